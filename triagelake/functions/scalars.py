"""Column expressions: event states, command tokens, label families, sentinels, keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as the Unicode standard lists it, plus the four separator controls.
WHITE_SPACE = (
    r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)

# Fixed values: (substring of the event id, state), first hit wins; anything else is "other".
EVENT_STATE_RULES = (
    ("session.connect", "connect"),
    ("client.", "fingerprint"),
    ("login.failed", "auth-fail"),
    ("login.success", "auth-success"),
    ("command.", "command"),
    ("file_download", "download"),
    ("session.closed", "close"),
)
EVENT_STATES = (*[state for _, state in EVENT_STATE_RULES], "other")

# Attack names of each family in the flow benchmark.
ATTACK_FAMILIES = {
    "normal": ["normal"],
    "dos": [
        "back", "land", "neptune", "pod", "smurf", "teardrop", "mailbomb",
        "apache2", "processtable", "udpstorm",
    ],
    "probe": ["satan", "ipsweep", "nmap", "portsweep", "mscan", "saint"],
    "r2l": [
        "guess_passwd", "ftp_write", "imap", "phf", "multihop", "warezmaster",
        "warezclient", "spy", "xlock", "xsnoop", "snmpguess", "snmpgetattack",
        "httptunnel", "sendmail", "named",
    ],
    "u2r": ["buffer_overflow", "loadmodule", "rootkit", "perl", "sqlattack", "xterm", "ps"],
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_state(event_id: Column | str) -> Column:
    """State of one log event by the first matching substring (B1)."""
    e = F.coalesce(_col(event_id), F.lit(""))
    out = F.lit("other")
    for needle, state in reversed(EVENT_STATE_RULES):
        out = F.when(e.contains(needle), state).otherwise(out)
    return out


def command_token(message: Column | str) -> Column:
    """First word of a logged command, reduced to safe characters, at most 32 long (B2)."""
    text = F.regexp_replace(
        F.coalesce(_col(message), F.lit("")), rf"^[^:]*:[{WHITE_SPACE}]*", ""
    )
    word = F.regexp_extract(text, rf"^[^{WHITE_SPACE};&|><]*", 0)
    safe = F.substring(F.regexp_replace(word, "[^A-Za-z0-9_.-]", ""), 1, 32)
    return F.when(safe == "", "unknown").otherwise(safe)


def clean_name(name: Column | str) -> Column:
    """Lower-cased name without surrounding white space."""
    return F.lower(
        F.regexp_replace(_col(name), rf"^[{WHITE_SPACE}]+|[{WHITE_SPACE}]+$", "")
    )


def attack_family(name: Column | str) -> Column:
    """Family of a raw attack name, ``other-attack`` if none lists it; a NULL name fails."""
    pairs = [F.lit(x) for family, names in ATTACK_FAMILIES.items() for n in names for x in (n, family)]
    found = F.try_element_at(F.create_map(*pairs), clean_name(name))
    return F.when(
        _col(name).isNull(), F.raise_error(F.lit("attack name is missing"))
    ).otherwise(F.coalesce(found, F.lit("other-attack")))


def binary_label(name: Column | str) -> Column:
    """0 for normal traffic, 1 for everything else; a NULL name fails."""
    return F.when(
        _col(name).isNull(), F.raise_error(F.lit("attack name is missing")).cast("int")
    ).otherwise((clean_name(name) != "normal").cast("int"))


def mask_sentinel(score: Column | str) -> Column:
    """Negative scores mean "not available" and become NULL."""
    s = _col(score)
    return F.when(s >= 0, s)


def missing_flag(value: Column | str) -> Column:
    """1 where the value is NULL, else 0."""
    return _col(value).isNull().cast("int")


def outcome_flag(count: Column | str) -> Column:
    """1 where a count is above zero."""
    return (_col(count) > 0).cast("int")


def external_id(references: Column | str, own_id: Column | str, source: str = "mitre-attack") -> Column:
    """External id of the first reference from ``source``, else the object's own id."""
    hits = F.filter(_col(references), lambda r: r["source_name"] == source)
    return F.coalesce(F.get(hits, F.lit(0))["external_id"], _col(own_id))


def package_key(purl: Column | str, version: Column | str) -> Column:
    """Package URL without its version, NULL where the component cannot be looked up."""
    p, v = _col(purl), _col(version)
    usable = p.startswith("pkg:") & (F.coalesce(v, F.lit("")) != "")
    return F.when(usable, F.regexp_replace(p, "@[^@]*$", ""))

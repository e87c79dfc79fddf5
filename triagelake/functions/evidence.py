"""Evidence text: cleaning, lines and fixed sentences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from triagelake.functions.scalars import WHITE_SPACE

# Contract version, allowed actions, sentence per action, cleaning patterns.
CONTRACT_VERSION = "selection-v2"
ALLOWED_ACTIONS = ("observe", "review", "corroborate", "compare", "defer")
ACTION_SENTENCES = {
    "observe": "The cited record reports {field} as {value} [{id}].",
    "review": "Review the cited record's {field} field, whose quoted value is {value} [{id}].",
    "corroborate": "Corroborate the cited {field} field ({value}) before operational use [{id}].",
    "compare": "Compare the cited {field} field ({value}) with independent evidence [{id}].",
    "defer": "Defer operational action until the cited {field} field ({value}) is corroborated [{id}].",
}
URL_PATTERN = rf"https?://[^{WHITE_SPACE}]+"
INJECTION_PATTERN = "ignore (all |the )?(previous|above)|system prompt|developer message"
URL_MARK, INJECTION_MARK = "[URL-REDACTED]", "[PROMPT-INJECTION-REMOVED]"
VALUE_LIMIT = 700
# No match of the injection pattern is longer than this, and the mark is: what lies farther behind the limit cannot move into it.
INJECTION_CHARS = len("ignore all previous")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sanitize_evidence(value: Column | str, limit: int = VALUE_LIMIT) -> Column:
    """Untrusted text made harmless: no markup, links, control characters or instructions.

    A missing value reads ``None``.
    """
    text = F.translate(F.coalesce(_col(value).cast("string"), F.lit("None")), "<>`", "[]")
    text = F.regexp_replace(text, URL_PATTERN, URL_MARK)
    text = F.regexp_replace(text, rf"[\x{{0}}-\x{{1f}}{WHITE_SPACE}]+", " ")
    near = F.substring(F.trim(text), 1, limit + INJECTION_CHARS)
    text = F.regexp_replace(near, f"(?iu){INJECTION_PATTERN}", INJECTION_MARK)
    return F.substring(text, 1, limit)


def evidence_line(evidence_id: Column | str, fields: Column | str) -> Column:
    """``[id] k=v; k=v`` of one record, fields in their given order."""
    parts = F.transform(_col(fields), lambda f: F.concat(f["field"], F.lit("="), sanitize_evidence(f["value"])))
    return F.concat(F.lit("["), _col(evidence_id), F.lit("] "), F.array_join(parts, "; "))


def json_string(value: Column) -> Column:
    """The value as a quoted JSON string."""
    listed = F.to_json(F.array(value))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def selection_sentence(action: Column, evidence_id: Column, field: Column, value: Column) -> Column:
    """The fixed sentence of an allowed action, filled in with an already sanitized value."""
    filled = {"field": F.replace(field, F.lit("_"), F.lit(" ")), "value": json_string(value), "id": evidence_id}
    out = F.lit(None).cast("string")
    for name, sentence in reversed(ACTION_SENTENCES.items()):
        pieces, rest = [], sentence
        while "{" in rest:
            before, rest = rest.split("{", 1)
            key, rest = rest.split("}", 1)
            pieces += [F.lit(before), filled[key]]
        out = F.when(action == name, F.concat(*pieces, F.lit(rest))).otherwise(out)
    return out

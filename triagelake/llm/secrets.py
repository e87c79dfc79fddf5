"""Secret scans: fixed patterns, and sliding windows of Shannon entropy over candidate strings."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagelake.llm.common import let, text_of


@dataclass(frozen=True)
class Kind:
    """A pattern whose matches count if group ``group`` has at least ``least`` code points.

    ``strict``, where given, matches just those of them, so texts need not list all short matches.
    """

    name: str
    pattern: str
    least: int
    group: int = 0
    strict: str | None = None


#: The base kinds, in the order that breaks ties.
BASE = (
    Kind("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    # A run's first AKIA takes the rest of the run, and a run of hex digits is one match: both have a strict form.
    Kind("access", r"AKIA[A-Z0-9]+", 16, strict=r"AKIA[A-Z0-9]{12,}"),
    Kind("hex", r"[0-9a-f]+", 32, strict=r"[0-9a-f]{32,}"),
)


@dataclass(frozen=True)
class CharClass:
    """Longest runs of ``alphabet`` in a candidate that match ``shape`` belong to the class; a window of
    ``window`` characters with at least ``bits`` bits of entropy a character marks a secret."""

    name: str
    alphabet: str
    shape: str
    window: int
    bits: float


DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
#: A run is scored by each class that fits it; a span inside another one is left out, of equal ones the first
#: class's stays. All need a digit: plain long words are no candidates.
CLASSES = (
    CharClass("entropy_hex", DIGITS + "abcdef", r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$", 20, 3.0),
    CharClass("entropy_lower", DIGITS + LOWER + "_-", r"^(?=.*[0-9].*[0-9])(?=.*[a-z])[0-9a-z_-]+$", 20, 3.7),
    CharClass("entropy_upper", DIGITS + LOWER.upper() + "_-", r"^(?=.*[0-9].*[0-9])(?=.*[A-Z])[0-9A-Z_-]+$", 20, 3.7),
    CharClass("entropy_mixed", DIGITS + LOWER + LOWER.upper() + "+/_=-", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z]).+$", 20, 3.9),
)
PLACEHOLDER = r"(?i:example|sample|dummy|placeholder|changeme|your[_-]|xxxx|0123456789|1234567890|abcdefgh)"
#: Texts without this have no candidate that counts.
LONG = r"[A-Za-z0-9+/_=-]{20}"
#: A placeholder is a match by itself and ends the run before it, so only windows that overlap it are lost.
CANDIDATE = rf"{PLACEHOLDER}|(?:(?!{PLACEHOLDER})[A-Za-z0-9+/_=-]){{20,}}"
#: A candidate that one of these finds is no secret (placeholders, paths, identifiers of public form).
ALLOWED = (
    PLACEHOLDER,
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"^(?:[A-Za-z]+[/_=-]+)+[A-Za-z]*[0-9]{0,4}$",
    r"^[0-9+/_=-]+$",
)
SCALE = 1 << 20
#: Matches are placed in runs of this many; growing one array of all would cost the square of their number.
RUN = 128


def _placed(text: Column, pattern: str, group: int = 0) -> Column:
    """Matches as structs (start, end, value), leftmost and non-overlapping; code points, end exclusive."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.split(text, pattern, -1)

    def walk(parts: Column) -> Column:
        """Length of a run, and its matches placed from its start."""
        empty = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")
        return F.aggregate(
            parts,
            F.struct(F.lit(0).cast("long").alias("at"), empty.alias("found")),
            lambda acc, x: let(acc["at"] + F.char_length(x["gap"]), lambda start: F.struct(
                (start + F.char_length(x["whole"])).alias("at"),
                F.concat(acc["found"], F.array(F.struct(
                    start.alias("start"), (start + F.char_length(x["whole"])).alias("end"), x["value"].alias("value")))
                ).alias("found"))),
        )

    def joined(runs: Column) -> Column:
        starts = F.aggregate(
            runs, F.array(F.lit(0).cast("long")), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x["at"])))
        return F.flatten(F.zip_with(runs, F.slice(starts, 1, F.size(runs)), lambda x, at: F.transform(
            x["found"], lambda m: F.struct((m["start"] + at).alias("start"), (m["end"] + at).alias("end"), m["value"].alias("value")))))

    def runs_of(parts: Column) -> Column:
        last = F.floor((F.size(parts) - 1) / RUN).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda r: walk(F.slice(parts, r * RUN + 1, F.lit(RUN))))

    zipped = F.arrays_zip(
        F.slice(gaps, 1, F.greatest(F.size(whole), F.lit(1))).alias("gap"), whole.alias("whole"), value.alias("value"))
    return let(zipped, lambda parts: let(runs_of(parts), joined))


def _numbered(spans: Column, kind: int, shift: Column | None = None) -> Column:
    """Spans as (start, kind, end), moved by ``shift``."""
    by = F.lit(0).cast("long") if shift is None else shift
    return F.transform(
        spans, lambda x: F.struct((x["start"] + by).alias("start"), F.lit(kind).alias("kind"), (x["end"] + by).alias("end")))


def windows(candidate: Column, kind: CharClass) -> Column:
    """Merged spans (start, end) of the windows of one candidate with enough entropy.

    Counts per character and the sum of c * log2(c) change by the one character that enters and
    the one that leaves. The sum is kept in whole numbers, so nothing drifts.
    """
    size = kind.window
    weight = [0] + [round(c * math.log2(c) * SCALE) for c in range(1, size + 1)]
    most = math.floor(size * (math.log2(size) - kind.bits) * SCALE) if math.log2(size) >= kind.bits else -1
    gain = F.array(*[F.lit(weight[c + 1] - weight[c]).cast("long") for c in range(size)])
    letters = F.lit(kind.alphabet)
    span = "array<struct<start:bigint,end:bigint>>"

    def scan(index: Column) -> Column:
        n = F.size(index)
        leaving = F.concat(F.array_repeat(F.lit(0), size), F.slice(index, 1, F.greatest(n - size, F.lit(0))))
        moves = F.zip_with(index, leaving, lambda a, b: F.struct(a.alias("a"), F.coalesce(b, F.lit(0)).alias("b")))
        start = F.struct(
            F.array_repeat(F.lit(0), len(kind.alphabet)).alias("counts"), F.lit(0).cast("long").alias("sum"),
            F.lit(0).cast("long").alias("i"), F.lit(-1).cast("long").alias("open"), F.lit(-1).cast("long").alias("close"),
            F.array().cast(span).alias("found"))

        def step(acc: Column, move: Column) -> Column:
            a, b = move["a"], move["b"]
            # 0 stands for "none"; characters are numbered from 1.
            out = F.when((b > 0), -F.get(gain, F.get(acc["counts"], b - 1) - 1)).otherwise(F.lit(0).cast("long"))
            less = F.get(acc["counts"], a - 1) - F.when(a == b, 1).otherwise(0)
            total = acc["sum"] + out + F.when(a > 0, F.get(gain, less)).otherwise(F.lit(0).cast("long"))
            counts = F.when(a == b, acc["counts"]).otherwise(F.transform(
                acc["counts"], lambda c, k: c + F.when(k == a - 1, 1).otherwise(0) - F.when(k == b - 1, 1).otherwise(0)))
            i = acc["i"] + 1

            def placed(s: Column) -> Column:
                hit = (i >= size) & (s <= most)
                far = hit & (acc["close"] >= 0) & (i - size > acc["close"])
                done = F.array(F.struct(acc["open"].alias("start"), acc["close"].alias("end")))
                return F.struct(
                    counts.alias("counts"), s.alias("sum"), i.alias("i"),
                    F.when(hit & ((acc["close"] < 0) | far), i - size).otherwise(acc["open"]).alias("open"),
                    F.when(hit, i).otherwise(acc["close"]).alias("close"),
                    F.when(far, F.concat(acc["found"], done)).otherwise(acc["found"]).alias("found"))

            return let(total, placed)

        def last(acc: Column) -> Column:
            tail = F.array(F.struct(acc["open"].alias("start"), acc["close"].alias("end")))
            return F.when(acc["close"] < 0, F.array().cast(span)).otherwise(F.concat(acc["found"], tail).cast(span))

        return F.aggregate(moves, start, step, last)

    chars = F.regexp_extract_all(candidate, F.lit("."), F.lit(0))
    return let(F.transform(chars, lambda c: F.instr(letters, c)), scan)


def _entropy(candidates: Column, classes: Sequence[CharClass], allowed: Sequence[str], first: int) -> Column:
    """Spans (start, kind, end) of all candidates of a text; kinds are numbered from ``first``."""
    kind_span = "array<struct<start:bigint,kind:int,end:bigint>>"

    def inside(x: Column, y: Column) -> Column:
        """Whether ``y`` makes ``x`` superfluous."""
        covered = (y["start"] <= x["start"]) & (y["end"] >= x["end"])
        wider = (y["start"] < x["start"]) | (y["end"] > x["end"])
        return covered & (wider | (y["kind"] < x["kind"]))

    def of_class(candidate: Column, number: int, kind: CharClass) -> Column:
        run = f"[{''.join(re.escape(c) for c in kind.alphabet)}]{{{kind.window},}}"
        fitting = F.filter(_placed(candidate["value"], run), lambda x: x["value"].rlike(kind.shape))
        return F.flatten(F.transform(
            fitting, lambda x: _numbered(windows(x["value"], kind), first + number, candidate["start"] + x["start"])))

    def of(candidate: Column) -> Column:
        found = F.concat(*[of_class(candidate, number, kind) for number, kind in enumerate(classes)])
        chosen = let(found, lambda spans: F.filter(spans, lambda x: ~F.exists(spans, lambda y: inside(x, y))))
        for pattern in allowed:
            chosen = F.when(candidate["value"].rlike(pattern), F.array().cast(kind_span)).otherwise(chosen)
        return chosen

    return F.flatten(F.transform(candidates, of))


def scan(
    docs: DataFrame, key: str = "doc_id", text: str = "text", *, base: Sequence[Kind] = BASE,
    classes: Sequence[CharClass] = CLASSES, allowed: Sequence[str] = ALLOWED, keep: Sequence[str] = (),
) -> DataFrame:
    """One row per document: (doc_id, ``keep`` columns, text, base, spans, kinds).

    ``base`` and ``spans`` are sorted arrays of (start, kind, end); ``kind`` is a number into the
    names of :func:`names`. Base spans always stay; the entropy windows add spans that no base span
    covers. Map-only and free of Python: a text without a match costs its regex passes only. A null
    text is empty, a null key is passed through, repeated rows give repeated results, an empty
    table an empty one.
    """
    kind_span = "array<struct<start:bigint,kind:int,end:bigint>>"
    rows = docs.select(F.col(key).alias("doc_id"), *keep, text_of(text).alias("_text"))
    probes = [(f"_k{i}", k.strict or k.pattern) for i, k in enumerate(base)]
    rows = rows.select("*", *[F.regexp_instr("_text", F.lit(p)).alias(n) for n, p in probes],
                       F.regexp_instr("_text", F.lit(LONG)).alias("_kc"))
    none = F.array().cast(kind_span)
    parts = []
    for i, kind in enumerate(base):
        long_enough = F.filter(
            _placed(F.col("_text"), kind.strict or kind.pattern, kind.group), lambda x: F.char_length(x["value"]) >= kind.least)  # noqa: B023
        found = _numbered(long_enough, i)
        parts.append(F.when(F.col(f"_k{i}") > 0, found).otherwise(none).alias(f"_b{i}"))
    rows = rows.select(
        "doc_id", *keep, "_text", *parts,
        F.when(F.col("_kc") > 0, _entropy(F.filter(
            _placed(F.col("_text"), CANDIDATE), lambda x: x["value"].rlike(LONG)), classes, allowed, len(base)))
        .otherwise(none).alias("_more"))
    rows = rows.select("doc_id", *keep, "_text", "_more", F.sort_array(F.concat(*[f"_b{i}" for i in range(len(base))])).alias("base"))
    new = F.filter("_more", lambda x: ~F.exists("base", lambda b: (b["start"] <= x["start"]) & (b["end"] >= x["end"])))
    return rows.select("doc_id", *keep, F.col("_text").alias("text"), "base", F.sort_array(F.concat("base", new)).alias("spans"))


def names(base: Sequence[Kind] = BASE, classes: Sequence[CharClass] = CLASSES) -> list[str]:
    return [k.name for k in base] + [c.name for c in classes]


def shown(spans: Column, kinds: Sequence[str] | None = None) -> Column:
    """kind:start:end, comma-joined."""
    known = F.array(*[F.lit(n) for n in (kinds or names())])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(known, x["kind"]), x["start"], x["end"])), ",")


def redacted(text: Column, spans: Column, mark: str = "[REDACTED]") -> Column:
    """``text`` with every span replaced by ``mark``; overlapping spans become one mark.

    A null text stays null, and one without a span stays as it is. Spans are those of :func:`scan`, by start; a long text is copied once
    for each of its spans at most.
    """
    walk = F.aggregate(
        spans,
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out")),
        lambda acc, x: F.struct(
            F.greatest(acc["at"], x["end"]).alias("at"),
            F.when(x["start"] >= acc["at"], F.concat(
                acc["out"], F.array(F.substring(text, acc["at"] + 1, x["start"] - acc["at"]), F.lit(mark)))
            ).otherwise(acc["out"]).alias("out")),
    )
    joined = let(walk, lambda w: F.concat(F.array_join(w["out"], ""), F.substring(text, w["at"] + 1, F.char_length(text).cast("long"))))
    return F.when(F.size(spans) == 0, text).otherwise(joined)

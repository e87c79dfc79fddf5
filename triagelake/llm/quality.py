"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagelake.llm.common import SPACE, WORD, let, text_of

#: Frequent short function words of the languages the rules know.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "with", "as", "was", "on", "be", "by", "this",
    "der", "die", "und", "das", "den", "von", "zu", "mit", "sich", "des", "auf", "ein", "nicht", "eine", "als",
    "le", "la", "les", "et", "des", "un", "une", "du", "que", "est", "pour", "dans", "qui", "par", "pas", "sur",
    "el", "los", "las", "y", "en", "por", "se", "del", "al", "lo", "como", "su", "para", "con", "no", "una",
)

#: (rule, measure, low, high): a document fails the rule if its measure is below low or above high.
#: None leaves a side open. The measures are those of :func:`ratios`.
RULES: tuple[tuple[str, str, float | None, float | None], ...] = (
    ("mean_word_length", "mean_word_length", 2.0, 20.0),
    ("symbol_ratio", "symbol_ratio", None, 0.10),
    ("stop_words", "stop_ratio", 0.01, None),
    ("repeated_lines", "dup_line_ratio", None, 0.30),
    ("bullet_lines", "bullet_ratio", None, 0.90),
    ("ellipsis_lines", "ellipsis_ratio", None, 0.30),
    ("words_with_letters", "letter_ratio", 0.70, None),
)


def repeated_words(words: Column) -> Column:
    """Number of words inside windows of three words that occur at least twice in the array.

    Equal windows are found by sorting (window hash, position); the covered words are the union of
    the intervals [p, p + 3). No work is quadratic in the length of the text.
    """
    nothing = F.lit(0).cast("long")

    def covered(places: Column) -> Column:
        # places: sorted starts of repeated windows; each adds min(3, distance to the one before).
        step = F.aggregate(
            places,
            F.struct(F.lit(-3).cast("long").alias("last"), nothing.alias("n")),
            lambda acc, p: F.struct(
                p.cast("long").alias("last"), (acc["n"] + F.least(F.lit(3).cast("long"), p - acc["last"])).alias("n")),
        )
        return step["n"]

    def starts(ordered: Column) -> Column:
        n = F.size(ordered)
        same = lambda x, i: (F.get(ordered, i)["h"] == x["h"])
        picked = F.filter(
            ordered, lambda x, i: ((i > 0) & same(x, i - 1)) | ((i < n - 1) & same(x, i + 1)))
        return F.sort_array(F.transform(picked, lambda x: x["p"]))

    def hashes(w: Column) -> Column:
        return F.transform(
            F.slice(w, 1, F.size(w) - 2), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))

    def count(h: Column) -> Column:
        paired = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p")))
        heavy = let(F.sort_array(paired), lambda z: let(starts(z), covered))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), nothing).otherwise(heavy)

    return F.when(F.size(words) < 3, nothing).otherwise(let(hashes(words), count))


def counts(text: Column, words: Column, lines: Column, stop_words: Sequence[str] = STOP_WORDS) -> dict[str, Column]:
    """Counts over one text, its words and its lines that have a word."""
    stops = "|".join(dict.fromkeys(stop_words))
    times = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("long")
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.char_length(F.regexp_replace(text, f"[{SPACE}]+", "")).cast("long"),
        "n_symbols": times("[#*$%&|<>]"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": repeated_words(words),
        "n_stop": times(rf"(?i)(?<![^{SPACE}])(?:{stops})(?=[.,;:!?]?(?:[{SPACE}]|$))"),
        "n_lettered": times(rf"(?<![^{SPACE}])[^{SPACE}\p{{L}}]*+\p{{L}}"),
        "n_bullet": times(r"(?m)^[\x20\t]*(?:[-*•]\x20|\|)"),
        "n_ellipsis": times(r"(?m)(?:\.\.\.|…)[\x20\t]*$"),
    }


def ratios() -> dict[str, Column]:
    """The measures of the rules, from the columns of :func:`counts`."""
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    return {
        "mean_word_length": F.col("word_chars") / words,
        "symbol_ratio": F.col("n_symbols") / words,
        "stop_ratio": F.col("n_stop") / words,
        "letter_ratio": F.col("n_lettered") / words,
        "dup_line_ratio": F.col("n_dup_lines") / lines,
        "bullet_ratio": F.col("n_bullet") / lines,
        "ellipsis_ratio": F.col("n_ellipsis") / lines,
    }


def compile_rules(rules: Sequence[tuple[str, str, float | None, float | None]] = RULES) -> Column:
    """The names of the failed rules as one expression over the columns of :func:`ratios`."""
    failed = []
    for name, measure, low, high in rules:
        bad = F.lit(False)
        if low is not None:
            bad = bad | (F.col(measure) < low)
        if high is not None:
            bad = bad | (F.col(measure) > high)
        failed.append(F.when(bad, F.lit(name)))
    return F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")


def judge(
    docs: DataFrame, key: str = "doc_id", text: str = "text", *, rules=RULES, min_words: int = 50,
    max_repeat_percent: int = 50, stop_words: Sequence[str] = STOP_WORDS,
) -> DataFrame:
    """One row per document with its counts, ``base_failed``, ``failed_rules`` and ``kept``.

    Map-only: projections of built-in functions over whole texts, no shuffle and no Python.
    A null text counts as one without words and fails the base rule; a null key is passed through;
    repeated rows are judged alike; other columns of ``docs`` are not read. An empty table gives
    an empty result.
    """
    split = docs.select(F.col(key).alias("doc_id"), text_of(text).alias("_text")).select(
        "*", F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)).alias("_words"),
        F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(f"[^{SPACE}]")).alias("_lines"))
    parts = counts(F.col("_text"), F.col("_words"), F.col("_lines"), stop_words)
    found = split.select("doc_id", *[c.alias(n) for n, c in parts.items()])
    found = found.select("*", *[c.alias(n) for n, c in ratios().items()])
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    judged = found.select("*", base.alias("base_failed"), compile_rules(rules).alias("failed_rules"))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))

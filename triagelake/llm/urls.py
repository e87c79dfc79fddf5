"""URL filters: host and path rules, and a ratio of two character language models for the rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagelake.core import cut

#: Fixed values: (verdict, host, path) of the rules.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Symbols of the models; upper case is lowered, digits count as 0, anything else as !.
ALPHABET = "abcdefghijklmnopqrstuvwxyz0./:?=&_%#-~+,;@!"
ORDER = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path of a url; both empty where it is null or has no ``://``."""
    shape = "://([^/?#]*)([^?#]*)"
    held = F.coalesce(url.cast("string"), F.lit(""))
    return F.translate(F.regexp_extract(held, shape, 1), UPPER, LOWER), F.regexp_extract(held, shape, 2)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def symbols(url: Column) -> Column:
    low = F.translate(F.translate(F.coalesce(url.cast("string"), F.lit("")), UPPER, LOWER), "123456789", "0" * 9)
    return F.regexp_replace(low, r"[^a-z0./:?=&_%#~+,;@-]", "!")


def _grams(rows: DataFrame, carried: Sequence[str]) -> DataFrame:
    """One row per character of ``_url``: g0 .. gORDER hold it with that many characters before it."""
    padded = F.concat(F.lit("^" * ORDER), F.col("_url"))
    at = rows.withColumn("_pad", padded).where(F.length("_url") > 0).select(
        *carried, "_pad", F.explode(F.sequence(F.lit(ORDER + 1), F.length("_pad"))).alias("_i"))
    return at.select(*carried, *[F.substring("_pad", F.col("_i") - o, F.lit(o + 1)).alias(f"g{o}") for o in range(ORDER + 1)])


def fit(urls: DataFrame, strength: float = 2.0) -> list[DataFrame]:
    """Per order o a table (gram, llr): log P(char | o before it) under accepted minus under rejected.

    ``urls`` has _url (symbols) and accepted. Counts cover all rows. An order's estimate is its counts
    plus ``strength`` times the estimate of the order below. The tables hold at most
    len(ALPHABET)^(o + 1) rows and a few padded ones, whatever the input: under four million at order 3.
    """
    grams = _grams(urls.select("_url", "accepted"), ["accepted"])
    long = grams.select("accepted", F.explode(F.array(*[
        F.struct(F.lit(o).alias("o"), F.col(f"g{o}").alias("gram")) for o in range(ORDER + 1)])).alias("x"))
    counted = cut(long.groupBy("x.o", "x.gram").agg(
        F.count(F.when(F.col("accepted"), 1)).alias("a"), F.count(F.when(~F.col("accepted"), 1)).alias("r")))
    tables = []
    lower = None
    for o in range(ORDER + 1):
        own = counted.where(F.col("o") == o).withColumn("_context", F.substring("gram", 1, o)).drop("o")
        context = own.groupBy("_context").agg(F.sum("a").alias("_ca"), F.sum("r").alias("_cr"))
        own = own.join(context, "_context")
        if lower is None:
            own = own.withColumn("_la", F.lit(1.0 / len(ALPHABET))).withColumn("_lr", F.lit(1.0 / len(ALPHABET)))
        else:
            own = own.withColumn("_suffix", F.substring("gram", 2, o)).join(
                lower.select(F.col("gram").alias("_suffix"), F.col("pa").alias("_la"), F.col("pr").alias("_lr")), "_suffix")
        lower = cut(own.select(
            "gram", ((F.col("a") + strength * F.col("_la")) / (F.col("_ca") + strength)).alias("pa"),
            ((F.col("r") + strength * F.col("_lr")) / (F.col("_cr") + strength)).alias("pr")))
        tables.append(lower.select("gram", (F.log("pa") - F.log("pr")).alias("llr")))
    return tables


def score(rows: DataFrame, tables: Sequence[DataFrame], carried: Sequence[str]) -> DataFrame:
    """``carried`` columns and ``ratio``: the log-likelihood difference per character (0 for an empty url).

    Each character uses the longest context in which the models know it. The tables are bounded by the
    alphabet (see :func:`fit`), so they are broadcast; characters are joined and summed where they are,
    and one row per url and task is shuffled.
    """
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    names = [*carried, "_row"]
    grams = _grams(rows, names)
    for o, table in enumerate(tables):
        grams = grams.join(F.broadcast(table.select(F.col("gram").alias(f"g{o}"), F.col("llr").alias(f"_l{o}"))), f"g{o}", "left")
    best = F.coalesce(*[F.col(f"_l{o}") for o in reversed(range(len(tables)))], F.lit(0.0))
    known = grams.groupBy(*names).agg(F.avg(best).alias("ratio"))
    blank = rows.where(F.length("_url") == 0).select(*names, F.lit(0.0).alias("ratio"))
    return known.unionByName(blank).drop("_row")


def threshold(scored: DataFrame, step: float = 0.01, most: float = 6.0) -> float:
    """The ratio that parts accepted from rejected best (mean of both error rates), from a histogram.

    ``scored`` has ratio and accepted. Equal errors: the middle of the range. One class missing: 0.
    """
    at = F.floor(F.greatest(F.lit(-most), F.least(F.lit(most), F.col("ratio"))) / step).cast("int")
    bins = scored.groupBy(at.alias("bin")).agg(
        F.count(F.when(F.col("accepted"), 1)).alias("a"), F.count(F.when(~F.col("accepted"), 1)).alias("r")).orderBy("bin").collect()
    all_a, all_r = sum(b["a"] for b in bins), sum(b["r"] for b in bins)
    if not all_a or not all_r:
        return 0.0
    below_a = below_r = 0
    tried = [(all_r / all_r, bins[0]["bin"])]  # everything accepted
    for b in bins:
        below_a, below_r = below_a + b["a"], below_r + b["r"]
        tried.append((below_a / all_a + (all_r - below_r) / all_r, b["bin"] + 1))
    least = min(t[0] for t in tried)
    good = [t[1] for t in tried if t[0] <= least + 1e-12]
    upper = next((b["bin"] for b in bins if b["bin"] >= good[-1]), good[-1])
    return step * (good[0] + upper) / 2


def judge(
    pages: DataFrame, key: str = "page_id", url: str = "url", *, rules: Sequence[tuple[str, str, str]] = RULES,
    strength: float = 2.0, held_out: int = 5,
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, ratio.

    A rule's verdict stands. The rest is judged by two variable-order character models, of urls that
    rules allow and of those they block: allowed if the difference of log-likelihoods per character
    reaches a threshold, set on every ``held_out``-th ruled url (by hash), which the models don't see.
    Null and empty urls have ratio 0; null keys pass through; repeated rows are judged alike; without
    ruled urls all ratios are 0 and the verdict is allow; an empty table gives an empty result.
    """
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(key).alias("page_id"), host.alias("host"), path.alias("path"), symbols(F.col(url)).alias("_url"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", name).withColumn("_ruled", verdict)
    known = rows.where(F.col("_ruled").isNotNull()).withColumn("accepted", F.col("_ruled") == "allow")
    part = F.pmod(F.xxhash64("page_id", "_url"), F.lit(held_out))
    tables = fit(known.where(part != 0), strength)
    cutoff = threshold(score(known.where(part == 0), tables, ["accepted"]))
    scored = score(rows, tables, ["page_id", "host", "path", "rule", "_ruled"])
    own = F.when(F.col("ratio") >= cutoff, F.lit("allow")).otherwise(F.lit("block"))
    return scored.select("page_id", "host", "path", "rule", F.coalesce("_ruled", own).alias("verdict"), "ratio")



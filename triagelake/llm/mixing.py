"""Mixing sources to target weights: Sainte-Laguë quotas of equal-token blocks, then seeded block selection."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from triagelake.core import cut, number_rows
from triagelake.llm.common import SPACE, WORD, text_of

#: Blocks that the smallest source has at least, unless it has fewer words.
PARTS = 64
#: Rows that one bucket of a source's line should hold.
BUCKET_ROWS = 4096


def source_targets(
    sources: DataFrame, *, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0
) -> tuple[DataFrame, float]:
    """``sources`` (source, source_size) with source_no, weight and target; also the total.

    Weights repeat over the sources in code point order, null last. A target is weight * level, but at most
    ``most`` * size; what a capped source gives up is shared again by weight. The level only rises, and
    each round is one aggregate over the source table with one row as its result.
    """
    numbered, _ = number_rows(sources, [F.col("source").asc_nulls_last()], "source_no")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    held = cut(numbered.withColumn("weight", F.get(cycle, (F.col("source_no") % len(weights)).cast("int"))))
    cap = F.col("source_size") * float(most)
    total = share * (held.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:
        full = F.col("weight") * level >= cap
        fixed, free = held.agg(F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("weight")))).first()
        if not free:
            break
        higher = (total - (fixed or 0.0)) / free
        if higher <= level * (1 + 1e-12):
            break
        level = higher
    return held.withColumn("target", F.least(F.col("weight") * level, cap)), total


def quotas(targets: DataFrame, total: float, block_words: int, most: int = 2) -> DataFrame:
    """Blocks per source by Sainte-Laguë: the highest quotients target / (2k + 1) get a block each.

    All quotients that surely win are counted, not listed; only about ten for each source around the
    last seat are ranked, by a range-partitioned sort. A source with n blocks gets ``most`` * n at most.
    """
    n_sources, mass = targets.agg(F.count(F.lit(1)), F.sum("target")).first()
    mass = mass or 0.0
    seats = round(total / block_words)
    blocks = F.ceil(F.col("source_size") / block_words).cast("long")
    exact = F.col("target") * (seats / mass if mass else 0.0)
    slack = (F.ceil(F.col("target") / (mass or 1.0) * 1.5 * n_sources) + 2).cast("long")
    sure = F.greatest(F.lit(0).cast("long"), F.floor(exact + 0.5).cast("long") - slack)
    base = cut(targets.withColumn("blocks", blocks).withColumn("_slack", slack)
               .withColumn("_sure", F.least(sure, most * F.col("blocks"))))
    open_seats = seats - (base.agg(F.sum("_sure")).first()[0] or 0)
    last = F.least(F.col("_sure") + 2 * F.col("_slack"), most * F.col("blocks")) - 1
    rivals = base.where(last >= F.col("_sure")).select(
        "source_no", "target", F.explode(F.sequence("_sure", last)).alias("k"))
    ranked, _ = number_rows(
        rivals.withColumn("quotient", F.col("target") / (2 * F.col("k") + 1)),
        [F.col("quotient").desc(), F.col("source_no"), F.col("k")], "rank")
    won = ranked.where((F.col("rank") < open_seats) & (F.col("quotient") > 0)).groupBy("source_no").agg(F.count(F.lit(1)).alias("_won"))
    return base.join(won, "source_no", "left").withColumn(
        "quota", F.col("_sure") + F.coalesce("_won", F.lit(0))).drop("_sure", "_slack", "_won")


def shard_quotas(quota: DataFrame, shards: int) -> DataFrame:
    """(source, shard, blocks): each source's whole quota dealt evenly, the remainders rotating over shards."""
    turn = F.col("source_no") % shards
    part = lambda k: F.floor((k * F.col("quota") + turn) / F.lit(shards)).cast("long")
    dealt = quota.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    return dealt.select("source", "shard", (part(F.col("shard") + 1) - part(F.col("shard"))).alias("blocks"))


def _placed(rows: DataFrame, n_rows: int) -> DataFrame:
    """Adds ``_at``: the words of the source before each row, in seeded order.

    Rows are dealt to hash buckets of about BUCKET_ROWS; totals are added up within a bucket, over the
    buckets of a super bucket, and over the super buckets of a source. No window holds a whole source.
    """
    bits = max(0, math.ceil(math.log2(max(1, n_rows) / BUCKET_ROWS)))
    low = bits // 2
    bucket = F.shiftrightunsigned("_h", 64 - bits) if bits else F.lit(0).cast("long")
    rows = rows.withColumn("_bucket", bucket)
    before = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("source_no", "_bucket").agg(F.sum("size").alias("_n")).withColumn("_super", F.shiftright("_bucket", low))
    top = sums.groupBy("source_no", "_super").agg(F.sum("_n").alias("_t")).select(
        "source_no", "_super", F.coalesce(F.sum("_t").over(before("source_no").orderBy("_super")), F.lit(0)).alias("_far"))
    sums = sums.withColumn("_near", F.coalesce(F.sum("_n").over(before("source_no", "_super").orderBy("_bucket")), F.lit(0)))
    offsets = sums.join(top, ["source_no", "_super"]).select("source_no", "_bucket", (F.col("_far") + F.col("_near")).alias("_base"))
    inside = before("source_no", "_bucket").orderBy("_h", "doc_id", "size")
    return rows.join(offsets, ["source_no", "_bucket"]).withColumn(
        "_at", F.col("_base") + F.coalesce(F.sum("size").over(inside), F.lit(0))).drop("_base", "_bucket")


def mix(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", *, weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5, most: int = 2, block_words: int = 64, seed: str = "mix", keep: Sequence[str] = (),
) -> DataFrame:
    """One row per document: doc_id, ``keep``, size, source_size, target, taken, ranges.

    The documents of a source lie on a line in seeded order, cut into blocks of ``block_words`` words
    (fewer if the smallest source would have less than PARTS blocks, one at least). A source gets its quota of blocks by Sainte-Laguë:
    whole passes over the line, and for the rest a run of neighbouring blocks from a seeded start.
    As the line is shuffled by document, a run is a random choice that cuts two documents at most.
    ``ranges`` lists the taken word ranges (from, to) of the document, ``taken`` is their length.

    Null texts have size 0 and are taken 0 times; the null source is a source of its own; null keys
    and repeated rows are placed like others; an empty table gives an empty result; ``keep`` must not name a column of the result. Results depend on
    the rows and the seed only. No part of the line and no source is gathered in one task.
    """
    if clash := {"doc_id", "size", "source_size", "target", "taken", "ranges"} & set(keep):
        raise ValueError(f"keep names columns of the result: {sorted(clash)}")
    rows = docs.select(
        F.col(key).alias("doc_id"), F.col(source).cast("string").alias("_source"), *[F.col(c).alias(f"_keep_{c}") for c in keep],
        F.regexp_count(text_of(text), F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), F.col(key), text_of(text)).alias("_h"))
    rows = cut(rows)
    sources = rows.groupBy(F.col("_source").alias("source")).agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows"))
    targets, total = source_targets(cut(sources), weights=weights, share=share, most=most)
    smallest = targets.where("source_size > 0").agg(F.min("source_size")).first()[0] or 1
    words = max(1, min(block_words, smallest // PARTS))
    plan = quotas(targets, total, words, most)
    n_rows = targets.agg(F.sum("_rows")).first()[0] or 0
    start = F.pmod(F.xxhash64(F.lit(seed), F.col("source")), F.greatest(F.col("blocks"), F.lit(1)))
    passes = F.floor(F.col("quota") / F.greatest(F.col("blocks"), F.lit(1))).cast("long")
    # quota and blocks are below 2^53, so the divisions above are exact where they matter.
    plan = plan.select(
        F.col("source").alias("_plan_source"), "source_no", "source_size", "target", passes.alias("_passes"),
        (F.col("quota") - passes * F.col("blocks")).alias("_run"), start.alias("_start"), "blocks")
    same = F.col("_source").eqNullSafe(F.col("_plan_source"))
    placed = _placed(rows.join(plan, same).drop("_source", "_plan_source"), n_rows)
    stop = F.col("_start") + F.col("_run")
    first = (F.col("_start") * words, F.least(stop * words, F.col("source_size")))
    wrapped = (F.lit(0).cast("long"), F.greatest(stop - F.col("blocks"), F.lit(0)) * words)

    def overlap(span):
        low = F.greatest(span[0] - F.col("_at"), F.lit(0).cast("long"))
        high = F.least(span[1] - F.col("_at"), F.col("size"))
        return F.struct(low.alias("from"), high.alias("to"))

    whole = F.array_repeat(F.struct(F.lit(0).cast("long").alias("from"), F.col("size").alias("to")), F.col("_passes").cast("int"))
    ranges = F.filter(F.concat(whole, F.array(overlap(first), overlap(wrapped))), lambda r: r["to"] > r["from"])
    length = F.aggregate("ranges", F.lit(0).cast("long"), lambda n, r: n + r["to"] - r["from"])
    return placed.withColumn("ranges", ranges).select(
        "doc_id", *[F.col(f"_keep_{c}").alias(c) for c in keep], "size", "source_size", "target",
        length.alias("taken"), "ranges")


def mixture(mixed: DataFrame, text: str = "text") -> DataFrame:
    """One row per taken range of :func:`mix` (run with ``keep`` holding the text), with its part of the text.

    A range over the whole document keeps the text as it is; a part keeps the white space between its words. Documents that
    are not taken (null and empty texts among them) give no row; repeated rows give their own; an empty table gives an empty result.
    """
    taken = mixed.withColumn("_range", F.explode("ranges"))
    low, high = F.col("_range")["from"], F.col("_range")["to"]
    words = F.regexp_extract_all(text, F.lit(rf"[{SPACE}]*{WORD}"), F.lit(0))
    part = F.array_join(F.slice(words, (low + 1).cast("int"), (high - low).cast("int")), "")
    return taken.withColumn(text, F.when((low == 0) & (high == F.col("size")), F.col(text)).otherwise(part)).drop("_range")

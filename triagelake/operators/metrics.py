"""Ranking and agreement metrics, ranks and folds; all keyed, none gathers a key in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagelake import SEED
from triagelake.core import det_rand, number_rows, running_sums, value_buckets


def ranking_metrics(
    rows: DataFrame, keys: Sequence[str], score: str, label: str, *,
    weight: str | None = None, bucket: str | None = None,
) -> DataFrame:
    """Average precision (ties grouped) and ROC-AUC (ties count one half) per key.

    Rows with equal scores merge before the shuffle; running totals over the score levels are
    two-level. A key without positives or without negatives gets NULL where undefined.
    """
    placed = rows.withColumn("_w", F.col(weight).cast("double") if weight else F.lit(1.0))
    if bucket is None:
        placed, bucket = value_buckets(placed, score), "_bucket"
    levels = placed.groupBy(*keys, bucket, score).agg(
        F.sum(F.col("_w") * F.col(label)).alias("_pos"), F.sum("_w").alias("_all")
    )
    cum = running_sums(
        levels, keys, score, {"_pos": "_cpos", "_all": "_call"}, bucket=bucket, descending=True
    )
    neg, cneg = F.col("_all") - F.col("_pos"), F.col("_call") - F.col("_cpos")
    sums = cum.groupBy(*keys).agg(
        F.sum("_pos").alias("positives"),
        F.sum(neg).alias("negatives"),
        F.sum(F.col("_pos") * F.try_divide(F.col("_cpos"), F.col("_call"))).alias("_ap"),
        F.sum(F.col("_pos") * (neg / 2 - cneg)).alias("_auc"),
    )
    return sums.select(
        *keys,
        F.when(F.col("positives") > 0, F.col("_ap") / F.nullif("positives", F.lit(0.0))).alias("average_precision"),
        F.when(
            (F.col("positives") > 0) & (F.col("negatives") > 0),
            1.0 + F.try_divide(F.col("_auc"), F.col("positives") * F.col("negatives")),
        ).alias("roc_auc"),
        "positives", "negatives",
    )


def average_rank_pct(rows: DataFrame, value: str, name: str) -> DataFrame:
    """Mean rank of equal values divided by the row count, added as ``name``."""
    levels = rows.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    placed = value_buckets(levels, value, like=rows)
    cum = running_sums(placed, [], value, {"_n": "_cum"}, bucket="_bucket")
    total = levels.agg(F.sum("_n").alias("t")).scalar()
    ranks = cum.select(
        value, ((F.col("_cum") - F.col("_n") + (F.col("_n") + 1) / 2) / total).alias(name)
    )
    return rows.join(ranks, value, "left")


def degree_baseline(nodes: DataFrame, transitive: str, direct: str) -> DataFrame:
    """0.7 x rank of transitive dependents + 0.3 x rank of direct dependents."""
    ranked = average_rank_pct(average_rank_pct(nodes, transitive, "_t"), direct, "_d")
    return ranked.withColumn("baseline", F.col("_t") * 0.7 + F.col("_d") * 0.3).drop("_t", "_d")


def adjusted_rand(pairs: DataFrame, keys: Sequence[str], a: str, b: str, weight: str | None = None) -> DataFrame:
    """Adjusted Rand index of two labelings per key.

    The contingency table is made with map-side combine; only its cells are summed further. ``weight`` is the
    number of points a row stands for.
    """
    cells = pairs.groupBy(*keys, a, b).agg((F.sum(weight) if weight else F.count(F.lit(1))).cast("double").alias("_n"))
    choose2 = lambda c: F.sum(F.col(c) * (F.col(c) - 1) / 2)
    inner = cells.groupBy(*keys).agg(choose2("_n").alias("_ij"), F.sum("_n").alias("_total"))
    by_a = cells.groupBy(*keys, a).agg(F.sum("_n").alias("_n")).groupBy(*keys).agg(choose2("_n").alias("_a"))
    by_b = cells.groupBy(*keys, b).agg(F.sum("_n").alias("_n")).groupBy(*keys).agg(choose2("_n").alias("_b"))
    if keys:
        joined = inner.join(by_a, list(keys)).join(by_b, list(keys))
    else:
        joined = inner.select("*", by_a.scalar().alias("_a"), by_b.scalar().alias("_b"))
    all_pairs = F.col("_total") * (F.col("_total") - 1) / 2
    expected = F.try_divide(F.col("_a") * F.col("_b"), all_pairs)
    top, bottom = F.col("_ij") - expected, (F.col("_a") + F.col("_b")) / 2 - expected
    ari = F.when(bottom.isNull() | (bottom == 0), 1.0).otherwise(F.try_divide(top, bottom))
    return joined.select(*keys, ari.alias("ari"))


def stratified_folds(rows: DataFrame, id_col: str, label: str, folds: int = 5, seed: int = SEED) -> DataFrame:
    """Fold number per row, shuffled by the seed, even within each class."""
    shuffled = rows.withColumn("_u", det_rand(seed, id_col))
    numbered, _ = number_rows(shuffled, [F.col(label).asc(), F.col("_u").asc(), F.col(id_col).asc()])
    first = numbered.groupBy(label).agg(F.min("row_no").alias("_first"))
    return numbered.join(first, label).withColumn(
        "fold", ((F.col("row_no") - F.col("_first")) % folds).cast("int")
    ).drop("_u", "row_no", "_first")

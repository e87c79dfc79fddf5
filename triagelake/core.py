"""Helpers shared by the operators.

Nothing here puts an unbounded group into one task: global order is made by range
partitioning, running totals by value buckets whose small totals are added up first.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from triagelake.session import ensure_checkpoint_dir


def cut(df: DataFrame) -> DataFrame:
    """Materialize ``df`` in the shared checkpoint folder and drop its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def bucketed(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` written as a table bucketed by ``keys`` in the shared checkpoint folder.

    The planner knows the layout, so joins on all the keys read it in place instead of shuffling it. Rows of
    one combination of keys share a bucket: split hot keys by a further key first.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    name = f"bucketed_{uuid.uuid4().hex}"
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}"
    buckets = shuffle_partitions(df)
    (df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).option("path", folder).format("parquet").saveAsTable(name))
    return spark.table(name)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written by columns in the shared checkpoint folder, without its lineage; who needs few columns reads only those."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/stored_{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def det_rand(seed: int | str, *keys: Column | str) -> Column:
    """Uniform [0, 1) double that depends only on ``seed`` and the keys, never on partitioning.

    It has 52 random bits, so floor(number * n) reaches every slot of tables of up to 2^52 rows.
    """
    parts = [F.lit(str(seed))]
    parts += [(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]
    head = F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, 13)
    return F.conv(head, 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))


def det_rand_sql(seed: int | str, *keys: str) -> str:
    """The same number in plain SQL (for cross-checks)."""
    parts = ", ".join([f"'{seed}'", *[f"CAST({k} AS VARCHAR)" for k in keys]])
    return f"(('0x' || left(md5(concat_ws('|', {parts})), 13))::BIGINT / {float(1 << 52)!r}::DOUBLE)"


def finite(column: Column | str) -> Column:
    """NaN and infinities become NULL."""
    c = (F.col(column) if isinstance(column, str) else column).cast("double")
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(None)).otherwise(c)


def strict(condition: Column, value: Column, message: str) -> Column:
    """``value`` where ``condition`` holds; fails the job elsewhere."""
    return F.when(condition, value).otherwise(F.raise_error(F.lit(message)))


def number_rows(df: DataFrame, order: Sequence[Column], name: str = "row_no") -> tuple[DataFrame, int]:
    """Number all rows 0..n-1 in ``order`` without a single-task window; also returns n.

    ``order`` must be total (end in a unique id). Rows are range partitioned and sorted, so a
    value shared by a third of the rows still spreads over tasks. The placed rows are
    checkpointed because the numbering and the per-partition counts must see one placement.
    """
    placed = cut(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    part = F.shiftright("_mid", 33).cast("int")
    counts = placed.groupBy(part.alias("_part")).count().collect()  # one row per partition
    offsets, total = [], 0
    for row in sorted(counts, key=lambda r: r["_part"]):
        offsets.append((row["_part"], total))
        total += row["count"]
    base = df.sparkSession.createDataFrame(offsets or [(0, 0)], "_part int, _base long")
    numbered = (
        placed.withColumn("_part", part)
        .join(F.broadcast(base), "_part")
        .withColumn(name, F.col("_base") + F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_part", "_base", "_mid")
    )
    return numbered, total


def value_buckets(
    df: DataFrame, value: str, name: str = "_bucket", like: DataFrame | None = None
) -> DataFrame:
    """Add a bucket number that rises with ``value``; buckets hold similar row counts.

    ``like`` may give the same values from an earlier, cheaper stage to take the bounds from.

    The bucket is a function of the value alone, so any recomputation agrees. Buckets follow the
    quantiles of all rows together, so no (key, bucket) group is larger than one bucket.
    """
    parts = max(2, shuffle_partitions(df))
    probs = [i / parts for i in range(1, parts)]
    bounds = (df if like is None else like).select(F.col(value).cast("double").alias("v")).approxQuantile(
        "v", probs, 1.0 / (4 * parts)
    )
    # Infinite bounds and a table without values leave no inner bound; Bucketizer needs one.
    inner = sorted({b for b in bounds if abs(b) != float("inf")}) or [0.0]
    splits = [float("-inf"), *inner, float("inf")]
    cast = df.withColumn("_as_double", F.col(value).cast("double"))
    return (
        Bucketizer(splits=splits, inputCol="_as_double", outputCol=name, handleInvalid="error")
        .transform(cast)
        .drop("_as_double")
    )


def running_sums(
    df: DataFrame, keys: Sequence[str], value: str, sums: dict[str, str], *,
    bucket: str | None = None, descending: bool = False,
) -> DataFrame:
    """Inclusive running totals per key in rising (or falling) order of ``value``.

    ``df`` has one row per (keys, value); ``sums`` maps a column to the name of its running total.
    Two levels: totals within value buckets by a window, plus the totals of the buckets before.
    """
    placed = df if bucket else value_buckets(df, value, "_bucket")
    bucket = bucket or "_bucket"
    way = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    inside = (
        Window.partitionBy(*keys, bucket).orderBy(way(value))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # One row per (keys, bucket) here; without keys that is one row per bucket, fine for one task.
    before = (
        Window.partitionBy(*(keys or [F.lit(0)])).orderBy(way(bucket))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    totals = placed.groupBy(*keys, bucket).agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    totals = totals.select(
        *keys, bucket,
        *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_b_{c}") for c in sums],
    )
    inner = placed.select("*", *[F.sum(c).over(inside).alias(f"_i_{c}") for c in sums])
    joined = inner.join(totals, [*keys, bucket])
    return joined.select(
        *df.columns, *[(F.col(f"_i_{c}") + F.col(f"_b_{c}")).alias(out) for c, out in sums.items()]
    )


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], weight: str | None = None
) -> DataFrame:
    """Linear-interpolation quantiles per key as (keys, prob, quantile); NULL values are ignored.

    ``weight`` is a whole-number frequency. Equal values are merged before the shuffle and no key
    is gathered in one task, unlike the built-in exact percentile.
    """
    rows = df.where(F.col(value).isNotNull())
    amount = F.sum(weight) if weight else F.count(F.lit(1))
    levels = rows.groupBy(*keys, value).agg(amount.cast("long").alias("_n")).where("_n > 0")
    placed = value_buckets(levels, value, like=rows)
    cum = running_sums(placed, keys, value, {"_n": "_cum"}, bucket="_bucket")
    totals = levels.groupBy(*keys).agg(F.sum("_n").alias("_total"))
    if keys:
        cum = cum.join(totals, list(keys))
    else:
        cum = cum.withColumn("_total", totals.select("_total").scalar())
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob")
    spread = cum.select("*", wanted).withColumn("_h", (F.col("_total") - 1) * F.col("prob"))
    first = F.col("_cum") - F.col("_n")
    holds = lambda i: (first <= i) & (i < F.col("_cum"))
    low, high = F.floor("_h"), F.ceil("_h")
    picked = spread.where(holds(low) | holds(high)).groupBy(*keys, "prob").agg(
        F.max(F.when(holds(low), F.col(value).cast("double"))).alias("_lo"),
        F.max(F.when(holds(high), F.col(value).cast("double"))).alias("_hi"),
        F.max("_h").alias("_h"),
    )
    return picked.select(
        *keys, "prob",
        (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("_h") - F.floor("_h"))).alias("quantile"),
    )


def in_parallel(*steps: Callable[[], object]) -> list:
    """Run a few independent chains of jobs side by side, so small rounds share the cluster."""
    wrap = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        return [f.result() for f in [pool.submit(wrap(s)) for s in steps]]

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from triagelake.core import det_rand, exact_quantiles, in_parallel, number_rows, running_sums


def test_det_rand_is_md5_and_ignores_partitioning(spark):
    one = spark.range(50).coalesce(1).select("id", det_rand(7, "id").alias("u"))
    many = spark.range(50).repartition(8).select("id", det_rand(7, "id").alias("u"))
    a, b = ({r.id: r.u for r in df.collect()} for df in (one, many))
    assert a == b
    assert a[3] == int(hashlib.md5(b"7|3").hexdigest()[:13], 16) / 2**52


def test_number_rows_orders_a_hot_value_by_id(spark):
    rows = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 7).alias("v"), "id")
    numbered, total = number_rows(rows.repartition(8), [F.col("v").desc(), F.col("id").asc()])
    got = numbered.orderBy("row_no").toPandas()
    want = rows.toPandas().sort_values(["v", "id"], ascending=[False, True])
    assert total == 1000
    assert got["row_no"].tolist() == list(range(1000))
    assert got["id"].tolist() == want["id"].tolist()


def test_number_rows_of_nothing(spark):
    numbered, total = number_rows(spark.range(0).select("id"), [F.col("id").asc()])
    assert total == 0 and numbered.count() == 0


def test_running_sums_both_ways(spark):
    pdf = pd.DataFrame({"k": [i % 3 for i in range(300)], "v": [i // 3 for i in range(300)], "n": range(300)})
    df = spark.createDataFrame(pdf)
    for down in (False, True):
        got = running_sums(df, ["k"], "v", {"n": "c"}, descending=down).toPandas().sort_values(["k", "v"])
        want = pdf.sort_values(["k", "v"], ascending=[True, not down]).assign(c=lambda d: d.groupby("k")["n"].cumsum())
        assert got["c"].tolist() == want.sort_values(["k", "v"])["c"].tolist()


def test_exact_quantiles_match_numpy_with_weights(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"k": rng.integers(0, 2, 400), "v": np.round(rng.normal(size=400), 1), "w": rng.integers(0, 4, 400)})
    got = exact_quantiles(spark.createDataFrame(pdf), ["k"], "v", [0.0, 0.1, 0.5, 0.9, 1.0], weight="w").toPandas()
    for _, r in got.iterrows():
        part = pdf[pdf.k == r["k"]]
        assert np.isclose(r["quantile"], np.quantile(np.repeat(part.v, part.w), r["prob"]))
    plain = exact_quantiles(spark.createDataFrame(pdf), [], "v", [0.25]).first()
    assert np.isclose(plain["quantile"], np.quantile(pdf.v, 0.25))


def test_in_parallel_keeps_order(spark):
    assert in_parallel(lambda: spark.range(3).count(), lambda: spark.range(5).count()) == [3, 5]


def test_quantiles_of_odd_tables(spark):
    empty = spark.createDataFrame([], "k string, v double")
    assert exact_quantiles(empty, [], "v", [0.5]).where("quantile IS NOT NULL").count() == 0
    blank = spark.createDataFrame([("a", None), ("b", None)], "k string, v double")
    assert exact_quantiles(blank, ["k"], "v", [0.5]).count() == 0
    ends = spark.createDataFrame([("a", float("inf")), ("a", 1.0), ("a", float("-inf"))], "k string, v double")
    assert exact_quantiles(ends, ["k"], "v", [0.5]).first()["quantile"] == 1.0

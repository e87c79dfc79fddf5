"""Sharding: one law for all rows, whole groups, gapless slots."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from triagelake.llm import queries, sharding

SF = "/root/testdata/sf0.01"


def checked(rows, shards=8):
    """Shard sizes, after checks of slots."""
    filled, slots = [0] * shards, {}
    for r in rows:
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
        filled[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    return filled


def test_whole_table(spark):
    texts = {r["doc_id"]: (r["text"] or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows, again = queries.op13_sharding(spark, SF).collect(), queries.op13_sharding(spark, SF).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, again), key=str)
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == {k: (len(t.encode()) + 1, zlib.crc32(t.encode())) for k, t in texts.items()}
    filled = checked(rows)
    assert max(filled) - min(filled) <= max(sum(filled) / 8 / 64, max(r["size"] for r in rows) / 2)
    groups = {}
    for r in rows:
        groups.setdefault(texts[r["doc_id"]], []).append(r)
    unit = sum(filled) // 512
    assert all(len({r["shard"] for r in own}) == 1 for own in groups.values() if sum(r["size"] for r in own) <= unit)


def test_hot_texts_are_dealt(spark):
    rows = [(i, "hot text of all" if i % 3 == 0 else f"text {i} " + "x" * (i % 50)) for i in range(9000)] + [(9001, "y" * 20_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    filled = checked(got := sharding.assign(df).collect())
    assert len(got) == len(rows) and max(filled) <= 1.02 * np.mean(filled)
    assert len({r["shard"] for r in got if r["doc_id"] % 3 == 0 and r["doc_id"] < 9000}) > 4  # that of the long text may have none
    five = checked(sharding.assign(df.repartition(7), 5).collect(), 5)
    assert max(five) <= 1.02 * np.mean(five)
    assert sorted(map(tuple, sharding.assign(df.repartition(3)).collect()), key=str) == sorted(map(tuple, got), key=str)


def test_cells_number_without_gaps(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CELL_ROWS", 10)
    df = spark.range(700).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 40).alias("text"))
    checked(sharding.assign(df, 3).collect(), 3)


def test_splitters_are_quantiles_of_bytes(spark):
    rows = sharding.sized(spark.createDataFrame([(i, f"{i} " + "z" * (i % 97)) for i in range(20_000)], "doc_id long, text string")).cache()
    total = rows.agg(F.sum("size")).first()[0]
    bounds = sharding.splitters(rows, total, 16)
    parts = {r["_range"]: r["b"] for r in sharding._ranged(rows, bounds, []).groupBy("_range").agg(F.sum("size").alias("b")).collect()}
    assert len(parts) == 16 and max(parts.values()) < 1.5 * total / 16
    want = np.searchsorted(bounds, [r["_key"] for r in rows.select("_key").orderBy("doc_id").collect()], side="right")
    got = [r["_range"] for r in sharding._ranged(rows, bounds, []).orderBy("doc_id").collect()]
    assert got == want.tolist()
    rows.unpersist()


def test_edges(spark):
    rows = [(None, None), (None, None), (1, ""), (2, None), (3, "x" * 500_000), (3, "same"), (3, "same"), (4, "é")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, size int, shard int")
    got = sharding.assign(df).collect()
    assert len(got) == len(rows)
    checked(got)
    assert {(r["size"], r["text_crc32"]) for r in got if r["doc_id"] in (None, 1, 2)} == {(1, 0)}
    assert sharding.assign(df.limit(0)).count() == 0
    assert {r["shard"] for r in sharding.assign(df, 1).collect()} == {0}


def test_files(spark, tmp_path):
    df = spark.createDataFrame([(i, f"text {i % 50}", i % 3) for i in range(2000)], "doc_id long, text string, source int")
    made = sharding.write(df, f"{tmp_path}/out", 4)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.columns == ["doc_id", "text", "source", "shard"] and back.count() == 2000
    want = {r["doc_id"]: r["shard"] for r in sharding.assign(df, 4).collect()}
    assert {r["doc_id"]: r["shard"] for r in back.collect()} == want and made.shards == 4
    with pytest.raises(ValueError, match="shard"):
        sharding.write(back, f"{tmp_path}/more")

"""Mixing against plain Python quotas and water levels."""

import heapq
import re

import pytest
from pyspark.sql import functions as F

from triagelake.llm import mixing, queries

SF = "/root/testdata/sf0.001"


def plain_targets(sizes):
    """sizes: [(source, size)] in order."""
    weights = {s: (5, 2, 1)[i % 3] for i, (s, _) in enumerate(sizes)}
    sizes = dict(sizes)
    total, fixed = 1.5 * sum(sizes.values()), {}
    while len(fixed) < len(sizes):
        level = (total - sum(fixed.values())) / sum(w for s, w in weights.items() if s not in fixed)
        more = {s: 2.0 * sizes[s] for s in sizes if s not in fixed and weights[s] * level > 2 * sizes[s]}
        if not more:
            break
        fixed |= more
    return {s: fixed.get(s, weights[s] * level if len(fixed) < len(sizes) else 0.0) for s in sizes}


def test_quotas_are_sainte_lague(spark):
    rows = [(i, f"s{i}", 1000 + 137 * i * i, 300.0 + 91 * i * i) for i in range(23)]
    df = spark.createDataFrame(rows, "source_no long, source string, source_size long, target double")
    total = sum(r[3] for r in rows)
    got = {r["source_no"]: r["quota"] for r in mixing.quotas(df, total, 50).collect()}
    heap = [(-t, n, 0) for n, _, _, t in rows]
    heapq.heapify(heap)
    want = dict.fromkeys(got, 0)
    for _ in range(round(total / 50)):
        q, n, k = heapq.heappop(heap)
        want[n] += 1
        heapq.heappush(heap, (-rows[n][3] / (2 * k + 3), n, k + 1))
    assert got == want


def test_shards_add_up(spark):
    df = spark.createDataFrame([(0, "a", 10), (1, "b", 3), (2, "c", 0)], "source_no long, source string, quota long")
    got = mixing.shard_quotas(df, 4).groupBy("source").agg(F.sum("blocks"), F.max("blocks") - F.min("blocks")).collect()
    assert {r[0]: r[1] for r in got} == {"a": 10, "b": 3, "c": 0} and all(r[2] <= 1 for r in got)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    size = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in docs}
    per = {}
    for r in docs:
        per[r["source"]] = per.get(r["source"], 0) + size[r["doc_id"]]
    targets = plain_targets(sorted(per.items(), key=lambda x: (x[0] is None, x[0] or "")))
    source = {r["doc_id"]: r["source"] for r in docs}
    got, again = queries.op6_mixing(spark, SF).collect(), queries.op6_mixing(spark, SF).collect()
    assert sorted(got) == sorted(again) and len(got) == len(docs)
    taken = dict.fromkeys(per, 0)
    for r in got:
        s = source[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], per[s])
        assert r["target"] == pytest.approx(targets[s])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    for s, n in taken.items():
        assert abs(n - targets[s]) <= 3 * 64  # whole blocks, and a last block that is shorter


def test_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 4)
    texts = [None, "", "one", "a b c " * 50, "x y"] * 6
    rows = [(None if i % 7 == 0 else i // 2, t, [None, "b", "a"][i % 3], 9, 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int, taken int")
    mixed = mixing.mix(df, block_words=8, keep=("text", "source"))
    got = mixed.collect()
    assert len(got) == len(rows)
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    for s in (None, "a", "b"):
        own = [r for r in got if r["source"] == s]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 16
    words = mixing.mixture(mixed).select("doc_id", F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).alias("n")).agg(F.sum("n")).first()[0]
    assert words == sum(r["taken"] for r in got)
    assert mixing.mix(df.limit(0)).count() == 0


def test_small_sources_reach_their_targets(spark):
    """Sources of a few words beside a large one, and a table of four words."""
    sizes = {"big": 20_000, "a": 10, "b": 10, "c": 30, "d": 100, "e": 1}
    rows = [(i, s, "w " * (n // 4 + (k < n % 4))) for i, (s, n) in enumerate(sizes.items()) for k in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixing.mix(df, keep=("source",)).collect()
    for s in sizes:
        own = [r for r in got if r["source"] == s]
        assert own[0]["source_size"] == sizes[s]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 2, s
    four = mixing.mix(spark.createDataFrame([(1, "a", "one two three four")], "doc_id long, source string, text string")).collect()
    assert four[0]["taken"] == 6
    with pytest.raises(ValueError, match="size"):
        mixing.mix(df, keep=("size",))

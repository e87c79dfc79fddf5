"""Importance resampling against plain Python and the C library's CRC."""

import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from triagelake.llm import importance, queries

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def features_of(text, grams):
    words = words_of(text)
    return [" ".join(words[i : i + n]) for n in range(1, grams + 1) for i in range(len(words) - n + 1)]


def plain(docs, target, grams=1, buckets=10_000, percent=10, least=20, seed=2024):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for texts, into in (([x for _, x in docs], s), (target, t)):
        for text in texts:
            for f in features_of(text, grams):
                into[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    rows = []
    for key, text in docs:
        own = features_of(text, grams)
        weight = sum(gain[bucket(f)] for f in own)
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((key, len(own), weight, score, len(words_of(text)) >= least))
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    ranks = {}
    for i, r in enumerate(able[: percent * len(able) // 100]):
        ranks.setdefault(r, []).append(i + 1)
    return sorted((*r[:4], ranks[r].pop(0) if ranks.get(r) else None) for r in rows) if all(r[0] is not None for r in rows) else (rows, ranks)


def test_crc_matrices():
    rng = np.random.default_rng(0)
    lengths = np.concatenate([np.arange(0, 40), [5] * 30, [2048, 2049, 5000, 0]])
    data = rng.integers(0, 256, int(lengths.sum()), dtype=np.uint8)
    starts = np.cumsum(lengths) - lengths
    want = [zlib.crc32(data[s : s + n].tobytes()) for s, n in zip(starts, lengths, strict=True)]
    assert importance.crc32(data, starts, lengths).tolist() == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("aBz09 .-éŞ語\U0001f600\n", max_size=30), max_size=6), st.integers(1, 3))
def test_features(texts, grams):
    for window, block in ((importance.WINDOW, importance.BLOCK_FEATURES), (5, 2)):
        old = importance.WINDOW, importance.BLOCK_FEATURES
        importance.WINDOW, importance.BLOCK_FEATURES = window, block
        try:
            got = [(int(o), int(b)) for owner, bucket in importance.feature_buckets(pa.array(texts, pa.string()), grams, 997) for o, b in zip(owner, bucket, strict=True)]
        finally:
            importance.WINDOW, importance.BLOCK_FEATURES = old
        assert sorted(got) == sorted((i, zlib.crc32(f.encode()) % 997) for i, t in enumerate(texts) for f in features_of(t, grams))


def test_whole_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = queries.op12_importance(spark, SF)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == plain(docs, target)


@pytest.mark.parametrize("grams", [1, 2, 3])
def test_small_tables(spark, grams):
    rng = np.random.default_rng(grams)
    vocabulary = ["Ab", "cd", "x1", "语言", "é", "word"]
    docs = [(i, " ".join(rng.choice(vocabulary, rng.integers(0, 12)))) for i in range(90)]
    docs += [(90, None), (91, ""), (92, "a" * 300_000), (93, "ab " * 100_000), (5, docs[5][1])]
    df = spark.createDataFrame([(*d, "x", 7) for d in docs], "doc_id long, text string, source string, weight int")
    target = ["ab ab cd", None, "word ab"]
    got = importance.resample(df, spark.createDataFrame([(t,) for t in target], "text string"), grams=grams, buckets=50, percent=25, least_words=4)
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(plain(docs, target, grams, 50, 25, 4), key=str)
    kept = importance.resample(df, df.limit(0), keep=("source",), grams=grams)
    assert kept.columns == ["doc_id", "source", "n_features", "weight", "score", "rank"] and kept.count() == len(docs)
    with pytest.raises(ValueError, match="weight"):
        importance.resample(df, df, keep=("weight",))
    assert importance.resample(df.limit(0), df).count() == 0


def test_null_keys(spark):
    df = spark.createDataFrame([(None, "one two three")] * 3 + [(1, "one two")], "doc_id long, text string")
    got = importance.resample(df, df, least_words=2, percent=100).collect()
    assert sorted(r["rank"] for r in got) == [1, 2, 3, 4] and len({r["score"] for r in got if r["doc_id"] is None}) == 1

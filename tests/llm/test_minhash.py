"""Near-duplicates against all pairs of full sets."""

import random
import re

import numpy as np
import pytest

from triagelake.llm import minhash, queries

SF = "/root/testdata/sf0.001"


def plain_set(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def plain_components(rows, percent):
    sets = [(i, plain_set(t)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (a, s) in enumerate(sets):
        for b, t in sets[n + 1:]:
            if a is None or b is None or not s or not t:
                continue
            if 100 * len(s & t) >= percent * len(s | t):
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return {i: top(i) for i in parent}


def check(spark, rows, percent=85):
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, label int")
    got = minhash.near_duplicates(df, percent=percent).collect()
    want = plain_components(rows, percent)
    assert len(got) == len(rows)
    for r in got:
        assert r["component_id"] == (None if r["doc_id"] is None else want[r["doc_id"]])
        assert r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"])
    by = {}
    for i, t in rows:
        by.setdefault(i, []).append(len(plain_set(t)))
    for r in got:
        assert r["n_shingles"] in by[r["doc_id"]]


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"n{rng.random()}"
    return " ".join(words)


def test_components_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(minhash, "CHUNK_DOCS", 16)  # stars are cut into several chunks
    rng = random.Random(8)
    rows, n = [], 0
    for _ in range(6):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([6, 40, 150]))]
        chain = base
        for k in range(30):
            rows.append((n := n + rng.randrange(1, 3), edited(rng, base, rng.randrange(0, 6))))
            if k % 6 == 0:
                chain = edited(rng, chain, 2).split()
                rows.append((n := n + 1, " ".join(chain)))
    rows += [(n + i, t) for i, t in enumerate([None, "", " \n", "one", "ONE", "one two three", "One  two\tthree", "a b c d", "a b c d e", "A b C d E f",
                                               "x " * 500, "x " * 900, "long " + " ".join(map(str, range(8000)))], 1)]
    rows += [(None, "one"), (None, None), (2, rows[1][1])]
    rng.shuffle(rows)
    check(spark, rows)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(df).count() == 0 and minhash.keep_first(df).count() == 0


def test_whole_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = plain_components(docs, 85)
    got = queries.op7_minhash(spark, SF).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {i: len(plain_set(t)) for i, t in docs}


def test_densified_sketches_estimate_similarity():
    rng = np.random.default_rng(2)
    for size, share in ((7, 6 / 7), (60, 0.8), (3000, 0.6)):
        both = rng.integers(0, 1 << 63, 2 * size).astype(np.uint64)
        common = round(2 * size * share / (1 + share))
        agree = []
        for s in range(60):
            mixed = minhash.mix(both, s)
            a, b = mixed[:size], mixed[size - common:2 * size - common]
            x, y = minhash.sketches(np.concatenate([a, b]), np.array([size, size]))
            agree.append((x == y).mean())
        assert np.mean(agree) == pytest.approx(common / (2 * size - common), abs=0.03)


def test_keep_first(spark):
    base = " ".join(f"w{i}" for i in range(100))
    rows = [(5, base, "a"), (3, base + " end", "b"), (9, "other text here", "c"), (None, base, "d"), (9, "other text here", "c"), (11, None, "e"), (12, "", "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = sorted((r["doc_id"] or 0, r["kept"]) for r in minhash.keep_first(df).collect())
    assert got == [(0, "d"), (3, "b"), (9, "c"), (11, "e"), (12, "f")]

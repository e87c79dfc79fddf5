"""Fingerprints against plain Python votes."""

import hashlib
import random
import re

import xxhash

from pyspark.sql import functions as F

from triagelake.llm import queries, simhash

SF = "/root/testdata/sf0.001"
MASK = (1 << 64) - 1


def chain(*values):
    """Spark's xxhash64 of several whole numbers."""
    seed = 42
    for v, size in values:
        seed = xxhash.xxh64_intdigest((v & MASK).to_bytes(8, "little")[:size], seed)
    return seed


def plain(text):
    words = [xxhash.xxh64_intdigest(w.encode(), 42) for w in re.findall(r"[^\x20\x09-\x0D]+", text)]
    grams = [words[i:i + 5] for i in range(len(words) - 4)] or ([words] if words else [])
    out = []
    for half in range(2):
        hashes = [chain((half, 4), *[(w, 8) for w in g]) for g in grams]
        out.append(sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes)))
    return out


def bits(x):
    return bin(x & MASK).count("1")


def check(rows, got):
    order = sorted(rows, key=lambda r: -(r[0] if r[0] is not None else -(1 << 63)))
    assert len(got) == len(rows)
    by = {(r["doc_id"], r["edited_sha256"]): r for r in got}
    for i, (key, text) in enumerate(order):
        following = order[(i + 1) % len(order)][1] or ""
        text = text or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        r = by[key, hashlib.sha256(edited.encode()).hexdigest()]
        a, b, c = plain(text), plain(edited), plain(following)
        assert r["n_chars"] == len(text)
        assert r["fingerprint"] == "".join(f"{x:016x}" for x in a) and r["edited_fingerprint"] == "".join(f"{x:016x}" for x in b)
        assert r["near_edited"] == 1 - sum(bits(x ^ y) for x, y in zip(a, b, strict=True)) / 128
        assert r["near_next"] == 1 - sum(bits(x ^ y) for x, y in zip(a, c, strict=True)) / 128


def test_whole_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op4_simhash(spark, SF).collect()
    check(docs, got)
    assert sum(r["near_edited"] for r in got) / len(got) > sum(r["near_next"] for r in got) / len(got) + 0.1


def test_edges(spark):
    rows = [(7, None), (6, ""), (5, "é🙂 a b c d e f g"), (4, "one"), (3, "x y " * 3000), (1 << 60, "big id here"), (-4, "neg"), (None, "null id, last"), (2, "a\x0bb\x0cc")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, block int")
    check(rows, queries.simhash_columns(simhash.with_edits(df)).collect())
    one = spark.createDataFrame([(1, "alone here now and then again")], "doc_id long, text string")
    check([(1, "alone here now and then again")], queries.simhash_columns(simhash.with_edits(one)).collect())
    assert simhash.with_edits(one.limit(0)).count() == 0
    same = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (1, "d e f")], "doc_id long, text string")
    assert simhash.with_edits(same).count() == 3


def test_search_finds_all_within_the_radius(spark):
    rng = random.Random(1)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = []
    for _ in range(40):
        a, b = rng.getrandbits(64), rng.getrandbits(64)
        for _ in range(6):
            x, y = a, b
            for _ in range(rng.randrange(0, 4)):
                k = rng.randrange(128)
                x, y = (x ^ 1 << k, y) if k < 64 else (x, y ^ 1 << (k - 64))
            rows.append((signed(x), signed(y)))
    rows += rows[:20]
    df = spark.createDataFrame(rows, "a long, b long")
    for radius in (0, 1, 3, 6):
        got = {tuple(r) for r in simhash.search(df.where(F.col("a") % 3 == 0), df, radius).collect()}
        want = {(p, q, x, y, d) for p, q in set(rows) if p % 3 == 0 for x, y in set(rows) if (d := bits(p ^ x) + bits(q ^ y)) <= radius}
        assert got == want

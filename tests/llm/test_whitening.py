"""Whitening against a dense eigensolver and plain Python sums."""

import math
from fractions import Fraction

import numpy as np
import pytest

from triagelake.llm import feast, queries, whitening

SF = "/root/testdata/sf0.01"


def symmetric(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values),) * 2))
    m = (q * np.array(values, float)) @ q.T
    return (m + m.T) / 2


@pytest.mark.parametrize("values", [
    [4.0], [3, 1], [5] * 20 + [1] * 20, [3, 2, 2, 1] + [0] * 30, [1e6] + [1] * 30, [0] * 6, [1] * 24,
    list(np.geomspace(1e6, 1e-3, 30)), [7, 7 - 1e-9, 7 - 2e-9] + [1] * 9, [-3, -1, 2, 4]])
def test_eigenpairs_and_inertia(values):
    m = symmetric(values)
    want = np.sort(np.array(values, float))[::-1]
    scale = max(1e-300, np.abs(want).max())
    for at in (0.5, 1.5, 3.3, -2.0):
        assert feast.above(m, at) == (want > at).sum()
    got, vectors = feast.largest(m, 16)
    want = want[want > 1e-12 * scale][:16]
    assert len(got) == len(want) and np.allclose(got, want, rtol=1e-12, atol=1e-13 * scale)
    assert np.allclose(vectors.T @ vectors, np.eye(len(got)), atol=1e-13)
    assert np.abs(m @ vectors - vectors * got).max(initial=0) < 1e-12 * scale


def test_exact_gram():
    rng = np.random.default_rng(1)
    for size in (3, 1 << 20, 1 << 25, 1 << 40):
        x = rng.integers(-size, size, (40, 3))
        want = [[sum(int(a) * int(b) for a, b in zip(x[:, i], x[:, j], strict=True)) for j in range(3)] for i in range(3)]
        assert whitening.exact_gram(x).tolist() == want


def plain(rows, steps=64):
    """vec_id -> (deviation, scores up to sign by component), n, eigenvalues, trace."""
    xs = [(k, tuple(math.floor(steps * float(c)) + 1_000_000 for c in v)) for k, v in rows
          if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    listed = sorted({x for _, x in xs})
    n, d = len(listed), len(listed[0])
    sums = [sum(x[i] for x in listed) for i in range(d)]
    off = np.array([[float(Fraction(n * x[i] - sums[i], n)) for i in range(d)] for x in listed])
    cov = off.T @ off / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = []
    for k, x in xs:
        dev = [n * x[i] - sums[i] for i in range(d)]
        out.append((k, sum(v * v for v in dev), np.array(dev, float) / n @ vectors / np.sqrt(values)))
    return out, n, values, np.trace(cov)


def test_whole_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want, n, values, trace = plain(rows)
    got = queries.op11_whitening(spark, SF).collect()
    assert len(got) == 16 * len(want) and {r["n"] for r in got} == {n}
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], {})[r["component"]] = r
    signs = np.sign([by[want[0][0]][c + 1]["whitened"] * want[0][2][c] for c in range(16)])
    for key, deviation, scores in want:
        own = by[key]
        assert {r["deviation"] for r in own.values()} == {deviation}
        assert np.allclose([own[c + 1]["whitened"] for c in range(16)], signs * scores[:16], atol=1e-8)
    assert np.allclose([by[want[0][0]][c + 1]["explained"] for c in range(16)], values[:16] / trace, rtol=1e-10)


def test_edges(spark):
    schema = "vec_id long, embedding array<float>, component int, text string"
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.1, 0.2, 0.3]), (1, [0.1, 0.2, 0.3]), (None, [0.5, -0.2, 0.1]), (2, None), (3, [0.1, None, 0.2]),
            (4, [nan, 0.0, 0.0]), (5, [0.0, inf, 0.0]), (6, []), (7, [1.0]), (8, [-0.4, 0.9, 0.0]), (9, [0.3, 0.3, -0.8]), (10, [0.7, 0.1, 0.2])]
    df = spark.createDataFrame([(*r, 5, "x") for r in rows], schema)
    got = whitening.whiten(df).collect()
    want, n, values, trace = plain([r for r in rows if r[0] not in (6, 7)])
    assert n == 5 and len(got) == 3 * len(want) == 18  # three dimensions, so three components
    assert sorted({r["deviation"] for r in got}) == sorted({w[1] for w in want})
    assert {r["component"] for r in got} == {1, 2, 3} and got[0]["identity_error"] < 1e-9
    assert whitening.whiten(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="component"):
        whitening.whiten(df, keep=("vec_id", "component"))
    # Equal vectors vary in no direction.
    same = whitening.whiten(df.where("vec_id = 1")).collect()
    assert len(same) == 6 and all(r["whitened"] is None and r["explained"] == 0 and r["deviation"] == 0 and r["identity_error"] is None for r in same)
    # Two distinct vectors vary in one.
    two = {r["component"]: r for r in whitening.whiten(df.where("vec_id IN (1, 8)")).where("vec_id = 8").collect()}
    assert abs(abs(two[1]["whitened"]) - 1) < 1e-12 and two[2]["whitened"] is None and abs(two[1]["explained"] - 1) < 1e-12


def test_far_entries(spark):
    df = spark.createDataFrame([(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [5.0, 2.0]), (4, [1e9, 3.0])], "vec_id long, embedding array<double>")
    got = whitening.whiten(df).collect()
    assert len(got) == 8 and all(r["deviation"] is None for r in got) and got[0]["identity_error"] < 1e-4

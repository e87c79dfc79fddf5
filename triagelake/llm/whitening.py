"""Embedding whitening: exact sums of the distinct vectors, principal components by contour integration."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagelake.core import cut
from triagelake.llm import feast

#: Rows of an Arrow batch that are worked on together.
ROWS = 4096
LONG = (1 << 63) - 1
GRAM = "i int, j int, v decimal(38,0)"


@dataclass(frozen=True)
class Fit:
    """Of the fit list: rows, exact sums per dimension, components (columns), their variances and shares."""

    n: int
    sums: list[int]
    components: np.ndarray
    variance: np.ndarray
    explained: np.ndarray


def grid(rows: DataFrame, vector: str, *, steps: float = 64.0, shift: int = 1_000_000) -> DataFrame:
    """Adds ``x``, the entries of ``vector`` as floor(steps * entry) + shift; rows that cannot be used go.

    Such rows have a null vector, a null or non-finite entry, no entry at all, or not the number of entries that
    most rows have (the larger number if two are equally frequent). floor(steps * entry) stops at plus and minus 2^62.
    """
    far = F.lit(2.0**62 / steps)
    entry = lambda c: F.floor(F.lit(steps) * F.greatest(F.least(c.cast("double"), far), -far)) + F.lit(shift)
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf")))
    kept = rows.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False)))
    sizes = kept.groupBy(F.size(vector).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.orderBy(F.col("n").desc(), F.col("d").desc()).first()  # one row per number of entries
    kept = kept.where(F.size(vector) == (most["d"] if most else 0))
    return kept.withColumn("x", F.transform(vector, lambda c: entry(c).cast("long")))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def _slices(batches: Iterator[pa.RecordBatch], limit: int = ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, limit):
            yield batch.slice(start, limit)


def exact_gram(rows: np.ndarray) -> np.ndarray:
    """Sum of the outer products of whole-number rows, exact, as Python integers.

    Products are added in doubles over as many rows as keep every partial sum below 2^53; rows too large for that
    are multiplied as Python integers.
    """
    total = np.zeros((rows.shape[1],) * 2, object)
    most = int(np.abs(rows).max(initial=0)) ** 2
    if most >= 1 << 53:
        whole = rows.astype(object)
        return total + whole.T @ whole
    step = max(1, (1 << 53) // max(1, most) - 1)
    values = rows.astype(np.float64)
    for start in range(0, len(rows), step):
        part = values[start : start + step]
        total = total + (part.T @ part).astype(np.int64).astype(object)
    return total


def _decimals(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = None, 0
    for batch in _slices(batches):
        x = _matrix(batch.column("x"))
        # Sums of 32-bit halves cannot overflow within a slice.
        own = (x >> 32).sum(axis=0).astype(object) * (1 << 32) + (x & 0xFFFFFFFF).sum(axis=0).astype(object)
        total, n = own if total is None else total + own, n + len(x)
    if n:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, len(total), dtype=np.int32)), _decimals([n, *total])], ["i", "v"])


def _grams(centre: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = len(centre)
        middle = np.array(centre, np.int64)
        gram, sums = np.zeros((d, d), object), np.zeros(d, object)
        i, j = np.triu_indices(d)
        some = False
        for batch in _slices(batches):
            x = _matrix(batch.column("x"))
            off = x - middle if np.abs(x).max(initial=0) < 1 << 61 else x.astype(object) - middle.astype(object)
            gram, sums, some = gram + exact_gram(off), sums + off.astype(object).sum(axis=0), True
        if some:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(i, np.full(d, -1)).astype(np.int32)), pa.array(np.append(j, np.arange(d)).astype(np.int32)),
                 _decimals([*gram[i, j], *sums])], ["i", "j", "v"])

    return run


def covariance(listed: DataFrame) -> tuple[int, list[int], np.ndarray]:
    """(rows, sums per dimension, covariance) of the ``x`` vectors of ``listed``, divisor n.

    Vectors are centred before they are multiplied: the whole part of the mean is taken off each vector,
    the products are added exactly, and the rest of the mean (below one half) is taken off the totals exactly. So the matrix is
    the true one rounded once per entry, whatever the order of the rows. Dimensions x dimensions numbers of
    each task are added up by Spark; one such matrix reaches the driver.
    """
    found = {r["i"]: int(r["v"]) for r in listed.select("x").mapInArrow(_sums, "i int, v decimal(38,0)")
             .groupBy("i").agg(F.sum("v").alias("v")).collect()}
    n = found.pop(-1, 0)
    sums = [found[i] for i in range(len(found))]
    if not n:
        return 0, [], np.zeros((0, 0))
    centre = [(2 * s + n) // (2 * n) for s in sums]
    parts = listed.select("x").mapInArrow(_grams(centre), GRAM).groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    cells = {(r["i"], r["j"]): int(r["v"]) for r in parts}
    d = len(sums)
    matrix = np.zeros((d, d))
    for i in range(d):
        for j in range(i, d):
            matrix[i, j] = matrix[j, i] = (n * cells[i, j] - cells[-1, i] * cells[-1, j]) / (n * n)
    return n, sums, matrix


def fit(listed: DataFrame, components: int = 16) -> Fit:
    """Components of the vectors of ``listed`` (each counts once, so give it distinct ones)."""
    n, sums, matrix = covariance(listed)
    values, vectors = feast.largest(matrix, components)
    trace = float(np.trace(matrix))
    # Either sign is right; the largest entry is made positive, so reruns agree.
    turn = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))]) if len(values) else np.zeros(0)
    return Fit(n, sums, vectors * turn, values, values / trace if trace else values)


def _offsets(x: np.ndarray, model: Fit) -> tuple[np.ndarray, list]:
    """n * x - sums, exact, and the sums of their squares (None where a long can't hold one)."""
    near, rest = (np.array(v, np.int64) for v in zip(*(divmod(s, model.n) for s in model.sums), strict=True))
    if np.abs(x).max(initial=0) < 1 << 61 and np.abs(near).max() < 1 << 61:
        off = x - near
        most = (int(np.abs(off).max(initial=0)) + 1) * model.n
        if most**2 * x.shape[1] <= LONG:
            dev = off * model.n - rest
            return dev.astype(np.float64), (dev * dev).sum(axis=1).tolist()
    dev = (x.astype(object) - near.astype(object)) * model.n - rest.astype(object)
    squares = (dev * dev).sum(axis=1).tolist()
    return dev.astype(np.float64), [int(s) if s <= LONG else None for s in squares]


def _scores(x: np.ndarray, model: Fit) -> tuple[np.ndarray, list]:
    dev, squares = _offsets(x, model)
    return (dev / model.n) @ model.components / np.sqrt(model.variance), squares


def _moments(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        k = len(model.variance)
        gram, sums = np.zeros((k, k)), np.zeros(k)
        for batch in _slices(batches):
            scores, _ = _scores(_matrix(batch.column("x")), model)
            gram, sums = gram + scores.T @ scores, sums + scores.sum(axis=0)
        i, j = np.indices((k, k)).reshape(2, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(i, np.full(k, -1)).astype(np.int32)), pa.array(np.append(j, np.arange(k)).astype(np.int32)),
             pa.array(np.append(gram.ravel(), sums))], ["i", "j", "v"])

    return run


def identity_error(listed: DataFrame, model: Fit) -> float | None:
    """Largest absolute entry of the covariance of the whitened vectors of ``listed`` minus the identity, measured by
    a pass over them; None without a component."""
    k = len(model.variance)
    if not k:
        return None
    sent = listed.sparkSession.sparkContext.broadcast(model)
    parts = listed.select("x").mapInArrow(_moments(sent), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    cells = {(r["i"], r["j"]): r["v"] for r in parts.collect()}
    mean = np.array([cells[-1, j] for j in range(k)]) / model.n
    gram = np.array([[cells[i, j] for j in range(k)] for i in range(k)]) / model.n
    return float(np.abs(gram - np.outer(mean, mean) - np.eye(k)).max())


def _whitened(sent, keep: list[str], components: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        k, has = min(components, len(model.sums)), len(model.variance)
        for batch in _slices(batches):
            scores, squares = _scores(_matrix(batch.column("x")), model)
            n = batch.num_rows
            filled = np.zeros((n, k))
            filled[:, :has] = scores
            missing = np.broadcast_to(np.arange(k) >= has, (n, k)).ravel()
            row = pa.array(np.repeat(np.arange(n), k))
            explained = np.zeros(k)
            explained[:has] = model.explained
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f"_keep_{c}").take(row) for c in keep], pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                 pa.array([model.n] * (n * k), pa.int64()), pa.array(squares, pa.int64()).take(row),
                 pa.array(filled.ravel(), mask=missing), pa.array(np.tile(explained, n))],
                [*keep, "component", "n", "deviation", "whitened", "explained"])

    return run


def whiten(rows: DataFrame, vector: str = "embedding", keep: tuple[str, ...] = ("vec_id",), *, components: int = 16) -> DataFrame:
    """Whitened coordinates of every usable vector: ``keep``, component, n, deviation, whitened, explained, identity_error.

    The fit list is each distinct vector once: copies are merged before and after the shuffle, so a vector with a
    third of all rows is one row of it. Component numbers rise as the variance falls; there are as many as
    ``components`` and the dimensions allow. A component whose variance is zero to rounding (as with
    few or equal vectors) has a null ``whitened`` and explains 0. ``deviation`` is null where a long can't hold
    it. Null and repeated keys keep their rows; unusable vectors (see :func:`grid`) give no row; an empty table gives an empty
    result; columns that are not in ``keep`` are not read, and ``keep`` must not name one of the columns made here.
    """
    made = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    if clash := set(keep) & set(made):
        raise ValueError(f"keep names columns of the result: {sorted(clash)}")
    held = grid(rows.select(*[F.col(c).alias(f"_keep_{c}") for c in keep], F.col(vector).alias("_vector")), "_vector")
    listed = cut(held.select("x").distinct())
    model = fit(listed, components)
    kinds = [f"`{c}` {held.schema[i].dataType.simpleString()}" for i, c in enumerate(keep)]
    schema = ", ".join([*kinds, "component int, n long, deviation long, whitened double, explained double"])
    error = F.lit(identity_error(listed, model)).cast("double").alias("identity_error")
    sent = rows.sparkSession.sparkContext.broadcast(model)
    return held.drop("_vector").mapInArrow(_whitened(sent, list(keep), components), schema).select("*", error)

"""Text operators: TF-IDF and topics by non-negative factorization."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from triagelake import SEED
from triagelake.core import cut
from triagelake.operators.metrics import adjusted_rand
from triagelake.operators.partials import ROWS_PER_TASK, spread, sum_over_rows

# Word pattern and vocabulary limits.
WORD = r"[\p{L}\p{N}_]{2,}"
MIN_DOCS, MAX_SHARE, MAX_TERMS = 2, 0.96, 2500
#: Words whose pairs are counted by number; if more of them could be in the vocabulary, all terms are counted as text.
KNOWN_WORDS = 100_000
#: Documents of a step of the counting passes.
STEP_DOCS = 2048


def default_stop_words() -> list[str]:
    return StopWordsRemover.loadDefaultStopWords("english")


def document_words(docs: DataFrame, doc_id: str, text: str, stop_words: Sequence[str]) -> DataFrame:
    """(doc, _w): the words in their order, stop words dropped."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"({WORD})"), F.lit(1))
    kept = F.filter(words, lambda w: ~w.isin(*stop_words)) if stop_words else words
    return docs.select(doc_id, kept.alias("_w"))


def document_terms(docs: DataFrame, doc_id: str, text: str, stop_words: Sequence[str]) -> DataFrame:
    """(doc, terms): single words and pairs of neighbours after stop words are dropped.

    Pairs are made inside the row's own word array, so no window or join is needed.
    """
    n = F.greatest(F.size("_w") - 1, F.lit(0))
    pairs = F.zip_with(
        F.slice("_w", F.lit(1), n), F.slice("_w", F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b))
    return document_words(docs, doc_id, text, stop_words).select(doc_id, F.concat("_w", pairs).alias("terms"))


def vocabulary(
    terms: DataFrame, n_docs: int, *, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, max_terms: int = MAX_TERMS
) -> DataFrame:
    """(term, idf) of the ``max_terms`` most frequent terms in enough, not too many documents.

    Document and total counts are both summed per term with map-side combine, so the shuffle
    carries each task's different terms only, not documents x terms. Ties go by the term.
    """
    counted = lambda column, tf, df: terms.select(F.explode(column).alias("term")).groupBy("term").agg(
        F.sum(F.lit(tf)).alias("tf"), F.sum(F.lit(df)).alias("df"))
    both = counted(F.col("terms"), 1, 0).unionByName(counted(F.array_distinct("terms"), 0, 1))
    stats = both.groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))
    return (
        stats.where((F.col("df") >= min_docs) & (F.col("df") <= max_share * n_docs))
        .orderBy(F.col("tf").desc(), "term").limit(max_terms)
        .select("term", (F.log((1.0 + n_docs) / (1.0 + F.col("df"))) + 1.0).alias("idf"))
    )


def _steps(batches):
    for batch in batches:
        yield from (batch.slice(at, STEP_DOCS) for at in range(0, batch.num_rows, STEP_DOCS))


def _numbers(batch: pa.RecordBatch, known: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Per word of a batch its row, and its number in ``known`` or -1."""
    words = batch.column("_w")
    row = np.repeat(np.arange(batch.num_rows), words.value_lengths().to_numpy(zero_copy_only=False))
    return row, pc.index_in(words.flatten(), value_set=known).fill_null(-1).to_numpy(zero_copy_only=False).astype("int64")


def _pair_keys(row: np.ndarray, no: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and keys (first number x ``size`` + second) of the pairs of neighbours that both have a number."""
    here = np.flatnonzero((row[1:] == row[:-1]) & (no[1:] >= 0) & (no[:-1] >= 0))
    return row[here], no[here] * size + no[here + 1]


def _counts(row: np.ndarray, key: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys (0..``size`` - 1), how often each occurs, and in how many rows."""
    cells, n = np.unique(row * size + key, return_counts=True)
    cells %= size
    order = np.argsort(cells, kind="stable")
    keys, first, df = np.unique(cells[order], return_index=True, return_counts=True)
    return keys, np.add.reduceat(n[order], first) if len(keys) else n, df


def word_counts(words: DataFrame) -> DataFrame:
    """(term, tf, df) of the single words; tasks count whole batches, so a batch's word is one row in the shuffle."""

    def count(batches):
        for part in _steps(batches):
            column = part.column("_w")
            row = np.repeat(np.arange(part.num_rows), column.value_lengths().to_numpy(zero_copy_only=False))
            coded = column.flatten().dictionary_encode()
            keys, tf, df = _counts(row, coded.indices.to_numpy(zero_copy_only=False).astype("int64"), max(1, len(coded.dictionary)))
            yield pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array(keys)), pa.array(tf), pa.array(df)], ["term", "tf", "df"])

    return words.mapInArrow(count, "term string, tf long, df long").groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def frequent_terms(
    words: DataFrame, n_docs: int, *, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, max_terms: int = MAX_TERMS
) -> DataFrame | None:
    """:func:`vocabulary` from (doc, _w), with few pairs counted; None if more than ``KNOWN_WORDS`` words may have a part in it.

    A pair is no more frequent than either of its words. So if ``max_terms`` words are frequent enough by themselves, the least frequent of
    them bounds what any pair in the vocabulary, and each of its words, must reach.
    """
    spark = words.sparkSession
    single = cut(word_counts(words).where(F.col("df") >= min_docs))
    fits = (F.col("df") >= min_docs) & (F.col("df") <= max_share * n_docs)
    top = single.where(fits).orderBy(F.col("tf").desc()).limit(max_terms).agg(F.count(F.lit(1)).alias("n"), F.min("tf").alias("tf")).first()
    least = top["tf"] if top["n"] == max_terms else min_docs
    known = [r[0] for r in single.where(F.col("tf") >= least).select("term").limit(KNOWN_WORDS + 1).collect()]
    if len(known) > KNOWN_WORDS:
        return None
    numbered, size = pa.array(known, pa.string()), max(1, len(known))

    def count(batches):
        for part in _steps(batches):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in _counts(*_pair_keys(*_numbers(part, numbered), size), size * size)], ["key", "tf", "df"])

    pairs = words.mapInArrow(count, "key long, tf long, df long").groupBy("key").agg(
        F.sum("tf").alias("tf"), F.sum("df").alias("df")).where(fits & (F.col("tf") >= least))
    # At most KNOWN_WORDS rows, so the hints are safe.
    names = spark.createDataFrame(list(enumerate(known)), "no long, word string")
    first, second = (F.broadcast(names.select(F.col("no").alias(n), F.col("word").alias(w))) for n, w in (("_a", "_first"), ("_b", "_second")))
    pairs = pairs.select(
        F.expr(f"key div {size}").alias("_a"), (F.col("key") % size).alias("_b"), "tf", "df").join(first, "_a").join(second, "_b")
    both = single.where(fits).select("term", "tf", "df").unionByName(pairs.select(F.concat_ws(" ", "_first", "_second").alias("term"), "tf", "df"))
    return both.orderBy(F.col("tf").desc(), "term").limit(max_terms).select(
        "term", (F.log((1.0 + n_docs) / (1.0 + F.col("df"))) + 1.0).alias("idf"))


def term_counts(words: DataFrame, doc_id: str, terms: Sequence[str]) -> DataFrame:
    """(doc, no, tf) of the ``terms`` (words and pairs, by their place in the list); a document's counts are one row in the shuffle."""
    parts = [t.split(" ") for t in terms]
    known = sorted({w for p in parts for w in p})
    place, size, m = {w: i for i, w in enumerate(known)}, max(1, len(known)), max(1, len(terms))
    single = np.full(size, -1)
    for no, p in enumerate(parts):
        if len(p) == 1:
            single[place[p[0]]] = no
    keyed = sorted((place[p[0]] * size + place[p[1]], no) for no, p in enumerate(parts) if len(p) == 2)
    # A last key that no pair has, so that the list is never empty.
    keys, pair = np.array([*[k for k, _ in keyed], -1 + (1 << 62)], np.int64), np.array([*[no for _, no in keyed], -1])
    numbered = pa.array(known, pa.string())

    def count(batches):
        for part in _steps(batches):
            row, no = _numbers(part, numbered)
            prow, pkey = _pair_keys(row, no, size)
            at = np.searchsorted(keys, pkey)
            found = np.concatenate([np.where(no >= 0, single[no], -1), np.where(keys[at] == pkey, pair[at], -1)])
            rows = np.concatenate([row, prow])
            cells, tf = np.unique(rows[found >= 0] * m + found[found >= 0], return_counts=True)
            rows, first = np.unique(cells // m, return_index=True)
            entries = pa.StructArray.from_arrays([pa.array((cells % m).astype("int32")), pa.array(tf.astype("int64"))], ["no", "tf"])
            listed = pa.ListArray.from_arrays(pa.array(np.append(first, len(cells)).astype("int32")), entries)
            yield pa.RecordBatch.from_arrays([part.column(doc_id).take(pa.array(rows)), listed], [doc_id, "_t"])

    kind = words.schema[doc_id].dataType.simpleString()
    counted = words.mapInArrow(count, f"{doc_id} {kind}, _t array<struct<no:int,tf:bigint>>")
    return counted.repartition(doc_id).select(doc_id, F.inline("_t")).groupBy(doc_id, "no").agg(F.sum("tf").alias("tf"))


def tfidf(
    docs: DataFrame, doc_id: str, text: str, *, stop_words: Sequence[str] | None = None,
    min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, max_terms: int = MAX_TERMS,
) -> DataFrame:
    """(doc, term, weight): (1 + ln tf) x smoothed idf, unit length per document.

    First the vocabulary, then the counts of its terms alone. Texts of a small corpus (few row
    groups) are spread over all cores first; a large one is read where it lies.
    """
    stop = default_stop_words() if stop_words is None else stop_words
    n_docs, cores = docs.count(), docs.sparkSession.sparkContext.defaultParallelism
    if n_docs < cores * ROWS_PER_TASK:
        docs = docs.select(doc_id, text).repartition(cores, doc_id)
    words = document_words(docs, doc_id, text, stop)
    limits = {"min_docs": min_docs, "max_share": max_share, "max_terms": max_terms}
    chosen = frequent_terms(words, n_docs, **limits)
    if chosen is None:
        chosen = vocabulary(document_terms(docs, doc_id, text, stop), n_docs, **limits)
    found = [tuple(r) for r in chosen.collect()]  # at most max_terms
    numbers = docs.sparkSession.createDataFrame([(i, *r) for i, r in enumerate(found)], "no int, term string, idf double")
    counts = term_counts(words, doc_id, [t for t, _ in found]).join(F.broadcast(numbers), "no")
    weighted = counts.select(doc_id, "term", ((1.0 + F.log("tf")) * F.col("idf")).alias("_x"))
    length = F.sqrt(F.sum(F.col("_x") * F.col("_x")).over(Window.partitionBy(doc_id)))
    return weighted.select(doc_id, "term", (F.col("_x") / length).alias("weight"))


def _vectors(docs: DataFrame, weights: DataFrame, doc_id: str) -> tuple[DataFrame, list[str]]:
    """One row per document with its term numbers and weights (maybe none), and the term list."""
    weights = cut(weights)
    terms = sorted(r[0] for r in weights.select("term").distinct().collect())  # at most max_terms
    spark = weights.sparkSession
    numbers = spark.createDataFrame([(t, i) for i, t in enumerate(terms)], "term string, no int")
    found = weights.join(F.broadcast(numbers), "term").groupBy(doc_id).agg(
        F.collect_list(F.struct("no", "weight")).alias("v"))
    rows = docs.select(doc_id).join(found, doc_id, "left")
    filled = rows.select(
        doc_id, F.coalesce("v.no", F.array().cast("array<int>")).alias("no"),
        F.coalesce("v.weight", F.array().cast("array<double>")).alias("x"))
    return spread(filled, docs.count(), doc_id), terms


class Batch:
    """Sparse documents x terms matrix of one batch."""

    def __init__(self, batch: pa.RecordBatch, size: int):
        no, x = batch.column("no"), batch.column("x")
        self.docs, self.size = batch.num_rows, size
        self.doc = np.repeat(np.arange(self.docs), no.value_lengths().to_numpy(zero_copy_only=False))
        self.no, self.x = no.flatten().to_numpy(), x.flatten().to_numpy()

    def times(self, right: np.ndarray) -> np.ndarray:
        """X @ right."""
        return np.stack([np.bincount(self.doc, self.x * c[self.no], self.docs) for c in right.T], axis=1)

    def back(self, left: np.ndarray) -> np.ndarray:
        """X' @ left."""
        return np.stack([np.bincount(self.no, self.x * c[self.doc], self.size) for c in left.T], axis=1)


def _start_topics(rows: DataFrame, size: int, n_docs: int, ks: Sequence[int], seeds: Sequence[int]) -> dict:
    """Starting topics per seed from the leading singular vectors, zeros filled with the mean.

    Subspace iteration: each pass sends terms x k numbers to the tasks and gets as many back.
    """
    top = max(ks)
    width = min(top + 10, size)
    basis = {str(s): np.linalg.qr(np.random.default_rng(s).normal(size=(size, width)))[0] for s in seeds}
    for _ in range(6):
        now = basis
        image = sum_over_rows(rows.select("no", "x"), lambda batch: {
            s: (lambda m: m.back(m.times(b)))(Batch(batch, size)) for s, b in now.items()})
        basis = {s: np.linalg.qr(image[s].reshape(size, width))[0] for s in now}
    now = basis

    def gram(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        m = Batch(batch, size)
        images = {s: m.times(b) for s, b in now.items()}
        out = {s: y.T @ y for s, y in images.items()}
        out["sum"] = np.array([m.x.sum()])
        return out

    small = sum_over_rows(rows.select("no", "x"), gram)
    vectors, values = {}, {}
    for s, b in basis.items():
        e, q = np.linalg.eigh(small[s].reshape(width, width))
        vectors[s] = (b @ q[:, ::-1])[:, :top]
        values[s] = np.sqrt(np.maximum(e[::-1][:top], 1e-30))
    sides = sum_over_rows(rows.select("no", "x"), lambda batch: {
        s: (lambda u: np.array([(np.maximum(u, 0) ** 2).sum(0), (np.maximum(-u, 0) ** 2).sum(0)]))(Batch(batch, size).times(v))
        for s, v in vectors.items()})
    mean = float(small["sum"][0]) / (n_docs * size)
    start = {}
    for s in vectors:
        up, down = np.sqrt(sides[s].reshape(2, top)) / values[s]
        h = np.zeros((top, size))
        for j in range(top):
            v = vectors[s][:, j]
            plus, minus = np.maximum(v, 0), np.maximum(-v, 0)
            a, b = up[j] * np.linalg.norm(plus), down[j] * np.linalg.norm(minus)
            side, strength = (plus, a) if a >= b else (minus, b)
            h[j] = np.sqrt(values[s][j] * strength) * side / max(np.linalg.norm(side), 1e-30)
        h[h < 1e-6] = mean
        start[s] = h
    return start


INNER_STEPS = 40
TINY = 1e-12


def document_weights(x: Batch, h: np.ndarray) -> np.ndarray:
    """Non-negative topic weights of a batch of documents for fixed topics."""
    xh, hh = x.times(h.T), h @ h.T
    w = np.maximum(xh, TINY) / max(float(np.trace(hh)), TINY)
    for _ in range(INNER_STEPS):
        w = w * xh / np.maximum(w @ hh, TINY)
    return w


def nmf_fit(
    rows: DataFrame, size: int, fits: dict[str, tuple[int, int]], *, max_rounds: int = 500, tol: float = 1e-4
) -> tuple[dict[str, np.ndarray], dict[str, list[float]]]:
    """Topics (k x terms) of several fits at once, and their losses by round.

    ``fits`` maps a name to (k, seed). One job per round serves all fits that still move:
    documents get their weights for the current topics inside the task, and only W'X and W'W
    come back, from which the topics are updated. No per-document state is kept.
    """
    n = rows.count()
    start = _start_topics(rows, size, n, [k for k, _ in fits.values()], sorted({s for _, s in fits.values()}))
    topics = {name: start[str(seed)][:k].copy() for name, (k, seed) in fits.items()}
    losses: dict[str, list[float]] = {name: [] for name in fits}
    moving = set(fits)
    for _ in range(max_rounds):
        now = {name: topics[name] for name in sorted(moving)}

        def partial(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
            x = Batch(batch, size)
            out = {}
            for name, h in now.items():
                w = document_weights(x, h)
                wx, ww = x.back(w).T, w.T @ w
                loss = (x.x * x.x).sum() - 2 * (wx * h).sum() + (ww * (h @ h.T)).sum()
                out[name] = np.concatenate([wx.ravel(), ww.ravel(), [loss]])
            return out

        sums = sum_over_rows(rows.select("no", "x"), partial)
        for name, h in now.items():
            k = len(h)
            flat = sums[name]
            wx, ww = flat[: k * size].reshape(k, size), flat[k * size : k * size + k * k].reshape(k, k)
            loss = max(float(flat[-1]), 0.0) ** 0.5
            past = losses[name]
            past.append(loss)
            if len(past) > 1 and past[-2] - loss <= tol * past[0]:
                moving.discard(name)
                continue
            for _ in range(INNER_STEPS):
                h = h * wx / np.maximum(ww @ h, TINY)
            topics[name] = h
        if not moving:
            break
    else:
        warnings.warn(f"topic fits {sorted(moving)} still moved after {max_rounds} rounds", RuntimeWarning, stacklevel=2)
    return topics, losses


def nmf_weights(rows: DataFrame, doc_id: str, size: int, topics: np.ndarray) -> DataFrame:
    """(doc, weights, label): label is the first largest weight."""

    def assign(batches):
        for batch in batches:
            w = document_weights(Batch(batch, size), topics)
            yield pa.RecordBatch.from_pydict({
                doc_id: batch.column(doc_id), "weights": pa.array(list(w), pa.list_(pa.float64())),
                "label": pa.array(w.argmax(axis=1), pa.int32())})

    kind = rows.schema[doc_id].dataType.simpleString()
    return rows.mapInArrow(assign, f"{doc_id} {kind}, weights array<double>, label int")


def nmf_topics(
    docs: DataFrame, doc_id: str, text: str, *, k: int = 6, seed: int = SEED, top_terms: int = 8,
    sensitivity: Sequence[int] = (5, 6, 7), stop_words: Sequence[str] | None = None, max_rounds: int = 500,
) -> dict[str, DataFrame]:
    """Topic model with its stability.

    Returns tables: ``weights`` (doc, weights, label), ``terms`` (topic, rank, term) and
    ``stability`` (comparison, ari): seed against seed + 1, and neighbouring topic numbers.
    """
    spark = docs.sparkSession
    rows, terms = _vectors(docs, tfidf(docs, doc_id, text, stop_words=stop_words), doc_id)
    size = len(terms)
    ks = sorted({*sensitivity, k})
    fits = {f"k{c}": (c, seed) for c in ks} | {"other": (k, seed + 1)}
    topics, _ = nmf_fit(rows, size, fits, max_rounds=max_rounds)
    weights = nmf_weights(rows, doc_id, size, topics[f"k{k}"])
    ranked = []
    for t, row in enumerate(topics[f"k{k}"]):
        best = sorted(range(size), key=lambda i: (-row[i], terms[i]))[:top_terms]
        ranked += [(t, place, terms[i]) for place, i in enumerate(best, start=1)]
    term_table = spark.createDataFrame(ranked, "topic int, rank int, term string")

    def labels(batches):
        for batch in batches:
            x = Batch(batch, size)
            found = {name: pa.array(document_weights(x, h).argmax(axis=1), pa.int32()) for name, h in topics.items()}
            yield pa.RecordBatch.from_pydict({doc_id: batch.column(doc_id), **found})

    kind = rows.schema[doc_id].dataType.simpleString()
    wide = cut(rows.mapInArrow(labels, f"{doc_id} {kind}, " + ", ".join(f"{n} int" for n in topics)))
    ordered = sorted(sensitivity)
    compare = [("seed", f"k{k}", "other")] + [
        (f"{a}_vs_{b}", f"k{a}", f"k{b}") for a, b in zip(ordered[:-1], ordered[1:])]
    pairs = wide.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("comparison"), F.col(a).alias("a"), F.col(b).alias("b")) for n, a, b in compare])))
    return {"weights": weights, "terms": term_table, "stability": adjusted_rand(pairs, ["comparison"], "a", "b")}

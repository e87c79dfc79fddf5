"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from triagelake.llm.common import concat_ranges, pieces
from triagelake.llm.langid import fold

TERM = re.compile(r"[^\W\d_]+")
#: Marks cut off both ends of a word before it is looked up.
MARKS = ".,;:!?\"'()[]{}<>*-_/|#&"
#: Bytes of text that a task works on together.
PIECE = 2_000_000
#: Besides whole words, their first letters are terms (written with a *), so inflected forms meet.
STEMS = (4, 5)


def terms_of(text: str) -> Iterator[str]:
    for word in TERM.findall(text.lower()):
        yield word
        for n in STEMS:
            if len(word) > n:
                yield word[:n] + "*"


#: Blocks a search opens before it compares the others' bounds with what it has found.
FIRST_BLOCKS = 4


@dataclass
class BlockMaxIndex:
    """Postings of unit vectors by term, in blocks of neighbouring examples with their largest weights.

    Postings lie in order of (term, example); two small tables of terms x blocks hold where a term's postings of a block
    begin and the largest of their weights (rounded up to single precision).
    """

    n: int
    blocks: int
    start: np.ndarray = field(repr=False)  # (terms, blocks + 1)
    most: np.ndarray = field(repr=False)  # (terms, blocks)
    example: np.ndarray = field(repr=False)
    weight: np.ndarray = field(repr=False)

    @classmethod
    def build(cls, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int, block: int = 128) -> BlockMaxIndex:
        """``vectors``: (terms, weights) of each example, terms distinct."""
        n, blocks = len(vectors), max(1, -(-len(vectors) // block))
        example = np.repeat(np.arange(n, dtype=np.int64), [len(t) for t, _ in vectors]) if n else np.zeros(0, np.int64)
        term = np.concatenate([t for t, _ in vectors]).astype(np.int64) if n else np.zeros(0, np.int64)
        weight = np.concatenate([w for _, w in vectors]) if n else np.zeros(0)
        order = np.lexsort((example, term))
        term, example, weight = term[order], example[order], weight[order]
        cell = term * blocks + example // block
        start = np.searchsorted(cell, np.arange(n_terms * blocks + 1)).astype(np.int32)
        start = np.hstack([start[:-1].reshape(n_terms, blocks), start[blocks::blocks, None]]) if n_terms else np.zeros((0, blocks + 1), np.int32)
        most = np.zeros(n_terms * blocks, np.float32)
        cells, first = np.unique(cell, return_index=True)
        if len(cells):
            most[cells] = np.nextafter(np.maximum.reduceat(weight, first).astype(np.float32), np.float32(np.inf))
        return cls(n, blocks, start, most.reshape(n_terms, blocks), example, weight)

    def top(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` examples with the largest positive dot products; ties go to the lower number.

        The blocks of the highest upper bounds are opened first; of the others only those whose bound reaches the
        k-th best so far, so no closed block can hold a better one.
        """
        bound = weights @ self.most[terms]
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        lead = max(FIRST_BLOCKS, -(-k * self.blocks // max(1, self.n)))
        found, scores = self._open(order[:lead], terms, weights, k)
        rest = order[lead:]
        if len(scores) == k:
            rest = rest[bound[rest] * (1 + 1e-9) >= scores[-1]]
        if len(rest):
            more, more_scores = self._open(rest, terms, weights, k)
            found, scores = np.concatenate([found, more]), np.concatenate([scores, more_scores])
            best = np.lexsort((found, -scores))[:k]
            found, scores = found[best], scores[best]
        return found, scores

    def _open(self, opened: np.ndarray, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The best ``k`` of the opened blocks; products are added term by term, so equal vectors get equal sums."""
        opened = np.sort(opened)
        # Neighbouring open blocks are one range of postings.
        first = opened[np.diff(opened, prepend=-2) > 1]
        last = opened[np.diff(opened, append=self.blocks + 1) > 1] + 1
        start, stop = self.start[terms[:, None], first].ravel(), self.start[terms[:, None], last].ravel()
        size = stop - start
        used = np.flatnonzero(size)
        start, size = start[used], size[used]
        at = np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)
        total = np.bincount(self.example[at], np.repeat(weights[used // len(first)], size) * self.weight[at], minlength=self.n)
        hit = np.flatnonzero(total > 0)
        if len(hit) > k:
            hit = hit[total[hit] >= np.partition(total[hit], -k)[-k]]
        best = hit[np.lexsort((hit, -total[hit]))[:k]]
        return best, total[best]


@dataclass
class Model:
    terms: list[str]
    idf: np.ndarray
    index: BlockMaxIndex
    example_ids: list
    toxic: np.ndarray
    weight: np.ndarray
    prior: float
    word: np.ndarray  # log odds of each term's own vote, less those of the prior
    coefficients: np.ndarray
    nothing: float  # score of a text that shares no term with any example
    k: int
    doubt: float


def vocabulary_of(forms: pa.StringArray, known: pa.StringArray, place: dict[str, int] | None = None) -> tuple[np.ndarray, dict[int, list[int]]]:
    """Numbers in ``known`` of the word and the stems of each form between white space (-1: none), one row
    for each kind of term; and those of forms that are not one plain word. ``place`` is ``known`` as a mapping of
    whole words alone: with it no stems are looked for."""
    low = pc.utf8_lower(forms)
    bare = pc.utf8_trim(low, MARKS)
    plain = pc.match_substring_regex(bare, r"^\p{L}*$").to_numpy(zero_copy_only=False).astype(bool)
    size = pc.utf8_length(bare).to_numpy(zero_copy_only=False)
    find = lambda x: pc.fill_null(pc.index_in(x, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    number = np.stack([find(bare)] + [] if place is not None else [find(bare)] + [
        np.where(size > n, find(pc.binary_join_element_wise(pc.utf8_slice_codeunits(bare, 0, n), "*", "")), -1) for n in STEMS])
    odd = np.flatnonzero(~plain)
    number[:, odd] = -1
    find_terms = terms_of if place is None else TERM.findall
    if place is None:
        place = {t: i for i, t in enumerate(known.to_pylist())} if len(odd) else {}
    several = {}
    for i, form in zip(odd.tolist(), low.take(pa.array(odd)).to_pylist(), strict=True):
        hits = [place[t] for t in find_terms(form) if t in place]
        if hits:
            several[i] = hits
    return number, several


def counted(text: pa.StringArray, known: pa.StringArray, place: dict[str, int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, term number, occurrences) of the known terms in the texts, ordered by both."""
    split = pc.ascii_split_whitespace(text)
    doc = np.repeat(np.arange(len(text)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
    coded = split.flatten().dictionary_encode()
    which = coded.indices.to_numpy(zero_copy_only=False)
    number, several = vocabulary_of(coded.dictionary, known, place)
    docs, terms = [], []
    for row in number:
        if (row >= 0).any():
            one = row[which]
            hit = one >= 0
            docs.append(doc[hit])
            terms.append(one[hit])
    if several:
        special = np.zeros(number.shape[1], bool)
        special[list(several)] = True
        sizes, flat = np.zeros(number.shape[1], np.int64), np.array([t for hits in several.values() for t in hits], np.int64)
        sizes[list(several)] = [len(hits) for hits in several.values()]
        starts = np.zeros(number.shape[1], np.int64)
        starts[list(several)] = np.cumsum(sizes[list(several)]) - sizes[list(several)]
        at = np.flatnonzero(special[which])
        docs.append(np.repeat(doc[at], sizes[which[at]]))
        terms.append(flat[concat_ranges(starts[which[at]], sizes[which[at]])])
    width = max(1, len(known))
    cell, n = np.unique(np.concatenate([np.zeros(0, np.int64), *docs]) * width + np.concatenate([np.zeros(0, np.int64), *terms]), return_counts=True)
    return cell // width, cell % width, n


def _places(terms: list[str]) -> tuple[pa.StringArray, dict[str, int]]:
    return pa.array(terms, pa.string()), {t: i for i, t in enumerate(terms)}


def _term_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, limit=PIECE):
        found = [Counter(TERM.findall(text.lower())) for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([list(c) for c in found], pa.list_(pa.string())),
             pa.array([list(c.values()) for c in found], pa.list_(pa.int64()))], ["doc_id", "terms", "n"])


def _document_counts(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, place = _places(sent.value)
        df, rows = np.zeros(len(known), np.int64), 0
        for batch in pieces(batches, limit=PIECE):
            _, terms, _ = counted(batch.column("text"), known, place)
            df += np.bincount(terms, minlength=len(df))
            rows += batch.num_rows
        met = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(-1, met)), pa.array(np.append(rows, df[met]))], ["number", "n"])

    return run


def weigh(n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF weights with a logarithm on the counts."""
    return (1.0 + np.log(n)) * idf


def unit(weights: np.ndarray) -> np.ndarray:
    return weights / np.sqrt((weights * weights).sum()) if len(weights) else weights


def vote(model: Model, terms: np.ndarray, weights: np.ndarray) -> tuple[float, np.ndarray]:
    """Similarity-weighted share of toxic examples among the nearest, drawn to the prior by ``doubt``; and those examples.

    The votes are weighed by the cosine as a part of the best one. So the length of the text's own vector, in which
    terms of no example have a part, cancels out; it does not change the order either.
    """
    found, scores = model.index.top(terms, weights, model.k)
    pull = scores / scores[0] * model.weight[found] if len(scores) else scores
    share = ((pull * model.toxic[found]).sum() + model.doubt * model.prior) / (pull.sum() + model.doubt)
    return float(share), found


#: Numbers of :func:`signs`.
SIGNS = 8


def signs(model: Model, terms: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the calibration sees of a text, and the examples that voted.

    The vote on the whole text; the three strongest votes on single words, their rising and falling parts; the
    number of terms; a constant. The vote on a word is that of the text "word" alone: all examples that have it vote,
    by its weight in them, which is their cosine to it.
    """
    share, found = vote(model, terms, weigh(n, model.idf[terms]))
    words = model.word[terms]
    strongest = np.sort(np.append(words, [0.0, 0.0, 0.0]))[:-4:-1]
    root = np.sqrt(max(1, len(words)))
    return np.array([logit(share) - logit(model.prior), *strongest, np.maximum(words, 0).sum() / root, np.minimum(words, 0).sum() / root,
                     np.log1p(len(terms)), 1.0]), found


def calibrate(x: np.ndarray, y: np.ndarray, w: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Weighted ridge-logistic fit of y on the rows of x, the last a constant, with slightly shrunk targets (Platt)."""
    pos, neg = (w * y).sum(), (w * (1 - y)).sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    beta = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], 0.1)
    start = beta.copy()
    for _ in range(rounds):
        p = chance(x @ beta)
        grad = x.T @ (w * (target - p)) - ridge * (beta - start)
        step = np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + np.diag(ridge), grad)
        beta = beta + step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return beta


def chance(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def logit(p):
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def fit(
    docs: DataFrame, labels: DataFrame, *, fit_rows: int = 20_000, examples: int = 2_048, k: int = 32, doubt: float = 2.0,
    word_doubt: float = 0.2, seed: str = "toxicity",
) -> Model:
    """Learns from ``labels`` (doc_id, toxic); rows without id or label are left out. Ids may have any type.

    The bounded sample: of each label at most ``fit_rows`` documents, those with the lowest seeded hashes
    of their ids, distinct in text. The first ``examples`` of each label (at most half of them) fill the index with all their terms, the others
    calibrate the votes. Terms are whole words: inflected forms and their stems fill an index three times as large and find no more. Document frequencies for the TF-IDF weights are counted over all ``docs``. A label that fills more documents than
    the sample keeps its weight: its examples count for as many documents as they stand for.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast(kind).alias("doc_id")).agg((F.max("toxic") > 0).alias("toxic"))
    known = known.withColumn("_h", F.xxhash64(F.lit(seed), "doc_id"))
    totals = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    lowest = [known.where(F.col("toxic") == label).orderBy("_h", "doc_id").limit(fit_rows) for label in (True, False)]
    picked = spark.createDataFrame([tuple(r) for part in lowest for r in part.collect()] or [(None, None, None)], f"doc_id {kind}, toxic boolean, _h long")
    texts = rows.join(F.broadcast(picked), "doc_id")  # at most 2 * fit_rows ids
    hashes = texts.select("toxic", "_h", "doc_id", F.xxhash64("text").alias("_t"), F.length("text").alias("_n"))
    single = hashes.groupBy("_t", "_n", "toxic").agg(F.min(F.struct("_h", "doc_id")).alias("x")).select("x._h", "x.doc_id", "toxic")
    split: dict[bool, list] = {True: [], False: []}
    for row in sorted({(r["_h"], r["doc_id"]): r for r in single.collect()}.values(), key=lambda r: (r["_h"], r["doc_id"])):
        split[row["toxic"]].append(row["doc_id"])
    # Half of a small sample is kept to calibrate.
    cut = {label: min(examples, (len(own) + 1) // 2) for label, own in split.items()}
    inside = {i: label for label, own in split.items() for i in own[: cut[label]]}
    outside = {i: label for label, own in split.items() for i in own[cut[label] :]}
    drawn = lambda ids: rows.join(F.broadcast(spark.createDataFrame(
        [(i, y) for i, y in ids.items()] or [(None, None)], f"doc_id {kind}, toxic boolean")), "doc_id")
    one_text = drawn(inside).groupBy("doc_id").agg(F.min("text").alias("text"))  # repeated ids: one text
    lists = one_text.mapInArrow(_term_lists, f"doc_id {kind}, terms array<string>, n array<long>").toArrow().combine_chunks()
    ids, sizes = lists.column("doc_id").to_pylist(), pc.list_value_length(lists.column("terms")).to_numpy().astype(np.int64)
    coded = pc.list_flatten(lists.column("terms")).combine_chunks().dictionary_encode()
    sorted_terms = pc.sort_indices(coded.dictionary).to_numpy()
    number = np.empty(len(sorted_terms), np.int64)
    number[sorted_terms] = np.arange(len(sorted_terms))
    flat, counts = number[coded.indices.to_numpy()], pc.list_flatten(lists.column("n")).to_numpy()
    terms = coded.dictionary.take(pa.array(sorted_terms)).to_pylist()
    ends = np.cumsum(sizes)
    del lists, coded
    sent = spark.sparkContext.broadcast(terms)  # the distinct terms of at most 2 * examples texts
    met = rows.select("text").mapInArrow(_document_counts(sent), "number long, n long").groupBy("number").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(len(terms) + 1)
    df[met.column("number").to_numpy()] = met.column("n").to_numpy()  # the last is the number of documents
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1
    held = []
    for i, size, end in zip(ids, sizes.tolist(), ends.tolist(), strict=True):
        own, n = flat[end - size : end], counts[end - size : end]
        order = np.argsort(own)
        own, n = own[order], n[order]
        common = own[np.lexsort((own, -n))][:3]  # texts of like frequent words share blocks
        held.append((tuple(common.tolist()), str(i), i, own, unit(weigh(n, idf[own]))))
    held.sort(key=lambda x: x[:2])
    toxic = np.array([float(inside[x[2]]) for x in held])
    prior = (totals.get(True, 0) + 1) / (totals.get(True, 0) + totals.get(False, 0) + 2)
    per = {label: totals.get(label, 0) / max(1, cut[label]) for label in split}
    scale = max(per.values()) or 1.0
    weight = np.array([per[inside[x[2]]] / scale for x in held])
    index = BlockMaxIndex.build([(x[3], x[4]) for x in held], len(terms))
    pull = index.weight * weight[index.example]
    at = np.repeat(np.arange(len(terms)), index.start[:, -1] - index.start[:, 0])
    small = min(per.values(), default=1) / scale
    yes = np.bincount(at, pull * toxic[index.example], minlength=len(terms)) + word_doubt * small * prior
    word = logit(yes / (np.bincount(at, pull, minlength=len(terms)) + word_doubt * small)) - logit(prior)
    start = np.zeros(SIGNS)
    start[0], start[-1] = 1.0, logit(prior)
    model = Model(terms, idf, index, [x[2] for x in held], toxic, weight, prior, word, start, prior, k, doubt * small)
    seen = drawn(outside).mapInArrow(_sample_signs(spark.sparkContext.broadcast(model)), "toxic boolean, terms long, signs array<double>").toPandas()
    if len(seen):
        y = seen["toxic"].to_numpy(float)
        w = np.array([totals.get(bool(v), 0) / max(1, len(split[bool(v)]) - cut[bool(v)]) for v in y])
        blank = seen["terms"].to_numpy() == 0
        model.nothing = float(((w * y)[blank].sum() + prior) / (w[blank].sum() + 1))
        if (~blank).any():
            order = np.lexsort(np.stack(seen["signs"].to_numpy()[~blank]).T)  # whatever the order of tasks
            x, y, w = np.stack(seen["signs"].to_numpy()[~blank])[order], y[~blank][order], w[~blank][order]
            model.coefficients = calibrate(x, y, w / w.mean())
    return model


def _texts(batch: pa.RecordBatch, known: pa.Array, place: dict[str, int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(terms, counts) of the known terms of each text."""
    docs, terms, n = counted(batch.column("text"), known, place)
    at = np.searchsorted(docs, np.arange(batch.num_rows + 1))
    for i in range(batch.num_rows):
        yield terms[at[i] : at[i + 1]], n[at[i] : at[i + 1]]


def _sample_signs(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        known, place = _places(model.terms)
        for batch in pieces(batches, limit=PIECE):
            found = [(len(t), signs(model, t, n)[0]) for t, n in _texts(batch, known, place)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array([m for m, _ in found], pa.int64()), pa.array([x for _, x in found], pa.list_(pa.float64()))],
                ["toxic", "terms", "signs"])

    return run


def _scores(sent, key: str, kind):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        (known, place), ids = _places(model.terms), pa.array(model.example_ids, kind)
        for batch in pieces(batches, limit=PIECE):
            score, sizes, near = np.full(batch.num_rows, model.nothing), np.zeros(batch.num_rows + 1, np.int32), [np.zeros(0, np.int64)]
            for i, (terms, n) in enumerate(_texts(batch, known, place)):
                if len(terms):
                    x, found = signs(model, terms, n)
                    score[i] = chance(x @ model.coefficients)
                    near.append(found)
                    sizes[i + 1] = len(found)
            evidence = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes, dtype=np.int32)), ids.take(pa.array(np.concatenate(near))))
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(score), evidence], [key, "score", "evidence"])

    return run


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, evidence): calibrated score of every whole text and the ids of the examples that voted.

    Null texts are empty; a text that shares no term with any example gets the score of such texts in the sample. Null keys
    and repeated rows keep their rows; an empty table gives an empty result; other columns are not read.
    The model is bounded by the texts that the arguments of :func:`fit` admit, and is broadcast. ``key`` has the type of the ids learned from.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(key).alias(key), F.col(text).cast("string").alias("text"))
    kind = rows.schema[0].dataType
    return rows.mapInArrow(
        _scores(sent, key, to_arrow_type(kind)), f"`{key}` {kind.simpleString()}, score double, evidence array<{kind.simpleString()}>")


def classify(docs: DataFrame, labels: DataFrame, *, parts: int = 5, held_out: int = 0, **options) -> DataFrame:
    """Learns outside the held-out fold of ids and scores all: doc_id, held_out, score, predicted, evidence."""
    model = fit(docs, labels.where(fold("doc_id", parts) != held_out).select("doc_id", "toxic"), **options)
    return score(docs, model).select(
        "doc_id", F.coalesce(fold("doc_id", parts) == held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")

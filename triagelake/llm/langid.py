"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagelake.llm.common import pieces, utf8

ORDERS = (1, 2, 3)
UNKNOWN = "und"
#: Bytes of text that a task works on together, and bytes whose n-grams are made at once.
PIECE, CHUNK = 1_000_000, 1 << 17
#: Numbers gathered from the model at once.
GATHERED = 1 << 20


@dataclass(frozen=True)
class Model:
    """Log probabilities (orders x buckets, languages) and log priors; ``languages`` in code point order."""

    languages: list[str]
    log_prob: np.ndarray
    log_prior: np.ndarray
    buckets: int


def gram_chunks(text: pa.StringArray, buckets: int, most: int = CHUNK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(order number, text number, slot) of the n-grams of all lower-cased texts, at most ``most`` at a time.

    Bytes are decoded in windows that reach a few characters into the next one, so a long text takes no more
    memory beyond its bytes than a short one.
    """
    data, offsets = utf8(pc.utf8_lower(text))
    raw = np.frombuffer(data, np.uint8)
    low, beyond = 0, 4 * max(ORDERS)
    while low < len(raw):
        high = _lead(raw, min(low + most, len(raw)))
        window = raw[low : _lead(raw, min(high + beyond, len(raw)))]
        codes = np.frombuffer(window.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        lead = np.flatnonzero((window & 0xC0) != 0x80) + low
        owner = np.searchsorted(offsets, lead, side="right") - 1
        here = int(np.searchsorted(lead, high))  # n-grams that begin in this window
        mixed = np.zeros(len(codes), np.uint32)
        for n, order in enumerate(ORDERS):
            mixed = mixed[: len(codes) - order + 1] * np.uint32(0x01000193) if order > 1 else mixed
            mixed = mixed ^ (codes[order - 1 :] * np.uint32(0x9E3779B1))
            slots = ((mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x85EBCA6B) >> np.uint32(12)) % np.uint32(buckets)
            first = owner[: min(here, len(slots))]
            inside = first == owner[order - 1 : order - 1 + len(first)]  # none runs into the next text
            yield n, first[inside], slots[: len(first)][inside] + np.uint32(n * buckets)
        low = high


def _lead(raw: np.ndarray, at: int) -> int:
    """The first byte from ``at`` on that begins a character."""
    while at < len(raw) and raw[at] & 0xC0 == 0x80:
        at += 1
    return at


def gram_slots(text: pa.StringArray, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram order the slots of the n-grams of all lower-cased texts, and the number in each text."""
    found = list(gram_chunks(text, buckets))
    for n in range(len(ORDERS)):
        owners, slots = (np.concatenate([np.zeros(0, np.int64), *[x[i] for x in found if x[0] == n]]) for i in (1, 2))
        yield slots.astype(np.int64), np.bincount(owners.astype(np.int64), minlength=len(text))


def _counts(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        width = len(ORDERS) * buckets
        for batch in pieces(batches, limit=PIECE):
            langs = batch.column("lang").dictionary_encode()
            which = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            for i, name in enumerate(langs.dictionary.to_pylist()):
                docs[name] = docs.get(name, 0) + int((which == i).sum())
                held = total.setdefault(name, np.zeros(width, np.int64))
                for _, _, slots in gram_chunks(batch.column("text").filter(pa.array(which == i)), buckets):
                    np.add.at(held, slots, 1)
        for name, found in total.items():
            slots = np.flatnonzero(found)
            n = len(slots) + 1  # slot -1 counts documents
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * n), pa.array(np.append(slots, -1)), pa.array(np.append(found[slots], docs[name]))], ["lang", "slot", "n"])

    return run


def fit(
    rows: DataFrame, text: str = "text", lang: str = "lang", *, buckets: int = 1 << 14, alpha: float = 0.5, most_languages: int = 500,
) -> Model:
    """Counts of all rows with a text and a language; len(ORDERS) * buckets numbers per language reach the driver.

    Tasks add up their own slices first, so the shuffle holds one row per task, language and slot. A column with more than
    ``most_languages`` values is no column of languages: it is refused, since model and tasks grow with their number.
    """
    known = rows.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    names = known.select("lang").distinct().limit(most_languages + 1).count()
    if names > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    counted = known.mapInArrow(_counts(buckets), "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    table = counted.toPandas()
    languages = sorted(table["lang"].unique())
    width = len(ORDERS) * buckets
    counts = np.zeros((width + 1, len(languages)))
    place = {name: i for i, name in enumerate(languages)}
    counts[table["slot"].to_numpy(np.int64), table["lang"].map(place).to_numpy(np.int64)] = table["n"]
    docs, counts = counts[-1], counts[:-1]
    smooth = counts + alpha
    per_order = smooth.reshape(len(ORDERS), buckets, len(languages))
    log_prob = np.log(per_order / per_order.sum(axis=1, keepdims=True)).reshape(width, len(languages)).astype(np.float32)
    return Model(languages, log_prob, np.log(docs / docs.sum()) if len(docs) else docs, buckets)


def _text_sums(text: pa.StringArray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the log probabilities of each text's n-grams by language, and the number of its n-grams."""
    width = len(model.languages)
    sums, grams = np.zeros((len(text), width)), np.zeros(len(text), np.int64)
    step = max(1, GATHERED // max(1, width))
    for _, owner, slots in gram_chunks(text, model.buckets):
        grams += np.bincount(owner, minlength=len(text))
        for at in range(0, len(slots) if width else 0, step):
            own, some = owner[at : at + step], slots[at : at + step]
            starts = np.flatnonzero(np.diff(own, prepend=-1))  # the n-grams of a text lie together
            sums[own[starts]] += np.add.reduceat(model.log_prob[some], starts, axis=0, dtype=np.float64)
    return sums, grams


def _predictions(sent, keep: list[str], text: str, weight_of: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for whole in batches:
            at = 0
            for batch in pieces(iter([whole]), text, PIECE):
                n = batch.num_rows
                given, at = whole.slice(at, n), at + n  # with its null texts
                sums, grams = _text_sums(batch.column(text), own)
                names, scores = np.full(n, UNKNOWN, object), np.zeros(n)
                lettered = batch.column("_lettered").to_numpy(zero_copy_only=False).astype(bool) & (len(own.languages) > 0)
                if lettered.any():
                    held = sums[lettered]
                    best = (held + own.log_prior).argmax(axis=1)
                    # n-grams of a text are not independent: they count as weight_of at most.
                    tempered = held * np.minimum(1.0, weight_of / np.maximum(grams[lettered], 1))[:, None] + own.log_prior
                    odds = np.exp(tempered - tempered.max(axis=1, keepdims=True))
                    names[lettered] = np.array(own.languages, object)[best]
                    scores[lettered] = odds[np.arange(len(best)), best] / odds.sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*[given.column(f"_keep_{c}") for c in keep], pa.array(names, pa.string()), pa.array(scores)], [*keep, "lang_pred", "score"])

    return run


def predict(docs: DataFrame, model: Model, keep: Sequence[str] = ("doc_id",), text: str = "text", *, weight_of: int = 100) -> DataFrame:
    """The ``keep`` columns, lang_pred and score for every whole text; ``und`` and 0 for texts that are null or
    have no letter.

    The model is broadcast: its size is set by ``buckets`` and the number of languages. Null keys and
    repeated rows keep their rows; a model without languages answers ``und``; an empty table gives an empty
    result; other columns are not read; ``keep`` must not name a column of the result. Tasks work on PIECE bytes at a time, and on
    windows of a longer text; a text that is kept is sent to them once.
    """
    if clash := {"lang_pred", "score"} & set(keep):
        raise ValueError(f"keep names columns of the result: {sorted(clash)}")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    value = F.col(text).cast("string")
    shared = text in keep and dict(docs.dtypes)[text] == "string"
    rows = docs.select(
        *[F.col(c).alias(f"_keep_{c}") for c in keep], *([] if shared else [value.alias("_text")]),
        F.coalesce(value.rlike(r"\p{L}"), F.lit(False)).alias("_lettered"))
    kinds = [f"`{c}` {rows.schema[i].dataType.simpleString()}" for i, c in enumerate(keep)]
    return rows.mapInArrow(
        _predictions(sent, list(keep), f"_keep_{text}" if shared else "_text", weight_of), ", ".join([*kinds, "lang_pred string", "score double"]))


def fold(key: str, parts: int):
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(F.col(key).cast("string")) % parts


def identify(docs: DataFrame, *, parts: int = 3, held_out: int = 1) -> DataFrame:
    """Learns from documents outside the held-out fold and predicts all: doc_id, held_out, lang_pred, score.

    A null id belongs to no fold: it is not learned from and not held out.
    """
    rows = docs.select("doc_id", "text", "lang")
    model = fit(rows.where(fold("doc_id", parts) != held_out))
    return predict(rows, model).select(
        "doc_id", F.coalesce(fold("doc_id", parts) == held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")

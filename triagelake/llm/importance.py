"""Target-distribution importance resampling over hashed word features, with length-bucketed CRC matrices."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagelake.core import cut, number_rows
from triagelake.llm.common import concat_ranges, pieces, utf8

#: Features of one block, and bytes of it beyond which a block ends early.
BLOCK_FEATURES, BLOCK_BYTES = 1 << 17, 1 << 21
#: Longer features take the library's loop over their bytes: a matrix would have one row and as many columns.
LONG = 2048
#: Bytes whose word borders are sought at once.
WINDOW = 1 << 22


def crc_table() -> np.ndarray:
    """Remainders of all bytes for the reflected CRC-32 polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


TABLE = crc_table()
#: A-Z become a-z; digits, a-z and all bytes of other than ASCII characters are in words.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IN_WORD = np.zeros(256, bool)
IN_WORD[48:58] = IN_WORD[65:91] = IN_WORD[97:123] = IN_WORD[128:] = True


def crc32(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Unsigned CRC-32 of byte ranges: ranges of one length are a matrix whose CRCs are updated column by column."""
    out = np.zeros(len(starts), np.uint32)
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    for own in np.split(order, cuts):
        size = int(lengths[own[0]]) if len(own) else 0
        if size > LONG:
            out[own] = [zlib.crc32(data[s : s + size]) for s in starts[own].tolist()]
            continue
        if not size:
            continue
        matrix = data[starts[own] + np.arange(size)[:, None]]  # one row for each column of the ranges
        crc = np.full(len(own), 0xFFFFFFFF, np.uint32)
        for column in matrix:
            crc = TABLE[(crc ^ column) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
        out[own] = ~crc
    return out


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, byte behind, text number) of all words of texts that lie one behind the other."""
    borders = np.unique(offsets)
    starts, ends = [], []
    for low in range(0, len(data), WINDOW):
        high = min(low + WINDOW, len(data))
        mask = IN_WORD[data[max(low - 1, 0) : high + 1]]  # a byte of context on both sides
        left = mask[:-1] if low else np.append(False, mask[: high - low - 1])
        inner = mask[1:] if low else mask
        inner, right = inner[: high - low], np.append(inner[1:], False)[: high - low]
        left, right = left[: high - low].copy(), right.copy()
        own = borders[(borders >= low) & (borders < high)] - low
        left[own] = False
        own = borders[(borders > low) & (borders <= high)] - low - 1
        right[own] = False
        starts.append(np.flatnonzero(inner & ~left) + low)
        ends.append(np.flatnonzero(inner & ~right) + low + 1)
    join = lambda parts: np.concatenate([np.zeros(0, np.int64), *parts])
    starts, ends = join(starts), join(ends)
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def feature_buckets(text: pa.StringArray, grams: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (text number, bucket) of all features: runs of 1 to ``grams`` words, joined by one space."""
    raw, offsets = utf8(text)
    data = np.frombuffer(raw, np.uint8)
    starts, ends, owner = word_spans(data, offsets)
    widths = np.cumsum(ends - starts + 1)
    at = 0
    while at < len(starts):
        base = widths[at - 1] if at else 0
        stop = min(at + BLOCK_FEATURES, max(at + 1, int(np.searchsorted(widths, base + BLOCK_BYTES, side="right"))))
        reach = min(stop + grams - 1, len(starts))  # the last features of the block end in later words
        length = ends[at:reach] - starts[at:reach]
        # The words of the block, each with a space behind it.
        joined = np.full(int((length + 1).sum()), 32, np.uint8)
        first = np.cumsum(length + 1) - (length + 1)
        if len(joined) <= 2 * BLOCK_BYTES:
            joined[concat_ranges(first, length)] = LOWER[data[concat_ranges(starts[at:reach], length)]]
        else:
            for f, s, n in zip(first.tolist(), starts[at:reach].tolist(), length.tolist(), strict=True):
                joined[f : f + n] = LOWER[data[s : s + n]]
        for n in range(1, grams + 1):
            i = np.arange(min(stop, len(starts) - n + 1) - at)
            i = i[owner[at + i] == owner[at + i + n - 1]]
            size = first[i + n - 1] + length[i + n - 1] - first[i]
            yield owner[at + i], _hashed(joined, first[i], size) % np.uint32(buckets)
        at = stop


def _hashed(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of each range; equal short ranges are hashed once."""
    out = np.zeros(len(starts), np.uint32)
    short = lengths <= LONG
    far = np.flatnonzero(~short)
    out[far] = crc32(data, starts[far], lengths[far])
    near = np.flatnonzero(short)
    if len(near):
        sizes = lengths[near]
        packed = data[concat_ranges(starts[near], sizes)]
        ends = np.append(0, np.cumsum(sizes))
        coded = pa.Array.from_buffers(pa.binary(), len(near), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(packed)]).dictionary_encode()
        kinds = coded.dictionary
        edge = np.frombuffer(kinds.buffers()[1], np.int32)[: len(kinds) + 1].astype(np.int64)
        found = crc32(np.frombuffer(kinds.buffers()[2], np.uint8), edge[:-1], np.diff(edge))
        out[near] = found[coded.indices.to_numpy(zero_copy_only=False)]
    return out


def _counts(grams: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in pieces(batches, limit=2_000_000):
            for _, bucket in feature_buckets(batch.column("text"), grams, buckets):
                total += np.bincount(bucket, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    return run


def bucket_counts(docs: DataFrame, text: str = "text", *, grams: int = 1, buckets: int = 10_000) -> np.ndarray:
    """Features of all whole texts in each bucket; tasks add up their own, ``buckets`` numbers reach the driver."""
    rows = docs.where(F.col(text).isNotNull()).select(F.col(text).cast("string").alias("text"))
    parts = rows.mapInArrow(_counts(grams, buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for row in parts:
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * log ratio) of each bucket's smoothed share in the target to that in the source."""
    width = len(source)
    s, t = source.astype(float), target.astype(float)
    ratio = ((t + 1) * (s.sum() + width)) / ((s + 1) * (t.sum() + width))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _weights(sent, keep: list[str], grams: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = sent.value
        for batch in pieces(batches, limit=2_000_000):
            n = batch.num_rows
            weight, features = np.zeros(n, np.int64), np.zeros(n, np.int64)
            for owner, bucket in feature_buckets(batch.column("text"), grams, len(gain)):
                features += np.bincount(owner, minlength=n)
                # Sums of whole numbers below 2^53 are exact in doubles.
                weight += np.bincount(owner, weights=gain[bucket], minlength=n).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f"_keep_{c}") for c in keep], pa.array(features), pa.array(weight)], [*keep, "n_features", "weight"])

    return run


def score_of(weight, key, seed: int):
    """``weight`` plus the row's seeded Gumbel draw, in thousandths."""
    head = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8)
    h = F.conv(head, 16, 10).cast("double")
    return weight + F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def resample(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", keep: Sequence[str] = (), *,
    grams: int = 1, buckets: int = 10_000, percent: int = 10, least_words: int = 20, seed: int = 2024,
) -> DataFrame:
    """Draws ``percent`` of the documents so that their features look like those of ``target``: the key, ``keep``, n_features,
    weight, score, rank.

    Every document is scored; ``rank`` is 1, 2, ... in falling score (ties: lower key, null keys last) for the drawn
    ones and null for the rest. Documents of fewer than ``least_words`` words are never drawn and not counted. Scores are
    Gumbel-perturbed log ratios, so the draw is without replacement and in proportion to the importance weights.

    A null or empty text has no feature and weight 0; a null key is hashed as empty text; repeated rows are drawn
    each by itself, with one score; an empty table gives an empty result, an empty target a flat
    one; other columns are not read. Whole texts are read twice (counts, then weights), in bounded pieces; ranks come
    from a range-partitioned sort of the scores. ``keep`` columns must not have a name of the result.
    """
    made = [key, "n_features", "weight", "score", "rank"]
    if clash := set(keep) & set(made):
        raise ValueError(f"keep names columns of the result: {sorted(clash)}")
    source = bucket_counts(docs, text, grams=grams, buckets=buckets)
    wanted = bucket_counts(target, text, grams=grams, buckets=buckets)
    sent = docs.sparkSession.sparkContext.broadcast(gains(source, wanted))  # ``buckets`` numbers
    carried = [key, *keep]
    rows = docs.select(*[F.col(c).alias(f"_keep_{c}") for c in carried], F.col(text).cast("string").alias("text"))
    kinds = [f"`{c}` {rows.schema[i].dataType.simpleString()}" for i, c in enumerate(carried)]
    weighed = rows.mapInArrow(_weights(sent, carried, grams), ", ".join([*kinds, "n_features long, weight long"]))
    scored = cut(weighed.withColumn("score", score_of(F.col("weight"), F.col(key), seed)))
    # n words have n + (n - 1) + ... features; the number rises with the words, so it decides for any ``grams``.
    least = sum(max(0, least_words - n) for n in range(grams))
    enough = F.col("n_features") >= least
    drawn = percent * scored.where(enough).count() // 100
    order = [enough.desc(), F.col("score").desc(), F.col(key).asc_nulls_last(), F.col("n_features"), F.col("weight")]
    ranked, _ = number_rows(scored, order, "_place")
    rank = F.when(enough & (F.col("_place") < drawn), F.col("_place") + 1)
    return ranked.select(key, *keep, "n_features", "weight", "score", rank.alias("rank"))

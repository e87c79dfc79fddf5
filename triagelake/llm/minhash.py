"""Near-duplicates: one-permutation hashing with optimal densification, banded buckets, star-shaped candidates."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from triagelake.core import cut
from triagelake.llm.common import concat_ranges, pieces

WORDS = 5
#: Bands of ROWS bins each. A pair at similarity .8 shares no band with chance 2.4e-9, at .85 with 1.8e-13.
BANDS, ROWS = 50, 5
#: Most documents, and most shingles, of one chunk of a star; a task compares two chunks.
CHUNK_DOCS, CHUNK_SHINGLES = 512, 1 << 19
ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x ^ np.uint64(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of the five-word shingles of each text, sorted within it, and their number.

    Words are what ASCII white space parts, A-Z lowered. A text with fewer words is one shingle,
    one without words has none.
    """
    split = pc.ascii_split_whitespace(pc.ascii_lower(text))
    flat = split.flatten()
    doc = np.repeat(np.arange(len(text)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
    coded = flat.dictionary_encode()
    forms, which = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
    value = pd.util.hash_array(forms.to_numpy(zero_copy_only=False).astype(object), categorize=False).astype(np.uint64)
    solid = (pc.binary_length(forms).to_numpy(zero_copy_only=False) > 0)[which] if len(which) else np.zeros(0, bool)
    doc, word = doc[solid], value[which[solid]]
    n_words = np.bincount(doc, minlength=len(text))
    n = len(word)
    pad = np.concatenate([word, np.zeros(WORDS, np.uint64)])
    whole = np.zeros(n, np.uint64)
    for k in range(WORDS):
        whole += mix(pad[k : k + n], k + 1) * ODD[k]
    starts = np.cumsum(n_words) - n_words
    full = n_words >= WORDS
    sizes = np.where(full, n_words - WORDS + 1, 0)
    hashes = mix(whole[concat_ranges(starts, sizes)])
    out, counts = [], np.zeros(len(text), np.int64)
    ends = np.cumsum(sizes)
    for i in range(len(text)):
        if sizes[i]:
            own = np.unique(hashes[ends[i] - sizes[i] : ends[i]])
        elif n_words[i]:
            own = word[starts[i] : starts[i] + n_words[i]]
            total = np.zeros(1, np.uint64)
            for k in range(len(own)):
                total += mix(own[k : k + 1], k + 1) * ODD[k]
            own = mix(total, 100 + len(own))
        else:
            continue
        out.append(own)
        counts[i] = len(own)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), counts


@lru_cache(maxsize=2)
def detours(bins: int) -> np.ndarray:
    """For each bin a seeded order of all bins: an empty bin borrows from the first filled one in it."""
    rng = np.random.default_rng(20170814)
    return np.stack([rng.permutation(bins) for _ in range(bins)])


def sketches(hashes: np.ndarray, counts: np.ndarray, bins: int = BANDS * ROWS) -> np.ndarray:
    """One-permutation sketch of each set: the least value in each bin; every set must have an element.

    Empty bins are filled independently of each other, each by its own order of the bins, so equal
    chances of agreement hold for small sets too (optimal densification).
    """
    n = len(counts)
    g = mix(hashes, 7)
    cell = np.repeat(np.arange(n), counts) * bins + ((g >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    least = np.full(n * bins, none)
    np.minimum.at(least, cell, g & np.uint64(0xFFFFFFFF))
    filled = (least != none).reshape(n, bins)
    least = least.reshape(n, bins)
    order = detours(bins)
    row, bin_ = np.nonzero(~filled)
    for attempt in range(bins):
        if not len(row):
            break
        other = order[bin_, attempt]
        hit = filled[row, other]
        # Mixed with the bin: a borrowed value must not look like the lender's own.
        least[row[hit], bin_[hit]] = least[row[hit], other[hit]]
        row, bin_ = row[~hit], bin_[~hit]
    return least


def bands(sketch: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each sketch."""
    shaped = sketch.reshape(len(sketch), BANDS, ROWS)
    key = np.zeros((len(sketch), BANDS), np.uint64)
    for k in range(ROWS):
        key = mix(key ^ shaped[:, :, k], k + 11)
    return mix(key ^ np.arange(BANDS, dtype=np.uint64)[None, :], 77).astype(np.int64)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        hashes, counts = shingles(batch.column("text"))
        have = counts > 0
        owner = np.repeat(np.arange(len(counts)), counts)
        a, b = np.zeros(len(counts), np.uint64), np.zeros(len(counts), np.uint64)
        keys = np.zeros((0, BANDS), np.int64)
        if have.any():
            starts = (np.cumsum(counts) - counts)[have]
            a[have] = np.add.reduceat(mix(hashes, 3), starts)
            b[have] = np.bitwise_xor.reduceat(mix(hashes, 5), starts)
            own = counts[have]
            keys = bands(sketches(hashes, own))
        assert len(owner) == len(hashes)
        at = np.concatenate([[0], np.cumsum(np.where(have, BANDS, 0))]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts), pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64)),
             pa.ListArray.from_arrays(pa.array(at), pa.array(keys.ravel()))], ["doc_id", "n_shingles", "s1", "s2", "bands"])


def _verified(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "member_text"):
            centre = batch.column("centre_text").dictionary_encode()
            hc, nc = shingles(centre.dictionary.cast(pa.string()))
            hm, nm = shingles(batch.column("member_text"))
            ec, em = np.cumsum(nc), np.cumsum(nm)
            good = []
            for i, c in enumerate(centre.indices.to_pylist()):
                a, b = hc[ec[c] - nc[c] : ec[c]], hm[em[i] - nm[i] : em[i]]
                common = len(a) + len(b) - len(np.union1d(a, b))
                good.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select(["centre", "member"]).filter(pa.array(good, pa.bool_()))

    return run


def _compared(percent: int):
    """Links between documents of different components in one pair of chunks; a spanning forest of them."""

    def run(key, table):
        ids, labels = table.column("doc_id").to_numpy(), table.column("label").to_numpy()
        hashes, counts = shingles(pc.fill_null(table.column("text"), "").combine_chunks().cast(pa.string()))
        n = len(ids)
        owner = np.repeat(np.arange(n), counts)
        _, number, times = np.unique(hashes, return_inverse=True, return_counts=True)
        shared = times[number] > 1
        owner, number = owner[shared], np.unique(number[shared], return_inverse=True)[1]
        common = np.zeros((n, n), np.float32)
        order = np.argsort(number, kind="stable")
        owner, number = owner[order], number[order]
        slab = 4096
        for low in range(0, int(number[-1]) + 1 if len(number) else 0, slab):
            a, b = np.searchsorted(number, [low, low + slab])
            part = np.zeros((n, slab), np.float32)
            part[owner[a:b], number[a:b] - low] = 1
            common += part @ part.T
        union = counts[:, None] + counts[None, :] - common
        links = np.argwhere(np.triu(100 * common >= percent * union, 1) & (labels[:, None] != labels[None, :]) & (counts[:, None] > 0))
        parent = {x: x for x in np.unique(labels).tolist()}

        def top(x):
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        found = []
        for i, j in links.tolist():
            a, b = top(labels[i].item()), top(labels[j].item())
            if a != b:
                parent[max(a, b)] = min(a, b)
                found.append((labels[i].item(), labels[j].item()))
        return pa.table({"centre": pa.array([f[0] for f in found], pa.int64()), "member": pa.array([f[1] for f in found], pa.int64())})

    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the least node that each node of the edges (centre, member) can reach.

    Labels take the least label next to them and then their label's label, so long chains take few rounds.
    Every round is written to the checkpoint folder.
    """
    both = cut(edges.select(F.col("centre").alias("a"), F.col("member").alias("b")).unionByName(
        edges.select(F.col("member").alias("a"), F.col("centre").alias("b"))).distinct())
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("near")), "b").groupBy("a").agg(F.min("near").alias("near"))
        lower = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", F.least("label", "near").alias("lower"), F.col("label").alias("old"))
        jump = lower.select(F.col("node").alias("lower"), F.col("lower").alias("far"))
        moved = cut(lower.join(jump, "lower").select("node", F.least("lower", "far").alias("label"), "old"))
        labels = moved.select("node", "label")
        if moved.where("label < old").isEmpty():
            return labels


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", *, percent: int = 85) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept; links at Jaccard >= percent / 100.

    1. Equal sets form a class (by size and two 64-bit sums); its least id stands for it.
    2. Sketches of the classes fall into banded buckets. The least id of a bucket is the centre of a star: only
       pairs centre-member become rows, so their number is linear. Each is confirmed on the full sets.
    3. Two members of a star that are in different components so far may still be linked. Stars with
       more than one component are cut into chunks of bounded size, and each task compares two chunks by a
       product of their shingle matrices. So every pair that shares a bucket is either connected or compared, and
       no pair becomes a row unless it links two components.

    A text without words has no shingles and no links. A null id names no component: its component_id is null
    and it is kept. Rows that repeat an id are one node with the links of all its texts. An empty table gives
    an empty result; other columns are not read.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    signed = cut(rows.mapInArrow(_signed, "doc_id long, n_shingles long, s1 long, s2 long, bands array<long>"))
    classes = signed.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("n_shingles", "s1", "s2").agg(
        F.min("doc_id").alias("rep"), F.first("bands").alias("bands"))
    classes = cut(classes)
    placed = classes.select("rep", F.explode("bands").alias("band"))
    centres = placed.groupBy("band").agg(F.min("rep").alias("centre"), F.max("rep").alias("_far")).where("centre < _far").drop("_far")
    stars = cut(placed.join(centres, "band").where("rep > centre").select("centre", F.col("rep").alias("member")).distinct())
    wanted = stars.select(F.explode(F.array("centre", "member")).alias("doc_id")).distinct()
    texts = cut(rows.join(wanted, "doc_id"))
    pairs = stars.join(texts.select(F.col("doc_id").alias("member"), F.col("text").alias("member_text")), "member").join(
        texts.select(F.col("doc_id").alias("centre"), F.col("text").alias("centre_text")), "centre")
    linked = cut(pairs.mapInArrow(_verified(percent), "centre long, member long"))
    labels = components(linked)
    label_of = lambda name: F.coalesce(F.col("label"), F.col(name)).alias("label")
    members = stars.unionByName(stars.select("centre", F.col("centre").alias("member")).distinct())
    members = members.join(labels.withColumnRenamed("node", "member"), "member", "left").select("centre", "member", label_of("member"))
    weight = texts.groupBy("doc_id").agg(F.sum(F.length("text") / 6 + 1).alias("_w"))  # rough number of shingles
    open_ = members.join(weight.withColumnRenamed("doc_id", "member"), "member").groupBy("centre").agg(
        F.count(F.lit(1)).alias("_n"), F.min("label").alias("_l"), F.max("label").alias("_u"), F.sum("_w").alias("_w")
    ).where("_l < _u AND _n > 2")
    chunks = F.greatest(F.ceil(F.col("_n") / CHUNK_DOCS), F.ceil(F.col("_w") / CHUNK_SHINGLES)).cast("int")
    dealt = members.join(open_.select("centre", chunks.alias("_chunks")), "centre").withColumn(
        "_own", F.pmod(F.xxhash64("member"), F.col("_chunks")).cast("int"))
    dealt = dealt.select("centre", F.col("member").alias("doc_id"), "label", "_own",
                         F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)).alias("_other"))
    dealt = dealt.select("centre", "doc_id", "label", F.least("_own", "_other").alias("low"), F.greatest("_own", "_other").alias("high"))
    more = dealt.join(texts, "doc_id").groupBy("centre", "low", "high").applyInArrow(_compared(percent), "centre long, member long")
    more = cut(more.distinct())
    merged = components(more)
    final = labels.join(merged.select(F.col("node").alias("label"), F.col("label").alias("_new")), "label", "full").select(
        F.coalesce("node", "label").alias("node"), F.coalesce("_new", "label").alias("label"))
    own = classes.select("n_shingles", "s1", "s2", "rep").join(final.withColumnRenamed("node", "rep"), "rep", "left").select(
        "n_shingles", "s1", "s2", F.coalesce("label", "rep").alias("label"))
    # A repeated id may be in several classes; the least label it reaches holds for all of them.
    got = signed.drop("bands").join(own, ["n_shingles", "s1", "s2"], "left").withColumn("label", F.coalesce("label", "doc_id"))
    return got.select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("label")).alias("component_id"),
        (F.col("doc_id").isNull() | (F.col("doc_id") == F.col("label"))).alias("kept"))


def keep_first(docs: DataFrame, *, percent: int = 80) -> DataFrame:
    """The documents whose id is that of their group, one row for each id; rows without an id stay.

    Null, empty and wordless texts are linked with nothing and stay; of rows that share an id the one with the lowest hash of its other
    columns stays, so reruns agree; all columns of ``docs`` come back, whatever their names; an empty table gives an empty result.
    """
    judged = near_duplicates(docs, percent=percent).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    order = Window.partitionBy("doc_id").orderBy(F.xxhash64(*[c for c in docs.columns if c != "doc_id"]))
    named = docs.where("doc_id IS NOT NULL").join(judged, "doc_id", "left_semi")
    first = named.withColumn("_first", F.row_number().over(order)).where("_first = 1").drop("_first")
    return first.select(docs.columns).unionByName(docs.where("doc_id IS NULL"))

"""Token ids in Simple-8b files: word-aligned packing with escapes and an offset for each block."""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triagelake.core import shuffle_partitions
from triagelake.llm.bpe import local_file
from triagelake.llm.common import concat_ranges, pieces
from triagelake.session import ensure_checkpoint_dir

#: Ids per word and bits per id of selectors 1 to 14; selector 0 is an escape.
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
BITS = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
BLOCK = 256
PAGE_IDS = 1 << 18
#: Distinct strings whose ids a worker keeps from task to task.
REMEMBERED = 400_000


def pack(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packs unsigned 64-bit ids: (words, first word of each block, escapes).

    The low four bits of a word are its selector, the rest holds as many ids as the selector says, lowest
    first; the last word of a block may be partly filled. An id of over 60 bits is an escape: its word holds
    its place in the list of escapes.
    """
    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    blocks = -(-n // block)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint64)
    place = np.arange(n, dtype=np.int64)
    left = np.minimum((place // block + 1) * block, n) - place
    chosen = np.zeros(n, np.int64)  # selector 0 unless another fits
    for s in range(14, 0, -1):
        bad = ids >= np.uint64(1 << int(BITS[s]))
        stop = np.where(bad, place, n)
        fits = np.minimum.accumulate(stop[::-1])[::-1] - place >= np.minimum(COUNTS[s], left)
        chosen[fits] = s
    step = np.minimum(COUNTS[chosen], left)
    begins = np.zeros(n, bool)
    at = np.arange(blocks, dtype=np.int64) * block
    ends = np.minimum(at + block, n)
    while len(at):  # all blocks side by side
        begins[at] = True
        at = at + step[at]
        going = at < ends
        at, ends = at[going], ends[going]
    start = np.flatnonzero(begins)
    selector, filled = chosen[start], step[start]
    words = selector.astype(np.uint64)
    for s in range(1, 15):
        own = np.flatnonzero(selector == s)
        for k in range(int(COUNTS[s])):
            now = own[filled[own] > k]
            words[now] |= ids[start[now] + k] << np.uint64(4 + k * int(BITS[s]))
    far = np.flatnonzero(selector == 0)
    escapes = ids[start[far]]
    words[far] = np.arange(len(far), dtype=np.uint64) << np.uint64(4)
    return words, np.searchsorted(start, np.arange(blocks) * block).astype(np.uint32), escapes


def unpack(words: np.ndarray, first: np.ndarray, escapes: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The n ids of :func:`pack`."""
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    selector = (words & np.uint64(15)).astype(np.int64)
    size = COUNTS[selector]
    before = np.cumsum(size) - size
    per_block = np.diff(np.append(first.astype(np.int64), len(words)))
    start = before - np.repeat(before[first], per_block) + np.repeat(np.arange(len(first)) * block, per_block)
    stop = np.minimum(start + size, np.repeat(np.minimum(np.arange(1, len(first) + 1) * block, n), per_block))
    for s in range(1, 15):
        own = np.flatnonzero(selector == s)
        mask = np.uint64((1 << int(BITS[s])) - 1)
        for k in range(int(COUNTS[s])):
            now = own[start[own] + k < stop[own]]
            out[start[now] + k] = (words[now] >> np.uint64(4 + k * int(BITS[s]))) & mask
    far = np.flatnonzero(selector == 0)
    out[start[far]] = escapes[(words[far] >> np.uint64(4)).astype(np.int64)]
    return out


@lru_cache(maxsize=2)
def unmodified(path: str):
    """The library's tokenizer as it loads the file, and a pattern of the added tokens it takes from raw text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(local_file(path))
    return own, "|".join(re.escape(t.content) for t in own.get_added_tokens_decoder().values())


@lru_cache(maxsize=2)
def tokenizers_of(path: str):
    """The library's tokenizer for text without ASCII white space, and one for single words of plain letters."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import WhitespaceSplit

    with open(local_file(path), encoding="utf-8") as file:
        spec = json.load(file)
    full = Tokenizer.from_str(json.dumps(spec))
    full.encode_special_tokens = True
    words = Tokenizer.from_str(json.dumps(spec | {"normalizer": None, "pre_tokenizer": None, "added_tokens": []}))
    words.pre_tokenizer = WhitespaceSplit()
    return full, words


def _lists(found: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    return np.array([i for ids in found for i in ids], np.int64), sizes


class Memo:
    """Ids of distinct strings a worker has met, up to ``REMEMBERED`` of them, as columns."""

    def __init__(self):
        self.words, self.flat, self.sizes = pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def ids(self, words: pa.StringArray, encode) -> tuple[np.ndarray, np.ndarray]:
        """Ids in a row and their number for each word; ``encode`` gives those of the words not met before."""
        at = pc.index_in(words, value_set=self.words)
        unknown = at.is_null()
        new = words.filter(unknown)
        flat, sizes = encode(new.to_pylist())
        place = pc.fill_null(at, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        place[place < 0] = len(self.words) + np.arange(len(new))
        flat, sizes = np.concatenate([self.flat, flat]), np.concatenate([self.sizes, sizes])
        if len(sizes) <= REMEMBERED:
            self.words, self.flat, self.sizes = pa.concat_arrays([self.words, new]), flat, sizes
        starts = np.cumsum(sizes) - sizes
        return flat[concat_ranges(starts[place], sizes[place])], sizes[place]


@lru_cache(maxsize=2)
def memos(path: str) -> tuple[Memo, Memo]:
    return Memo(), Memo()


def token_ids(text: pa.StringArray, path: str, added: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts as the tokenizers library gives them, and their number in each text.

    With ``added`` the literal texts of added tokens (such as <|endoftext|>) get the ids of these tokens, as by
    the library's default: a text that holds one goes to the unmodified tokenizer as a whole. Without it they
    are plain text, as with ``encode_special_tokens``.
    """
    if not added:
        return plain_ids(text, path)
    own, marks = unmodified(path)
    if not marks or not (marked := pc.match_substring_regex(text, marks).to_numpy(zero_copy_only=False).astype(bool)).any():
        return plain_ids(text, path)
    flat, counts = plain_ids(text.filter(pa.array(~marked)), path)
    more, more_counts = _lists([own.encode(t, add_special_tokens=False).ids for t in text.filter(pa.array(marked)).to_pylist()])
    sizes = np.zeros(len(text), np.int64)
    sizes[~marked], sizes[marked] = counts, more_counts
    place = np.zeros(len(text), np.int64)
    place[~marked] = np.cumsum(counts) - counts
    place[marked] = len(flat) + np.cumsum(more_counts) - more_counts
    return np.concatenate([flat, more])[concat_ranges(place, sizes)], sizes


def plain_ids(text: pa.StringArray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts, and their number in each text; added tokens are plain text.

    The tokenizer drops white space and never joins what it separates, so distinct pieces between
    ASCII white space are encoded once. Pieces of plain letters (a-z), with stops or commas behind them,
    need neither normalizer nor split pattern.
    """
    full, plain = tokenizers_of(path)
    split = pc.ascii_split_whitespace(text)
    per_text = pc.list_value_length(split).to_numpy(zero_copy_only=False)
    coded = pc.ascii_lower(split.flatten()).dictionary_encode()
    forms, which = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
    core = pc.ascii_rtrim(forms, ".,")
    simple = pc.match_substring_regex(core, "^[a-z]+$")
    # Only behind a plain letter: others can be lower-cased into a letter and a mark, which joins what follows.
    cut = pc.match_substring_regex(core, "[a-z]$")
    head = pc.if_else(cut, core, forms)
    tail_size = pc.if_else(cut, pc.subtract(pc.binary_length(forms), pc.binary_length(core)), 0).to_numpy(zero_copy_only=False)
    flags = simple.to_numpy(zero_copy_only=False).astype(bool)
    tails = [f[len(f) - n :] for f, n in zip(forms.filter(pa.array(tail_size > 0)).to_pylist(), tail_size[tail_size > 0].tolist(), strict=True)]
    known_tails = sorted(set(tails))
    heads = head.filter(pa.array(flags)).dictionary_encode()
    rest = head.filter(pa.array(~flags)).dictionary_encode()

    def encode_plain(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        flat, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in range(0, len(words), 2000):
            part = plain.encode(" ".join(words[i : i + 2000]), add_special_tokens=False)
            flat.append(np.array(part.ids, np.int64))
            sizes.append(np.bincount(np.array(part.word_ids, np.int64), minlength=min(2000, len(words) - i)))
        return np.concatenate(flat), np.concatenate(sizes)

    def encode_full(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return _lists([e.ids for e in full.encode_batch_fast(words, add_special_tokens=False)])

    known_plain, known_full = memos(path)
    flat, sizes = known_plain.ids(heads.dictionary, encode_plain)
    more, more_sizes = known_full.ids(pa.concat_arrays([rest.dictionary, pa.array(known_tails, pa.string())]), encode_full)
    flat, sizes = np.concatenate([flat, more]), np.concatenate([sizes, more_sizes]).astype(np.int64)
    # Parts: plain heads, then other heads, then tails, then nothing. A form is a head and a tail.
    n_plain, n_other = len(heads.dictionary), len(rest.dictionary)
    first = np.empty(len(forms), np.int64)
    first[flags] = heads.indices.to_numpy(zero_copy_only=False)
    first[~flags] = n_plain + rest.indices.to_numpy(zero_copy_only=False)
    second = np.full(len(forms), len(sizes), np.int64)
    number = {t: n_plain + n_other + i for i, t in enumerate(known_tails)}
    second[tail_size > 0] = [number[t] for t in tails]
    sizes = np.append(sizes, 0)
    starts = np.cumsum(sizes) - sizes
    parts = np.stack([first, second], axis=1).ravel()
    flat = flat[concat_ranges(starts[parts], sizes[parts])].astype(np.int32)
    size = sizes[first] + sizes[second]
    start = np.cumsum(size) - size
    per_form = size[which]
    ids = flat[concat_ranges(start[which], per_form)]
    ends = np.concatenate([[0], np.cumsum(per_form)])[np.concatenate([[0], np.cumsum(per_text)])]
    return ids, np.diff(ends)


PAGE = "part int, page long, before long, n_ids long, doc_ids array<bigint>, doc_sizes array<bigint>, words binary, first binary, escapes binary"


def _pages(path: str, end_id: int, block: int, added: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, page, before = TaskContext.get().partitionId(), 0, 0
        keys, sizes, held, waiting = [], [], [], 0

        def flush():
            ids = np.concatenate(held)
            words, first, escapes = pack(ids, block)
            values = [[part], [page], [before], [len(ids)], [keys], [np.concatenate(sizes)],
                      [words.astype("<u8").tobytes()], [first.astype("<u4").tobytes()], [escapes.astype("<u8").tobytes()]]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(values, kinds, strict=True)], [c.split()[0] for c in PAGE.split(", ")]), len(ids)

        for batch in pieces(batches, limit=4_000_000):
            ids, counts = token_ids(batch.column("text"), path, added)
            ends = np.cumsum(counts)
            whole = np.full(len(ids) + len(counts), end_id, np.int64)
            whole[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
            ends = ends + np.arange(1, len(counts) + 1)
            own = batch.column("doc_id").to_pylist()
            start = 0
            while start < len(own):
                base = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, base + PAGE_IDS - waiting, side="right")))
                keys += own[start:stop]
                sizes.append(counts[start:stop] + 1)
                held.append(whole[base : ends[stop - 1]])
                waiting += int(ends[stop - 1] - base)
                start = stop
                if waiting >= PAGE_IDS or start < len(own):
                    made, n = flush()
                    yield made
                    page, before = page + 1, before + n
                    keys, sizes, held, waiting = [], [], [], 0
        if held:
            yield flush()[0]

    return run


def write_ids(
    docs: DataFrame, folder: str, path: str, key: str = "doc_id", text: str = "text", *, end_id: int = 1, block: int = BLOCK,
    added: bool = False,
) -> str:
    """Encodes every whole text with the tokenizer file ``path``, appends ``end_id`` and writes files to ``folder``.

    Documents are range partitioned by id (equal and null ids, which come first, by a hash of their text as
    well), so files in order of ``part`` hold ascending ids and no id value fills one task. A row of a file is a
    page of whole documents: their ids and sizes, the packed words, the first word of each block, the escapes.
    A null text is empty and has the end id alone. ``added`` is that of :func:`token_ids`. ``folder`` must be one that all executors share.
    Null and repeated ids are rows like others; an empty table writes no page; other columns are not read. A task encodes 4 MB of text at
    a time, or one longer text.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    placed = rows.repartitionByRange(shuffle_partitions(docs), *order).sortWithinPartitions(*order, "text")
    placed.mapInArrow(_pages(path, end_id, block, added), PAGE).write.mode("errorifexists").parquet(folder)
    return folder


def _pages_read(block: int, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(np.frombuffer(row["words"], "<u8"), np.frombuffer(row["first"], "<u4"),
                             np.frombuffer(row["escapes"], "<u8"), row["n_ids"], block)
                sizes = np.array(row["doc_sizes"], np.int64)
                ends = np.cumsum(sizes)
                n = len(sizes)
                columns = [pa.array([row["part"]] * n, pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                           pa.array(row["before"] + ends - sizes), pa.array(sizes)]
                if digest:
                    raw = memoryview(ids.astype("<u4").tobytes())
                    own = pa.array([zlib.crc32(raw[4 * (e - s) : 4 * e]) for e, s in zip(ends.tolist(), sizes.tolist(), strict=True)], pa.int64())
                else:
                    own = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids.astype(np.int64)))
                yield pa.RecordBatch.from_arrays([*columns, own], ["part", "doc_id", "at", "n_tokens", "ids_crc32" if digest else "ids"])

    return run


def read_ids(spark: SparkSession, folder: str, *, block: int = BLOCK, digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of each document in the files; with ``digest`` ids_crc32 takes the place of ids.

    ``start`` counts the ids of all documents before. One total per file part goes to the driver. Null and repeated ids come back as they
    were written; a folder without pages gives an empty result.
    """
    files = spark.read.schema(PAGE).parquet(folder)
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    offsets, total = [], 0
    for row in totals:
        offsets.append((row["part"], total))
        total += row["n"]
    base = spark.createDataFrame(offsets or [(0, 0)], "part int, _base long")
    last = "ids_crc32 long" if digest else "ids array<bigint>"
    rows = files.mapInArrow(_pages_read(block, digest), f"part int, doc_id long, at long, n_tokens long, {last}")
    return rows.join(F.broadcast(base), "part").select("doc_id", (F.col("_base") + F.col("at")).alias("start"), "n_tokens", last.split()[0])


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the checkpoint folder that all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"

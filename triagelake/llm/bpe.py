"""Byte-level BPE: merges replayed in rank order over all distinct words of a slice of the corpus."""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

from triagelake.llm.common import concat_ranges, pieces, strings, utf8

LETTER, NUMBER, BLANK, OTHER = 0, 1, 2, 3
#: White_Space of Unicode.
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def local_file(name: str) -> str:
    """A file by its path, or the copy that ``SparkContext.addFile`` gave to this machine."""
    return name if os.path.exists(name) else SparkFiles.get(os.path.basename(name))


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of every code point, as the split pattern sees it."""
    table = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for value, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for m in regex.finditer(pattern, every):
            a, b = (x if x < 0xD800 else x + 0x800 for x in (m.start(), m.end() - 1))
            table[a : b + 1] = value
    table[0xD800:0xE000] = OTHER
    table[WHITE] = BLANK
    return table


def word_starts(codes: np.ndarray, doc_starts: np.ndarray) -> np.ndarray:
    """Marks the first code point of each match of the split pattern; no match crosses a document.

    The pattern's alternatives are rules on runs of one class: a run of letters, numbers or other
    characters takes one space before it; of a white run the last character splits off before other
    text; a lone apostrophe that starts a match takes the letters of a contraction.
    """
    n = len(codes)
    if not n:
        return np.zeros(0, bool)
    kind = classes()[codes]
    first = np.zeros(n + 1, bool)
    first[doc_starts] = True
    first[n] = True
    first = first[:n] if n else first
    change = first.copy()
    change[1:] |= kind[1:] != kind[:-1]
    ends_doc = np.empty(n, bool)
    ends_doc[:-1], ends_doc[-1] = first[1:], True
    starts = change.copy()
    blank = kind == BLANK
    # The last white character before other text of the same document starts a match of its own ...
    last = np.zeros(n, bool)
    last[:-1] = blank[:-1] & ~blank[1:] & ~ends_doc[:-1]
    starts |= last
    # ... and a plain space there takes the run behind it along.
    taken = np.flatnonzero(last & (codes == 32)) + 1
    starts[taken] = False
    # Contractions: a run that is one apostrophe, not taken along by a space, before these letters.
    at = np.flatnonzero(starts & (codes == 39) & ~ends_doc)
    at = at[kind[at + 1] == LETTER]
    if len(at):
        pad = np.concatenate([codes, np.zeros(2, codes.dtype)])
        inside = at + 2 < n
        inside[inside] &= ~first[at[inside] + 2]
        one, two = pad[at + 1], np.where(inside, pad[at + 2], 0)
        short = np.isin(one, [ord(c) for c in "stmd"])
        double = ((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)
        length = np.where(short, 2, np.where(double, 3, 0))
        at, length = at[length > 0], length[length > 0]
        starts[at + 1] = False
        follow = at + length
        ok = follow < n
        starts[follow[ok]] = True
    return starts


def split_words(text: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
    """All matches of the split pattern over the texts, in order, and the number in each text."""
    data, offsets = utf8(text)
    codes = np.frombuffer(data.decode("utf-8").encode("utf-32-le"), np.uint32)
    raw = np.frombuffer(data, np.uint8)
    lead = np.flatnonzero((raw & 0xC0) != 0x80)
    doc_codes = np.searchsorted(lead, offsets)
    starts = np.flatnonzero(word_starts(codes, doc_codes[:-1][np.diff(doc_codes) > 0]))
    per_doc = np.diff(np.searchsorted(starts, doc_codes))
    return strings(data, np.append(lead[starts], len(data))), per_doc


class Merges:
    """Ranks of a vocabulary file and the replay of its merges over a set of words."""

    def __init__(self, ranks: dict[bytes, int]):
        self.token = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.token[rank] = token
        self.width = len(self.token)
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        # Every way to put a token together from two others; the pair's rank is that of the whole.
        pairs = np.array(sorted(
            (ranks[t[:i]] * self.width + ranks[t[i:]], r)
            for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks), np.int64).reshape(-1, 2)
        self.pair_key, self.pair_rank = np.append(pairs[:, 0], np.iinfo(np.int64).max), np.append(pairs[:, 1], -1)
        # Postings are kept by bands of ranks; a band is emptied before the next one is opened.
        self.bounds = np.unique(np.geomspace(8, self.width, 40).astype(np.int64))
        self.bounds[-1] = self.width

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of tokens, -1 where no merge puts them together."""
        key = left * self.width + right
        at = np.searchsorted(self.pair_key, key)
        return np.where(self.pair_key[at] == key, self.pair_rank[at], -1)

    def replay(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of the words raw[offsets[i]:offsets[i + 1]], in a row, and how many each word has.

        All words lie on one line of positions. An inverted index holds, for each band of pair ranks, the
        positions where such a pair starts. The lowest band is opened; in each word that has postings in
        it, the pair of lowest rank is merged (every occurrence, from the left), and only the pairs on both
        sides of a merge are looked up and indexed anew. So a word's merges happen in rank order.
        """
        n = len(raw)
        if not n:
            return np.zeros(0, np.int64), np.diff(offsets)
        lengths = np.diff(offsets)
        word = np.repeat(np.arange(len(lengths)), lengths)
        token = self.byte[raw]
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        filled = lengths > 0
        after[offsets[1:][filled] - 1] = -1
        before[offsets[:-1][filled]] = -1
        now = np.full(n, -1, np.int64)
        inner = np.flatnonzero(after >= 0)
        now[inner] = self.pair(token[inner], token[inner + 1])
        index: list[list[np.ndarray]] = [[] for _ in self.bounds]
        lowest = 0

        def post(places: np.ndarray) -> None:
            nonlocal lowest
            places = places[now[places] >= 0]
            if not len(places):
                return
            band = np.searchsorted(self.bounds, now[places], side="right")
            order = np.argsort(band, kind="stable")
            cuts = np.flatnonzero(np.diff(band[order])) + 1
            for part in np.split(order, cuts):
                index[band[part[0]]].append(places[part])
            lowest = min(lowest, int(band[order[0]]))

        post(inner)
        while lowest < len(index):
            if not index[lowest]:
                lowest += 1
                continue
            places = np.concatenate(index[lowest])
            index[lowest] = []
            rank = now[places]
            low = self.bounds[lowest - 1] if lowest else 0
            fit = (rank >= low) & (rank < self.bounds[lowest])
            places, rank = places[fit], rank[fit]
            if not len(places):
                continue
            order = np.lexsort((places, rank, word[places]))
            places, rank = places[order], rank[order]
            once = np.append(True, places[1:] != places[:-1])
            places, rank = places[once], rank[once]
            own = word[places]
            head = np.append(True, own[1:] != own[:-1])
            least = rank[head][np.cumsum(head) - 1]
            chosen = rank == least
            rest, p, r = places[~chosen], places[chosen], rank[chosen]
            if len(rest):
                index[lowest].append(rest)
            # Of overlapping occurrences (aaa) every other one counts, from the left.
            chained = np.append(False, after[p[:-1]] == p[1:])
            number = np.arange(len(p))
            begin = np.maximum.accumulate(np.where(chained, 0, number))
            keep = (number - begin) % 2 == 0
            p, r = p[keep], r[keep]
            q = after[p]
            right = after[q]
            token[p] = r
            now[q] = -2  # merged away
            after[p] = right
            open_right = right >= 0
            before[right[open_right]] = p[open_right]
            now[p[~open_right]] = -1
            # A right neighbour may itself have just been merged: links and tokens are all set by now.
            at = p[open_right]
            now[at] = self.pair(token[at], token[after[at]])
            left = before[p]
            side = left >= 0
            left = left[side]
            now[left] = self.pair(token[left], token[p[side]])
            post(np.concatenate([at, left]))
        stays = now != -2
        counts = np.zeros(len(lengths), np.int64)
        counts += np.bincount(word[stays], minlength=len(lengths))
        return token[stays], counts

    def decode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of all ids and the len + 1 offsets between them."""
        size, data, start = self._layout()
        lengths = size[ids]
        offsets = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(lengths, out=offsets[1:])
        taken = pa.Array.from_buffers(
            pa.binary(), len(size), [None, pa.py_buffer(start.astype(np.int32)), pa.py_buffer(data)]).take(pa.array(ids))
        return (taken.buffers()[2].to_pybytes()[: offsets[-1]] if len(ids) else b""), offsets

    def _layout(self):
        if not hasattr(self, "_laid"):
            size = np.fromiter(map(len, self.token), np.int64, len(self.token))
            self._laid = (size, b"".join(self.token), np.concatenate([[0], np.cumsum(size)]))
        return self._laid


@lru_cache(maxsize=2)
def load(path: str) -> Merges:
    with open(local_file(path), "rb") as lines:
        return Merges({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})


def encode_texts(text: pa.StringArray, merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, and the len + 1 offsets of the texts in them."""
    words, per_doc = split_words(text)
    coded = words.dictionary_encode()
    data, offsets = utf8(coded.dictionary)
    flat, sizes = merges.replay(np.frombuffer(data, np.uint8), offsets)
    starts = np.cumsum(sizes) - sizes
    which = coded.indices.to_numpy(zero_copy_only=False)
    ids = flat[concat_ranges(starts[which], sizes[which])]
    at_word = np.concatenate([[0], np.cumsum(sizes[which])])
    return ids, at_word[np.concatenate([[0], np.cumsum(per_doc)])]


def _encoded(path: str, key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = load(path)
        for batch in pieces(batches, limit=2_000_000):
            ids, at = encode_texts(batch.column("text"), merges)
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(key), lists], [key, "ids"])

    return run


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): token ids of every whole text by the rank file ``path``, without special tokens.

    Each task replays the merges over the distinct words of its slices of the corpus; nothing is
    shuffled and memory is bounded by a slice. A null text has no ids; null keys and repeated rows
    keep their rows; an empty table gives an empty result; other columns are not read.
    """
    frame = docs.select(docs[key].alias(key), docs[text].alias("text"))
    return frame.mapInArrow(_encoded(path, key), f"`{key}` {frame.schema[0].dataType.simpleString()}, ids array<int>")


def decode(coded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """(key, bytes): the bytes of the ids; null ids count as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = load(path)
        for batch in batches:
            lists = batch.column("ids")
            sizes = np.array([len(x) if x.is_valid else 0 for x in lists], np.int64)
            data, offsets = merges.decode(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64))
            at = offsets[np.concatenate([[0], np.cumsum(sizes)])]
            out = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([batch.column(key), out], [key, "bytes"])

    frame = coded.select(key, "ids")
    return frame.mapInArrow(run, f"`{key}` {frame.schema[0].dataType.simpleString()}, bytes binary")


def digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of every whole text; the ids are decoded again for the last.

    The same work as :func:`encode` and :func:`decode` in one pass, so ids don't leave the task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = load(path)
        shown = pa.array([f"{i} ".encode() for i in range(merges.width)], pa.binary())
        shown_size = np.fromiter((len(x.as_py()) for x in shown), np.int64, len(shown))
        for batch in pieces(batches, limit=2_000_000):
            ids, at = encode_texts(batch.column("text"), merges)
            written = shown.take(pa.array(ids))
            listing = memoryview(written.buffers()[2]) if len(ids) else memoryview(b"")
            stop = np.concatenate([[0], np.cumsum(shown_size[ids])])[at].tolist()
            data, offsets = merges.decode(ids.astype(np.int64))
            data, cut = memoryview(data), offsets[at].tolist()
            sha = hashlib.sha256
            yield pa.RecordBatch.from_arrays([
                batch.column(key), pa.array(np.diff(at), pa.int64()),
                pa.array([sha(listing[a : max(a, b - 1)]).hexdigest() for a, b in zip(stop, stop[1:], strict=False)], pa.string()),
                pa.array([sha(data[a:b]).hexdigest() for a, b in zip(cut, cut[1:], strict=False)], pa.string()),
            ], [key, "n_tokens", "ids_sha256", "decoded_sha256"])

    frame = docs.select(docs[key].alias(key), docs[text].alias("text"))
    kind = frame.schema[0].dataType.simpleString()
    return frame.mapInArrow(run, f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def ship(spark: SparkSession, path: str) -> str:
    """Let executors without the vocabulary file fetch the driver's copy; returns ``path``."""
    spark.sparkContext.addFile(path)
    return path

"""Simple-8b files: exact round trips and ids as the library gives them."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from triagelake.llm import queries, simple8b

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    own = Tokenizer.from_file(PATH)
    own.encode_special_tokens = True
    return own


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 5000])
@pytest.mark.parametrize("bits", [0, 1, 7, 16, 31, 60, 64])
def test_round_trip(n, bits):
    rng = np.random.default_rng(n * 100 + bits)
    width = rng.integers(0, bits + 1, n)
    ids = np.array([random.Random(i).getrandbits(int(w)) if w else 0 for i, w in enumerate(width)], np.uint64)
    words, first, escapes = simple8b.pack(ids)
    assert np.array_equal(simple8b.unpack(words, first, escapes, n), ids)
    assert len(escapes) == int((ids >= np.uint64(1 << 60)).sum())
    if n and bits <= 1:
        assert len(words) <= -(-n // 60) + -(-n // simple8b.BLOCK)


CASES = ["", " ", "Hello, WORLD. it's", "straße ÉCOLE café ΣΑΣ.", "a.b,c.. ,, ...", "x y z", "<|endoftext|> <|startoftext|>", "1234 5,6.", "🙂🙂 日本",
         "don't DON'T 'll", "end.,", "\x1c\x1d q", "İstanbul KK", "supercalifragilistic" * 30, "a\x0bb\x0cc"]


def test_ids_equal_the_library(library):
    rng = random.Random(3)
    texts = CASES + ["".join(rng.choice("abcTHE.,'! é\n0ſ") for _ in range(rng.randrange(60))) for _ in range(800)]
    ids, counts = simple8b.token_ids(pa.array(texts), PATH)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_stops_behind_any_letter():
    """The unmodified library on letters, marks and stops in all orders."""
    library = Tokenizer.from_file(PATH)
    rng = random.Random(7)
    marks = ["İ", "ı", "\u0307", "\u0301", "\u0345", "é", "É", "ß", "Σ", "K", "ǅ", "ﬁ", "語", "\u1112", "\u1161", "\u200d", "٣", "½", ".", ",", ".,", " ", "a", "Z"]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randrange(1, 9))) for _ in range(4000)]
    texts += [chr(c) + stop for c in range(0x80, 0x3100) for stop in (".", ",a")]
    ids, counts = simple8b.token_ids(pa.array(texts), PATH, added=True)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_files_and_edges(spark, library, monkeypatch):
    rows = [(i, t) for i, t in enumerate(CASES)] + [(None, "no id"), (None, None), (3, CASES[3]), (3, None)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, part int")
    folder = simple8b.write_ids(df, simple8b.shared_folder(spark, "ids"), PATH)
    got = sorted(simple8b.read_ids(spark, folder).collect(), key=lambda r: r["start"])
    assert len(got) == len(rows)
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda x: (x is not None, x))
    want = sorted(((*library.encode(t or "", add_special_tokens=False).ids, 1), k is None, k or 0) for k, t in rows)
    assert sorted((tuple(r["ids"]), r["doc_id"] is None, r["doc_id"] or 0) for r in got) == want
    at = 0
    for r in got:
        assert (r["start"], r["n_tokens"]) == (at, len(r["ids"]))
        at += r["n_tokens"]
    empty = simple8b.write_ids(df.limit(0), simple8b.shared_folder(spark, "ids"), PATH)
    assert simple8b.read_ids(spark, empty).count() == 0


def test_whole_table(spark, library):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = sorted(queries.op5_simple8b(spark, SF).collect())
    assert [r["doc_id"] for r in got] == sorted(docs)
    at = 0
    for r in got:
        ids = [*library.encode(docs[r["doc_id"]], add_special_tokens=False).ids, 1]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_added_tokens_as_by_the_library_default(spark, monkeypatch):
    library = Tokenizer.from_file(PATH)
    texts = [*CASES, "a <|endoftext|> b", "a<|startoftext|>B, c.<|endoftext|>", "<|ENDOFTEXT|> x", "plain words", "<|endoftext|>" * 3, "é<|endoftext|> 1"]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [320, 49407, 321] in want
    ids, counts = simple8b.token_ids(pa.array(texts), PATH, added=True)
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(queries, "table", lambda *_: df)
    at = 0
    for r, w in zip(sorted(queries.op5_simple8b(spark, SF).collect()), want, strict=True):
        w = [*w, 1]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(w), zlib.crc32(np.array(w, "<u4").tobytes()))
        at += len(w)

"""BPE against the tiktoken library."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken

from triagelake.llm import bpe, queries

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


CASES = [None, "", " ", "   ", "a", "'s", "it's we'll they've I'm he'd we're don't", "'start ''s '' ' 's x's \n's", "a  b\n\nc \t d ", "\n\n\n",
         "aaaa" * 50, "1234 5 67٣४", "héllo wörld ñ 🙂🙂 日本語 テキスト", "x y  z　", "<|endoftext|>", "don'trest I'LL 'llama",
         "ab" * 20000, "q" * 7000 + "'", "áé", "\x1c\x1d a\x0bb", "'", "x'", " 'r", "'re'ver 'v"]


def test_split_equals_the_pattern():
    rng = random.Random(5)
    texts = [t or "" for t in CASES] + ["".join(rng.choice("ab'stdmrevl 1\n\t.!é ") for _ in range(rng.randrange(40))) for _ in range(3000)]
    words, per_doc = bpe.split_words(pa.array(texts))
    want = [regex.findall(public_tokenizers.PATTERN, t) for t in texts]
    assert per_doc.tolist() == [len(w) for w in want]
    assert words.to_pylist() == [x for w in want for x in w]


def test_ids_equal_the_library(spark, library):
    rng = random.Random(6)
    texts = CASES + ["".join(rng.choice("abcdeth ino'\n1é🙂") for _ in range(rng.randrange(200))) for _ in range(300)]
    rows = [(i, t, [7]) for i, t in enumerate(texts)] + [(None, "null key", None), (6, CASES[6], None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids array<int>")
    coded = bpe.encode(df, PATH)
    got = coded.collect()
    assert len(got) == len(rows)
    for r in got:
        text = "null key" if r["doc_id"] is None else texts[r["doc_id"]] or ""
        assert r["ids"] == library.encode_ordinary(text)
    for r in bpe.decode(coded, PATH).collect():
        text = "null key" if r["doc_id"] is None else texts[r["doc_id"]] or ""
        assert bytes(r["bytes"]) == text.encode()
    assert bpe.encode(df.limit(0), PATH).count() == 0


def test_whole_table(spark, library):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op2_bpe(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode_ordinary(docs[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()


def test_replay_of_words(library):
    merges = bpe.load(PATH)
    words = [b"banana", b"", b"aaaaaaa", b"x", b"abababab", "é🙂é".encode(), b"mississippi"]
    offsets = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    ids, counts = merges.replay(np.frombuffer(b"".join(words), np.uint8), offsets)
    want = [library.encode_ordinary(w.decode()) for w in words]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    assert np.array_equal(merges.decode(np.array([], np.int64))[1], [0])

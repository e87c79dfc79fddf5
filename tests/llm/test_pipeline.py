"""The pipeline's stages against plain Python on their own inputs."""

import hashlib
import re

import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_bpe import library  # noqa: F401
from tests.llm.test_minhash import plain_components
from tests.llm.test_secrets import plain_all

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def made(spark):
    """What each stage returned, in order."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        docs = spark.createDataFrame(docs.toPandas(), docs.schema)
        out.append(docs.collect())
    return out


def test_columns(spark, made):
    for rows in made[:-1]:
        assert list(rows[0].asDict()) == list(corpus_pipeline.COLUMNS)
        assert all(r["n_chars"] == len(r["text"]) for r in rows)


def test_languages_kept(spark, made):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert all(tuple(r) == tuple(docs[r["doc_id"]]) for r in made[0])
    assert len(made[0]) >= 0.97 * len(docs)


def test_one_of_each_group(made):
    want = plain_components([(r["doc_id"], r["text"]) for r in made[0]], 80)
    assert sorted(r["doc_id"] for r in made[1]) == sorted({v for v in want.values()})


def test_secrets_are_gone(made):
    before = {r["doc_id"]: r["text"] for r in made[1]}
    for r in made[2]:
        spans = plain_all(before[r["doc_id"]])[1]
        text, at = "", 0
        for a, _, b in spans:
            if a >= at:
                text += before[r["doc_id"]][at:a] + "[REDACTED]"
            at = max(at, b)
        assert r["text"] == text + before[r["doc_id"]][at:]
    assert len(made[2]) == len(before)


def test_mixture_has_its_words(made):
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    before = {r["doc_id"]: r for r in made[2]}
    assert sum(words(r["text"]) for r in made[3]) == pytest.approx(1.5 * sum(words(r["text"]) for r in before.values()), rel=0.03)
    assert all(r["text"] in before[r["doc_id"]]["text"] and r["source"] == before[r["doc_id"]]["source"] for r in made[3])


def test_ids(made, library):  # noqa: F811
    assert isinstance(library, tiktoken.Encoding)
    want = sorted((r["doc_id"], hashlib.sha256(" ".join(map(str, library.encode_ordinary(r["text"]))).encode()).hexdigest()) for r in made[3])
    assert sorted((r["doc_id"], r["ids_sha256"]) for r in made[4]) == want


def test_edges(spark):
    rows = [(None, "the cat and the dog", "en", None, 3), (1, None, None, "a", None), (2, "", "en", "a", 0), (3, "le chat et le chien", "fr", "b", 5),
            (3, "le chat et le chien", "fr", "b", 5), (4, "123 456", "en", "a", 7), (5, "the word " * 9000, "en", "a", 1)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, spans string")
    for part in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            part = stage(spark, part, SF)
            part = spark.createDataFrame(part.collect(), part.schema)
        if docs.count() and part.count():
            assert part.agg(F.count("ids_sha256")).first()[0] == part.count()


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0

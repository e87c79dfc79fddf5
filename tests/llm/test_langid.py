"""Language identification: counts against plain Python, held-out accuracy."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from triagelake.llm import langid, queries

SF = "/root/testdata/sf0.01"


def test_grams_stay_in_their_text():
    texts = ["", "a", "ab", "abc", "Ü🙂x", "", "abcd", ""]
    for (slots, counts), order in zip(langid.gram_slots(pa.array(texts), 1 << 14), langid.ORDERS, strict=True):
        want = [max(0, len(t) - order + 1) for t in texts]
        assert counts.tolist() == want and len(slots) == sum(want)
        own = np.split(slots, np.cumsum(counts)[:-1])
        alone = [next(s for n, (s, _) in enumerate(langid.gram_slots(pa.array([t]), 1 << 14)) if langid.ORDERS[n] == order) for t in texts]
        assert all(np.array_equal(a, b) for a, b in zip(own, alone, strict=True))


def test_model_and_scores_equal_plain_counts(spark):
    rows = [(0, "the cat", "en"), (1, "der hund", "de"), (2, "the dog the", "en"), (3, None, "en"), (4, "x", None)]
    df = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, score double")
    model = langid.fit(df, buckets=64, alpha=0.5)
    assert model.languages == ["de", "en"]
    counts = {"en": Counter(), "de": Counter()}
    for _, t, lang in rows[:3]:
        for slots, _ in langid.gram_slots(pa.array([t]), 64):
            counts[lang].update(slots.tolist())
    for i, lang in enumerate(model.languages):
        for n in range(3):
            own = np.array([counts[lang][s] + 0.5 for s in range(n * 64, n * 64 + 64)])
            assert np.allclose(model.log_prob[n * 64:n * 64 + 64, i], np.log(own / own.sum()), atol=1e-5)
    got = {r["doc_id"]: r for r in langid.predict(df, model).collect()}
    assert got[0]["lang_pred"] == "en" and got[1]["lang_pred"] == "de"
    assert got[3]["lang_pred"] == "und" and got[3]["score"] == 0.0


def test_edges(spark):
    rows = [(None, "the end", "en"), (1, "", "en"), (2, "123 !?", "de"), (3, "der", "de"), (3, "der", "de"), (4, "the " * 20000, "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.identify(df).collect()
    assert len(got) == 6
    assert {r["lang_pred"] for r in got if r["doc_id"] in (1, 2)} == {"und"}
    assert all(0 <= r["score"] <= 1 for r in got)
    assert langid.identify(df.limit(0)).count() == 0
    assert {r["lang_pred"] for r in langid.identify(df.where("doc_id IS NULL")).collect()} == {"und"}


def test_held_out_accuracy(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op10_langid(spark, SF).collect()
    assert len(got) == len(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r["held_out"]]
    right = np.mean([r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held])
    assert right >= 0.97, right
    assert np.mean([r["score"] > 0.5 for r in held]) > 0.95
    assert pytest.approx(1.0) == max(r["score"] for r in got)


def worker_peak(run) -> float:
    """Peak resident megabytes a child process adds while it works."""
    import multiprocessing
    import resource

    def child(pipe):
        base = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
        run()
        pipe.send((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - base) / 1024)

    ours, theirs = multiprocessing.Pipe()
    process = multiprocessing.get_context("fork").Process(target=child, args=(theirs,))
    process.start()
    process.join()
    return ours.recv()


@pytest.mark.parametrize("languages, size", [(6, 30_000_000), (60, 6_000_000)])
def test_memory_of_scoring(languages, size):
    rng = np.random.default_rng(0)
    text = "".join(map(chr, rng.integers(97, 123, 1000))) + "éß語 "
    model = langid.Model([f"l{i}" for i in range(languages)], rng.standard_normal((3 << 14, languages)).astype(np.float32), np.zeros(languages), 1 << 14)
    texts = pa.array([text * (size // len(text))])
    assert worker_peak(lambda: langid._text_sums(texts, model)) < 500


def test_windows_and_kept_texts(spark):
    texts = ["", "añb語c", "x", "Ünï" * 7, "", "語" * 9, "ab"]
    for most in (1, 3, 5, 1000):
        got = [(n, int(o), int(s)) for n, owner, slots in langid.gram_chunks(pa.array(texts), 64, most) for o, s in zip(owner, slots, strict=True)]
        want = [(n, int(o), int(s)) for n, owner, slots in langid.gram_chunks(pa.array(texts), 64) for o, s in zip(owner, slots, strict=True)]
        assert sorted(got) == sorted(want)
    df = spark.createDataFrame([(1, None, "en"), (2, "the end", "en"), (3, "", "de"), (4, "das ende", "de")], "doc_id long, text string, lang string")
    model = langid.fit(df)
    got = sorted(langid.predict(df, model, keep=("doc_id", "text", "lang")).collect())
    assert [(r["doc_id"], r["text"], r["lang"]) for r in got] == [(1, None, "en"), (2, "the end", "en"), (3, "", "de"), (4, "das ende", "de")]
    assert [r["lang_pred"] for r in got] == ["und", "en", "und", "de"]
    with pytest.raises(ValueError, match="score"):
        langid.predict(df, model, keep=("score",))
    with pytest.raises(ValueError, match="languages"):
        langid.fit(df, most_languages=1)

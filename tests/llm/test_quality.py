"""Quality rules against a plain Python count."""

import re
from collections import Counter

from triagelake.llm import quality, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if seen[tuple(words[i:i + 3])] > 1 for k in range(3)}
    n, rep = len(words), len(covered)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), rep, n < 50 or 100 * rep > 50 * n)


CASES = [None, "", " \n\t", "one two", "a b c a b c", "a a a a a", "x y z x y z x y z q", "a b\na b\n\na b\r\n", "# * $ %&|<> é 🙂",
         "w " * 3000, " ".join(f"w{i % 700}" for i in range(5000)), "a b c d\x0be\x1cf", "\n".join(["same line"] * 90)]


def test_counts_equal_the_plain_ones(spark):
    rows = [(i, t, 1) for i, t in enumerate(CASES)] + [(None, CASES[4], 2), (4, CASES[4], 3)]
    got = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, n_words int")).collect()
    assert len(got) == len(rows)
    for r in got:
        want = plain(CASES[4 if r["doc_id"] is None else r["doc_id"]])
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == want


def test_whole_table_and_good_rows(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    good = {r[0] for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").select("doc_id").collect()}
    got = queries.op8_quality(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == plain(docs[r["doc_id"]])
    clean = [r for r in got if r["doc_id"] in good and not r["base_failed"]]
    assert sum(r["kept"] for r in clean) >= 0.97 * len(clean)


def test_plan_has_no_shuffle_and_no_python(spark):
    plan = queries.op8_quality(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_empty(spark):
    assert quality.judge(spark.createDataFrame([], "doc_id long, text string")).count() == 0

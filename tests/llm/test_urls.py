"""URL filters against a plain Python model."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from triagelake.llm import queries, urls

SF = "/root/testdata/sf0.001"


def plain_rule(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [r for r in urls.RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
    return host, path, best and best[1] + best[2], best and best[0]


CASES = [None, "", "no scheme", "http://a.NET/x", "http://net", "http://net/", "https://Example.net/en/1?x", "http://notexample.net/en/",
         "http://example.com/de/a#b", "http://www.example.com/fr/", "x://y.org/fr/?q", "http://org/fr", "http://é.org/FR/ü", "a://b://c.net/"]


def test_rules_and_edges(spark):
    rows = [(i, u, "x") for i, u in enumerate(CASES)] + [(None, CASES[5], "y"), (5, CASES[5], "z")]
    got = urls.judge(spark.createDataFrame(rows, "page_id long, url string, host string")).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path, rule, verdict = plain_rule(CASES[5 if r["page_id"] is None else r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict or (verdict is None and r["verdict"] in ("allow", "block"))
    assert urls.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_ratio_equals_the_plain_model(spark):
    rows = [("ab.c/00", True), ("ab.d/", True), ("xyz/ab", False), ("xz", False), ("xab", False)]
    df = spark.createDataFrame(rows, "_url string, accepted boolean")
    tables = urls.fit(df, 2.0)
    counts = {c: Counter() for c in (True, False)}
    for u, c in rows:
        pad = "^^^" + u
        for i in range(3, len(pad)):
            for o in range(4):
                counts[c][pad[i - o:i + 1]] += 1
                counts[c]["|" + str(o) + pad[i - o:i]] += 1
    def p(gram, c):
        if not gram:
            return 1 / len(urls.ALPHABET)
        return (counts[c][gram] + 2.0 * p(gram[1:], c)) / (counts[c]["|" + str(len(gram) - 1) + gram[:-1]] + 2.0)
    for u in ("ab.c/", "zzz", "xq", "q"):
        pad, total = "^^^" + u, 0.0
        for i in range(3, len(pad)):
            known = [pad[i - o:i + 1] for o in range(4) if counts[True][pad[i - o:i + 1]] + counts[False][pad[i - o:i + 1]]]
            if known:
                total += math.log(p(known[-1], True)) - math.log(p(known[-1], False))
        got = urls.score(spark.createDataFrame([(u,)], "_url string"), tables, ["_url"]).first()["ratio"]
        assert got == pytest.approx(total / len(u))


def test_whole_table(spark):
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()}
    got = queries.op9_urls(spark, SF)
    rows = got.collect()
    assert {r["page_id"] for r in rows} == set(pages) and len(rows) == len(pages)
    for r in rows:
        host, path, rule, verdict = plain_rule(pages[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and (verdict is None or r["verdict"] == verdict)
    assert got.where(F.col("rule").isNull()).select("verdict").distinct().count() <= 2


def test_threshold_parts_the_classes(spark):
    df = spark.createDataFrame([(x / 10, x > 3) for x in range(-10, 10)], "ratio double, accepted boolean")
    assert 0.3 < urls.threshold(df) <= 0.4
    assert urls.threshold(df.where("accepted")) == 0.0

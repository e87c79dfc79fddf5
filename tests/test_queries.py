"""The registered queries against their SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUICK = (
    "session_features", "transitions", "markov_surprise", "decide_by_argmax", "check_matrix", "cohort_drift", "quantile_summary",
    "pct_rank", "average_precision", "paired_bootstrap", "graph_degrees", "blast_radius", "valid_edges", "safe_holdout",
    "sanitize_evidence", "selection_audit", "verify_assets", "flow_scan", "tfidf", "silhouette", "gate_rules",
)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def _canonical(frame):
    frame = frame[sorted(frame.columns)]
    shown = frame.map(lambda v: None if v is None or v != v else (f"{v:.9g}" if isinstance(v, float) else str(v)))
    return shown.fillna("<null>").sort_values(list(shown.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = _canonical(entry.queries()[name](spark, SF).toPandas())
    want = _canonical(con.execute(entry.oracle_sql()[name]).df())
    assert got.equals(want)


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).where("is_winner").count() == 1

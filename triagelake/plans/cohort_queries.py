"""Queries on check tables, quantiles, ranks, metrics and resampling."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from triagelake.core import det_rand_sql, exact_quantiles
from triagelake.functions import scalars
from triagelake.operators import cohort, decide, metrics
from triagelake.plans import roles

P = roles.PRIORITIES
FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
REPS = 500


def _matrix(spark, d):
    return cohort.mask_matrix(cohort.check_matrix(roles.checks(spark, d)), P)


def q_check_matrix(spark, d):
    m = cohort.check_matrix(roles.checks(spark, d))
    return m.select("repository", *[F.round(cohort.quoted(c), 6).alias(c) for c in P])


def q_sentinel_mask(spark, d):
    c = roles.checks(spark, d)
    return c.select("repository", "name", F.round(scalars.mask_sentinel("score"), 6).alias("score"))


def q_missing_matrix(spark, d):
    return cohort.missing_matrix(_matrix(spark, d), "repository", P)


def q_cohort_drift(spark, d):
    o = roles.table(spark, d, "orders").select(
        "o_orderdate", F.when(F.col("o_orderstatus") != "P", F.concat("o_orderstatus", "o_orderpriority")).alias("commit"),
        F.when(F.col("o_custkey") % 7 == 0, -1.0).otherwise(F.col("o_totalprice")).alias("score"))
    return cohort.cohort_drift(o, "o_orderdate", "commit", "score")


def q_median_impute(spark, d):
    m = cohort.median_impute(_matrix(spark, d), P)
    return m.select("repository", *[F.round(cohort.quoted(c), 6).alias(c) for c in P])


def q_robust_scale(spark, d):
    li = roles.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *FEATURES)
    s = cohort.robust_scale(li, FEATURES)
    return s.select("l_orderkey", "l_linenumber", *[F.round(c, 6).alias(c) for c in FEATURES])


def q_quantile_summary(spark, d):
    li = roles.table(spark, d, "lineitem").select("l_returnflag", "l_extendedprice")
    return exact_quantiles(li, ["l_returnflag"], "l_extendedprice", [0.1, 0.5, 0.9]).select(
        "l_returnflag", "prob", F.round("quantile", 6).alias("quantile"))


def q_pct_rank(spark, d):
    li = roles.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return metrics.average_rank_pct(li, "l_quantity", "pct").withColumn("pct", F.round("pct", 6))


def _metric(spark, d, which):
    s = roles.scored(spark, d)
    arms = s.select("y", F.inline(F.array(
        F.struct(F.lit("advanced").alias("arm"), F.col("advanced").alias("score")),
        F.struct(F.lit("baseline").alias("arm"), F.col("baseline").alias("score")))))
    m = metrics.ranking_metrics(arms, ["arm"], "score", "y")
    return m.select("arm", F.round(which, 6).alias(which))


def q_average_precision(spark, d):
    return _metric(spark, d, "average_precision")


def q_roc_auc(spark, d):
    return _metric(spark, d, "roc_auc")


def q_adjusted_rand(spark, d):
    li = roles.table(spark, d, "lineitem").select("l_linestatus", "l_returnflag", F.col("l_linenumber").alias("b"))
    return metrics.adjusted_rand(li, ["l_linestatus"], "l_returnflag", "b").withColumn("ari", F.round("ari", 6))


def q_stratified_folds(spark, d):
    return metrics.stratified_folds(roles.scored(spark, d).select("doc_id", "y"), "doc_id", "y")


def _bootstrap(spark, d, how):
    diffs = decide.paired_differences(
        roles.scored(spark, d), "doc_id", "advanced", "baseline", "y", n=REPS, weights=how)
    return diffs.select(F.col("rep").cast("long").alias("rep"), F.round("difference", 6).alias("difference"))


def q_paired_differences(spark, d):
    return _bootstrap(spark, d, "stratified")


def q_poisson_differences(spark, d):
    return _bootstrap(spark, d, "poisson")


def q_paired_bootstrap(spark, d):
    g = decide.paired_bootstrap_gate(roles.scored(spark, d), "doc_id", "advanced", "baseline", "y", n=REPS)
    return g.select(*[F.round(c, 6).alias(c) for c in ("median", "p10", "p90")], "adopt")


QUERIES = {
    "check_matrix": q_check_matrix,
    "sentinel_mask": q_sentinel_mask,
    "missing_matrix": q_missing_matrix,
    "cohort_drift": q_cohort_drift,
    "median_impute": q_median_impute,
    "robust_scale": q_robust_scale,
    "quantile_summary": q_quantile_summary,
    "pct_rank": q_pct_rank,
    "average_precision": q_average_precision,
    "roc_auc": q_roc_auc,
    "adjusted_rand": q_adjusted_rand,
    "stratified_folds": q_stratified_folds,
    "paired_differences": q_paired_differences,
    "poisson_differences": q_poisson_differences,
    "paired_bootstrap": q_paired_bootstrap,
}

_PIVOT = ", ".join(f"round(max(CASE WHEN name = '{p}' THEN score END), 6) AS \"{p}\"" for p in P)
_MASKED = f"""{roles.CHECKS_SQL}, masked AS (SELECT repository, name, CASE WHEN score >= 0 THEN score END AS score FROM checks),
wide AS (SELECT repository, {_PIVOT} FROM masked GROUP BY repository)"""


def _scale_sql(c: str) -> str:
    x = f"ln(1 + {c})"
    iqr = f"(SELECT quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25) FROM lineitem)"
    return (f"round(({x} - (SELECT quantile_cont({x}, 0.5) FROM lineitem)) / "
            f"CASE WHEN {iqr} = 0 THEN 1 ELSE {iqr} END, 6) + 0.0 AS {c}")


_ARMS = f"""{roles.SCORED_SQL},
arms AS (SELECT 'advanced' AS arm, advanced AS score, y FROM scored UNION ALL SELECT 'baseline', baseline, y FROM scored),
lv AS (SELECT arm, score, sum(y)::DOUBLE AS p, count(*)::DOUBLE AS n FROM arms GROUP BY 1, 2),
cum AS (SELECT *, sum(p) OVER w AS cp, sum(n) OVER w AS cn FROM lv WINDOW w AS (PARTITION BY arm ORDER BY score DESC))"""

# Differences of weighted average precision per replicate from a table w(rep, doc_id, weight).
_DIFF_SQL = """arms AS (SELECT rep, 'a' AS arm, advanced AS score, y, weight FROM scored JOIN w USING (doc_id)
  UNION ALL SELECT rep, 'b', baseline, y, weight FROM scored JOIN w USING (doc_id)),
lv AS (SELECT rep, arm, score, sum(y * weight)::DOUBLE AS p, sum(weight)::DOUBLE AS n FROM arms GROUP BY 1, 2, 3),
cum AS (SELECT *, sum(p) OVER win AS cp, sum(n) OVER win AS cn FROM lv WINDOW win AS (PARTITION BY rep, arm ORDER BY score DESC)),
ap AS (SELECT rep, arm, sum(p * cp / cn) / sum(p) AS ap FROM cum GROUP BY 1, 2),
diffs AS (SELECT rep, max(CASE WHEN arm = 'a' THEN ap END) - max(CASE WHEN arm = 'b' THEN ap END) AS difference FROM ap GROUP BY rep)"""

_STRATA_SQL = f"""{roles.SCORED_SQL},
num AS (SELECT doc_id, y, row_number() OVER (PARTITION BY y ORDER BY doc_id) - 1 AS slot, count(*) OVER (PARTITION BY y) AS size FROM scored),
draws AS (SELECT rep, y, floor({det_rand_sql(8414, 'rep', 'y', 'slot')} * size)::BIGINT AS slot
          FROM num, generate_series(0, {REPS - 1}) g(rep)),
w AS (SELECT rep, num.doc_id, count(*) AS weight FROM draws JOIN num USING (y, slot) GROUP BY 1, 2),
{_DIFF_SQL}"""


def _poisson_sql(u: str) -> str:
    cdf, term, k, parts = 0.0, math.exp(-1.0), 0, []
    while cdf + term <= 1.0 - 2.0**-52 and term >= 2.0**-53:
        cdf, k = cdf + term, k + 1
        parts.append(f"CASE WHEN {u} >= {cdf!r}::DOUBLE THEN 1 ELSE 0 END")
        term /= k
    return " + ".join(parts)


ORACLE = {
    "check_matrix": f"WITH {roles.CHECKS_SQL} SELECT repository, {_PIVOT} FROM checks GROUP BY repository",
    "sentinel_mask": f"WITH {_MASKED} SELECT repository, name, round(score, 6) AS score FROM masked",
    "missing_matrix": f"WITH {_MASKED} SELECT repository, "
    + ", ".join(f"CASE WHEN \"{p}\" IS NULL THEN 1 ELSE 0 END AS \"{p}__missing\"" for p in P) + " FROM wide",
    "cohort_drift": """SELECT floor(date_diff('microseconds', min(o_orderdate), max(o_orderdate)) / 86400000000)::BIGINT AS observation_span_days,
  count(DISTINCT CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus || o_orderpriority END) AS engine_commits,
  count(*) FILTER (o_custkey % 7 = 0) AS negative_sentinel_count FROM orders""",
    "median_impute": f"WITH {_MASKED} SELECT repository, "
    + ", ".join(f"round(coalesce(\"{p}\", (SELECT quantile_cont(\"{p}\", 0.5) FROM wide), 0), 6) AS \"{p}\"" for p in P) + " FROM wide",
    "robust_scale": f"SELECT l_orderkey, l_linenumber, {', '.join(_scale_sql(c) for c in FEATURES)} FROM lineitem",
    "quantile_summary": """SELECT l_returnflag, prob, round(CASE prob WHEN 0.1 THEN q1 WHEN 0.5 THEN q2 ELSE q3 END, 6) AS quantile
FROM (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.1) AS q1, quantile_cont(l_extendedprice, 0.5) AS q2,
             quantile_cont(l_extendedprice, 0.9) AS q3 FROM lineitem GROUP BY 1) t,
     (VALUES (0.1::DOUBLE), (0.5::DOUBLE), (0.9::DOUBLE)) p(prob)""",
    "pct_rank": """WITH lv AS (SELECT l_quantity, count(*) AS n FROM lineitem GROUP BY 1),
r AS (SELECT l_quantity, (sum(n) OVER (ORDER BY l_quantity) - n + (n + 1) / 2.0::DOUBLE) / sum(n) OVER () AS pct FROM lv)
SELECT l_orderkey, l_linenumber, l_quantity, round(pct, 6) AS pct FROM lineitem JOIN r USING (l_quantity)""",
    "average_precision": f"WITH {_ARMS} SELECT arm, round(sum(p * cp / cn) / sum(p), 6) AS average_precision FROM cum GROUP BY arm",
    "roc_auc": f"""WITH {_ARMS} SELECT arm,
  round(sum(p * ((SELECT count(*) FROM scored WHERE y = 0) - (cn - cp) + (n - p) / 2)) / (sum(p) * sum(n - p)), 6) AS roc_auc
FROM cum GROUP BY arm""",
    "adjusted_rand": """WITH c AS (SELECT l_linestatus, l_returnflag AS a, l_linenumber AS b, count(*)::DOUBLE AS n FROM lineitem GROUP BY 1, 2, 3),
ij AS (SELECT l_linestatus, sum(n * (n - 1) / 2) AS ij, sum(n) AS t FROM c GROUP BY 1),
ca AS (SELECT l_linestatus, sum(n * (n - 1) / 2) AS sa FROM (SELECT l_linestatus, a, sum(n) AS n FROM c GROUP BY 1, 2) x GROUP BY 1),
cb AS (SELECT l_linestatus, sum(n * (n - 1) / 2) AS sb FROM (SELECT l_linestatus, b, sum(n) AS n FROM c GROUP BY 1, 2) x GROUP BY 1)
SELECT l_linestatus, round((ij - sa * sb / (t * (t - 1) / 2)) / ((sa + sb) / 2 - sa * sb / (t * (t - 1) / 2)), 6) AS ari
FROM ij JOIN ca USING (l_linestatus) JOIN cb USING (l_linestatus)""",
    "stratified_folds": f"""WITH {roles.SCORED_SQL} SELECT doc_id, y,
  ((row_number() OVER (PARTITION BY y ORDER BY {det_rand_sql(8414, 'doc_id')}, doc_id) - 1) % 5)::INT AS fold FROM scored""",
    "paired_differences": f"WITH {_STRATA_SQL} SELECT rep, round(difference, 6) AS difference FROM diffs",
    "poisson_differences": f"""WITH {roles.SCORED_SQL},
u AS (SELECT rep, doc_id, {det_rand_sql(8414, 'rep', 'doc_id')} AS u FROM scored, generate_series(0, {REPS - 1}) g(rep)),
w AS (SELECT * FROM (SELECT rep, doc_id, {_poisson_sql('u')} AS weight FROM u) x WHERE weight > 0),
{_DIFF_SQL} SELECT rep, round(difference, 6) AS difference FROM diffs""",
    "paired_bootstrap": f"""WITH {_STRATA_SQL}
SELECT round(quantile_cont(difference, 0.5), 6) AS median, round(quantile_cont(difference, 0.1), 6) AS p10,
       round(quantile_cont(difference, 0.9), 6) AS p90, quantile_cont(difference, 0.1) > 0 AS adopt FROM diffs""",
}

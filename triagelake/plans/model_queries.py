"""Queries on text, clusters, anomaly scores and graph screens."""

from __future__ import annotations

from pyspark.sql import functions as F

from triagelake.operators import cluster, cohort, graph, links, posture, screen, sessions, text
from triagelake.plans import graph_queries, roles

STOP = ("the", "and", "of", "la", "le", "der", "die", "und", "el", "que")
DIMS = 64
SESSION_FEATURES = (
    "event_count", "duration_seconds", "unique_event_types", "login_failed", "command_success", "telnet_fraction")


def _docs(spark, d):
    return roles.table(spark, d, "documents").select("doc_id", "text")


def q_tfidf(spark, d):
    t = text.tfidf(_docs(spark, d), "doc_id", "text", stop_words=STOP)
    return t.select("doc_id", "term", F.round("weight", 6).alias("weight"))


def _topics(spark, d):
    return text.nmf_topics(_docs(spark, d), "doc_id", "text")


def q_nmf_topics(spark, d):
    return _topics(spark, d)["weights"]


def q_topic_terms(spark, d):
    return _topics(spark, d)["terms"]


def q_topic_stability(spark, d):
    return _topics(spark, d)["stability"]


def _embedded(spark, d):
    e = roles.table(spark, d, "embeddings")
    return e.select("vec_id", "label", *[F.get("embedding", F.lit(i)).cast("double").alias(f"e{i}") for i in range(DIMS)])


def q_silhouette(spark, d):
    e = roles.table(spark, d, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("x"))
    return cluster.silhouette(e, [], "vec_id", "x", "label").withColumn("silhouette", F.round("silhouette", 6))


def _kmeans(spark, d):
    return cluster.kmeans_select(
        _embedded(spark, d), "vec_id", [f"e{i}" for i in range(DIMS)], log1p=False, scale=False)


def q_kmeans_scores(spark, d):
    return _kmeans(spark, d)["scores"]


def q_kmeans_labels(spark, d):
    return _kmeans(spark, d)["labels"]


def q_iforest_rarity(spark, d):
    f = sessions.session_features(roles.honeypot_log(spark, d))
    return cluster.iforest_rarity(f, "session_id", SESSION_FEATURES)


def _screen(spark, d):
    nodes = graph_queries.components(spark, d)
    edges = roles.dag(spark, d)[1]
    features = graph.node_features(nodes, edges, graph_queries.advisories(spark, d))
    label = roles.table(spark, d, "part").select(
        F.col("p_partkey").alias("node"), (F.col("p_size") % 5 == 0).cast("int").alias("y"))
    return screen.graph_screen(features.join(label, "node"), edges, "y")


def q_graph_screen(spark, d):
    return _screen(spark, d)["metrics"]


def q_svd_scores(spark, d):
    """Rank-1 entries of the returned-brand relation at its own edges, both ways to get them."""
    inc = roles.incidence(spark, d).withColumn("split", F.lit(0))
    exact = links.spectral_scores(inc, inc, 1, narrow=True).withColumnRenamed("spectral", "gram")
    both = links.spectral_scores(inc, exact, 1)
    return both.select("row_id", "col_id", F.round("gram", 5).alias("gram"), F.round("spectral", 5).alias("subspace"))


def q_balanced_logistic(spark, d):
    o = roles.table(spark, d, "orders").select(
        "o_orderkey", "o_totalprice", (F.col("o_custkey") % 97).alias("branch"), F.month("o_orderdate").alias("month"),
        (F.col("o_orderstatus") == "F").cast("int").alias("y"))
    return screen.balanced_logistic(o, o, ["o_totalprice", "branch", "month"], "y").select("o_orderkey", "y", "probability")


def _posture_matrix(spark, d):
    return cohort.mask_matrix(cohort.check_matrix(roles.checks(spark, d), names=roles.PRIORITIES), roles.PRIORITIES)


def q_posture_predict(spark, d):
    m = _posture_matrix(spark, d)
    model = posture.fit_reference(m, "repository", roles.PRIORITIES, 3)
    return posture.predict_reference(model, m, "repository", roles.PRIORITIES)


def q_stability_gates(spark, d):
    return posture.stability_gates(
        _posture_matrix(spark, d), "repository", roles.PRIORITIES, selected_k=3, model_search_boundary=False,
        observation_span_days=30, bootstrap_repeats=80, starts=12)


def q_gate_rules(spark, d):
    c = roles.table(spark, d, "customer").groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("s"))
    facts = c.select(
        "c_nationkey", (F.lit(2) + F.col("s") % 30).cast("int").alias("selected_k"), "n", (F.col("s") % 5 == 0).alias("model_search_boundary"),
        (F.col("s") % 100 / 100.0).alias("bootstrap_cluster_ari_p10"), (F.col("s") % 90 / 90.0).alias("loo_cluster_ari_p10"),
        (0.9 + F.col("s") % 11 / 100.0).alias("membership_confidence_median"), (F.col("s") % 200).cast("int").alias("observation_span_days"))
    return posture.gate_rules(facts).select("c_nationkey", "decision", F.array_join("reasons", "; ").alias("reasons"))


QUERIES = {
    "svd_scores": q_svd_scores,
    "graph_screen": q_graph_screen,
    "balanced_logistic": q_balanced_logistic,
    "posture_predict": q_posture_predict,
    "stability_gates": q_stability_gates,
    "gate_rules": q_gate_rules,
    "tfidf": q_tfidf,
    "nmf_topics": q_nmf_topics,
    "topic_terms": q_topic_terms,
    "topic_stability": q_topic_stability,
    "silhouette": q_silhouette,
    "kmeans_scores": q_kmeans_scores,
    "kmeans_labels": q_kmeans_labels,
    "iforest_rarity": q_iforest_rarity,
}

def _power_ctes(rounds: int = 25) -> str:
    """Leading right singular vector of inc by unrolled power iteration."""
    parts = ["v0 AS MATERIALIZED (SELECT DISTINCT col_id, 1.0::DOUBLE AS x FROM inc)"]
    for i in range(1, rounds + 1):
        parts.append(
            f"w{i} AS MATERIALIZED (SELECT inc.col_id, sum(u) AS x FROM inc JOIN (SELECT row_id, sum(x) AS u FROM inc "
            f"JOIN v{i - 1} USING (col_id) GROUP BY row_id) r USING (row_id) GROUP BY inc.col_id)")
        parts.append(f"v{i} AS MATERIALIZED (SELECT col_id, x / (SELECT sqrt(sum(x * x)) FROM w{i}) AS x FROM w{i})")
    parts.append(f"u AS (SELECT row_id, sum(x) AS u FROM inc JOIN v{rounds} USING (col_id) GROUP BY row_id)")
    parts.append(f"sc AS (SELECT row_id, col_id, round(u * x, 5) AS s FROM inc JOIN u USING (row_id) JOIN v{rounds} USING (col_id))")
    return ",\n".join(parts)


_STOP_SQL = ", ".join(f"'{w}'" for w in STOP)

ORACLE = {
    "svd_scores": f"WITH {roles.INCIDENCE_SQL}, {_power_ctes()} SELECT row_id, col_id, s AS gram, s AS subspace FROM sc",
    "tfidf": f"""WITH t0 AS (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '{text.WORD}'), lambda w: w NOT IN ({_STOP_SQL})) AS w FROM documents),
tk AS (SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM t0),
tm AS (SELECT doc_id, w AS term FROM tk UNION ALL
       SELECT a.doc_id, a.w || ' ' || b.w FROM tk a JOIN tk b ON a.doc_id = b.doc_id AND b.i = a.i + 1),
c AS (SELECT doc_id, term, count(*) AS tf FROM tm GROUP BY 1, 2),
n AS (SELECT count(*)::DOUBLE AS n FROM documents),
v AS (SELECT term, ln((1 + n) / (1 + df)) + 1 AS idf FROM (SELECT term, count(*) AS df, sum(tf) AS total FROM c GROUP BY 1) s, n
      WHERE df >= 2 AND df <= 0.96::DOUBLE * n ORDER BY total DESC, term LIMIT 2500),
x AS (SELECT doc_id, term, (1 + ln(tf)) * idf AS x FROM c JOIN v USING (term))
SELECT doc_id, term, round(x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)), 6) AS weight FROM x""",
    "gate_rules": """WITH c AS (SELECT c_nationkey, count(*) AS n, sum(c_custkey)::BIGINT AS s FROM customer GROUP BY 1),
f AS (SELECT *, 2 + s % 30 AS k, (s % 100)::DOUBLE / 100 AS b, (s % 90)::DOUBLE / 90 AS l, 0.9::DOUBLE + (s % 11)::DOUBLE / 100 AS m, s % 200 AS days FROM c),
r AS (SELECT c_nationkey, concat_ws('; ', CASE WHEN s % 5 = 0 THEN 'BIC optimum is on the search boundary' END,
  CASE WHEN b < 0.6::DOUBLE THEN 'bootstrap full-pipeline ARI p10 is below 0.60' END,
  CASE WHEN l < 0.7::DOUBLE THEN 'leave-one-out full-pipeline ARI p10 is below 0.70' END,
  CASE WHEN m > 0.95::DOUBLE AND n::DOUBLE / k < 8 THEN printf('membership confidence implausibly high (median %.2f) for k=%d on n=%d (~%.1f points/component): near-hard assignments indicate GMM overfit, not stable separation', m, k, n, n::DOUBLE / k) END,
  CASE WHEN days > 120 THEN 'observation dates span more than the preregistered 120-day window' END) AS reasons FROM f)
SELECT c_nationkey, CASE WHEN reasons = '' THEN 'ADOPT' ELSE 'REJECT' END AS decision, reasons FROM r""",
    "silhouette": """WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
d AS (SELECT a.vec_id, a.label, b.label AS c, sum(list_distance(a.v, b.v)) AS s, count(*) AS n FROM e a, e b GROUP BY 1, 2, 3),
r AS (SELECT vec_id, max(CASE WHEN c = label THEN CASE WHEN n > 1 THEN s / (n - 1) END END) AS a, min(CASE WHEN c <> label THEN s / n END) AS b FROM d GROUP BY 1)
SELECT round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM r""",
}

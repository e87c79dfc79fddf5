"""Queries on the dependency graph, with SQL that unrolls the rounds."""

from __future__ import annotations

from pyspark.sql import functions as F

from triagelake import SEED
from triagelake.core import det_rand_sql
from triagelake.functions import scalars
from triagelake.operators import graph, metrics
from triagelake.plans import roles
from triagelake.sources import documents

DOCUMENT_PARTS = 500  # components of one bill of materials in the registered query
PIVOTS = 64  # sources of the sampled betweenness
ROUNDS = 20  # PageRank rounds in the registered query
LEVELS = 18  # breadth-first levels in the SQL; the part DAG has at most log2(parts) of them


def components(spark, d):
    """Parts as components of the dependency graph."""
    p = roles.table(spark, d, "part")
    return p.select(
        F.col("p_partkey").alias("node"), F.col("p_name").alias("name"),
        F.when(F.col("p_size") % 4 != 0, F.col("p_size").cast("string")).otherwise("").alias("version"),
        F.concat(F.when(F.col("p_size") % 5 != 0, "pkg:gen/").otherwise("gen:"), "p_brand", F.lit("@x/"),
                 F.regexp_replace("p_name", " ", "-"), F.lit("@"), F.col("p_size").cast("string")).alias("purl"),
    )


COMPONENTS_SQL = """comp AS (SELECT p_partkey AS node, p_name AS name,
  CASE WHEN p_size % 4 <> 0 THEN p_size::VARCHAR ELSE '' END AS version,
  CASE WHEN p_size % 5 <> 0 THEN 'pkg:gen/' ELSE 'gen:' END || p_brand || '@x/' || replace(p_name, ' ', '-') || '@' || p_size AS purl
  FROM part)"""


def advisories(spark, d):
    """Advisory ids: suppliers of all lines of a part, with repeats."""
    li = roles.table(spark, d, "lineitem")
    return li.select(F.col("l_partkey").alias("node"), F.concat(F.lit("ADV-"), F.col("l_suppkey") % 20).alias("id"))


ADVISORIES_SQL = """adv AS (SELECT DISTINCT l_partkey AS node, 'ADV-' || (l_suppkey % 20) AS id
  FROM lineitem)"""


def q_graph_degrees(spark, d):
    return graph.graph_degrees(*roles.dag(spark, d))


def q_undirected_edges(spark, d):
    return graph.undirected_edges(roles.dag(spark, d)[1])


def q_unresolved_nodes(spark, d):
    nodes = components(spark, d).where("node % 3 != 0").withColumn("component_type", F.lit("library"))
    out = graph.with_unresolved(nodes, roles.dag(spark, d)[1])
    return out


def q_blast_radius(spark, d):
    return graph.blast_radius(*roles.dag(spark, d))


def q_graph_depth(spark, d):
    return graph.graph_depth(*roles.dag(spark, d))


def q_dag_check(spark, d):
    edges = roles.dag(spark, d)[1]
    extra = edges.where("src = 5").select(F.lit(2).cast("long").alias("src"), F.lit(5).cast("long").alias("dst"))
    good = graph.dag_check(edges).withColumn("graph", F.lit("parts"))
    bad = graph.dag_check(edges.unionByName(extra)).withColumn("graph", F.lit("parts with a loop"))
    return good.unionByName(bad)


def q_pagerank(spark, d):
    r = graph.pagerank(*roles.dag(spark, d), tol=None, max_rounds=ROUNDS)
    return r.select("node", F.round("pagerank", 8).alias("pagerank"))


def q_betweenness(spark, d):
    b = graph.betweenness(*roles.dag(spark, d))
    return b.select("node", F.round("betweenness", 8).alias("betweenness"))


def q_betweenness_pivots(spark, d):
    """Betweenness estimated from PIVOTS seeded sources, with its error."""
    b = graph.betweenness(*roles.dag(spark, d), sources=PIVOTS)
    return b.select("node", *[F.round(c, 8).alias(c) for c in ("betweenness", "standard_error", "error_bound")])


def q_advisory_join(spark, d):
    out = graph.advisory_join(components(spark, d).select("node"), advisories(spark, d))
    return out.select("node", F.array_join("vulnerability_ids", ",").alias("vulnerability_ids"), "vulnerability_count")


def q_node_features(spark, d):
    nodes, edges = components(spark, d), roles.dag(spark, d)[1]
    f = graph.node_features(nodes, edges, advisories(spark, d), tol=None, max_rounds=ROUNDS)
    return f.withColumns({
        "pagerank": F.round("pagerank", 8), "betweenness": F.round("betweenness", 8),
        "vulnerability_ids": F.array_join("vulnerability_ids", ","),
    })


def bom_documents(spark, d):
    """(bills of materials, advisory batches): a document for each DOCUMENT_PARTS parts; all use the same references."""
    c = components(spark, d).withColumn("doc_id", F.floor(F.col("node") / DOCUMENT_PARTS)).withColumn("i", F.col("node") % DOCUMENT_PARTS)
    ref = lambda n: F.concat(F.lit("p"), n.cast("string"))
    i = F.col("i")
    listed = c.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("i", "name", "version", "purl"))).alias("c"))
    asked = F.filter("c", lambda x: x["purl"].startswith("pkg:") & (x["version"] != ""))
    body = F.struct(
        F.lit("CycloneDX").alias("bomFormat"), F.lit("1.2").alias("specVersion"),
        F.transform("c", lambda x: F.struct(ref(x["i"]).alias("bom-ref"), x["name"].alias("name"), x["version"].alias("version"),
                                            x["purl"].alias("purl"), F.lit("library").alias("type"))).alias("components"),
        F.transform(F.filter("c", lambda x: x["i"] > 0), lambda x: F.struct(
            ref(x["i"]).alias("ref"), F.array(ref(F.floor(x["i"] / 2)), ref(F.floor(x["i"] / 3))).alias("dependsOn"))).alias("dependencies"))
    vulns = lambda x: F.array(*[F.struct(F.concat(F.lit("ADV-"), (x["i"] % k).cast("string")).alias("id")) for k in (7, 3)])
    results = F.struct(F.transform(asked, lambda x: F.struct(vulns(x).alias("vulns"))).alias("results"))
    return (listed.select("doc_id", F.to_json(body).alias("value")), listed.select("doc_id", F.to_json(results).alias("value")))


def q_dependency_load(spark, d):
    boms, batches = bom_documents(spark, d)
    out = graph.dependency_load(documents.parse_bom(boms), documents.parse_advisories(batches), tol=None, max_rounds=ROUNDS)
    return out.withColumns({
        "pagerank": F.round("pagerank", 8), "betweenness": F.round("betweenness", 8),
        "vulnerability_ids": F.array_join("vulnerability_ids", ","),
    })


def q_degree_baseline(spark, d):
    nodes, edges = roles.dag(spark, d)
    both = graph.blast_radius(nodes, edges).join(graph.graph_degrees(nodes, edges), "node")
    out = metrics.degree_baseline(both, "transitive_dependents", "direct_dependents")
    return out.select("node", F.round("baseline", 6).alias("baseline"))


def q_positional_join(spark, d):
    c = roles.table(spark, d, "conversations")
    asked = c.where("role != 'assistant'").select("conv_id", F.col("turn").alias("pos"), F.col("text").alias("query"))
    told = c.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("pos"), F.col("text").alias("result"))
    return graph.positional_join(asked, told, ["conv_id"], "pos", strict=False).select(
        "conv_id", "pos", F.length("query").alias("query_chars"), F.length("result").alias("result_chars"), "status")


def q_package_key(spark, d):
    return components(spark, d).select("node", scalars.package_key("purl", "version").alias("package"))


QUERIES = {
    "graph_degrees": q_graph_degrees,
    "undirected_edges": q_undirected_edges,
    "unresolved_nodes": q_unresolved_nodes,
    "blast_radius": q_blast_radius,
    "graph_depth": q_graph_depth,
    "dag_check": q_dag_check,
    "pagerank": q_pagerank,
    "betweenness": q_betweenness,
    "betweenness_pivots": q_betweenness_pivots,
    "advisory_join": q_advisory_join,
    "node_features": q_node_features,
    "dependency_load": q_dependency_load,
    "degree_baseline": q_degree_baseline,
    "positional_join": q_positional_join,
    "package_key": q_package_key,
}

_DEGREES = """deg AS (SELECT node, (SELECT count(*) FROM edges WHERE dst = node) AS direct_dependents,
  (SELECT count(*) FROM edges WHERE src = node) AS direct_dependencies FROM nodes)"""

_CLOSURE = """clo AS (SELECT src, dst FROM edges UNION SELECT clo.src, edges.dst FROM clo JOIN edges ON clo.dst = edges.src),
rad AS (SELECT node, (SELECT count(*) FROM clo WHERE dst = node) AS transitive_dependents,
        (SELECT count(*) FROM clo WHERE src = node) AS transitive_dependencies FROM nodes)"""

_DEPTH = """hop AS (SELECT node, 0 AS dist FROM nodes WHERE node NOT IN (SELECT dst FROM edges)
  UNION SELECT edges.dst, hop.dist + 1 FROM hop JOIN edges ON hop.node = edges.src),
dep AS (SELECT node, coalesce((SELECT min(dist) FROM hop WHERE hop.node = nodes.node), -1)::INT AS depth FROM nodes)"""


def _pagerank_ctes() -> str:
    parts = ["od AS (SELECT node, count(src) AS o FROM nodes LEFT JOIN edges ON src = node GROUP BY node)",
             "nn AS (SELECT count(*)::DOUBLE AS n FROM nodes)",
             "r0 AS MATERIALIZED (SELECT node, o, 1.0::DOUBLE / n AS r FROM od, nn)"]
    for i in range(1, ROUNDS + 1):
        q = f"r{i - 1}"
        parts.append(
            f"r{i} AS MATERIALIZED (SELECT {q}.node, {q}.o, 0.85::DOUBLE * (coalesce(g.s, 0) + "
            f"(SELECT coalesce(sum(r), 0) FROM {q} WHERE o = 0) / n) + 0.15::DOUBLE / n AS r FROM {q} LEFT JOIN "
            f"(SELECT dst, sum(r / o) AS s FROM edges JOIN {q} ON src = node GROUP BY dst) g ON g.dst = {q}.node, nn)")
    return ",\n".join(parts)


def _pagerank_by_ctes() -> str:
    """As above, in each document by itself."""
    parts = ["od AS (SELECT node, doc_id, count(src) AS o FROM nodes LEFT JOIN edges ON src = node GROUP BY ALL)",
             "nn AS (SELECT doc_id, count(*)::DOUBLE AS n FROM nodes GROUP BY 1)",
             "r0 AS MATERIALIZED (SELECT node, doc_id, o, n, 1.0::DOUBLE / n AS r FROM od JOIN nn USING (doc_id))"]
    for i in range(1, ROUNDS + 1):
        q = f"r{i - 1}"
        parts.append(
            f"r{i} AS MATERIALIZED (SELECT {q}.node, {q}.doc_id, {q}.o, n, 0.85::DOUBLE * (coalesce(g.s, 0) + coalesce(l.r, 0) / n) + 0.15::DOUBLE / n AS r "
            f"FROM {q} LEFT JOIN (SELECT dst, sum(r / o) AS s FROM edges JOIN {q} ON src = node GROUP BY dst) g ON g.dst = {q}.node "
            f"LEFT JOIN (SELECT doc_id, sum(r) AS r FROM {q} WHERE o = 0 GROUP BY 1) l ON l.doc_id = {q}.doc_id)")
    return ",\n".join(parts)


def _betweenness_ctes(sources: str = "nodes") -> str:
    parts = [f"l0 AS MATERIALIZED (SELECT node AS s, node AS v, 1.0::DOUBLE AS sigma FROM {sources})",
             "seen0 AS MATERIALIZED (SELECT s, v FROM l0)"]
    for i in range(1, LEVELS + 1):
        parts.append(f"""l{i} AS MATERIALIZED (SELECT s, dst AS v, sum(sigma) AS sigma FROM l{i - 1} JOIN edges ON v = src
  WHERE NOT EXISTS (SELECT 1 FROM seen{i - 1} z WHERE z.s = l{i - 1}.s AND z.v = dst) GROUP BY s, dst)""")
        parts.append(f"seen{i} AS MATERIALIZED (SELECT * FROM seen{i - 1} UNION ALL SELECT s, v FROM l{i})")
    parts.append(f"d{LEVELS} AS MATERIALIZED (SELECT s, v, sigma, 0.0::DOUBLE AS delta FROM l{LEVELS})")
    for i in range(LEVELS - 1, -1, -1):
        parts.append(f"""d{i} AS MATERIALIZED (SELECT a.s, a.v, a.sigma, coalesce(sum(a.sigma / b.sigma * (1 + b.delta)), 0) AS delta
  FROM l{i} a LEFT JOIN (SELECT d{i + 1}.*, src FROM d{i + 1} JOIN edges ON v = dst) b ON a.s = b.s AND a.v = b.src
  GROUP BY a.s, a.v, a.sigma)""")
    union = " UNION ALL ".join(f"SELECT v, delta FROM d{i} WHERE s <> v" for i in range(LEVELS + 1))
    parts.append(f"""dp AS MATERIALIZED (SELECT v, sum(delta) AS b, sum(delta * delta) AS b2 FROM ({union}) u GROUP BY v)""")
    parts.append("""bt AS (SELECT node, coalesce(b, 0) / ((SELECT count(*) FROM nodes) - 1) / ((SELECT count(*) FROM nodes) - 2) AS betweenness
  FROM nodes LEFT JOIN dp ON dp.v = node)""")
    return ",\n".join(parts)


_PAGERANK = _pagerank_ctes()
_BETWEENNESS = _betweenness_ctes()

ORACLE = {
    "graph_degrees": f"WITH {roles.DAG_SQL}, {_DEGREES} SELECT * FROM deg",
    "undirected_edges": f"WITH {roles.DAG_SQL} SELECT src, dst FROM edges UNION SELECT dst, src FROM edges",
    "unresolved_nodes": f"""WITH {roles.DAG_SQL}, {COMPONENTS_SQL},
known AS (SELECT *, 'library' AS component_type FROM comp WHERE node % 3 <> 0)
SELECT * FROM known UNION ALL
SELECT e, e::VARCHAR, '', '', 'unresolved' FROM (SELECT src AS e FROM edges UNION SELECT dst FROM edges) t
WHERE e NOT IN (SELECT node FROM known)""",
    "blast_radius": f"WITH RECURSIVE {roles.DAG_SQL}, {_CLOSURE} SELECT * FROM rad",
    "graph_depth": f"WITH RECURSIVE {roles.DAG_SQL}, {_DEPTH} SELECT * FROM dep",
    "dag_check": f"""WITH RECURSIVE {roles.DAG_SQL}, {_CLOSURE},
e2 AS (SELECT src, dst FROM edges UNION SELECT 2, 5),
c2 AS (SELECT src, dst FROM e2 UNION SELECT c2.src, e2.dst FROM c2 JOIN e2 ON c2.dst = e2.src),
onloop AS (SELECT src AS x FROM c2 WHERE src = dst)
SELECT 'parts' AS graph, count(*) = 0 AS is_dag, count(*) AS cyclic_edges FROM clo WHERE src = dst
UNION ALL SELECT 'parts with a loop', count(*) = 0, count(*) FROM e2
WHERE (src IN (SELECT x FROM onloop) OR EXISTS (SELECT 1 FROM c2 WHERE c2.dst = e2.src AND c2.src IN (SELECT x FROM onloop)))
  AND (dst IN (SELECT x FROM onloop) OR EXISTS (SELECT 1 FROM c2 WHERE c2.src = e2.dst AND c2.dst IN (SELECT x FROM onloop)))""",
    "pagerank": f"WITH {roles.DAG_SQL}, {_PAGERANK} SELECT node, round(r, 8) AS pagerank FROM r{ROUNDS}",
    "betweenness": f"WITH {roles.DAG_SQL}, {_BETWEENNESS} SELECT node, round(betweenness, 8) AS betweenness FROM bt",
    "betweenness_pivots": f"""WITH {roles.DAG_SQL},
piv AS MATERIALIZED (SELECT node FROM nodes ORDER BY {det_rand_sql(SEED, "node")}, node LIMIT {PIVOTS}), {_betweenness_ctes("piv")},
num AS (SELECT (SELECT count(*) FROM nodes)::DOUBLE AS n, (SELECT count(*) FROM piv)::DOUBLE AS s),
est AS (SELECT node, coalesce(b, 0) AS b, coalesce(b2, 0) AS b2, n, s, 1 / ((n - 1) * (n - 2)) AS scale FROM nodes LEFT JOIN dp ON dp.v = node, num)
SELECT node, round(b * n / s * scale, 8) AS betweenness,
       round(sqrt(greatest((b2 - b * b / s) / (s - 1), 0) * (1 - s / n) / s) * n * scale, 8) AS standard_error,
       round(n / (n - 1) * sqrt(ln(2 / 0.05::DOUBLE) / (2 * s)), 8) AS error_bound FROM est""",
    "advisory_join": f"""WITH {ADVISORIES_SQL}
SELECT p_partkey AS node, coalesce(string_agg(id, ',' ORDER BY id), '') AS vulnerability_ids, count(id)::INT AS vulnerability_count
FROM part LEFT JOIN adv ON node = p_partkey GROUP BY p_partkey""",
    "node_features": f"""WITH RECURSIVE {roles.DAG_SQL}, {COMPONENTS_SQL}, {ADVISORIES_SQL}, {_DEGREES}, {_CLOSURE}, {_DEPTH}, {_PAGERANK}, {_BETWEENNESS},
va AS (SELECT p_partkey AS node, coalesce(string_agg(id, ',' ORDER BY id), '') AS vulnerability_ids, count(id)::INT AS vulnerability_count
       FROM part LEFT JOIN adv ON node = p_partkey GROUP BY p_partkey)
SELECT node, name, version, purl, direct_dependents, direct_dependencies, transitive_dependents, transitive_dependencies,
       depth, round(r, 8) AS pagerank, round(betweenness, 8) AS betweenness, vulnerability_count, vulnerability_ids
FROM comp JOIN deg USING (node) JOIN rad USING (node) JOIN dep USING (node) JOIN r{ROUNDS} USING (node) JOIN bt USING (node) JOIN va USING (node)""",
    "dependency_load": f"""WITH RECURSIVE {COMPONENTS_SQL},
listed AS (SELECT node // {DOCUMENT_PARTS} AS doc_id, node % {DOCUMENT_PARTS} AS i, name, version, purl FROM comp),
links AS (SELECT DISTINCT doc_id, i AS a, unnest([i // 2, i // 3]) AS b FROM listed WHERE i > 0),
every AS (SELECT * FROM listed UNION ALL SELECT DISTINCT doc_id, b, 'p' || b, '', '' FROM links l
          WHERE NOT EXISTS (SELECT 1 FROM listed x WHERE x.doc_id = l.doc_id AND x.i = l.b)),
nodes AS MATERIALIZED (SELECT *, doc_id || ':' || i AS node FROM every),
edges AS MATERIALIZED (SELECT doc_id || ':' || a AS src, doc_id || ':' || b AS dst FROM links), {_DEGREES}, {_CLOSURE}, {_DEPTH}, {_pagerank_by_ctes()}, {_betweenness_ctes()}
SELECT nodes.doc_id, 'p' || i AS node, name, version, purl, direct_dependents, direct_dependencies, transitive_dependents, transitive_dependencies,
  depth, round(r, 8) AS pagerank, round(coalesce(b, 0) / ((n - 1) * (n - 2)), 8) AS betweenness,
  CASE WHEN NOT (starts_with(purl, 'pkg:') AND version <> '') THEN 0 WHEN i % 7 = i % 3 THEN 1 ELSE 2 END AS vulnerability_count,
  CASE WHEN NOT (starts_with(purl, 'pkg:') AND version <> '') THEN '' WHEN i % 7 = i % 3 THEN 'ADV-' || i % 7
       ELSE 'ADV-' || least(i % 7, i % 3) || ',ADV-' || greatest(i % 7, i % 3) END AS vulnerability_ids
FROM nodes JOIN deg USING (node) JOIN rad USING (node) JOIN dep USING (node) JOIN r{ROUNDS} USING (node) LEFT JOIN dp ON dp.v = node""",
    "degree_baseline": f"""WITH RECURSIVE {roles.DAG_SQL}, {_DEGREES}, {_CLOSURE},
t AS (SELECT node, transitive_dependents AS t, direct_dependents AS d FROM rad JOIN deg USING (node)),
pt AS (SELECT t, (sum(n) OVER (ORDER BY t) - n + (n + 1) / 2.0::DOUBLE) / sum(n) OVER () AS pt FROM (SELECT t, count(*) AS n FROM t GROUP BY t) a),
pd AS (SELECT d, (sum(n) OVER (ORDER BY d) - n + (n + 1) / 2.0::DOUBLE) / sum(n) OVER () AS pd FROM (SELECT d, count(*) AS n FROM t GROUP BY d) a)
SELECT node, round(0.7::DOUBLE * pt + 0.3::DOUBLE * pd, 6) AS baseline FROM t JOIN pt USING (t) JOIN pd USING (d)""",
    "positional_join": """WITH q AS (SELECT conv_id, turn AS pos, text FROM conversations WHERE role <> 'assistant'),
r AS (SELECT conv_id, turn - 1 AS pos, text FROM conversations WHERE role = 'assistant')
SELECT conv_id, pos, length(q.text)::INT AS query_chars, length(r.text)::INT AS result_chars,
       CASE WHEN q.text IS NULL THEN 'missing query' WHEN r.text IS NULL THEN 'missing result' ELSE 'matched' END AS status
FROM q FULL JOIN r USING (conv_id, pos)""",
    "package_key": f"""WITH {COMPONENTS_SQL} SELECT node,
CASE WHEN starts_with(purl, 'pkg:') AND version <> '' THEN regexp_replace(purl, '@[^@]*$', '') END AS package FROM comp""",
}

"""Queries on sources. Documents are built from single rows of the given tables, then parsed."""

from __future__ import annotations

from pyspark.sql import functions as F

from triagelake.operators import cohort, links, sessions
from triagelake.plans import roles
from triagelake.sources import assets, documents, flows, receipts

# --- documents as assets; manifest wrong for every 7th, silent about every 11th -------------


def _assets(spark, d):
    doc = roles.table(spark, d, "documents").select("doc_id", "text")
    return doc.select(
        F.lit("corpus").alias("project"), F.concat(F.lit("doc-"), "doc_id").alias("filename"),
        F.encode("text", "UTF-8").alias("content"), "doc_id")


def _manifest_entries(spark, d):
    i = F.col("doc_id")
    doc = roles.table(spark, d, "documents").where(i % 11 != 0)
    return doc.select(
        F.lit("corpus").alias("project"), F.concat(F.lit("doc-"), "doc_id").alias("filename"),
        F.when(i % 7 == 0, F.sha2(F.lit("x").cast("binary"), 256)).otherwise(F.sha2(F.encode("text", "UTF-8"), 256)).alias("sha256"),
        (F.octet_length("text") + F.when(i % 5 == 0, 1).otherwise(0)).cast("long").alias("bytes"),
        F.concat(F.lit("2026-01-"), F.lpad((i % 28 + 1).cast("string"), 2, "0")).alias("acquired_at_utc"))


def q_verify_assets(spark, d):
    v = assets.verify_assets(_assets(spark, d), _manifest_entries(spark, d))
    return v.select("filename", "actual_sha256", "actual_bytes", "status")


def q_resolve_assets(spark, d):
    a = _assets(spark, d)
    requests = a.select("project", "filename", F.sha2("content", 256).alias("expected_sha256"))
    user = a.where("doc_id % 3 = 0").withColumn("content", F.when(F.col("doc_id") % 6 == 0, F.lit("spoiled").cast("binary")).otherwise(F.col("content")))
    copies = user.withColumn("tier", F.lit("user-cache")).unionByName(
        a.where("doc_id % 2 = 0").withColumn("tier", F.lit("release-cache"))).unionByName(
        a.where("doc_id % 4 = 1").withColumn("tier", F.lit("package-data")))
    r = assets.resolve_assets(requests, copies.drop("doc_id"), _manifest_entries(spark, d))
    return r.select("filename", "source", "bytes", "acquired_at_utc", "status")


def q_provenance(spark, d):
    v = assets.verify_assets(_assets(spark, d), _manifest_entries(spark, d))
    ready = v.select("filename", F.col("actual_sha256").alias("expected_sha256"), F.col("actual_bytes").alias("bytes"),
                     F.lit("release-cache").alias("source"), "acquired_at_utc", "status")
    return assets.provenance(ready)


def q_manifest_scan(spark, d):
    """Manifest text per document with a repeated entry; the last one wins."""
    m = _manifest_entries(spark, d)
    old = F.struct("project", "filename", F.lit("p").alias("relative_path"), F.lit("old").alias("sha256"), F.lit(1).cast("long").alias("bytes"), "acquired_at_utc")
    new = F.struct("project", "filename", F.lit("p").alias("relative_path"), "sha256", "bytes", "acquired_at_utc")
    files = m.select(F.encode(F.to_json(F.struct(F.array(old, new).alias("entries"))), "UTF-8").alias("content"))
    return assets.parse_manifest(files).drop("relative_path")


def q_run_receipt(spark, d):
    o = roles.table(spark, d, "orders")
    metrics = o.agg(F.count(F.lit(1)).alias("orders"), F.count_distinct("o_custkey").alias("customers"))
    return receipts.run_receipt("order-audit", metrics, q_provenance(spark, d).drop("url"), figure_count=0, offline=True,
                                extra={"status": "CHECKED", "evaluation": "whole tables"})


# --- parsed documents -----------------------------------------------------------------------


def q_catalog_scan(spark, d):
    o = roles.table(spark, d, "orders")
    entry = F.create_map(
        F.lit("cveID"), F.concat(F.lit("CVE-"), F.col("o_orderkey").cast("string")),
        F.lit("shortDescription"), F.concat("o_orderpriority", F.lit(" \"quoted\"")),
        F.lit("dateAdded"), F.date_format("o_orderdate", "yyyy-MM-dd"))
    docs = o.select(F.col("o_orderkey").alias("doc_id"), F.to_json(F.struct(
        F.lit("2026.07").alias("catalogVersion"), F.array(entry).alias("vulnerabilities"))).alias("value"))
    return documents.parse_catalog(docs).drop("entry").withColumn("dateAdded", F.date_format("dateAdded", "yyyy-MM-dd"))


def q_session_log_scan(spark, d):
    """One document per event row: its session, an empty session and a second ignored key."""
    e = roles.honeypot_log(spark, d)
    event = F.struct("eventid", "message", "timestamp", "protocol")
    none = F.array().cast("array<struct<eventid:string,message:string,timestamp:string,protocol:string>>")
    s, i = F.col("session_id"), F.col("pos").cast("string")
    docs = e.select(F.col("pos").alias("doc_id"), F.to_json(F.array(
        F.create_map(F.concat(s, F.lit("-"), i), F.array(event, event), F.lit("ignored"), none),
        F.create_map(F.concat(F.lit("empty-"), i), none))).alias("value"))
    f = sessions.session_features(documents.parse_session_log(docs))
    return f.select("session_id", "event_count", "unique_event_types", "telnet_fraction", "duration_seconds", "login_failed")


def q_session_lines(spark, d):
    """One line per event: its session as a line-delimited log, and lines without an event."""
    e = roles.honeypot_log(spark, d)
    event = F.struct("eventid", "message", "timestamp", "protocol")
    none = F.array().cast("array<struct<eventid:string,message:string,timestamp:string,protocol:string>>")
    i = F.col("pos").cast("string")
    lines = e.select(F.col("pos").alias("doc_id"), F.explode(F.array(
        F.to_json(F.create_map(F.concat("session_id", F.lit("-"), i), F.array(event, event))),
        F.to_json(F.create_map(F.concat(F.lit("empty-"), i), none)), F.lit(" "))).alias("value"))
    f = sessions.session_features(documents.parse_session_lines(lines))
    return f.select("session_id", "event_count", "unique_event_types", "telnet_fraction", "duration_seconds", "login_failed")


def q_bom_scan(spark, d):
    p = roles.spread_table(spark, d, "part")
    ref = lambda n: F.concat(F.lit("p"), n.cast("string"))
    key = F.col("p_partkey")
    comp = lambda r, name, v: F.struct(r.alias("bom-ref"), name.alias("name"), v.alias("version"), F.lit(None).cast("string").alias("purl"), F.lit("library").alias("type"))
    deps = F.array(F.struct(ref(key).alias("ref"), F.array(ref(F.floor(key / 2)), ref(F.floor(key / 3)), ref(F.floor(key / 3))).alias("dependsOn")))
    body = F.struct(
        F.lit("CycloneDX").alias("bomFormat"), F.lit("1.2").alias("specVersion"),
        F.struct(comp(ref(key), F.col("p_name"), F.col("p_size").cast("string")).alias("component")).alias("metadata"),
        F.array(comp(F.concat(ref(key), F.lit("-x")), F.lit(None).cast("string"), F.lit(None).cast("string")),
                comp(F.lit(None).cast("string"), F.lit("no ref"), F.lit("1"))).alias("components"),
        deps.alias("dependencies"))
    nodes, edges = documents.parse_bom(p.select(key.alias("doc_id"), F.to_json(body).alias("value")))
    a = nodes.select("doc_id", F.lit("node").alias("kind"), F.col("node").alias("a"), F.concat_ws("|", "name", "version", "purl", "component_type").alias("b"))
    return a.unionByName(edges.select("doc_id", F.lit("edge").alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b")))


def q_advisory_scan(spark, d):
    p = roles.spread_table(spark, d, "part")
    v = lambda n: F.struct(F.concat(F.lit("ADV-"), n.cast("string")).alias("id"))
    k = F.col("p_partkey")
    hit = F.struct(F.array(v(k % 7), v(k % 3), v(k % 3)).alias("vulns"))
    miss = F.struct(F.lit(None).cast("array<struct<id:string>>").alias("vulns"))
    docs = p.select(k.alias("doc_id"), F.to_json(F.struct(F.array(miss, hit).alias("results"))).alias("value"))
    r = documents.parse_advisories(docs)
    return r.select("doc_id", F.col("pos").cast("long").alias("pos"), F.array_join("ids", ",").alias("ids"))


def q_scorecard_scan(spark, d):
    c = roles.table(spark, d, "customer")
    k = F.col("c_custkey")
    check = lambda n, s: F.struct(F.lit(n).alias("name"), s.cast("int").alias("score"))
    body = F.struct(
        F.when(k % 2 == 0, "2026-07-11").otherwise("2026-07-06T00:00:00Z").alias("date"),
        F.struct(F.concat(F.lit("github.com/org/repo-"), k.cast("string")).alias("name"), F.lit("c0").alias("commit")).alias("repo"),
        F.struct(F.concat(F.lit("e"), (k % 5).cast("string")).alias("commit")).alias("scorecard"),
        F.round("c_acctbal", 1).alias("score"),
        F.array(check("Fuzzing", k % 12 - 1), check("License", k % 11), check("License", k % 4)).alias("checks"))
    rows = documents.parse_scorecards(c.select(k.alias("doc_id"), F.to_json(body).alias("value")))
    m = cohort.mask_matrix(cohort.check_matrix(rows, names=["Fuzzing", "License"], position="pos"), ["Fuzzing", "License"])
    heads = rows.groupBy("repository").agg(
        F.max("scorecard_commit").alias("scorecard_commit"), F.max(F.date_format("scorecard_timestamp", "yyyy-MM-dd")).alias("day"))
    return m.join(heads, "repository")


def q_flow_scan(spark, d):
    li = roles.table(spark, d, "lineitem")
    names = F.array(F.lit("normal"), F.lit(" Neptune"), F.lit("saint"), F.lit("PHF"), F.lit("ps "), F.lit("odd"))
    cells = []
    for c in flows.COLUMNS:
        if c in flows.CATEGORICAL:
            cells.append(F.col("l_returnflag"))
        elif c == "attack_name":
            cells.append(F.get(names, (F.col("l_partkey") % 6).cast("int")))
        elif c.endswith("_rate"):
            cells.append(F.col("l_discount").cast("string"))
        else:
            cells.append(F.col("l_linenumber").cast("string"))
    lines = li.select("l_orderkey", F.concat_ws(",", *cells).alias("value"))
    f = flows.parse_flows(lines)
    return f.groupBy("attack_family", "label", "attack_name", "service").agg(
        F.count(F.lit(1)).alias("n"), F.sum("src_bytes").alias("src_bytes"), F.round(F.sum("serror_rate"), 2).alias("serror_rate"),
        F.sum("difficulty").alias("difficulty"))


def q_bundle_scan(spark, d):
    s = roles.table(spark, d, "supplier")
    k = F.col("s_suppkey").cast("string")
    no = F.lit(None).cast("string")
    thing = lambda t, revoked: F.struct(F.concat(F.lit(f"{t}--"), k).alias("id"), F.lit(t).alias("type"), revoked.alias("revoked"), no.alias("relationship_type"), no.alias("source_ref"), no.alias("target_ref"))
    link = F.struct(F.concat(F.lit("relationship--"), k).alias("id"), F.lit("relationship").alias("type"), F.lit(None).cast("boolean").alias("revoked"),
                    F.lit("targets").alias("relationship_type"), F.concat(F.lit("attack-pattern--"), k).alias("source_ref"),
                    F.concat(F.lit("x-mitre-asset--"), k).alias("target_ref"))
    body = F.struct(F.lit("bundle").alias("type"), F.array(
        thing("attack-pattern", F.lit(True)), thing("attack-pattern", F.col("s_suppkey") % 4 == 0),
        thing("x-mitre-asset", F.col("s_suppkey") % 3 == 0), link, link).alias("objects"))
    objects = documents.parse_bundle(s.select(F.col("s_suppkey").alias("doc_id"), F.to_json(body).alias("value")))
    edges = links.valid_edges(objects).select(F.lit("edge").alias("kind"), "row_id", "col_id")
    kept = links.active(objects).select(F.lit("active").alias("kind"), F.col("id").alias("row_id"), F.col("type").alias("col_id"))
    return edges.unionByName(kept)


QUERIES = {
    "verify_assets": q_verify_assets,
    "resolve_assets": q_resolve_assets,
    "provenance": q_provenance,
    "manifest_scan": q_manifest_scan,
    "run_receipt": q_run_receipt,
    "catalog_scan": q_catalog_scan,
    "session_log_scan": q_session_log_scan,
    "session_lines": q_session_lines,
    "bom_scan": q_bom_scan,
    "advisory_scan": q_advisory_scan,
    "scorecard_scan": q_scorecard_scan,
    "flow_scan": q_flow_scan,
    "bundle_scan": q_bundle_scan,
}

_MANIFEST_SQL = """mf AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN sha256('x') ELSE sha256(text) END AS sha,
  strlen(text) + CASE WHEN doc_id % 5 = 0 THEN 1 ELSE 0 END AS bytes, '2026-01-' || lpad((doc_id % 28 + 1)::VARCHAR, 2, '0') AS acquired_at_utc
  FROM documents WHERE doc_id % 11 <> 0),
st AS (SELECT doc_id, text, acquired_at_utc, CASE WHEN sha IS NULL THEN 'not-in-manifest' WHEN bytes <> strlen(text) OR strlen(text) > 20000000 THEN 'size-mismatch'
  WHEN sha <> sha256(text) THEN 'sha-mismatch' ELSE 'ok' END AS status FROM documents LEFT JOIN mf USING (doc_id))"""

_SOURCES_SQL = f"""{_MANIFEST_SQL},
pv AS (SELECT 'doc-' || doc_id AS file, sha256(text) AS sha256, strlen(text) AS bytes, 'release-cache' AS source, acquired_at_utc FROM st WHERE status = 'ok')"""

ORACLE = {
    "verify_assets": f"WITH {_MANIFEST_SQL} SELECT 'doc-' || doc_id AS filename, sha256(text) AS actual_sha256, strlen(text) AS actual_bytes, status FROM st",
    "resolve_assets": f"""WITH {_MANIFEST_SQL},
pick AS (SELECT doc_id, text, acquired_at_utc, status, CASE WHEN doc_id % 3 = 0 THEN 'user-cache' WHEN doc_id % 11 = 0 THEN NULL
  WHEN doc_id % 2 = 0 THEN 'release-cache' WHEN doc_id % 4 = 1 THEN 'package-data' END AS source FROM st)
SELECT 'doc-' || doc_id AS filename, source,
  CASE WHEN source = 'user-cache' AND doc_id % 6 = 0 THEN 7 WHEN source IS NOT NULL THEN strlen(text) END AS bytes,
  CASE WHEN source <> 'user-cache' THEN acquired_at_utc END AS acquired_at_utc,
  CASE WHEN source IS NULL THEN 'unavailable' WHEN source = 'user-cache' THEN CASE WHEN doc_id % 6 = 0 THEN 'sha-mismatch' ELSE 'ok' END ELSE status END AS status
FROM pick""",
    "provenance": f"WITH {_SOURCES_SQL} SELECT file, sha256, bytes, source, NULL::VARCHAR AS url, acquired_at_utc FROM pv",
    "manifest_scan": f"WITH {_MANIFEST_SQL} SELECT 'corpus' AS project, 'doc-' || doc_id AS filename, sha AS sha256, bytes, acquired_at_utc FROM mf",
    "run_receipt": f"""WITH {_SOURCES_SQL}
SELECT 'order-audit' AS project, 'run' AS part, '{{"project":"order-audit","status":"CHECKED","seed":8414,"metrics":{{"orders":' || (SELECT count(*) FROM orders)
  || ',"customers":' || (SELECT count(DISTINCT o_custkey) FROM orders) || '}},"figure_count":0,"offline":true,"evaluation":"whole tables"}}' AS body
UNION ALL SELECT 'order-audit', 'source', '{{"file":"' || file || '","sha256":"' || sha256 || '","bytes":' || bytes || ',"source":"' || source
  || '","acquired_at_utc":"' || acquired_at_utc || '"}}' FROM pv""",
    "catalog_scan": """SELECT o_orderkey AS doc_id, '2026.07' AS catalog_version, 0 AS pos, 'CVE-' || o_orderkey AS cveID,
  o_orderpriority || ' "quoted"' AS shortDescription, strftime(o_orderdate, '%Y-%m-%d') AS dateAdded FROM orders""",
    "session_log_scan": f"""WITH {roles.LOG_SQL}
SELECT session_id || '-' || pos AS session_id, 2::BIGINT AS event_count, 1::BIGINT AS unique_event_types,
  CASE WHEN protocol = 'telnet' THEN 1.0 ELSE 0.0 END::DOUBLE AS telnet_fraction, 0.0::DOUBLE AS duration_seconds,
  CASE WHEN contains(eventid, 'login.failed') THEN 2 ELSE 0 END AS login_failed FROM log
UNION ALL SELECT 'empty-' || pos, 0, 0, NULL, 0.0, 0 FROM log""",
    "bom_scan": """SELECT p_partkey AS doc_id, 'node' AS kind, 'p' || p_partkey AS a, p_name || '|' || p_size || '||library' AS b FROM part
UNION ALL SELECT p_partkey, 'node', 'p' || p_partkey || '-x', 'p' || p_partkey || '-x|||library' FROM part
UNION ALL SELECT DISTINCT p_partkey, 'edge', 'p' || p_partkey, 'p' || unnest([p_partkey // 2, p_partkey // 3]) FROM part""",
    "advisory_scan": """SELECT p_partkey AS doc_id, 0::BIGINT AS pos, '' AS ids FROM part
UNION ALL SELECT p_partkey, 1, CASE WHEN p_partkey % 7 = p_partkey % 3 THEN 'ADV-' || p_partkey % 7
  ELSE 'ADV-' || least(p_partkey % 7, p_partkey % 3) || ',ADV-' || greatest(p_partkey % 7, p_partkey % 3) END FROM part""",
    "scorecard_scan": """SELECT 'org/repo-' || c_custkey AS repository, CASE WHEN c_custkey % 12 > 0 THEN (c_custkey % 12 - 1)::DOUBLE END AS "Fuzzing",
  (c_custkey % 4)::DOUBLE AS "License", 'e' || c_custkey % 5 AS scorecard_commit,
  CASE WHEN c_custkey % 2 = 0 THEN '2026-07-11' ELSE '2026-07-06' END AS day FROM customer""",
    "flow_scan": """SELECT CASE l_partkey % 6 WHEN 0 THEN 'normal' WHEN 1 THEN 'dos' WHEN 2 THEN 'probe' WHEN 3 THEN 'r2l' WHEN 4 THEN 'u2r' ELSE 'other-attack' END AS attack_family,
  CASE WHEN l_partkey % 6 = 0 THEN 0 ELSE 1 END AS label,
  CASE l_partkey % 6 WHEN 0 THEN 'normal' WHEN 1 THEN 'neptune' WHEN 2 THEN 'saint' WHEN 3 THEN 'phf' WHEN 4 THEN 'ps' ELSE 'odd' END AS attack_name,
  l_returnflag AS service, count(*) AS n, sum(l_linenumber)::BIGINT AS src_bytes, round(sum(l_discount), 2) AS serror_rate, sum(l_linenumber)::BIGINT AS difficulty
FROM lineitem GROUP BY 1, 2, 3, 4""",
    "bundle_scan": """SELECT 'edge' AS kind, 'attack-pattern--' || s_suppkey AS row_id, 'x-mitre-asset--' || s_suppkey AS col_id FROM supplier
  WHERE s_suppkey % 4 <> 0 AND s_suppkey % 3 <> 0
UNION ALL SELECT 'active', 'attack-pattern--' || s_suppkey, 'attack-pattern' FROM supplier WHERE s_suppkey % 4 <> 0
UNION ALL SELECT 'active', 'x-mitre-asset--' || s_suppkey, 'x-mitre-asset' FROM supplier WHERE s_suppkey % 3 <> 0
UNION ALL SELECT 'active', 'relationship--' || s_suppkey, 'relationship' FROM supplier
UNION ALL SELECT 'active', 'relationship--' || s_suppkey, 'relationship' FROM supplier""",
}
#: The same sessions, whichever way they are written.
ORACLE["session_lines"] = ORACLE["session_log_scan"]

import gzip
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from triagelake.operators import cohort, graph, links
from triagelake.sources import assets, documents, flows, receipts


def _write(path, value):
    path.write_text(value if isinstance(value, str) else json.dumps(value), encoding="utf-8")
    return str(path)


def test_manifest_and_verification(spark, tmp_path):
    body = b"catalog bytes"
    entry = {"project": "p", "filename": "a.json", "relative_path": "x/a.json", "sha256": hashlib.sha256(body).hexdigest(), "bytes": len(body), "acquired_at_utc": "t"}
    raw = json.dumps({"entries": [dict(entry, sha256="old"), entry]})
    files = assets.read_binary(spark, _write(tmp_path / "lock.json", raw))
    manifest = assets.parse_manifest(files, hashlib.sha256(raw.encode()).hexdigest())
    assert [r.sha256 for r in manifest.collect()] == [entry["sha256"]]
    with pytest.raises(Exception, match="manifest SHA-256 mismatch"):
        assets.parse_manifest(files, "0" * 64).collect()
    given = spark.createDataFrame([("p", "a.json", bytearray(body)), ("p", "b.json", bytearray(b"x"))], "project string, filename string, content binary")
    assert {r.filename: r.status for r in assets.verify_assets(given, manifest).collect()} == {"a.json": "ok", "b.json": "not-in-manifest"}
    assert assets.verify_assets(given, manifest, max_bytes=3).where("filename = 'a.json'").first().status == "size-mismatch"
    with pytest.raises(Exception, match="asset check failed"):
        assets.verify_assets(given, manifest, strict=True).collect()


def test_first_tier_wins_even_if_spoiled(spark):
    ok = hashlib.sha256(b"right").hexdigest()
    m = spark.createDataFrame([("p", "f", ok, 5, "t")], "project string, filename string, sha256 string, bytes long, acquired_at_utc string")
    copies = spark.createDataFrame([("p", "f", "user-cache", bytearray(b"wrong")), ("p", "f", "release-cache", bytearray(b"right"))],
                                   "project string, filename string, tier string, content binary")
    requests = spark.createDataFrame([("p", "f", ok), ("p", "none", ok)], "project string, filename string, expected_sha256 string")
    got = {r.filename: (r.source, r.status) for r in assets.resolve_assets(requests, copies, m).collect()}
    assert got == {"f": ("user-cache", "sha-mismatch"), "none": (None, "unavailable")}
    later = assets.resolve_assets(requests, copies.where("tier != 'user-cache'"), m)
    assert later.where("filename = 'f'").first().status == "ok" and assets.provenance(later).count() == 1


def test_catalog_file(spark, tmp_path):
    doc = {"catalogVersion": "2026.07.10", "vulnerabilities": [{"cveID": "CVE-1", "dateAdded": "2021-11-03", "shortDescription": "d"}, {"cveID": "CVE-2", "dateAdded": "2022-01-02"}]}
    d = documents.read_documents(spark, _write(tmp_path / "kev.json", doc))
    rows = documents.parse_catalog(d).orderBy("pos").collect()
    assert [r.cveID for r in rows] == ["CVE-1", "CVE-2"] and rows[1].shortDescription is None
    assert str(rows[0].dateAdded) == "2021-11-03 00:00:00"
    assert documents.catalog_version(d).first().catalog_version == "2026.07.10"


def test_gzip_session_log(spark, tmp_path):
    path = tmp_path / "day.json.gz"
    path.write_bytes(gzip.compress(json.dumps([{"s": [{"eventid": "b"}, {"eventid": "a"}]}, {"t": []}]).encode()))
    rows = documents.parse_session_log(documents.read_documents(spark, str(path))).orderBy("session_id", "pos").collect()
    assert [(r.session_id, r.pos, r.eventid) for r in rows] == [("s", 0, "b"), ("s", 1, "a"), ("t", None, None)]


def test_bom_with_unknown_reference_and_repeats(spark, tmp_path):
    doc = {"bomFormat": "CycloneDX", "specVersion": "1.2", "metadata": {"component": {"bom-ref": "root", "name": "app", "type": "application"}},
           "components": [{"bom-ref": "a", "name": "a", "version": "1", "purl": "pkg:x/a@1"}, {"name": "no ref"}],
           "dependencies": [{"ref": "root", "dependsOn": ["a", "ghost", "a"]}, {"ref": "a"}]}
    nodes, edges = documents.parse_bom(documents.read_documents(spark, _write(tmp_path / "bom.json", doc)))
    assert [(r.node, r.pos) for r in nodes.orderBy("pos").collect()] == [("root", 0), ("a", 1)]
    assert edges.count() == 2
    every = graph.with_unresolved(nodes.drop("doc_id", "pos"), edges)
    assert {r.node: r.component_type for r in every.collect()} == {"root": "application", "a": "unknown", "ghost": "unresolved"}
    with pytest.raises(Exception, match="not a valid bill of materials"):
        documents.parse_bom(spark.createDataFrame([("x", '{"components": []}')], "doc_id string, value string"))[0].collect()


def test_scorecards(spark, tmp_path):
    for i, (day, checks) in enumerate([("2026-07-11", [("Fuzzing", -1), ("License", 10)]), ("2026-03-01T00:00:00Z", [("License", 9)])]):
        _write(tmp_path / f"r{i}.json", {"date": day, "repo": {"name": f"github.com/o/r{i}", "commit": "c"}, "scorecard": {"version": "v", "commit": f"e{i}"},
                                         "score": 5.5, "checks": [{"name": n, "score": s, "reason": ""} for n, s in checks]})
    rows = documents.parse_scorecards(documents.read_documents(spark, str(tmp_path)))
    m = {r.repository: r for r in cohort.check_matrix(rows, position="pos").collect()}
    assert m["o/r0"].Fuzzing == -1 and m["o/r1"].Fuzzing is None and m["o/r1"].License == 9
    d = cohort.cohort_drift(rows, "scorecard_timestamp", "scorecard_commit", "score").first()
    assert (d.observation_span_days, d.engine_commits, d.negative_sentinel_count) == (132, 2, 1)
    with pytest.raises(Exception, match="lacks a required key"):
        documents.parse_scorecards(spark.createDataFrame([("x", '{"date": "2026-01-01", "repo": {}}')], "doc_id string, value string")).collect()


def test_flows(spark, tmp_path):
    line = ["0", "tcp", "http", "SF", *["1"] * 37, " Neptune", "21"]
    good = _write(tmp_path / "good.csv", ",".join(line) + "\n")
    r = flows.read_flows(spark, good).first()
    assert (r.attack_name, r.label, r.attack_family, r.difficulty, len(r)) == ("neptune", 1, "dos", 21, 45)
    assert len(flows.FEATURE_COLUMNS) == 41
    bad = _write(tmp_path / "bad.csv", ",".join(["x", *line[1:]]) + "\n")
    with pytest.raises(Exception):
        flows.read_flows(spark, bad).collect()
    with pytest.raises(ValueError, match="expected 2 rows"):
        documents.expect_rows(flows.read_flows(spark, good), 2, "train")


def test_bundle_links(spark, tmp_path):
    t = lambda i, **k: {"id": i, "type": "attack-pattern", **k}
    rel = lambda s, d, kind="targets", **k: {"id": f"r-{s}-{d}-{kind}", "type": "relationship", "relationship_type": kind, "source_ref": s, "target_ref": d, **k}
    doc = {"type": "bundle", "objects": [
        t("t1"), t("t2", revoked=True), t("t3", external_references=[{"source_name": "mitre-attack", "external_id": "T3"}]),
        {"id": "a1", "type": "x-mitre-asset"}, {"id": "m1", "type": "malware"}, {"id": "c1", "type": "course-of-action"},
        rel("t1", "a1"), rel("t1", "a1"), rel("t2", "a1"), rel("t3", "a1", x_mitre_deprecated=True), rel("t3", "m1"),
        rel("m1", "t1", "uses"), rel("m1", "t1", "uses"), rel("c1", "t1", "uses")]}
    objects = documents.parse_bundle(documents.read_documents(spark, _write(tmp_path / "b.json", doc)))
    assert [(r.row_id, r.col_id) for r in links.valid_edges(objects).collect()] == [("t1", "a1")]
    w = {r.id: (r.use_count, round(r.weight, 4)) for r in links.use_weights(objects).collect()}
    assert w == {"t1": (2, 2.0986), "t3": (0, 1.0)}


def test_receipt_rows(spark, tmp_path):
    metrics = spark.sql("select 3 as rows, 0.5D as ap")
    sources = spark.createDataFrame([("a", 1), ("b", 2)], "file string, bytes long")
    rows = receipts.run_receipt("p", metrics, sources, offline=True, extra={"status": "DRY"})
    receipts.write_receipt(rows, str(tmp_path / "receipts"))
    back = spark.read.json(str(tmp_path / "receipts")).collect()
    head = json.loads([r.body for r in back if r.part == "run"][0])
    assert head == {"project": "p", "status": "DRY", "seed": 8414, "metrics": {"rows": 3, "ap": 0.5}, "offline": True}
    assert sorted(json.loads(r.body)["file"] for r in back if r.part == "source") == ["a", "b"]


def test_broken_documents_fail(spark):
    log = '[{"s1": [{"eventid": "a"}]}, {"s2": []}]'
    good = spark.createDataFrame([("d", log)], "doc_id string, value string")
    assert documents.parse_session_log(good).count() == 2
    for text in ("not json", log[:-9], log[:-1], "", "{}"):
        bad = spark.createDataFrame([("d", text)], "doc_id string, value string")
        with pytest.raises(Exception, match="not a valid session log"):
            documents.parse_session_log(bad).collect()
    for more in (log, "," + log, " x", "]", "\n[]"):
        with pytest.raises(Exception, match="not a valid session log"):
            documents.parse_session_log(good.withColumn("value", F.concat("value", F.lit(more)))).collect()
    assert documents.parse_session_log(good.withColumn("value", F.concat(F.lit("\n "), "value", F.lit(" \n")))).count() == 2
    lines = spark.createDataFrame([("d", '{"s1": [{"eventid": "a"}]}'), ("d", ""), ("d", '{"s2": []}')], "doc_id string, value string")
    assert sorted(r.session_id for r in documents.parse_session_lines(lines).collect()) == ["s1", "s2"]
    with pytest.raises(Exception, match="not a valid session line"):
        documents.parse_session_lines(lines.withColumn("value", F.concat("value", F.lit("x{")))).collect()


def test_parent_without_children_is_a_node(spark):
    text = '{"bomFormat": "CycloneDX", "components": [{"bom-ref": "x"}], "dependencies": [{"ref": "ghost", "dependsOn": []}]}'
    nodes, edges = documents.parse_bom(spark.createDataFrame([(1, text)], "doc_id int, value string"))
    assert {(r.node, r.component_type) for r in nodes.collect()} == {("x", "unknown"), ("ghost", "unresolved")}
    assert edges.count() == 0


def test_manifests_are_whole_and_ordered(spark):
    entry = '{"project": "p", "filename": "f", "sha256": "%s", "bytes": 1}'
    rows = [("b", bytearray(('{"entries": [' + entry % "new" + "]}").encode())), ("a", bytearray(('{"entries": [' + ",".join([entry % "old"] * 3) + "]}").encode()))]
    files = spark.createDataFrame(rows, "path string, content binary")
    assert [r.sha256 for r in assets.parse_manifest(files).collect()] == ["new"]
    cut = spark.createDataFrame([("a", rows[0][1][:-4])], "path string, content binary")
    with pytest.raises(Exception, match="not a valid manifest"):
        assets.parse_manifest(cut).collect()


def test_a_bom_is_parsed_once_per_result(spark, tmp_path):
    """No inferred filter and no join parses a text again; a file of one split is dealt out before its documents are built."""
    from triagelake.plans import source_queries

    body = json.dumps({"bomFormat": "CycloneDX", "components": [{"bom-ref": "a", "name": "old"}, {"name": "no ref"}, {"bom-ref": "a", "version": "2"}],
                       "dependencies": [{"ref": "a", "dependsOn": ["b", "b"]}, {"ref": "lone"}, {"ref": ""}, None]})
    bare = json.dumps({"bomFormat": "CycloneDX", "components": []})
    nodes, edges = documents.parse_bom(spark.createDataFrame([("x", body), ("x", body), (None, body), ("y", bare)], "doc_id string, value string"))
    for frame in (nodes, edges):
        assert frame._jdf.queryExecution().optimizedPlan().toString().count("not a valid bill of materials") == 1
    got = sorted((str(r.doc_id), r.node, r.pos, r["name"], r.version, r.component_type) for r in nodes.collect() if r.pos is not None)
    assert got == [("None", "a", 1, "a", "2", "unknown"), ("x", "a", 1, "a", "2", "unknown")]
    loose = sorted((str(r.doc_id), r.node, r["name"], r.component_type) for r in nodes.where("pos IS NULL").collect())
    # Nothing can be looked up in a document without a name, so there even the listed reference counts as unresolved.
    assert loose == [("None", "a", "a", "unresolved"), ("None", "lone", "lone", "unresolved"), ("x", "lone", "lone", "unresolved")]
    assert sorted((str(r.doc_id), r.src, r.dst) for r in edges.collect()) == [("None", "a", "b"), ("x", "a", "b")]
    spark.range(8).selectExpr("id AS p_partkey", "'n' AS p_name", "1 AS p_size").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    plan = source_queries.q_bom_scan(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Repartition ") == plan.count("not a valid bill of materials") == 2

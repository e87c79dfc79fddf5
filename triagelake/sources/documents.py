"""Readers for the JSON documents: each takes rows with one document's text in ``value``.

A document is one row; many documents are parsed in one job. ``doc_id`` (any type) keeps
documents apart. ``read_documents`` makes such rows from files, gzip included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CATALOG_SCHEMA = "catalogVersion string, vulnerabilities array<map<string,string>>"
EVENT = "struct<eventid:string,message:string,timestamp:string,protocol:string>"
COMPONENT = "struct<`bom-ref`:string,name:string,version:string,purl:string,type:string>"
BOM_SCHEMA = (
    "bomFormat string, specVersion string,"
    f"metadata struct<component:{COMPONENT}>,components array<{COMPONENT}>,"
    "dependencies array<struct<ref:string,dependsOn:array<string>>>"
)
ADVISORY_SCHEMA = "results array<struct<vulns:array<struct<id:string,modified:string>>>>"
SCORECARD_SCHEMA = (
    "date string, repo struct<name:string,commit:string>, scorecard struct<version:string,commit:string>,"
    "score double, checks array<struct<name:string,score:double,reason:string>>"
)
OBJECT = (
    "struct<id:string,type:string,name:string,revoked:boolean,x_mitre_deprecated:boolean,"
    "external_references:array<struct<source_name:string,external_id:string>>,"
    "relationship_type:string,source_ref:string,target_ref:string>"
)
BUNDLE_SCHEMA = f"type string, objects array<{OBJECT}>"


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, value): whole files, compressed ones too; the path is the id.

    Gzip files cannot be split; land them once as JSON lines or Parquet for repeated use.
    """
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("doc_id"), "value")


def one_value(text: Column | str) -> Column:
    """Whether ``text`` is one JSON value and nothing else: it fits both as the only item of a list and as a member.

    The built-in parser alone stops behind the first value and would drop the rest.
    """
    c = F.col(text) if isinstance(text, str) else text
    items = F.from_json(F.concat(F.lit("["), c, F.lit("]")), "array<string>")
    member = F.from_json(F.concat(F.lit('{"v":'), c, F.lit(',"z":1}')), "v string, z int")
    return F.coalesce((F.size(items) == 1) & (member["z"] == 1), F.lit(False))


def _parsed(documents: DataFrame, schema: str, required: Column, what: str) -> DataFrame:
    d = documents.select("doc_id", F.from_json("value", schema).alias("d"), one_value("value").alias("_one"))
    checked = F.when(F.col("_one") & required, F.col("d")).otherwise(
        F.raise_error(F.concat(F.lit(f"not a valid {what}: "), F.col("doc_id").cast("string"))))
    return d.select("doc_id", checked.alias("d"))


def parse_catalog(documents: DataFrame, fields: tuple[str, ...] = ("cveID", "shortDescription")) -> DataFrame:
    """Exploited-vulnerability catalog: one row per entry, ``dateAdded`` as a UTC timestamp.

    ``entry`` holds every field of the entry as text; ``fields`` are columns of their own.
    """
    d = _parsed(documents, CATALOG_SCHEMA, F.col("d.vulnerabilities").isNotNull(), "catalog")
    v = d.select("doc_id", F.col("d.catalogVersion").alias("catalog_version"), F.posexplode("d.vulnerabilities").alias("pos", "v"))
    return v.select(
        "doc_id", "catalog_version", "pos", *[F.try_element_at("v", F.lit(f)).alias(f) for f in fields],
        F.try_element_at("v", F.lit("dateAdded")).cast("timestamp").alias("dateAdded"), F.col("v").alias("entry"))


def catalog_version(documents: DataFrame) -> DataFrame:
    """The catalog's version string per document."""
    return documents.select("doc_id", F.get_json_object("value", "$.catalogVersion").alias("catalog_version"))


def parse_session_log(documents: DataFrame) -> DataFrame:
    """Session log: (doc_id, session_id, pos, eventid, message, timestamp, protocol).

    A document is a JSON array of one-key objects; only the first key of an object counts. The
    order in the array is the event order. A session without events keeps one row, ``pos`` NULL.
    """
    log = documents.select("doc_id", "value", F.from_json("value", f"array<map<string,array<{EVENT}>>>").alias("g"))
    # A truncated log parses to its first objects: its text must also close the array it opened.
    whole = F.col("g").isNotNull() & ~F.exists("g", lambda m: m.isNull()) & F.col("value").rlike(r"(?s)^\s*\[.*\]\s*$") & one_value("value")
    checked = F.when(whole, F.col("g")).otherwise(
        F.raise_error(F.concat(F.lit("not a valid session log: "), F.col("doc_id").cast("string"))))
    groups = log.select("doc_id", F.explode(checked).alias("g"))
    return _sessions(groups)


def parse_session_lines(lines: DataFrame) -> DataFrame:
    """As :func:`parse_session_log` for line-delimited logs: a row's ``value`` is one session object.

    Lines are read in parallel (``spark.read.text``), so a large day is not one task; blank lines are skipped.
    """
    log = lines.where(F.trim("value") != "").select(
        "doc_id", F.from_json("value", f"map<string,array<{EVENT}>>").alias("g"), one_value("value").alias("_one"))
    checked = F.when(F.col("_one") & (F.size(F.coalesce(F.map_keys("g"), F.array().cast("array<string>"))) > 0), F.col("g")).otherwise(
        F.raise_error(F.concat(F.lit("not a valid session line: "), F.col("doc_id").cast("string"))))
    return _sessions(log.select("doc_id", checked.alias("g")))


def _sessions(groups: DataFrame) -> DataFrame:
    entry = F.get(F.map_entries("g"), F.lit(0))
    one = groups.select("doc_id", entry["key"].alias("session_id"), entry["value"].alias("events"))
    return one.select("doc_id", "session_id", F.posexplode_outer("events").alias("pos", "e")).select(
        "doc_id", "session_id", "pos", "e.eventid", "e.message", "e.timestamp", "e.protocol")


def parse_bom(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bill of materials: nodes (doc_id, pos, node, name, version, purl, component_type) and edges.

    The root component comes first; components without a reference are left out; the last of
    repeated references wins but keeps the first one's place.
    """
    d = _parsed(documents, BOM_SCHEMA, F.col("d.bomFormat").isNotNull() & F.col("d.components").isNotNull(), "bill of materials")
    listed = F.concat(F.array("d.metadata.component"), F.col("d.components"))
    # References that no component lists take part without a place, so a parent without children is not lost.
    # Without a document's name there is nothing to find a component by: such references stay apart.
    # The outer forms keep the planner from parsing a text once more, to see beforehand whether its lists are empty.
    parts = F.transform(listed, lambda c, i: F.struct(
        c["bom-ref"].alias("node"), i.alias("pos"), c.alias("c"), F.lit(False).alias("apart")))
    refs = F.transform(F.coalesce("d.dependencies", F.array()), lambda p: F.struct(
        p["ref"].alias("node"), F.lit(None).cast("int").alias("pos"), F.lit(None).cast(COMPONENT).alias("c"), F.col("doc_id").isNull().alias("apart")))
    found = d.select("doc_id", F.inline_outer(F.concat(parts, refs))).where("node IS NOT NULL AND node != ''")
    latest = found.groupBy("doc_id", "node", "apart").agg(F.max_by("c", "pos").alias("c"), F.min("pos").alias("pos"))
    kind = F.when(F.col("pos").isNull(), "unresolved").otherwise("unknown")
    nodes = latest.select(
        "doc_id", "pos", "node", F.coalesce("c.name", "node").alias("name"), F.coalesce("c.version", F.lit("")).alias("version"),
        F.coalesce("c.purl", F.lit("")).alias("purl"), F.coalesce("c.type", kind).alias("component_type"))
    deps = d.select("doc_id", F.explode_outer("d.dependencies").alias("p"))
    edges = deps.select("doc_id", F.col("p.ref").alias("src"), F.explode("p.dependsOn").alias("dst")).distinct()
    return nodes, edges


def parse_advisories(documents: DataFrame) -> DataFrame:
    """Advisory batch: (doc_id, pos, ids), one row per result, empty list if there is none."""
    d = _parsed(documents, ADVISORY_SCHEMA, F.col("d.results").isNotNull(), "advisory batch")
    ids = F.array_sort(F.array_distinct(F.transform(F.col("r.vulns"), lambda v: v["id"])))
    return d.select("doc_id", F.posexplode("d.results").alias("pos", "r")).select(
        "doc_id", "pos", F.coalesce(ids, F.array().cast("array<string>")).alias("ids"))


def parse_scorecards(documents: DataFrame) -> DataFrame:
    """Repository checks: one row per (repository, check) with the document's head (A10).

    All five top-level keys must be there; the host prefix of the repository name is removed.
    Repeated checks keep their place in ``pos``.
    """
    have = one_value("value")
    for key in ("date", "repo", "scorecard", "score", "checks"):
        have = have & F.array_contains(F.json_object_keys("value"), key)
    bad = F.raise_error(F.concat(F.lit("scorecard lacks a required key: "), F.col("doc_id").cast("string")))
    d = documents.select("doc_id", F.from_json(F.when(have, F.col("value")).otherwise(bad), SCORECARD_SCHEMA).alias("d"))
    stamp = F.coalesce(F.try_to_timestamp("d.date"), F.try_to_timestamp("d.date", F.lit("yyyy-MM-dd")))
    return d.select(
        "doc_id", F.regexp_replace("d.repo.name", r"^github\.com/", "").alias("repository"),
        F.coalesce("d.repo.commit", F.lit("")).alias("repository_commit"), F.col("d.date").alias("scorecard_date"),
        stamp.alias("scorecard_timestamp"), F.coalesce("d.scorecard.commit", F.lit("")).alias("scorecard_commit"),
        F.col("d.score").alias("overall_score"), F.posexplode_outer("d.checks").alias("pos", "c"),
    ).select("*", F.col("c.name").alias("name"), F.col("c.score").alias("score")).drop("c")


def parse_bundle(documents: DataFrame) -> DataFrame:
    """Threat bundle: one row per object, the last of repeated ids; relations are all kept."""
    d = _parsed(documents, BUNDLE_SCHEMA, (F.col("d.type") == "bundle") & F.col("d.objects").isNotNull(), "bundle")
    o = d.select("doc_id", F.posexplode("d.objects").alias("pos", "o"))
    relation = F.col("o.type") == "relationship"
    things = o.where(~relation & F.col("o.id").isNotNull()).groupBy("doc_id", "o.id").agg(
        F.max_by("o", "pos").alias("o"), F.max("pos").alias("pos"))
    both = o.where(relation).select("doc_id", "pos", "o").unionByName(things.select("doc_id", "pos", "o"))
    return both.select("doc_id", "pos", "o.*")


def expect_rows(df: DataFrame, expected: int, what: str) -> DataFrame:
    """Fail unless ``df`` has the number of rows the caller expects."""
    found = df.count()
    if found != expected:
        raise ValueError(f"{what}: expected {expected} rows, found {found}")
    return df

"""Verified assets: digests, manifest, tier choice and provenance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Tiers in the order they are asked, default size ceiling in bytes.
TIERS = ("user-cache", "release-cache", "package-data")
MAX_BYTES = 20_000_000

MANIFEST_SCHEMA = (
    "entries array<struct<project:string,filename:string,relative_path:string,"
    "sha256:string,bytes:bigint,acquired_at_utc:string>>"
)


def read_binary(spark: SparkSession, path: str) -> DataFrame:
    """Files as (path, content, length); one row per file, read in parallel."""
    return spark.read.format("binaryFile").load(path).select("path", "content", "length")


def digest(assets: DataFrame) -> DataFrame:
    """Replace ``content`` by its SHA-256 and length, so no bytes travel past this point."""
    return assets.withColumns({
        "actual_sha256": F.sha2("content", 256),
        "actual_bytes": F.octet_length("content").cast("long"),
    }).drop("content", "length")


def parse_manifest(files: DataFrame, expected_sha256: str | None = None) -> DataFrame:
    """Manifest entries from manifest files with ``content``; the last repeat of a key, by file path and place, wins (A4).

    A file that does not parse to its end fails the job.

    With ``expected_sha256`` a manifest with other bytes fails the job.
    """
    text = F.col("content").cast("string")
    if expected_sha256 is not None:
        text = F.when(F.sha2("content", 256) == expected_sha256, text).otherwise(
            F.raise_error(F.lit("manifest SHA-256 mismatch")))
    name = F.col("path").cast("string") if "path" in files.columns else F.lit("")
    parsed = F.from_json(text, MANIFEST_SCHEMA)["entries"]
    closed = parsed.isNotNull() & text.rlike(r"(?s)\}\s*$")
    checked = F.when(closed, parsed).otherwise(F.raise_error(F.concat(F.lit("not a valid manifest: "), name)))
    entries = files.select(name.alias("file"), F.posexplode(checked).alias("pos", "e"))
    return entries.groupBy("e.project", "e.filename").agg(F.max_by("e", F.struct("file", "pos")).alias("e")).select("e.*")


def verify_assets(assets: DataFrame, manifest: DataFrame, *, max_bytes: int = MAX_BYTES, strict: bool = False) -> DataFrame:
    """Status of every asset against the manifest: ok or what is wrong (A1).

    ``assets`` has project, filename, content and may have expected_sha256 (a caller's own pin).
    ``strict`` fails the job on the first asset that is not ok.
    """
    found = digest(assets)
    if "expected_sha256" not in found.columns:
        found = found.withColumn("expected_sha256", F.lit(None).cast("string"))
    joined = found.join(manifest.withColumn("_listed", F.lit(True)), ["project", "filename"], "left")
    pinned = F.coalesce("expected_sha256", "sha256")
    status = (
        F.when(F.col("_listed").isNull(), "not-in-manifest")
        .when((F.col("actual_bytes") != F.col("bytes")) | (F.col("actual_bytes") > max_bytes), "size-mismatch")
        .when((F.col("actual_sha256") != pinned) | (F.col("actual_sha256") != F.col("sha256")), "sha-mismatch")
        .otherwise("ok")
    )
    if strict:
        status = F.when(status == "ok", status).otherwise(
            F.raise_error(F.concat(F.lit("asset check failed for "), "filename", F.lit(": "), status)))
    return joined.withColumn("status", status).drop("_listed", "expected_sha256")


def resolve_assets(
    requests: DataFrame, copies: DataFrame, manifest: DataFrame, *, max_bytes: int = MAX_BYTES, strict: bool = False
) -> DataFrame:
    """The copy each request gets: the first tier that has one, checked (A2).

    ``requests``: project, filename, expected_sha256. ``copies``: project, filename, tier,
    content. A copy outside the user cache counts only if the manifest lists it; the user cache
    is checked by digest alone. A bad copy in the first tier fails, later tiers are not tried.
    """
    order = F.array_position(F.array(*[F.lit(t) for t in TIERS]), F.col("tier"))
    listed = digest(copies).join(
        manifest.select("project", "filename", F.col("bytes").alias("_bytes"), F.col("sha256").alias("_sha"), "acquired_at_utc"),
        ["project", "filename"], "left")
    cached = F.col("tier") == TIERS[0]
    usable = listed.where(cached | F.col("_sha").isNotNull())
    first = usable.groupBy("project", "filename").agg(F.min_by(
        F.struct("tier", "actual_sha256", "actual_bytes", "_bytes", "_sha", F.when(~cached, F.col("acquired_at_utc")).alias("acquired_at_utc")),
        order).alias("c"))
    joined = requests.join(first, ["project", "filename"], "left")
    c = F.col("c")
    own = c["tier"] == TIERS[0]
    size_bad = (c["actual_bytes"] != c["_bytes"]) | (c["actual_bytes"] > max_bytes)
    wrong = c["actual_sha256"] != F.col("expected_sha256")
    status = (
        F.when(c.isNull(), "unavailable")
        .when(own & wrong, "sha-mismatch").when(own, "ok")
        .when(size_bad, "size-mismatch")
        .when(wrong | (c["actual_sha256"] != c["_sha"]), "sha-mismatch").otherwise("ok")
    )
    if strict:
        status = F.when(status == "ok", status).otherwise(
            F.raise_error(F.concat(F.lit("no valid copy of "), "filename", F.lit(": "), status)))
    return joined.select(
        "project", "filename", "expected_sha256", c["tier"].alias("source"), c["actual_bytes"].alias("bytes"),
        c["acquired_at_utc"].alias("acquired_at_utc"), status.alias("status"))


def provenance(resolved: DataFrame, url: str | None = None) -> DataFrame:
    """One provenance row per asset that passed (A3)."""
    return resolved.where("status = 'ok'").select(
        F.col("filename").alias("file"), F.col("expected_sha256").alias("sha256"), "bytes", "source",
        F.lit(url).cast("string").alias("url"), "acquired_at_utc")

"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: str | int = "*", app: str = "triagelake", **extra: str) -> SparkSession:
    """A local session for tests and the bench; on a cluster use the one you are given."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point checkpoints at the folder the cluster names; fall back only in local mode."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        context.setCheckpointDir(named)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="triagelake-checkpoints-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")


def ship_package(spark: SparkSession) -> None:
    """Send this package to executors whose Python does not have it (a wheel or PYTHONPATH does the same)."""
    import shutil
    from pathlib import Path

    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="triagelake-package-")) / "triagelake"
    spark.sparkContext.addPyFile(shutil.make_archive(str(target), "zip", root.parent, root.name))

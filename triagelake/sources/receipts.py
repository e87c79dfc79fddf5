"""Run receipts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagelake import SEED


def run_receipt(
    project: str, metrics: DataFrame, sources: DataFrame, *, seed: int = SEED, status: str = "COMPLETE",
    figure_count: int | None = None, offline: bool | None = None, extra: dict[str, object] | None = None,
) -> DataFrame:
    """Receipt rows (project, part, body): one head with the metrics, one row per source.

    ``metrics`` is a one-row table. Keys in ``extra`` replace earlier ones. Sources stay rows of
    their own, so a run over very many files never gathers them in one value.
    """
    body: dict[str, Column] = {
        "project": F.lit(project), "status": F.lit(status), "seed": F.lit(seed),
        "metrics": F.struct(*metrics.columns),
    }
    if figure_count is not None:
        body["figure_count"] = F.lit(figure_count)
    if offline is not None:
        body["offline"] = F.lit(offline)
    body.update({k: v if isinstance(v, Column) else F.lit(v) for k, v in (extra or {}).items()})
    head = metrics.select(F.to_json(F.struct(*[c.alias(k) for k, c in body.items()])).alias("body"))
    rows = head.select(F.lit("run").alias("part"), "body").unionByName(
        sources.select(F.lit("source").alias("part"), F.to_json(F.struct(*sources.columns)).alias("body")))
    return rows.select(F.lit(project).alias("project"), "part", "body")


def write_receipt(receipt: DataFrame, path: str) -> None:
    """Append the receipt to a JSON folder."""
    receipt.write.mode("append").json(path)

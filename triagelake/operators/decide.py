"""Decisions: recall at review budgets, argmax choice, proxy check, paired bootstrap gate."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from triagelake import SEED
from triagelake.core import cut, det_rand, number_rows, shuffle_partitions, value_buckets
from triagelake.operators.metrics import ranking_metrics

# Default review budgets.
UTILITY_BUDGETS = (0.02, 0.05, 0.10, 0.20)
CURVE_BUDGETS = (0.01, 0.02, 0.05, 0.10, 0.15, 0.20)

# The sentence that explains a decision.
WHY = (
    "Winner: '%s' queue — mean recall %.3f vs %.3f (+%.3f) over budgets (%s), "
    "measured against the held-out '%s' outcome the scoring rule did not author."
)


def budget_rows(total: int, budget: float) -> int:
    """Review slots a budget buys: at least one, else rounded up."""
    return max(1, math.ceil(total * budget))


def ranked_queues(
    frame: DataFrame, id_col: str, queues: Mapping[str, str], carry: Sequence[str] = ()
) -> tuple[DataFrame, int]:
    """Rank of every row in every queue: (queue_no, id, rank, carry...) and the row count.

    All queues are ranked by one range-partitioned sort. Higher scores first, NULL scores last,
    the lower id wins ties, so no score level is ever gathered in one task.
    """
    arms = F.array(*[
        F.struct(F.lit(i).alias("queue_no"), F.col(c).cast("double").alias("score"))
        for i, c in enumerate(queues.values())
    ])
    long = frame.select(id_col, *carry, F.inline(arms))
    clean = long.withColumn("score", F.nanvl("score", F.lit(None).cast("double")))
    numbered, rows = number_rows(
        clean, [F.col("queue_no").asc(), F.col("score").desc_nulls_last(), F.col(id_col).asc()]
    )
    total = rows // max(1, len(queues))
    ranked = numbered.withColumn("rank", F.col("row_no") - F.col("queue_no") * F.lit(total) + 1)
    return ranked.drop("row_no"), total


def top_budget(frame: DataFrame, id_col: str, score: str, budget: float) -> DataFrame:
    """The rows a review budget selects."""
    ranked, total = ranked_queues(frame, id_col, {"queue": score})
    return ranked.where(F.col("rank") <= budget_rows(total, budget)).select(id_col, "score", "rank")


def recall_at_budget(
    frame: DataFrame, id_col: str, proxy: str, queues: Mapping[str, str], budgets: Sequence[float]
) -> DataFrame:
    """Share of positives found in each queue's top rows, per budget: (queue, budget, recall) (F1).

    One sort for all queues, then one aggregate with a conditional sum per budget.
    """
    ranked, total = ranked_queues(frame, id_col, queues, [proxy])
    hits = [
        F.sum(F.when(F.col("rank") <= budget_rows(total, b), F.col(proxy)).otherwise(0)).alias(f"_h{i}")
        for i, b in enumerate(budgets)
    ]
    sums = ranked.groupBy("queue_no").agg(F.sum(proxy).alias("_pos"), *hits)
    names = F.array(*[F.lit(q) for q in queues])
    cells = F.array(*[
        F.struct(
            F.lit(float(b)).alias("budget"),
            (F.col(f"_h{i}") / F.greatest(F.col("_pos"), F.lit(1))).cast("double").alias("recall"),
        )
        for i, b in enumerate(budgets)
    ])
    return sums.select(
        "queue_no", F.get(names, F.col("queue_no")).alias("queue"), F.inline(cells)
    )


def budget_curve(
    frame: DataFrame, id_col: str, proxy: str, queues: Mapping[str, str],
    curve_budgets: Sequence[float] = CURVE_BUDGETS,
) -> DataFrame:
    """Recall of every queue at every curve budget (F2)."""
    return recall_at_budget(frame, id_col, proxy, queues, curve_budgets).drop("queue_no")


def decide_by_argmax(
    frame: DataFrame,
    id_col: str,
    *,
    proxy: str,
    queues: Mapping[str, str],
    utility_budgets: Sequence[float] = UTILITY_BUDGETS,
) -> DataFrame:
    """Mean recall per queue and the winner, first of equals in the given order.

    One row per queue: (queue, queue_no, score_column, utility, place, is_winner, why).
    ``place`` orders by utility, ``why`` is the same computed sentence on every row.
    """
    recalls = recall_at_budget(frame, id_col, proxy, queues, utility_budgets)
    utilities = recalls.groupBy("queue", "queue_no").agg(F.avg("recall").alias("utility"))
    # One row per queue from here on: a window over a handful of rows.
    one = Window.partitionBy(F.lit(0)).orderBy(F.col("utility").desc(), F.col("queue_no"))
    everything = one.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = utilities.select(
        "*",
        F.row_number().over(one).alias("place"),
        F.first("queue").over(everything).alias("_lead"),
        F.first("utility").over(everything).alias("_u1"),
        F.coalesce(F.nth_value("utility", 2).over(everything), F.first("utility").over(everything)).alias("_u2"),
    )
    budgets = ", ".join(str(b) for b in utility_budgets) + ("," if len(utility_budgets) == 1 else "")
    why = F.format_string(WHY, "_lead", "_u1", "_u2", F.col("_u1") - F.col("_u2"), F.lit(budgets), F.lit(proxy))
    columns = F.array(*[F.lit(c) for c in queues.values()])
    return placed.select(
        "queue", "queue_no", F.get(columns, F.col("queue_no")).alias("score_column"), "utility", "place",
        (F.col("place") == 1).alias("is_winner"), why.alias("why"),
    )


def selected_scores(frame: DataFrame, id_col: str, decision: DataFrame) -> DataFrame:
    """The winning queue's score per row, chosen by the decision table."""
    names = [r["score_column"] for r in decision.where("is_winner").select("score_column").collect()]
    return frame.select(id_col, F.col(names[0]).alias("score"))


def decision_receipt(decision: DataFrame, proxy: str, utility_budgets: Sequence[float] = UTILITY_BUDGETS) -> DataFrame:
    """One JSON row: proxy, recommended queue, budgets and a rounded utility per queue."""
    body = decision.groupBy().agg(
        F.max(F.when(F.col("is_winner"), F.col("queue"))).alias("recommended_queue"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(
            F.concat("queue", F.lit("_queue_utility")), F.round("utility", 4)
        )))).alias("utilities"),
    )
    head = F.struct(
        F.lit(proxy).alias("proxy"), "recommended_queue",
        F.array(*[F.lit(float(b)) for b in utility_budgets]).alias("utility_budgets"),
    )
    return body.select(F.to_json(head).alias("receipt"), F.to_json("utilities").alias("utilities"))


def proxy_independence(frame: DataFrame, proxy: str, score: str) -> DataFrame:
    """Is some score level mixed in the outcome, and how correlated are both.

    One row (non_monotone, correlation). Rows of a score level are combined before the shuffle,
    so a level with very many rows stays cheap; the correlation is a plain aggregate.
    """
    s, y = F.col("score"), F.col("y")
    rows = frame.select(F.nanvl(F.col(score).cast("double"), F.lit(None)).alias("score"),
                        F.col(proxy).cast("double").alias("y"))
    levels = rows.groupBy("score").agg(F.avg("y").alias("mean"))
    mixed = levels.where("score IS NOT NULL").agg(
        F.coalesce(F.max((F.col("mean") > 0) & (F.col("mean") < 1)), F.lit(False)).alias("non_monotone")
    )
    corr = rows.agg(F.corr(s, y).alias("correlation"))
    return corr.select(
        mixed.select("non_monotone").scalar().alias("non_monotone"),
        F.round("correlation", 4).alias("correlation"),
    )


def bootstrap_draws(rows: DataFrame, id_col: str, label: str, n: int, seed: int) -> DataFrame:
    """The replicates that draw each row, a replicate as often as it does: (id, _y, _slot, reps).

    Positives and negatives are resampled apart, each with as many draws as rows. Draws are made
    where they are needed, from the row numbers, in even tasks; one shuffle takes them to the rows drawn.
    """
    numbered, _ = number_rows(
        rows.select(id_col, F.col(label).alias("_y")), [F.col("_y").asc(), F.col(id_col).asc()]
    )
    spans = numbered.groupBy("_y").agg(F.count(F.lit(1)).alias("_size"), F.min("row_no").alias("_first"))
    # Two rows (label 0 and 1), so the hint is safe.
    slots = cut(numbered.join(F.broadcast(spans), "_y").select(
        id_col, "_y", "_size", (F.col("row_no") - F.col("_first")).alias("_slot")
    ).repartition(even_tasks(rows), "_y", "_slot"))
    draws = slots.select(
        "_y", "_size", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("rep"), "_slot"
    ).select(
        "_y", F.col("rep").cast("short").alias("rep") if n <= 1 << 15 else "rep",
        F.floor(det_rand(seed, "rep", "_y", "_slot") * F.col("_size")).alias("_slot"),
    )
    drawn = draws.groupBy("_y", "_slot").agg(F.collect_list("rep").alias("reps"))
    return drawn.join(slots, ["_y", "_slot"]).select(id_col, "_y", "_slot", "reps")


def bootstrap_weights(rows: DataFrame, id_col: str, label: str, n: int, seed: int) -> DataFrame:
    """How often each row is drawn in each stratified replicate: (rep, id, weight)."""
    drawn = bootstrap_draws(rows, id_col, label, n, seed).select(
        id_col, "_y", "_slot", F.explode("reps").alias("rep")).withColumn("rep", F.col("rep").cast("int"))
    return drawn.groupBy("rep", "_y", "_slot", id_col).agg(F.count(F.lit(1)).alias("weight")).select("rep", id_col, "weight")


def poisson_count(u):
    """Poisson(1) count from one uniform number, by its distribution function.

    The number is a multiple of 2^-52, so counts of up to 18 occur, each with its own chance.
    """
    steps, cdf, term, k = [], 0.0, math.exp(-1.0), 0
    while cdf + term <= 1.0 - 2.0**-52 and term >= 2.0**-53:
        cdf, k = cdf + term, k + 1
        steps.append(F.when(u >= F.lit(cdf), 1).otherwise(0))
        term /= k
    out = steps[0]
    for s in steps[1:]:
        out = out + s
    return out


def poisson_weight(seed: int, *keys: str):
    """:func:`poisson_count` of one deterministic uniform number per combination of the keys."""
    return poisson_count(det_rand(seed, *keys))


def even_tasks(rows: DataFrame) -> int:
    """Tasks for work that is far larger than its rows: as a number given to repartition, AQE does not merge them."""
    return max(shuffle_partitions(rows), rows.sparkSession.sparkContext.defaultParallelism)


def paired_differences(
    rows: DataFrame, id_col: str, advanced: str, baseline: str, label: str, *,
    n: int = 500, seed: int = SEED, metric: str = "ap", weights: str = "stratified",
) -> DataFrame:
    """metric(advanced) - metric(baseline) of every replicate: (rep, difference).

    ``weights="stratified"`` draws whole strata; ``"poisson"`` gives every row an independent
    Poisson(1) count, which needs no shuffle of draws. Either way a row's replicates are one array, made
    once for both scores in tasks of even size; rows go to their score bucket with it, and it is opened there.
    """
    measure = {"ap": "average_precision", "roc_auc": "roc_auc"}[metric]
    arms = F.inline(F.array(
        F.struct(F.lit("a").alias("arm"), F.col("_a").alias("score")), F.struct(F.lit("b").alias("arm"), F.col("_b").alias("score")),
    ))
    plain = rows.select(
        F.col(id_col).alias("_id"), F.col(label).alias("y"), F.col(advanced).cast("double").alias("_a"), F.col(baseline).cast("double").alias("_b"))
    if weights == "poisson":
        numbers = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda rep: det_rand(seed, rep, "_id"))
        drawn = cut(plain.repartition(even_tasks(rows), "_id").withColumn("reps", F.flatten(F.transform(
            numbers, lambda u, rep: F.array_repeat(rep, poisson_count(u))))))
    else:
        w = bootstrap_draws(rows, id_col, label, n, seed).select(F.col(id_col).alias("_id"), "reps")
        drawn = cut(plain.join(w, "_id"))
    base = value_buckets(drawn.select("y", "reps", arms), "score", like=plain.select(arms))
    placed = base.repartition(even_tasks(rows), "arm", "_bucket")
    replicated = placed.select("arm", "score", "y", "_bucket", F.explode("reps").alias("rep")).withColumn("rep", F.col("rep").cast("int"))
    metrics = ranking_metrics(replicated, ["arm", "rep"], "score", "y", bucket="_bucket")
    return metrics.groupBy("rep").agg(
        (F.max(F.when(F.col("arm") == "a", F.col(measure)))
         - F.max(F.when(F.col("arm") == "b", F.col(measure)))).alias("difference")
    )


def paired_bootstrap_gate(rows: DataFrame, id_col: str, advanced: str, baseline: str, label: str, **options) -> DataFrame:
    """One row (median, p10, p90, adopt): adopt only if the p10 difference is above zero."""
    diffs = paired_differences(rows, id_col, advanced, baseline, label, **options)
    # One row per replicate: the built-in exact percentile is fine here.
    return diffs.agg(
        F.percentile("difference", F.lit(0.5)).alias("median"),
        F.percentile("difference", F.lit(0.1)).alias("p10"),
        F.percentile("difference", F.lit(0.9)).alias("p90"),
    ).withColumn("adopt", F.coalesce(F.col("p10") > 0, F.lit(False)))

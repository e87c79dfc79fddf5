import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from triagelake.operators import decide, metrics


@pytest.fixture(scope="module")
def frame(spark):
    i = np.arange(366)
    outcome = (i % 6 == 1).astype(int)
    pdf = pd.DataFrame({"id": i, "outcome": outcome, "good": outcome * 2 + i * 37 % 101 / 100, "bad": i * 53 % 97 / 97})
    return pdf, spark.createDataFrame(pdf).repartition(6)


def _recall(pdf, score, budget):
    k = max(1, int(np.ceil(len(pdf) * budget)))
    top = pdf.sort_values([score, "id"], ascending=[False, True], na_position="last").head(k)
    return top["outcome"].sum() / max(1, pdf["outcome"].sum())


def test_better_queue_wins_and_swapping_flips(frame):
    pdf, df = frame
    rows = decide.decide_by_argmax(df, "id", proxy="outcome", queues={"good": "good", "bad": "bad"}).collect()
    got = {r.queue: r for r in rows}
    assert got["good"].is_winner and not got["bad"].is_winner
    for q in ("good", "bad"):
        assert got[q].utility == pytest.approx(np.mean([_recall(pdf, q, b) for b in decide.UTILITY_BUDGETS]))
    assert "mean recall" in got["good"].why and "'good' queue" in got["good"].why
    swapped = decide.decide_by_argmax(df, "id", proxy="outcome", queues={"good": "bad", "bad": "good"})
    assert swapped.where("is_winner").first().queue == "bad"
    chosen = decide.selected_scores(df, "id", swapped).orderBy("id").toPandas()["score"]
    assert np.allclose(chosen, pdf["good"])
    body = decide.decision_receipt(swapped, "outcome").first()
    assert '"recommended_queue":"bad"' in body.receipt and '"good_queue_utility":0.' in body.utilities


def test_published_example(spark):
    """Mean recalls 0.457 and 0.071 of the published decision example, on the data that it draws."""
    rng = np.random.default_rng(0)
    y = (rng.random(400) < 0.2).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"id": range(400), "y": y, "good": y * 3 + rng.random(400), "bad": rng.random(400)}))
    got = {r.queue: round(r.utility, 3) for r in decide.decide_by_argmax(df, "id", proxy="y", queues={"good": "good", "bad": "bad"}).collect()}
    assert got == {"good": 0.457, "bad": 0.071}


def test_first_of_equal_queues_wins(frame):
    _, df = frame
    rows = decide.decide_by_argmax(df, "id", proxy="outcome", queues={"z": "good", "a": "good"})
    assert rows.where("is_winner").first().queue == "z"


def test_ties_by_id_and_nulls_last(spark):
    pdf = pd.DataFrame({"id": range(10), "s": [1.0, None, 2.0, 2.0, 2.0, None, 0.0, 2.0, float("nan"), 1.0], "outcome": [1] * 10})
    df = spark.createDataFrame(pdf.astype({"s": object}).where(pdf.s.notna(), None), "id long, s double, outcome long")
    assert [r.id for r in decide.top_budget(df, "id", "s", 0.3).orderBy("rank").collect()] == [2, 3, 4]
    assert decide.top_budget(df, "id", "s", 1.0).count() == 10


def test_no_positives_gives_zero(spark):
    df = spark.range(20).select("id", F.lit(0).alias("y"), F.col("id").alias("s"))
    assert all(r.recall == 0.0 for r in decide.budget_curve(df, "id", "y", {"q": "s"}).collect())


def test_proxy_independence(spark):
    i = np.arange(560)
    pdf = pd.DataFrame({"level": (i % 7).astype(float), "cut": (i % 7 >= 4).astype(int), "spread": (i // 7 % 4 == 0).astype(int)})
    df = spark.createDataFrame(pdf)
    cut, spread = (decide.proxy_independence(df, p, "level").first() for p in ("cut", "spread"))
    assert not cut.non_monotone and cut.correlation == pytest.approx(np.corrcoef(pdf.level, pdf.cut)[0, 1], abs=1e-4)
    assert spread.non_monotone and spread.correlation == 0.0


def _ap(y, s, w):
    order = np.unique(s)[::-1]
    tp = fp = last = out = 0.0
    total = (y * w).sum()
    for v in order:
        at = s == v
        tp += (y * w)[at].sum()
        fp += ((1 - y) * w)[at].sum()
        if tp + fp:
            out += (tp - last) / total * tp / (tp + fp)
        last = tp
    return out


def _auc(y, s, w):
    p, n = y == 1, y == 0
    more = (s[p][:, None] > s[n][None, :]) + 0.5 * (s[p][:, None] == s[n][None, :])
    weight = w[p][:, None] * w[n][None, :]
    return (more * weight).sum() / weight.sum()


def test_ranking_metrics_with_ties_and_weights(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"k": np.repeat([0, 1], 200), "y": rng.integers(0, 2, 400), "s": rng.integers(0, 15, 400) / 3, "w": rng.integers(0, 3, 400)})
    got = metrics.ranking_metrics(spark.createDataFrame(pdf), ["k"], "s", "y", weight="w").collect()
    for r in got:
        part = pdf[pdf.k == r.k]
        y, s, w = (part[c].to_numpy().astype(float) for c in "ysw")
        assert r.average_precision == pytest.approx(_ap(y, s, w))
        assert r.roc_auc == pytest.approx(_auc(y, s, w))


def test_one_class_metrics_are_null(spark):
    df = spark.range(10).select(F.lit(0).alias("k"), F.col("id").cast("double").alias("s"), F.lit(0).alias("y"))
    r = metrics.ranking_metrics(df, ["k"], "s", "y").first()
    assert r.average_precision is None and r.roc_auc is None


@pytest.mark.parametrize("how", ["stratified", "poisson"])
@pytest.mark.parametrize("metric", ["ap", "roc_auc"])
def test_bootstrap_gate(spark, how, metric):
    i = np.arange(252)
    y = (i % 3 == 0).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"id": i, "y": y, "adv": y * 0.6 + i * 29 % 83 / 83, "base": i * 61 % 89 / 89}))
    g = decide.paired_bootstrap_gate(df, "id", "adv", "base", "y", n=25, seed=1, metric=metric, weights=how).first()
    assert g.p10 <= g.median <= g.p90 and g.adopt is True
    worse = decide.paired_bootstrap_gate(df, "id", "base", "adv", "y", n=25, seed=1, metric=metric, weights=how).first()
    assert worse.adopt is False


def test_bootstrap_draws_whole_strata(spark):
    df = spark.range(90).select("id", (F.col("id") % 3 == 0).cast("int").alias("y"))
    w = decide.bootstrap_weights(df, "id", "y", 4, 7).join(df, "id").groupBy("rep", "y").agg(F.sum("weight").alias("n")).collect()
    assert {(r.rep, r.y): r.n for r in w} == {(rep, y): 30 if y else 60 for rep in range(4) for y in (0, 1)}


def test_folds_are_even_in_each_class(spark):
    df = spark.range(103).select("id", (F.col("id") % 4 == 0).cast("int").alias("y"))
    sizes = metrics.stratified_folds(df, "id", "y").groupBy("y", "fold").count().toPandas()
    for _, part in sizes.groupby("y"):
        assert len(part) == 5 and part["count"].max() - part["count"].min() <= 1


def test_adjusted_rand(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 1), (1, 2)], "a int, b int")
    assert metrics.adjusted_rand(df, [], "a", "b").first().ari == pytest.approx(0.5714285714)
    same = spark.range(5).select(F.lit(1).alias("a"), F.lit(2).alias("b"))
    assert metrics.adjusted_rand(same, [], "a", "b").first().ari == 1.0


@pytest.mark.parametrize("how", ["stratified", "poisson"])
def test_replicates_are_drawn_once_for_both_scores(spark, how):
    """The differences are those of the drawn weights, and no hash number is made again behind the score buckets."""
    i = np.arange(120)
    pdf = pd.DataFrame({"id": i, "y": (i % 3 == 0).astype(int), "adv": i * 29 % 17 / 17, "base": i * 61 % 89 / 89})
    df = spark.createDataFrame(pdf)
    got = decide.paired_differences(df, "id", "adv", "base", "y", n=6, seed=3, weights=how)
    assert "md5" not in got._jdf.queryExecution().executedPlan().toString()
    if how == "poisson":
        weight = decide.poisson_weight(3, "rep", "id")
        drawn = df.select("id", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("rep")).select("id", "rep", weight.alias("weight"))
    else:
        drawn = decide.bootstrap_weights(df, "id", "y", 6, 3)
    w = drawn.toPandas().pivot(index="id", columns="rep", values="weight").reindex(i).fillna(0)
    y, adv, base = pdf.y.to_numpy(), pdf.adv.to_numpy(), pdf.base.to_numpy()
    for r in got.collect():
        weights = w[r.rep].to_numpy()
        assert r.difference == pytest.approx(_ap(y, adv, weights) - _ap(y, base, weights))

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators.cost import THRESHOLDS, business_cost, class_weight, cost_curve, cost_optimal
from tidemark.operators.ordered import exact_quantiles, running_totals
from tidemark.operators.profile import describe, latency_summary, rate_by_month
from tidemark.operators.ranking import confusion, evaluate


def scored(spark, y, s, amt=None):
    amt = np.ones(len(y)) if amt is None else amt
    rows = [(int(a), float(b), float(c)) for a, b, c in zip(y, s, amt)]
    return spark.createDataFrame(rows, "is_fraud int, score double, amt double")


def slow_metrics(y, s):
    y, s = np.asarray(y), np.asarray(s)
    pos, neg = (y == 1).sum(), (y == 0).sum()
    ap, recall_before, best = 0.0, 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        tp, fp = ((s >= t) & (y == 1)).sum(), ((s >= t) & (y == 0)).sum()
        ap += (tp / pos - recall_before) * tp / (tp + fp)
        recall_before = tp / pos
        if fp / neg <= 0.01:
            best = max(best, tp / pos)
    wins = (s[y == 1][:, None] > s[y == 0][None, :]).sum() + 0.5 * (s[y == 1][:, None] == s[y == 0][None, :]).sum()
    return ap, wins / (pos * neg), best


def test_perfect_ranking(spark):
    row = evaluate(scored(spark, [0, 0, 0, 0, 1, 1], [0.1, 0.2, 0.3, 0.35, 0.8, 0.9])).first()
    for name in ("pr_auc", "roc_auc", "recall_at_1pct_fpr", "precision", "recall", "f1"):
        assert row[name] == 1.0
    assert row["pr_auc_lift"] == pytest.approx(3)


@pytest.mark.parametrize("seed,digits", [(0, 6), (1, 2), (2, 1)])
def test_against_the_definitions_with_ties(spark, seed, digits):
    rng = np.random.default_rng(seed)
    y = (rng.random(1500) < 0.1).astype(int)
    s = np.round(np.clip(rng.normal(0.3 + 0.2 * y, 0.2), 0, 1), digits)
    row = evaluate(scored(spark, y, s)).first()
    assert (row["pr_auc"], row["roc_auc"], row["recall_at_1pct_fpr"]) == pytest.approx(slow_metrics(y, s), abs=1e-12)


def test_random_scores_find_the_base_rate(spark):
    df = spark.range(200_000).select(
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100)) == 0).cast("int").alias("is_fraud"),
        (F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1 << 30)) / float(1 << 30)).alias("score"),
    )
    row = evaluate(df).first()
    assert row["pr_auc"] == pytest.approx(row["base_rate"], abs=0.005)
    assert row["recall_at_1pct_fpr"] <= 0.03


def test_group_without_positives_has_null_ranking_metrics(spark):
    df = scored(spark, [0, 0, 1, 0], [0.1, 0.9, 0.8, 0.2]).withColumn("g", F.when(F.col("score") > 0.5, "a").otherwise("b"))
    rows = {r["g"]: r for r in evaluate(df, by=["g"]).collect()}
    assert rows["b"]["pr_auc"] is None and rows["b"]["roc_auc"] is None and rows["b"]["precision"] == 0.0
    assert rows["a"]["pr_auc"] == pytest.approx(0.5)


def test_nothing_flagged(spark):
    row = evaluate(scored(spark, [0, 1], [0.1, 0.2]), threshold=0.99).first()
    assert (row["precision"], row["recall"], row["f1"]) == (0, 0, 0)
    assert tuple(confusion(scored(spark, [0, 1], [0.1, 0.2]), 0.15).first()) == (1, 0, 0, 1)


def test_business_cost_example(spark):
    df = scored(spark, [1, 1, 0, 0], [0.9, 0.1, 0.8, 0.2], [500, 300, 50, 60])
    row = business_cost(df, 0.5).first()
    assert tuple(row) == (800, 300, 10, 310)


def test_cost_curve_against_a_loop(spark):
    rng = np.random.default_rng(5)
    y = (rng.random(800) < 0.2).astype(int)
    s = np.round(np.clip(rng.normal(0.3 + 0.3 * y, 0.2), 0, 1), 2)
    amt = np.round(rng.gamma(2, 40, 800), 2)
    curve = {r["threshold"]: r for r in cost_curve(scored(spark, y, s, amt)).collect()}
    want = [amt[(y == 1) & (s < t)].sum() + 10 * ((y == 0) & (s >= t)).sum() for t in THRESHOLDS]
    assert [curve[t]["total_cost"] for t in THRESHOLDS] == pytest.approx(want)
    best = cost_optimal(scored(spark, y, s, amt)).first()
    assert best["threshold"] == THRESHOLDS[int(np.argmin(want))]


def test_dearer_false_alarms_raise_the_threshold(spark):
    y = [0] * 100 + [1] * 10
    s = list(np.linspace(0, 0.6, 100)) + list(np.linspace(0.4, 0.9, 10))
    best = {r["fp_cost"]: r["threshold"] for r in cost_optimal(scored(spark, y, s, [100.0] * 110), [1.0, 100.0]).collect()}
    assert best[1.0] < best[100.0]


def test_first_of_equal_thresholds_wins(spark):
    best = cost_optimal(scored(spark, [0, 1], [0.105, 0.505], [1, 100])).first()
    assert best["threshold"] == pytest.approx(0.11) and best["total_cost"] == 0


def test_class_weight(spark):
    assert class_weight(scored(spark, [0, 0, 0, 1], [0, 0, 0, 0])).first()[0] == 3


def test_quantiles_and_ranks(spark):
    values = np.random.default_rng(3).integers(0, 50, 333).astype(float)
    df = spark.createDataFrame([(float(v), "g") for v in values], "v double, g string")
    got = exact_quantiles(df, "v", {"a": 0.25, "b": 0.5, "c": 0.99}, ["g"]).first()
    assert tuple(got)[1:] == pytest.approx(tuple(np.quantile(values, [0.25, 0.5, 0.99])))
    order = np.sort(values)
    row = latency_summary(df, "v").first()
    assert (row["p50"], row["p99"]) == (order[333 // 2], order[int(333 * 0.99) - 1])
    one = describe(spark.createDataFrame([(7.0,)], "v double"), "v").first()
    assert (one["p25"], one["p50"], one["max"], one["std"]) == (7, 7, 7, None)


def test_running_totals_along_many_bins(spark):
    df = spark.range(1000).select((F.col("id") % 97).cast("double").alias("v"))
    rows = sorted(running_totals(df, "v", {"n": F.count(F.lit(1))}).collect(), key=lambda r: r["v"])
    assert [r["run_n"] for r in rows] == list(np.cumsum([r["n"] for r in rows]))
    assert [r["next_value"] for r in rows] == [*range(1, 97), None]
    assert {r["all_n"] for r in rows} == {1000}


def test_missing_months_appear(spark):
    df = spark.sql("select timestamp_ntz'2020-01-05 00:00:00' as trans_date_trans_time, 1 as is_fraud union all "
                   "select timestamp_ntz'2020-04-05 00:00:00', 0")
    rows = rate_by_month(df).orderBy("month").collect()
    assert [(r["count"], r["mean"]) for r in rows] == [(1, 1.0), (0, None), (0, None), (1, 0.0)]

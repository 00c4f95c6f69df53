from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators.drift import inject_drift, numeric_drift
from tidemark.plans.monitoring import alert_summary, alert_text, drift_distances, week_label, weekly_report


def sample(spark, n, seed, scale=30.0, start="2024-03-05"):
    rng = np.random.default_rng(seed)
    first = datetime.fromisoformat(start)
    rows = [
        (datetime.fromtimestamp(first.timestamp() + i * 60), float(a), float(h), int(k), ["x", "y", "z"][c], int(y), float(s))
        for i, (a, h, k, c, y, s) in enumerate(
            zip(rng.gamma(2, scale, n), rng.integers(0, 24, n), rng.random(n) < 0.2, rng.integers(0, 3, n),
                rng.random(n) < 0.05, rng.random(n))
        )
    ]
    schema = "trans_date_trans_time timestamp_ntz, amt double, hour double, is_night int, category string, is_fraud int, score double"
    return spark.createDataFrame(rows, schema)


def distances(reference, current):
    current = current.withColumn("week", F.lit("w"))
    rows = drift_distances(reference, current, "week", ["w"], ["amt", "hour"], ["is_night", "category"]).collect()
    return {r["feature"]: r["distance"] for r in rows}


def test_quiet_on_the_same_distribution_and_loud_on_a_shift(spark):
    quiet = distances(sample(spark, 4000, 0), sample(spark, 3000, 1))
    assert all(d < 0.1 for d in quiet.values())
    loud = distances(sample(spark, 4000, 0), sample(spark, 3000, 1, scale=60.0))
    assert loud["amt"] > 0.1 and loud["hour"] < 0.1 and loud["category"] < 0.1


def test_wasserstein_and_jensen_shannon_by_hand(spark):
    ref, cur = sample(spark, 500, 2), sample(spark, 300, 3, scale=45.0)
    a, b = (np.array([r["amt"] for r in d.collect()]) for d in (ref, cur))
    grid = np.sort(np.concatenate([a, b]))
    cdf = lambda x: np.searchsorted(np.sort(x), grid[:-1], side="right") / len(x)
    want = (np.abs(cdf(a) - cdf(b)) * np.diff(grid)).sum() / a.std()
    p, q = (np.array([d.where(F.col("category") == c).count() for c in "xyz"]) for d in (ref, cur))
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    js = np.sqrt(((p * np.log(p / m)).sum() + (q * np.log(q / m)).sum()) / 2)
    got = distances(ref, cur)
    assert got["amt"] == pytest.approx(want, rel=1e-9) and got["category"] == pytest.approx(js, rel=1e-9)


def test_injection_scales_amounts_only(spark):
    row = spark.createDataFrame(
        [(datetime(2024, 1, 2), 10.0, float(np.log1p(10)), 20.0, 30.0, 2.0)],
        "t timestamp_ntz, amt double, log_amt double, card_amt_sum_1h double, card_amt_sum_24h double, amt_vs_card_mean double",
    )
    moved = inject_drift(row, "t", "2024-01-01", 2.0).first()
    assert tuple(moved)[1:] == pytest.approx((20, np.log1p(20), 40, 60, 2))
    assert inject_drift(row, "t", "2024-01-03", 2.0).first() == row.first()


@pytest.mark.parametrize(
    "day,week", [("2024-01-01", "2023-12-25"), ("2024-01-02", "2024-01-01"), ("2024-01-08", "2024-01-01"), ("2024-01-09", "2024-01-08")]
)
def test_weeks_run_tuesday_to_monday(spark, day, week):
    t = F.lit(f"{day} 23:59:59").cast("timestamp_ntz")
    assert spark.range(1).select(week_label(t)).first()[0] == week


def test_alert_rules(spark):
    rows = spark.createDataFrame([(0.3, 0.0, 0.0), (0.29, 0.1, 0.051), (0.0, 0.0, 0.05)], "a double, b double, c double")
    got = [r[0] for r in rows.select(alert_text(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert got == ["DATA_DRIFT", "PREDICTION_DRIFT, RETRAIN", "-"]


def test_small_weeks_are_left_out(spark):
    reference, current = sample(spark, 3000, 0), sample(spark, 11_000, 1)
    report = weekly_report(reference, current, ["amt", "hour"], ["category"])
    rows = {r["week"]: r for r in report.collect()}
    assert set(rows) == {"2024-03-04"} and rows["2024-03-04"]["transactions"] == 10_080
    assert alert_summary(report).first()["weeks"] == 1
    nothing = weekly_report(reference, current, ["amt"], ["category"], min_rows=10**6)
    assert nothing.count() == 0


@pytest.mark.parametrize("batch", [7, 10_000])
def test_many_windows_in_one_sweep(spark, batch):
    """Forty windows, ties, an empty window, nulls and bins cut over several batches, against numpy."""
    rng = np.random.default_rng(4)
    rows = [(None if i % 3 == 0 else f"w{i % 40:02d}", float(round(v, 1)) if i % 17 else None, float(i % 24)) for i, v in enumerate(rng.gamma(2, 3, 4000))]
    rows += [("w40", None, 1.0)]
    names = [f"w{i:02d}" for i in range(42)]
    df = spark.createDataFrame(rows, "week string, amt double, hour double")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = {(r["window"], r["feature"]): r["distance"] for r in numeric_drift(df, "week", names, ["amt", "hour"]).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    for place, feature in ((1, "amt"), (2, "hour")):
        ref = np.array([r[place] for r in rows if r[0] is None and r[place] is not None])
        for name in names:
            cur = np.array([r[place] for r in rows if r[0] == name and r[place] is not None])
            if not len(cur):
                assert got[name, feature] is None
                continue
            grid = np.unique(np.concatenate([ref, cur]))
            share = lambda x: np.searchsorted(np.sort(x), grid[:-1], side="right") / len(x)  # noqa: E731, B023
            want = (np.abs(share(ref) - share(cur)) * np.diff(grid)).sum() / ref.std()
            assert got[name, feature] == pytest.approx(want, rel=1e-9)

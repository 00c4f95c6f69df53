"""Weekly report: performance, drift against a reference period, alerts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.columns import DEFAULT, TxnColumns
from tidemark.operators.drift import (
    DATASET_DRIFT_SHARE,
    DRIFT_AT,
    MIN_POSITIVES,
    MIN_ROWS,
    RETRAIN_RECALL_DROP,
    categorical_drift,
    numeric_drift,
)
from tidemark.operators.ordered import quantile_cuts
from tidemark.operators.ranking import evaluate
from tidemark.schemas import DRIFT_CATEGORICAL, DRIFT_NUMERIC

def week_label(time: Column) -> Column:
    """Weeks run from Tuesday 00:00 to Monday 23:59 and are named by the Monday before them."""
    shifted = time.cast("timestamp") - F.expr("interval 1 day")
    return F.date_format(F.date_trunc("week", shifted), "yyyy-MM-dd")


def large_enough(
    df: DataFrame, window: str, min_rows: int = MIN_ROWS, min_positives: int = MIN_POSITIVES, cols: TxnColumns = DEFAULT
) -> DataFrame:
    """Windows worth judging, with their size and label rate."""
    sizes = df.groupBy(window).agg(
        F.count(F.lit(1)).alias("transactions"),
        F.sum(cols.label).alias("frauds"),
        F.avg(cols.label).alias("fraud_rate"),
    )
    return sizes.where((F.col("transactions") >= min_rows) & (F.col("frauds") >= min_positives))


def drift_distances(
    reference: DataFrame, current: DataFrame, window: str, windows: Sequence[str], numeric: Sequence[str],
    categorical: Sequence[str],
) -> DataFrame:
    """Distance of every feature in every window from the reference, long form."""
    features = [*numeric, *categorical]
    rows = _beside_reference(reference, current, window, windows, features)
    cuts = quantile_cuts(rows, numeric) if numeric else {}
    return _distances(rows, window, windows, numeric, categorical, cuts)


def _beside_reference(
    reference: DataFrame, current: DataFrame, window: str, windows: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Reference rows (null window) and the rows of the wanted windows."""
    return reference.select(F.lit(None).cast("string").alias(window), *columns).unionByName(
        current.where(F.col(window).isin(list(windows))).select(window, *columns)
    )


def _distances(rows, window, windows, numeric, categorical, cuts) -> DataFrame:
    parts = []
    if numeric:
        parts.append(numeric_drift(rows, window, windows, numeric, cuts))
    if categorical:
        parts.append(categorical_drift(rows, window, windows, categorical))
    return reduce(DataFrame.unionByName, parts)


def alert_text(share: Column, score_distance: Column, recall_drop: Column) -> Column:
    fired = F.array_compact(
        F.array(
            F.when(share >= DATASET_DRIFT_SHARE, F.lit("DATA_DRIFT")),
            F.when(score_distance >= DRIFT_AT, F.lit("PREDICTION_DRIFT")),
            F.when(recall_drop > RETRAIN_RECALL_DROP, F.lit("RETRAIN")),
        )
    )
    return F.when(F.size(fired) > 0, F.concat_ws(", ", fired)).otherwise(F.lit("-"))


def weekly_report(
    reference: DataFrame,
    current: DataFrame,
    numeric: Sequence[str] = tuple(DRIFT_NUMERIC),
    categorical: Sequence[str] = tuple(DRIFT_CATEGORICAL),
    min_rows: int = MIN_ROWS,
    min_positives: int = MIN_POSITIVES,
    cols: TxnColumns = DEFAULT,
) -> DataFrame:
    """One row per week of `current` that is large enough. All rows are used, none sampled.

    Both inputs are read several times; hand in stored tables, not long computations.
    """
    weekly = current.withColumn("week", week_label(F.col(cols.time)))
    # One name per week of data: a list bounded by the length of the period, not by its volume.
    judged = large_enough(weekly, "week", min_rows, min_positives, cols).select("week").collect()
    weeks = sorted(row["week"] for row in judged) or ["none"]
    monitored = [*numeric, cols.score]
    rows = _beside_reference(reference, weekly, "week", weeks, [*monitored, *categorical, cols.label])
    cuts = quantile_cuts(rows, monitored)

    on_score = F.col("feature") == cols.score
    drifted = (F.col("distance") >= DRIFT_AT).cast("double")
    drift = _distances(rows, "week", weeks, monitored, categorical, cuts).groupBy(F.col("window").alias("_week")).agg(
        F.avg(F.when(~on_score, drifted)).alias("drift_share"),
        F.max(F.when(F.col("feature") == cols.amount, F.col("distance"))).alias("amt_drift"),
        F.max(F.when(on_score, F.col("distance"))).alias("score_drift"),
    )
    quality = evaluate(rows, cols=cols, by=["week"], cuts=cuts[cols.score])
    baseline = quality.where(F.col("week").isNull()).select(F.col("recall_at_1pct_fpr").alias("_ref_recall"))
    joined = (
        quality.where(F.col("week").isNotNull())
        .join(drift, F.col("week") == F.col("_week"))
        .join(F.broadcast(baseline), F.lit(True), "left")
    )
    drop = 1 - F.try_divide(F.col("recall_at_1pct_fpr"), F.col("_ref_recall"))
    return joined.select(
        "week",
        (F.col("positives") + F.col("negatives")).alias("transactions"),
        F.round(100 * F.col("base_rate"), 2).alias("fraud_rate_pct"),
        F.round("pr_auc", 4).alias("pr_auc"),
        F.round("recall_at_1pct_fpr", 4).alias("recall_at_1pct_fpr"),
        F.round(100 * F.col("drift_share")).cast("int").alias("drifted_features_pct"),
        F.round("amt_drift", 3).alias("amt_drift"),
        F.round("score_drift", 3).alias("score_drift"),
        alert_text(F.col("drift_share"), F.col("score_drift"), drop).alias("alerts"),
    )


def alert_summary(report: DataFrame) -> DataFrame:
    return report.agg(F.count_if(F.col("alerts") != "-").alias("weeks_with_alerts"), F.count(F.lit(1)).alias("weeks"))

"""Metrics of a ranked score against a rare label, from one cumulative curve."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.columns import DEFAULT, TxnColumns
from tidemark.functions.scalars import ratio
from tidemark.operators.ordered import running_totals

METRICS = ["pr_auc", "pr_auc_lift", "roc_auc", "recall_at_1pct_fpr", "precision", "recall", "f1", "base_rate"]


def confusion(
    df: DataFrame, threshold: float | Column = 0.5, cols: TxnColumns = DEFAULT, by: Sequence[str] = ()
) -> DataFrame:
    """tp, fp, fn, tn when every score at or above the threshold is flagged."""
    return df.groupBy(*by).agg(*_confusion_counts(F.col(cols.label), F.col(cols.score) >= threshold))


def _confusion_counts(label: Column, flagged: Column) -> list[Column]:
    return [
        F.count_if((label == 1) & flagged).alias("tp"),
        F.count_if((label == 0) & flagged).alias("fp"),
        F.count_if((label == 1) & ~flagged).alias("fn"),
        F.count_if((label == 0) & ~flagged).alias("tn"),
    ]


def precision_recall_f1() -> dict[str, Column]:
    """Of a table with tp, fp, fn; zero where nothing was flagged or nothing was there to find."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return {
        "precision": ratio(tp, tp + fp, 0.0),
        "recall": ratio(tp, tp + fn, 0.0),
        "f1": ratio(2 * tp, 2 * tp + fp + fn, 0.0),
    }


def ranking_curve(
    df: DataFrame, cols: TxnColumns = DEFAULT, by: Sequence[str] = (), cuts: Sequence[float] | None = None
) -> DataFrame:
    """Distinct scores from high to low with positives/negatives at, and down to, each of them.

    `cuts` are cut points of the score from an earlier pass, see `ordered.quantile_cuts`.
    """
    label = F.col(cols.label)
    sums = {"pos": F.count_if(label == 1), "neg": F.count_if(label == 0)}
    return running_totals(df, cols.score, sums, by, descending=True, cuts=cuts)


def evaluate(
    df: DataFrame,
    threshold: float = 0.5,
    max_fpr: float = 0.01,
    cols: TxnColumns = DEFAULT,
    by: Sequence[str] = (),
    cuts: Sequence[float] | None = None,
) -> DataFrame:
    """All tracked metrics, one row per group; ranking metrics are null for a group without positives.

    Average precision sums recall steps times precision over distinct scores; the area under the ROC
    curve counts a tie as one half; both follow from the same curve, as do the counts at `threshold`.
    """
    curve = ranking_curve(df, cols, by, cuts)
    pos, neg, found, alarms = F.col("pos"), F.col("neg"), F.col("run_pos"), F.col("run_neg")
    within = ratio(alarms, F.col("all_neg")) <= max_fpr
    flagged = F.col(cols.score) >= threshold
    sums = curve.groupBy(*by).agg(
        F.max("all_pos").alias("positives"),
        F.max("all_neg").alias("negatives"),
        F.sum(pos * found / (found + alarms)).alias("_precision_steps"),
        F.sum(neg * (found - pos / 2)).alias("_pairs_won"),
        F.max(F.when(within, found)).alias("_found_within"),
        F.sum(F.when(flagged, pos).otherwise(0)).alias("tp"),
        F.sum(F.when(flagged, neg).otherwise(0)).alias("fp"),
        F.sum(F.when(flagged, 0).otherwise(pos)).alias("fn"),
        F.sum(F.when(flagged, 0).otherwise(neg)).alias("tn"),
    )
    positives, negatives = F.col("positives"), F.col("negatives")
    scored = sums.withColumns(
        {
            "pr_auc": ratio(F.col("_precision_steps"), positives),
            "base_rate": ratio(positives, positives + negatives),
            "roc_auc": ratio(F.col("_pairs_won"), positives.cast("double") * negatives),
            "recall_at_1pct_fpr": ratio(F.coalesce("_found_within", F.lit(0)), positives),
            **precision_recall_f1(),
        }
    ).withColumn("pr_auc_lift", ratio(F.col("pr_auc"), F.col("base_rate")))
    return scored.select(*by, "positives", "negatives", "tp", "fp", "fn", "tn", *METRICS)

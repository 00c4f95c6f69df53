"""Labels arrive days after the predictions they belong to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def label_join(
    predictions: DataFrame, labels: DataFrame, id: str = "transaction_id", label: str = "is_fraud"
) -> DataFrame:
    """Every prediction once, with its label or null while none has arrived.

    Redelivered labels are merged first (the largest wins), so a duplicate cannot multiply predictions.
    """
    known = labels.groupBy(F.col(id).alias("_id")).agg(F.max(label).alias(label))
    return predictions.join(known, F.col(id) == F.col("_id"), "left").drop("_id")


def label_join_stream(
    predictions: DataFrame,
    labels: DataFrame,
    id: str = "transaction_id",
    predicted_at: str = "predicted_at",
    labelled_at: str = "labelled_at",
    wait: str = "30 days",
    lateness: str = "1 hour",
) -> DataFrame:
    """The same on two streams: a prediction is emitted once labelled, or unlabelled after `wait`."""
    left = predictions.withWatermark(predicted_at, lateness)
    right = labels.withColumnRenamed(id, "_id").withWatermark(labelled_at, lateness)
    in_time = (F.col(labelled_at) >= F.col(predicted_at)) & (
        F.col(labelled_at) <= F.col(predicted_at) + F.expr(f"interval {wait}")
    )
    return left.join(right, (F.col(id) == F.col("_id")) & in_time, "left_outer").drop("_id")

"""Event to decision in one streaming query: decode, check, history, row features, model, decision."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.columns import TxnColumns
from tidemark.functions.rules import DECLINE_AT, decide
from tidemark.functions.scalars import add_transaction_features
from tidemark.plans.training import with_score
from tidemark.schemas import FEATURES

EVENT_COLUMNS = TxnColumns(key="cc_num", time="event_time", id="transaction_id", amount="amount")


def online_features(events: DataFrame) -> DataFrame:
    """Events with history features to the model's input, through the functions used for training."""
    renamed = events.withColumn("amt", F.col("amount")).withColumn("dob", F.to_date("customer_dob"))
    return add_transaction_features(
        renamed, time="event_time", home=("customer_lat", "customer_long"), merchant=("merchant_lat", "merchant_long")
    )


def _latency(events: DataFrame) -> list[Column]:
    if "arrived_at" not in events.columns:
        return []
    waited = F.unix_micros(F.current_timestamp()) - F.unix_micros("arrived_at")
    return [(waited / 1000).alias("latency_ms")]


def scorer(
    model: Transformer, threshold: float, version: str, decline_at: float = DECLINE_AT
) -> Callable[[DataFrame], DataFrame]:
    """Events with history features to scored events.

    Where it is known when an event arrived, `latency_ms` is the time from then until its micro-batch is scored.
    """

    def score(events: DataFrame) -> DataFrame:
        scored = with_score(model, online_features(events))
        return scored.select(
            "transaction_id",
            "cc_num",
            "event_time",
            F.round("score", 6).alias("fraud_score"),
            decide(F.col("score"), threshold, decline_at).alias("decision"),
            F.lit(float(threshold)).alias("threshold"),
            F.lit(version).alias("model_version"),
            *_latency(scored),
        )

    return score


__all__ = ["EVENT_COLUMNS", "FEATURES", "online_features", "scorer"]

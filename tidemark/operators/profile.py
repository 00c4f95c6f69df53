"""Descriptive tables: label rates, distributions per group, data-quality checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.columns import DEFAULT, TxnColumns
from tidemark.functions.scalars import MICROS, epoch_us, ratio
from tidemark.operators.ordered import exact_quantiles, values_at_ranks


def split_summary(df: DataFrame, by: Sequence[str] = ("split",), cols: TxnColumns = DEFAULT) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(cols.label).alias("fraud_rate"),
        F.min(cols.time).alias("first_time"),
        F.max(cols.time).alias("last_time"),
    )


def label_balance(df: DataFrame, cols: TxnColumns = DEFAULT) -> DataFrame:
    label = F.col(cols.label)
    return df.agg(
        F.count_if(label == 0).alias("negatives"),
        F.count_if(label == 1).alias("positives"),
        F.avg(label).alias("fraud_rate"),
        (1 - F.avg(label)).alias("always_negative_accuracy"),
    )


def rate_by(df: DataFrame, group: Column | str, name: str, cols: TxnColumns = DEFAULT) -> DataFrame:
    """Rows and label rate per group, highest rate first."""
    group = F.col(group) if isinstance(group, str) else group
    rates = df.groupBy(group.alias(name)).agg(
        F.count(cols.label).alias("transactions"), F.avg(cols.label).alias("fraud_rate")
    )
    percent = F.round(F.col("fraud_rate") * 100, 2)
    return rates.withColumn("fraud_rate_pct", percent).orderBy(F.desc("fraud_rate"), name)


def rate_by_month(df: DataFrame, cols: TxnColumns = DEFAULT) -> DataFrame:
    """Every calendar month between the first and the last row, including months without rows."""
    month = F.trunc(F.to_date(F.col(cols.time)), "month")
    seen = df.groupBy(month.alias("month")).agg(
        F.count(cols.label).alias("_count"), F.avg(cols.label).alias("mean")
    )
    span = seen.agg(F.min("month").alias("_from"), F.max("month").alias("_to"))
    calendar = span.select(F.explode(F.expr("sequence(_from, _to, interval 1 month)")).alias("month"))
    return calendar.join(seen, "month", "left").select(
        "month",
        F.coalesce("_count", F.lit(0)).alias("count"),
        "mean",
        (F.col("mean") * 100).alias("fraud_rate_pct"),
    )


def describe(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles."""
    column = F.col(value)
    moments = df.groupBy(*by).agg(
        F.count(column).alias("count"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    )
    quartiles = exact_quantiles(df, value, {"p25": 0.25, "p50": 0.5, "p75": 0.75}, by)
    if by:
        joined = moments.join(quartiles.withColumnsRenamed({b: f"_q_{b}" for b in by}), _same(by), "left")
    else:
        joined = moments.join(quartiles, F.lit(True), "left")
    return joined.select(*by, "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def _same(by: Sequence[str]) -> Column:
    condition = F.lit(True)
    for b in by:
        condition = condition & F.col(b).eqNullSafe(F.col(f"_q_{b}"))
    return condition


def labels_per_key(df: DataFrame, cols: TxnColumns = DEFAULT) -> DataFrame:
    return df.groupBy(cols.key).agg(F.count(cols.label).alias("n_txn"), F.sum(cols.label).alias("n_fraud"))


def compromised_keys(df: DataFrame, cols: TxnColumns = DEFAULT) -> DataFrame:
    """How many keys ever had a positive, and the distribution of positives over those keys."""
    per_key = labels_per_key(df, cols)
    share = per_key.agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.count_if(F.col("n_fraud") > 0).alias("n_compromised"),
        F.avg((F.col("n_fraud") > 0).cast("double")).alias("share_compromised"),
    )
    spread = describe(per_key.where("n_fraud > 0"), "n_fraud")
    return share.join(spread, F.lit(True), "left")


def label_span(df: DataFrame, cols: TxnColumns = DEFAULT) -> DataFrame:
    """Seconds between the first and last positive of each key."""
    us = epoch_us(F.col(cols.time))
    span = (F.max(us) - F.min(us)) / F.lit(float(MICROS))
    return df.where(F.col(cols.label) == 1).groupBy(cols.key).agg(span.alias("span_seconds"))


def log_histogram(df: DataFrame, value: str, by: str, bins: int = 100) -> DataFrame:
    """Density of log10(value) per group over equal-width bins spanning all groups; positive values only."""
    logs = df.where(F.col(value) > 0).select(by, F.log10(F.col(value)).alias("_x"))
    span = logs.agg(F.min("_x").alias("_low"), F.max("_x").alias("_high"))
    width = (F.col("_high") - F.col("_low")) / F.lit(float(bins))
    placed = F.least(F.floor((F.col("_x") - F.col("_low")) / width), F.lit(bins - 1))
    counted = (
        logs.join(F.broadcast(span), F.lit(True), "inner")
        .groupBy(by, F.when(width > 0, placed).otherwise(F.lit(0)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"), F.max("_low").alias("_low"), F.max(width).alias("_width"))
    )
    share = ratio(F.col("n"), F.sum("n").over(Window.partitionBy(by)))
    return counted.select(
        by,
        "bin",
        (F.col("_low") + F.col("bin") * F.col("_width")).alias("log10_from"),
        "n",
        ratio(share, F.col("_width")).alias("density"),
    )


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column: declared type, nulls and rows, from a single pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *(F.count_if(F.col(f"`{name}`").isNull()).alias(f"_null_{i}") for i, name in enumerate(df.columns)),
    )
    rows = F.array(
        *(
            F.struct(
                F.lit(name).alias("column"),
                F.lit(kind).alias("type"),
                F.col(f"_null_{i}").alias("nulls"),
                F.col("_rows").alias("rows"),
            )
            for i, (name, kind) in enumerate(df.dtypes)
        )
    )
    return counts.select(F.inline(rows))


def feed_checks(
    df: DataFrame, time: str, unix_time: str = "unix_time", merchant: str = "merchant", prefix: str = "fraud_"
) -> DataFrame:
    """Share of merchants with the artificial prefix and the offset between the two clocks, in seconds."""
    offset = F.floor(epoch_us(F.col(time)) / F.lit(MICROS)) - F.col(unix_time)
    return df.agg(
        F.avg(F.startswith(F.col(merchant), F.lit(prefix)).cast("double")).alias("prefixed_share"),
        F.min(offset).alias("min_offset_s"),
        F.max(offset).alias("max_offset_s"),
    )


def decision_counts(df: DataFrame, decision: str = "decision") -> DataFrame:
    return df.groupBy(decision).agg(F.count(F.lit(1)).alias("n"))


def latency_summary(df: DataFrame, latency: str, by: Sequence[str] = (), time: str | None = None) -> DataFrame:
    """Median and 99th percentile as exact ranks n // 2 and int(0.99 n) - 1 of the sorted values.

    With `time` also `per_second`: rows with a latency over the seconds between the first and the last of them; null for no span.
    """
    n = F.col("all_n")
    tail = F.floor(n * F.lit(0.99)) - 1
    ranks = {"p50": F.floor(n / 2), "p99": F.when(tail < 0, n + tail).otherwise(tail)}
    found = values_at_ranks(df, latency, ranks, by)
    if time is None:
        return found
    us = F.unix_micros(F.col(time).cast("timestamp"))
    span = (F.max(us) - F.min(us)) / F.lit(1e6)
    known = df.where(F.col(latency).isNotNull()).groupBy(*(F.col(b).alias(f"_by_{b}") for b in by))
    rates = known.agg(ratio(F.count(F.lit(1)), span).alias("per_second"))
    same = reduce(lambda a, b: a & b, (F.col(b).eqNullSafe(F.col(f"_by_{b}")) for b in by), F.lit(True))
    return found.join(rates, same).select(*found.columns, "per_second")


def distinct_keys(df: DataFrame, key: str, approximate: bool = False) -> DataFrame:
    """Keys are counted after a distinct, which combines map-side; the sketch needs no shuffle of keys."""
    if approximate:
        return df.agg(F.approx_count_distinct(key).alias("n_keys"))
    return df.select(key).where(F.col(key).isNotNull()).distinct().agg(F.count(F.lit(1)).alias("n_keys"))


def busiest(df: DataFrame, order: str, tie: str) -> DataFrame:
    return df.orderBy(F.desc(order), tie).limit(1)

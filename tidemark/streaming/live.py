"""Decisions and latencies per tumbling window while they are made, and duplicates of redelivered events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.sketch import SIZE, merge_sketches, sketch_quantiles


def live_decisions(
    scored: DataFrame, time: str = "event_time", width: str = "1 hour", lateness: str = "10 minutes", decision: str = "decision"
) -> DataFrame:
    """Counts per window and decision; a window is final once the watermark has passed its end."""
    stamped = scored.withColumn("_at", F.col(time).cast("timestamp")).withWatermark("_at", lateness)
    counted = stamped.groupBy(F.window("_at", width).alias("_w"), decision).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), decision, "n")


def once(events: DataFrame, id: str = "transaction_id", time: str = "event_time", within: str = "1 day") -> DataFrame:
    """Delivery is at least once; the first copy of an id within the delay is kept."""
    stamped = events.withColumn("_at", F.col(time).cast("timestamp")).withWatermark("_at", within)
    return stamped.dropDuplicatesWithinWatermark([id]).drop("_at")


def live_latency(
    scored: DataFrame,
    value: str = "latency_ms",
    time: str = "event_time",
    width: str = "1 hour",
    lateness: str = "10 minutes",
    decision: str = "decision",
    id: str | None = "transaction_id",
    size: int = SIZE,
) -> DataFrame:
    """(window_start, window_end, decision, events, n, sketch): one row per window and decision, for append mode.

    The state of an open window is one quantile sketch and two counts, whatever the traffic; a window is emitted once, when
    the watermark has passed its end. `events` counts all rows, `n` those whose value is neither null nor NaN. Copies of
    an id within the lateness count once (`id` None: all rows count). Rows without a time belong to no window.
    """
    stamped = scored.withColumn("_at", F.col(time).cast("timestamp")).withWatermark("_at", lateness)
    if id is not None:
        stamped = stamped.dropDuplicatesWithinWatermark([id])
    number = F.col(value).cast("double")
    number = F.when(~F.isnan(number), number)
    found = stamped.groupBy(F.window("_at", width).alias("_w"), F.col(decision).alias("decision")).agg(
        F.count(F.lit(1)).alias("events"), F.count(number).alias("n"), F.kll_sketch_agg_double(number, F.lit(size)).alias("sketch")
    )
    return found.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "decision", "events", "n", "sketch")


def latency_report(windows: DataFrame, by: str = "decision", size: int = SIZE) -> DataFrame:
    """(by, events, per_second, n, p50, p99) over stored rows of `live_latency`.

    The rate is over the time from the first window's start to the last one's end, empty windows in between included.
    Quantiles come from merged sketches and are null where no event has a value.
    """
    span = F.unix_seconds(F.max("window_end")) - F.unix_seconds(F.min("window_start"))
    span = windows.agg(span.alias("_seconds"))
    counts = windows.groupBy(by).agg(F.sum("events").alias("events")).join(F.broadcast(span), F.lit(True))
    counts = counts.select(F.col(by).alias("_by"), "events", (F.col("events") / F.col("_seconds")).alias("per_second"))
    merged = merge_sketches(windows.where("n > 0"), [by], size).drop("parts")
    quantiles = sketch_quantiles(merged, {"p50": 0.5, "p99": 0.99})
    both = counts.join(quantiles, F.col("_by").eqNullSafe(F.col(by)), "left")
    return both.select(F.col("_by").alias(by), "events", "per_second", F.coalesce("n", F.lit(0)).alias("n"), "p50", "p99")

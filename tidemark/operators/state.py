"""State of every key after a stretch of history, as tables.

A card's state is its totals (one row) and the rows its longest window can still reach. The reachable
rows stay rows: a busy card then spreads over many tasks instead of becoming one huge list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.columns import DEFAULT, TxnColumns
from tidemark.functions.scalars import MICROS, epoch_us
from tidemark.operators.history import WINDOWS, KeyState

LONGEST_US = max(WINDOWS.values()) * MICROS


def snapshot(df: DataFrame, cols: TxnColumns = DEFAULT, longest_us: int = LONGEST_US) -> KeyState:
    """State after replaying all rows of `df`; the row exactly `longest_us` before the last one is kept."""
    slim = df.select(
        F.col(cols.key),
        epoch_us(F.col(cols.time)).alias("us"),
        F.col(cols.id).alias("id"),
        F.col(cols.amount).alias("amt"),
    )
    totals = slim.groupBy(cols.key).agg(
        F.max("us").alias("last_us"), F.count(F.lit(1)).alias("total_count"), F.sum("amt").alias("total_amount")
    )
    last = totals.select(F.col(cols.key).alias("_key"), F.col("last_us").alias("_last"))
    same = F.col(cols.key).eqNullSafe(F.col("_key"))
    recent = slim.join(last, same & (F.col("us") >= F.col("_last") - longest_us), "inner")
    return KeyState(totals, recent.select(cols.key, "us", "id", "amt"))


def write_state(state: KeyState, path: str) -> None:
    """Replace the state stored under `path`."""
    state.totals.write.mode("overwrite").parquet(f"{path}/totals")
    state.recent.write.mode("overwrite").parquet(f"{path}/recent")


def read_state(spark, path: str) -> KeyState:
    return KeyState(spark.read.parquet(f"{path}/totals"), spark.read.parquet(f"{path}/recent"))

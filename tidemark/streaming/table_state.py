"""History features of a stream whose state lives in tables.

Each micro-batch runs the batch operator over its own rows plus the state left by earlier batches, so a
key with a large share of the traffic is spread over many tasks just as in batch. State is written per
batch as what changed (rows that arrived, new totals of the keys they touched); every `compact_every`
batches the whole state is written instead, and nothing older is read again.

Batch n reads only what batches before n wrote and replaces its own folders, so repeating it after a
failure gives the same rows once.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.columns import DEFAULT, TxnColumns
from tidemark.functions.scalars import MICROS, epoch_us
from tidemark.operators.history import (
    HOT_ROWS,
    MAX_GAP_SECONDS,
    WINDOWS,
    KeyState,
    contributions,
    features_of,
)
from tidemark.operators.state import write_state
from tidemark.session import path_exists


@dataclass(frozen=True)
class TableStateHistory:
    """Feature job over `state_path`; `output_path` receives one folder per batch."""

    state_path: str
    output_path: str
    cols: TxnColumns = DEFAULT
    windows: Mapping[str, int] | None = None
    max_gap: int = MAX_GAP_SECONDS
    hot_rows: int | None = HOT_ROWS
    compact_every: int = 20

    def seed(self, state: KeyState) -> None:
        """Start from a backfilled state instead of from nothing."""
        write_state(state, f"{self.state_path}/start")

    def start(self, events: DataFrame, checkpoint: str, transform=None, **trigger) -> StreamingQuery:
        """Run over a stream of rows with the columns of `cols`; `transform` is applied before the sink."""

        def each(batch: DataFrame, batch_id: int) -> None:
            self.process(batch, batch_id, transform)

        writer = events.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"availableNow": True})).start()

    def process(self, batch: DataFrame, batch_id: int, transform=None) -> None:
        """The rows of a batch are kept for its few jobs; a lost copy is recomputed from older folders only."""
        batch = batch.persist()
        before = self._state_before(batch, batch_id)
        rows = contributions(batch, self.cols, before).persist()
        try:
            features = features_of(
                rows, batch.columns, self.cols, self._windows(), self.max_gap, self.hot_rows, mark_late=True
            )
            out = features if transform is None else transform(features)
            out.write.mode("overwrite").parquet(f"{self.output_path}/batch_id={batch_id}")
            self._write_after(batch, before, batch_id)
        finally:
            rows.unpersist()
            batch.unpersist()

    def state_after(self, spark: SparkSession, batch_id: int) -> KeyState:
        """Full state once batch `batch_id` has been processed."""
        return self._latest(spark, batch_id + 1)

    def _windows(self) -> Mapping[str, int]:
        return WINDOWS if self.windows is None else self.windows

    def _longest_us(self) -> int:
        return max(self._windows().values()) * MICROS

    def _is_whole(self, batch_id: int) -> bool:
        return batch_id % self.compact_every == self.compact_every - 1

    def _folders(self, spark: SparkSession, batch_id: int) -> list[tuple[int, str]]:
        """Folders that together hold the state before `batch_id`, oldest first."""
        first = batch_id - batch_id % self.compact_every
        folders = [(i, f"{self.state_path}/batch_id={i}") for i in range(max(first - 1, 0), batch_id)]
        start = f"{self.state_path}/start"
        if first == 0 and path_exists(spark, start):
            folders.insert(0, (-1, start))
        return folders

    def _latest(self, spark: SparkSession, batch_id: int) -> KeyState | None:
        folders = self._folders(spark, batch_id)
        if not folders:
            return None
        layout = spark.read.parquet(f"{folders[-1][1]}/totals").schema
        totals = reduce(
            DataFrame.unionByName,
            [spark.read.schema(layout).parquet(f"{p}/totals").withColumn("_batch", F.lit(i)) for i, p in folders],
        )
        recent = spark.read.parquet(*(f"{p}/recent" for _, p in folders))
        fields = F.struct("last_us", "total_count", "total_amount")
        newest = totals.groupBy(self.cols.key).agg(F.max_by(fields, F.col("_batch")).alias("_t"))
        return KeyState(newest.select(self.cols.key, "_t.*"), recent)

    def _state_before(self, batch: DataFrame, batch_id: int) -> KeyState | None:
        """State of the keys in this batch, with the rows its windows can reach."""
        state = self._latest(batch.sparkSession, batch_id)
        if state is None:
            return None
        key = self.cols.key
        earliest = batch.agg(F.min(epoch_us(F.col(self.cols.time)))).first()[0]
        touched = batch.select(key).distinct()
        reachable = state.recent.where(F.col("us") >= F.lit((earliest or 0) - self._longest_us()))
        return KeyState(
            state.totals.join(touched, key, "left_semi"), reachable.join(touched, key, "left_semi")
        )

    def _write_after(self, batch: DataFrame, before: KeyState | None, batch_id: int) -> None:
        key, target = self.cols.key, f"{self.state_path}/batch_id={batch_id}"
        arrived = batch.select(
            F.col(key),
            epoch_us(F.col(self.cols.time)).alias("us"),
            F.col(self.cols.id).alias("id"),
            F.col(self.cols.amount).alias("amt"),
        )
        added = arrived.groupBy(key).agg(
            F.max("us").alias("last_us"), F.count(F.lit(1)).alias("total_count"), F.sum("amt").alias("total_amount")
        )
        whole = self._latest(batch.sparkSession, batch_id) if self._is_whole(batch_id) else before
        if whole is not None:
            added = whole.totals.unionByName(added).groupBy(key).agg(
                F.max("last_us").alias("last_us"),
                F.sum("total_count").alias("total_count"),
                F.sum("total_amount").alias("total_amount"),
            )
        added.write.mode("overwrite").parquet(f"{target}/totals")
        if self._is_whole(batch_id) and whole is not None:
            written = batch.sparkSession.read.parquet(f"{target}/totals")
            last = written.select(F.col(key).alias("_key"), (F.col("last_us") - self._longest_us()).alias("_from"))
            kept = whole.recent.unionByName(arrived)
            arrived = kept.join(last, (F.col(key) == F.col("_key")) & (F.col("us") >= F.col("_from"))).drop("_key", "_from")
        arrived.write.mode("overwrite").parquet(f"{target}/recent")

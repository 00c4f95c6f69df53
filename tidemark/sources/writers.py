"""Sinks: split tables, keyed messages, idempotent micro-batches, reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.columns import DEFAULT, TxnColumns


def write_dataset(df: DataFrame, path: str, cols: TxnColumns = DEFAULT, split: str = "split") -> None:
    """One folder per split, files in time order.

    Ranges of (split, time) balance the files by rows, however uneven the splits are.
    """
    ordered = df.repartitionByRange(split, cols.time, cols.id).sortWithinPartitions(split, cols.time, cols.id)
    ordered.write.mode("overwrite").partitionBy(split).parquet(path)


def keyed_messages(df: DataFrame, key: str) -> DataFrame:
    """One message per row: the key as bytes, the row as JSON."""
    return df.select(F.col(key).cast("binary").alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def label_messages(labels: DataFrame, key: str) -> DataFrame:
    """Label messages carry the card only as the key, never in the body."""
    body = [c for c in labels.columns if c != key]
    return labels.select(F.col(key).cast("binary").alias("key"), F.to_json(F.struct(*body)).alias("value"))


def publish_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """Needs the Kafka connector on the class path."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).option(
        "kafka.acks", "all"
    ).save()


def publish_files(messages: DataFrame, path: str) -> None:
    """Message bodies as JSON lines, added to the folder a file stream reads."""
    messages.select("value").write.mode("append").text(path)


def micro_batch_sink(
    path: str, on_summary: Callable[[int, dict], None] | None = None, busiest_by: str = "card_txn_count_1h",
    key: str = "cc_num",
) -> Callable[[DataFrame, int], None]:
    """Function for foreachBatch. A repeated batch replaces its own folder, so no row is written twice."""

    def write(batch: DataFrame, batch_id: int) -> None:
        target = f"{path}/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(target)
        if on_summary is None:
            return
        written = batch.sparkSession.read.schema(batch.schema).parquet(target)
        top = F.max_by(F.struct(F.col(key), F.col(busiest_by)), F.struct(F.col(busiest_by), F.col(key)))
        row = written.agg(F.count(F.lit(1)).alias("rows"), top.alias("busiest")).first()
        on_summary(batch_id, row.asDict(recursive=True))

    return write


def write_report(df: DataFrame, path: str, format: str = "parquet") -> None:
    """A handful of rows: one file, written by a task of its own, so the work before it keeps its tasks."""
    writer = df.repartition(1).write.mode("overwrite")
    writer.option("header", True).csv(path) if format == "csv" else writer.format(format).save(path)

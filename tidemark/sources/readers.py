"""Typed reads of files and streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import epoch_us, parse_iso
from tidemark.operators.clean import in_time_order
from tidemark.schemas import EVENT_SCHEMA, LABEL_SCHEMA, RAW_SCHEMA, REPLAY_COLUMNS

# Fixed values of the message feed.
TRANSACTIONS_TOPIC = "transactions"
LABELS_TOPIC = "fraud-labels"
MAX_PER_TRIGGER = 5000

CORRUPT = "_corrupt_record"


def load_raw(spark: SparkSession, path: str | Sequence[str], keep_corrupt: bool = False) -> DataFrame:
    """Raw transactions from CSV; the first column is only a row number.

    Malformed rows have nulls where a value does not parse; `keep_corrupt` adds the original line.
    """
    schema = T.StructType(RAW_SCHEMA.fields + ([T.StructField(CORRUPT, T.StringType())] if keep_corrupt else []))
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
    return reader.option("columnNameOfCorruptRecord", CORRUPT).csv(paths).drop("row_index")


def load_transactions(spark: SparkSession, path: str, limit: int | None = None, skip: int = 0) -> DataFrame:
    """The columns needed to replay a file, in time order, after skipping the first rows."""
    return in_time_order(load_raw(spark, path).select(*REPLAY_COLUMNS), skip, limit)


def load_split(
    spark: SparkSession, path: str, splits: str | Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Rows of one or more splits; only their partitions and the wanted columns are read."""
    names = [splits] if isinstance(splits, str) else list(splits)
    rows = spark.read.parquet(path).where(F.col("split").isin(names))
    return rows if columns is None else rows.select(*columns)


def kafka_messages(
    spark: SparkSession,
    servers: str,
    topic: str = TRANSACTIONS_TOPIC,
    max_per_trigger: int = MAX_PER_TRIGGER,
    starting: str = "earliest",
) -> DataFrame:
    """Message bodies of a topic as text, with the time of their arrival. Needs the Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("maxOffsetsPerTrigger", max_per_trigger)
        .load()
        .select(F.col("value").cast("string").alias("json"), F.col("timestamp").alias("arrived_at"))
    )


def file_messages(spark: SparkSession, path: str, files_per_trigger: int | None = 1) -> DataFrame:
    """Lines of text files as message bodies, oldest files first; they arrived when their file was written."""
    reader = spark.readStream.format("text")
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path).select(F.col("value").alias("json"), F.col("_metadata.file_modification_time").alias("arrived_at"))


def decode_events(messages: DataFrame) -> DataFrame:
    """Message text to event columns, with `event_time` and `event_us`; other columns of the messages are kept.

    A body that is no JSON gives nulls in every column and an unparseable time gives a null time, so
    both fail the row contract and end up with the rejected rows instead of stopping the stream.
    """
    fields = messages.withColumn("_e", F.from_json("json", EVENT_SCHEMA)).select(*messages.columns, "_e.*")
    timed = fields.withColumn("event_time", parse_iso(F.col("timestamp")))
    return timed.withColumn("event_us", epoch_us(F.col("event_time")))


def decode_labels(messages: DataFrame) -> DataFrame:
    return messages.select(F.from_json("json", LABEL_SCHEMA).alias("_l")).select("_l.*")

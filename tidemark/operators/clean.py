"""Cleaning, event projections, tagged unions and the chronological split."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.columns import DEFAULT, TxnColumns
from tidemark.functions.scalars import iso_date, iso_time, strip_prefix
from tidemark.operators.selection import between, order_keys
from tidemark.schemas import PII_COLUMNS

# Fixed values of the data preparation.
MERCHANT_PREFIX = "fraud_"
VALIDATION_START = "2020-01-01"


def clean(df: DataFrame, merchant: str = "merchant", drop: tuple[str, ...] = ("unix_time", *PII_COLUMNS)) -> DataFrame:
    """Strip the artificial merchant prefix; drop the unreliable clock and personal data where present."""
    return df.withColumn(merchant, strip_prefix(F.col(merchant), MERCHANT_PREFIX)).drop(*drop)


def to_event(df: DataFrame, cols: TxnColumns = DEFAULT) -> DataFrame:
    """Raw row to transaction event. The label is not part of it."""
    return df.select(
        F.col(cols.id).cast("string").alias("transaction_id"),
        F.col(cols.key).cast("string").alias("cc_num"),
        F.col(cols.amount).cast("double").alias("amount"),
        F.col(cols.category).cast("string").alias("category"),
        iso_time(F.col(cols.time)).alias("timestamp"),
        iso_date(F.col("dob")).alias("customer_dob"),
        F.col("lat").cast("double").alias("customer_lat"),
        F.col("long").cast("double").alias("customer_long"),
        F.col("merch_lat").cast("double").alias("merchant_lat"),
        F.col("merch_long").cast("double").alias("merchant_long"),
        F.col("city_pop").cast("long").alias("city_pop"),
    )


def to_label_event(df: DataFrame, cols: TxnColumns = DEFAULT) -> DataFrame:
    return df.select(
        F.col(cols.id).cast("string").alias("transaction_id"), F.col(cols.label).cast("int").alias("is_fraud")
    )


def tagged_union(sources: dict[str, DataFrame], tag: str = "source") -> DataFrame:
    """All rows of all sources, duplicates kept, each tagged with the source's name."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def time_split(
    df: DataFrame, validation_start: str = VALIDATION_START, cols: TxnColumns = DEFAULT, source: str = "source"
) -> DataFrame:
    """Add `split`: the test source as a whole, the rest cut at `validation_start` (which is validation).

    Rows without a time belong to no split (null), unless their source is the test source.
    """
    cut = F.lit(validation_start).cast("timestamp_ntz")
    return df.withColumn(
        "split",
        F.when(F.col(source) == "test", F.lit("test"))
        .when(F.col(cols.time) < cut, F.lit("train"))
        .when(F.col(cols.time) >= cut, F.lit("val")),
    )


def in_time_order(df: DataFrame, skip: int = 0, limit: int | None = None, cols: TxnColumns = DEFAULT) -> DataFrame:
    """Rows by (time, id) after skipping `skip` of them; all remaining rows unless limited. Null times come first."""
    if skip == 0 and limit is None:
        return df.orderBy(cols.time, cols.id)
    kept = between(df, order_keys(df, cols.time, cols.id), skip, None if limit is None else skip + limit)
    return kept.orderBy(cols.time, cols.id)

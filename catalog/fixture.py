"""The driver's tables seen as card transactions (the mapping of SURVEY section 7.3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import prepare_session

CATEGORIES = ["click", "error", "purchase", "signup", "view"]
CUT_VALIDATION = "2024-01-15"
CUT_TEST = "2024-01-23"

# The same view for the oracle.
TXN_SQL = """
txn AS (
  SELECT event_id AS trans_num, CAST(user_id AS VARCHAR) AS cc_num, ts AS trans_date_trans_time,
         value AS amt, event_type AS category,
         'fraud_' || event_type || '_' || CAST(user_id % 7 AS VARCHAR) AS merchant,
         CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) >= 95 AS INTEGER) AS is_fraud,
         value / (value + 50) AS score,
         (user_id * 37 % 1800) / 10.0::DOUBLE - 90 AS lat, (user_id * 53 % 3600) / 10.0::DOUBLE - 180 AS long,
         (event_id * 41 % 1800) / 10.0::DOUBLE - 90 AS merch_lat,
         (event_id * 59 % 3600) / 10.0::DOUBLE - 180 AS merch_long,
         DATE '1950-01-01' + CAST(user_id * 97 % 15000 AS INTEGER) AS dob,
         1000 + user_id * 131 % 90000 AS city_pop,
         epoch_us(ts) // 1000000 - 220924800 AS unix_time,
         epoch_us(ts) AS us,
         CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 'train' WHEN ts < TIMESTAMP '2024-01-23' THEN 'val'
              ELSE 'test' END AS split
  FROM events)
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare_session(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str, truncate: str | None = None) -> DataFrame:
    """events as raw transactions; `truncate` cuts the time to force ties and exact window borders."""
    events = table(spark, sf_dir, "events")
    user, event, value = F.col("user_id"), F.col("event_id"), F.col("value")
    time = F.col("ts") if truncate is None else F.date_trunc(truncate, F.col("ts")).cast("timestamp_ntz")
    mark = F.get_json_object("props", "$.k").cast("int")
    return events.select(
        event.alias("trans_num"),
        user.cast("string").alias("cc_num"),
        time.alias("trans_date_trans_time"),
        value.alias("amt"),
        F.col("event_type").alias("category"),
        F.concat(F.lit("fraud_"), "event_type", F.lit("_"), (user % 7).cast("string")).alias("merchant"),
        (mark >= 95).cast("int").alias("is_fraud"),
        (value / (value + 50)).alias("score"),
        ((user * 37 % 1800) / F.lit(10.0) - 90).alias("lat"),
        ((user * 53 % 3600) / F.lit(10.0) - 180).alias("long"),
        ((event * 41 % 1800) / F.lit(10.0) - 90).alias("merch_lat"),
        ((event * 59 % 3600) / F.lit(10.0) - 180).alias("merch_long"),
        F.date_add(F.lit("1950-01-01").cast("date"), (user * 97 % 15000).cast("int")).alias("dob"),
        (1000 + user * 131 % 90000).alias("city_pop"),
        (F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000000) - 220924800).alias("unix_time"),
        F.when(F.col("ts") < F.lit(CUT_VALIDATION).cast("timestamp_ntz"), "train")
        .when(F.col("ts") < F.lit(CUT_TEST).cast("timestamp_ntz"), "val")
        .otherwise("test")
        .alias("split"),
    )

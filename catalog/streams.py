"""Registered streaming queries: the tables are replayed as files in three slices of time.

Each slice is written, then the same query is started again from its checkpoint and runs until nothing is
left, so every one of them also restarts twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.batch import Query, rounded
from catalog.fixture import CATEGORIES, CUT_VALIDATION, transactions
from tidemark.columns import TxnColumns
from tidemark.functions.rules import decide, split_valid
from tidemark.functions.scalars import iso_time
from tidemark.operators.clean import to_event
from tidemark.operators.labels import label_join_stream
from tidemark.operators.state import snapshot
from tidemark.plans.dataset import build_dataset
from tidemark.plans.training import fit_model, with_score
from tidemark.schemas import HISTORY_FEATURES
from tidemark.session import ROCKSDB, new_working_path, stored
from tidemark.sources.readers import decode_events, file_messages
from tidemark.sources.writers import keyed_messages, micro_batch_sink, publish_files
from tidemark.streaming.keyed_state import keyed_history
from tidemark.operators.sketch import rank_error
from tidemark.streaming.live import latency_report, live_decisions, live_latency
from tidemark.streaming.scoring import EVENT_COLUMNS, scorer
from tidemark.streaming.table_state import TableStateHistory

SPLITS = ("train", "val", "test")
STATE_COLUMNS = TxnColumns(id="transaction_id", amount="amount", time="event_time")


def _publish(rows: DataFrame, folder: str) -> None:
    publish_files(keyed_messages(to_event(rows), "cc_num"), folder)


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return split_valid(decode_events(file_messages(spark, folder, files_per_trigger=None)), CATEGORIES)[0]


def _replay(spark: SparkSession, rows: DataFrame, folder: str, start, slices=SPLITS) -> None:
    for name in slices:
        _publish(rows.where(F.col("split") == name), folder)
        start().awaitTermination()


def _backfill(rows: DataFrame):
    past = rows.where("split <> 'test'").withColumn("transaction_id", F.col("trans_num").cast("string"))
    return snapshot(past, TxnColumns(id="transaction_id"))


def _result(spark: SparkSession, path: str) -> DataFrame:
    out = spark.read.parquet(path)
    return rounded(out.select("transaction_id", "cc_num", *HISTORY_FEATURES, "late"))


def _table_state(spark: SparkSession, rows: DataFrame, slices=SPLITS, before=None, **options) -> DataFrame:
    work = new_working_path(spark, "stream")
    job = TableStateHistory(f"{work}/state", f"{work}/features", STATE_COLUMNS, **options)
    if before is not None:
        job.seed(before)

    def start():
        return job.start(_events(spark, f"{work}/in"), f"{work}/checkpoint")

    _replay(spark, rows, f"{work}/in", start, slices)
    return _result(spark, f"{work}/features")


def _state_store(spark: SparkSession, rows: DataFrame, slices=SPLITS, before=None) -> DataFrame:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    work = new_working_path(spark, "stream")

    def start():
        features = keyed_history(_events(spark, f"{work}/in").drop("json"), before=before)
        writer = features.writeStream.foreachBatch(micro_batch_sink(f"{work}/features"))
        return writer.option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True).start()

    _replay(spark, rows, f"{work}/in", start, slices)
    return _result(spark, f"{work}/features")


def stream_history(spark, sf_dir):
    """State in tables; ties forced; every key with more than 50 rows in a batch takes the sliced route."""
    return _table_state(spark, transactions(spark, sf_dir, "hour"), hot_rows=50, compact_every=2)


def stream_history_state_store(spark, sf_dir):
    return _state_store(spark, transactions(spark, sf_dir, "hour"))


def backfill_stream(spark, sf_dir):
    """Only the test period is live; the state of the earlier periods is loaded first."""
    rows = transactions(spark, sf_dir)
    return _table_state(spark, rows, ("test",), _backfill(rows))


def backfill_state_store(spark, sf_dir):
    rows = transactions(spark, sf_dir)
    return _state_store(spark, rows, ("test",), _backfill(rows))


def stream_scoring(spark, sf_dir):
    """Live scores of the test period against batch scores of the same model over the prepared table."""
    rows = transactions(spark, sf_dir)
    raw = rows.drop("split", "score")
    train_raw, test_raw = (raw.where(rows["split"] != "test"), raw.where(rows["split"] == "test"))
    prepared = stored(build_dataset(train_raw, test_raw, CUT_VALIDATION), "prepared")
    model = fit_model(prepared.where("split = 'train'"), "logreg")

    work = new_working_path(spark, "stream")
    job = TableStateHistory(f"{work}/state", f"{work}/scored", EVENT_COLUMNS)
    job.seed(_backfill(rows))
    _publish(rows.where("split = 'test'"), f"{work}/in")
    score = scorer(model, 0.5, "1")
    job.start(_events(spark, f"{work}/in"), f"{work}/checkpoint", score).awaitTermination()

    offline = with_score(model, prepared.where("split = 'test'")).select(
        F.col("trans_num").cast("string").alias("_id"), F.col("score").alias("_score"), decide(F.col("score"), 0.5).alias("_decision")
    )
    both = spark.read.parquet(f"{work}/scored").join(offline, F.col("transaction_id") == F.col("_id"), "full_outer")
    return both.agg(
        F.count("transaction_id").alias("scored_live"),
        F.count("_id").alias("scored_offline"),
        F.count_if(F.abs(F.col("fraud_score") - F.col("_score")) <= 1e-6).alias("same_score"),
        F.count_if(F.col("decision") == F.col("_decision")).alias("same_decision"),
    )


def stream_dead_letter(spark, sf_dir):
    """Bodies that are no JSON and fields out of contract are kept aside with their reasons."""
    rows = transactions(spark, sf_dir)
    n = F.col("transaction_id").cast("long")
    events = to_event(rows).withColumn("amount", F.when(n % 10 == 3, -F.col("amount")).otherwise(F.col("amount")))
    bodies = keyed_messages(events.withColumn("timestamp", F.when(n % 10 == 7, F.lit("soon")).otherwise(F.col("timestamp"))), "cc_num")
    damaged = bodies.withColumn(
        "value", F.when(F.get_json_object("value", "$.transaction_id").cast("long") % 10 == 9, F.substring("value", 3, 20)).otherwise(F.col("value"))
    )
    work = new_working_path(spark, "stream")
    publish_files(damaged, f"{work}/in")
    rejected = split_valid(decode_events(file_messages(spark, f"{work}/in", None)), CATEGORIES)[1]
    writer = rejected.writeStream.foreachBatch(micro_batch_sink(f"{work}/rejected"))
    writer.option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    out = spark.read.parquet(f"{work}/rejected")
    return out.groupBy(F.array_join("violations", ",").alias("violations")).agg(F.count(F.lit(1)).alias("n"))


def live_decision_counts(spark, sf_dir):
    """Decisions per hour, updated as slices arrive; the last update of a window counts."""
    rows = transactions(spark, sf_dir).select(
        F.col("trans_date_trans_time").alias("event_time"), decide(F.col("score"), 0.5, 0.8).alias("decision"), "split"
    )
    work = new_working_path(spark, "stream")

    def start():
        source = spark.readStream.schema(rows.drop("split").schema).parquet(f"{work}/in")
        writer = live_decisions(source).writeStream.outputMode("update").foreachBatch(micro_batch_sink(f"{work}/counts"))
        return writer.option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True).start()

    for name in SPLITS:
        rows.where(F.col("split") == name).drop("split").write.mode("append").parquet(f"{work}/in")
        start().awaitTermination()
    updates = spark.read.parquet(f"{work}/counts")
    newest = updates.groupBy("window_start", "decision").agg(F.max_by("n", "batch_id").alias("n"))
    return newest.withColumn("window_start", iso_time(F.col("window_start")))


def live_latency_sketches(spark, sf_dir):
    """Sketches of amounts per day and decision from a stream, every slice delivered twice; merged to decisions.

    Are the ranks of the answers as close as stated? Three times the stated error, so that chance does not decide.
    """
    rows = transactions(spark, sf_dir).select(
        F.col("trans_num").cast("string").alias("transaction_id"), F.col("trans_date_trans_time").alias("event_time"),
        decide(F.col("score"), 0.5, 0.8).alias("decision"), F.col("amt").alias("latency_ms"), "split",
    )
    rows = stored(rows, "decided")
    work = new_working_path(spark, "stream")

    def start():
        source = spark.readStream.schema(rows.drop("split").schema).parquet(f"{work}/in")
        writer = live_latency(source, width="1 day").writeStream.outputMode("append").foreachBatch(micro_batch_sink(f"{work}/out"))
        return writer.option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True).start()

    for name in SPLITS:
        for _ in range(2):
            rows.where(F.col("split") == name).drop("split").write.mode("append").parquet(f"{work}/in")
        start().awaitTermination()
    # A later row moves the watermark on, so that the last windows close; its own stays open.
    closing = rows.agg((F.max("event_time") + F.expr("interval 30 days")).alias("event_time")).select(
        F.lit("closing").alias("transaction_id"), "event_time", F.lit("closing").alias("decision"), F.lit(0.0).alias("latency_ms")
    )
    closing.write.mode("append").parquet(f"{work}/in")
    start().awaitTermination()
    answers = stored(latency_report(spark.read.parquet(f"{work}/out")), "answers")
    far, within = 3 * rank_error(), []
    for name, share in (("p50", 0.5), ("p99", 0.99)):
        below, upto = (F.avg(test.cast("double")) for test in (F.col("latency_ms") < F.col(name), F.col("latency_ms") <= F.col(name)))
        within.append(((below <= share + far) & (upto >= share - far)).alias(f"{name}_close"))
    close = rows.join(answers.select("decision", "p50", "p99"), "decision").groupBy("decision").agg(*within)
    return rounded(close.join(answers.select("decision", "events", "n", "per_second"), "decision"), 9)


def label_join_stream_rows(spark, sf_dir):
    """Two thirds of the decisions get a label a day later; the others are emitted without one after two days."""
    rows = transactions(spark, sf_dir)
    predictions = rows.select(
        F.col("trans_num").cast("string").alias("transaction_id"),
        F.col("trans_date_trans_time").cast("timestamp").alias("predicted_at"),
    )
    labels = rows.where("trans_num % 3 <> 0").select(
        F.col("trans_num").cast("string").alias("transaction_id"),
        "is_fraud",
        (F.col("trans_date_trans_time").cast("timestamp") + F.expr("interval 1 day")).alias("labelled_at"),
    )
    work = new_working_path(spark, "stream")
    predictions.write.parquet(f"{work}/predictions")
    labels.write.parquet(f"{work}/labels")
    joined = label_join_stream(
        spark.readStream.schema(predictions.schema).parquet(f"{work}/predictions"),
        spark.readStream.schema(labels.schema).parquet(f"{work}/labels"),
        wait="2 days",
    )
    writer = joined.writeStream.outputMode("append").foreachBatch(micro_batch_sink(f"{work}/out"))
    writer = writer.option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True)
    writer.start().awaitTermination()
    # A later row on both sides moves the watermark on, so that the last predictions stop waiting.
    later = predictions.select(F.lit("closing").alias("transaction_id"), F.max("predicted_at") + F.expr("interval 30 days"))
    later = later.toDF(*predictions.columns)
    later.write.mode("append").parquet(f"{work}/predictions")
    late = later.select(F.lit("closing label").alias("transaction_id"), F.lit(0).cast(labels.schema["is_fraud"].dataType), "predicted_at")
    late.toDF(*labels.columns).write.mode("append").parquet(f"{work}/labels")
    writer.start().awaitTermination()
    out = spark.read.parquet(f"{work}/out")
    return out.where("transaction_id <> 'closing'").select("transaction_id", "is_fraud")


QUERIES: dict[str, Query] = {
    "stream_history": stream_history,
    "stream_history_state_store": stream_history_state_store,
    "backfill_stream": backfill_stream,
    "backfill_state_store": backfill_state_store,
    "stream_scoring": stream_scoring,
    "stream_dead_letter": stream_dead_letter,
    "live_decisions": live_decision_counts,
    "live_latency": live_latency_sketches,
    "label_join_stream": label_join_stream_rows,
}

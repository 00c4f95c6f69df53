"""Jobs for spark-submit: python -m tidemark.jobs <job> --help

Cluster, memory and shuffle settings come from the submission; paths may be on any file system Spark reads.
"""

from __future__ import annotations

import argparse
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.columns import DEFAULT
from tidemark.functions.rules import split_valid
from tidemark.operators import profile
from tidemark.operators.clean import VALIDATION_START, in_time_order, to_event
from tidemark.operators.cost import FALSE_ALARM_COST, SENSITIVITY_COSTS, cost_optimal
from tidemark.operators.drift import inject_drift
from tidemark.operators.history import history_features
from tidemark.operators.parity import parity_report
from tidemark.operators.state import read_state, snapshot, write_state
from tidemark.plans.dataset import build_dataset
from tidemark.plans.monitoring import alert_summary, weekly_report
from tidemark.plans.registry import (
    VERSION_SCHEMA,
    champion,
    change_versions,
    load_champion,
    mark_evaluated,
    not_yet_evaluated,
    promote,
    read_versions,
)
from tidemark.plans.summary import final_summary
from tidemark.plans.training import compare, compare_models, random_search, resampled, train_final, with_score, without_groups
from tidemark.schemas import HISTORY_FEATURES
from tidemark.session import ROCKSDB, prepare_session, stored
from tidemark.sources.readers import (
    LABELS_TOPIC,
    MAX_PER_TRIGGER,
    TRANSACTIONS_TOPIC,
    decode_events,
    file_messages,
    kafka_messages,
    load_raw,
    load_split,
    load_transactions,
)
from tidemark.sources.writers import (
    keyed_messages,
    label_messages,
    micro_batch_sink,
    publish_files,
    publish_kafka,
    write_dataset,
    write_report,
)
from tidemark.streaming.keyed_state import keyed_history
from tidemark.streaming.live import latency_report, live_latency
from tidemark.streaming.scoring import EVENT_COLUMNS, scorer
from tidemark.streaming.table_state import TableStateHistory

STATE_COLUMNS = [DEFAULT.id, DEFAULT.key, DEFAULT.time, DEFAULT.amount]


def prepare(spark: SparkSession, a) -> DataFrame:
    """Raw files to the split feature table."""
    write_dataset(build_dataset(load_raw(spark, a.train), load_raw(spark, a.test), a.validation_start), a.data)
    return profile.split_summary(spark.read.parquet(a.data))


def explore(spark: SparkSession, a) -> DataFrame:
    """Descriptive tables of a raw file, one report folder each."""
    raw = stored(load_raw(spark, a.train), "raw")
    reports = {
        "nulls": profile.null_profile(raw),
        "feed": profile.feed_checks(raw, DEFAULT.time),
        "labels": profile.label_balance(raw),
        "amount_by_label": profile.describe(raw, DEFAULT.amount, [DEFAULT.label]),
        "amount_histogram": profile.log_histogram(raw, DEFAULT.amount, DEFAULT.label),
        "by_category": profile.rate_by(raw, DEFAULT.category, "category"),
        "by_hour": profile.rate_by(raw, F.hour(DEFAULT.time), "hour"),
        "by_month": profile.rate_by_month(raw),
        "cards": profile.compromised_keys(raw),
        "fraud_span": profile.describe(profile.label_span(raw), "span_seconds"),
    }
    for name, report in reports.items():
        write_report(report, f"{a.out}/{name}")
    return reports["labels"]


def replay(spark: SparkSession, a) -> DataFrame:
    """Rows of a raw file as transaction and label messages."""
    rows = stored(load_transactions(spark, a.test, a.limit or None, a.skip), "replay")
    events = keyed_messages(to_event(rows), DEFAULT.key)
    keyed = rows.select(DEFAULT.key, F.col(DEFAULT.id).alias("transaction_id"), DEFAULT.label)
    labels = label_messages(keyed, DEFAULT.key)
    if a.bootstrap:
        publish_kafka(events, a.bootstrap, TRANSACTIONS_TOPIC)
        publish_kafka(labels, a.bootstrap, LABELS_TOPIC)
    else:
        publish_files(events, f"{a.out}/{TRANSACTIONS_TOPIC}")
        publish_files(labels, f"{a.out}/{LABELS_TOPIC}")
    return profile.split_summary(rows, [])


def backfill(spark: SparkSession, a) -> DataFrame:
    """State of every card after the train and validation periods."""
    state = snapshot(load_split(spark, a.data, ["train", "val"], STATE_COLUMNS))
    write_state(state, a.state)
    return read_state(spark, a.state).totals.agg(F.count(F.lit(1)).alias("cards"), F.sum("total_count").alias("rows"))


def verify_parity(spark: SparkSession, a) -> DataFrame:
    """Rows of the test period (the first n, if given): features continued from the state against the stored ones."""
    test = load_split(spark, a.data, "test", [*STATE_COLUMNS, *HISTORY_FEATURES])
    first = stored(in_time_order(test, limit=a.n or None), "parity")
    state = snapshot(load_split(spark, a.data, ["train", "val"], STATE_COLUMNS))
    online = history_features(first.select(*STATE_COLUMNS), before=state)
    return parity_report(online, first, DEFAULT.id, HISTORY_FEATURES)


def _messages(spark: SparkSession, a) -> DataFrame:
    if a.bootstrap:
        return kafka_messages(spark, a.bootstrap, max_per_trigger=a.max_per_batch)
    return file_messages(spark, a.input, a.files_per_trigger)


def _trigger(a) -> dict:
    return {"availableNow": True} if a.available_now else {"processingTime": f"{a.trigger_seconds} seconds"}


def _keep_rejected(rejected: DataFrame, a) -> StreamingQuery:
    sink = rejected.writeStream.foreachBatch(micro_batch_sink(f"{a.out}/rejected"))
    return sink.option("checkpointLocation", f"{a.checkpoint}/rejected").trigger(**_trigger(a)).start()


def stream_features(spark: SparkSession, a) -> None:
    """Valid events with history features, rejected ones beside them."""
    valid, rejected = split_valid(decode_events(_messages(spark, a)))
    queries = [_keep_rejected(rejected, a)]
    if a.engine == "tables":
        job = TableStateHistory(f"{a.checkpoint}/state", f"{a.out}/features", EVENT_COLUMNS)
        if a.state:
            job.seed(read_state(spark, a.state))
        queries.append(job.start(valid, f"{a.checkpoint}/features", **_trigger(a)))
    else:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        before = read_state(spark, a.state) if a.state else None
        writer = keyed_history(valid.drop("json"), before=before).writeStream
        sink = micro_batch_sink(f"{a.out}/features", lambda i, s: print(f"batch {i}: {s}", flush=True))
        writer = writer.foreachBatch(sink).option("checkpointLocation", f"{a.checkpoint}/features")
        queries.append(writer.trigger(**_trigger(a)).start())
    for query in queries:
        query.awaitTermination()


def stream_scores(spark: SparkSession, a) -> None:
    """Valid events to decisions with the champion and its own threshold, rejected ones beside them."""
    model, row = load_champion(read_versions(spark, a.registry))
    job = TableStateHistory(f"{a.checkpoint}/state", f"{a.out}/scored", EVENT_COLUMNS)
    if a.state:
        job.seed(read_state(spark, a.state))
    valid, rejected = split_valid(decode_events(_messages(spark, a)))
    score = scorer(model, row["threshold"], row["version"])
    for query in [_keep_rejected(rejected, a), job.start(valid, f"{a.checkpoint}/scores", score, **_trigger(a))]:
        query.awaitTermination()


def stream_latency(spark: SparkSession, a) -> DataFrame | None:
    """Decisions, latency and rate of the scored events under --input, kept per hour as sketches."""
    layout = spark.read.parquet(a.input).drop("batch_id").schema
    found = live_latency(spark.readStream.schema(layout).option("recursiveFileLookup", True).parquet(a.input))
    sink = found.writeStream.outputMode("append").foreachBatch(micro_batch_sink(f"{a.out}/latency"))
    sink.option("checkpointLocation", f"{a.checkpoint}/latency").trigger(**_trigger(a)).start().awaitTermination()
    return latency_report(spark.read.parquet(f"{a.out}/latency"))


def train(spark: SparkSession, a) -> DataFrame:
    """Baselines compared on the validation period; their fitted pipelines are kept under --models."""
    runs = {name: {"name": name} for name in ("prior", "logreg", "trees") if a.model in ("all", name)}
    done = compare_models(load_split(spark, a.data, "train"), load_split(spark, a.data, "val"), runs)
    if a.models:
        for name, model in done.models.items():
            model.write().overwrite().save(f"{a.models}/{name}")
    return done.metrics


def ablate(spark: SparkSession, a) -> DataFrame:
    """One model with all inputs and one without each group of inputs."""
    return compare(load_split(spark, a.data, "train"), load_split(spark, a.data, "val"), without_groups(model=a.model))


def imbalance(spark: SparkSession, a) -> DataFrame:
    """Ways of dealing with the rare class: none, weights, and chains of samplers such as undersample:0.1,smote:0.3,tomek."""
    chains = [[(step.partition(":")[0], float(step.partition(":")[2]) if ":" in step else None) for step in c.split(",")] for c in a.chain]
    return compare(load_split(spark, a.data, "train"), load_split(spark, a.data, "val"), resampled(chains, model=a.model))


def tune(spark: SparkSession, a) -> DataFrame:
    """Search, final fit, threshold, registration and promotion; the trials are kept beside the model."""
    rows, validation = load_split(spark, a.data, "train"), load_split(spark, a.data, "val")
    found = random_search(rows, validation, a.n_trials, a.train_sample)
    final = train_final(rows, validation, found.best)
    # Versions get their numbers when they are committed, so files have names of their own.
    path = f"{a.models}/{uuid.uuid4().hex}"
    final.model.write().save(path)
    found.trials.write.parquet(f"{path}-trials")

    def register(versions: DataFrame) -> DataFrame:
        number = (versions.agg(F.max("registered")).first()[0] or 0) + 1
        new = (str(number), number, None, final.metrics["pr_auc"], final.threshold, FALSE_ALARM_COST, path, False)
        return promote(versions, spark.createDataFrame([new], VERSION_SCHEMA))

    return change_versions(spark, a.registry, register)


def final_evaluation(spark: SparkSession, a) -> DataFrame:
    """The champion on the test period, once per version."""
    versions = read_versions(spark, a.registry)
    row = champion(versions)
    asked = versions.where(F.col("version") == row["version"])
    if not_yet_evaluated(asked, versions.where("test_evaluated"), force=a.force).isEmpty():
        raise SystemExit(f"version {row['version']} has already been evaluated on the test period")
    model, row = load_champion(versions)
    scored = stored(with_score(model, load_split(spark, a.data, ["val", "test"])), "scored")
    table = final_summary(scored, row["threshold"], row["fp_cost"])
    write_report(table, a.out)
    change_versions(spark, a.registry, lambda latest: mark_evaluated(latest, row["version"]))
    return table


def costs(spark: SparkSession, a) -> DataFrame:
    """Cheapest thresholds of the champion on validation for several costs of a false alarm."""
    model, _ = load_champion(read_versions(spark, a.registry))
    return cost_optimal(with_score(model, load_split(spark, a.data, "val")), SENSITIVITY_COSTS)


def monitor(spark: SparkSession, a) -> DataFrame:
    """Weeks of the test period against validation, optionally with a simulated shift."""
    model, _ = load_champion(read_versions(spark, a.registry))
    current = load_split(spark, a.data, "test")
    if a.inject_drift:
        current = inject_drift(current, DEFAULT.time, a.inject_drift, a.drift_factor)
    reference = stored(with_score(model, load_split(spark, a.data, "val")), "reference")
    report = stored(weekly_report(reference, stored(with_score(model, current), "current")), "report")
    write_report(report, a.out)
    alert_summary(report).show()
    return report.orderBy("week")


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(run, *paths):
        sub = jobs.add_parser(run.__name__.replace("_", "-"), help=run.__doc__)
        sub.set_defaults(run=run)
        for path in paths:
            sub.add_argument(f"--{path}", required=True)
        return sub

    job(prepare, "train", "test", "data").add_argument("--validation-start", default=VALIDATION_START)
    job(explore, "train", "out")
    sub = job(replay, "test")
    sub.add_argument("--out")
    sub.add_argument("--bootstrap")
    sub.add_argument("--limit", type=int, default=0, help="0 for all rows")
    sub.add_argument("--skip", type=int, default=0)
    job(backfill, "data", "state")
    job(verify_parity, "data").add_argument("--n", type=int, default=0, help="0 for all rows")
    for run, needed in ((stream_features, ()), (stream_scores, ("registry",))):
        sub = job(run, "out", "checkpoint", *needed)
        sub.add_argument("--input", help="folder of JSON lines")
        sub.add_argument("--bootstrap", help="Kafka servers instead of a folder")
        sub.add_argument("--state", help="backfilled state to start from")
        sub.add_argument("--engine", choices=["tables", "store"], default="tables")
        sub.add_argument("--files-per-trigger", type=int, default=1)
        sub.add_argument("--max-per-batch", type=int, default=MAX_PER_TRIGGER)
        sub.add_argument("--trigger-seconds", type=int, default=10)
        sub.add_argument("--available-now", action="store_true")
    sub = job(stream_latency, "input", "out", "checkpoint")
    sub.add_argument("--trigger-seconds", type=int, default=10)
    sub.add_argument("--available-now", action="store_true")
    sub = job(train, "data")
    sub.add_argument("--model", choices=["prior", "logreg", "trees", "all"], default="all")
    sub.add_argument("--models", help="folder for the fitted pipelines")
    for run in (ablate, imbalance):
        job(run, "data").add_argument("--model", choices=["logreg", "trees"], default="trees")
    jobs.choices["imbalance"].add_argument("--chain", action="append", default=[])
    sub = job(tune, "data", "models", "registry")
    sub.add_argument("--n-trials", type=int, default=20)
    sub.add_argument("--train-sample", type=float, default=1.0)
    job(final_evaluation, "data", "registry", "out").add_argument("--force", action="store_true")
    job(costs, "data", "registry")
    sub = job(monitor, "data", "registry", "out")
    sub.add_argument("--inject-drift", metavar="DATE")
    sub.add_argument("--drift-factor", type=float, default=1.8)
    return parser.parse_args(argv)


def run(spark: SparkSession, argv: list[str] | None = None) -> DataFrame | None:
    chosen = arguments(argv)
    started = time.perf_counter()
    table = chosen.run(prepare_session(spark), chosen)
    if table is not None:
        table.show(100, truncate=False)
    print(f"{chosen.job}: {time.perf_counter() - started:.1f}s", flush=True)
    return table


if __name__ == "__main__":
    run(SparkSession.builder.appName("tidemark").getOrCreate())

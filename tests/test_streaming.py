import json
from datetime import timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from samples import START, random_rows, slow_history, txns
from tidemark.columns import TxnColumns
from tidemark.functions.rules import split_valid
from tidemark.operators.labels import label_join
from tidemark.operators.state import snapshot
from tidemark.schemas import HISTORY_FEATURES
from tidemark.sources.readers import decode_events, file_messages
from tidemark.sources.writers import micro_batch_sink
from tidemark.streaming.keyed_state import CardMemory, exported_state, keyed_history
from tidemark.streaming.live import once
from tidemark.streaming.table_state import TableStateHistory

COLS = TxnColumns(id="transaction_id", amount="amount", time="event_time")


def event(row):
    id_, card, minute, amount = row
    time = (START + timedelta(minutes=minute)).isoformat()
    return json.dumps({"transaction_id": id_, "cc_num": card, "amount": amount, "timestamp": time})


def put(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text("\n".join(r if isinstance(r, str) else event(r) for r in rows) + "\n")


def events(spark, folder, files=None):
    decoded = decode_events(file_messages(spark, str(folder), files))
    return decoded.select("transaction_id", "cc_num", "amount", "event_time", "event_us")


def result(spark, path):
    return {r["transaction_id"]: r for r in spark.read.parquet(str(path)).collect()}


def assert_same(got, want):
    assert set(got) == set(want)
    for id_, features in want.items():
        assert [got[id_][f] for f in HISTORY_FEATURES] == pytest.approx(features, rel=1e-9, abs=1e-9)


def in_four(rows):
    """Cut where the minute changes, so that ties stay together."""
    cuts = [rows[i * len(rows) // 4][2] for i in (1, 2, 3)]
    return [[r for r in rows if lo <= r[2] < hi] for lo, hi in zip([-1, *cuts], [*cuts, 10**9])]


def table_job(tmp_path, **options):
    return TableStateHistory(str(tmp_path / "state"), str(tmp_path / "out"), COLS, **options)


@pytest.mark.parametrize("hot_rows,compact_every", [(20_000, 20), (10, 2)])
def test_tables_four_batches_equal_one_pass(spark, tmp_path, hot_rows, compact_every):
    rows = random_rows(300, 5, hot=0.4)
    job = table_job(tmp_path, hot_rows=hot_rows, compact_every=compact_every)
    for i, part in enumerate(in_four(rows)):
        put(tmp_path / "in", f"f{i}", part)
        job.start(events(spark, tmp_path / "in"), str(tmp_path / "checkpoint")).awaitTermination()
    got = result(spark, tmp_path / "out")
    assert_same(got, slow_history(rows))
    assert {r["batch_id"] for r in got.values()} == {0, 1, 2, 3} and not any(r["late"] for r in got.values())
    totals = {r["cc_num"]: r for r in job.state_after(spark, 3).totals.collect()}
    for card in "ABC":
        assert totals[card]["total_count"] == sum(r[1] == card for r in rows)


def test_tables_repeating_a_batch_changes_nothing(spark, tmp_path):
    first, second = in_four(random_rows(120, 1))[:2]
    job = table_job(tmp_path)

    def batch(rows):
        return txns(spark, rows).select(F.col("trans_num").alias("transaction_id"), "cc_num",
                                        F.col("trans_date_trans_time").alias("event_time"), F.col("amt").alias("amount"))

    job.process(batch(first), 0)
    job.process(batch(second), 1)
    once_only = result(spark, tmp_path / "out")
    state = sorted(map(tuple, job.state_after(spark, 1).totals.collect()))
    job.process(batch(first), 0)
    job.process(batch(second), 1)
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(first) + len(second)
    assert result(spark, tmp_path / "out") == once_only
    assert sorted(map(tuple, job.state_after(spark, 1).totals.collect())) == state


def test_tables_backfill_means_no_cold_start(spark, tmp_path):
    rows = random_rows(200, 7)
    cut = rows[140][2]
    job = table_job(tmp_path)
    job.seed(snapshot(txns(spark, [r for r in rows if r[2] < cut])))
    live = [r for r in rows if r[2] >= cut]
    put(tmp_path / "in", "live", live)
    job.start(events(spark, tmp_path / "in"), str(tmp_path / "checkpoint")).awaitTermination()
    want = slow_history(rows)
    assert_same(result(spark, tmp_path / "out"), {r[0]: want[r[0]] for r in live})


def test_tables_late_rows_are_marked(spark, tmp_path):
    job = table_job(tmp_path)
    for name, part in (("a", [("a", "X", 0, 10), ("b", "X", 50, 20)]), ("b", [("c", "X", 40, 5), ("d", "X", 55, 6)])):
        put(tmp_path / "in", name, part)
        job.start(events(spark, tmp_path / "in"), str(tmp_path / "checkpoint")).awaitTermination()
    got = result(spark, tmp_path / "out")
    assert got["c"]["late"] and not got["d"]["late"]
    assert (got["c"]["seconds_since_last_txn"], got["c"]["card_txn_count_1h"]) == (0, 1)
    assert (got["d"]["seconds_since_last_txn"], got["d"]["card_txn_count_1h"]) == (300, 3)
    assert got["d"]["amt_vs_card_mean"] == pytest.approx(6 / (35 / 3))


def state_store_run(spark, tmp_path, before=None, files=1):
    stream = keyed_history(events(spark, tmp_path / "in", files), before=before)
    writer = stream.writeStream.foreachBatch(micro_batch_sink(str(tmp_path / "out")))
    writer.option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start().awaitTermination()


def test_state_store_equals_one_pass_after_a_restart(spark, tmp_path):
    rows = random_rows(300, 5)
    for i, part in enumerate(in_four(rows)):
        put(tmp_path / "in", f"f{i}", part)
        if i % 2:
            state_store_run(spark, tmp_path, files=None)
    assert_same(result(spark, tmp_path / "out"), slow_history(rows))
    stored, batch = exported_state(spark, str(tmp_path / "checkpoint")), snapshot(txns(spark, rows))
    for side in ("totals", "recent"):
        a, b = (getattr(s, side).select(*(c for c in getattr(batch, side).columns if c != "id")) for s in (stored, batch))
        assert sorted(map(repr, a.selectExpr([f"round({c}, 6) {c}" if c in ("amt", "total_amount") else c for c in a.columns]).collect())) == \
            sorted(map(repr, b.selectExpr([f"round({c}, 6) {c}" if c in ("amt", "total_amount") else c for c in b.columns]).collect()))


def test_state_store_starts_from_a_backfill(spark, tmp_path):
    rows = random_rows(200, 7)
    cut = rows[140][2]
    live = [r for r in rows if r[2] >= cut]
    put(tmp_path / "in", "live", live)
    state_store_run(spark, tmp_path, snapshot(txns(spark, [r for r in rows if r[2] < cut])))
    want = slow_history(rows)
    assert_same(result(spark, tmp_path / "out"), {r[0]: want[r[0]] for r in live})


def test_memory_in_chunks_of_seven_equals_one_pass():
    rows = [r for r in random_rows(200, 3, cards=("A",))]
    us = np.array([r[2] * 60_000_000 for r in rows])
    amounts = np.array([r[3] for r in rows])
    windows = {"1h": 3600, "24h": 86400}
    whole = CardMemory().observe(us, amounts, windows, 604800)
    memory, parts, start = CardMemory(), [], 0
    while start < len(us):
        stop = min(start + 7, len(us))
        while stop < len(us) and us[stop] == us[stop - 1]:
            stop += 1
        parts.append(memory.observe(us[start:stop], amounts[start:stop], windows, 604800))
        start = stop
    chunks = pd.concat(parts, ignore_index=True)
    np.testing.assert_allclose(chunks.drop(columns="late").to_numpy(), whole.drop(columns="late").to_numpy(), rtol=1e-12)
    assert memory.us.min() >= us[-1] - 86400 * 1_000_000


def test_bad_bodies_go_to_the_dead_letters(spark, tmp_path):
    put(tmp_path / "in", "f", ["no json", json.dumps({"transaction_id": "x", "cc_num": "1", "amount": 5.0, "timestamp": "soon"})])
    rejected = split_valid(decode_events(file_messages(spark, str(tmp_path / "in"))))[1]
    seen = []
    sink = micro_batch_sink(str(tmp_path / "out"), lambda i, s: seen.append((i, s["rows"])), "amount")
    rejected.writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "c")).trigger(
        availableNow=True
    ).start().awaitTermination()
    rows = sorted(spark.read.parquet(str(tmp_path / "out")).collect(), key=lambda r: r["json"])
    assert seen == [(0, 2)]
    assert rows[0]["json"] == "no json" and len(rows[0]["violations"]) == 11
    assert "timestamp" in rows[1]["violations"] and "amount" not in rows[1]["violations"]


def test_redelivered_events_pass_once(spark, tmp_path):
    put(tmp_path / "in", "a", [("a", "X", 0, 10), ("b", "X", 5, 20), ("a", "X", 0, 10)])
    put(tmp_path / "in", "b", [("b", "X", 5, 20), ("c", "X", 6, 1)])
    writer = once(events(spark, tmp_path / "in", 1)).writeStream.foreachBatch(micro_batch_sink(str(tmp_path / "out")))
    writer.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r["transaction_id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b", "c"]


def test_duplicate_labels_do_not_multiply_predictions(spark):
    predictions = spark.createDataFrame([("a",), ("b",)], "transaction_id string")
    labels = spark.createDataFrame([("a", 1), ("a", 1), ("z", 0)], "transaction_id string, is_fraud int")
    assert sorted(map(tuple, label_join(predictions, labels).collect())) == [("a", 1), ("b", None)]

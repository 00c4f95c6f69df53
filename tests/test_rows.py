from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from samples import random_rows, txns
from tidemark.columns import DEFAULT
from tidemark.functions.rules import alerts_feed, decide, split_valid, with_violations
from tidemark.functions.scalars import haversine_km, iso_time
from tidemark.operators.clean import clean, in_time_order, time_split, to_event, to_label_event
from tidemark.operators.selection import between, order_keys
from tidemark.plans.dataset import build_dataset
from tidemark.schemas import EVENT_SCHEMA, FEATURES, PII_COLUMNS, RAW_SCHEMA
from tidemark.sources.readers import load_raw, load_split, load_transactions
from tidemark.sources.writers import keyed_messages, label_messages, write_dataset, write_report


def raw_row(**over):
    row = {
        "row_index": 0, "trans_date_trans_time": datetime(2019, 6, 1, 12), "cc_num": "0042", "merchant": "fraud_Shop",
        "category": "home", "amt": 10.0, "first": "A", "last": "B", "gender": "F", "street": "S", "city": "C",
        "state": "NY", "zip": "00501", "lat": 40.0, "long": -74.0, "city_pop": 1000, "job": "J",
        "dob": date(1980, 6, 1), "trans_num": "t1", "unix_time": 1, "merch_lat": 40.5, "merch_long": -74.5, "is_fraud": 0,
    }
    return row | over


def raw(spark, *overs):
    return spark.createDataFrame([tuple(raw_row(**o).values()) for o in overs], RAW_SCHEMA).drop("row_index")


def test_cleaning(spark):
    out = clean(raw(spark, {}, {"merchant": "fraud_fraud_x"}, {"merchant": "my_fraud_y"}))
    assert [r["merchant"] for r in out.collect()] == ["Shop", "fraud_x", "my_fraud_y"]
    assert not set(out.columns) & {"unix_time", *PII_COLUMNS}
    assert clean(out).columns == out.columns


def test_paris_to_london(spark):
    km = spark.range(1).select(haversine_km(*(F.lit(v) for v in (48.8566, 2.3522, 51.5074, -0.1278)))).first()[0]
    assert km == pytest.approx(344, abs=5)
    same = spark.range(1).select(haversine_km(F.lit(12.0), F.lit(7.0), F.lit(-12.0), F.lit(-173.0))).first()[0]
    assert same == pytest.approx(20015.09, abs=0.1)


def test_dataset_is_chronological_and_the_test_period_sees_history(spark):
    train = raw(spark, {"trans_num": "t1", "amt": 10.0}, {"trans_num": "t2", "amt": 20.0, "trans_date_trans_time": datetime(2020, 2, 1)})
    test = raw(spark, {"trans_num": "t3", "amt": 30.0, "trans_date_trans_time": datetime(2020, 7, 1)})
    rows = {r["split"]: r for r in build_dataset(train, test).collect()}
    assert {s: r["trans_num"] for s, r in rows.items()} == {"train": "t1", "val": "t2", "test": "t3"}
    assert rows["test"]["amt_vs_card_mean"] == pytest.approx(30 / 15)
    assert rows["train"]["age_years"] == pytest.approx(14244 / 365.25)
    assert rows["train"].__fields__[3 : 3 + len(FEATURES)] == FEATURES


def test_split_table_round_trip(spark, tmp_path):
    rows = raw(spark, {"trans_num": "t1"}, {"trans_num": "t2", "trans_date_trans_time": datetime(2020, 2, 1)})
    write_dataset(build_dataset(rows, rows.limit(0)), str(tmp_path / "d"))
    back = load_split(spark, str(tmp_path / "d"), ["val", "test"], ["trans_num", "amt"])
    assert [tuple(r) for r in back.collect()] == [("t2", 10.0)]
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<trans_num:string,amt:double>" in plan and "PartitionFilters" in plan


def test_typed_csv(spark, tmp_path):
    path = tmp_path / "raw.csv"
    names = ["", *[f.name for f in RAW_SCHEMA.fields[1:]]]
    lines = [",".join(names)]
    for i, minute in enumerate([5, 3, 4]):
        row = raw_row(row_index=i, trans_num=f"t{i}", trans_date_trans_time=f"2020-01-01 00:0{minute}:00")
        lines.append(",".join(str(v) for v in row.values()))
    lines.append(",".join(str(v) for v in raw_row(trans_num="t9", amt="much", trans_date_trans_time="2021-01-01 00:00:00").values()))
    path.write_text("\n".join(lines) + "\n")
    rows = load_raw(spark, str(path), keep_corrupt=True).orderBy("trans_num").collect()
    assert rows[0]["cc_num"] == "0042" and rows[0]["zip"] == "00501" and rows[0]["dob"] == date(1980, 6, 1)
    assert rows[3]["amt"] is None and "much" in rows[3]["_corrupt_record"] and rows[0]["_corrupt_record"] is None
    ordered = load_transactions(spark, str(path), limit=2, skip=1).collect()
    assert [r["trans_num"] for r in ordered] == ["t2", "t0"] and len(ordered[0]) == 12


def test_events_carry_no_label_and_ids_stay_text(spark):
    rows = raw(spark, {"is_fraud": 1, "trans_date_trans_time": datetime(2020, 1, 1, 1, 2, 3, 450000)})
    event = to_event(rows)
    assert event.columns == EVENT_SCHEMA.fieldNames()
    first = event.first()
    assert first["cc_num"] == "0042" and first["timestamp"] == "2020-01-01T01:02:03.450000" and first["customer_dob"] == "1980-06-01"
    assert with_violations(event).first()["violations"] == []
    assert tuple(to_label_event(rows).first()) == ("t1", 1)
    message = keyed_messages(event, "cc_num").first()
    assert bytes(message["key"]) == b"0042" and "is_fraud" not in message["value"]
    label = label_messages(rows.select("cc_num", F.col("trans_num").alias("transaction_id"), "is_fraud"), "cc_num").first()
    assert label["value"] == '{"transaction_id":"t1","is_fraud":1}'


@pytest.mark.parametrize(
    "field,value",
    [("amount", -5.0), ("amount", 0.0), ("amount", 1_000_000.01), ("category", "casino"), ("customer_lat", 200.0),
     ("cc_num", ""), ("amount", None), ("timestamp", "yesterday"), ("city_pop", -1), ("customer_dob", "1985-02-30")],
)
def test_contract_rejects(spark, field, value):
    kind = EVENT_SCHEMA[field].dataType
    bad = to_event(raw(spark, {})).withColumn(field, F.lit(value).cast(kind))
    accepted, rejected = split_valid(bad)
    assert accepted.count() == 0 and rejected.first()["violations"] == [field]


def test_decisions(spark):
    scores = spark.createDataFrame([(0.01,), (0.5,), (0.89,), (0.9,), (1.0,)], "score double")
    got = [r[0] for r in scores.select(decide(F.col("score"), 0.5)).collect()]
    assert got == ["approve", "review", "review", "decline", "decline"]
    high = spark.range(1).select(decide(F.lit(0.92), 0.95)).first()[0]
    assert high == "decline"


def test_alerts_hide_the_card(spark):
    rows = spark.createDataFrame([("4000123412341234", "review"), ("4", "approve")], "cc_num string, decision string")
    assert [tuple(r) for r in alerts_feed(rows, "cc_num").collect()] == [("...1234", "review")]


def test_iso_time_without_fraction(spark):
    row = spark.createDataFrame([(datetime(2020, 1, 1),)], "t timestamp_ntz").select(iso_time(F.col("t"))).first()
    assert row[0] == "2020-01-01T00:00:00"


def test_report_file(spark, tmp_path):
    write_report(spark.range(3).toDF("n"), str(tmp_path / "r"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "r")).count() == 3


@pytest.mark.parametrize("skip,limit", [(0, 3), (3, None), (5, 4), (9, 100), (200, None), (0, None)])
def test_positions_without_a_single_task(spark, skip, limit):
    rows = random_rows(200, 4, days=1) + [(f"z{i}", "A", 0, 1.0) for i in range(8)]
    df = txns(spark, rows)
    want = [r[0] for r in sorted(rows, key=lambda r: (r[2], r[0]))][skip : None if limit is None else skip + limit]
    assert [r["trans_num"] for r in in_time_order(df, skip, limit).collect()] == want
    if skip or limit:
        keys = order_keys(df, DEFAULT.time, DEFAULT.id)
        rest = between(df, keys, skip, None if limit is None else skip + limit).orderBy("trans_date_trans_time", "trans_num").collect()
        assert [r["trans_num"] for r in rest] == want


def test_rows_without_a_time(spark):
    rows = [("a", None, "train"), ("b", datetime(2019, 5, 1), "train"), ("c", datetime(2020, 5, 1), "train"), ("d", None, "test")]
    df = spark.createDataFrame(rows, "trans_num string, trans_date_trans_time timestamp_ntz, source string")
    splits = {r["trans_num"]: r["split"] for r in time_split(df).collect()}
    assert splits == {"a": None, "b": "train", "c": "val", "d": "test"}
    assert [r["trans_num"] for r in in_time_order(df, 1, 2).collect()] == ["d", "b"]
    assert [r["trans_num"] for r in in_time_order(df, 0, 3).collect()] == ["a", "d", "b"]
    assert [r["trans_num"] for r in in_time_order(df, 3).collect()] == ["c"]

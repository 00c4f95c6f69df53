"""Selection of the first rows against plain sorting, with ties, nulls, repeated rows and extreme keys."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators.clean import in_time_order
from tidemark.operators.selection import between, border, order_keys

SCHEMA = "trans_date_trans_time timestamp_ntz, trans_num string, amt double"


def rows_of(n, seed=0):
    rng = np.random.default_rng(seed)
    start = datetime(2024, 1, 1)
    rows = [(start + timedelta(seconds=int(rng.integers(0, n // 4))), f"{rng.integers(0, 50):03d}ä{'x' * int(rng.integers(0, 20))}", float(i)) for i in range(n)]
    rows += [(None, "b", 1.0), (None, "a", 1.0), (None, None, 2.0), (start, None, 1.0), (start, "", 1.0), (start, "a", 1.0), (start, "ab", 1.0)]
    return rows + [(start, "same", 7.0)] * 30 + [(start + timedelta(days=3650), "same", 7.0)] * 9


def order(r):
    return (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())


@pytest.mark.parametrize(("skip", "limit"), [(0, 10), (0, 60), (3, 40), (25, 10), (200, None), (439, None), (444, 5), (446, None), (500, 3), (0, 0)])
def test_between_positions(spark, skip, limit):
    rows = rows_of(400)
    assert len(rows) == 446
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = [tuple(r) for r in in_time_order(df, skip, limit).collect()]
    want = sorted(rows, key=order)[skip : None if limit is None else skip + limit]
    # Which of the rows that agree in time and id are taken at a border is open.
    assert [order(r) for r in got] == [order(r) for r in want]
    left = list(rows)
    for r in got:
        left.remove(r)


def test_rows_before_and_after_a_border_are_all_rows(spark):
    df = spark.createDataFrame(rows_of(300, 1), SCHEMA).repartition(4)
    keys = order_keys(df, "trans_date_trans_time", "trans_num")
    for cut in (1, 57, 330, 345):
        parts = between(df, keys, 0, cut), between(df, keys, cut, None)
        assert parts[0].count() == cut
        assert sorted(map(tuple, parts[0].unionAll(parts[1]).collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)


def test_all_rows_at_one_time(spark):
    df = spark.range(50_000).select(
        F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz").alias("trans_date_trans_time"), F.col("id").alias("trans_num"), F.lit(1.0).alias("amt")
    )
    assert [r["trans_num"] for r in in_time_order(df, 20_000, 5).collect()] == list(range(20_000, 20_005))
    plan = between(df, order_keys(df, "trans_date_trans_time", "trans_num"), 20_000, 20_005)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan and "Exchange" not in plan


def test_extreme_keys(spark):
    values = [-(1 << 63), -1, 0, 1, (1 << 63) - 1, None, 5, 5]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    keys = order_keys(df, "v")
    for k in range(1, 8):
        got = [r[0] for r in between(df, keys, 0, k).collect()]
        want = sorted(values, key=lambda v: -(1 << 63) if v is None else v)[:k]
        assert sorted(got, key=lambda v: -(1 << 63) if v is None else v)[2:] == want[2:] and len(got) == k
    assert border(df, keys, 8) is None and border(df, keys, 0) is None and border(df.limit(0), keys, 1) is None

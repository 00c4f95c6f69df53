import numpy as np
import pytest

from tidemark.operators.profile import latency_summary
from tidemark.operators.sketch import merge_sketches, quantile_sketches, rank_error, sketch_quantiles


def test_merged_sketches_are_as_close_as_one(spark, tmp_path):
    rng = np.random.default_rng(3)
    values = rng.gamma(2, 30, 60_000)
    rows = [("a" if i % 4 else "b", i % 30, float(v)) for i, v in enumerate(values)]
    rows += [("a", 0, None), ("a", 0, float("nan")), ("empty", 0, None)]
    df = spark.createDataFrame(rows, "g string, day int, v double")
    path = str(tmp_path / "sketches")
    quantile_sketches(df, "v", ["g", "day"]).write.parquet(path)
    merged = merge_sketches(spark.read.parquet(path), ["g"])
    shares = {"low": 0.05, "middle": 0.5, "high": 0.99}
    got = {r["g"]: r for r in sketch_quantiles(merged, shares).collect()}
    assert set(got) == {"a", "b"}
    for g, row in got.items():
        own = np.sort([v for name, _, v in rows if name == g and v is not None and v == v])
        assert row["n"] == len(own) and row["parts"] == len({d for name, d, v in rows if name == g and v})
        for name, share in shares.items():
            assert abs(np.searchsorted(own, row[name]) / len(own) - share) <= 3 * rank_error()


def test_rate_of_a_feed(spark):
    rows = [(1, f"2024-01-01 00:00:{s:02d}", float(s)) for s in range(0, 41, 10)] + [(None, "2024-01-01 00:00:00", 1.0), (2, "2024-01-01 00:00:00", None)]
    df = spark.createDataFrame(rows, "g int, t string, v double").selectExpr("g", "CAST(t AS timestamp_ntz) AS t", "v")
    got = {r["g"]: (r["n"], r["p50"], r["per_second"]) for r in latency_summary(df, "v", ["g"], time="t").collect()}
    assert got == {1: (5, 20.0, pytest.approx(0.125)), None: (1, 1.0, None)}
    assert latency_summary(df, "v", time="t").first()["per_second"] == pytest.approx(6 / 40)

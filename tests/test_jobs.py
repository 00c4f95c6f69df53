"""The jobs one after the other over a small raw file, as a user would run them."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from test_rows import raw_row
from tidemark.jobs import run
from tidemark.operators.ranking import evaluate
from tidemark.plans.registry import champion, read_versions
from tidemark.plans.training import with_score
from tidemark.schemas import CATEGORIES, RAW_SCHEMA


def write_csv(path, n, start, seed):
    rng = np.random.default_rng(seed)
    names = ["", *[f.name for f in RAW_SCHEMA.fields[1:]]]
    lines, time = [",".join(names)], datetime.fromisoformat(start)
    for i in range(n):
        time += timedelta(minutes=int(rng.integers(1, 240)))
        fraud = int(rng.random() < 0.1)
        row = raw_row(row_index=i, trans_num=f"{seed}-{i:05d}", trans_date_trans_time=str(time), cc_num=f"00{rng.integers(0, 9)}",
                      amt=round(float(rng.gamma(2, 40 + 300 * fraud)) + 1, 2), is_fraud=fraud, category=CATEGORIES[i % 14])
        lines.append(",".join(str(v) for v in row.values()))
    path.write_text("\n".join(lines) + "\n")


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    base = tmp_path_factory.mktemp("jobs")
    write_csv(base / "train.csv", 1500, "2019-09-01", 1)
    write_csv(base / "test.csv", 900, "2020-07-01", 2)
    return base


def test_jobs_from_raw_files_to_reports(spark, folder, monkeypatch):
    def at(name):
        return str(folder / name)

    def job(*argv):
        return run(spark, list(argv))

    summary = job("prepare", "--train", at("train.csv"), "--test", at("test.csv"), "--data", at("data"))
    assert {r["split"] for r in summary.collect()} == {"train", "val", "test"}
    assert job("explore", "--train", at("train.csv"), "--out", at("explore")).first()["positives"] > 0
    assert all(r["equal"] for r in job("verify-parity", "--data", at("data"), "--n", "300").collect())
    assert job("backfill", "--data", at("data"), "--state", at("state")).first()["rows"] == 1500

    job("replay", "--test", at("test.csv"), "--limit", "0", "--out", at("feed"))
    stream = ["--input", at("feed/transactions"), "--state", at("state"), "--available-now"]
    stored = spark.read.parquet(at("data")).where("split = 'test'")
    for engine in ("tables", "store"):
        job("stream-features", *stream, "--engine", engine, "--out", at(engine), "--checkpoint", at(f"{engine}-c"))
        live = spark.read.parquet(at(f"{engine}/features"))
        both = live.join(stored.select(F.col("trans_num").alias("id"), F.col("amt_vs_card_mean").alias("want")), F.col("transaction_id") == F.col("id"))
        assert both.where("abs(amt_vs_card_mean - want) < 1e-9").count() == 900

    import tidemark.plans.training as training

    monkeypatch.setattr(training, "SEARCH_SPACE", {"n_estimators": ("step", 2, 3, 1), "max_depth": ("step", 2, 3, 1)})
    table = job("train", "--data", at("data"), "--model", "logreg", "--models", at("baselines")).collect()
    assert [r["run"] for r in table] == ["logreg"] and table[0]["train_seconds"] > 0
    again = PipelineModel.load(at("baselines/logreg"))
    measured = evaluate(with_score(again, spark.read.parquet(at("data")).where("split = 'val'"))).first()
    assert measured["pr_auc"] == pytest.approx(table[0]["pr_auc"])
    names = [r["run"] for r in job("ablate", "--data", at("data"), "--model", "logreg").collect()]
    assert names == ["full", "without history", "without amount"]
    chains = ["--chain", "undersample:0.5", "--chain", "smote:0.4,tomek"]
    names = [r["run"] for r in job("imbalance", "--data", at("data"), "--model", "logreg", *chains).collect()]
    assert names == ["plain", "weighted", "undersample 0.5", "smote 0.4, tomek"]

    monkeypatch.setattr(training.random_search, "__defaults__", (1.0, training.SEARCH_SPACE, 42, training.DEFAULT))
    registry = ["--data", at("data"), "--registry", at("registry")]
    job("tune", *registry, "--models", at("models"), "--n-trials", "1")
    first = champion(read_versions(spark, at("registry")))
    assert first["version"] == "1"
    trials = spark.read.parquet(f"{first['model_path']}-trials").collect()
    assert len(trials) == 1 and trials[0]["pr_auc"] > 0
    table = {r["metric"]: r for r in job("final-evaluation", *registry, "--out", at("final")).collect()}
    assert table["rows"]["test"] == 900 and table["frauds"]["val"] > 0
    with pytest.raises(SystemExit):
        job("final-evaluation", *registry, "--out", at("final"))
    assert job("costs", *registry).count() == 5
    assert job("monitor", *registry, "--out", at("weekly"), "--inject-drift", "2020-08-01").count() == 0
    job("stream-scores", *stream, "--registry", at("registry"), "--out", at("live"), "--checkpoint", at("live-c"))
    assert spark.read.parquet(at("live/scored")).groupBy("decision").count().agg(F.sum("count")).first()[0] == 900
    latency = ["--input", at("live/scored"), "--out", at("live"), "--checkpoint", at("live-c"), "--available-now"]
    found = job("stream-latency", *latency).collect()
    assert 850 < sum(r["events"] for r in found) <= 900 and all(r["n"] == r["events"] and 0 < r["p50"] <= r["p99"] for r in found)

"""Events that a scoring stream rejects are kept beside the scored ones."""

from tidemark import jobs
from test_jobs import write_csv


def test_stream_scores_keeps_rejected_events(spark, tmp_path, monkeypatch):
    write_csv(tmp_path / "test.csv", 5, "2020-07-01", 2)
    jobs.run(spark, ["replay", "--test", str(tmp_path / "test.csv"), "--limit", "0", "--out", str(tmp_path / "feed")])
    folder = tmp_path / "feed" / "transactions"
    (folder / "bad.json").write_text("no json\n")
    monkeypatch.setattr(jobs, "read_versions", lambda *a: None)
    monkeypatch.setattr(jobs, "load_champion", lambda versions: (None, {"threshold": 0.5, "version": "1"}))
    monkeypatch.setattr(jobs, "scorer", lambda *a: lambda events: events.select("transaction_id"))
    out = str(tmp_path / "out")
    stream = ["--input", str(folder), "--available-now", "--files-per-trigger", "100"]
    jobs.run(spark, ["stream-scores", *stream, "--registry", "none", "--out", out, "--checkpoint", str(tmp_path / "c")])
    assert spark.read.parquet(f"{out}/scored").count() == 5
    rejected = spark.read.parquet(f"{out}/rejected").collect()
    assert [r["json"] for r in rejected] == ["no json"] and rejected[0]["violations"]

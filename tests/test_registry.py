from concurrent.futures import ThreadPoolExecutor
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from tidemark.plans.registry import VERSION_SCHEMA, LostRace, change_versions, mark_evaluated, promote, read_versions, revisions
from tidemark.session import create_once, read_small_files


def entered(spark, score):
    def change(versions):
        number = (versions.agg(F.max("registered")).first()[0] or 0) + 1
        new = (str(number), number, None, score, 0.5, 10.0, f"model-{score}", False)
        return promote(versions, spark.createDataFrame([new], VERSION_SCHEMA))

    return change


def test_two_writers_at_once_leave_one_champion(spark, tmp_path):
    path, together, scores = str(tmp_path / "registry"), Barrier(4), [0.3, 0.9, 0.5, 0.7]

    def register(score):
        decide, tries = entered(spark, score), []

        def change(versions):
            if not tries:
                together.wait()
            tries.append(1)
            return decide(versions)

        change_versions(spark, path, change)
        return len(tries)

    with ThreadPoolExecutor(4) as pool:
        tries = list(pool.map(register, scores))
    assert sum(tries) > 4
    rows = read_versions(spark, path).collect()
    assert sorted(r["version"] for r in rows) == ["1", "2", "3", "4"]
    assert [r["val_pr_auc"] for r in rows if r["alias"] == "champion"] == [0.9]
    assert sum(r["alias"] == "challenger" for r in rows) <= 1
    sizes = {r["revision"]: r["count"] for r in revisions(spark, path).groupBy("revision").count().collect()}
    assert sizes == {1: 1, 2: 2, 3: 3, 4: 4}
    assert len(list((tmp_path / "registry" / "tables").iterdir())) == 4


def test_a_writer_that_always_loses_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "registry")
    change_versions(spark, path, entered(spark, 0.5))

    def late(versions):
        change_versions(spark, path, entered(spark, 0.4))
        return mark_evaluated(versions, "1")

    with pytest.raises(LostRace):
        change_versions(spark, path, late, attempts=2)
    rows = read_versions(spark, path).collect()
    assert len(rows) == 3 and not any(r["test_evaluated"] for r in rows)
    assert len(list((tmp_path / "registry" / "tables").iterdir())) == 3


def test_nothing_registered(spark, tmp_path):
    assert read_versions(spark, str(tmp_path / "none")).count() == 0
    assert revisions(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("root", ["file:", "viewfs://shared"])
def test_a_file_is_created_once(spark, tmp_path, root):
    """By a hard link on a local disk, by a rename on other stores."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.shared.link./tmp", "file:///tmp")
    conf.set(f"fs.viewfs.mounttable.shared.link./{tmp_path.parts[1]}", f"file:///{tmp_path.parts[1]}")
    folder = f"{root}{tmp_path}/f"
    assert create_once(spark, f"{folder}/1", "first") and not create_once(spark, f"{folder}/1", "second")
    assert read_small_files(spark, folder) == {"1": "first"}
    assert [p.name for p in (tmp_path / "f").iterdir() if not p.name.startswith(".")] == ["1"]

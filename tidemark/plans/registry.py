"""Model versions as a table: champion, challenger, and the one look at the test period."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import create_once, delete_path, read_small_files

VERSION_SCHEMA = T.StructType(
    [
        T.StructField("version", T.StringType()),
        T.StructField("registered", T.LongType()),
        T.StructField("alias", T.StringType()),
        T.StructField("val_pr_auc", T.DoubleType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("fp_cost", T.DoubleType()),
        T.StructField("model_path", T.StringType()),
        T.StructField("test_evaluated", T.BooleanType()),
    ]
)


def promote(versions: DataFrame, new: DataFrame) -> DataFrame:
    """Add one new version: champion if it strictly beats the champion (or there is none), else challenger.

    An alias belongs to one version only, so whoever held it before loses it.
    """
    champion = versions.agg(F.max(F.when(F.col("alias") == "champion", F.col("val_pr_auc"))).alias("_best"))
    beats = F.col("_best").isNull() | (F.col("val_pr_auc") > F.col("_best"))
    entered = new.drop("alias").join(F.broadcast(champion), F.lit(True), "left")
    entered = entered.withColumn("alias", F.when(beats, F.lit("champion")).otherwise(F.lit("challenger"))).drop("_best")
    taken = entered.agg(F.max("alias").alias("_taken"))
    kept = versions.join(F.broadcast(taken), F.lit(True), "left").withColumn(
        "alias", F.when(F.col("alias").eqNullSafe(F.col("_taken")), F.lit(None)).otherwise(F.col("alias"))
    )
    return kept.drop("_taken").unionByName(entered, allowMissingColumns=True)


def promotion_history(versions: DataFrame, order: str = "registered", model: str | None = None) -> DataFrame:
    """The alias each version got when it was registered; the champion's score is the best one so far."""
    line = (Window.partitionBy(model) if model else Window.partitionBy(F.lit(0))).orderBy(order)
    best = F.max("val_pr_auc").over(line.rowsBetween(Window.unboundedPreceding, -1))
    beats = best.isNull() | (F.col("val_pr_auc") > best)
    return versions.withColumn("alias", F.when(beats, F.lit("champion")).otherwise(F.lit("challenger")))


def not_yet_evaluated(requested: DataFrame, evaluations: DataFrame, version: str = "version", force: bool = False) -> DataFrame:
    """Versions that may still be measured on the test period; each only once unless forced."""
    return requested if force else requested.join(evaluations.select(version), version, "left_anti")


def mark_evaluated(versions: DataFrame, version: str) -> DataFrame:
    """Remember that the test period has been opened for a version."""
    opened = (F.col("version") == version) | F.coalesce("test_evaluated", F.lit(False))
    return versions.withColumn("test_evaluated", opened)


def champion(versions: DataFrame) -> Row:
    row = versions.where(F.col("alias") == "champion").first()
    if row is None:
        raise LookupError("no champion has been promoted")
    return row


def load_champion(versions: DataFrame) -> tuple[PipelineModel, Row]:
    """The champion's model with the row that holds its own threshold."""
    row = champion(versions)
    return PipelineModel.load(row["model_path"]), row


class LostRace(RuntimeError):
    """Other writers were first, every time."""


def change_versions(
    spark: SparkSession, path: str, change: Callable[[DataFrame], DataFrame], attempts: int = 20
) -> DataFrame:
    """Apply `change` to the latest table and commit the result as the next revision; earlier revisions stay.

    Writers need no lock. The table is written under a name of its own, then the revision's number is claimed by a
    small file that only one writer can create. Whoever loses reads the new latest table and decides again, so
    `change` may run several times and must depend on its argument alone.
    """
    for _ in range(attempts):
        number, latest = _latest(spark, path)
        name = uuid.uuid4().hex
        changed = change(_table(spark, path, latest))
        changed.select(*VERSION_SCHEMA.fieldNames()).coalesce(1).write.parquet(f"{path}/{_TABLES}/{name}")
        if create_once(spark, f"{path}/{_REVISIONS}/{number + 1:09d}", name):
            return _table(spark, path, name)
        delete_path(spark, f"{path}/{_TABLES}/{name}")
    raise LostRace(f"{path}: no revision committed in {attempts} attempts")


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    """The latest revision, or an empty table."""
    return _table(spark, path, _latest(spark, path)[1])


def revisions(spark: SparkSession, path: str) -> DataFrame:
    """All revisions one below the other, with their number."""
    numbered = [_table(spark, path, name).withColumn("revision", F.lit(n)) for n, name in _committed(spark, path)]
    return reduce(DataFrame.unionByName, numbered, _table(spark, path, None).withColumn("revision", F.lit(0)))


_TABLES, _REVISIONS = "tables", "revisions"


def _committed(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    return sorted((int(n), name) for n, name in read_small_files(spark, f"{path}/{_REVISIONS}").items())


def _latest(spark: SparkSession, path: str) -> tuple[int, str | None]:
    return max(_committed(spark, path), default=(0, None))


def _table(spark: SparkSession, path: str, name: str | None) -> DataFrame:
    if name is None:
        return spark.createDataFrame([], VERSION_SCHEMA)
    return spark.read.schema(VERSION_SCHEMA).parquet(f"{path}/{_TABLES}/{name}")

"""From raw documents to packed training sequences: five stages, each a written table for the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, ngram_join, quality, queries, toxicity
from tidemark.session import new_working_path

LEAST_QUALITY = 0.5
MOST_TOXICITY = 0.5


def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules score as good; the rules are learned from the corpus's labels."""
    model = quality.fit(*_tables(spark, sf_dir), label="quality")
    return quality.score(docs, model, name="_score").where(F.col("_score") >= LEAST_QUALITY).drop("_score")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a sentence that makes them toxic."""
    model = toxicity.fit(*_tables(spark, sf_dir), label="toxic")
    return toxicity.score(docs, model, name="_score").where(F.col("_score") < MOST_TOXICITY).drop("_score")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of the documents that are equal but for white space."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 or more over runs of five words."""
    return ngram_join.drop_near_duplicates(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences of 2048 tokens."""
    return queries.packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good),
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("packing", pack),
]

#: The learned stages have no SQL form; tests hold the others against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_working_path(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

"""Exact duplicates by two passes over a Bloom filter.

The first pass puts the hash of every document into a filter whose cells count to two. A hash that occurs
twice leaves a count of two in each of its cells, so the second pass, which keeps one bit per cell ("twice or
more"), finds every repeated hash and few others. Only rows with such a hash are shuffled, as narrow rows
without their text; the rest pass straight through.

The filter has 16 cells per document and at most 2**max_bits cells (32 MB as broadcast bits by default).
Beyond that more unique rows pass for "possibly repeated" and are shuffled too; results never change.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import BLANKS, attach, cell_filter, filter_bits, in_filter, kept_rows, row_key, stored, text_of

MAX_BITS = 28


def text_digest(text: str) -> Column:
    """SHA-256 (binary) of the text without white space."""
    return F.unhex(F.sha2(F.regexp_replace(text_of(text), BLANKS + "+", ""), 256))


def possibly_repeated(spark: SparkSession, chunks: dict[int, bytes], bits: int):
    """A function of a column of 64-bit hashes: false means that the hash occurs once."""
    shared = spark.sparkContext.broadcast(chunks)

    @F.pandas_udf("boolean")
    def test(hashes: pd.Series) -> pd.Series:
        return pd.Series(in_filter(shared.value, bits, hashes.to_numpy()))

    return test


def _resolved(docs: DataFrame, id: str, text: str, max_bits: int):
    """Narrow rows with the mark "possibly repeated", the marked rows, their groups, the test, the number of rows."""
    rows = stored(
        docs.select(
            F.col(id).alias("_id"),
            text_digest(text).alias("_sha"),
            F.length(text_of(text)).alias("_chars"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "digests",
    )
    total = rows.count()
    bits = filter_bits(total, max_bits)
    chunks = cell_filter(rows.select(F.xxhash64("_sha").alias("h")), "h", bits, least=2)
    test = possibly_repeated(docs.sparkSession, chunks, bits)
    marked = rows.withColumn("_maybe", test(F.xxhash64("_sha")))
    maybe = stored(marked.where("_maybe").drop("_maybe"), "possibly-repeated")
    # ~x falls as x rises and cannot overflow; max() over structs compares field by field.
    rank = F.struct(
        "_chars",
        F.col("_id").isNotNull().alias("has"),
        F.bitwise_not("_id").alias("id"),
        F.bitwise_not("_row").alias("row"),
    )
    groups = stored(maybe.groupBy("_sha").agg(F.count(F.lit(1)).alias("_n"), F.max(rank).alias("_best")), "groups")
    return marked, maybe, groups, test, total


def exact_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256 (lowercase hex).

    Texts are equal when they are without white space; null counts as empty. Of equal texts the row with the most
    code points stays, then the smallest id; a null id comes after all others; of fully repeated rows one stays.
    Other columns play no part, whatever their names. An empty table gives an empty result.
    """
    marked, maybe, groups, _, total = _resolved(docs, id, text, max_bits)
    digest = F.lower(F.hex("_sha")).alias("text_sha256")
    met = attach(maybe, groups, "_sha", "_n", total).select(
        F.col("_id").alias(id),
        F.bitwise_not("_best.id").alias("keep_id"),
        F.col("_n").alias("group_size"),
        (F.col("_row") == F.bitwise_not("_best.row")).alias("kept"),
        digest,
    )
    alone = marked.where(~F.col("_maybe")).select(
        F.col("_id").alias(id),
        F.col("_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        digest,
    )
    return alone.unionByName(met)


def drop_exact_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS
) -> DataFrame:
    """The documents that stay, with all their columns, by the rules of `exact_duplicates`.

    Only documents that the filter marks are shuffled with their text.
    """
    _, _, groups, test, _ = _resolved(docs, id, text, max_bits)
    keyed = docs.withColumn("_sha", text_digest(text))
    keyed = keyed.withColumn("_keep_key", row_key(id, F.hex("_sha"))).withColumn("_maybe", test(F.xxhash64("_sha")))
    best = groups.select(F.bitwise_not("_best.id").alias("_id"), "_sha")
    best = best.select(row_key("_id", F.hex("_sha")).alias("_keep_key"))
    straight = keyed.where(~F.col("_maybe")).drop("_keep_key", "_sha", "_maybe")
    kept = kept_rows(keyed.where("_maybe"), best, "_keep_key", F.length(text_of(text)).desc())
    return straight.unionByName(kept.drop("_sha", "_maybe"))

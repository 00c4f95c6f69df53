"""What the vector operators share: usable rows, block meetings of two sides, connected components without hot tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import attach, stored


def whole(vector: Column) -> Column:
    """Neither null nor holding a null or non-finite component; an empty vector is whole."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return vector.isNotNull() & finite


def padded(vector: Column, length: int, zero: Column) -> Column:
    """The vector as if it ended in zeros up to that length."""
    return F.concat(vector, F.array_repeat(zero, F.lit(length) - F.size(vector)))


def longest(rows: DataFrame, vector: str) -> int:
    return rows.agg(F.max(F.size(vector))).first()[0] or 0


def task_count(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def meetings(held: DataFrame, streamed: DataFrame, order: list[str | Column]) -> DataFrame:
    """Both sides dealt so that every held row meets every streamed row of its group once, in bounded pieces.

    Both have `key` (the group), `node`, `lanes` and `batches` and otherwise the same columns. The held rows of a group
    are spread over its `lanes`, the streamed ones over its `batches`; each pair of a lane and a batch is one cell, whose
    held rows (`side` 0) come before its streamed ones, those in `order`. Cells are told apart by 64 bits.
    """
    apart = ["lanes", "batches"]
    a = held.withColumn("lane", F.pmod(F.xxhash64("node"), F.col("lanes")))
    a = a.withColumn("batch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("batches") - 1))).withColumn("side", F.lit(0))
    b = streamed.withColumn("batch", F.pmod(F.xxhash64("node", F.lit(7)), F.col("batches")))
    b = b.withColumn("lane", F.explode(F.sequence(F.lit(0).cast("long"), F.col("lanes") - 1))).withColumn("side", F.lit(1))
    both = a.unionByName(b).withColumn("cell", F.xxhash64("key", "lane", "batch")).drop("key", "lane", "batch", *apart)
    dealt = both.repartition(task_count(held), "cell")
    return dealt.sortWithinPartitions("cell", "side", *order)


def parts(total: Column, rows: int) -> Column:
    """How many pieces of at most about `rows` rows; one at least."""
    return F.greatest(F.lit(1), F.ceil(total / rows)).cast("long")


def matrix(column: pa.Array, dtype: str = "float64") -> np.ndarray:
    """Lists of one length as rows; of no rows a matrix without rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    return flat.reshape(len(column), len(flat) // max(1, len(column)))


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that edges (u, v) reach, for every node of an edge between two nodes.

    Every node points to its smallest neighbour, pointers are followed to their ends, and the ends become the nodes of
    the remaining edges, at most half as many. Rows that share an end are joined with it by `attach`, so an end that a
    third of all nodes point to is no single task's work. Each turn is a written table.
    """
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = stored(edges, "edges")
    known, left = None, edges.count()
    while left:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = both.groupBy("u").agg(F.min("v").alias("p"), F.count(F.lit(1)).alias("degree"))
        near = _to_ends(stored(near.select(F.col("u").alias("node"), F.least("p", "u").alias("p"), "degree"), "pointers"))
        if known is None:
            known = near.select("node", F.col("p").alias("root"))
        else:
            known = stored(_followed(known, near.select(F.col("node").alias("root"), "p"), "root", "p"), "roots")
        ends = near.select("node", "p", "degree")
        first = attach(edges, ends.select(F.col("node").alias("u"), F.col("p").alias("a"), "degree"), "u", "degree", left)
        second = attach(first.select("v", "a"), ends.select(F.col("node").alias("v"), F.col("p").alias("b"), "degree"), "v", "degree", left)
        rest = second.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
        edges = stored(rest, "edges")
        left = edges.count()
    if known is None:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return known


def _to_ends(near: DataFrame) -> DataFrame:
    """(node, p, degree) with p followed until it points to itself."""
    while near.where("node <> p").join(near.where("node <> p").select(F.col("node").alias("p")), "p", "left_semi").limit(1).count():
        near = stored(_followed(near, near.select(F.col("node").alias("p"), F.col("p").alias("next")), "p", "next"), "pointers")
    return near


def _followed(rows: DataFrame, pointers: DataFrame, at: str, to: str) -> DataFrame:
    """`rows` whose column `at` is replaced by where `pointers` (at, to) lead; where they lead nowhere it stays."""
    sizes = rows.groupBy(at).agg(F.count(F.lit(1)).alias("_held"))
    targets = sizes.join(pointers, at, "left").select(at, F.coalesce(to, at).alias("_to"), "_held")
    moved = attach(rows, stored(targets, "targets"), at, "_held", rows.count())
    return moved.withColumn(at, F.col("_to")).select(*rows.columns)

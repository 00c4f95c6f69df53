"""Approximate nearest neighbours by a permutation index.

A vector is represented by the order of its nearest pivots. The index is cut into blocks of vectors (by a hash of
the id); in every block each pivot has an inverted file of the vectors that have it among their nearest
`prefix` pivots, with its position. A query adds up, over the files of its own nearest pivots, how much the
positions agree, which gives the footrule distance to every vector of the block; the nearest share of the
block is compared exactly, in double precision, and the best of all blocks are merged.

Nearness is an inner product, orders of pivots follow angles. So vectors get one more coordinate that brings all to one
length, and queries a zero there: the angle to a query then falls as the inner product rises. That length is the LONG
quantile of all; the few longer vectors are compared with every query, so that they do not flatten the angles of the rest.

Every vector is indexed; only the pivots are a bounded sample. Equal vectors are indexed once, with their smallest
ids, which are all that a list of neighbours can need. Queries meet blocks in batches of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

PIVOTS = 256
PREFIX = 64
SHARE = 0.15
#: Rows of a block that are compared exactly at least.
LEAST_COMPARED = 512
LONG = 0.98
NEIGHBOURS = 20
BLOCK_ROWS = 16_384
QUERY_ROWS = 2_048


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda v: v != 0)


def usable_vectors(table: DataFrame, id: str, vector: str) -> DataFrame:
    """(id, x): rows that take part. A repeated id counts once, with its smallest vector."""
    rows = table.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("x"))
    rows = rows.where(F.col("id").isNotNull() & _usable(F.col("x")))
    rows = stored(rows.groupBy("id").agg(F.min("x").alias("x")), "vectors")
    usual = rows.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("x") == (usual["n"] if usual else 0))


def _distinct(rows: DataFrame, keep: int) -> DataFrame:
    """(x, ids): every distinct vector with its `keep` smallest ids in order.

    Copies are first cut down within 64 lots of each vector, so that a vector that fills a third of the table
    stays no single task's work.
    """
    lot = F.pmod(F.xxhash64("id"), F.lit(64))
    lots = rows.select("x", "id", F.xxhash64("x").alias("h"), lot.alias("lot"))
    first = F.row_number().over(Window.partitionBy("h", "x", "lot").orderBy("id"))
    few = lots.withColumn("n", first).where(F.col("n") <= keep)
    return few.groupBy("x").agg(F.slice(F.array_sort(F.collect_list("id")), 1, keep).alias("ids"))


def _nearest_pivots(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """Numbers of the nearest pivots (largest inner product first) of each row."""
    likeness = x @ pivots.T
    prefix = min(prefix, len(pivots))
    some = np.argpartition(-likeness, prefix - 1, axis=1)[:, :prefix]
    order = np.argsort(-np.take_along_axis(likeness, some, 1), axis=1, kind="stable")
    return np.take_along_axis(some, order, 1)


def _lifted(x: np.ndarray, length: float) -> np.ndarray:
    """`x` with one more coordinate, so that each row has that length; longer rows are shortened."""
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    rest = np.sqrt(np.maximum(0.0, 1 - np.square(norm / length)))
    return np.hstack([x / np.maximum(norm, length), rest])


def _search(pivots: np.ndarray, length: float, prefix: int, share: float, k: int, least: int):
    def search(guests: pd.DataFrame, hosts: pd.DataFrame) -> pd.DataFrame:
        if not len(guests) or not len(hosts):
            return pd.DataFrame({"query": [], "vec": [], "score": []})
        x = np.stack(hosts["x"].to_numpy())
        near = _nearest_pivots(_lifted(x, length), pivots, prefix)
        # What is longer than that by rounding alone is not long.
        long = np.linalg.norm(x, axis=1) > length * (1 + 1e-9)
        depth = near.shape[1]
        # Inverted files: by pivot, the vectors and how far before the end of the prefix it stands.
        order = np.argsort(near, axis=None, kind="stable")
        who = (order // depth).astype("int32")
        ahead = (depth - order % depth).astype("int16")
        starts = np.searchsorted(near.ravel()[order], np.arange(len(pivots) + 1))

        q = np.stack(guests["x"].to_numpy())
        flat = np.hstack([q / np.linalg.norm(q, axis=1, keepdims=True), np.zeros((len(q), 1))])
        q_near = _nearest_pivots(flat, pivots, prefix)
        # At least `least` rows of a block are compared exactly, whatever the share.
        wanted = min(len(x), max(least, int(np.ceil(share * len(x)))))
        ids = hosts["ids"].tolist()
        out_query, out_vec, out_score = [], [], []
        for name, vector, pivots_of in zip(guests["id"], q, q_near):
            # A pivot missing in a prefix stands at its end: a shared pivot saves the smaller of the two
            # distances from the end, twice.
            saved = np.zeros(len(x), dtype="int32")
            for position, p in enumerate(pivots_of):
                part = slice(starts[p], starts[p + 1])
                saved[who[part]] += np.minimum(ahead[part], depth - position)
            saved[long] = np.iinfo("int32").max
            close = np.argpartition(-saved, wanted - 1)[:wanted]
            score = np.einsum("ij,j->i", x[close], vector)
            best = close[score >= np.partition(score, -min(k + 1, wanted))[-min(k + 1, wanted)]]
            score = np.einsum("ij,j->i", x[best], vector)
            found = [(-s, v) for s, b in zip(score.tolist(), best.tolist()) for v in ids[b] if v != name]
            found = sorted(found)[:k]
            out_query.append(name)
            out_vec.append([v for _, v in found])
            out_score.append([-s for s, _ in found])
        return pd.DataFrame({"query": out_query, "vec": out_vec, "score": out_score})

    return search


def nearest_neighbours(
    table: DataFrame,
    queries: Callable[[Column], Column],
    id: str = "vec_id",
    vector: str = "embedding",
    k: int = NEIGHBOURS,
    pivots: int = PIVOTS,
    prefix: int = PREFIX,
    share: float = SHARE,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id meets the condition `queries`, its k nearest found.

    Nearness is the largest inner product of the original vectors, in double precision, ties to the smaller id; a
    row is not its own neighbour. Vectors that are null or zero, hold null or non-finite components or have another
    length than most take no part, nor do rows with a null id; repeated rows count once. With fewer candidates all
    are returned. An empty table gives an empty result.
    """
    spark = table.sparkSession
    rows = usable_vectors(table, id, vector)
    asked = rows.where(queries(F.col("id")))
    chosen = rows.orderBy(F.xxhash64("id"), "id").limit(pivots).select("x").collect()
    if not chosen:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    hosts = stored(_distinct(rows, k + 1), "distinct-vectors")
    norm = F.sqrt(F.aggregate("x", F.lit(0.0), lambda total, v: total + v * v))
    length = hosts.agg(F.percentile_approx(norm, F.lit(LONG))).first()[0]
    centre = _lifted(np.array([r["x"] for r in chosen], dtype="float64"), length)
    blocks = max(1, -(-hosts.count() // BLOCK_ROWS))
    batches = max(1, -(-asked.count() // QUERY_ROWS))
    # Every batch of queries meets every block: each side is copied to the tasks of its row or column.
    host = hosts.withColumn("block", F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(blocks)).cast("int"))
    host = host.withColumn("batch", F.explode(F.sequence(F.lit(0), F.lit(batches - 1))))
    guest = asked.withColumn("batch", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(batches)).cast("int"))
    guest = guest.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = (
        guest.groupBy("block", "batch")
        .cogroup(host.groupBy("block", "batch"))
        .applyInPandas(_search(centre, length, prefix, share, k, LEAST_COMPARED), "query long, vec array<long>, score array<double>")
    )
    flat = found.select("query", F.explode(F.arrays_zip("score", "vec")).alias("r"))
    flat = flat.select(F.col("query").alias("query_id"), F.col("r.vec").alias("vec_id"), F.col("r.score").alias("score"))
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return flat.withColumn("rank", best).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

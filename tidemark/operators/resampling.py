"""Synthetic minority rows and removal of borderline pairs, for training rows only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.nearest import BLOCK_ROWS, id_column, nearest
from tidemark.operators.sampling import lottery, sample_rows

# Fixed value: neighbours a synthetic row may be drawn towards.
NEIGHBOURS = 5


def smote(
    df: DataFrame, ratio: float, id: str, vector: str, label: str, k: int = NEIGHBOURS, seed: int = 42,
    block_rows: int = BLOCK_ROWS, ticket: Column | None = None, pick: Column | None = None, way: Column | None = None,
    name: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """Add synthetic positives until there are `ratio` times as many positives as negatives.

    Each lies between a positive and one of its k nearest positives. Every positive is the start of
    equally many synthetic rows, give or take one. Synthetic rows have a null id, or the one that `name` makes of the
    id of their start and the number of the copy. Whole numbers are ids as longs, all else as text.

    `ticket` orders the positives that get one more row; `pick` (an integer) and `way` (in [0, 1)) choose
    neighbour and position for the n-th row of an id, in terms of the columns `id` and `copy`.
    """
    sizes = df.agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")).first()
    missing = int(sizes["neg"] * ratio) - sizes["pos"]
    if missing <= 0 or sizes["pos"] < 2:
        return df.select(id_column(df, id).alias(id), F.col(vector).cast("array<double>").alias(vector), label)
    positives = df.where(F.col(label) == 1).select(
        id_column(df, id).alias("id"), F.col(vector).cast("array<double>").alias("x")
    )
    each, rest = divmod(missing, sizes["pos"])
    k = min(k, sizes["pos"] - 1)
    one_more = sample_rows(positives, "id", rest, seed, ticket).select(F.col("id").alias("_more"))
    starts = positives.join(one_more, F.col("id") == F.col("_more"), "left")
    copies = F.lit(each) + F.when(F.col("_more").isNotNull(), 1).otherwise(0)
    starts = starts.withColumn("_copies", copies).where("_copies > 0").select(
        "id", "x", F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("copy")
    )
    pick = lottery(F.struct("id", "copy"), seed + 1) if pick is None else pick
    way = lottery(F.struct("id", "copy"), seed + 2) / F.lit(float(1 << 32)) if way is None else way
    starts = starts.withColumn("_rank", F.pmod(pick, F.lit(k)) + 1).withColumn("_way", way)

    towards = nearest(positives, "id", "x", k, block_rows, seed).select(
        F.col("id").alias("_from"), F.col("rank").alias("_at"), "neighbour"
    )
    goals = positives.select(F.col("id").alias("_goal"), F.col("x").alias("_y"))
    drawn = starts.join(towards, (F.col("id") == F.col("_from")) & (F.col("_rank") == F.col("_at"))).join(
        goals, F.col("neighbour") == F.col("_goal")
    )
    between = F.zip_with("x", "_y", lambda a, b: a + F.col("_way") * (b - a))
    kind = positives.schema["id"].dataType
    named = F.lit(None).cast(kind) if name is None else name(F.col("id"), F.col("copy")).cast(kind)
    synthetic = drawn.select(
        named.alias(id), between.alias(vector), F.lit(1).cast(df.schema[label].dataType).alias(label)
    )
    real = df.select(id_column(df, id).alias(id), F.col(vector).cast("array<double>").alias(vector), label)
    return real.unionByName(synthetic)


def tomek_links(df: DataFrame, id: str, vector: str, label: str, block_rows: int = BLOCK_ROWS, seed: int = 42) -> DataFrame:
    """Pairs (a, b), a < b, of different classes that are each other's nearest row."""
    closest = nearest(df, id, vector, 1, block_rows, seed)
    forth = closest.select(F.col("id").alias("a"), F.col("neighbour").alias("b"), "distance")
    back = closest.select(F.col("id").alias("_b"), F.col("neighbour").alias("_a"))
    mutual = forth.join(back, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b"))).where(F.col("a") < F.col("b"))
    labels = df.select(id_column(df, id).alias("_id"), F.col(label).alias("_y"))
    first = labels.select(F.col("_id").alias("_ia"), F.col("_y").alias("_ya"))
    second = labels.select(F.col("_id").alias("_ib"), F.col("_y").alias("_yb"))
    pairs = mutual.join(first, F.col("a") == F.col("_ia")).join(second, F.col("b") == F.col("_ib"))
    return pairs.where(F.col("_ya") != F.col("_yb")).select("a", "b", "distance")


def remove_tomek_links(df: DataFrame, id: str, vector: str, label: str, block_rows: int = BLOCK_ROWS, seed: int = 42) -> DataFrame:
    """Both rows of every link go."""
    links = tomek_links(df, id, vector, label, block_rows, seed)
    gone = links.select(F.col("a").alias("_gone")).union(links.select("b"))
    return df.join(gone, id_column(df, id) == F.col("_gone"), "left_anti")

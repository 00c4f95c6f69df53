"""Running totals along an ordered value, without sending one ordering to a single task.

A window ordered by score with no partition (or with one huge partition) runs in one task. Here
equal values are merged first, the value range is cut at its quantiles into as many bins as there are
shuffle partitions, each bin is accumulated on its own, and the totals of the bins before it (a table
of at most `bins` rows per group) are added. The cut points are plain numbers in the plan, so a
recomputed partition always falls into the same bin.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def quantile_cuts(df: DataFrame, values: Sequence[str], bins: int | None = None) -> dict[str, list[float]]:
    """Inner cut points per column; approximate quantiles only decide how evenly the work is spread."""
    bins = bins or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shares = [i / bins for i in range(1, bins)]
    doubles = df.select(*(F.col(v).cast("double").alias(v) for v in values))
    found = doubles.approxQuantile(list(values), shares, 1.0 / (4 * bins))
    return {value: sorted(set(cuts)) for value, cuts in zip(values, found)}


def bin_of(
    df: DataFrame, value: str, cuts: Sequence[float], out: str = "_bin", invalid: str = "error"
) -> DataFrame:
    """Number of cut points at or below the value; nulls fail unless `invalid` is "keep" (a bin of their own)."""
    edges = [float("-inf"), *(cuts or [0.0]), float("inf")]
    cutter = Bucketizer(splits=edges, inputCol=value, outputCol=out, handleInvalid=invalid)
    return cutter.transform(df).withColumn(out, F.col(out).cast("int"))


def running_totals(
    df: DataFrame,
    value: str,
    sums: Mapping[str, Column],
    by: Sequence[str] = (),
    descending: bool = False,
    cuts: Sequence[float] | None = None,
) -> DataFrame:
    """One row per distinct value of each group.

    For every name in `sums`: `name` (this value), `run_name` (all values up to and including it) and
    `all_name` (the whole group). `next_value` is the following distinct value, null at the end.
    """
    df = df.withColumn(value, F.col(value).cast("double"))
    if cuts is None:
        cuts = quantile_cuts(df, [value])[value]
    tied = df.groupBy(*by, value).agg(*(c.alias(name) for name, c in sums.items()))
    tied = bin_of(tied, value, cuts)
    return accumulate(tied, value, list(sums), by, descending)


def accumulate(
    tied: DataFrame, value: str, names: Sequence[str], by: Sequence[str] = (), descending: bool = False
) -> DataFrame:
    """The same for rows that are already unique per (group, value) and carry their bin as `_bin`."""
    along = F.col(value).desc() if descending else F.col(value).asc()
    bin_order = F.col("_bin").desc() if descending else F.col("_bin").asc()
    first = F.max(value) if descending else F.min(value)

    per_bin = tied.groupBy(*by, "_bin").agg(*(F.sum(n).alias(n) for n in names), first.alias("_first"))
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    earlier = group.orderBy(bin_order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bin.select(
        *(F.col(b).alias(f"_by_{b}") for b in by),
        F.col("_bin").alias("_at"),
        *(F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_before_{n}") for n in names),
        *(F.sum(n).over(group).alias(f"all_{n}") for n in names),
        F.lead("_first").over(group.orderBy(bin_order)).alias("_next_first"),
    )

    inside = Window.partitionBy(*by, "_bin").orderBy(along)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = tied.withColumns(
        {f"_run_{n}": F.sum(n).over(upto) for n in names} | {"_next_here": F.lead(value).over(inside)}
    )
    same = F.col("_bin") == F.col("_at")
    for b in by:
        same = same & F.col(b).eqNullSafe(F.col(f"_by_{b}"))
    return local.join(offsets, same, "inner").select(
        *by,
        value,
        *names,
        *((F.col(f"_run_{n}") + F.col(f"_before_{n}")).alias(f"run_{n}") for n in names),
        *(F.col(f"all_{n}") for n in names),
        F.coalesce("_next_here", "_next_first").alias("next_value"),
    )


def exact_quantiles(
    df: DataFrame, value: str, shares: Mapping[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Quantiles with linear interpolation between the two neighbouring ranks, one column per share."""
    known = df.where(F.col(value).isNotNull())
    line = running_totals(known, value, {"n": F.count(F.lit(1))}, by)
    first_rank, last_rank = F.col("run_n") - F.col("n"), F.col("run_n") - 1
    aggregates = []
    for name, share in shares.items():
        rank = F.lit(float(share)) * (F.col("all_n") - 1)
        low, part = F.floor(rank), rank - F.floor(rank)
        covers = (low >= first_rank) & (low <= last_rank)
        following = F.when(low + 1 <= last_rank, F.col(value)).otherwise(F.coalesce("next_value", value))
        aggregates.append(F.max(F.when(covers, F.col(value) + part * (following - F.col(value)))).alias(name))
    return line.groupBy(*by).agg(*aggregates)


def values_at_ranks(df: DataFrame, value: str, ranks: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Value at zero-based ranks of the ascending order; a rank may refer to the row count `all_n`."""
    line = running_totals(df.where(F.col(value).isNotNull()), value, {"n": F.count(F.lit(1))}, by)
    covers = {
        name: (rank >= F.col("run_n") - F.col("n")) & (rank < F.col("run_n")) for name, rank in ranks.items()
    }
    return line.groupBy(*by).agg(
        F.max("all_n").alias("n"), *(F.max(F.when(hit, F.col(value))).alias(name) for name, hit in covers.items())
    )

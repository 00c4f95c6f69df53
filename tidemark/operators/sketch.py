"""Quantile sketches that are made once per window, stored, and merged to any longer period.

A sketch is a few kilobytes whatever it has seen, so windows can be kept for years and asked for quantiles of any span
without the rows. The answers are approximate: see `rank_error`. The exact route is `profile.latency_summary`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Size parameter of the sketches.
SIZE = 800


def rank_error(size: int = SIZE) -> float:
    """How far, as a share of all rows, the rank of an answer may lie from the rank asked for, in 99 of 100 cases."""
    return 2.296 / size**0.9723


def quantile_sketches(df: DataFrame, value: str, by: Sequence[str], size: int = SIZE) -> DataFrame:
    """(by, sketch, n): one mergeable sketch per group, combined map-side; null and NaN values are left out.

    Groups without a value are left out as well.
    """
    known = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    sketch = F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(size))
    return known.groupBy(*by).agg(sketch.alias("sketch"), F.count(F.lit(1)).alias("n"))


def merge_sketches(sketches: DataFrame, by: Sequence[str], size: int = SIZE) -> DataFrame:
    """The sketches of finer groups as those of coarser ones; `parts` counts what was merged."""
    merged = F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch")
    return sketches.groupBy(*by).agg(merged, F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts"))


def sketch_quantiles(sketches: DataFrame, shares: Mapping[str, float]) -> DataFrame:
    """The sketches' groups with one column per share."""
    asked = {name: F.kll_sketch_get_quantile_double("sketch", F.lit(float(share))) for name, share in shares.items()}
    return sketches.withColumns(asked).drop("sketch")

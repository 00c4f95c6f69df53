"""Do two computations of the same features agree, row by row?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parity_report(
    online: DataFrame, offline: DataFrame, id: str, features: Sequence[str], rtol: float = 1e-9, atol: float = 1e-9
) -> DataFrame:
    """One row per feature: rows compared, rows missing on either side, largest difference, verdict."""
    left = online.select(F.col(id).alias("_left"), *(F.col(f).alias(f"_on_{f}") for f in features))
    right = offline.select(F.col(id).alias("_right"), *(F.col(f).alias(f"_off_{f}") for f in features))
    both = left.join(right, F.col("_left") == F.col("_right"), "full_outer")

    aggregates = [
        F.count_if(F.col("_left").isNotNull() & F.col("_right").isNotNull()).alias("_both"),
        F.count_if(F.col("_left").isNull()).alias("_only_off"),
        F.count_if(F.col("_right").isNull()).alias("_only_on"),
    ]
    for f in features:
        distance = F.abs(F.col(f"_on_{f}") - F.col(f"_off_{f}"))
        close = distance <= atol + rtol * F.abs(F.col(f"_off_{f}"))
        aggregates += [F.max(distance).alias(f"_max_{f}"), F.count_if(close).alias(f"_close_{f}")]
    rows = F.array(
        *(
            F.struct(
                F.lit(f).alias("feature"),
                F.col("_both").alias("compared"),
                F.col("_only_on").alias("missing_offline"),
                F.col("_only_off").alias("missing_online"),
                F.col(f"_max_{f}").alias("max_abs_diff"),
                ((F.col(f"_close_{f}") == F.col("_both")) & (F.col("_only_on") + F.col("_only_off") == 0)).alias("equal"),
            )
            for f in features
        )
    )
    return both.agg(*aggregates).select(F.inline(rows))

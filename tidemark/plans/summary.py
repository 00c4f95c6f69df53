"""Final comparison of validation and test at the threshold chosen on validation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.columns import DEFAULT, TxnColumns
from tidemark.functions.scalars import ratio
from tidemark.operators.cost import FALSE_ALARM_COST, business_cost
from tidemark.operators.ranking import METRICS, evaluate

COSTS = ["no_model_loss", "missed_fraud_loss", "false_alarm_cost", "total_cost"]


def summary_by_split(
    df: DataFrame, threshold: float, fp_cost: float = FALSE_ALARM_COST, split: str = "split", cols: TxnColumns = DEFAULT
) -> DataFrame:
    quality = evaluate(df, threshold, cols=cols, by=[split])
    costs = business_cost(df, threshold, fp_cost, cols, by=[split])
    return quality.join(costs, split).select(
        split,
        (F.col("positives") + F.col("negatives")).alias("rows"),
        F.col("positives").alias("frauds"),
        "tp",
        "fn",
        "fp",
        "tn",
        *METRICS,
        *COSTS,
        ratio(F.col("fp"), F.col("fp") + F.col("tn")).alias("false_alarm_rate"),
        (1 - ratio(F.col("total_cost"), F.col("no_model_loss"))).alias("cost_reduction"),
    )


def final_summary(
    df: DataFrame,
    threshold: float,
    fp_cost: float = FALSE_ALARM_COST,
    splits: tuple[str, ...] = ("val", "test"),
    split: str = "split",
    cols: TxnColumns = DEFAULT,
) -> DataFrame:
    """One row per metric, one column per split."""
    table = summary_by_split(df.where(F.col(split).isin(*splits)), threshold, fp_cost, split, cols)
    names = [c for c in table.columns if c != split]
    entries = F.array(*(F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("_value")) for n in names))
    return table.select(split, F.inline(entries)).groupBy("metric").pivot(split, list(splits)).agg(F.max("_value"))

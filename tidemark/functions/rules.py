"""Row contract of the transaction feed, decisions and the alert listing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import mask_tail, parse_iso
from tidemark.schemas import CATEGORIES

# Fixed values of the contract.
MAX_AMOUNT = 1_000_000
DECLINE_AT = 0.9
DEFAULT_THRESHOLD = 0.5


def contract_rules(categories: list[str] = CATEGORIES) -> dict[str, Column]:
    """Field name to the condition it has to meet; a null never meets it."""
    c = F.col
    return {
        "transaction_id": F.length(c("transaction_id")) > 0,
        "cc_num": F.length(c("cc_num")) > 0,
        "amount": (c("amount") > 0) & (c("amount") <= MAX_AMOUNT),
        "category": c("category").isin(categories),
        "timestamp": parse_iso(c("timestamp")).isNotNull(),
        "customer_dob": F.expr("try_cast(customer_dob AS DATE)").isNotNull(),
        "customer_lat": c("customer_lat").between(-90, 90),
        "customer_long": c("customer_long").between(-180, 180),
        "merchant_lat": c("merchant_lat").between(-90, 90),
        "merchant_long": c("merchant_long").between(-180, 180),
        "city_pop": c("city_pop") >= 0,
    }


def with_violations(events: DataFrame, categories: list[str] = CATEGORIES) -> DataFrame:
    """Add the fields that break the contract, in field order, as an array."""
    broken = [
        F.when(F.coalesce(rule, F.lit(False)), F.lit(None)).otherwise(F.lit(field))
        for field, rule in contract_rules(categories).items()
    ]
    return events.withColumn("violations", F.array_compact(F.array(*broken)))


def split_valid(events: DataFrame, categories: list[str] = CATEGORIES) -> tuple[DataFrame, DataFrame]:
    """(rows within the contract, rejected rows with their reasons)."""
    checked = with_violations(events, categories)
    accepted = checked.where(F.size("violations") == 0).drop("violations")
    return accepted, checked.where(F.size("violations") > 0)


def decide(score: Column, threshold: Column | float = DEFAULT_THRESHOLD, decline_at: float = DECLINE_AT) -> Column:
    """Declining is tested first, so it wins even where the review threshold lies above it."""
    return (
        F.when(score >= decline_at, F.lit("decline")).when(score >= threshold, F.lit("review")).otherwise(F.lit("approve"))
    )


def alerts_feed(scored: DataFrame, key: str, decision: str = "decision") -> DataFrame:
    """Everything that was not approved, with the card reduced to its last four digits."""
    return scored.where(F.col(decision) != "approve").withColumn(key, mask_tail(F.col(key)))

"""Transaction-risk analytics on Spark DataFrames."""

from tidemark.columns import TxnColumns

__all__ = ["TxnColumns"]

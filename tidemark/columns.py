"""Column names every operator works on; override them to run on another table."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class TxnColumns:
    key: str = "cc_num"
    time: str = "trans_date_trans_time"
    id: str = "trans_num"
    amount: str = "amt"
    category: str = "category"
    label: str = "is_fraud"
    score: str = "score"


DEFAULT = TxnColumns()

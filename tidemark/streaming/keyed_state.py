"""History features with per-key state in the state store, for low latency.

Spark routes every key to one task and keeps its state there, so the work of a task per trigger is bounded
by the trigger's row limit and the longest window of a key. Where a single key carries a large share of
the traffic use `table_state` instead, which splits keys.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators.history import FIRST_ROW_RATIO, MAX_GAP_SECONDS, WINDOWS, KeyState
from tidemark.functions.scalars import MICROS

_NO_ROWS = np.empty(0, dtype="int64")


@dataclass
class Totals:
    last_us: int | None = None
    count: int = 0
    amount: float = 0.0


@dataclass
class CardMemory:
    """What one key remembers: totals of everything, and the rows within its longest window."""

    us: np.ndarray = field(default_factory=lambda: _NO_ROWS)
    amounts: np.ndarray = field(default_factory=lambda: np.empty(0))
    totals: Totals = field(default_factory=Totals)

    def observe(self, us: np.ndarray, amounts: np.ndarray, windows: Mapping[str, int], max_gap: int) -> pd.DataFrame:
        """Features of rows sorted by (time, id), which are then remembered."""
        known_us = np.concatenate([self.us, us])
        known_amounts = np.concatenate([self.amounts, amounts])
        by_time = np.argsort(known_us, kind="stable")
        known_us, known_amounts = known_us[by_time], known_amounts[by_time]

        out: dict[str, np.ndarray] = {}
        until = np.searchsorted(known_us, us, side="left")
        for name, seconds in windows.items():
            since = np.searchsorted(known_us, us - seconds * MICROS, side="left")
            out[f"card_txn_count_{name}"] = (until - since).astype("float64")
            out[f"card_amt_sum_{name}"] = _sums_between(known_amounts, since, until)

        newest = np.maximum.accumulate(us)
        previous = np.concatenate([[self.totals.last_us if self.totals.last_us is not None else us[0]], newest[:-1]])
        if self.totals.last_us is not None:
            previous = np.maximum(previous, self.totals.last_us)
        gap = np.clip((us - previous) / MICROS, 0.0, max_gap)
        late = us < previous
        if self.totals.last_us is None:
            gap[0] = max_gap
        out["seconds_since_last_txn"] = gap

        past_count = self.totals.count + np.arange(len(us))
        past_amount = self.totals.amount + np.concatenate([[0.0], np.cumsum(amounts)[:-1]])
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = amounts / (past_amount / past_count)
        out["amt_vs_card_mean"] = np.where((past_count > 0) & (past_amount != 0), ratio, FIRST_ROW_RATIO)
        out["late"] = late

        last = int(max(newest[-1], previous[-1]))
        self.totals = Totals(last, self.totals.count + len(us), self.totals.amount + float(amounts.sum()))
        keep = known_us >= last - max(windows.values()) * MICROS
        self.us, self.amounts = known_us[keep], known_amounts[keep]
        return pd.DataFrame(out)


def _sums_between(values: np.ndarray, since: np.ndarray, until: np.ndarray) -> np.ndarray:
    """Sum of values[since:until] per pair, without differences of running sums."""
    if not len(values):
        return np.zeros(len(since))
    padded = np.append(values, 0.0)
    pairs = np.column_stack([since, until]).ravel()
    return np.where(until > since, np.add.reduceat(padded, pairs)[::2], 0.0)


class CardProcessor(StatefulProcessor):
    """Input: event columns with `event_us` and `amount`; output: the same columns, features and `late`."""

    def __init__(self, id: str, windows: Mapping[str, int], max_gap: int):
        self.id, self.windows, self.max_gap = id, dict(windows), max_gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = handle.getValueState("totals", "last_us long, total_count long, total_amount double")
        self.recent = handle.getListState("recent", "us long, amt double")

    def handleInitialState(self, key, initial: pd.DataFrame, timers) -> None:
        for row in initial[initial["total_count"].notna()].itertuples(index=False):
            self.totals.update((int(row.last_us), int(row.total_count), float(row.total_amount)))
        rows = initial[initial["us"].notna()]
        if len(rows):
            self.recent.appendList([(int(u), float(a)) for u, a in zip(rows["us"], rows["amt"])])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
        events = pd.concat(list(rows), ignore_index=True)
        if not len(events):
            return
        events = events.sort_values(["event_us", self.id], kind="stable", ignore_index=True)
        memory = self._recall()
        us, amounts = events["event_us"].to_numpy("int64"), events["amount"].to_numpy("float64")
        features = memory.observe(us, amounts, self.windows, self.max_gap)
        t = memory.totals
        self.totals.update((t.last_us, t.count, t.amount))
        self.recent.put([(int(u), float(a)) for u, a in zip(memory.us, memory.amounts)])
        yield pd.concat([events, features], axis=1)

    def _recall(self) -> CardMemory:
        memory = CardMemory()
        if self.totals.exists():
            last, count, amount = self.totals.get()
            memory.totals = Totals(int(last), int(count), float(amount))
        if self.recent.exists():
            rows = list(self.recent.get())
            memory.us = np.array([r[0] for r in rows], dtype="int64")
            memory.amounts = np.array([r[1] for r in rows], dtype="float64")
            order = np.argsort(memory.us, kind="stable")
            memory.us, memory.amounts = memory.us[order], memory.amounts[order]
        return memory

    def close(self) -> None:
        pass


def keyed_history(
    events: DataFrame,
    key: str = "cc_num",
    id: str = "transaction_id",
    before: KeyState | None = None,
    windows: Mapping[str, int] = WINDOWS,
    max_gap: int = MAX_GAP_SECONDS,
) -> DataFrame:
    """Stream of valid events to the same stream with features. Needs the RocksDB state store.

    `before` loads a backfilled state; its rows are handed to the keys one by one, not as lists.
    """
    features = [f"card_{kind}_{name}" for name in windows for kind in ("txn_count", "amt_sum")]
    features += ["seconds_since_last_txn", "amt_vs_card_mean"]
    schema = T.StructType(
        [T.StructField(f.name, f.dataType) for f in events.schema.fields]
        + [T.StructField(name, T.DoubleType()) for name in features]
        + [T.StructField("late", T.BooleanType())]
    )
    initial = None
    if before is not None:
        totals = before.totals.select(key, "last_us", "total_count", "total_amount")
        initial = totals.unionByName(before.recent.select(key, "us", "amt"), allowMissingColumns=True).groupBy(key)
    return events.groupBy(key).transformWithStateInPandas(
        CardProcessor(id, windows, max_gap), outputStructType=schema, outputMode="append", timeMode="none",
        initialState=initial,
    )


def exported_state(spark: SparkSession, checkpoint: str, key: str = "cc_num") -> KeyState:
    """State of a stopped (or running) `keyed_history` query as tables, read from its checkpoint."""

    def variable(name: str, **options) -> DataFrame:
        reader = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", name)
        return reader.options(**options).load()

    totals = variable("totals").select(F.col(f"key.{key}").alias(key), "value.*")
    recent = variable("recent", flattenCollectionTypes="true").select(F.col(f"key.{key}").alias(key), "list_element.*")
    return KeyState(totals, recent.select(key, "us", F.lit(None).cast("string").alias("id"), "amt"))

"""Behaviour of each key before the current row: velocity windows, gap, ratio to the past mean.

Two orderings are at work. The windows cover [t - w, t) on time alone, so rows with the same
timestamp do not see each other. The gap and the running mean follow (time, id), so a tied row
with a smaller id is visible.

Most keys are short: one shuffle by key and one sort serve every feature. A key with more than
`hot_rows` rows would make one task sort and scan all of them, so such keys take another route,
cut into time slices of at most the smallest common width of the windows:

  window [t - w, t)  =  rows of t's own slice before t             (running sum in the slice)
                     +  whole slices between                       (sum over slice totals)
                     +  rows of the slice holding t - w, from t-w  (running sum, backwards)

The third term needs rows of an older slice; each row therefore travels to the slice it expires in,
once per window, shifted by w. All three frames are running sums, linear in the slice, and nothing
is ever gathered per key except one small total per slice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.columns import DEFAULT, TxnColumns
from tidemark.functions.scalars import MICROS, epoch_us

# Fixed values of the feature definition.
WINDOWS: dict[str, int] = {"1h": 3600, "24h": 24 * 3600}
MAX_GAP_SECONDS = 7 * 24 * 3600
FIRST_ROW_RATIO = 1.0

HOT_ROWS = 20_000
SLICE_SECONDS = 900

# A carried total sorts before every real time and stays clear of overflow when a window is subtracted.
_BEFORE_ALL_TIME = -(1 << 60)

_US, _EMIT = "_us", "_emit"
_RUN_N, _RUN_SUM, _RUN_LAST = "_run_n", "_run_sum", "_run_last"
_WIN_N, _WIN_SUM = "_win_n", "_win_sum"


@dataclass(frozen=True)
class KeyState:
    """What is known of every key before the rows at hand.

    totals: key, last_us, total_count, total_amount - one row per key.
    recent: key, us, id, amt - the rows a window can still reach.
    """

    totals: DataFrame
    recent: DataFrame


def history_features(
    df: DataFrame,
    cols: TxnColumns = DEFAULT,
    windows: Mapping[str, int] = WINDOWS,
    max_gap: int = MAX_GAP_SECONDS,
    hot_rows: int | None = HOT_ROWS,
    slice_seconds: int = SLICE_SECONDS,
    before: KeyState | None = None,
    mark_late: bool = False,
) -> DataFrame:
    """Add count and sum per window, seconds since the previous row and ratio to the past mean.

    `before` continues from a state instead of from nothing. `hot_rows=None` keeps every key on the
    single-shuffle route, `hot_rows=0` sends every key through the slices; otherwise rows are counted
    per key first (a scan of the key column) and the second route is planned only if it is needed.
    `mark_late` adds a flag for rows older than their key's state; their gap is zero rather than negative.
    """
    rows = contributions(df, cols, before)
    return features_of(rows, df.columns, cols, windows, max_gap, hot_rows, slice_seconds, mark_late)


def features_of(
    rows: DataFrame,
    columns: Sequence[str],
    cols: TxnColumns = DEFAULT,
    windows: Mapping[str, int] = WINDOWS,
    max_gap: int = MAX_GAP_SECONDS,
    hot_rows: int | None = HOT_ROWS,
    slice_seconds: int = SLICE_SECONDS,
    mark_late: bool = False,
) -> DataFrame:
    """Second half of `history_features`, for callers that keep the output of `contributions`."""
    spans = {name: int(seconds) * MICROS for name, seconds in windows.items()}
    if hot_rows is None or hot_keys(rows, cols.key, hot_rows).isEmpty():
        seen = _by_key(rows, cols, spans)
    else:
        hot = hot_keys(rows, cols.key, hot_rows)
        is_hot = F.col(cols.key).eqNullSafe(F.col("_hot_key"))
        width = _slice_width(spans, slice_seconds * MICROS)
        seen = _by_key(rows.join(hot, is_hot, "left_anti"), cols, spans).unionByName(
            _by_slice(rows.join(hot, is_hot, "left_semi"), cols, spans, width)
        )
    return _finish(columns, seen, cols, spans, max_gap, mark_late)


def hot_keys(rows: DataFrame, key: str, hot_rows: int) -> DataFrame:
    """Keys with more than `hot_rows` rows. Left to Spark to broadcast or shuffle, by its size."""
    counts = rows.groupBy(F.col(key).alias("_hot_key")).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.where(F.col("_rows") > hot_rows).select("_hot_key")


def contributions(df: DataFrame, cols: TxnColumns, before: KeyState | None = None) -> DataFrame:
    """Each row with what it adds to later rows: to the running totals and to the windows."""
    us, amount = epoch_us(F.col(cols.time)), F.col(cols.amount)
    rows = df.withColumns(
        {
            _US: us,
            _EMIT: F.lit(True),
            _RUN_N: F.lit(1).cast("long"),
            _RUN_SUM: amount,
            _RUN_LAST: us,
            _WIN_N: F.lit(1).cast("long"),
            _WIN_SUM: amount,
        }
    )
    if before is None:
        return rows
    nothing, zero = F.lit(0).cast("long"), F.lit(0.0)
    carried = before.totals.select(
        F.col(cols.key),
        F.lit(_BEFORE_ALL_TIME).alias(_US),
        F.lit(False).alias(_EMIT),
        F.col("total_count").alias(_RUN_N),
        F.col("total_amount").alias(_RUN_SUM),
        F.col("last_us").alias(_RUN_LAST),
        nothing.alias(_WIN_N),
        zero.alias(_WIN_SUM),
    )
    reachable = before.recent.select(
        F.col(cols.key),
        F.col("us").alias(_US),
        F.lit(False).alias(_EMIT),
        nothing.alias(_RUN_N),
        zero.alias(_RUN_SUM),
        F.lit(None).cast("long").alias(_RUN_LAST),
        F.lit(1).cast("long").alias(_WIN_N),
        F.col("amt").alias(_WIN_SUM),
    )
    return rows.unionByName(carried, allowMissingColumns=True).unionByName(reachable, allowMissingColumns=True)


def _count_of(span: str) -> str:
    return f"_count_{span}"


def _sum_of(span: str) -> str:
    return f"_sum_{span}"


def _by_key(rows: DataFrame, cols: TxnColumns, spans: Mapping[str, int]) -> DataFrame:
    key = Window.partitionBy(cols.key)
    earlier = key.orderBy(_US, cols.id).rowsBetween(Window.unboundedPreceding, -1)
    running = rows.withColumns(
        {
            "_past_n": F.sum(_RUN_N).over(earlier),
            "_past_sum": F.sum(_RUN_SUM).over(earlier),
            "_past_last": F.max(_RUN_LAST).over(earlier),
        }
    )
    windowed: dict[str, Column] = {}
    for span, us in spans.items():
        frame = key.orderBy(_US).rangeBetween(-us, -1)
        windowed[_count_of(span)] = F.coalesce(F.sum(_WIN_N).over(frame), F.lit(0))
        windowed[_sum_of(span)] = F.coalesce(F.sum(_WIN_SUM).over(frame), F.lit(0.0))
    return running.withColumns(windowed).where(_EMIT)


def _slice_width(spans: Mapping[str, int], wanted: int) -> int:
    """Largest width not above `wanted` that divides every window."""
    common = reduce(gcd, spans.values())
    pieces = -(-common // max(1, min(wanted, common)))
    while common % pieces:
        pieces += 1
    return common // pieces


def _slice_start(position: Column, width: int) -> Column:
    return position - F.pmod(position, F.lit(width))


def _by_slice(rows: DataFrame, cols: TxnColumns, spans: Mapping[str, int], width: int) -> DataFrame:
    payload = [c for c in rows.columns if c != cols.key and not c.startswith("_")]
    own, shift, position = F.col("_shift") == 0, F.col("_shift"), F.col("_position")

    everywhere = F.array(*(F.lit(us).cast("long") for us in (0, *spans.values())))
    only_here = F.array(F.lit(0).cast("long"))
    travelling = rows.withColumn("_shift", F.explode(F.when(F.col(_WIN_N) > 0, everywhere).otherwise(only_here)))
    travelling = travelling.select(
        cols.key,
        "_shift",
        *(F.col(c) for c in rows.columns if c.startswith("_")),
        *(F.when(own, F.col(c)).alias(c) for c in payload),
        (F.col(_US) + shift).alias("_position"),
        _slice_start(F.col(_US) + shift, width).alias("_slice"),
    )

    part = Window.partitionBy(cols.key, "_slice")
    earlier = part.orderBy("_position", cols.id).rowsBetween(Window.unboundedPreceding, -1)
    strictly_before = part.orderBy("_position").rangeBetween(Window.unboundedPreceding, -1)
    not_expired = part.orderBy(position.desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    inside = travelling.withColumns(
        {
            "_in_n": F.sum(F.when(own, F.col(_RUN_N))).over(earlier),
            "_in_sum": F.sum(F.when(own, F.col(_RUN_SUM))).over(earlier),
            "_in_last": F.max(F.when(own, F.col(_RUN_LAST))).over(earlier),
        }
    ).withColumns(
        {
            "_here_n": F.sum(F.when(own, F.col(_WIN_N))).over(strictly_before),
            "_here_sum": F.sum(F.when(own, F.col(_WIN_SUM))).over(strictly_before),
        }
    )
    inside = inside.withColumns(
        {f"_tail_n_{s}": F.sum(F.when(shift == us, F.col(_WIN_N))).over(not_expired) for s, us in spans.items()}
        | {f"_tail_sum_{s}": F.sum(F.when(shift == us, F.col(_WIN_SUM))).over(not_expired) for s, us in spans.items()}
    ).where(own & F.col(_EMIT))

    totals = rows.groupBy(cols.key, _slice_start(F.col(_US), width).alias("_slice")).agg(
        F.sum(_RUN_N).alias("_t_n"),
        F.sum(_RUN_SUM).alias("_t_sum"),
        F.max(_RUN_LAST).alias("_t_last"),
        F.sum(_WIN_N).alias("_t_win_n"),
        F.sum(_WIN_SUM).alias("_t_win_sum"),
    )
    line = Window.partitionBy(cols.key).orderBy("_slice")
    older = line.rowsBetween(Window.unboundedPreceding, -1)
    carried = {
        "_old_n": F.sum("_t_n").over(older),
        "_old_sum": F.sum("_t_sum").over(older),
        "_old_last": F.max("_t_last").over(older),
    }
    for span, us in spans.items():
        whole = line.rangeBetween(width - us, -width) if us > width else None
        carried[f"_mid_n_{span}"] = F.sum("_t_win_n").over(whole) if whole else F.lit(0)
        carried[f"_mid_sum_{span}"] = F.sum("_t_win_sum").over(whole) if whole else F.lit(0.0)
    slices = totals.select(F.col(cols.key).alias("_slice_key"), F.col("_slice").alias("_slice_of"),
                           *(c.alias(name) for name, c in carried.items()))

    joined = inside.join(
        slices, F.col(cols.key).eqNullSafe(F.col("_slice_key")) & (F.col("_slice") == F.col("_slice_of")), "inner"
    )
    out = {
        "_past_n": _plus("_old_n", "_in_n"),
        "_past_sum": _plus("_old_sum", "_in_sum"),
        "_past_last": F.greatest("_old_last", "_in_last"),
    }
    for span in spans:
        out[_count_of(span)] = _plus(f"_tail_n_{span}", f"_mid_n_{span}", "_here_n")
        out[_sum_of(span)] = _plus(f"_tail_sum_{span}", f"_mid_sum_{span}", "_here_sum")
    return joined.select(*rows.columns, *(c.alias(name) for name, c in out.items()))


def _plus(*names: str) -> Column:
    return reduce(lambda a, b: a + b, (F.coalesce(F.col(n), F.lit(0)) for n in names))


def _finish(
    columns: Sequence[str], seen: DataFrame, cols: TxnColumns, spans: Mapping[str, int], max_gap: int, mark_late: bool
) -> DataFrame:
    features = {}
    for span in spans:
        features[f"card_txn_count_{span}"] = F.col(_count_of(span)).cast("double")
        features[f"card_amt_sum_{span}"] = F.col(_sum_of(span)).cast("double")
    cap = F.lit(float(max_gap))
    gap = F.greatest((F.col(_US) - F.col("_past_last")) / F.lit(float(MICROS)), F.lit(0.0))
    features["seconds_since_last_txn"] = F.when(F.col("_past_last").isNull(), cap).otherwise(F.least(gap, cap))
    past_mean = F.try_divide(F.col("_past_sum"), F.col("_past_n"))
    features["amt_vs_card_mean"] = F.coalesce(
        F.try_divide(F.col(cols.amount), past_mean), F.lit(FIRST_ROW_RATIO)
    )
    if mark_late:
        features["late"] = F.coalesce(F.col(_US) < F.col("_past_last"), F.lit(False))
    return seen.select(*columns, *(c.alias(name) for name, c in features.items()))

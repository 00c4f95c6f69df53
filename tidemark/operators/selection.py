"""The first k rows of an order, without sorting and without sending any value's rows to one task.

The k-th row of an order by whole-number keys is found digit by digit: each pass counts the rows that share the digits
found so far by the next DIGIT bits, at most 2**DIGIT counts, and goes on in the digit where the k-th row lies. What
remains is a filter on the keys. Rows that agree in all keys are told apart by two hashes of all their columns, so those
left at the border are repetitions of one row, of which as many are taken as are wanted.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGIT = 11
_LEAST = -(1 << 63)


@dataclass(frozen=True)
class Border:
    """First keys of the k-th row, how many rows with these keys are among the first k, and how many there are.

    All keys, unless fewer decide.
    """

    keys: tuple[int, ...]
    inside: int
    rows: int


def order_keys(df: DataFrame, *columns: str) -> list[Column]:
    """Long keys in the ascending order of the columns (nulls first), then two hashes of the row.

    Whole numbers, dates and times are one key each. All else is ordered as text: by its bytes, seven to a key.
    """
    keys: list[Column] = []
    for name in columns:
        kind, value = df.schema[name].dataType.typeName(), F.col(name)
        if kind in ("timestamp", "timestamp_ntz"):
            keys.append(_nulls_first(F.unix_micros(value.cast("timestamp"))))
        elif kind == "date":
            keys.append(_nulls_first(F.unix_date(value).cast("long")))
        elif kind in ("byte", "short", "integer", "long"):
            keys.append(_nulls_first(value.cast("long")))
        else:
            data = F.hex(F.encode(value.cast("string"), "UTF-8"))
            longest = df.agg(F.max(F.length(data))).first()[0] or 0
            parts = [F.conv(F.rpad(F.substring(data, start + 1, 14), 14, "0"), 16, 10).cast("long") for start in range(0, longest, 14)]
            keys += [_nulls_first(part) for part in parts] + [_nulls_first(F.length(data).cast("long"))]
    rest = [F.col(c) for c in df.columns if df.schema[c].dataType.typeName() != "map"]
    return [*keys, F.xxhash64(*rest), F.xxhash64(F.lit(1), *rest)]


def _nulls_first(key: Column) -> Column:
    return F.coalesce(key, F.lit(_LEAST))


def border(df: DataFrame, keys: Sequence[Column], k: int) -> Border | None:
    """Where the first k rows end; None if there are no more than k rows, or k is not positive."""
    if k <= 0:
        return None
    names = [f"_key{i}" for i in range(len(keys))]
    rows = df.select(*(key.alias(name) for key, name in zip(keys, names)))
    found: list[int] = []
    before = 0
    for name in names:
        seen = rows.agg(F.min(name), F.max(name), F.count(F.lit(1))).first()
        if not found and seen[2] <= k:
            return None
        low, high, here = seen
        while low < high:
            # Digits of the distance from the lowest key: the range shrinks by 2**DIGIT with every pass.
            shift = max(0, (high - low).bit_length() - DIGIT)
            width = 1 << shift
            distance = (F.col(name).cast("decimal(20,0)") - F.lit(low).cast("decimal(20,0)")) if high - low >= 1 << 63 else F.col(name) - F.lit(low)
            digit = F.floor(distance / F.lit(width).cast("decimal(20,0)")) if high - low >= 1 << 63 else F.shiftright(distance, shift)
            counts = rows.groupBy(digit.cast("long").alias("digit")).agg(F.count(F.lit(1)).alias("n")).collect()
            for r in sorted(counts, key=lambda r: r["digit"]):
                if before + r["n"] >= k:
                    low, high, here = low + r["digit"] * width, min(high, low + (r["digit"] + 1) * width - 1), r["n"]
                    break
                before += r["n"]
            rows = rows.where((F.col(name) >= F.lit(low)) & (F.col(name) <= F.lit(high)))
        found.append(low)
        if before + here == k:
            # All rows with these first keys are inside, whatever their other keys are.
            return Border(tuple(found), here, here)
    return Border(tuple(found), k - before, here)


def _compare(keys: Sequence[Column], bound: Sequence[int]) -> tuple[Column, Column]:
    """Before the bound, and equal to it."""
    same = [F.lit(True)]
    for key, value in zip(keys, bound):
        same.append(same[-1] & (key == F.lit(value)))
    before = [s & (key < F.lit(value)) for s, key, value in zip(same, keys, bound)]
    return reduce(lambda a, b: a | b, before), same[-1]


def between(df: DataFrame, keys: Sequence[Column], skip: int, stop: int | None) -> DataFrame:
    """Rows number `skip` to `stop` (from zero, `stop` not included) of the order by `keys`, in any order."""
    if stop is not None and stop <= max(0, skip):
        return df.limit(0)
    first, last = border(df, keys, skip), None if stop is None else border(df, keys, stop)
    if first is None and skip > 0:
        return df.limit(0)
    wanted, ties = F.lit(True), []
    if first is not None:
        before, same = _compare(keys, first.keys)
        wanted = ~before & ~same
        upto = last.inside if last is not None and last.keys == first.keys else first.rows
        ties.append((same, upto - first.inside))
    if last is not None:
        before, same = _compare(keys, last.keys)
        whole = last.inside == last.rows
        wanted = wanted & (before | same if whole else before)
        if not whole and (first is None or last.keys != first.keys):
            ties.append((same, last.inside))
    out = df.where(wanted)
    for same, taken in ties:
        if taken > 0:
            out = out.unionByName(df.where(same).limit(taken))
    return out

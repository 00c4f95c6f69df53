"""Shards of nearly equal bytes by a histogram sort.

Rows get a 63-bit key whose high bits come from the text and whose low bits come from the id: equal texts stand
side by side, and a group of any size can still be cut. Splitters are found by counting: the exact bytes below
candidate borders are summed over all partitions, then the interval around each wanted border is divided again,
until the border is within the tolerance or a single key is left. Then all rows are exchanged once.

Everything is a DataFrame function. The driver sees one counter per probe (at most 2**12 per interval and pass).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored, text_of

SHARDS = 40
TOLERANCE = 0.001
OVERHEAD = 16
_KEY_BITS = 63
_TEXT_BITS = 40
_STEP_BITS = 12
_CELL_BITS = 14
_CELL_ROWS = 1000


def text_bytes(text: str) -> Column:
    return F.octet_length(text_of(text)).cast("long")


def sort_key(id: str, text: str) -> Column:
    """63 bits, never negative: 40 of the text's hash, then 23 of the id's."""
    own = F.shiftrightunsigned(F.xxhash64(F.col(id), F.lit(1)), 64 - (_KEY_BITS - _TEXT_BITS))
    high = F.shiftrightunsigned(F.xxhash64(text_of(text)), 64 - _TEXT_BITS)
    return F.shiftleft(high, _KEY_BITS - _TEXT_BITS).bitwiseOR(own)


def _cell_bytes(rows: DataFrame, done: int, bits: int, cells: list[int], size: str) -> dict[int, int]:
    """Bytes by the first `bits` bits of the key, within the cells given by their first `done` bits."""
    wanted = F.broadcast(rows.sparkSession.createDataFrame([(c,) for c in cells], "_open long"))
    inside = rows.join(wanted, F.shiftright("_key", _KEY_BITS - done) == F.col("_open"), "left_semi") if done else rows
    parts = inside.groupBy(F.shiftright("_key", _KEY_BITS - bits).alias("c")).agg(F.sum(size).alias("b"))
    return {r["c"]: r["b"] for r in parts.collect()}


def splitters(rows: DataFrame, shards: int, size: str, tolerance: float = TOLERANCE) -> list[int]:
    """shards - 1 ascending borders of `_key`: a row with a key at or above the i-th border belongs behind it.

    Each pass sums the bytes of 2**12 equal parts of every interval that still holds a wanted border, at most
    shards - 1 intervals. A border is settled at the nearer end of its part once the part holds no more than the
    tolerance (a share of a shard's mean bytes) or a single key.
    """
    total = rows.agg(F.sum(size)).first()[0] or 0
    near = max(1.0, tolerance * total / shards)
    borders: dict[int, int] = {}
    # For each open border: the cell it lies in and the bytes below that cell.
    unsettled = {i: (0, 0) for i in range(1, shards)}
    done = 0
    while unsettled:
        bits = min(_KEY_BITS, done + _STEP_BITS)
        held = _cell_bytes(rows, done, bits, sorted({cell for cell, _ in unsettled.values()}), size)
        parts: dict[int, list[int]] = {}
        for cell in sorted(held):
            parts.setdefault(cell >> (bits - done), []).append(cell)
        refined = {}
        for i, (parent, below) in unsettled.items():
            target = total * i / shards
            inside = parts.get(parent, [parent << (bits - done)])
            for cell in inside:
                upto = below + held.get(cell, 0)
                if upto >= target or cell == inside[-1]:
                    break
                below = upto
            if upto - below <= near or bits == _KEY_BITS:
                borders[i] = (cell + int(target - below > upto - target)) << (_KEY_BITS - bits)
            else:
                refined[i] = (cell, below)
        unsettled, done = refined, bits
    return [borders[i] for i in sorted(borders)]


def shard(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    shards: int = SHARDS,
    tolerance: float = TOLERANCE,
    carry: list[str] | None = None,
) -> DataFrame:
    """All rows of `docs`, their columns (or those in `carry`) with size, shard (0 to shards - 1) and slot (gapless from 0 in each shard).

    A row's size is the UTF-8 bytes of its text plus 16; null texts count as empty. Shards differ by about the
    tolerance and the documents at their borders; with fewer rows than shards some stay empty. Equal texts are
    neighbours, in one shard unless a border cuts them. Fully repeated rows stay together. An id may be null.
    Columns named size, shard or slot are replaced. An empty table gives an empty result.

    Slots are numbered in cells of the key range, cut further where a cell holds many rows, so no task orders a
    whole shard. There are at most 2**15 cells and borders more; their offsets are broadcast.
    """
    own = ("size", "shard", "slot")
    carried = [c for c in (carry or docs.columns) if c not in own]
    keys = [(text_bytes(text) + OVERHEAD).alias("size"), sort_key(id, text).alias("_key"), F.xxhash64(id, F.lit(2)).alias("_lot")]
    keyed = docs.select(*carried, *keys)
    rows = stored(keyed.select("size", "_key", "_lot"), "shard-keys")
    borders = splitters(rows, shards, "size", tolerance)

    place = F.lit(0)
    for border in borders:
        place = place + (F.col("_key") >= F.lit(border)).cast("int")
    placed = {"shard": place.cast("int"), "_range": F.shiftright("_key", _KEY_BITS - _CELL_BITS).cast("int")}
    cell = ["shard", "_range", "_part"]

    limit = max(_CELL_ROWS, rows.count() >> _CELL_BITS)
    ranges = rows.withColumns(placed).groupBy("shard", "_range").agg(F.count(F.lit(1)).alias("n"))
    large = ranges.where(F.col("n") > limit).select("shard", "_range", F.ceil(F.col("n") / limit).alias("_parts"))
    large = F.broadcast(stored(large, "large-cells"))

    def in_cells(df: DataFrame) -> DataFrame:
        part = F.coalesce(F.pmod("_lot", "_parts"), F.lit(0)).cast("int")
        return df.withColumns(placed).join(large, ["shard", "_range"], "left").withColumn("_part", part).drop("_parts")

    counts = in_cells(rows).groupBy(*cell).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("_range", "_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*cell, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_offset"))
    offsets = F.broadcast(stored(offsets, "cell-offsets"))

    order = Window.partitionBy(*cell).orderBy("_key", "_lot")
    slot = F.col("_offset") + F.row_number().over(order) - 1
    numbered = in_cells(keyed).join(offsets, cell).withColumn("slot", slot.cast("long"))
    return numbered.select(*carried, *own)


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """One folder per shard, rows in the order of their slots within each file."""
    sharded = shard(docs, **options)
    sharded.sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path)

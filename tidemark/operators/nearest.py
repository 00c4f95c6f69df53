"""Exact nearest neighbours of every row, in tasks of bounded memory.

Rows are grouped around pivots (a bounded sample of the rows) and groups that lie close to each other share one of a few
blocks, which hold equally many rows. A first pass inside each row's own block gives an upper bound for the distance of its
k-th neighbour. A second pass sends a row once to every other block that can hold anything closer - by the triangle
inequality, one with a group where d(row, pivot) - radius(group) <= bound. Inside a block the same test passes over groups;
what remains is compared by a matrix product, whose rounding errors are allowed for, and only pairs within the bound are
measured exactly. Of equal rows of a block only the k + 1 with the smallest ids are compared. Only the k best per row and
block leave a task.

At worst, where no group can be passed over, every pair of rows goes through the matrix product; a task never holds more
than two blocks, and a row is sent to each block once.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.sampling import lottery, sample_rows
from tidemark.session import stored

BLOCK_ROWS = 2000
MAX_PIVOTS = 8192
#: Blocks, as long as none holds more than so many numbers; beyond that there are more blocks.
BLOCKS = 12
_VALUES_IN_BLOCK = 2_500_000
_ROWS_AT_ONCE = 512
_GUESTS_AT_ONCE = 2048
_HOSTS_AT_ONCE = 1024
_PAIRS_AT_ONCE = 1_000_000
_SLACK = 1e-9
_CELLS_AT_ONCE = 4_000_000


def id_column(df: DataFrame, id: str) -> Column:
    """Whole numbers as longs, all else as text."""
    whole = df.schema[id].dataType.typeName() in ("byte", "short", "integer", "long")
    return F.col(id).cast("long" if whole else "string")


def nearest(df: DataFrame, id: str, vector: str, k: int = 1, block_rows: int = BLOCK_ROWS, seed: int = 42) -> DataFrame:
    """(id, neighbour, distance, rank) with ranks 1..k by (distance, neighbour); a row is not its own neighbour.

    `vector` holds numbers, as many in every row. Ids are longs or, unless they are whole numbers, texts. Groups hold about
    `block_rows` rows, and more where there would be more than MAX_PIVOTS of them.
    """
    points = df.select(id_column(df, id).alias("id"), F.col(vector).cast("array<double>").alias("x"))
    points = stored(points.withColumn("no", F.monotonically_increasing_id()), "points")
    rows = points.count()
    wanted = max(1, min(MAX_PIVOTS, ceil(rows / block_rows)))
    pivots = np.array([r["x"] for r in sample_rows(points, "id", wanted, seed).select("x").collect()], dtype="float64")
    dims = pivots.shape[1] if pivots.ndim == 2 else 1

    kind = points.schema["id"].dataType.simpleString()
    point = f"id {kind}, x array<double>, no long"
    grouped = stored(points.mapInArrow(_nearest_pivot(pivots), f"{point}, cell int, away double"), "cells")
    cells = grouped.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius"))
    # At most one row per pivot.
    shape = {r["cell"]: (r["n"], r["radius"]) for r in cells.collect()}
    blocks = max(1, min(BLOCKS, ceil(rows / block_rows)), ceil(rows * dims / _VALUES_IN_BLOCK))
    blocks_of = _in_blocks(pivots, shape, rows, blocks, block_rows)

    spark = df.sparkSession
    homes = spark.createDataFrame([(c, b) for c, b in blocks_of.items()], "_cell int, _blocks array<int>")
    mine = F.pmod(lottery(F.col("no"), seed + 1), F.size("_blocks")).cast("int")
    placed = grouped.join(F.broadcast(homes), F.col("cell") == F.col("_cell")).select(
        "id", "x", "no", "cell", F.element_at("_blocks", mine + 1).alias("block")
    )

    found = f"id {kind}, neighbour {kind}, distance double, no long"
    own = stored(placed.groupBy("block").applyInArrow(_within_block(k), found), "own-block")
    bound = own.groupBy(F.col("no").alias("_no")).agg(F.count(F.lit(1)).alias("_n"), F.max("distance").alias("_d"))
    asking = placed.join(bound, F.col("no") == F.col("_no"), "left").select(
        "id", "x", "no", "block", F.when(F.col("_n") >= k, F.col("_d")).alias("bound")
    )
    guests = asking.mapInArrow(_visits(pivots, shape, blocks_of), f"{point}, bound double, lane int, to_block int")
    hosts = placed.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).where(F.col("lane") != F.col("block"))
    # Few rows make long work here, so the number of tasks must not follow from the bytes.
    tasks = max(1, min(blocks * (blocks - 1), 8 * spark.sparkContext.defaultParallelism))
    other = (
        guests.repartition(tasks, "to_block", "lane").groupBy("to_block", "lane")
        .cogroup(hosts.repartition(tasks, "block", "lane").groupBy("block", "lane"))
        .applyInArrow(_across_blocks(k), found)
    )
    best = F.row_number().over(Window.partitionBy("id").orderBy("distance", "neighbour"))
    return own.unionByName(other).drop("no").withColumn("rank", best).where(F.col("rank") <= k)


def _in_blocks(pivots: np.ndarray, shape: dict[int, tuple[int, float]], rows: int, blocks: int, block_rows: int) -> dict[int, list[int]]:
    """The blocks of every cell: cells around the same coarse pivot follow each other, and the row is cut evenly."""
    cells = sorted(shape)
    if not cells:
        return {}
    coarse = pivots[cells][:: max(1, len(cells) // blocks)]
    d = _rough(pivots[cells], coarse)
    order = np.lexsort((d.min(axis=1), d.argmin(axis=1)))
    # Larger cells are cut into parts.
    most = max(block_rows, ceil(rows / blocks / 4))
    before, out = 0, {}
    for c in (cells[i] for i in order):
        n = shape[c][0]
        parts = ceil(n / most)
        out[c] = [min(blocks - 1, int((before + (p + 0.5) * n / parts) * blocks / rows)) for p in range(parts)]
        before += n
    return out


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    sizes = pc.unique(pc.list_value_length(lists)).to_pylist()
    if len(sizes) > 1 or None in sizes:
        raise ValueError("vectors must not be null and must hold equally many numbers")
    return lists.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(len(lists), sizes[0] if sizes else 0)


def _rough(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances by a matrix product, to be taken with the allowance of `_error`."""
    return (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)


def _error(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """More than the rounding error of a squared distance between a row of `a` and any of `b`."""
    largest = (b * b).sum(axis=1).max() if len(b) else 0.0
    return 2e-15 * (a.shape[1] + 8) * ((a * a).sum(axis=1) + largest)


def _exact(a: np.ndarray, b: np.ndarray, row: np.ndarray, col: np.ndarray) -> np.ndarray:
    out = np.empty(len(row))
    step = max(1, _CELLS_AT_ONCE // max(1, a.shape[1]))
    for start in range(0, len(row), step):
        gap = a[row[start : start + step]] - b[col[start : start + step]]
        out[start : start + step] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
    return out


def _in_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bounds the memory of a task: rows at once times pivots."""
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS_AT_ONCE):
            yield batch.slice(start, _ROWS_AT_ONCE)


def _nearest_pivot(pivots: np.ndarray):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middle = pivots.mean(axis=0) if len(pivots) else 0.0
        for batch in _in_pieces(batches):
            x = _matrix(batch["x"])
            cell = _rough(x - middle, pivots - middle).argmin(axis=1)
            away = _exact(x, pivots, np.arange(len(x)), cell)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype("int32")), pa.array(away)], [*batch.schema.names, "cell", "away"])

    return assign


class _Best:
    """The k nearest hosts of every guest so far: numbers of guests and hosts, distances."""

    def __init__(self, guests: int, k: int, bound: np.ndarray, order: np.ndarray):
        self.k, self.bound, self.order = k, bound, order
        self.kept = [(np.empty(0, dtype=int), np.empty(0, dtype=int), np.empty(0))]
        self.waiting = 0

    def add(self, row: np.ndarray, col: np.ndarray, d: np.ndarray) -> None:
        self.kept.append((row, col, d))
        self.waiting += len(row)
        if self.waiting > _PAIRS_AT_ONCE:
            self.cut()

    def cut(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        row, col, d = (np.concatenate(parts) for parts in zip(*self.kept))
        sorted_by = np.lexsort((self.order[col], d, row))
        row, col, d = row[sorted_by], col[sorted_by], d[sorted_by]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        full = place == self.k - 1
        self.bound[row[full]] = np.minimum(self.bound[row[full]], d[full])
        row, col, d = row[place < self.k], col[place < self.k], d[place < self.k]
        self.kept, self.waiting = [(row, col, d)], 0
        return row, col, d


def _few_of_equal(x: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """Numbers of the rows without those that have k + 1 equal rows before them in the order."""
    whole = np.ascontiguousarray(x).view(np.dtype((np.void, x.shape[1] * 8))).ravel() if x.shape[1] else np.zeros(len(x))
    same = np.unique(whole, return_inverse=True)[1].ravel()
    by = np.lexsort((order, same))
    place = np.arange(len(by)) - np.searchsorted(same[by], same[by])
    return by[place <= k]


def _search(guests: pa.Table, hosts: pa.Table, k: int, bound: np.ndarray | None = None) -> pa.Table:
    """The k nearest hosts of each guest, as far as they are within its bound; a row is no host of itself."""
    names = ["id", "neighbour", "distance", "no"]
    none = pa.table([guests["id"].combine_chunks()[:0], hosts["id"].combine_chunks()[:0], pa.array([], "float64"), pa.array([], "int64")], names)
    if not guests.num_rows or not hosts.num_rows:
        return none
    g, h = _matrix(guests["x"]), _matrix(hosts["x"])
    guest_no, host_no = guests["no"].to_numpy(), hosts["no"].to_numpy()
    ids = hosts["id"].combine_chunks()
    order = pc.rank(ids, sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy().astype("int64")
    cell = hosts["cell"].to_numpy()
    fit = np.isfinite(h).all(axis=1)
    use = np.flatnonzero(fit)[_few_of_equal(h[fit], order[fit], k)]
    use = use[np.argsort(cell[use], kind="stable")]
    h, order, host_no, cell = h[use], order[use], host_no[use], cell[use]
    out = []
    # Runs of one cell, not too long, each with its middle and its radius.
    starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else np.empty(0, dtype=int)
    runs = [(s, min(s + _HOSTS_AT_ONCE, e)) for a, e in zip(starts, np.r_[starts[1:], len(cell)]) for s in range(a, e, _HOSTS_AT_ONCE)]
    shift = h.mean(axis=0) if len(h) else 0.0
    g_near, h_near = g - shift, h - shift
    middles = np.array([h_near[a:b].mean(axis=0) for a, b in runs]).reshape(len(runs), g.shape[1])
    radius = np.array([np.sqrt(((h_near[a:b] - m) ** 2).sum(axis=1).max()) for (a, b), m in zip(runs, middles)])
    # One product gives a squared distance less that of the guest to the middle.
    product = np.hstack([h_near, (h_near * h_near).sum(axis=1)[:, None]]).T.copy()
    seat = np.argsort(guests["cell"].to_numpy(), kind="stable") if "cell" in guests.column_names else np.arange(len(g))
    seat = seat[np.isfinite(g[seat]).all(axis=1)] if len(runs) else seat[:0]
    for start in range(0, len(seat), _GUESTS_AT_ONCE):
        here = seat[start : start + _GUESTS_AT_ONCE]
        a, near, no = g[here], g_near[here], guest_no[here]
        best = _Best(len(here), k, np.full(len(here), np.inf) if bound is None else bound[here].copy(), order)
        doubled = np.hstack([-2 * near, np.ones((len(here), 1))])
        norm, error = (near * near).sum(axis=1), _error(near, h_near)
        gaps = np.sqrt(np.maximum(_rough(near, middles) - error[:, None], 0))
        least = gaps - radius[None, :] * (1 + _SLACK)
        # Runs that are close to most of these guests come first, as they lower the bounds.
        for i, run in enumerate(np.argsort(gaps.mean(axis=0), kind="stable")):
            first, last = runs[run]
            ask = np.flatnonzero(least[:, run] <= best.bound * (1 + _SLACK) + _SLACK)
            if not len(ask):
                continue
            whole = len(ask) == len(here)
            rest = (doubled if whole else doubled[ask]) @ product[:, first:last]
            limit = (best.bound * (1 + _SLACK) + _SLACK) ** 2 + error - norm
            if not np.isfinite(best.bound[ask]).all() and last - first > k + 1:
                # The k + 1 smallest of this run, one of which may be the guest itself.
                edge = np.partition(rest, k, axis=1)[:, k] + 2 * error[ask]
                limit = limit.copy()
                limit[ask] = np.minimum(limit[ask], edge)
            row, col = np.nonzero(rest <= limit[ask][:, None])
            row, col = ask[row], col + first
            other = no[row] != host_no[col]
            row, col = row[other], col[other]
            d = _exact(a, h, row, col)
            closer = d <= best.bound[row]
            best.add(row[closer], col[closer], d[closer])
            if i < 4 or i % 16 == 0:
                best.cut()
        row, col, d = best.cut()
        taken = pa.array(here[row])
        out.append(pa.table([guests["id"].combine_chunks().take(taken), ids.take(pa.array(use[col])), pa.array(d), pa.array(no[row])], names))
    return pa.concat_tables(out) if out else none


def _within_block(k: int):
    def search(block: pa.Table) -> pa.Table:
        return _search(block, block, k)

    return search


def _visits(pivots: np.ndarray, shape: dict[int, tuple[int, float]], blocks_of: dict[int, list[int]]):
    cells = sorted(shape)
    place = {c: i for i, c in enumerate(cells)}
    parts = sorted({(b, place[c]) for c, blocks in blocks_of.items() for b in blocks})
    block = np.array([b for b, _ in parts], dtype="int64")
    cell = np.array([c for _, c in parts], dtype="int64")
    starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if len(block) else np.empty(0, dtype=int)
    radius = np.array([shape[c][1] for c in cells])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middle = pivots[cells].mean(axis=0) if cells else 0.0
        centres = pivots[cells] - middle
        for batch in _in_pieces(batches):
            x = _matrix(batch["x"]) - middle
            d = np.sqrt(np.maximum(_rough(x, centres) - _error(x, centres)[:, None], 0))
            bound = pc.fill_null(batch["bound"], np.inf).to_numpy(zero_copy_only=False)
            reach = d - radius[None, :] * (1 + _SLACK) <= (bound * (1 + _SLACK) + _SLACK)[:, None]
            row, to = np.nonzero(np.logical_or.reduceat(reach[:, cell], starts, axis=1))
            to_block = block[starts][to].astype("int32")
            home = batch["block"].to_numpy()
            elsewhere = home[row] != to_block
            row, to_block = row[elsewhere], to_block[elsewhere]
            sent = batch.select(["id", "x", "no"]).take(pa.array(row))
            more = [pa.array(bound[row]), pa.array(home[row].astype("int32")), pa.array(to_block)]
            yield pa.RecordBatch.from_arrays([*sent.columns, *more], [*sent.schema.names, "bound", "lane", "to_block"])

    return spread


def _across_blocks(k: int):
    def search(guests: pa.Table, hosts: pa.Table) -> pa.Table:
        return _search(guests, hosts, k, guests["bound"].to_numpy())

    return search

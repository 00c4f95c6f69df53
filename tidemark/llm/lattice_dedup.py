"""Near copies among embeddings by lattice hashing.

Random projections of the unit vectors are decoded, eight coordinates at a time, to points of the lattice E8; the points of
one or more such blocks name a cell of one table. A vector lies in its own cell of every table and visits PROBES cells: its
own and the nearest neighbouring ones, in order of their distance over all blocks. Cells in which nobody visits another
vector are dropped by their counts, before any vector is moved; in the others visitors meet residents in bounded pieces and
the cosine is verified in double precision on the original vectors.

Width of the cells, blocks and number of tables follow from the number of vectors (`plan`): about CROWD unrelated vectors
are met in a table, whatever the size, and there are so many tables that a pair exactly at the bound is found with
probability RECALL; pairs above it are found more often. The chance depends on the pair's distance alone, not on the
dimension of the vectors or on what else is in the table, and is measured on simulated pairs.

A pair that meets several times counts where it meets first: both cells are recomputed from the vectors, so neither pairs nor
lists of partners are ever sent, only counts for each vector and one link for each vector to the smallest of those linked in
the same piece. Equal vectors are one class with a size.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import attach, pieces, stored
from tidemark.llm.vectors import components, longest, matrix, meetings, padded, parts, whole

LEAST = 0.95
RECALL = 0.998
PROBES = 8
CROWD = 0.5
MOST_BLOCKS = 4
SEED = 8
#: Pairs simulated to choose the tables.
SIMULATED = 4000
#: Residents and visitors of a cell that one task holds and streams, and rows compared at a time.
RESIDENTS, VISITORS, PIECE = 512, 8192, 512


@cache
def roots() -> np.ndarray:
    """The 240 shortest vectors of E8, doubled so that they are whole numbers."""
    two = [np.bincount([i, j], weights=[a, b], minlength=8) for i, j in itertools.combinations(range(8), 2) for a in (2, -2) for b in (2, -2)]
    halves = [np.array(s, dtype="float64") for s in itertools.product((1, -1), repeat=8) if s.count(-1) % 2 == 0]
    return np.array(two + halves)


def _nearest_even(y: np.ndarray) -> np.ndarray:
    """Nearest whole vector with an even sum: the worst rounded coordinate is rounded the other way where it is odd."""
    point = np.rint(y)
    rest = y - point
    odd = np.flatnonzero(point.sum(axis=1) % 2)
    worst = np.abs(rest[odd]).argmax(axis=1)
    point[odd, worst] += np.where(rest[odd, worst] >= 0, 1.0, -1.0)
    return point


def decode(y: np.ndarray) -> np.ndarray:
    """The nearest points of E8: whole vectors with an even sum, or those moved by one half."""
    whole_one, half = _nearest_even(y), _nearest_even(y - 0.5) + 0.5
    nearer = np.square(y - whole_one).sum(axis=1) <= np.square(y - half).sum(axis=1)
    return np.where(nearer[:, None], whole_one, half)


class Tables:
    """Projections, shifts and cell numbers of all tables for vectors of one length."""

    def __init__(self, length: int, blocks: int, width: float, tables: int, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.blocks, self.tables = blocks, tables
        self.project = rng.normal(size=(length, tables * blocks * 8)) / width
        self.shift = rng.uniform(0, 2, size=tables * blocks * 8)
        self.factor = rng.integers(-(1 << 62), 1 << 62, size=(tables, blocks, 8)) | 1
        self.salt = rng.integers(-(1 << 62), 1 << 62, size=tables)

    def cells(self, unit: np.ndarray, probes: int = PROBES) -> np.ndarray:
        """By row and table the numbers of the nearest cells, the own one first."""
        y = unit @ self.project + self.shift
        out = np.empty((len(unit), self.tables, probes), dtype="int64")
        for t in range(self.tables):
            out[:, t] = self.table_cells(y[:, t * self.blocks * 8 : (t + 1) * self.blocks * 8], t, probes)
        return out

    def table_cells(self, y: np.ndarray, t: int, probes: int) -> np.ndarray:
        far = np.zeros((len(y), 1))
        cell = np.full((len(y), 1), self.salt[t])
        for b in range(self.blocks):
            part = y[:, 8 * b : 8 * b + 8]
            point = decode(part)
            number = (2 * point).astype("int64") @ self.factor[t, b]
            # How much farther than the nearest point its neighbours lie.
            extra = 2 - (part - point) @ roots().T
            some = np.argpartition(extra, probes - 1, axis=1)[:, : probes - 1]
            more = np.take_along_axis(extra, some, 1)
            steps = (roots().astype("int64") @ self.factor[t, b])[some]
            far_here = np.hstack([np.zeros((len(y), 1)), np.maximum(more, 1e-9)])
            cell_here = np.hstack([number[:, None], number[:, None] + steps])
            far = (far[:, :, None] + far_here[:, None, :]).reshape(len(y), -1)
            cell = (cell[:, :, None] + cell_here[:, None, :]).reshape(len(y), -1)
            best = np.argsort(far, axis=1, kind="stable")[:, :probes]
            far, cell = np.take_along_axis(far, best, 1), np.take_along_axis(cell, best, 1)
        return cell


def _found(least: float, blocks: int, width: float, probes: int) -> float:
    """Share of simulated pairs with cosine `least` of which one visits the other's cell in one table."""
    table = Tables(1, blocks, width, 1)
    rng = np.random.default_rng(SEED + blocks)
    y = rng.uniform(0, 2, size=(SIMULATED, 8 * blocks))
    other = y + rng.normal(size=y.shape) * np.sqrt(2 - 2 * least) / width
    a, b = table.table_cells(y, 0, probes), table.table_cells(other, 0, probes)
    return float(((a == b[:, :1]) | (b == a[:, :1])).any(axis=1).mean())


def plan(vectors: int, least: float = LEAST, recall: float = RECALL, probes: int = PROBES) -> tuple[int, float, int]:
    """Blocks and width of the cells and number of tables with the fewest tables for that many vectors.

    The projected difference of two unrelated unit vectors has a density of (width**2 / 4 / pi)**(4 * blocks) at zero, and
    a cell has volume 1, which gives the width at which a vector meets CROWD unrelated ones.
    """
    choices = []
    for blocks in range(1, MOST_BLOCKS + 1):
        width = float(np.sqrt(4 * np.pi * (CROWD / (probes * max(2, vectors))) ** (1 / (4 * blocks))))
        found = _found(least, blocks, width, probes)
        if 0 < found:
            choices.append((int(np.ceil(np.log(1 - recall) / np.log(max(1e-9, 1 - found)))), blocks, width))
    tables, blocks, width = min(choices)
    return blocks, width, tables


def _unit(x: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    x = x / np.abs(x).max(axis=1, keepdims=True, initial=1e-300)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _post(tables: Tables):
    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 2048):
            cells = tables.cells(_unit(matrix(batch.column("x"))))
            rows, width = len(cells), cells[0].size if len(cells) else 0
            starts = pa.array(np.arange(rows + 1, dtype="int32") * width)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.ListArray.from_arrays(starts, pa.array(cells.ravel()))], names=["node", "cells"]
            )

    return post


def _verify(tables: Tables, least: float):
    """Counts and links of the pairs that meet here first: (node, links, root)."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in pieces(batches, PIECE):
            names = ("cell", "side", "node", "n", "t")
            piece = {name: batch.column(name).to_numpy() for name in names} | {"x": matrix(batch.column("x"))}
            resident = piece["side"] == 0
            # Residents of a cell come before its visitors: those of the last cell may have to wait for the next piece.
            held = {name: a[resident] for name, a in piece.items()}
            if kept is not None:
                held = {name: np.concatenate([kept[name], a]) for name, a in held.items()}
            guests = {name: a[~resident] for name, a in piece.items()}
            if len(guests["cell"]) and len(held["cell"]):
                yield from _links(guests, held, tables, least)
            last = held["cell"] == piece["cell"][-1] if len(piece["cell"]) else slice(None)
            kept = {name: a[last] for name, a in held.items()}

    return verify


def _links(guests: dict, held: dict, tables: Tables, least: float) -> Iterator[pa.RecordBatch]:
    a, b = _unit(guests["x"]), _unit(held["x"])
    met = (guests["cell"][:, None] == held["cell"]) & (guests["node"][:, None] != held["node"])
    # A little below the bound here; the pairs left are measured once more on the original vectors.
    met &= a @ b.T >= least - 1e-9
    g, h = np.nonzero(met)
    x, y = guests["x"][g], held["x"][h]
    x, y = x / np.abs(x).max(axis=1, keepdims=True, initial=0), y / np.abs(y).max(axis=1, keepdims=True, initial=0)
    cosine = np.einsum("ij,ij->i", x, y) / np.sqrt(np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y))
    g, h = g[cosine >= least], h[cosine >= least]
    if not len(g):
        return
    some_g, g_at = np.unique(g, return_inverse=True)
    some_h, h_at = np.unique(h, return_inverse=True)
    g_cells, h_cells = tables.cells(a[some_g]), tables.cells(b[some_h])
    first = np.ones(len(g), dtype=bool)
    here = guests["t"][g]
    smaller = guests["node"][g] < held["node"][h]
    for t in range(int(here.max()) + 1):
        open_ = np.flatnonzero(first & (here >= t))
        gc, hc = g_cells[g_at[open_], t], h_cells[h_at[open_], t]
        visits = (gc == hc[:, :1]).any(axis=1)
        visited = (hc == gc[:, :1]).any(axis=1)
        # In one table the visit of the smaller node comes first.
        now = here[open_] == t
        earlier = np.where(now, visited & ~smaller[open_], visits | visited)
        first[open_[earlier]] = False
    g, h = g[first], h[first]
    if not len(g):
        return
    # One number for each vector of the piece; a visitor may also be a resident here.
    nodes, at = np.unique(np.concatenate([guests["node"][g], held["node"][h]]), return_inverse=True)
    u, v = at[: len(g)], at[len(g) :]
    links = np.bincount(u, weights=held["n"][h], minlength=len(nodes)) + np.bincount(v, weights=guests["n"][g], minlength=len(nodes))
    root = np.arange(len(nodes))
    while True:
        before = root.copy()
        low = np.minimum(root[u], root[v])
        np.minimum.at(root, u, low)
        np.minimum.at(root, v, low)
        root = root[root]
        if (root == before).all():
            break
    yield pa.RecordBatch.from_arrays(
        [pa.array(nodes), pa.array(links.astype("int64")), pa.array(nodes[root])], names=["node", "links", "root"]
    )


def near_duplicates(
    table: DataFrame, id: str = "vec_id", vector: str = "embedding", least: float = LEAST, recall: float = RECALL
) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per row of `table`.

    Two vectors are linked when their cosine, in double precision, is at least `least`; no pair below it is linked. `n_links`
    counts the other rows linked directly, `component_id` is the smallest id that links reach, and the row that has it is kept.
    Every linked pair is found with a probability of at least `recall`, of 1 where the vectors are equal.

    Vectors that are null, zero or empty or hold null or non-finite components are linked with nothing and kept. Shorter
    vectors count as ended in zeros. Rows that repeat an id are rows of their own, linked if their vectors are. Null ids
    are no smallest ids: a component without any other has a null component_id and keeps its rows. An empty table
    gives an empty result. `id` may have any type with an order. Other columns are ignored.
    """
    spark = table.sparkSession
    values = F.col(vector).cast("array<double>")
    rows = table.select(F.col(id).alias("vec_id"), F.when(whole(values) & F.exists(values, lambda v: v != 0), values).alias("x"))
    length = longest(rows, "x")
    x = padded(F.col("x"), length, F.lit(0.0))
    if dict(table.dtypes)[vector] == "array<float>":
        x = x.cast("array<float>")
    # Two hashes with different seeds tell vectors apart.
    rows = rows.select("vec_id", x.alias("x")).withColumn("h", F.struct(F.xxhash64("x").alias("a"), F.xxhash64(F.lit(1), F.col("x")).alias("b")))
    rows = stored(rows.withColumn("h", F.when(F.col("x").isNotNull(), F.col("h"))), "rows")
    classes = rows.where("x IS NOT NULL").groupBy("h").agg(
        F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("n"), F.any_value("x").alias("x")
    )
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    total = classes.count()
    if not total:
        return rows.select(
            "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
        )
    found = stored(_pairs(classes.select("node", "n", "x"), total, length, least, recall), "links")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    ends = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))

    known = classes.select("node", "h", "first", "n").join(counts, "node", "left").join(ends, "node", "left")
    known = stored(known.withColumn("root", F.coalesce("root", "node")), "known-classes")
    # Minima by component are partial sums first; the join back splits large components.
    smallest = known.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("held"))
    known = attach(known, stored(smallest, "smallest"), "root", "held", total)
    known = known.select("h", "n", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    whole_rows, blank = rows.where("h IS NOT NULL").select("vec_id", "h"), rows.where("h IS NULL").select("vec_id")
    out = attach(whole_rows, stored(known, "class-results"), "h", "n", rows.count())
    kept = F.col("vec_id").eqNullSafe(F.col("component_id"))
    alone = blank.select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
    )
    return out.select("vec_id", "n_links", "component_id", kept.alias("kept")).unionByName(alone)


def _pairs(classes: DataFrame, total: int, length: int, least: float, recall: float) -> DataFrame:
    """(node, links, root) of all pieces."""
    tables = Tables(length, *plan(total, least, recall))
    posted = classes.select("node", "x").mapInArrow(_post(tables), "node long, cells array<long>")
    posted = posted.select("node", F.posexplode("cells").alias("place", "cell"))
    posts = stored(posted.select("node", "cell", F.expr(f"place div {PROBES}").cast("int").alias("t"), (F.col("place") % PROBES == 0).alias("own")), "posts")
    # Every post is a visit, the own one a residence as well.
    cells = posts.groupBy("cell").agg(
        F.count(F.lit(1)).alias("visits"), F.count_if("own").alias("residents"), F.min("node").alias("a"), F.max("node").alias("b")
    )
    cells = cells.where("residents > 0 AND a <> b").select(
        "cell", "visits", parts(F.col("residents"), RESIDENTS).alias("lanes"), parts(F.col("visits"), VISITORS).alias("batches")
    )
    cells = stored(cells, "cells")
    met = attach(posts, cells, "cell", "visits", posts.count())
    met = met.select(F.col("cell").alias("key"), "t", "own", "lanes", "batches", "node").join(classes, "node")
    met = stored(met, "met")
    sides = ["key", "t", "lanes", "batches", "node", "n", "x"]
    dealt = meetings(met.where("own").select(*sides), met.select(*sides), ["node"])
    return dealt.mapInArrow(_verify(tables, least), "node long, links long, root long")

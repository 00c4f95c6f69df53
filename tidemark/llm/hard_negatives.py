"""Hard negatives by exact integer products in a residue number system.

Components are scaled and rounded down to integers. The integer products of a block of anchors with a block of rows are
taken modulo several primes below 1024: residues between -p/2 and p/2 and stretches of 64 components keep every partial
sum below 2**24, where a float32 matrix product is exact. The residues are put together by the Chinese remainder theorem
into the exact signed score; so many primes are used that their product exceeds twice the largest possible score.

Two sweeps choose by windows on the score. The first meets anchors with the rows of their label and keeps the best as
positives. The second meets anchors, each with the bands of score that its positives open, with the rows of other labels.
Blocks keep only the first few of each anchor and band, so a task holds at most ANCHORS anchors and their lists.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import attach, pieces, stored
from tidemark.llm.vectors import longest, matrix, meetings, padded, parts, task_count, whole

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
#: Bounds of a negative's score, in percent of its positive's.
LOWEST, HIGHEST = 80, 100
#: Anchors that a task holds, and rows that stream past them: at least and at most in a task.
ANCHORS = 1024
LEAST_ROWS, MOST_ROWS = 1 << 12, 1 << 18
#: Rows of a block of products.
BLOCK = 1024
#: Scores must stay below this, so that all steps fit in 64 bits.
MOST = 1 << 51
#: 64 products of residues of a prime below 1024 add up to less than 2**24.
STRETCH = 64
_NONE = -(1 << 61)


def moduli(bound: int) -> list[int]:
    """The largest primes below 1024 whose product tells all integers between -bound and bound apart."""
    chosen, product, p = [], 1, 1023
    while product <= 2 * bound:
        if all(p % q for q in range(3, int(p**0.5) + 1, 2)):
            chosen.append(p)
            product *= p
        p -= 2
    return chosen


def residues(x: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """Of integers, by prime: the residue nearest to zero, as float32."""
    out = []
    for p in primes:
        r = x % p
        out.append((r - p * (r > p // 2)).astype("float32"))
    return out


def products(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact inner products of the rows behind two lists of residues."""
    value, product = np.zeros((len(a[0]), len(b[0])), dtype="int64"), 1
    for x, y, p in zip(a, b, primes):
        rest = np.zeros(value.shape, dtype="int32")
        for start in range(0, x.shape[1], STRETCH):
            part = x[:, start : start + STRETCH] @ y[:, start : start + STRETCH].T
            rest = (rest + part.astype("int32")) % p
        digit = (rest - value % p) * pow(product, -1, p) % p
        value += digit * product
        product *= p
    return np.where(value > product // 2, value - product, value)


class _Held:
    """The anchors of one cell with their bands, and the first entries found of each band."""

    def __init__(self, batch: pa.Table, primes: list[int], same: bool, most: int):
        self.node = batch["node"].to_numpy()
        self.code = batch["code"].to_numpy()
        self.x = residues(matrix(batch["x"].combine_chunks(), "int64"), primes)
        self.low = matrix(batch["low"].combine_chunks(), "int64")
        self.high = matrix(batch["high"].combine_chunks(), "int64")
        self.primes, self.same, self.most = primes, same, most
        self.bands = self.low.shape[1]
        # The score that an entry has to exceed: entries come by rising id, so a later tie never wins.
        self.worst = np.full(self.low.shape, _NONE)
        self.found = {name: np.zeros(0, dtype="int64") for name in ("slot", "score", "place", "id", "unnamed", "n")}
        self.seen = 0

    def meet(self, batch: pa.RecordBatch) -> None:
        node, code, n = (batch.column(c).to_numpy() for c in ("node", "code", "n"))
        ids = batch.column("id")
        unnamed = np.asarray(ids.is_null())
        ids = ids.fill_null(0).to_numpy()
        score = products(self.x, residues(matrix(batch.column("x"), "int64"), self.primes), self.primes)
        least = np.maximum(self.low, self.worst + 1).min(axis=1)
        wanted = (score >= least[:, None]) & (score <= self.high.max(axis=1)[:, None])
        wanted &= (self.code[:, None] == code) == self.same
        who, row = np.nonzero(wanted)
        score = score[who, row]
        # An anchor is no partner of itself; its further copies are.
        copies = n[row] - (self.node[who] == node[row])
        entries = {name: [a] for name, a in self.found.items()}
        for band in range(self.bands):
            fits = (score >= self.low[who, band]) & (score <= self.high[who, band]) & (score > self.worst[who, band]) & (copies > 0)
            at = row[fits]
            for name, values in zip(
                entries, (who[fits] * self.bands + band, score[fits], self.seen + at, ids[at], unnamed[at], copies[fits])
            ):
                entries[name].append(values)
        self.seen += len(node)
        self.found = {name: np.concatenate(a) for name, a in entries.items()}
        self._prune()

    def _prune(self) -> None:
        f = self.found
        order = np.lexsort((f["place"], -f["score"], f["slot"]))
        slot = f["slot"][order]
        number = np.arange(len(slot)) - np.searchsorted(slot, slot)
        last = number == self.most - 1
        self.worst.flat[slot[last]] = f["score"][order][last]
        order = order[number < self.most]
        self.found = {name: a[order] for name, a in f.items()}

    def out(self) -> pa.RecordBatch:
        f = self.found
        return pa.RecordBatch.from_pydict(
            {
                "anchor": pa.array(self.node[f["slot"] // max(1, self.bands)], pa.int64()),
                "band": pa.array(f["slot"] % max(1, self.bands), pa.int32()),
                "id": pa.array(f["id"], pa.int64(), mask=f["unnamed"].astype(bool)),
                "score": pa.array(f["score"], pa.int64()),
                "n": pa.array(np.minimum(f["n"], self.most), pa.int64()),
            }
        )


_FOUND = "anchor long, band int, id long, score long, n long"


def _sweep(primes: list[int], same: bool, most: int):
    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, waiting, held = None, [], None
        for batch in pieces(batches, BLOCK):
            cell, side = batch.column("cell").to_numpy(), batch.column("side").to_numpy()
            edges = np.flatnonzero((cell[1:] != cell[:-1]) | (side[1:] != side[:-1])) + 1
            for start, stop in zip([0, *edges.tolist()], [*edges.tolist(), len(cell)]):
                if start == stop:
                    continue
                if cell[start] != at:
                    if held is not None:
                        yield held.out()
                    at, waiting, held = cell[start], [], None
                part = batch.slice(start, stop - start)
                if side[start] == 0:
                    waiting.append(part)
                elif waiting or held is not None:
                    held = held or _Held(pa.Table.from_batches(waiting), primes, same, most)
                    waiting = []
                    held.meet(part)
        if held is not None:
            yield held.out()

    return sweep


def _met(guests: DataFrame, rows: DataFrame, x: Column, primes: list[int], same: bool, most: int) -> DataFrame:
    """The first `most` rows of every band of every anchor, copies apart: (anchor, band, place, id, score)."""
    both = ["key", "lanes", "batches", "node", "id", "code", "n"]
    held = guests.select(*both, x.alias("x"), "low", "high")
    none = F.lit(None).cast("array<long>")
    streamed = rows.select(*both, x.alias("x"), none.alias("low"), none.alias("high"))
    dealt = meetings(held, streamed, [F.col("id").asc_nulls_last(), "node"])
    found = dealt.mapInArrow(_sweep(primes, same, most), _FOUND)
    along = Window.partitionBy("anchor", "band").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    before = F.sum("n").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    first = found.withColumn("before", before).where(F.col("before") < most)
    places = F.sequence(F.col("before") + 1, F.least(F.col("before") + F.col("n"), F.lit(most)))
    return first.select("anchor", "band", "id", "score", F.explode(places.cast("array<int>")).alias("place"))


def hard_negatives(
    table: DataFrame,
    anchors: Callable[[Column], Column],
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lowest: int = LOWEST,
    highest: int = HIGHEST,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Every row whose id meets the condition `anchors` is an anchor. A score is the inner product of floor(scale * component);
    higher scores come first, ties by smaller id, rows without an id last. An anchor's positives are its first rows of
    the same label but itself; with each positive come the first rows of another label whose score lies between `lowest`
    and `highest` percent of the positive's.

    Rows with a null label, a null vector or a null or non-finite component take no part. Shorter vectors count as ended
    in zeros. Repeated rows count as often as they stand there: a copy of an anchor is one of its positives. A null id is
    never an anchor. An empty table gives an empty result. Scores of 2**51 and more are refused with an error. `id` holds
    integers, labels may have any type that can be compared. Other columns are ignored.
    """
    spark = table.sparkSession
    values = F.col(vector).cast("array<double>")
    rows = table.select(F.col(id).cast("long").alias("id"), F.xxhash64(F.lit(1), F.col(label)).alias("code"), values.alias("v"), F.col(label).isNull().alias("blank"))
    rows = rows.where(whole(F.col("v")) & ~F.col("blank")).select("id", "code", "v")
    length = longest(rows, "v")
    scaled = F.transform(padded(F.col("v"), length, F.lit(0.0)), lambda c: F.floor(c * scale))
    alike = rows.select("id", "code", scaled.alias("x")).groupBy("id", "code", "x").agg(F.count(F.lit(1)).alias("n"))
    rows = stored(alike.withColumn("node", F.monotonically_increasing_id()), "scaled-rows")
    norm = F.sqrt(F.aggregate("x", F.lit(0.0), lambda total, c: total + c.cast("double") * c))
    is_anchor = F.coalesce(anchors(F.col("id")), F.lit(False))
    seen = rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(is_anchor).alias("anchors"),
        F.max(norm).alias("norm"),
        F.max(F.when(is_anchor, norm)).alias("anchor_norm"),
        F.max(F.aggregate("x", F.lit(0.0), lambda top, c: F.greatest(top, F.abs(c.cast("double"))))).alias("most"),
    ).first()
    if not seen["anchors"]:
        return spark.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        )
    bound = seen["norm"] * seen["anchor_norm"] * (1 + 1e-9)
    if bound >= MOST:
        raise ValueError(f"scores may reach {bound:.3g}, more than 2**51: use a smaller scale")
    primes = moduli(int(bound) + 1)
    kind = next(t for t, top in (("smallint", 1 << 15), ("int", 1 << 31), ("bigint", 1 << 63)) if (seen["most"] or 0) < top)
    x = F.col("x").cast(f"array<{kind}>")

    per_task = -(-seen["rows"] // task_count(rows))
    stretch = min(MOST_ROWS, max(LEAST_ROWS, per_task))
    sizes = rows.groupBy("code").agg(F.count(F.lit(1)).alias("size"), F.count_if(is_anchor).alias("asked")).where("asked > 0")
    sizes = sizes.select(
        "code", "size", parts(F.col("asked"), ANCHORS).alias("lanes"), parts(F.col("size"), stretch).alias("batches")
    )
    alike = attach(rows, stored(sizes, "label-sizes"), "code", "size", seen["rows"]).withColumn("key", F.col("code"))
    every = F.array(F.lit(_NONE)), F.array(F.lit(-_NONE))
    guests = alike.where(is_anchor).select("*", every[0].alias("low"), every[1].alias("high"))
    found = _met(guests, alike, x, primes, True, positives)
    found = stored(found.select("anchor", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    # Bands that no positive opens hold nothing.
    opened = found.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("p"))
    low = F.transform("p", lambda p: -_floor_percent(-p["positive_score"], lowest))
    high = F.transform("p", lambda p: _floor_percent(p["positive_score"], highest))
    opened = opened.select(
        F.col("anchor").alias("node"),
        F.concat(low, F.array_repeat(F.lit(1).cast("long"), F.lit(positives) - F.size("p"))).alias("low"),
        F.concat(high, F.array_repeat(F.lit(_NONE), F.lit(positives) - F.size("p"))).alias("high"),
    )
    lanes, batches = max(1, -(-seen["anchors"] // ANCHORS)), max(1, -(-seen["rows"] // stretch))
    spread = {"key": F.lit(0).cast("long"), "lanes": F.lit(lanes).cast("long"), "batches": F.lit(batches).cast("long")}
    guests = rows.where(is_anchor).join(opened, "node").withColumns(spread)
    against = _met(guests, rows.withColumns(spread), x, primes, False, negatives)
    against = against.select(
        "anchor", (F.col("band") + 1).alias("place"), F.col("place").alias("rank"),
        F.col("id").alias("negative_id"), F.col("score").alias("negative_score"),
    )
    names = rows.where(is_anchor).select(F.col("node").alias("anchor"), F.col("id").alias("anchor_id"), "n")
    out = against.join(found, ["anchor", "place"]).join(names, "anchor")
    # Equal anchors have equal lists.
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _floor_percent(value: Column, percent: int) -> Column:
    """floor(value * percent / 100) in whole numbers."""
    product, hundred = value * F.lit(percent).cast("long"), F.lit(100).cast("long")
    return F.call_function("div", product - F.pmod(product, hundred), hundred)

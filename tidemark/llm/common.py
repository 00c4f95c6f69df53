"""What several corpus operators need: salt-free joins with hot keys, streaming over Arrow batches, bitmaps."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import stored

__all__ = ["BLANKS", "arrow_rows", "attach", "cell_filter", "filter_bits", "in_filter", "kept_rows", "pieces", "row_key", "stored", "text_of"]

#: The characters that count as white space in all contracts of this package, as a regular expression class.
BLANKS = r"[\x20\x09-\x0D]"
#: A key is hot when it holds more than this share of all rows, so there are at most 1 / HOT_SHARE hot keys.
HOT_SHARE = 1 / 1000


def text_of(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def attach(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """`rows` with the columns of the group of their key; rows without a group are left out.

    `groups` has one row per key and, in `size`, the number of rows of the key; `total` is the number of all
    rows. By the pigeonhole principle at most 1000 keys hold more than a thousandth of the rows: those groups
    are broadcast, so their rows stay where they are; all other keys are small enough for one task.
    """
    edge = F.lit(max(1.0, total * HOT_SHARE))
    hot, cold = F.broadcast(groups.where(F.col(size) > edge)), groups.where(F.col(size) <= edge)
    rest = rows.join(hot.select(key), key, "left_anti")
    return rows.join(hot, key).unionByName(rest.join(cold, key))


def attach_left(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Like `attach`, but rows without a group stay, with nulls. The columns of `groups` come last."""
    edge = F.lit(max(1.0, total * HOT_SHARE))
    hot, cold = F.broadcast(groups.where(F.col(size) > edge)), groups.where(F.col(size) <= edge)
    near = rows.join(hot, key, "left")
    rest = near.where(F.col(size).isNull()).select(*rows.columns)
    return near.where(F.col(size).isNotNull()).unionByName(rest.join(cold, key, "left"))


def kept_rows(docs: DataFrame, keep: DataFrame, key: str, *best: Column) -> DataFrame:
    """The rows of `docs` whose key (never null) is among those of `keep`, one row for every key.

    `best` orders the rows of one key. The key belongs to one document, so one shuffle by it serves the join and
    the choice, and no task gets more than its share.
    """
    found = docs.join(keep.select(key).distinct(), key, "left_semi")
    first = F.row_number().over(Window.partitionBy(key).orderBy(*(best or (F.lit(0),))))
    return found.withColumn("_place", first).where("_place = 1").drop("_place", key)


def row_key(id: str, *parts: Column) -> Column:
    """A text that tells documents apart: the id and what else identifies the row; a null id is a value of its own."""
    return F.concat_ws("/", F.coalesce(F.col(id).cast("string"), F.lit("null")), *parts)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs that run inside hand so many rows at a time to Python; a batch lies outside the heap, twice over."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that a task holds the derived arrays of few documents at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


_CHUNK_BITS = 20


def cell_filter(keys: DataFrame, column: str, bits: int, least: int = 1, probes: int = 4) -> dict[int, bytes]:
    """A Bloom filter of 2**bits cells over 64-bit keys, as chunks of packed bits: was the cell hit `least` times?

    `least` is 1 or 2. Tasks send sorted cell numbers, chunk by chunk; the receivers add them to one byte per cell
    in a stream, so their memory is bounded by the filter. At most 2**bits / 8 bytes come to the driver.
    """
    schema = "chunk int, once binary, twice binary"
    partial = keys.select(F.col(column).alias("h")).mapInPandas(_count_cells(bits, probes), schema)
    wanted = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(1, min(1 << max(0, bits - _CHUNK_BITS), wanted))
    merged = partial.repartition(tasks, "chunk").mapInPandas(_merge_cells(least), "chunk int, bits binary")
    return {r["chunk"]: bytes(r["bits"]) for r in merged.collect()}


def filter_bits(rows: int, most: int, cells_per_row: int = 16) -> int:
    return min(most, max(_CHUNK_BITS, (cells_per_row * rows).bit_length()))


def in_filter(chunks: dict[int, bytes], bits: int, keys: np.ndarray, probes: int = 4) -> np.ndarray:
    """For each key: are all its cells set? False is certain."""
    found = np.ones(len(keys), dtype=bool)
    for row in probe_cells(keys, bits, probes):
        hit = np.zeros(len(row), dtype=bool)
        chunk = row >> np.uint64(_CHUNK_BITS)
        place = (row & np.uint64((1 << _CHUNK_BITS) - 1)).astype("int64")
        for c in np.unique(chunk):
            if int(c) in chunks:
                here = chunk == c
                packed = np.frombuffer(chunks[int(c)], dtype="uint8")
                hit[here] = (packed[place[here] >> 3] >> (7 - (place[here] & 7))) & 1
        found &= hit
    return found


def _count_cells(bits: int, probes: int):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cells = probe_cells(batch["h"].to_numpy(), bits, probes)
            # Probes of one row that meet in one cell are one hit.
            cells.sort(axis=0)
            fresh = np.vstack([np.ones((1, cells.shape[1]), dtype=bool), cells[1:] != cells[:-1]])
            cell, hits = np.unique(cells[fresh], return_counts=True)
            chunk = (cell >> np.uint64(_CHUNK_BITS)).astype("int32")
            place = (cell & np.uint64((1 << _CHUNK_BITS) - 1)).astype("uint32")
            edges = [0, *(np.flatnonzero(chunk[1:] != chunk[:-1]) + 1).tolist(), len(chunk)] if len(chunk) else []
            parts = [slice(a, b) for a, b in zip(edges, edges[1:])]
            yield pd.DataFrame(
                {
                    "chunk": np.array([chunk[p][0] for p in parts], dtype="int32"),
                    "once": [place[p][hits[p] == 1].tobytes() for p in parts],
                    "twice": [place[p][hits[p] > 1].tobytes() for p in parts],
                }
            )

    return count


def _merge_cells(least: int):
    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, once, twice in zip(batch["chunk"], batch["once"], batch["twice"]):
                held = counts.setdefault(chunk, np.zeros(1 << _CHUNK_BITS, dtype="uint8"))
                single = np.frombuffer(once, dtype="uint32")
                held[single] = np.minimum(held[single] + 1, 2)
                held[np.frombuffer(twice, dtype="uint32")] = 2
        for chunk, held in counts.items():
            if (held >= least).any():
                bits = np.packbits(held >= least).tobytes()
                yield pd.DataFrame({"chunk": np.array([chunk], dtype="int32"), "bits": [bits]})

    return merge


def probe_cells(hashes: np.ndarray, bits: int, probes: int) -> np.ndarray:
    """Cells of 64-bit hashes in a filter of 2**bits cells: one row per probe (double hashing)."""
    first = hashes.astype("uint64")
    second = (first >> np.uint64(32)) | np.uint64(1)
    mask = np.uint64((1 << bits) - 1)
    return np.stack([(first + np.uint64(i) * second) & mask for i in range(probes)])

"""Repeated lines, by levelled sorted runs of line keys.

Documents go in batches of rising id. A run is a table of line keys and the first document of each, bucketed
and sorted by key, so reading it back needs no shuffle and sorting it finds it sorted. Each batch is grouped by key once and
merge-joined with the runs: keys found there come from an earlier document, the others become a new run of
level 0. Two runs of one level are merged into one run of the next level, again without a shuffle, so a key is
rewritten a logarithmic number of times and a batch meets a logarithmic number of runs. A `LineRuns` can be kept
for later batches, as long as their ids are larger.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import attach, pieces, stored, text_of
from tidemark.session import new_working_path

MIN_CHARS = 10
BATCHES = 4
_KEY = ["h", "h2"]
_LAST = (1 << 63) - 1
_BLANK_BYTES = b" \t\n\x0b\x0c\r"


def line_key(line: bytes) -> bytes:
    return line.strip(_BLANK_BYTES).lower()


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode("utf-8", "replace")) >= least)


def _key_rows(least: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            docs, counts, digests = batch.column(0).to_numpy(), [], []
            for text in batch.column(1).to_pylist():
                keys = {k for k in map(line_key, text.encode().split(b"\n")) if _long_enough(k, least)}
                counts.append(len(keys))
                digests.extend(map(xxhash.xxh3_128_digest, keys))
            halves = np.frombuffer(b"".join(digests), dtype="int64").reshape(-1, 2)
            columns = [np.repeat(docs, counts), np.ascontiguousarray(halves[:, 0]), np.ascontiguousarray(halves[:, 1])]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["doc", *_KEY])

    return rows


class LineRuns:
    """The runs of all batches so far. Files lie in the shared working folder; `close` forgets the tables."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self._made: list[str] = []

    def _written(self, keys: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        writer = keys.select(*_KEY, "first").write.bucketBy(self.buckets, *_KEY).sortBy(*_KEY)
        writer.option("path", new_working_path(self.spark, "line-run")).saveAsTable(name)
        self._made.append(name)
        return name

    def _add(self, name: str) -> None:
        for level in self.levels:
            if not level:
                level.append(name)
                return
            left, right = self.spark.table(level.pop()), self.spark.table(name)
            # The keys of two runs are disjoint.
            merged = left.join(right.withColumnRenamed("first", "_right").hint("merge"), _KEY, "full")
            name = self._written(merged.withColumn("first", F.coalesce("first", "_right")))
        self.levels.append([name])

    def add_batch(self, rows: DataFrame) -> DataFrame:
        """(doc, h) of the lines to drop from a batch of (doc, h, h2); its new keys become a run."""
        keys = rows.groupBy(*_KEY).agg(F.min("doc").alias("_first"), F.count(F.lit(1)).alias("n"))
        firsts: list[Column] = []
        for i, name in enumerate(run for level in self.levels for run in level):
            run = self.spark.table(name).withColumnRenamed("first", f"_run{i}")
            keys = keys.join(run.hint("merge"), _KEY, "left")
            firsts.append(F.col(f"_run{i}"))
        earlier = F.coalesce(*firsts, F.lit(None).cast("long"))
        keys = stored(keys.select(*_KEY, "n", "_first", earlier.alias("_earlier")), "batch-keys")
        repeated = keys.where((F.col("n") > 1) | F.col("_earlier").isNotNull())
        repeated = repeated.select(F.struct(*_KEY).alias("key"), "n", F.coalesce("_earlier", "_first").alias("first"))
        keyed = rows.select("doc", F.struct(*_KEY).alias("key"))
        dropped = attach(keyed, repeated, "key", "n", rows.count()).where(F.col("first") < F.col("doc"))
        dropped = stored(dropped.select("doc", F.col("key.h").alias("h")), "dropped-lines")
        fresh = keys.where(F.col("_earlier").isNull()).withColumnRenamed("_first", "first")
        self._add(self._written(fresh.repartition(self.buckets, *_KEY)))
        return dropped

    def close(self) -> None:
        for name in self._made:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def _document(id: str) -> Column:
    return F.coalesce(F.col(id), F.lit(_LAST))


def repeated_lines(docs: DataFrame, id: str, text: str, least: int = MIN_CHARS, batches: int = BATCHES) -> DataFrame:
    """(doc, h): the keys each document loses, by 64 bits of their hash; a null id is the last document."""
    spark = docs.sparkSession
    edges = docs.select(F.percentile_approx(_document(id), [i / batches for i in range(1, batches)])).first()[0]
    edges = sorted(set(edges or []))
    schema = "doc long, h long, h2 long"
    rows = docs.select(_document(id).alias("doc"), text_of(text).alias("text")).mapInArrow(_key_rows(least), schema)
    number = reduce(lambda n, e: n + (F.col("doc") >= F.lit(e)).cast("int"), edges, F.lit(0))
    path = new_working_path(spark, "line-keys")
    rows.withColumn("batch", number).write.partitionBy("batch").parquet(path)
    everything = spark.read.schema(schema + ", batch int").parquet(path)
    runs, dropped = LineRuns(spark), []
    for b in range(len(edges) + 1):
        dropped.append(runs.add_batch(everything.where(F.col("batch") == b).drop("batch")))
    runs.close()
    return reduce(DataFrame.unionByName, dropped)


def _without(texts: pd.Series, lost: pd.Series) -> pd.DataFrame:
    out = []
    for text, hashes in zip(texts, lost):
        lines = text.encode().split(b"\n")
        kept = lines
        if hashes is not None and len(hashes):
            gone = set(hashes.tolist())
            heads = [int.from_bytes(xxhash.xxh3_128_digest(line_key(x))[:8], "little", signed=True) for x in lines]
            kept = [x for x, h in zip(lines, heads) if h not in gone]
        out.append((b"\n".join(kept).decode(), len(lines), len(lines) - len(kept)))
    return pd.DataFrame(out, columns=["text", "n_lines", "n_dropped"])


def drop_repeated_lines(
    docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = MIN_CHARS, batches: int = BATCHES
) -> DataFrame:
    """All rows and columns of `docs`, the text without repeated lines, with n_lines (before) and n_dropped.

    Lines are what stands between \\n. A line's key is the line without white space at both ends, A-Z in lower
    case. Keys of at least `least` code points that several documents hold stay only in the document with the
    smallest id (there, all their lines). A null or empty text is one empty line. Rows with one id are one
    document; a null id comes last. Columns named n_lines or n_dropped are replaced. An empty table gives none.
    """
    lost = repeated_lines(docs, id, text, least, batches).groupBy("doc").agg(F.collect_list("h").alias("_lost"))
    lost = lost.withColumnRenamed("doc", "_lost_doc")
    plain = docs.select(*[c for c in docs.columns if c not in ("n_lines", "n_dropped")])
    keyed = plain.withColumn("_doc", _document(id))
    joined = keyed.join(lost, F.col("_doc") == F.col("_lost_doc"), "left")
    without = F.pandas_udf(_without, "text string, n_lines long, n_dropped long")
    done = joined.withColumn("_done", without(text_of(text), F.col("_lost")))
    columns = [F.col("_done.text").alias(c) if c == text else F.col(c) for c in plain.columns]
    return done.select(*columns, "_done.n_lines", "_done.n_dropped")

"""Distance between a reference period and each later window, feature by feature.

All windows are measured in one pass, so the reference is neither copied per window nor broadcast. For numeric features
the rows are merged to sparse counts per (feature, value, window); the value axis is cut into bins, the counts of a bin
are sorted by value, and a sweep along them keeps one running count per window. A bin begins with the counts of all
earlier bins, which come from the small table of bin totals, so bins are swept independently and as streams: a task holds
one batch of rows and the running counts.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import ratio
from tidemark.operators.ordered import bin_of, quantile_cuts
from tidemark.session import stored

# Fixed values of the monitoring rules.
DRIFT_AT = 0.1
DATASET_DRIFT_SHARE = 0.3
RETRAIN_RECALL_DROP = 0.05
MIN_ROWS = 1000
MIN_POSITIVES = 5
SMALLEST_SCALE = 0.001


def inject_drift(df: DataFrame, time: str, since: str, factor: float, amount: str = "amt") -> DataFrame:
    """What if amounts were `factor` times larger from a date on? The ratio to the past mean stays."""
    hit = F.col(time) >= F.lit(since).cast("timestamp_ntz")
    scaled = F.when(hit, F.col(amount) * factor).otherwise(F.col(amount))
    out = {amount: scaled}
    if "log_amt" in df.columns:
        out["log_amt"] = F.when(hit, F.log1p(F.col(amount) * factor)).otherwise(F.col("log_amt"))
    for name in ("card_amt_sum_1h", "card_amt_sum_24h"):
        if name in df.columns:
            out[name] = F.when(hit, F.col(name) * factor).otherwise(F.col(name))
    return df.withColumns(out)


def numeric_drift(
    df: DataFrame, window: str, windows: Sequence[str], features: Sequence[str],
    cuts: Mapping[str, Sequence[float]] | None = None,
) -> DataFrame:
    """Wasserstein distance to the reference, divided by the reference's deviation.

    Rows whose `window` is null are the reference. Returns (window, feature, distance).
    """
    doubles = df.select(window, *(F.col(f).cast("double").alias(f) for f in features))
    cuts = quantile_cuts(doubles, features) if cuts is None else cuts
    for f in features:
        doubles = bin_of(doubles, f, cuts[f], f"_bin_{f}", invalid="keep")
    pairs = F.array(
        *(F.struct(F.lit(i).alias("feature"), F.col(f).alias("value"), F.col(f"_bin_{f}").alias("_bin")) for i, f in enumerate(features))
    )
    long = doubles.select(window, F.inline(pairs)).where(F.col("value").isNotNull())

    # The reference is number 0, windows follow in the order given.
    number = F.when(F.col(window).isNull(), 0).otherwise(F.array_position(F.array(*map(F.lit, windows)), F.col(window)))
    numbered = long.select("feature", "value", "_bin", number.cast("int").alias("at"))
    counts = numbered.groupBy("feature", "_bin", "value", "at").agg(F.count(F.lit(1)).alias("n"))
    areas = _swept(stored(counts, "sparse-counts"), len(windows))
    scale_rows = F.array(
        *(F.struct(F.lit(i).alias("_feature"), F.lit(f).alias("_name"), F.col(f"_std_{f}").alias("_std")) for i, f in enumerate(features))
    )
    scale = (
        df.where(F.col(window).isNull())
        .agg(*(F.stddev_pop(F.col(f).cast("double")).alias(f"_std_{f}") for f in features))
        .select(F.inline(scale_rows))
    )
    name = F.element_at(F.array(*map(F.lit, windows)), F.col("at"))
    return areas.join(F.broadcast(scale), F.col("feature") == F.col("_feature")).select(
        name.alias("window"), F.col("_name").alias("feature"), (F.col("area") / F.greatest("_std", F.lit(SMALLEST_SCALE))).alias("distance")
    )


def _swept(counts: DataFrame, windows: int) -> DataFrame:
    """(feature, at, area): area between the cumulative shares of the reference and of each window, 1 to `windows`.

    Null where either has no rows. `counts` is (feature, _bin, value, at, n), unique but for n.
    """
    totals = counts.groupBy("feature", "_bin", "at").agg(F.sum("n").alias("n"), F.min("value").alias("first"))
    # One group has a row per bin and window of a feature.
    opened = totals.groupBy("feature").applyInPandas(_opened(windows), _OPENED)
    # Flat columns only: a batch with columns of lists, even null ones, takes several times as long to hand over.
    rows = counts.select("feature", "_bin", F.lit(1).alias("kind"), "value", "at", "n", F.lit(None).cast("long").alias("total"))
    tasks = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = opened.unionByName(rows).repartition(tasks, "feature", "_bin").sortWithinPartitions("feature", "_bin", "kind", "value")
    parts = dealt.mapInArrow(_sweep(windows), "feature int, at int, area double")
    return parts.groupBy("feature", "at").agg(F.sum("area").alias("area"))


_OPENED = "feature int, _bin int, kind int, value double, at int, n long, total long"


def _opened(windows: int):
    """First rows of every bin, one per window: its counts before the bin and in all bins, and the following bin's first value."""

    def opened(totals: pd.DataFrame) -> pd.DataFrame:
        bins, place = np.unique(totals["_bin"].to_numpy(), return_inverse=True)
        n = np.zeros((len(bins), windows + 1), dtype="int64")
        n[place, totals["at"].to_numpy()] = totals["n"].to_numpy()
        first = np.full(len(bins), np.inf)
        np.minimum.at(first, place, totals["first"].to_numpy())
        following = np.append(first[1:], np.nan)
        size = windows + 1
        return pd.DataFrame(
            {
                "feature": totals["feature"].iloc[0],
                "_bin": np.repeat(bins, size),
                "kind": 0,
                "value": np.repeat(following, size),
                "at": np.tile(np.arange(size), len(bins)),
                "n": (n.cumsum(axis=0) - n).ravel(),
                "total": np.tile(n.sum(axis=0), len(bins)),
            }
        )

    return opened


def _sweep(windows: int):
    """Areas of each bin in a stream sorted by (feature, bin, kind, value); rows of kind 0 open a bin."""

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bin_ = None
        for batch in batches:
            names = ("feature", "kind", "value", "at", "n")
            feature, kind, value, at, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in names)
            edges = (np.flatnonzero(kind[1:] != kind[:-1]) + 1).tolist()
            for start, stop in zip([0, *edges], [*edges, len(kind)]):
                if start == stop:
                    continue
                if kind[start]:
                    bin_.add(value[start:stop], at[start:stop], n[start:stop])
                    continue
                if bin_ is None or bin_.value is not None:
                    if bin_ is not None:
                        yield bin_.closed()
                    bin_ = _Bin(feature[start], value[start], windows)
                total = batch.column("total").slice(start, stop - start).to_numpy()
                bin_.count[at[start:stop]], bin_.total[at[start:stop]] = n[start:stop], total
        if bin_ is not None:
            yield bin_.closed()

    return sweep


class _Bin:
    """Running counts of all windows along the values of one bin, and the areas so far."""

    def __init__(self, feature: int, following: float, windows: int):
        self.feature, self.following, self.value = feature, following, None
        self.count, self.total = np.zeros(windows + 1, dtype="int64"), np.zeros(windows + 1, dtype="int64")
        self.area = np.zeros(windows)

    def _shares(self, counts: np.ndarray) -> np.ndarray:
        with np.errstate(all="ignore"):
            return counts / self.total

    def _widen(self, value: float) -> None:
        """The counts so far hold from the last value up to this one."""
        share = self._shares(self.count)
        self.area += np.abs(share[0] - share[1:]) * (value - self.value)

    def add(self, value: np.ndarray, at: np.ndarray, n: np.ndarray) -> None:
        if not len(value):
            return
        if self.value is not None:
            self._widen(value[0])
        last = np.flatnonzero(np.append(value[1:] != value[:-1], True))
        step = np.zeros((len(value), len(self.total)), dtype="int64")
        step[np.arange(len(value)), at] = n
        counts = self.count + step.cumsum(axis=0)[last]
        share = self._shares(counts[:-1])
        self.area += (np.abs(share[:, :1] - share[:, 1:]) * np.diff(value[last])[:, None]).sum(axis=0)
        self.count, self.value = counts[-1], value[-1]

    def closed(self) -> pa.RecordBatch:
        if not np.isnan(self.following) and self.value is not None:
            self._widen(self.following)
        known = (self.total[1:] > 0) & (self.total[0] > 0)
        windows = np.arange(1, len(self.total), dtype="int32")
        return pa.RecordBatch.from_pydict(
            {
                "feature": pa.array([self.feature] * len(windows), pa.int32()),
                "at": pa.array(windows),
                "area": pa.array(np.where(known, self.area, 0.0), mask=~known),
            }
        )


def categorical_drift(df: DataFrame, window: str, windows: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Jensen-Shannon distance (natural logarithm) between category shares; (window, feature, distance)."""
    pairs = F.array(
        *(F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("value")) for f in features)
    )
    counters = [F.count_if(F.col(window).isNull()).alias("ref")]
    counters += [F.count_if(F.col(window) == w).alias(f"w{i}") for i, w in enumerate(windows)]
    counts = df.select(window, F.inline(pairs)).where(F.col("value").isNotNull()).groupBy("feature", "value").agg(*counters)

    names = ["ref", *(f"w{i}" for i in range(len(windows)))]
    all_of = counts.groupBy(F.col("feature").alias("_feature")).agg(*(F.sum(n).alias(f"all_{n}") for n in names))
    shares = counts.join(all_of, F.col("feature") == F.col("_feature"))

    def divergence(i: int):
        p, q = ratio(F.col("ref"), F.col("all_ref")), ratio(F.col(f"w{i}"), F.col(f"all_w{i}"))
        middle = (p + q) / 2
        part_p = F.when(p > 0, p * F.ln(p / middle)).otherwise(F.when(p.isNotNull() & q.isNotNull(), F.lit(0.0)))
        part_q = F.when(q > 0, q * F.ln(q / middle)).otherwise(F.when(p.isNotNull() & q.isNotNull(), F.lit(0.0)))
        return F.sqrt(F.greatest(F.sum(part_p + part_q) / 2, F.lit(0.0)))

    labelled = F.array(
        *(F.struct(F.lit(w).alias("window"), F.col(f"_d{i}").alias("distance")) for i, w in enumerate(windows))
    )
    return (
        shares.groupBy("feature")
        .agg(*(divergence(i).alias(f"_d{i}") for i in range(len(windows))))
        .select("feature", F.inline(labelled))
        .select("window", "feature", "distance")
    )


def drift_share(distances: DataFrame, drift_at: float = DRIFT_AT) -> DataFrame:
    """Share and names of drifted features per window."""
    drifted = F.col("distance") >= drift_at
    return distances.groupBy("window").agg(
        F.avg(drifted.cast("double")).alias("drift_share"),
        F.array_sort(F.collect_list(F.when(drifted, F.col("feature")))).alias("drifted_features"),
    )

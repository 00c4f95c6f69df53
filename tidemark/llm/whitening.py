"""Whitening of embeddings by an incremental eigendecomposition.

Every partition of the distinct vectors keeps the eigenvalues and eigenvectors of its scatter matrix. A vector is a
centred rank-one update: the new eigenvalues are the roots of the secular equation between the old ones, after deflation
of directions that the update does not touch and of equal eigenvalues (which a reflection gathers in one direction). Spectra
of partitions are combined, a few at a time, by one rank-one update for each eigenpair of the other and one for the
distance of the means. The result is the basis of a Rayleigh-Ritz refinement over all vectors, repeated until the
projected covariance is diagonal.

A spectrum is a square matrix of the vectors' length; that, never rows, is what tasks hand on and what comes to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.vectors import longest, matrix, padded, task_count, whole

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
#: Vectors that a task adds one by one, at most about, and spectra that one task combines.
TASK_ROWS = 1 << 16
FAN_IN = 16
#: The projected covariance counts as diagonal when no other entry exceeds this share of the trace.
DIAGONAL = 1e-14
MOST_ROUNDS = 6
#: A component with less than this share of the trace is rounding, not a direction of the data.
LEAST_SHARE = 1e-10
_EPS = float(np.finfo("float64").eps)


def _solve_secular(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(z2 / (d - t)) = 0 for rising d: for each the number of its nearer pole and the distance from it.

    Root i lies between d[i] and d[i + 1], the last one within sum(z2) of the last d. Steps interpolate the sums of the
    poles on either side by one pole each; a step that leaves the bracket halves it instead.
    """
    k = len(d)
    total = z2.sum() * (1 + 64 * _EPS)
    above = np.append(d[1:], d[-1] + total)
    left_of = np.tri(k).T  # [pole, root]: pole <= root
    half = (above - d) / 2
    to_right = 1 + z2 @ (1 / ((d[:, None] - d) - half)) < 0
    to_right[-1] = False
    index = np.arange(k)
    origin = index + to_right
    low = np.where(to_right, -half, 0.0)
    high = np.where(to_right, 0.0, half)
    high[-1] = total
    apart = d[:, None] - d[origin]
    following = np.minimum(index + 1, k - 1)
    mu = (low + high) / 2
    for _ in range(80):
        over = 1 / (apart - mu)
        f = 1 + z2 @ over
        done = np.abs(f) <= 8 * _EPS * (1 + z2 @ np.abs(over))
        if done.all():
            break
        up = f > 0
        np.copyto(high, mu, where=up)
        np.copyto(low, mu, where=~up)
        np.square(over, out=over)
        slope = z2 @ over
        over *= left_of
        psi = z2 @ over
        here, next_one = (d - d[origin]) - mu, (d[following] - d[origin]) - mu
        c = f - here * psi - next_one * (slope - psi)
        a = (here + next_one) * f - here * next_one * slope
        b = here * next_one * f
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
        with np.errstate(all="ignore"):
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            # The last root has poles on one side only.
            step[-1] = here[-1] + here[-1] ** 2 * psi[-1] / (f[-1] - here[-1] * psi[-1])
            moved = mu + step
            inside = (moved > low) & (moved < high)
        moved = np.where(inside, moved, (low + high) / 2)
        if (done | (moved == mu)).all():
            break
        mu = np.where(done, mu, moved)
    return origin, mu


class Spectrum:
    """Count, mean, and eigenvalues (rising) and eigenvectors (columns) of the scatter matrix of some vectors."""

    def __init__(self, mean: np.ndarray, n: int = 0, values: np.ndarray | None = None, vectors: np.ndarray | None = None):
        size = len(mean)
        self.n, self.mean = n, mean
        self.values = np.zeros(size) if values is None else values
        self.vectors = np.eye(size) if vectors is None else vectors

    def add(self, x: np.ndarray) -> None:
        self.n += 1
        apart = x - self.mean
        self.mean = self.mean + apart / self.n
        if self.n > 1:
            self.update(apart * np.sqrt((self.n - 1) / self.n))

    def combine(self, other: Spectrum) -> None:
        if not other.n:
            return
        if not self.n:
            self.n, self.mean, self.values, self.vectors = other.n, other.mean, other.values, other.vectors
            return
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.update(np.sqrt(value) * vector)
        n = self.n + other.n
        apart = other.mean - self.mean
        self.update(apart * np.sqrt(self.n * (other.n / n)))
        self.mean = self.mean + apart * (other.n / n)
        self.n = n

    def update(self, v: np.ndarray) -> None:
        """The spectrum of the matrix plus v times v."""
        z = v @ self.vectors
        weight = z @ z
        if weight == 0:
            return
        values, vectors = self.values, self.vectors
        tolerance = 8 * _EPS * max(values[-1], weight)
        self._gather(z, tolerance)
        active = np.flatnonzero(np.abs(z) * np.sqrt(weight) > tolerance)
        if not len(active):
            return
        d, za = values[active], z[active]
        origin, mu = _solve_secular(d, za * za)
        # [pole, root]: distance of a root from a pole, from its nearer pole, so that nothing cancels.
        gaps = (d[origin] - d[:, None]) + mu
        k = len(d)
        if k > 1:
            # Weights for which these roots are exact (Gu and Eisenstat), so that the vectors stay orthogonal.
            poles = d - d[:, None]
            column = np.arange(k - 1) + (np.arange(k - 1) >= np.arange(k)[:, None])
            fitted = np.prod(gaps[:, :-1] / np.take_along_axis(poles, column, 1), axis=1) * gaps[:, -1]
            za = np.copysign(np.sqrt(np.abs(fitted)), za)
        turn = za[:, None] / -gaps
        turn /= np.sqrt((turn * turn).sum(axis=0))
        vectors[:, active] = vectors[:, active] @ turn
        values[active] = d[origin] + mu
        order = np.argsort(values, kind="stable")
        self.values, self.vectors = values[order], vectors[:, order]

    def _gather(self, z: np.ndarray, tolerance: float) -> None:
        """Within a run of equal eigenvalues a reflection moves all of z to the run's last vector."""
        equal = np.diff(self.values) <= tolerance
        if not equal.any():
            return
        edges = np.flatnonzero(np.diff(np.concatenate([[False], equal, [False]]).astype("int8")))
        for start, stop in zip(edges[::2], edges[1::2] + 1):
            part = z[start:stop]
            length = np.sqrt(part @ part)
            if length == 0:
                continue
            gathered = -np.copysign(length, part[-1])
            w = part.copy()
            w[-1] -= gathered
            block = self.vectors[:, start:stop]
            self.vectors[:, start:stop] = block - np.outer(block @ w, w) * (2 / (w @ w))
            z[start:stop] = 0
            z[stop - 1] = gathered


_SPECTRUM = "lane int, n long, mean array<double>, values array<double>, vectors array<double>"


def _as_row(lane: int, s: Spectrum) -> pd.DataFrame:
    return pd.DataFrame({"lane": [lane], "n": [s.n], "mean": [s.mean], "values": [s.values], "vectors": [s.vectors.ravel()]})


def _add_all(centre: np.ndarray):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lane, spectrum = 0, None
        for batch in batches:
            for x in (matrix(batch.column("x"), "int64") - centre).astype("float64"):
                spectrum = spectrum or Spectrum(np.zeros(len(centre)))
                spectrum.add(x)
            lane = batch.column("lane")[0].as_py() if batch.num_rows else lane
        if spectrum:
            s = spectrum
            yield pa.RecordBatch.from_pydict(
                {
                    "lane": pa.array([lane], pa.int32()),
                    "n": [s.n],
                    "mean": [s.mean],
                    "values": [s.values],
                    "vectors": [s.vectors.ravel()],
                }
            )

    return add


def _combine(part: pd.DataFrame) -> pd.DataFrame:
    whole_one = None
    for r in part.sort_values("lane").itertuples():
        size = len(r.mean)
        one = Spectrum(np.array(r.mean), int(r.n), np.array(r.values), np.array(r.vectors).reshape(size, size))
        if whole_one is None:
            whole_one = one
        else:
            whole_one.combine(one)
    return _as_row(int(part["lane"].min()) // FAN_IN, whole_one)


def _summed(fit: DataFrame, project, size: int) -> np.ndarray:
    """The sum over all vectors of the outer products of `project(x)`, made by tasks, of which each sends one matrix."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            y = project(matrix(batch.column("x"), "int64"))
            total += y.T @ y
        i, j = np.triu_indices(size)
        yield pa.RecordBatch.from_pydict({"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "v": total[i, j]})

    entries = fit.select("x").mapInArrow(products, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((size, size))
    for r in entries.collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"]
    return out


def _ritz(fit: DataFrame, start: np.ndarray, centred, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and eigenvectors of the covariance of all vectors, from a basis near them."""
    basis = np.linalg.qr(start)[0]
    for _ in range(MOST_ROUNDS):
        projected = _summed(fit, lambda x, b=basis: centred(x) @ b, len(basis)) / n
        beside = np.abs(projected - np.diag(np.diag(projected))).max(initial=0.0)
        if beside <= DIAGONAL * np.trace(projected):
            break
        basis = np.linalg.qr(basis @ np.linalg.eigh(projected)[1])[0]
    values = np.diag(projected)
    order = np.argsort(-values, kind="stable")
    return values[order], basis[:, order]


def whiten(
    table: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
    offset: int = OFFSET,
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): one row per vector and component.

    Components c become the integers x = floor(scale * c) + offset. Mean and covariance V are those of the distinct x
    vectors; `n` is their number. Component i is the unit eigenvector of V with the i-th largest eigenvalue, either sign;
    `whitened` is x minus the mean along it over the root of the eigenvalue, `explained` the eigenvalue over V's trace.
    `deviation` is the exact sum of (n * x - S)**2 over the entries, S the sums of the distinct vectors; null where it does not
    fit in a long. `identity_error` is the largest absolute entry of the whitened distinct vectors' covariance minus the identity.

    Rows whose vector is null or holds null or non-finite entries are left out. Shorter vectors count as ended in zeros.
    Repeated rows and null ids keep their rows. Components without variance (fewer distinct vectors than entries, equal
    entries) are not returned; where there is no variance at all, and for an empty table, the result is empty. Entries of 2**51 and more are
    refused with an error. Other columns are ignored.
    """
    spark = table.sparkSession
    rows = table.select(F.col(id).alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).where(whole(F.col("v")))
    length = longest(rows, "v")
    x = F.transform(padded(F.col("v"), length, F.lit(0.0)), lambda c: F.floor(c * scale) + F.lit(offset).cast("long"))
    named = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}"
    schema = f"{named}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    largest = F.aggregate("v", F.lit(0.0), lambda top, c: F.greatest(top, F.abs(c)))
    if (rows.agg(F.max(largest)).first()[0] or 0) * scale + abs(offset) >= 1 << 51:
        raise ValueError("entries may reach 2**51: use a smaller scale")
    rows = stored(rows.select("vec_id", x.alias("x")), "integer-rows")
    fit = stored(rows.groupBy("x").agg(F.lit(1).alias("one")).select("x"), "fit-list")
    n = fit.count()
    if not n or not length:
        return spark.createDataFrame([], schema)
    # Sums without overflow; one row per entry of a vector.
    sums = fit.select(F.posexplode("x")).groupBy("pos").agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("s")).collect()
    sums = [int(r["s"]) for r in sorted(sums, key=lambda r: r["pos"])]
    centre = np.array([s // n for s in sums], dtype="int64")
    rest = [s - n * int(c) for s, c in zip(sums, centre)]
    fraction = np.array([r / n for r in rest])

    def centred(x: np.ndarray) -> np.ndarray:
        return (x - centre) - fraction

    tasks = max(task_count(fit), -(-n // TASK_ROWS))
    # By the vector itself, so that partitions are about equal and a repeated task gets the same rows.
    dealt = fit.repartition(tasks, "x").withColumn("lane", F.spark_partition_id())
    spectra = stored(dealt.mapInArrow(_add_all(centre), _SPECTRUM), "spectra")
    while tasks > 1:
        group = F.expr(f"lane div {FAN_IN}")
        spectra = stored(spectra.withColumn("to", group).groupBy("to").applyInPandas(lambda part: _combine(part.drop(columns="to")), _SPECTRUM), "spectra")
        tasks = -(-tasks // FAN_IN)
    start = np.array(spectra.first()["vectors"]).reshape(length, length)
    values, basis = _ritz(fit, start, centred, n)

    trace = values.sum()
    many = int(np.count_nonzero(values[:components] > LEAST_SHARE * trace))
    if not many:
        return spark.createDataFrame([], schema)
    onto = basis[:, :many] / np.sqrt(values[:many])
    # A column of ones beside the whitened entries yields their means in the same pass.
    whitened = _summed(fit, lambda x: np.hstack([centred(x) @ onto, np.ones((len(x), 1))]), many + 1) / n
    means = whitened[:-1, -1]
    error = float(np.abs(whitened[:-1, :-1] - np.outer(means, means) - np.eye(many)).max())
    explained = values[:many] / trace
    exact = _deviations(centre, rest, n)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"), "int64")
            at = np.repeat(np.arange(len(x)), many)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(at)),
                    pa.array(np.tile(np.arange(1, many + 1, dtype="int32"), len(x))),
                    pa.array(np.full(len(at), n, dtype="int64")),
                    pa.array(exact(x), pa.int64()).take(pa.array(at)),
                    pa.array((centred(x) @ onto).ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(at), error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(project, schema)


def _deviations(centre: np.ndarray, rest: list[int], n: int):
    """For rows x the sums of (n * x - S)**2, with S = n * centre + rest, as whole numbers; None beyond 63 bits."""

    def deviations(x: np.ndarray) -> list[int | None]:
        apart = x - centre
        most = n * (int(np.abs(apart).max(initial=0)) + 1)
        if most * most * max(1, len(centre)) < 1 << 63:
            away = n * apart - np.array(rest, dtype="int64")
            return (away * away).sum(axis=1).tolist()
        sums = (sum((n * int(a) - r) ** 2 for a, r in zip(row, rest)) for row in apart.tolist())
        return [s if s < 1 << 63 else None for s in sums]

    return deviations

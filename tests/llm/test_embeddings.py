"""Hard negatives, whitening and lattice near-dedup against brute force, with odd rows."""

import math

import numpy as np
import pytest

from tidemark.llm import hard_negatives, lattice_dedup, vectors, whitening

NAN, INF = float("nan"), float("inf")
#: Rows that take no part, and extra columns named like the operators' own.
USELESS = [(900, None), (910, [NAN, 1.0, 1.0]), (920, [1.0, INF, 0.0]), (930, [None, 1.0, 1.0])]
EXTRA = "node int, n int, x int, cell int, side int, key int, code int, h int, lanes int, root int, v int"
CLASH = tuple(range(11))


def table(spark, rows, label=True, kind="double"):
    """Rows (id, vector[, label]) with clashing extra columns."""
    full = [(r[0], r[1], *((r[2],) if label else ()), *CLASH) for r in rows]
    names = f"vec_id long, embedding array<{kind}>, {'label int, ' if label else ''}{EXTRA}"
    return spark.createDataFrame(full, names).repartition(3)


# --- hard negatives ---------------------------------------------------------------------------------------------------


def brute_negatives(rows, anchors, scale=256, k=5, low=80, high=100):
    use = [(i, v, y) for i, v, y in rows if y is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    size = max((len(v) for _, v, _ in use), default=0)
    use = [(i, [math.floor(scale * c) for c in v] + [0] * (size - len(v)), y) for i, v, y in use]

    def place(j, score):
        return -score, use[j][0] is None, use[j][0] or 0

    out = []
    for a, (i, x, y) in enumerate(use):
        if i is None or not anchors(i):
            continue
        score = {j: sum(p * q for p, q in zip(x, use[j][1])) for j in range(len(use)) if j != a}
        order = sorted(score, key=lambda j: place(j, score[j]))
        for p in [j for j in order if use[j][2] == y][:k]:
            fits = [j for j in order if use[j][2] != y and low * score[p] <= 100 * score[j] <= high * score[p]][:k]
            out += [(i, use[p][0], r, use[j][0], score[p], score[j]) for r, j in enumerate(fits, 1)]
    return sorted(out, key=repr)


def got_negatives(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_negatives(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "LEAST_ROWS", 64)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 8)
    monkeypatch.setattr(hard_negatives, "BLOCK", 32)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=5).round(2).tolist(), int(rng.integers(0, 3))) for i in range(300)]
    rows += [(i, [0.5, 0.5, 0.25], 1) for i in range(300, 360)]  # one vector, a hot label, shorter than the others
    rows += [(20, rows[20][1], rows[20][2]), (20, rows[20][1], rows[20][2]), (40, [1.0, 2.0], 0), (None, rows[7][1], 0), (None, rows[20][1], 1)]
    rows += [(i, v, 1) for i, v in USELESS] + [(940, [1.0, 1.0], None), (960, [], 2), (980, [0.0] * 5, 0)]
    got = got_negatives(hard_negatives.hard_negatives(table(spark, rows), lambda id: id % 20 == 0))
    assert got == brute_negatives(rows, lambda i: i % 20 == 0)
    assert len(got) > 300


def test_negatives_of_few_rows(spark):
    one = [(0, [1.0, 0.0], 1)]
    assert hard_negatives.hard_negatives(table(spark, one), lambda id: id % 20 == 0).count() == 0
    nothing = hard_negatives.hard_negatives(table(spark, one).limit(0), lambda id: id % 20 == 0)
    assert nothing.count() == 0 and nothing.columns[0] == "anchor_id"
    with pytest.raises(ValueError, match="scale"):
        hard_negatives.hard_negatives(table(spark, [(0, [1e9, 1.0], 1), (1, [1e9, 1.0], 1)]), lambda id: id % 20 == 0)


@pytest.mark.parametrize(("size", "most"), [(1, 3), (64, 300), (70, 4000), (200, 300_000)])
def test_products_are_exact(size, most):
    rng = np.random.default_rng(size)
    a, b = (rng.integers(-most, most + 1, size=(n, size)) for n in (7, 9))
    a[0], b[0], b[1] = most, most, -most
    primes = hard_negatives.moduli(size * most * most)
    assert math.prod(primes) > 2 * size * most * most
    got = hard_negatives.products(hard_negatives.residues(a, primes), hard_negatives.residues(b, primes), primes)
    assert (got == a @ b.T).all()


# --- whitening --------------------------------------------------------------------------------------------------------


def brute_whitening(rows, components=16):
    use = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    size = max(len(v) for _, v in use)
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in [*v, *[0.0] * (size - len(v))]] for _, v in use])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    apart = (fit * n - s) / n
    values, basis = np.linalg.eigh(apart.T @ apart / n)
    values, basis = values[::-1][:components], basis[:, ::-1][:, :components]
    return [i for i, _ in use], n, ((x * n - s) ** 2).sum(axis=1), (x * n - s) / n @ basis / np.sqrt(values), values / np.trace(apart.T @ apart / n)


def check_whitening(spark, rows, components=16):
    ids, n, deviations, white, shares = brute_whitening(rows, components)
    got = whitening.whiten(table(spark, rows, label=False), components=components).toPandas()
    many = min(components, white.shape[1])
    assert len(got) == len(ids) * many and sorted(set(got["component"])) == list(range(1, many + 1))
    assert (got["n"] == n).all() and got["identity_error"].nunique() == 1 and got["identity_error"][0] < 1e-9
    for c in range(many):
        part = got[got["component"] == c + 1]
        assert np.allclose(part["explained"], shares[c], rtol=1e-9)
        have = sorted(zip(part["deviation"].tolist(), np.abs(part["whitened"]).round(7).tolist()))
        assert [d for d, _ in have] == sorted(deviations.tolist())
        want = sorted(zip(deviations.tolist(), np.abs(white[:, c]).round(7).tolist()))
        assert np.allclose([w for _, w in have], [w for _, w in want], atol=1e-6)
        # One sign for all rows.
        told = part.dropna(subset=["vec_id"]).drop_duplicates("vec_id").set_index("vec_id")["whitened"]
        known = {i: w for i, w in reversed(list(zip(ids, white[:, c]))) if i is not None}
        signs = {np.sign(told[i] * known[i]) for i in told.index if abs(known[i]) > 1e-3 and ids.count(i) == 1}
        assert len(signs) == 1


def test_whitening(spark):
    rng = np.random.default_rng(1)
    spread = np.linspace(2, 0.3, 20)
    rows = [(i, (rng.normal(size=20) * spread).tolist()) for i in range(400)]
    rows += [(i, rows[5][1]) for i in range(400, 500)] + [(7, rows[7][1]), (None, rows[9][1]), (None, [1.0, 2.0])] + USELESS
    check_whitening(spark, rows)
    check_whitening(spark, [(i, v[:3]) for i, v in rows if v], components=2)


def test_whitening_of_few_rows(spark):
    flat = [(i, [1.0, 2.0]) for i in range(5)]
    assert whitening.whiten(table(spark, flat, label=False)).count() == 0
    assert whitening.whiten(table(spark, flat, label=False).limit(0)).count() == 0
    assert whitening.whiten(table(spark, USELESS, label=False)).count() == 0
    line = [(i, [float(i), 2.0 * i, 5.0]) for i in range(6)]
    got = whitening.whiten(table(spark, line, label=False)).collect()
    assert {r.component for r in got} == {1} and len(got) == 6
    assert all(abs(abs(r.whitened) - abs(r.vec_id - 2.5) / np.sqrt(35 / 12)) < 1e-9 and abs(r.explained - 1) < 1e-9 for r in got)


def test_large_deviations_are_exact(spark):
    rows = [(0, [0.0]), (1, [2.0**40]), (2, [2.0**39]), (3, [1.0])]
    got = {r.vec_id: r.deviation for r in whitening.whiten(table(spark, rows, label=False)).collect()}
    x = [math.floor(64 * v[0]) + 1_000_000 for _, v in rows]
    want = {i: (4 * x[i] - sum(x)) ** 2 for i, _ in rows}
    assert got == {i: w if w < 1 << 63 else None for i, w in want.items()}


@pytest.mark.parametrize("kind", ["plain", "ties", "low rank", "unequal"])
def test_spectra(kind):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(150, 12))
    if kind == "ties":
        x = rng.integers(0, 2, size=(150, 12)).astype(float)
    elif kind == "low rank":
        x = rng.normal(size=(150, 3)) @ rng.normal(size=(3, 12))
    elif kind == "unequal":
        x *= 10.0 ** -np.arange(12)
    parts = []
    for some in np.array_split(x, 3):
        parts.append(whitening.Spectrum(np.zeros(12)))
        for row in some:
            parts[-1].add(row)
    total = parts[0]
    for other in parts[1:]:
        total.combine(other)
    scatter = (x - x.mean(axis=0)).T @ (x - x.mean(axis=0))
    top = np.linalg.eigvalsh(scatter)[-1]
    assert np.abs(total.vectors * total.values @ total.vectors.T - scatter).max() < 1e-12 * top
    assert np.abs(total.vectors.T @ total.vectors - np.eye(12)).max() < 1e-12
    assert (np.diff(total.values) >= 0).all() and total.n == 150


# --- lattice near-dedup -----------------------------------------------------------------------------------------------


def brute_links(rows, least=0.95):
    size = max((len(v) for _, v in rows if v), default=0)

    def unit(v):
        if v is None or not all(c is not None and math.isfinite(c) for c in v) or not any(v):
            return np.full(size, NAN)
        x = np.array([*v, *[0.0] * (size - len(v))])
        return x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max())

    x = np.array([unit(v) for _, v in rows]).reshape(len(rows), size)
    linked = np.nan_to_num(x @ x.T) >= least
    np.fill_diagonal(linked, False)
    root = list(range(len(rows)))
    for i, j in np.argwhere(linked):
        a, b = root[i], root[j]
        root = [min(a, b) if r in (a, b) else r for r in root]
    out = []
    for i, (name, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None]
        first = min(ids) if ids else None
        out.append((name, int(linked[i].sum()), first, name == first))
    return sorted(out, key=repr)


def got_links(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def near_rows(rng, size=12):
    base = rng.normal(size=(60, size))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    n = 100
    for family, copies in ((3, 150), (7, 12), (11, 5)):  # a family of a third of all rows
        for _ in range(copies):
            rows.append((n, (base[family] + 0.06 * rng.normal(size=size)).tolist()))
            n += 1
    rows += [(n + i, (3.0 * base[20]).tolist()) for i in range(40)]  # one vector, other lengths than its neighbour's
    return rows + [(5, base[5].tolist()), (None, base[3].tolist()), (None, base[59].tolist()), (None, [1.0]), (400, [0.0] * size), (410, [])]


def test_links(spark, monkeypatch):
    monkeypatch.setattr(lattice_dedup, "RESIDENTS", 16)
    monkeypatch.setattr(lattice_dedup, "VISITORS", 32)
    monkeypatch.setattr(lattice_dedup, "PIECE", 50)
    rows = near_rows(np.random.default_rng(2)) + USELESS
    got = lattice_dedup.near_duplicates(table(spark, rows, label=False), recall=1 - 1e-9)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert got_links(got) == brute_links(rows)


def test_links_by_text_ids(spark):
    rows = [(f"v{i}" if i is not None else None, v) for i, v in near_rows(np.random.default_rng(6))]
    df = spark.createDataFrame(rows, "vec_id string, embedding array<double>")
    assert got_links(lattice_dedup.near_duplicates(df, recall=1 - 1e-9)) == brute_links(rows)


def test_no_links(spark):
    assert lattice_dedup.near_duplicates(table(spark, USELESS, label=False).limit(0)).count() == 0
    got = got_links(lattice_dedup.near_duplicates(table(spark, USELESS, label=False)))
    assert got == [(i, 0, i, True) for i, _ in USELESS]
    assert got_links(lattice_dedup.near_duplicates(table(spark, [(4, [1.0, 2.0])], label=False, kind="float"))) == [(4, 0, 4, True)]


@pytest.mark.parametrize(("size", "rows"), [(64, 3000), (256, 3000)])
def test_recall_at_the_bound(spark, size, rows):
    """Pairs whose cosine lies just above 0.95 among unrelated vectors."""
    rng = np.random.default_rng(size)
    x = rng.normal(size=(rows, size))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.normal(size=x.shape)
    side -= (side * x).sum(axis=1, keepdims=True) * x
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    cosine = 0.9501
    both = np.vstack([x, cosine * x + np.sqrt(1 - cosine**2) * side])
    df = spark.createDataFrame([(i, v) for i, v in enumerate(both.tolist())], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in lattice_dedup.near_duplicates(df).collect()}
    found = sum(got[i + rows].component_id == i for i in range(rows)) / rows
    assert found >= 0.99 and all(r.n_links <= 1 for r in got.values())


def test_lattice_points_are_nearest():
    rng = np.random.default_rng(9)
    y = rng.uniform(-3, 3, size=(300, 8))
    point = lattice_dedup.decode(y)
    whole_one = np.isclose(point, np.rint(point)).all(axis=1)
    half = np.isclose(point - 0.5, np.rint(point - 0.5)).all(axis=1)
    assert (whole_one | half).all() and np.allclose(point.sum(axis=1) % 2, 0)
    far = np.square(y - point).sum(axis=1)
    beside = np.square(y[:, None] - point[:, None] - lattice_dedup.roots() / 2).sum(axis=2)
    assert (far <= beside.min(axis=1) + 1e-12).all() and far.max() <= 1 + 1e-12


def test_components(spark):
    rng = np.random.default_rng(12)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, size=(200, 2))]
    edges += [(1000, 1001 + i) for i in range(200)] + [(2000 + i, 2001 + i) for i in range(60)] + [(5, 5)]
    root = list(range(3000))
    for a, b in edges:
        x, y = root[a], root[b]
        root = [min(x, y) if r in (x, y) else r for r in root]
    want = {n: root[n] for e in edges if e[0] != e[1] for n in e}
    got = vectors.components(spark.createDataFrame(edges, "u long, v long"))
    assert {r.node: r.root for r in got.collect()} == want
    assert vectors.components(spark.createDataFrame([(3, 3)], "u long, v long")).count() == 0

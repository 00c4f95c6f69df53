import numpy as np
import pytest

from tidemark.llm import permutation_index


def brute(vectors, queries, k=20):
    ids = sorted(vectors)
    x = np.array([vectors[i] for i in ids], dtype="float64")
    out = {}
    for q in queries:
        score = x @ np.array(vectors[q], dtype="float64")
        out[q] = [i for _, i in sorted((-s, i) for s, i in zip(score.tolist(), ids) if i != q)][:k]
    return out


def test_recall_and_order(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    vectors = {r.vec_id: r.embedding for r in table.collect()}
    want = brute(vectors, [i for i in vectors if i % 20 == 0])
    rows = permutation_index.nearest_neighbours(table, lambda id: id % 20 == 0).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(got.setdefault(r.query_id, [])) + 1
        got[r.query_id].append(r.vec_id)
        assert abs(r.score - float(np.dot(np.array(vectors[r.query_id], float), np.array(vectors[r.vec_id], float)))) < 1e-12
    assert got.keys() == want.keys()
    assert np.mean([len(set(got[q]) & set(want[q])) / 20 for q in want]) >= 0.9


@pytest.mark.parametrize(("rows", "spread", "far"), [(2000, 0.5, 1), (9000, 0.0, 1), (9000, 0.5, 1), (9000, 0.0, 1000)])
def test_recall_of_unequal_lengths(spark, monkeypatch, rows, spread, far):
    """Blocks of which 15 % are compared, and no more; with `far`, three vectors are that many times longer."""
    monkeypatch.setattr(permutation_index, "LEAST_COMPARED", 0)
    monkeypatch.setattr(permutation_index, "BLOCK_ROWS", 4096)
    rng = np.random.default_rng(rows)
    x = rng.normal(size=(rows, 64))
    x *= np.exp(spread * rng.normal(size=(rows, 1))) / np.linalg.norm(x, axis=1, keepdims=True)
    x[[11, 12, 13]] *= far
    vectors = dict(enumerate(x.tolist()))
    want = brute(vectors, range(0, rows, 50))
    table = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    got = {}
    for r in permutation_index.nearest_neighbours(table, lambda id: id % 50 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    recall = np.mean([len(got[q] & set(want[q])) / 20 for q in want])
    print("recall", rows, spread, far, round(float(recall), 3))
    assert recall >= 0.9


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 7), 1.0, float(i % 3)]) for i in range(1, 90)]
    rows += [(i, [2.0, 1.0, 2.0]) for i in range(200, 300)]  # one vector, many ids
    rows += [(20, [6.0, 1.0, 2.0]), (1, [1.0, 1.0, 1.0]), (None, [1.0, 1.0, 1.0])]
    rows += [(400, None), (420, [0.0, 0.0, 0.0]), (440, [nan, 1.0, 1.0]), (460, [inf, 1.0, 1.0]), (480, [None, 1.0, 1.0]), (500, [1.0, 2.0])]
    table = spark.createDataFrame([(i, v, 3, 4) for i, v in rows], "vec_id long, embedding array<float>, x int, ids int")
    plain = {i: v for i, v in rows[:189]}
    want = brute(plain, [i for i in plain if i % 20 == 0])
    got = {}
    for r in permutation_index.nearest_neighbours(table, lambda id: id % 20 == 0, share=1.0).collect():
        got.setdefault(r.query_id, {})[r.rank] = r.vec_id
    assert {q: [v for _, v in sorted(found.items())] for q, found in got.items()} == want


def test_few_and_no_candidates(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0]), (3, [0.5, 0.5])], "vec_id long, embedding array<float>")
    rows = permutation_index.nearest_neighbours(table, lambda id: id % 20 == 0).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in rows] == [(0, 1, 3, 0.5)]
    assert permutation_index.nearest_neighbours(table.limit(0), lambda id: id % 20 == 0).count() == 0

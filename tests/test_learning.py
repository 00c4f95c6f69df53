import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.operators import nearest as module
from tidemark.operators.nearest import nearest
from tidemark.operators.ranking import evaluate
from tidemark.operators.resampling import remove_tomek_links, smote, tomek_links
from tidemark.operators.sampling import sample_fraction, sample_rows, undersample
from tidemark.plans.registry import VERSION_SCHEMA, champion, load_champion, not_yet_evaluated, promote, promotion_history
from tidemark.plans import training
from tidemark.plans.training import (
    SEARCH_SPACE,
    compare,
    dealt,
    draw_params,
    fit_model,
    importances,
    random_search,
    resampled,
    train_final,
    with_score,
    without_groups,
)
from tidemark.plans.trials import side_by_side
from tidemark.schemas import NUMERIC_FEATURES

SMALL = {"n_estimators": 3, "max_depth": 3}


@pytest.fixture(scope="module")
def matrix(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, len(NUMERIC_FEATURES)))
    y = (rng.random(600) < 0.05 + 0.3 * (x[:, 0] > 1.5)).astype(int)
    rows = [(i, *map(float, v), ["home", "travel"][i % 2], int(t)) for i, (v, t) in enumerate(zip(x, y))]
    fields = ", ".join(f"{f} double" for f in NUMERIC_FEATURES)
    return spark.createDataFrame(rows, f"trans_num long, {fields}, category string, is_fraud int").cache()


def vectors(spark, n, dims, seed, classes=2):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, dims)) * 10)
    y = rng.integers(0, classes, n)
    df = spark.createDataFrame([(i, [float(v) for v in p], int(t)) for i, (p, t) in enumerate(zip(x, y))], "id long, x array<double>, y int")
    return df, x, y


def slow_nearest(x, k):
    out = {}
    for i in range(len(x)):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        out[i] = [j for j in sorted(range(len(x)), key=lambda j: (d[j], j)) if j != i][:k]
    return out


@pytest.mark.parametrize("n,dims,k,block", [(150, 2, 3, 10), (120, 12, 1, 25), (40, 3, 50, 7), (30, 2, 2, 1000)])
def test_neighbours_are_exact(spark, n, dims, k, block):
    df, x, _ = vectors(spark, n, dims, 1)
    got = {}
    for r in sorted(nearest(df, "id", "x", k, block_rows=block).collect(), key=lambda r: (r["id"], r["rank"])):
        got.setdefault(r["id"], []).append(r["neighbour"])
    assert got == slow_nearest(x, k)


def test_neighbours_of_equal_points(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(30)], "id long, x array<double>")
    rows = nearest(df, "id", "x", 1, block_rows=5).collect()
    assert {(r["id"], r["neighbour"]) for r in rows} == {(i, 0 if i else 1) for i in range(30)}


def test_tomek_links(spark):
    df, x, y = vectors(spark, 80, 2, 3)
    near = {i: j[0] for i, j in slow_nearest(x, 1).items()}
    want = {(i, j) for i, j in near.items() if i < j and near[j] == i and y[i] != y[j]}
    assert {(r["a"], r["b"]) for r in tomek_links(df, "id", "x", "y", block_rows=9).collect()} == want and want
    left = {r["id"] for r in remove_tomek_links(df, "id", "x", "y", block_rows=9).collect()}
    assert left == set(range(80)) - {i for pair in want for i in pair}


def test_smote_reaches_the_ratio_between_neighbours(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(v) for v in rng.normal(size=3)], int(i < 12)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, x array<double>, y int")
    out = smote(df, 0.3, "id", "x", "y", block_rows=5).collect()
    assert sum(r["y"] for r in out) == int(188 * 0.3) and len(out) == 188 + int(188 * 0.3)
    minority = np.array([r[1] for r in rows[:12]])
    near = slow_nearest(minority, 5)
    for r in out:
        if r["id"] is None:
            p = np.array(r["x"])
            gaps = [np.linalg.norm(minority[i] - p) + np.linalg.norm(minority[j] - p) - np.linalg.norm(minority[i] - minority[j])
                    for i in near for j in near[i]]
            assert min(gaps) < 1e-9
    assert smote(df, 0.01, "id", "x", "y").count() == 200


def test_undersampling_is_exact_and_repeatable(spark, matrix):
    sizes = {r["is_fraud"]: r["count"] for r in matrix.groupBy("is_fraud").count().collect()}
    kept = undersample(matrix, 0.5, "trans_num")
    counts = {r["is_fraud"]: r["count"] for r in kept.groupBy("is_fraud").count().collect()}
    assert counts == {1: sizes[1], 0: int(sizes[1] / 0.5)}
    again = undersample(matrix.repartition(7), 0.5, "trans_num")
    assert kept.select("trans_num").exceptAll(again.select("trans_num")).count() == 0


@pytest.mark.parametrize("n", [0, 1, 57, 600, 10_000])
def test_sample_rows(spark, matrix, n):
    assert sample_rows(matrix, "trans_num", n).select("trans_num").distinct().count() == min(n, 600)


def test_sample_fraction(spark):
    assert sample_fraction(spark.range(100_000), "id", 0.2).count() == pytest.approx(20_000, rel=0.05)


def test_resampling_by_text_ids(spark):
    """Ids with leading zeros, as the raw feed has them; synthetic rows named after their start."""
    rng = np.random.default_rng(5)
    rows = [(f"{i:04d}", [float(v) for v in rng.normal(size=3)], int(i < 15)) for i in range(120)]
    numbers = spark.createDataFrame([(int(i), x, y) for i, x, y in rows], "id long, x array<double>, y int")
    texts = spark.createDataFrame(rows, "id string, x array<double>, y int")
    want = {(f"{r['id']:04d}", f"{r['neighbour']:04d}", r["rank"]) for r in nearest(numbers, "id", "x", 2, block_rows=20).collect()}
    assert {(r["id"], r["neighbour"], r["rank"]) for r in nearest(texts, "id", "x", 2, block_rows=20).collect()} == want
    links = {(f"{r['a']:04d}", f"{r['b']:04d}") for r in tomek_links(numbers, "id", "x", "y", block_rows=20).collect()}
    assert {(r["a"], r["b"]) for r in tomek_links(texts, "id", "x", "y", block_rows=20).collect()} == links and links
    assert remove_tomek_links(texts, "id", "x", "y", block_rows=20).count() == 120 - len({i for pair in links for i in pair})
    more = smote(texts, 0.4, "id", "x", "y", block_rows=5, name=lambda source, copy: F.concat(source, F.lit("+"), copy.cast("string")))
    ids = [r["id"] for r in more.collect()]
    assert len(ids) == len(set(ids)) == 105 + 42 and sum("+" in i for i in ids) == 42 - 15


def test_fits_side_by_side(spark, matrix):
    """Runs at once give what each gives alone; inputs that runs share are prepared once; a failure ends all."""
    # Without row and column samples, which follow the order of files.
    whole = {**SMALL, "subsample": 1.0, "colsample": 1.0}
    runs = {
        "trees": {"name": "trees", "params": whole},
        "heavy": {"name": "trees", "params": whole, "class_weighting": False},
        "logreg": {"name": "logreg"},
        **without_groups({"first": NUMERIC_FEATURES[:3]}, model="logreg"),
        **resampled([[("undersample", 0.9)], [("smote", 0.5), ("tomek", None)]], model="logreg"),
    }
    table = compare(matrix, matrix, runs).collect()
    assert [r["run"] for r in table] == list(runs)
    for r in table:
        alone = evaluate(with_score(fit_model(matrix, **runs[r["run"]]), matrix)).first()
        assert r["pr_auc"] == pytest.approx(alone["pr_auc"]) and (r["tp"], r["fp"]) == (alone["tp"], alone["fp"])
        assert r["train_seconds"] > 0

    def broken():
        raise KeyError("broken")

    def endless():
        return spark.range(0, 1 << 50, numPartitions=2).where("id % 7 = 9").count()

    with pytest.raises(KeyError, match="broken"):
        side_by_side(spark, {"endless": endless, "broken": broken})
    assert side_by_side(spark, {}) == {}


def test_prior_in_closed_form(spark, matrix):
    """A constant score: every metric follows from the base rate."""
    rate = matrix.agg(F.avg("is_fraud")).first()[0]
    row = compare(matrix, matrix, {"prior": {"name": "prior"}}).first()
    assert row["pr_auc"] == pytest.approx(rate) and row["roc_auc"] == pytest.approx(0.5) and row["pr_auc_lift"] == pytest.approx(1)
    assert row["recall_at_1pct_fpr"] == 0 and (row["tp"], row["fp"]) == (0, 0)


def test_resampling_touches_training_rows_only(spark, matrix):
    def under(df):
        return undersample(df, 1.0, "trans_num")

    model = fit_model(matrix, "logreg", class_weighting=False, samplers=[under])
    assert with_score(model, matrix).count() == 600


def test_weighting_raises_scores(spark, matrix):
    plain = with_score(fit_model(matrix, "logreg", class_weighting=False), matrix).agg(F.avg("score")).first()[0]
    heavy = with_score(fit_model(matrix, "logreg"), matrix).agg(F.avg("score")).first()[0]
    assert heavy > plain + 0.1


def test_prior_predicts_the_base_rate_and_unknown_categories_are_zeros(spark, matrix):
    rate = matrix.agg(F.avg("is_fraud")).first()[0]
    model = fit_model(matrix, "prior")
    odd = matrix.withColumn("category", F.lit("never seen"))
    row = with_score(model, odd).agg(F.min("score"), F.max("score"), F.count("*")).first()
    assert row[0] == pytest.approx(rate) and row[1] == pytest.approx(rate) and row[2] == 600
    features = model.transform(odd).first()["features"].toArray()
    assert len(features) == 16 and list(features[-2:]) == [0, 0]


def test_search_final_fit_and_registry(spark, matrix, tmp_path):
    rng = np.random.default_rng(1)
    drawn = [draw_params(rng) for _ in range(50)]
    assert all(d["n_estimators"] % 50 == 0 and 100 <= d["n_estimators"] <= 600 and 0.01 <= d["learning_rate"] <= 0.3 for d in drawn)
    assert set(drawn[0]) == set(SEARCH_SPACE)
    space = {"n_estimators": ("step", 2, 3, 1), "max_depth": ("step", 2, 3, 1)}
    found = random_search(matrix, matrix, 2, 0.9, space)
    assert found.trials.count() == 2 and set(found.best) == set(space)

    final = train_final(matrix, matrix, SMALL)
    path = str(tmp_path / "model")
    final.model.write().save(path)
    names = {r["feature"] for r in importances(final.model, spark).collect()}
    assert names == {*NUMERIC_FEATURES, "category_home", "category_travel"}

    def version(number, score):
        return spark.createDataFrame([(str(number), number, None, score, final.threshold, 10.0, path, False)], VERSION_SCHEMA)

    table = spark.createDataFrame([], VERSION_SCHEMA)
    for number, score in enumerate([0.5, 0.4, 0.5, 0.6], 1):
        table = promote(table, version(number, score))
    aliases = {r["version"]: r["alias"] for r in table.collect()}
    assert aliases == {"1": None, "2": None, "3": "challenger", "4": "champion"}
    history = promotion_history(table).orderBy("registered").select("alias").collect()
    assert [r[0] for r in history] == ["champion", "challenger", "challenger", "champion"]
    model, row = load_champion(table)
    assert row["version"] == "4" and row["threshold"] == final.threshold
    same = with_score(model, matrix).join(with_score(final.model, matrix).select("trans_num", F.col("score").alias("s2")), "trans_num")
    assert same.where("score <> s2").count() == 0
    with pytest.raises(LookupError):
        champion(table.where("alias is null"))


def test_the_test_period_is_opened_once(spark):
    asked = spark.createDataFrame([("1",), ("2",)], "version string")
    done = spark.createDataFrame([("1",)], "version string")
    assert [r[0] for r in not_yet_evaluated(asked, done).collect()] == ["2"]
    assert not_yet_evaluated(asked, done, force=True).count() == 2


def test_a_row_goes_to_a_block_once(spark):
    """However many groups hold something near, a row travels once per block: most groups are in reach in many dimensions."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(900, 24))
    x[700:] = x[500]
    x += 1e4
    df = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(x)], "id long, x array<double>")
    pivots, shape = x[:300], {c: (3, 9.0) for c in range(300)}
    blocks_of = module._in_blocks(pivots, shape, 900, module.BLOCKS, 3)
    home, free = pa.array([0] * 300, "int32"), pa.array([None] * 300, "float64")
    batch = pa.record_batch([pa.array(range(300)), pa.array(pivots.tolist()), pa.array(range(300)), home, free], ["id", "x", "no", "block", "bound"])
    sent = pa.Table.from_batches(module._visits(pivots, shape, blocks_of)([batch]))
    assert sent.num_rows == 300 * (module.BLOCKS - 1) and sent.group_by(["no", "to_block"]).aggregate([]).num_rows == sent.num_rows
    got = {}
    for r in sorted(nearest(df, "id", "x", 3, block_rows=10).collect(), key=lambda r: (r["id"], r["rank"])):
        got.setdefault(r["id"], []).append(r["neighbour"])
    assert got == slow_nearest(x, 3)


def test_fits_read_equal_parts(spark, matrix, monkeypatch):
    """A fit alone has a part per core, each of many fits has few, and no part is too large; small tables stay as they are."""
    assert training.parts_of(280_000, 12) == 12 and training.parts_of(280_000, 12, 16) == 2 and training.parts_of(280_000, 12, 3) == 8
    assert training.parts_of(17_000_000, 12) == 36 and training.parts_of(17_000_000, 12, 16) * training.PART_ROWS >= 17_000_000
    uneven = spark.range(60_000, numPartitions=3).where("id < 20001 or id % 7 = 0")
    sizes = dealt(uneven, 60_000).rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert len(sizes) == 8 and sum(sizes) == uneven.count() and max(sizes) - min(sizes) <= 3
    assert dealt(matrix, 600) is matrix
    started = []
    monkeypatch.setattr(training, "compare", lambda train, val, runs, cols: started.extend(runs) or spark.createDataFrame([(r, 0.5) for r in runs], "run string, pr_auc double"))
    found = random_search(matrix, matrix, 6).trials.orderBy("trial").collect()
    work = [found[int(t)]["n_estimators"] * (found[int(t)]["max_depth"] + 1) for t in started]
    assert [r["trial"] for r in found] == list(range(6)) and work == sorted(work, reverse=True)


def test_fits_share_a_table_without_lineage(spark, matrix, monkeypatch):
    """Inputs that runs share are dealt once, and no fit reads its rows through files and shuffles; samplers get a table of their own."""
    dealt_tables, read = [], []
    monkeypatch.setattr(training, "dealt", lambda df, rows, at_once=1: dealt_tables.append(rows) or df.repartition(2))
    inner = training.classifier

    class Watched:
        def __init__(self, *args):
            self.estimator = inner(*args)

        def fit(self, df):
            lineage = df.select("features").rdd._jrdd.rdd().toDebugString()
            read.append((df.rdd.getNumPartitions(), df.count(), "FileScan" in lineage or "ShuffledRowRDD" in lineage))
            return self.estimator.fit(df)

    monkeypatch.setattr(training, "classifier", Watched)
    runs = {"weighted": {"name": "logreg"}, "plain": {"name": "logreg", "class_weighting": False}, **resampled([[("undersample", 0.9)]], model="logreg")}
    table = {r["run"]: r["pr_auc"] for r in compare(matrix, matrix, runs).collect()}
    assert set(table) == set(runs) and all(0 < v <= 1 for v in table.values())
    fewer = min(dealt_tables)
    assert sorted(dealt_tables) == [fewer, 600] and fewer < 600
    assert sorted(read) == sorted([(2, 600, False)] * (len(runs) - 1) + [(2, fewer, False)])


def test_lineage_of_trees_is_short(spark):
    """The trees of a fit are checkpointed every few; where rows are many, as often as Spark does by itself."""
    assert training.classifier("trees", "is_fraud", 280_000).getCheckpointInterval() == 3
    assert training.classifier("trees", "is_fraud", 17_000_000).getCheckpointInterval() == 10

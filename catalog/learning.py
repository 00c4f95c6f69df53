"""Registered queries of the learning side: sampling, neighbours, models, versions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.batch import Query, rounded
from catalog.fixture import CUT_TEST, CUT_VALIDATION, table, transactions
from tidemark.operators.nearest import nearest
from tidemark.operators.ranking import evaluate
from tidemark.operators.resampling import remove_tomek_links, smote, tomek_links
from tidemark.operators.sampling import sample_fraction, undersample
from tidemark.plans.dataset import build_dataset
from tidemark.plans.registry import VERSION_SCHEMA, load_champion, not_yet_evaluated, promote, promotion_history
from tidemark.plans.training import BASELINE_TREES, compare, fit_model, importances, random_search, resampled, train_final, with_score, without_groups
from tidemark.session import new_working_path, stored

# As many as the job `tune` takes; models and ranges are the library's.
TRIALS = 20
BLOCK = 100


def _ticket(name: str = "trans_num"):
    return F.pmod(F.pmod(F.col(name), F.lit(1000003)) * 2654435761, F.lit(4294967296))


def _vectors(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("x"), (F.col("label") == 0).cast("int").alias("y"), "label"
    )


def _prepared(spark, sf_dir) -> DataFrame:
    raw = transactions(spark, sf_dir).drop("split", "score")
    cut = F.lit(CUT_TEST).cast("timestamp_ntz")
    time = F.col("trans_date_trans_time")
    return stored(build_dataset(raw.where(time < cut), raw.where(time >= cut), CUT_VALIDATION), "prepared")


def _periods(spark, sf_dir):
    rows = _prepared(spark, sf_dir)
    return rows.where("split = 'train'"), rows.where("split = 'val'"), rows.where("split = 'test'")


def undersample_rows(spark, sf_dir):
    rows = transactions(spark, sf_dir).select("trans_num", "is_fraud")
    return undersample(rows, 0.1, "trans_num", ticket=_ticket())


def sample_rows(spark, sf_dir):
    return sample_fraction(transactions(spark, sf_dir).select("trans_num", "amt"), "trans_num", 0.2)


def neighbours(spark, sf_dir):
    out = nearest(_vectors(spark, sf_dir), "vec_id", "x", 5, block_rows=BLOCK)
    return rounded(out.select("id", "neighbour", "rank", "distance"))


def smote_rows(spark, sf_dir):
    out = smote(
        _vectors(spark, sf_dir), 0.3, "vec_id", "x", "y", block_rows=BLOCK, ticket=_ticket("id"),
        pick=F.col("id") * 7 + F.col("copy") * 3, way=F.pmod(F.col("id") * 13 + F.col("copy") * 29, F.lit(100)) / F.lit(100.0),
    )
    total = F.aggregate("x", F.lit(0.0), lambda acc, v: acc + v)
    return rounded(out.select("vec_id", "y", total.alias("total"), F.col("x")[0].alias("x0"), F.col("x")[1].alias("x1")))


def tomek(spark, sf_dir):
    rows = _vectors(spark, sf_dir).withColumn("y", F.col("label") % 2)
    return rounded(tomek_links(rows, "vec_id", "x", "y", block_rows=BLOCK))


def tomek_removed(spark, sf_dir):
    rows = _vectors(spark, sf_dir).withColumn("y", F.col("label") % 2)
    return remove_tomek_links(rows, "vec_id", "x", "y", block_rows=BLOCK).select("vec_id", "y")


#: Chains of resampling steps that are compared with each other.
CHAINS = [
    [("undersample", 0.1)],
    [("smote", 0.1)],
    [("undersample", 0.1), ("smote", 0.3), ("tomek", None)],
]
SHOWN = ["run", "pr_auc", "recall_at_1pct_fpr", "precision", "recall"]


def train_compare(spark, sf_dir):
    train, val, _ = _periods(spark, sf_dir)
    runs = {name: {"name": name} for name in ("prior", "logreg", "trees")}
    return rounded(compare(train, val, runs).drop("train_seconds"), 4)


def imbalance_compare(spark, sf_dir):
    train, val, _ = _periods(spark, sf_dir)
    return rounded(compare(train, val, resampled(CHAINS)).select(*SHOWN), 4)


def ablation(spark, sf_dir):
    train, val, _ = _periods(spark, sf_dir)
    return rounded(compare(train, val, without_groups()).select(*SHOWN), 4)


def search(spark, sf_dir):
    train, val, _ = _periods(spark, sf_dir)
    return rounded(random_search(train, val, TRIALS).trials, 4)


def importance(spark, sf_dir):
    train, _, _ = _periods(spark, sf_dir)
    return rounded(importances(fit_model(train, "trees"), spark))


def score_batch(spark, sf_dir):
    """Fit, choose the threshold, register, promote, load the champion again and score the test period."""
    train, val, test = _periods(spark, sf_dir)
    final = train_final(train, val, BASELINE_TREES)
    path = new_working_path(spark, "model")
    final.model.write().overwrite().save(path)
    row = ("1", 1, None, final.metrics["pr_auc"], final.threshold, 10.0, path, False)
    none = spark.createDataFrame([], VERSION_SCHEMA)
    versions = promote(none, spark.createDataFrame([row], VERSION_SCHEMA))
    model, version = load_champion(versions)
    scored = with_score(model, test)
    flagged = (F.col("score") >= version["threshold"]).cast("int").alias("flagged")
    return rounded(scored.select("trans_num", "is_fraud", "score", flagged))


def _versions(spark, sf_dir) -> DataFrame:
    """Every day of data stands for one registered version, with that day's average precision."""
    rows = transactions(spark, sf_dir).withColumn("version", F.date_format("trans_date_trans_time", "yyyy-MM-dd"))
    return evaluate(rows, by=["version"]).select("version", F.col("pr_auc").alias("val_pr_auc"), "positives")


def promotions(spark, sf_dir):
    return rounded(promotion_history(_versions(spark, sf_dir), "version").select("version", "val_pr_auc", "alias"))


def promoted(spark, sf_dir):
    """The last day as a new version against a table of all earlier days, whose best is the champion and whose first is the challenger."""
    days = stored(_versions(spark, sf_dir).where("val_pr_auc IS NOT NULL"), "versions")
    last = days.agg(F.max("version")).first()[0]
    past = days.where(F.col("version") < last)
    best = past.orderBy(F.desc("val_pr_auc"), "version").limit(1).select(F.col("version").alias("_best"))
    alias = F.when(F.col("version") == F.col("_best"), "champion").when(F.col("version") == F.col("_first"), "challenger")
    first = past.agg(F.min("version").alias("_first"))
    past = past.join(F.broadcast(best), F.lit(True)).join(F.broadcast(first), F.lit(True)).withColumn("alias", alias)
    new = days.where(F.col("version") == last).withColumn("alias", F.lit(None).cast("string"))
    columns = ["version", "val_pr_auc", "alias"]
    return rounded(promote(past.select(*columns), new.select(*columns)).select(*columns))


def test_guard(spark, sf_dir):
    """Versions with more than 18 positives count as already evaluated."""
    versions = _versions(spark, sf_dir)
    return not_yet_evaluated(versions.select("version"), versions.where("positives > 18"))


QUERIES: dict[str, Query] = {
    "undersample": undersample_rows,
    "sample_fraction": sample_rows,
    "nearest_neighbours": neighbours,
    "smote": smote_rows,
    "tomek": tomek,
    "tomek_removed": tomek_removed,
    "train_compare": train_compare,
    "imbalance_compare": imbalance_compare,
    "ablation": ablation,
    "random_search": search,
    "importance": importance,
    "score_batch": score_batch,
    "promote": promoted,
    "promotion_history": promotions,
    "test_guard": test_guard,
}

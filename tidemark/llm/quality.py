"""Quality by a sparse ensemble of rules.

Statistics of the text are Spark columns. Trees over them are fitted on labelled documents; every path from a root
is a rule, a conjunction of comparisons. A lasso logistic regression over the rules keeps few of them, and these
are compiled into one Spark column expression: scoring is a scan without Python, shuffles or a model object.

Trees and weights are fitted on a bounded sample (SAMPLE labelled documents of each class, smallest hash of the id
first), weighted back to the shares of all labels.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored, text_of
from tidemark.llm.toxicity import labelled_sample

SAMPLE = 5000
TREES = 24
DEPTH = 3
LASSO = 0.002
#: Words are told apart within stretches of so many.
STRETCH = 50
_SEED = 17


def _without(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, "")).cast("double")


def _fresh_share(words: Column) -> Column:
    """Mean share of distinct words in consecutive stretches of STRETCH words, over the whole text.

    The last stretch is the last STRETCH words and overlaps the one before, so every word counts and the share does not
    depend on the length; a text with fewer words is one stretch.
    """

    def of(all_words: Column) -> Column:
        last = F.ceil(F.size(all_words) / STRETCH).cast("int") - 1
        latest = F.greatest(F.size(all_words) - STRETCH, F.lit(0))
        starts = F.transform(F.sequence(F.lit(0), last), lambda i: F.least(i * STRETCH, latest) + 1)
        some = F.transform(starts, lambda start: F.slice(all_words, start, STRETCH))
        shares = F.transform(some, lambda s: F.size(F.array_distinct(s)) / F.size(s))
        return F.aggregate(shares, F.lit(0.0), lambda total, share: total + share) / F.size(shares)

    # A function of one element: the words are cut out once, not again for every stretch.
    return F.transform(F.array(words), of)[0]


def statistics(text: str) -> dict[str, Column]:
    """What the rules compare, nothing that grows or falls with length alone; all are defined for an empty text.

    Shares refer to code points or words.
    """
    t = text_of(text)
    chars = F.length(t).cast("double")
    some = F.greatest(chars, F.lit(1.0))
    words = F.split(t, " ")
    count = F.size(words).cast("double")
    return {
        "letters": 1 - _without(t, r"\p{L}+") / some,
        "capitals": 1 - _without(t, r"\p{Lu}+") / some,
        "digits": 1 - _without(t, r"\p{N}+") / some,
        "spaces": 1 - _without(t, r"\s+") / some,
        "ends": 1 - _without(t, "[.!?]+") / some,
        "signs": 1 - _without(t, "[#$%&*@^~<>{}=+_/\\\\]+") / some,
        "bars": 1 - F.length(F.replace(t, F.lit("|"), F.lit(""))) / some,
        "shouts": 1 - F.length(F.replace(t, F.lit("!"), F.lit(""))) / some,
        "lines": 1 - F.length(F.replace(t, F.lit("\n"), F.lit(""))) / some,
        "word_chars": chars / count,
        "fresh_words": _fresh_share(words),
    }


@dataclass(frozen=True)
class Rule:
    """All comparisons (statistic, "<=" or ">", bound) must hold."""

    tests: tuple[tuple[str, str, float], ...]

    def column(self, statistic: Callable[[str], Column]) -> Column:
        out = None
        for name, sign, bound in self.tests:
            value = statistic(name)
            test = value <= F.lit(bound) if sign == "<=" else value > F.lit(bound)
            out = test if out is None else out & test
        return F.coalesce(out.cast("double"), F.lit(0.0))


@dataclass(frozen=True)
class RuleModel:
    bias: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self, statistic: Callable[[str], Column]) -> Column:
        total = F.lit(self.bias)
        for rule, weight in self.rules:
            total = total + rule.column(statistic) * F.lit(weight)
        return 1 / (1 + F.exp(-total))


def tree_rules(description: str, names: list[str]) -> list[Rule]:
    """The conditions of all nodes below the roots, from the printed form of Spark's trees."""
    path: list[tuple[int, tuple[str, str, float]]] = []
    rules = []
    for line in description.splitlines():
        depth = len(line) - len(line.lstrip())
        if line.strip().startswith("Tree "):
            path = []
        found = re.match(r"(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line.strip())
        if found:
            path = [(d, t) for d, t in path if d < depth]
            path.append((depth, (names[int(found[1])], found[2], float(found[3]))))
            rules.append(Rule(tuple(sorted({t for _, t in path}))))
    return list(dict.fromkeys(rules))


def _kept_statistic(name: str) -> Column:
    return F.col(f"_stat_{name}")


def with_statistics(docs: DataFrame, text: str) -> DataFrame:
    return docs.withColumns({f"_stat_{n}": c for n, c in statistics(text).items()})


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    rows: int = SAMPLE,
    trees: int = TREES,
    depth: int = DEPTH,
    lasso: float = LASSO,
) -> RuleModel:
    """Rules from the labels given; with one class only, or none, a constant score."""
    names = list(statistics(text))
    sample = with_statistics(labelled_sample(docs, labels, id, text, label, rows), "text")
    sample = stored(sample.select("id", "y", "weight", *[f"_stat_{n}" for n in names]), "quality-sample")
    sample = stored(sample.repartition(4).sortWithinPartitions("id"), "quality-sample")
    classes = {r["y"] for r in sample.select("y").distinct().collect()}
    if len(classes) < 2:
        return RuleModel(-20.0 if classes == {0} else 20.0, ())
    vector = array_to_vector(F.array(*[F.col(f"_stat_{n}") for n in names]))
    points = sample.select("y", "weight", vector.alias("features"))
    forest = RandomForestClassifier(
        labelCol="y", weightCol="weight", numTrees=trees, maxDepth=depth, seed=_SEED, featureSubsetStrategy="onethird"
    )
    rules = tree_rules(forest.fit(points).toDebugString, names)
    if not rules:
        return RuleModel(20.0, ())
    met = sample.select("y", "weight", array_to_vector(F.array(*[r.column(_kept_statistic) for r in rules])).alias("features"))
    met = stored(met, "quality-rules")
    lasso_fit = LogisticRegression(
        labelCol="y", weightCol="weight", elasticNetParam=1.0, regParam=lasso, maxIter=60, family="binomial"
    ).fit(met)
    weights = lasso_fit.coefficients.toArray().tolist()
    kept = tuple((r, w) for r, w in zip(rules, weights) if w != 0.0)
    return RuleModel(float(lasso_fit.intercept), kept)


def score(docs: DataFrame, model: RuleModel, text: str = "text", name: str = "score") -> DataFrame:
    """All rows and columns of `docs` and the score of the whole text, 0 to 1; null counts as empty.

    A column of that name is replaced.
    """
    kept = [c for c in docs.columns if c != name]
    # The rules are a function of one struct, so the statistics are computed once for a row even where the optimiser
    # moves the score into a filter; as plain columns they would be written out there again for every comparison.
    found = F.array(F.struct(*[c.alias(n) for n, c in statistics(text).items()]))
    scores = F.transform(found, lambda row: model.score(lambda n: row[n]))
    return docs.select(*kept, scores[0].alias(name))

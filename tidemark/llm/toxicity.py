"""Toxicity by multiple-instance learning.

Only documents carry labels. A sentence has the probability p = sigmoid(bias + weights of its words and word
beginnings), a document 1 - product(1 - p) over its sentences (noisy-or). Both are learned together from the
labels of documents, so the sentences that make a document toxic can be pointed out afterwards.

Every sentence has some probability, and many add up to certainty. Documents are labelled at usual lengths, so what
weak sentences (p below WEAK) may say is held to that: in a document of more sentences than usual, which is the
USUAL quantile of the fitted documents, their odds are divided by how many times longer it is. A clean text then scores
alike at all lengths, and a sentence that is toxic by itself counts in full wherever it stands.

The model is fitted on a bounded sample (SAMPLE labelled documents of each class, whole texts, smallest hash of the
id first), weighted back to the shares of the classes among all labels. Scoring reads every document.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored, text_of

SAMPLE = 2000
MAX_FEATURES = 4000
LEAST_DOCUMENTS = 4
BEGINNINGS = (4, 5, 6, 7)
WEAK = 0.5
USUAL = 0.95
_STEPS = 400
_RATE = 0.1
_SHRINK = 0.002
_REMEMBERED = 1_000_000
#: Words, and what ends a sentence.
_PARTS = re.compile(r"[^\W\d_]+|[.!?\n]+")
_SENTENCE = re.compile(r"[^.!?\n]*[.!?\n]*")


def word_features(word: str) -> list[str]:
    return ["=" + word, *(word[:n] for n in BEGINNINGS if n < len(word))]


@dataclass
class ToxicityModel:
    """Weights of features (a beginning, or "=" and a whole word), the bias of a sentence, and a usual document's sentences."""

    bias: float
    weights: dict[str, float]
    usual: float = float("inf")
    # Weight of each word; None marks the end of a sentence.
    known: dict[str, float] = field(default_factory=dict, repr=False)

    def _weight(self, part: str) -> float:
        weight = self.known.get(part)
        if weight is None:
            if len(self.known) > _REMEMBERED:
                self.known.clear()
            ends = not part[0].isalpha()
            weight = np.inf if ends else sum(self.weights.get(f, 0.0) for f in word_features(part))
            self.known[part] = weight
        return weight

    def sentence_scores(self, text: str) -> np.ndarray:
        """p of each sentence, in order, as it counts in this text; a text without an end is one sentence."""
        parts = _PARTS.findall(text.lower())
        known = self.known.get
        found = [known(p) for p in parts]
        if None in found:
            found = [self._weight(p) for p in parts]
        weights = np.array([*found, np.inf])
        ends = np.isinf(weights)
        number = np.cumsum(ends) - ends
        sums = np.bincount(number[~ends], weights=weights[~ends], minlength=1)
        z = np.clip(self.bias + sums, -60, 60)
        p = 1 / (1 + np.exp(-z))
        if len(p) > self.usual:
            p = np.where(p < WEAK, 1 / (1 + np.exp(-z) * (len(p) / self.usual)), p)
        return p

    def score(self, text: str) -> float:
        return float(-np.expm1(np.log1p(-np.minimum(self.sentence_scores(text), 1 - 1e-12)).sum()))


def labelled_sample(docs: DataFrame, labels: DataFrame, id: str, text: str, label: str, rows: int) -> DataFrame:
    """(id, text, y, weight): at most `rows` documents of each class, weighted to the shares of all labels.

    `labels` may hold an id several times; its largest label counts. Only the ids of the sample are broadcast.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(id).isNotNull())
    known = stored(known.groupBy(F.col(id).alias("_id")).agg(F.max(label).cast("int").alias("y")), "labels")
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = None
    for y, n in sizes.items():
        some = known.where(F.col("y") == y).orderBy(F.xxhash64("_id"), "_id").limit(rows)
        some = some.withColumn("weight", F.lit(n / min(n, rows)))
        chosen = some if chosen is None else chosen.unionByName(some)
    if chosen is None:
        return docs.sparkSession.createDataFrame([], "id long, text string, y int, weight double")
    found = docs.join(F.broadcast(chosen), F.col(id) == F.col("_id"))
    return found.select(F.col("_id").alias("id"), text_of(text).alias("text"), "y", "weight")


def _feature_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts = {0: Counter(), 1: Counter()}
    for batch in batches:
        for text, y in zip(batch["text"], batch["y"]):
            words = {p for p in _PARTS.findall(text.lower()) if p[0].isalpha()}
            counts[int(y)].update({f for w in words for f in word_features(w)})
    names = sorted(counts[0].keys() | counts[1].keys())
    clean, toxic = ([counts[y][f] for f in names] for y in (0, 1))
    yield pd.DataFrame({"feature": names, "clean": clean, "toxic": toxic})


def _instances(features: list[str]):
    number = {f: i for i, f in enumerate(features)}

    def instances(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sentences, found = [], []
            for text in batch["text"]:
                at, rows = 0, []
                for part in _PARTS.findall(text.lower()):
                    if not part[0].isalpha():
                        at += 1
                    else:
                        rows.extend((at, number[f]) for f in word_features(part) if f in number)
                sentences.append(at + 1)
                found.append(np.array(rows, dtype="int32").reshape(-1, 2))
            yield pd.DataFrame(
                {
                    "y": batch["y"],
                    "weight": batch["weight"],
                    "sentences": sentences,
                    "sentence": [f[:, 0] for f in found],
                    "feature": [f[:, 1] for f in found],
                }
            )

    return instances


def _noisy_or(bags: pd.DataFrame, features: int) -> tuple[float, np.ndarray]:
    """Bias and weights by gradient steps (Adam) on the log loss of documents, with a quadratic penalty."""
    y, doc_weight = bags["y"].to_numpy(), bags["weight"].to_numpy()
    doc_weight = doc_weight / doc_weight.sum()
    doc, feature, key = [], [], []
    for i, (s, f) in enumerate(zip(bags["sentence"], bags["feature"])):
        doc.append(np.full(len(s), i))
        key.append(np.asarray(s, dtype="int64"))
        feature.append(np.asarray(f, dtype="int64"))
    doc, key, feature = (np.concatenate([np.empty(0, dtype="int64"), *x]) for x in (doc, key, feature))
    _, first, sentence = np.unique(doc << 32 | key, return_index=True, return_inverse=True)
    doc_of = doc[first]
    plain = bags["sentences"].to_numpy() - np.bincount(doc_of, minlength=len(y))
    theta = np.zeros(features + 1)
    theta[-1] = -5.0
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, _STEPS + 1):
        z = theta[-1] + np.bincount(sentence, weights=theta[feature], minlength=len(first))
        p, base = 1 / (1 + np.exp(-z)), 1 / (1 + np.exp(-theta[-1]))
        log_clean = np.bincount(doc_of, weights=-np.logaddexp(0, z), minlength=len(y)) - plain * np.logaddexp(0, theta[-1])
        clean = np.exp(np.minimum(log_clean, -1e-9))
        pull = doc_weight * ((1 - y) - y * clean / (1 - clean))
        of_sentence = pull[doc_of] * p
        slope = np.append(
            np.bincount(feature, weights=of_sentence[sentence], minlength=features),
            of_sentence.sum() + (pull * plain).sum() * base,
        )
        slope[:-1] += _SHRINK / len(y) * theta[:-1]
        mean = 0.9 * mean + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        theta -= _RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
    return float(theta[-1]), theta[:-1]


def fit(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = SAMPLE
) -> ToxicityModel:
    """A model from the labels given; without both classes every document scores the share of toxic labels."""
    sample = stored(labelled_sample(docs, labels, id, text, label, rows).repartition(8), "toxicity-sample")
    classes = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.sum("weight").alias("n")).collect()}
    if len(classes) < 2:
        return ToxicityModel(-20.0 if 1 not in classes else 20.0, {})
    counts = sample.select("text", "y").mapInPandas(_feature_counts, "feature string, clean long, toxic long")
    counts = counts.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    sizes = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}

    def odds(n, of):
        return F.log((F.col(n) + 0.5) / (of - F.col(n) + 0.5))

    distance = (odds("toxic", sizes[1]) - odds("clean", sizes[0])) / F.sqrt(
        1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5)
    )
    telling = counts.where(F.col("clean") + F.col("toxic") >= LEAST_DOCUMENTS).withColumn("z", F.abs(distance))
    telling = telling.where("z > 2").orderBy(F.desc("z"), "feature").limit(MAX_FEATURES)
    features = [r["feature"] for r in telling.select("feature").collect()]
    bags = sample.select("text", "y", "weight", "id").mapInPandas(
        _instances(features), "y int, weight double, sentences long, sentence array<int>, feature array<int>"
    )

    # At most 2 * rows documents and MAX_FEATURES features, so one task can fit them.
    def fitted(all_bags: pd.DataFrame) -> pd.DataFrame:
        bias, weights = _noisy_or(all_bags, len(features))
        usual = float(all_bags["sentences"].quantile(USUAL))
        return pd.DataFrame({"feature": ["", " ", *features], "weight": [bias, usual, *weights.tolist()]})

    found = bags.groupBy().applyInPandas(fitted, "feature string, weight double").collect()
    weights = {r["feature"]: r["weight"] for r in found}
    bias, usual = weights.pop(""), weights.pop(" ")
    return ToxicityModel(bias, {f: w for f, w in weights.items() if abs(w) > 1e-6}, usual)


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", name: str = "score") -> DataFrame:
    """All rows and columns of `docs` and the score of the whole text, 0 to 1; null counts as empty.

    A column of that name is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.bias, model.weights, model.usual))

    @F.pandas_udf("double")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = ToxicityModel(*shared.value)
        for some in texts:
            yield pd.Series([own.score(t) for t in some], dtype="float64")

    return docs.withColumn(name, of(text_of(text)))


def offending_sentences(docs: DataFrame, model: ToxicityModel, id: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """(id, sentence_no, start, sentence, score) of the sentences that score `least` or more; start counts code points."""
    shared = docs.sparkSession.sparkContext.broadcast((model.bias, model.weights, model.usual))

    @F.pandas_udf("array<struct<sentence_no:int,start:int,sentence:string,score:double>>")
    def of(texts: pd.Series) -> pd.Series:
        own, out = ToxicityModel(*shared.value), []
        for t in texts:
            spans = [m for m in _SENTENCE.finditer(t) if m[0]]
            scores = [own.sentence_scores(m[0])[0] for m in spans]
            out.append([(i, m.start(), m[0], float(p)) for i, (m, p) in enumerate(zip(spans, scores)) if p >= least])
        return pd.Series(out)

    return docs.select(F.col(id), F.inline(of(text_of(text))))

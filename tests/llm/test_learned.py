import math
import zlib

import pytest
import regex
from pyspark.sql import functions as F

from tidemark.llm import license_scan, quality, queries, toxicity

SF = "/root/testdata/sf0.1"


def held_out_scores(spark, rows, label, n, rest):
    truth = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    pairs = []
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % n == rest)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        if r.held_out and r.doc_id in truth:
            pairs.append((truth[r.doc_id], r.predicted))
    right = sum(y == p for y, p in pairs) / len(pairs)
    positives = [p for y, p in pairs if y == 1]
    negatives = [p for y, p in pairs if y == 0]
    return right, sum(positives) / len(positives), 1 - sum(negatives) / len(negatives)


def test_toxicity_on_held_out_labels(spark):
    right, found, spared = held_out_scores(spark, queries.op7_toxicity(spark, SF).collect(), "toxic", 5, 0)
    assert right >= 0.97 and found >= 0.85 and spared >= 0.98


def test_quality_on_held_out_labels(spark):
    right, kept, rejected = held_out_scores(spark, queries.op10_quality(spark, SF).collect(), "quality", 3, 1)
    assert right >= 0.97 and kept >= 0.98 and rejected >= 0.85


@pytest.fixture(scope="module")
def toxic_model(documents, labels):
    return toxicity.fit(documents, labels)


def test_offending_sentences(spark, toxic_model):
    text = "A quiet start. You are a worthless idiot and a pathetic loser! Then it ends"
    docs = spark.createDataFrame([(1, text), (2, "Nothing here. At all."), (3, None), (4, "")], "doc_id long, text string")
    found = toxicity.offending_sentences(docs, toxic_model).collect()
    assert [(r.doc_id, r.sentence_no, r.start) for r in found] == [(1, 1, text.index(" You"))]
    scores = {r.doc_id: r.score for r in toxicity.score(docs, toxic_model).collect()}
    assert scores[1] > 0.5 > max(scores[2], scores[3], scores[4])


def test_noisy_or_of_sentences(toxic_model):
    text = "One idiot here. Two.\nThree stupid. Four"
    clean = 1.0
    for p in toxic_model.sentence_scores(text):
        clean *= 1 - p
    assert abs(toxic_model.score(text) - (1 - clean)) < 1e-9


def test_toxicity_of_odd_rows(odd, nothing, labels, toxic_model):
    scored = toxicity.score(odd.withColumn("score", F.lit("x")), toxic_model)
    assert scored.count() == odd.count() and dict(scored.dtypes)["score"] == "double"
    assert scored.where("score is null or score < 0 or score > 1").count() == 0
    assert toxicity.score(nothing, toxic_model).count() == 0
    assert toxicity.fit(nothing, labels).score("an idiot") < 0.5


def test_rules_of_a_printed_forest():
    printed = """RandomForest
  Tree 0 (weight 1.0):
    If (feature 0 <= 1.5)
     If (feature 1 <= 2.0)
      Predict: 0.0
     Else (feature 1 > 2.0)
      Predict: 1.0
    Else (feature 0 > 1.5)
     Predict: 1.0
  Tree 1 (weight 1.0):
    Predict: 0.0
"""
    a, b = ("a", "<=", 1.5), ("b", "<=", 2.0)
    want = [(a,), (a, b), (a, ("b", ">", 2.0)), (("a", ">", 1.5),)]
    assert [r.tests for r in quality.tree_rules(printed, ["a", "b"])] == [tuple(w) for w in want]


def test_quality_of_odd_rows(odd, nothing, documents, labels):
    model = quality.fit(documents, labels, trees=8)
    assert model.rules
    scored = quality.score(odd.withColumn("score", F.lit("x")), model)
    assert scored.count() == odd.count()
    assert scored.where("score is null or score < 0 or score > 1").count() == 0
    assert "Python" not in scored._jdf.queryExecution().executedPlan().toString()
    assert quality.score(nothing, model).count() == 0
    assert quality.score(odd, quality.fit(nothing, labels)).where("score >= 0.5").count() == odd.count()


@pytest.fixture(scope="module")
def license_model(documents):
    return license_scan.fit(documents)


def test_licences_of_the_corpus(documents, license_model):
    lines = {
        "Released under the MIT License.": "MIT",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC",
        "Licensed under the Apache License, Version 2.0.": "Apache",
        "This work is licensed under the GNU General Public License, version 3.": "GPL",
    }
    want = sorted(
        (r.doc_id, i, lines[line])
        for r in documents.collect()
        for i, line in enumerate(r.text.split("\n"))
        if line in lines
    )
    found = license_scan.scan(documents, license_model)
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.doc_id, r.paragraph, r.family) for r in found.where("confirmed").collect()) == want


def test_licences_of_odd_rows(spark, odd, nothing, license_model):
    assert license_scan.scan(odd, license_model).count() == 0
    assert license_scan.scan(nothing, license_model).count() == 0
    texts = [
        (1, "Intro\n\nlicensed under the mit license\nend", "p"),
        (1, "Intro\n\nlicensed under the mit license\nend", "p"),
        (None, "SPDX-License-Identifier: Apache-2.0", "p"),
        (2, "x " * 9000 + "\nThis file is licensed under the GNU General Public License", "p"),
        (3, "The general told the public about the version of the work", "p"),
    ]
    rows = license_scan.scan(spark.createDataFrame(texts, "doc_id long, text string, family string"), license_model).collect()
    got = sorted((str(r.doc_id), r.paragraph, r.family) for r in rows)
    assert got == [("1", 2, "MIT"), ("1", 2, "MIT"), ("2", 1, "GPL"), ("None", 0, "Apache")]


#: What each share of characters counts, in the words of another regular expression library.
SHARES = {
    "letters": r"\p{L}",
    "capitals": r"\p{Lu}",
    "digits": r"\p{N}",
    "spaces": r"[ \t\n\x0b\f\r]",
    "ends": "[.!?]",
    "signs": r"[#$%&*@^~<>{}=+_/\\]",
    "bars": r"\|",
    "shouts": "!",
    "lines": "\n",
}


def plain_statistics(text):
    text = text or ""
    words, some = text.split(" "), max(len(text), 1)
    found = {name: 1 - (len(text) - len(regex.findall(p, text))) / some for name, p in SHARES.items()}
    stretches = [words[min(i, max(len(words) - 50, 0)) :][:50] for i in range(0, len(words), 50)]
    found["word_chars"] = len(text) / len(words)
    found["fresh_words"] = sum(len(set(s)) / len(s) for s in stretches) / len(stretches)
    return found


def plain_score(model, text):
    found, total = plain_statistics(text), model.bias
    for rule, weight in model.rules:
        total += weight * all(found[n] <= b if sign == "<=" else found[n] > b for n, sign, b in rule.tests)
    return 1 / (1 + math.exp(-total))


@pytest.fixture(scope="module")
def quality_model(documents, labels):
    return quality.fit(documents, labels)


def test_quality_equals_rules_in_plain_python(odd, documents, quality_model):
    assert quality_model.rules
    for table in (documents, odd.select("doc_id", "text")):
        for r in quality.score(table, quality_model).collect():
            assert abs(r.score - plain_score(quality_model, r.text)) < 1e-9


def test_the_last_words_of_a_text_count(spark, documents, labels, quality_model):
    good = [r.text for r in documents.join(labels, "doc_id").where("quality = 1").orderBy("doc_id").limit(400).collect()]
    good = [" ".join(t.split(" ")[:50]) for t in good if len(t.split(" ")) >= 50][:60]
    rows = [(n, f"{t} " + " ".join(["word"] * n)) for t in good for n in (48, 49, 50, 51)]
    scored = quality.score(spark.createDataFrame(rows, "n int, text string"), quality_model).collect()
    kept = {n: sum(r.score >= 0.5 for r in scored if r.n == n) for n in (48, 49, 50, 51)}
    assert len(good) >= 30 and max(kept.values()) - min(kept.values()) <= 0.1 * len(good), kept

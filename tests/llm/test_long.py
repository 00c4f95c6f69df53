"""Scores of documents must not depend on length alone."""

import random

from pyspark.sql import functions as F

from tidemark.llm import quality, queries, toxicity

SF = "/root/testdata/sf0.1"


def long_joins(texts, lengths, each, size, seed=1):
    """(length, text): random texts joined until their sizes add up to the length."""
    rng, out = random.Random(seed), []
    for length in lengths:
        for _ in range(each):
            parts, n = [], 0
            while n < length:
                parts.append(rng.choice(texts))
                n += size(parts[-1])
            out.append((length, "\n".join(parts)))
    return out


def test_long_good_documents_are_kept(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    held_out = F.coalesce(queries._remainder("doc_id", 3) == 1, F.lit(False))
    model = quality.fit(docs, labels.where(~held_out), label="quality")
    good = docs.where(held_out).join(labels.where("quality = 1"), "doc_id").orderBy("doc_id")
    joins = long_joins([r.text for r in good.select("text").collect()], (74_000, 241_000, 699_000, 2_400_000), 5, len)
    scored = quality.score(spark.createDataFrame(joins, "doc_id long, text string").repartition(8), model)
    assert scored.where("score < 0.5").groupBy("doc_id").count().collect() == []


def test_statistics_of_repeated_text(spark):
    text = " ".join(f"w{i % 40}" for i in range(500))
    docs = spark.createDataFrame([(1, text), (2, " ".join([text] * 20))], "doc_id long, text string")
    once, often = docs.orderBy("doc_id").select(F.struct(*[c.alias(n) for n, c in quality.statistics("text").items()])).collect()
    for name, value in once[0].asDict().items():
        assert abs(value - often[0][name]) < 0.01, name


def test_long_clean_documents_are_not_toxic(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    held_out = F.coalesce(queries._remainder("doc_id", 5) == 0, F.lit(False))
    model = toxicity.fit(docs, labels.where(~held_out), label="toxic")
    truth = docs.where(held_out).join(labels, "doc_id").orderBy("doc_id").select("text", "toxic").collect()
    clean = [r.text for r in truth if r.toxic == 0 and model.score(r.text) < 0.5]
    toxic = [r.text for r in truth if r.toxic == 1 and model.score(r.text) >= 0.5]

    def sentences(text):
        return len(model.sentence_scores(text))

    joins = long_joins(clean, (1_100, 3_800, 11_400, 60_000), 10, sentences)
    scores = [(n, model.score(t)) for n, t in joins]
    print("clean joins: most", {n: max(s for m, s in scores if m == n) for n, _ in scores})
    assert [n for n, s in scores if s >= 0.5] == []
    found = [model.score(t[: len(t) // 2] + "\n" + toxic[i % len(toxic)] + "\n" + t[len(t) // 2 :]) >= 0.5 for i, (_, t) in enumerate(joins)]
    print("with a toxic document inside: found", sum(found), "of", len(found))
    assert sum(found) >= 0.9 * len(found)

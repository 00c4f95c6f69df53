"""Licence notices in texts, found by a trained classifier of paragraphs.

A paragraph is what stands between line feeds. A multinomial logistic regression with a lasso penalty over
word n-grams gives each paragraph a score per licence family and for "none of them". A second, one-dimensional regression
calibrates the distance of the best family from "none" into a probability. A finding is confirmed by comparison
with the notices of that family. Few n-grams keep a weight, so paragraphs without any of their words are passed over by one
regular expression; all work is DataFrame expressions.

The classifier is fitted on the notices below and on at most UNKNOWN paragraphs of the corpus that are unlike all of them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored, text_of

# Usual wordings of public licence notices, by family.
NOTICES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache", "Licensed under the Apache License, Version 2.0."),
    ("Apache", "You may not use this file except in compliance with the Apache License. You may obtain a copy of the License at apache.org/licenses/LICENSE-2.0"),
    ("Apache", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation."),
    ("GPL", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("LGPL", "Licensed under the GNU Lesser General Public License, version 2.1 or later."),
    ("LGPL", "SPDX-License-Identifier: LGPL-2.1-or-later"),
    ("AGPL", "Licensed under the GNU Affero General Public License, version 3."),
    ("AGPL", "SPDX-License-Identifier: AGPL-3.0-only"),
    ("BSD", "Released under the BSD 3-Clause License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("BSD", "SPDX-License-Identifier: BSD-3-Clause"),
    ("MPL", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL", "SPDX-License-Identifier: MPL-2.0"),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY", "Licensed under CC BY 4.0."),
    ("CC-BY-SA", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC", "Licensed under CC BY-NC 4.0."),
    ("CC0", "Dedicated to the public domain under the CC0 1.0 Universal dedication."),
    ("CC0", "SPDX-License-Identifier: CC0-1.0"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("ISC", "Released under the ISC License."),
    ("Proprietary", "Copyright. All rights reserved. No part of this publication may be reproduced without prior written permission."),
]
#: Words too common to be a feature by themselves.
COMMON = (
    "a all and any are as at be by can except for form forms free from in is it may met no not of on or part person "
    "prior project provided purpose source subject terms that the this to use used v version was with without work you"
).split()
#: The family of all other paragraphs.
NONE = "none"
UNKNOWN = 4000
GRAM_WORDS = 3
FRAMES = 4
STEPS = 25
LASSO = 0.0005
LEAST = 0.5
CONFIRMED = 0.6
_WORD = r"[\p{L}\p{N}]+(?:[.\-][\p{L}\p{N}]+)*"


def words_of(paragraph: Column) -> Column:
    return F.regexp_extract_all(F.lower(paragraph), F.lit(f"({_WORD})"), F.lit(1))


def grams_of(words: Column) -> Column:
    """Distinct runs of one to three words that hold a word not in COMMON."""
    common = F.array(*[F.lit(w) for w in COMMON])

    def runs(n: int) -> Column:
        starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - (n - 1))).otherwise(F.array())
        telling = F.filter(starts, lambda i: F.exists(F.slice(words, i, n), lambda w: ~F.array_contains(common, w)))
        return F.transform(telling, lambda i: F.array_join(F.slice(words, i, n), " "))

    return F.array_distinct(F.concat(*[runs(n) for n in range(1, GRAM_WORDS + 1)]))


@dataclass(frozen=True)
class LicenseModel:
    """N-grams, their classifier (the last family is NONE), and the calibration of the margin."""

    families: tuple[str, ...]
    vocabulary: CountVectorizerModel
    classifier: LogisticRegressionModel
    slope: float = 1.0
    offset: float = 0.0

    def pattern(self) -> str | None:
        """Matches every lower-case text that holds an n-gram with a weight, by the longest word of each."""
        weighted = self.classifier.coefficientMatrix.toArray().any(axis=0)
        grams = [g for g, has in zip(self.vocabulary.vocabulary, weighted) if has]
        words = {max((w for w in g.split(" ") if w not in COMMON), key=lambda w: (len(w), w)) for g in grams}
        if not words:
            return None
        return r"(?<![\p{L}\p{N}])(?:" + "|".join(sorted(map(re.escape, words))) + r")(?![\p{L}\p{N}])"


def notices(spark: SparkSession) -> DataFrame:
    table = spark.createDataFrame([(i, f, t) for i, (f, t) in enumerate(NOTICES)], "template int, family string, notice string")
    return table.withColumn("words", words_of(F.col("notice")))


def _likeness(words: Column, other: Column) -> Column:
    """Shared words of two texts as a share of the shorter one's."""
    a, b = F.array_distinct(words), F.array_distinct(other)
    return F.size(F.array_intersect(a, b)) / F.greatest(F.least(F.size(a), F.size(b)), F.lit(1))


def _nearest_notice(words: Column) -> Column:
    all_notices = F.array(*[F.array(*[F.lit(w) for w in _notice_words(n)]) for _, n in NOTICES])
    return F.array_max(F.transform(all_notices, lambda other: _likeness(words, other)))


def _notice_words(notice: str) -> list[str]:
    return re.findall(r"\w+(?:[.\-]\w+)*", notice.lower())


def paragraphs(docs: DataFrame, id: str, text: str, pattern: str | None = None) -> DataFrame:
    """(id, paragraph, line): non-empty paragraphs with their number, those that match the pattern if one is given."""
    rows = docs.select(F.col(id).alias("id"), text_of(text).alias("text"))
    if pattern:
        rows = rows.where(F.lower("text").rlike(pattern))
    lines = F.transform(F.split("text", "\n"), lambda p, i: F.struct(i.alias("paragraph"), p.alias("line")))
    rows = rows.select("id", F.inline(lines)).where(F.trim("line") != "")
    return rows.where(F.lower("line").rlike(pattern)) if pattern else rows


def fit(docs: DataFrame, id: str = "doc_id", text: str = "text", unknown: int = UNKNOWN, lasso: float = LASSO) -> LicenseModel:
    """Fitted on the notices, each several times with words in front and behind, and on paragraphs of `docs`.

    About `unknown` documents are taken by the hash of their id, then `unknown` of their paragraphs at most; those that
    look like a notice are left out.
    """
    spark = docs.sparkSession
    known = notices(spark)
    lots = max(1, docs.count() // unknown)
    some = paragraphs(docs.where(F.pmod(F.xxhash64(F.col(id)), F.lit(lots)) == 0), id, text)
    some = some.orderBy(F.xxhash64("line"), "line", "id", "paragraph").limit(unknown)
    some = stored(some.select("line", words_of(F.col("line")).alias("words")).coalesce(1), "licence-unknown")
    clean = some.where((F.size("words") < 3) | (_nearest_notice(F.col("words")) < F.lit(CONFIRMED)))
    plain = clean.select(F.lit(NONE).alias("family"), "words")
    plain = plain.unionByName(known.limit(1).select(F.lit(NONE).alias("family"), F.slice("words", 1, 0).alias("words")))
    # A notice may stand within other words of its paragraph.
    turn = F.row_number().over(Window.orderBy("line")).alias("turn")
    frames = clean.where(F.size("words") > 0).orderBy(F.xxhash64("line")).limit(FRAMES).select(F.slice("words", 1, 6).alias("frame"), turn)
    turns = known.withColumn("turn", F.explode(F.sequence(F.lit(1), F.lit(FRAMES))))
    framed = turns.join(F.broadcast(frames), "turn").select("family", F.concat("frame", "words", "frame").alias("words"))
    rows = plain.unionByName(known.select("family", "words")).unionByName(framed)
    rows = stored(rows.select("family", grams_of(F.col("words")).alias("grams")).repartition(1), "licence-training")

    vocabulary = CountVectorizer(inputCol="grams", outputCol="features", binary=True, minDF=1.0)
    vocabulary = vocabulary.fit(known.select(grams_of(F.col("words")).alias("grams")))
    families = (*dict.fromkeys(f for f, _ in NOTICES), NONE)
    label = F.array_position(F.array(*[F.lit(f) for f in families]), F.col("family")) - 1
    sizes = rows.groupBy("family").agg((1 / F.count(F.lit(1))).alias("weight"))
    points = vocabulary.transform(rows.join(F.broadcast(sizes), "family"))
    points = stored(points.select(label.cast("double").alias("label"), "weight", "features", "family").coalesce(1), "licence-points")
    classifier = LogisticRegression(
        weightCol="weight", family="multinomial", elasticNetParam=1.0, regParam=lasso, maxIter=STEPS, standardization=False
    ).fit(points)
    model = LicenseModel(families, vocabulary, classifier)
    margins = _scored(points, model).select(
        (F.col("family") != NONE).cast("double").alias("label"), "weight", array_to_vector(F.array("margin")).alias("features")
    )
    platt = LogisticRegression(weightCol="weight", family="binomial", regParam=0.001).fit(stored(margins, "licence-margins"))
    return replace(model, slope=float(platt.coefficients[0]), offset=float(platt.intercept))


def _scored(rows: DataFrame, model: LicenseModel) -> DataFrame:
    """`rows` (with features) and best (family), margin (its distance from "none")."""
    found = model.classifier.transform(rows).withColumn("_logits", vector_to_array("rawPrediction"))
    known = len(model.families) - 1
    found = found.withColumn("_top", F.array_max(F.slice("_logits", 1, known)))
    best = F.element_at(F.array(*[F.lit(f) for f in model.families]), F.array_position("_logits", F.col("_top")).cast("int"))
    margin = F.col("_top") - F.element_at("_logits", known + 1)
    return found.withColumns({"best": best, "margin": margin}).select(*rows.columns, "best", "margin")


def scan(docs: DataFrame, model: LicenseModel, id: str = "doc_id", text: str = "text", least: float = LEAST) -> DataFrame:
    """One row per paragraph that is a licence notice: id, paragraph, family, probability, template, likeness, confirmed, line.

    paragraph counts from 0. `template` is the most similar notice of the family (the first of equal ones), likeness the
    shared words as a share of the shorter text's, confirmed whether that is CONFIRMED or more. Null and empty texts give no
    rows; rows with equal or null ids give their own; other columns play no part, whatever their names.
    """
    rows = paragraphs(docs, id, text, model.pattern()).withColumn("words", words_of(F.col("line")))
    # Written once, so that the words of a long line are not cut out again for each of its n-grams.
    rows = stored(rows, "licence-lines")
    rows = _scored(model.vocabulary.transform(rows.withColumn("grams", grams_of(F.col("words")))), model)
    probability = 1 / (1 + F.exp(-(F.col("margin") * F.lit(model.slope) + F.lit(model.offset))))
    rows = rows.withColumn("probability", probability).where(F.col("probability") >= F.lit(least))
    compared = []
    for i, (family, notice) in enumerate(NOTICES):
        other = F.array(*[F.lit(w) for w in _notice_words(notice)])
        like = F.when(F.col("best") == F.lit(family), _likeness(F.col("words"), other)).otherwise(F.lit(-1.0))
        compared.append(F.struct(like.alias("likeness"), F.lit(-i).alias("order")))
    rows = rows.withColumn("_like", F.array_max(F.array(*compared)))
    return rows.select(
        F.col("id").alias(id),
        F.col("paragraph").cast("int").alias("paragraph"),
        F.col("best").alias("family"),
        "probability",
        (-F.col("_like.order")).alias("template"),
        F.col("_like.likeness").alias("likeness"),
        (F.col("_like.likeness") >= F.lit(CONFIRMED)).alias("confirmed"),
        "line",
    )

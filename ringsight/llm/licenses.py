"""Licence scans: a trained paragraph classifier, confirmed by templates. DataFrame functions and Spark ML only.

1. Features: the distinct word 1- and 2-grams of a paragraph (a line of a text; words: letters, digits and dots inside, lower
   case) that occur in the notices below, so a paragraph is a sparse 0/1 vector.
2. Training: multinomial logistic regression (Spark ML) on the notices, windows of their words, sentences that only mention
   licences, and at most about `fit_paragraphs` paragraphs of the corpus (by hash) that share fewer than three 2-grams with
   the notices, which are the class `unknown`. Only the fit is bounded.
3. Scoring: paragraphs that share enough 2-grams with the notices together to share them with one (the others could not be
   confirmed, so nothing is lost) meet the weights by n-gram; sums per class give probabilities. A family is believed if its probability is the greatest and at least the calibrated bound, the greatest
   family probability of any unknown training paragraph (at least 0.5).
4. Confirmation: a notice of the family must share `SIMILAR` of its 2-grams, or of the paragraph's where that is shorter, and
   three at least (`LEAST`).

Null texts count as empty; null or repeated ids are fine. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringsight.session import materialize

#: The usual notices of each family.
NOTICES = {
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "cc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, you can obtain one at mozilla.org/MPL/2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
}
#: Sentences that mention licences and grant none.
DECOYS = (
    "You need a valid driver license to rent a car in this state.",
    "The license plate of the car was found near the old station.",
    "Copyright law protects the work of authors and of artists.",
    "The court gave permission to publish the public version of the report.",
    "The warranty of the device covers parts and labour for two years.",
    "Software is distributed by the vendor under its own terms.",
    "The general public may use the park free of charge.",
    "The restaurant lost its liquor license for the second time.",
)
UNKNOWN = "unknown"
SIMILAR, LEAST, FIT_PARAGRAPHS = 0.6, 3, 2000


def words_of(paragraph: Column) -> Column:
    return F.regexp_extract_all(F.lower(paragraph), F.lit(r"[\p{L}\p{N}]+(?:\.[\p{N}]+)*"), F.lit(0))


def _pairs(words: Column) -> Column:
    pairs = F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(F.filter(pairs, lambda p: p.isNotNull() & F.contains(p, F.lit(" "))))


def paragraphs(docs: DataFrame, text: str) -> DataFrame:
    """One row per line that can be confirmed, with its place and words: it shares the 2-grams with all notices that one asks for."""
    least = min(LEAST, *(len(_text_pairs(t)) for texts in NOTICES.values() for t in texts))
    lines = docs.select("*", F.posexplode(F.split(text, "\n")).alias("paragraph", "line")).withColumn("words", words_of(F.col("line")))
    return lines.where(F.size("words") > least).where(F.size(F.array_intersect(_pairs(F.col("words")), _known_pairs())) >= least)


def _known_pairs() -> Column:
    """The 2-grams of all notices."""
    return F.array(*[F.lit(g) for g in sorted({g for texts in NOTICES.values() for t in texts for g in _text_pairs(t)})])


def notices(spark: SparkSession) -> DataFrame:
    """(family, notice, text) of the fixed notices; decoys are unknown."""
    rows = [(family, f"{family} {k}", text) for family, texts in NOTICES.items() for k, text in enumerate(texts)]
    rows += [(UNKNOWN, f"decoy {k}", text) for k, text in enumerate(DECOYS)]
    return spark.createDataFrame(rows, "family string, notice string, line string")


def train(docs: DataFrame, text: str = "text", fit_paragraphs: int = FIT_PARAGRAPHS) -> tuple[DataFrame, float]:
    """(weights by n-gram: ngram, weights in the order of the sorted classes; '' holds the intercepts), and the bound."""
    spark = docs.sparkSession
    fixed = notices(spark).withColumn("words", words_of(F.col("line")))
    grams = fixed.select(F.explode(F.array_union("words", _pairs(F.col("words")))).alias("g")).distinct().orderBy("g")
    vocabulary = [r[0] for r in grams.collect()]  # of the fixed notices only
    size = F.size("words")
    cut = F.explode(F.sequence(F.lit(0), F.greatest(size - 6, F.lit(0)), F.lit(2)))
    windows = fixed.where(F.col("family") != UNKNOWN).select("family", "words", cut.alias("at")).select(
        "family", F.slice("words", F.col("at") + 1, F.lit(10)).alias("words")
    )
    total = docs.count()
    share = max(1, -(-total * 4 // fit_paragraphs))
    some = docs.where(F.pmod(F.xxhash64(text), F.lit(share)) == 0).select(F.explode(F.split(F.coalesce(text, F.lit("")), "\n")).alias("line"))
    plain = (
        some.where(F.pmod(F.xxhash64("line"), F.lit(2)) == 0)
        .select(F.slice(words_of(F.col("line")), 1, 400).alias("words"))
        .where(size > 0)
        .where(F.size(F.array_intersect(_pairs(F.col("words")), _known_pairs())) < LEAST)
        .select(F.lit(UNKNOWN).alias("family"), "words")
    )
    rows = fixed.select("family", "words").unionByName(windows).unionByName(plain)
    classes = sorted([*NOTICES, UNKNOWN])
    terms = F.array(*[F.lit(g) for g in vocabulary])
    label = (F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("family")) - 1).cast("double")
    found = F.array_intersect(F.array_union("words", _pairs(F.col("words"))), terms)
    sparse = materialize(rows.select(label.alias("label"), found.alias("found")), "licence-rows")
    vector = F.transform(terms, lambda g: F.array_contains("found", g).cast("double"))
    labelled = materialize(sparse.select("label", vector.alias("x")), "licence-vectors").coalesce(4)
    labelled = labelled.withColumn("features", array_to_vector("x"))
    model = LogisticRegression(family="multinomial", regParam=0.0001, maxIter=60, standardization=False).fit(labelled)
    odds = vector_to_array(F.col("probability"))
    at = classes.index(UNKNOWN)
    best = F.array_max(F.array(*[odds[i] for i in range(len(classes)) if i != at]))
    bound = model.transform(labelled).where(F.col("label") == at).agg(F.max(best)).first()[0] or 0.0
    matrix = model.coefficientMatrix.toArray()
    table = [(g, matrix[:, k].tolist()) for k, g in enumerate(vocabulary) if np.abs(matrix[:, k]).max() > 1e-6]
    table.append(("", model.interceptVector.toArray().tolist()))
    return spark.createDataFrame(table, "ngram string, weights array<double>"), max(0.5, float(bound))


def _text_pairs(text: str) -> set[str]:
    """The 2-grams of a fixed notice."""
    import re

    words = re.findall(r"[^\W_]+(?:\.[0-9]+)*", text.lower())
    return {f"{a} {b}" for a, b in zip(words, words[1:], strict=False)}


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, paragraph, family, probability, notice, similarity) of the paragraphs confirmed as licences."""
    weights, bound = train(docs, text)
    classes = sorted([*NOTICES, UNKNOWN])
    found = paragraphs(docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("row")), "text")
    # the lines are written once: rows are numbered once only
    lines = materialize(found.select("key", "row", "paragraph", "words"), "licence-lines")
    lines = lines.withColumn("pairs", _pairs(F.col("words")))
    sums = (
        lines.select("row", "paragraph", F.explode(F.concat(F.array_union("words", "pairs"), F.array(F.lit("")))).alias("ngram"))
        .join(F.broadcast(weights), "ngram")  # n-grams of the fixed notices
        .groupBy("row", "paragraph")
        .agg(*[F.sum(F.col("weights")[k]).alias(c) for k, c in enumerate(classes)])
    )
    total = sum((F.exp(F.col(c) - F.greatest(*classes)) for c in classes), F.lit(0.0))
    best = F.greatest(*[c for c in classes if c != UNKNOWN])
    scored = sums.select(
        "row", "paragraph",
        F.coalesce(*[F.when(F.col(c) == best, F.lit(c)) for c in classes if c != UNKNOWN]).alias("family"),
        (F.exp(best - F.greatest(*classes)) / total).alias("probability"), (best > F.col(UNKNOWN)).alias("known"),
    ).where(F.col("known") & (F.col("probability") >= bound))
    templates = notices(docs.sparkSession).where(F.col("family") != UNKNOWN).select("family", "notice", _pairs(words_of(F.col("line"))).alias("own"))
    compared = scored.join(lines, ["row", "paragraph"]).join(F.broadcast(templates), "family")
    shared = F.size(F.array_intersect("own", "pairs"))
    similarity = shared / F.least(F.size("own"), F.size("pairs"))
    confirmed = compared.where(shared >= F.least(F.lit(LEAST), F.size("own"))).withColumn("similarity", similarity).where(F.col("similarity") >= SIMILAR)
    return (
        confirmed.groupBy("row", "paragraph")
        .agg(F.max(F.struct("similarity", "notice", "family", "probability", "key")).alias("b"))
        .select(F.col("b.key").alias(key), "paragraph", "b.family", "b.probability", "b.notice", "b.similarity")
    )

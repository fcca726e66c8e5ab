"""Licence scans: a trained paragraph classifier, confirmed against templates.

A paragraph (a line of a text) becomes sparse word n-grams (1 to 3 words,
hashed).  A multinomial logistic regression, trained on excerpts of licence
templates and on ordinary paragraphs, gives each paragraph a family or
"unknown".  A family is believed only above a confidence that was calibrated
on ordinary paragraphs which trained nothing.  Last, the paragraph is compared
with the templates of its family: the share of the template's
trigrams of words that it holds, or of its own that a template holds, must be
high enough, and so must their number: a few words in a row that a long template
shares with ordinary prose are no licence.

Only paragraphs that hold a trigram of a template reach the model; no other
one could be confirmed.  Every ordinary one among them takes part: those of one
half of the documents train, those of the other half calibrate.  The confidence
counts all paragraphs of that half, those that never reach the model as 0.
Everything runs as DataFrame expressions and Spark ML; texts stay in their rows.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import stored

# Opening or notice lines of licence families (public texts).
TEMPLATES = {
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS",
    ),
    "mit": (
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ),
    "bsd": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products",
    ),
    "cc": (
        "Licensed under CC BY-NC 4.0.",
        "Licensed under CC BY-SA 4.0.",
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    "proprietary": (
        "Copyright. All rights reserved.",
        "No part of this work may be reproduced without written permission of the publisher.",
    ),
}
UNKNOWN = "unknown"
FAMILIES = (UNKNOWN, *TEMPLATES)
#: Hash buckets of the n-grams.
BUCKETS = 1 << 12
#: Share of ordinary paragraphs that may pass the confidence limit, the least that limit can be, and its steps.
FALSE_RATE, LEAST_CONFIDENCE, CONFIDENCE_STEPS = 0.001, 0.5, 10_000
#: Share of trigrams that a confirmed paragraph and a template of its family have in common.
LEAST_OVERLAP = 0.5
#: Trigrams in common that confirm a paragraph; of a template with fewer than twice as many, half of it.
LEAST_COMMON = 5


def paragraph_words(paragraph: Column) -> Column:
    """Lower-case words of letters, digits, dots and dashes, without a dot at the end."""
    cleaned = F.regexp_replace(F.lower(paragraph), r"[^a-z0-9.\-]+", " ")
    return F.filter(F.transform(F.split(cleaned, " "), lambda w: F.regexp_replace(w, r"^[.\-]+|[.\-]+$", "")), lambda w: w != "")


def ngrams(ws: Column, n: int) -> Column:
    """The n-grams of a word array, joined by spaces."""
    out = ws
    for k in range(2, n + 1):
        out = F.zip_with(out, F.slice(ws, F.lit(k), F.greatest(F.size(ws) - (k - 1), F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.slice(out, F.lit(1), F.greatest(F.size(ws) - (n - 1), F.lit(0)))


def features(ws: Column) -> Column:
    return F.concat(ws, ngrams(ws, 2), ngrams(ws, 3))


def template_table(spark: SparkSession) -> DataFrame:
    """family, words of every template."""
    rows = [(f, t) for f, ts in TEMPLATES.items() for t in ts]
    return spark.createDataFrame(rows, "family string, text string").select("family", paragraph_words(F.col("text")).alias("words"))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n")


def paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple = ()) -> DataFrame:
    """doc_id, columns to keep, position (from 0), paragraph of every line that holds a word."""
    return (docs.select(F.col(id_col).alias("doc_id"), *keep, F.posexplode(_lines(F.col(text_col))).alias("position", "paragraph"))
            .where(F.trim("paragraph") != ""))


def _training(templates: DataFrame) -> DataFrame:
    """Whole templates and their excerpts of at least half the words, by family."""
    w = F.col("words")
    part = F.flatten(F.transform(F.sequence(F.ceil(F.size(w) / 2).cast("int"), F.size(w)), lambda n: F.transform(
        F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.slice(w, i, n))))
    return templates.select("family", F.explode(part).alias("words"))


def _halves(docs: DataFrame) -> DataFrame:
    """doc_id, text, calibrates: by a hash of both, whether the document's ordinary paragraphs calibrate or train."""
    return docs.select("doc_id", "text", (F.pmod(F.xxhash64("doc_id", "text"), F.lit(2)) == 0).alias("calibrates"))


def candidates(docs: DataFrame) -> DataFrame:
    """Every paragraph that holds a trigram of a template: doc_id, calibrates, position,
    paragraph, words, ordinary (no template confirms it)."""
    # whole texts first: most hold no trigram of a template at all
    lines = paragraphs(_halves(docs).where(may_match(F.col("text"))), keep=("calibrates",)).where(may_match(F.col("paragraph")))
    return (lines.withColumn("words", paragraph_words(F.col("paragraph")))
            .withColumn("ordinary", ~F.coalesce(confirmed(None, F.col("words")), F.lit(False))))


def _shingles(ws: Column) -> Column:
    """Distinct trigrams; of shorter sequences, the whole as one."""
    return F.when(F.size(ws) >= 3, F.array_distinct(ngrams(ws, 3))).when(F.size(ws) > 0, F.array(F.array_join(ws, " "))).otherwise(F.array().cast("array<string>"))


def _template_trigrams(template: str) -> list[str]:
    """The distinct trigrams of a template (as ``_shingles`` of ``paragraph_words``)."""
    ws = [re.sub(r"^[.\-]+|[.\-]+$", "", x) for x in re.sub(r"[^a-z0-9.\-]+", " ", template.lower()).split(" ")]
    ws = [w for w in ws if w]
    return list(dict.fromkeys(" ".join(ws[i:i + 3]) for i in range(max(1, len(ws) - 2))))


def _literal_shingles(template: str) -> Column:
    """The trigrams of a template as a constant array."""
    return F.array(*map(F.lit, _template_trigrams(template)))


def _templates(family: Column | None) -> Column:
    """The trigrams of each template of the family (of every family if None)."""
    if family is None:
        return F.array(*[_literal_shingles(t) for ts in TEMPLATES.values() for t in ts])
    return F.coalesce(F.try_element_at(F.create_map(*[x for f, ts in TEMPLATES.items() for x in (
        F.lit(f), F.array(*map(_literal_shingles, ts)))]), family), F.array().cast("array<array<string>>"))


def overlap(family: Column | None, ws: Column) -> Column:
    """Largest share of trigrams common to a paragraph and a template of the
    family (of any family if None), counted over the shorter of the two."""
    share = lambda mine, t: F.size(F.array_intersect(mine, t)) / F.greatest(F.least(F.size(mine), F.size(t)), F.lit(1))
    best = F.transform(F.array(_shingles(ws)), lambda mine: F.array_max(F.transform(_templates(family), lambda t: share(mine, t))))[0]
    return F.coalesce(best, F.lit(0.0))


def confirmed(family: Column | None, ws: Column) -> Column:
    """Whether a template of the family (any if None) has ``LEAST_OVERLAP`` of the shorter
    side in common with the paragraph, and ``LEAST_COMMON`` trigrams (a short template: half of its own)."""
    def holds(mine: Column, t: Column) -> Column:
        asked = F.greatest(F.least(F.size(mine), F.size(t)) * F.lit(LEAST_OVERLAP), F.least(F.size(t) / 2, F.lit(float(LEAST_COMMON))))
        return F.size(F.array_intersect(mine, t)) >= asked
    return F.exists(F.array(_shingles(ws)), lambda mine: F.exists(_templates(family), lambda t: holds(mine, t)))


def _trie_pattern(phrases: list[str]) -> str:
    """A pattern for any of the phrases in lower-case text, whatever stands between their words."""
    trie: dict = {}
    for p in phrases:
        node = trie
        for c in p:
            node = node.setdefault(c, {})
        node[""] = {}

    def pattern(node: dict) -> str:
        ways = ["(?![a-z0-9])" if c == "" else ("[^a-z0-9]++" if c == " " else re.escape(c)) + pattern(n) for c, n in sorted(node.items())]
        return ways[0] if len(ways) == 1 else "(?:" + "|".join(ways) + ")" if ways else ""

    return "(?<![a-z0-9])" + pattern(trie)


def may_match(text: Column) -> Column:
    """Whether a text may hold a trigram of a template: true for every text with a paragraph that does."""
    return F.lower(text).rlike(_trie_pattern([g for ts in TEMPLATES.values() for t in ts for g in _template_trigrams(t)]))


class Classifier:
    """The regression and its calibrated confidence."""

    def __init__(self, model: LogisticRegressionModel, confidence: float):
        self.model, self.confidence = model, confidence

    def scored(self, rows: DataFrame) -> DataFrame:
        """Adds family and probability (of the likeliest family; unknown if it is that or below the confidence). ``rows`` has words."""
        tf = HashingTF(inputCol="__grams", outputCol="features", numFeatures=BUCKETS, binary=True)
        p = vector_to_array(F.col("probability"))
        out = self.model.transform(tf.transform(rows.withColumn("__grams", features(F.col("words"))))).withColumn("__p", p)
        best = F.array_max(F.transform(F.slice("__p", 2, len(FAMILIES)), lambda x, i: F.struct(x.alias("p"), i.alias("i"))))
        return (out.withColumn("__best", best).withColumn("probability", F.col("__best.p"))
                .withColumn("family", F.when(F.col("probability") >= self.confidence, F.element_at(
                    F.array(*map(F.lit, TEMPLATES)), (F.col("__best.i") + 1).cast("int"))).otherwise(F.lit(UNKNOWN)))
                .drop("__grams", "features", "rawPrediction", "prediction", "__p", "__best"))


def train(docs: DataFrame, lines: DataFrame | None = None) -> Classifier:
    """Fits on template excerpts and every ordinary candidate of one half of the documents, and sets the
    confidence on all ordinary paragraphs of the other half.  ``lines``: the candidates of ``docs``, if at hand."""
    spark = docs.sparkSession
    lines = stored(candidates(docs), "licence-lines") if lines is None else lines
    label = F.element_at(F.map_from_arrays(F.array(*map(F.lit, FAMILIES)), F.array(*[F.lit(float(i)) for i in range(len(FAMILIES))])), F.col("family"))
    rows = (_training(template_table(spark)).select("family", "words")
            .unionByName(lines.where("ordinary and not calibrates").select(F.lit(UNKNOWN).alias("family"), "words")).withColumn("label", label))
    # excerpts and ordinary paragraphs differ in number: each class weighs the same
    weights = rows.groupBy("label").agg((F.lit(1000.0) / F.count("*")).alias("weight"))
    rows = rows.join(weights, "label").withColumn("__grams", features(F.col("words")))
    rows = HashingTF(inputCol="__grams", outputCol="features", numFeatures=BUCKETS, binary=True).transform(rows)
    # a class without rows (no ordinary paragraph among the candidates) keeps its place in the model
    model = LogisticRegression(family="multinomial", weightCol="weight", regParam=0.002, elasticNetParam=0.5, maxIter=25, tol=1e-4).fit(
        rows.select("label", "weight", "features"))
    # paragraphs that are no candidates are never believed: they count as probability 0
    every = _halves(docs).where("calibrates").agg(F.sum(F.size(F.filter(_lines(F.col("text")), lambda x: F.trim(x) != "")))).first()[0] or 0
    silent = every - lines.where("calibrates").count()
    ordinary = Classifier(model, 0.0).scored(lines.where("ordinary and calibrates"))
    step = (F.ceil(F.col("probability") * CONFIDENCE_STEPS) / CONFIDENCE_STEPS).cast("double").alias("probability")
    counts = ordinary.groupBy(step).agg(F.count("*").alias("n")).unionByName(
        spark.range(1).select(F.lit(0.0).alias("probability"), F.lit(silent).cast("long").alias("n")))
    limit = counts.where("n > 0").agg(F.expr(f"percentile(probability, {1 - FALSE_RATE}, n)")).first()[0]
    return Classifier(model, max(LEAST_CONFIDENCE, min(limit or 0.0, 0.95)))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per paragraph found to be a licence: doc_id, position, family, probability, overlap, paragraph.

    Null and empty texts have no paragraph.  Rows that repeat are reported once
    each; null ids are reported with null; extra columns are ignored; an empty
    table gives an empty result."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if rows.isEmpty():
        return rows.sparkSession.createDataFrame([], f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, position int, family string, probability double, overlap double, paragraph string")
    lines = stored(candidates(rows), "licence-lines")
    scored = train(rows, lines).scored(lines)
    return (scored.where(F.col("family") != UNKNOWN).withColumn("overlap", overlap(F.col("family"), F.col("words")))
            .where(confirmed(F.col("family"), F.col("words"))).select("doc_id", "position", "family", "probability", "overlap", "paragraph"))


def document_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with a licence: doc_id, families (sorted), n_paragraphs, probability (best)."""
    found = scan(docs, id_col, text_col)
    return found.groupBy("doc_id").agg(F.sort_array(F.collect_set("family")).alias("families"), F.count("*").alias("n_paragraphs"),
                                       F.round(F.max("probability"), 4).alias("probability"))

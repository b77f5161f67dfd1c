"""Licence families of paragraphs by a trained classifier, confirmed by templates.

Paragraphs are the lines of a text.  Hashed word one- and two-grams feed a multinomial
logistic regression over licence families and an unknown class.  It is trained on
templates, varied by leaving out words and by surrounding them with words of the corpus,
against a bounded sample of the corpus's own lines.  A second regression on lines kept
aside turns the margin between the best family and the unknown class into a
calibrated probability; a line is a finding if that is at least one half.  The nearest
template of the family then confirms the finding or not.

Everything is DataFrame operations and Spark's own feature transformers.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, NGram
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lethe.operators.sizing import durable

# Names and wording of public licences and their customary notices.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction'),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("GPL", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("LGPL", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL", "Licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY", "Licensed under CC BY 4.0."),
    ("CC-BY-SA", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC", "Licensed under CC BY-NC 4.0."),
    ("Public domain", "This is free and unencumbered software released into the public domain."),
    ("Public domain", "To the extent possible under law, the author has waived all copyright and related rights under CC0 1.0 Universal."),
    ("Proprietary", "All rights reserved."),
    ("Proprietary", "Copyright, all rights reserved. No part may be reproduced without prior written permission."),
]
UNKNOWN = "unknown"


@dataclass(frozen=True)
class LicenceParameters:
    sampled_lines: int = 10_000  # lines of the corpus that stand for the unknown class
    variants: int = 30  # training lines per template
    features: int = 1 << 13
    confirmed_from: float = 0.75  # share of a template's words in a finding
    iterations: int = 25


def _words(text: Column) -> Column:
    lowered = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}.+/-]+", " ")
    return F.array_remove(F.transform(F.split(lowered, " "), lambda w: F.rtrim(w, F.lit(".-/+"))), "")


def _once(column: Column) -> Column:
    """The column, computed once: conditions on it are not moved below this point."""
    return F.explode_outer(F.array(column))


def _with_features(frame: DataFrame, p: LicenceParameters) -> DataFrame:
    paired = NGram(n=2, inputCol="words", outputCol="pairs").transform(frame)
    grams = paired.withColumn("grams", F.concat("words", "pairs")).drop("pairs")
    return HashingTF(numFeatures=p.features, binary=True, inputCol="grams", outputCol="features").transform(grams).drop("grams")


def paragraphs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, paragraph, line) of every line that is not blank."""
    lines = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.posexplode(F.split(F.col(text_col).cast("string"), "\r\n|\n|\r")).alias("paragraph", "line"),
    )
    return lines.where(F.length(F.trim("line")) > 0)


def _training(spark: SparkSession, lines: DataFrame, p: LicenceParameters) -> DataFrame:
    """(words, family, aside): varied templates and sampled lines of the corpus."""
    templates = spark.createDataFrame(TEMPLATES, "family string, template string")
    wording = templates.select("family", _words(F.col("template")).alias("words"))
    # few lines of many documents, drawn by hash
    drawn = durable(
        lines.orderBy(F.xxhash64("doc_id", "paragraph"), "line")
        .limit(p.sampled_lines)
        .select(F.slice(_words(F.substring("line", 1, 2000)), 1, 200).alias("words"))
    )
    telling = reduce(
        lambda a, b: a | b,
        (F.array_contains("words", w) for w in ("license", "licensed", "licence", "copyright", "reserved", "spdx-license-identifier", "redistribution")),
    )
    none = drawn.where(~telling).select(F.lit(UNKNOWN).alias("family"), "words")
    numbered = none.select("words", F.pmod(F.xxhash64("words"), F.lit(p.variants)).alias("around"))
    context = numbered.groupBy("around").agg(F.first("words").alias("near"))
    varied = (
        wording.withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(p.variants - 1))))
        .join(context, F.col("n") == F.col("around"), "left")
        .select(
            "family",
            F.concat(
                F.when(F.col("n") % 3 == 1, F.slice(F.coalesce("near", F.array()), 1, 6)).otherwise(F.array()),
                # every fifth variant is whole, the others lack about one word in eight
                F.filter("words", lambda w: (F.col("n") % 5 == 0) | (F.pmod(F.xxhash64(w, F.col("n")), F.lit(8)) > 0)),
                F.when(F.col("n") % 3 == 2, F.slice(F.coalesce("near", F.array()), 1, 6)).otherwise(F.array()),
            ).alias("words"),
        )
    )
    both = none.unionByName(varied).where(F.size("words") > 0)
    return both.withColumn("aside", F.pmod(F.xxhash64("words"), F.lit(4)) == 0)


def find_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  parameters: LicenceParameters = LicenceParameters()) -> DataFrame:
    """(doc_id, paragraph, family, probability, similarity, confirmed) of findings.

    ``paragraph`` counts the lines of the text from 0, blank ones too.  ``similarity`` is
    the largest share of a template of the family whose words occur in the line, and
    ``confirmed`` whether that is at least 0.75.  Null, empty and blank texts have no
    findings.  Repeated rows and rows without id are searched each for itself.  No
    documents, or none with words: no rows.  Other columns are not read.
    """
    p = parameters
    spark = docs.sparkSession
    lines = paragraphs(docs, id_col, text_col)
    training = durable(_training(spark, lines, p).coalesce(4))
    families = [UNKNOWN, *sorted({f for f, _ in TEMPLATES})]
    number = F.array_position(F.array(*map(F.lit, families)), F.col("family")) - 1
    featured = _with_features(training, p).withColumn("label", number.cast("double"))
    fit = featured.where("not aside").select("features", "label")
    model = LogisticRegression(maxIter=p.iterations, regParam=1e-3, family="multinomial").fit(fit)

    def margins(frame: DataFrame) -> DataFrame:
        raw = _once(vector_to_array("rawPrediction")).alias("raw")
        scored = model.transform(frame).select(*frame.drop("features").columns, raw)
        known = F.slice("raw", 2, len(families) - 1)
        return (
            scored.withColumn("best", F.array_max(known))
            .withColumn("family", F.get(F.array(*map(F.lit, families[1:])), F.array_position(known, F.col("best")).cast("int") - 1))
            .withColumn("margin", F.col("best") - F.get("raw", F.lit(0)))
        )

    slope, shift = _calibration(margins(featured.where("aside").select("label", "features")), model.numClasses)
    worded = lines.select("doc_id", "paragraph", _once(_words(F.col("line"))).alias("words"))
    scored = margins(_with_features(worded.where(F.size("words") > 0), p))
    probability = 1 / (1 + F.exp(-(F.col("margin") * slope + shift)))
    findings = scored.select("doc_id", "paragraph", "words", "family", probability.alias("probability")).where(
        F.col("probability") >= 0.5
    )
    wording = spark.createDataFrame(TEMPLATES, "family string, template string")
    sets = wording.groupBy("family").agg(F.collect_list(F.array_distinct(_words(F.col("template")))).alias("sets"))
    compared = findings.join(F.broadcast(sets), "family")  # one row per family
    share = F.array_max(
        F.transform("sets", lambda s: F.size(F.array_intersect(s, F.col("words"))) / F.size(s))
    )
    return compared.select("doc_id", "paragraph", "family", "probability", share.alias("similarity")).withColumn(
        "confirmed", F.col("similarity") >= p.confirmed_from
    )


def _calibration(aside: DataFrame, classes: int) -> tuple[float, float]:
    """Slope and shift from the margin to the log odds of being a licence."""
    known = aside.select("margin", (F.col("label") > 0).cast("double").alias("y"))
    seen = known.agg(F.count_distinct("y")).first()[0]
    if seen < 2 or classes < 2:
        return 1.0, 0.0
    vectors = known.select(F.call_function("array", "margin").alias("m"), "y")
    from pyspark.ml.functions import array_to_vector

    fitted = LogisticRegression(labelCol="y", featuresCol="x", regParam=1e-3).fit(
        vectors.select(array_to_vector("m").alias("x"), "y")
    )
    return float(fitted.coefficients[0]), float(fitted.intercept)

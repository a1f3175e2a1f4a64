"""License scans: a trained classifier of short units, an unknown class, and a comparison with templates, as DataFrame operations only.

Texts are cut into units, at line breaks and at sentence ends. Hashed word n-grams of a unit go into a multinomial logistic
regression over ordinary text, the families below, and unknown licences. Its features are the places of the n-grams of the fixed
texts below, so that all units of a corpus come down to far fewer vectors, and it is fitted on all of them, by their numbers.
Neighbouring units that it takes for licences make a passage, as notices are wrapped over lines, and a family is believed where
one of its templates is found in the passage.
"""

from __future__ import annotations

import json
import math

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.functions.settle import settle
from logloom.plans.scratch import saved

# Public notices by family; "unknown" has notices of no family.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Released under the BSD License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "SPDX-License-Identifier: BSD-2-Clause",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC-SA 4.0.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Licensed under the GNU General Public License, version 2 or later.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "SPDX-License-Identifier: GPL-2.0-only",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "unknown": [
        "All rights reserved.",
        "No part of this work may be copied without a license.",
        "This file is subject to the license agreement in the accompanying package.",
        "Use of this software is governed by the terms of its license.",
        "Licensed under the terms of the Example Vendor License, version 1.",
        "Released under a custom license.",
        "This code is licensed under the Sample Company License 2.1.",
        "This package is licensed under the Public Tool License.",
        "Distributed under the terms of the Data Users License, see the file COPYING for the full text.",
        "Licensed material, for evaluation only; redistribution is not permitted.",
        "You may use and copy these files under the license in the file LICENSE.",
    ],
}
# Sentences about licences that grant nothing.
TALK = [
    "The city council discussed the license of the new restaurant for an hour.",
    "She lost her driving license and asked the office for a copy.",
    "Copyright law was the subject of the lecture on Monday.",
    "He asked for permission to leave the room and was granted it.",
    "The museum owns the copyright of the photographs in its collection.",
    "Many projects chose a free license in those years, and others did not.",
    "The ministry may redistribute the money among the schools.",
    "A fishing license costs more than it did a year ago.",
    "The software was sold with a license for ten users.",
    "The judge said that the terms of the agreement were not clear.",
    "All seats in the front rows are reserved for guests.",
    "The foundation published a report on public libraries.",
    "Taxi drivers need permission of the town and a license of the state.",
    "Her essay compares how the licenses of large programs changed.",
    "The debate about copyright is still going on.",
    "Nobody knows who holds the copyright today.",
    "The company renewed its license and opened a second shop.",
    "The terms of use were changed twice last year.",
    "Our new car has no license plate yet.",
    "Is a license needed for a dog?",
    "Questions of copyright and of permission came up at the meeting.",
    "Files and software of this kind are used in many hospitals.",
]
TEXT = "text"
UNKNOWN = "unknown"
CLASSES = [TEXT, *sorted(TEMPLATES)]
FEATURES = 1 << 16
# The weight of all ordinary units together, at most; that of a fixed text is 20.
ORDINARY_WEIGHT = 4_000
LEAST_OVERLAP = 0.6
CANDIDATE, SURE = 0.5, 0.2
# One ordinary unit in so many may fall below the limit of candidates, and below that of unknown licences.
ONE_CANDIDATE_IN, ONE_UNKNOWN_IN = 1_000, 4_000
# Limits are powers of two to this part.
STEPS = 64
FRAMES = ["{}", "Note: {}", "Code and data: {}", "The files in this folder are {}", "{} (see the file LICENSE)"]
WIDTHS = (7, 10, 14)


def units(text: Column) -> Column:
    """Lines, and sentences of a line; empty strings stand for blank lines."""
    return F.split(F.coalesce(text, F.lit("")), r"\n|(?<=[.!?;:])[ \t]+(?=[A-Z(\x22])")


def _tokens(unit: Column) -> Column:
    """Lower-case runs of letters, digits and inner dots, plus signs and hyphens; none for a unit without any."""
    return F.array_remove(F.split(F.lower(unit), r"[^a-z0-9.+\-\x{80}-\x{10FFFF}]+|[.+\-]+(?![a-z0-9])"), "")


def _with_grams(df: DataFrame) -> DataFrame:
    """``words``, ``pairs`` and ``triples``: hashes of the column ``tokens`` (settled) and of its neighbours."""
    df = settle(df.withColumn("words", F.transform("tokens", lambda token: F.xxhash64(token))), "words")
    after = lambda n: F.slice("words", 1, F.greatest(F.size("words") - n, F.lit(0)))
    return df.withColumns({
        "pairs": F.transform(after(1), lambda h, i: F.xxhash64(h, F.get("words", i + 1))),
        "triples": F.transform(after(2), lambda h, i: F.xxhash64(h, F.get("words", i + 1), F.get("words", i + 2)))})


def _with_settled_grams(df: DataFrame) -> DataFrame:
    """All hashes of words, pairs and triples in the column ``grams``, computed once however often templates are compared with them."""
    return settle(_with_grams(df).withColumn("grams", F.concat("words", "pairs", "triples")).drop("words", "pairs", "triples"), "grams")


def _place(gram: Column) -> Column:
    """The number of a gram's feature, its hash modulo their number, a power of two; grams may share one."""
    return F.hash(gram).bitwiseAND(F.lit(FEATURES - 1))


def template_rows(spark) -> DataFrame:
    """family and the longest grams of every template, up to triples (``own``)."""
    rows = spark.createDataFrame([(family, text) for family, texts in TEMPLATES.items() for text in texts], "family string, unit string")
    rows = _with_grams(rows.withColumn("tokens", _tokens(F.col("unit"))))
    own = F.when(F.size("triples") > 0, F.col("triples")).when(F.size("pairs") > 0, F.col("pairs")).otherwise(F.col("words"))
    return rows.select("family", F.array_distinct(own).alias("own"))


def _families(spark) -> Column:
    """The families with the grams of their templates, as a constant; its size is that of the fixed templates."""
    rows = template_rows(spark).groupBy("family").agg(F.collect_list("own").alias("own"))
    kind = "array<struct<family: string, own: array<array<bigint>>>>"
    return F.from_json(F.lit(rows.agg(F.to_json(F.sort_array(F.collect_list(F.struct("family", "own"))))).first()[0]), kind)


def _overlap(templates: Column) -> Column:
    """The largest share of a template's grams that the column ``grams`` holds."""
    return F.coalesce(F.array_max(F.transform(templates, lambda own: F.size(F.array_intersect(own, F.col("grams"))) / F.size(own))), F.lit(0.0))


def _variants(text: str, frames: list[str]) -> list[str]:
    """The text between other words, and wrapped at some widths."""
    words = text.split(" ")
    wrapped = [words[i : i + width] for width in WIDTHS for i in range(0, len(words), width) if len(words) > width]
    return [frame.replace("{}", text) for frame in frames] + [" ".join(line) for line in wrapped if len(line) > 3]


def _fixed_units(spark) -> DataFrame:
    """grams, label and weight: variants of the templates and of talk about licences."""
    fixed = [(v, float(CLASSES.index(family)), 20.0) for family, texts in TEMPLATES.items() for text in texts for v in _variants(text, FRAMES)]
    fixed += [(v, 0.0, 20.0) for text in TALK for v in _variants(text, ["{}"])]
    rows = spark.createDataFrame(fixed, "unit string, label double, weight double")
    return _with_settled_grams(rows.withColumn("tokens", _tokens(F.col("unit"))))


def _fixed_grams(spark) -> DataFrame:
    """gram and place of all n-grams of the fixed units, which bound their number."""
    return _fixed_units(spark).select(F.explode("grams").alias("gram")).distinct().withColumn("place", _place(F.col("gram")))


def _one_of(places: list[int]):
    """A test whether a number is one of ``places``, by a constant table: one step for each gram of a corpus."""
    held = set(places)
    table = F.from_json(F.lit(json.dumps([int(place in held) for place in range(FEATURES)])), "array<tinyint>").cast("array<boolean>")
    return lambda place: F.get(table, place)


def unit_rows(documents: DataFrame) -> DataFrame:
    """doc_id, _t (hash of the text), number, unit and places (features, ascending) of every unit with a token.

    Units without any feature are all alike to the classifier; they have their hash ``_h`` only.
    """
    known = _one_of([row["place"] for row in _fixed_grams(documents.sparkSession).collect()])
    rows = documents.select("doc_id", F.xxhash64("text").alias("_t"), F.posexplode(units(F.col("text"))).alias("number", "unit")).where("unit != ''")
    cut = settle(rows.withColumn("tokens", _tokens(F.col("unit"))), "tokens").where(F.size("tokens") > 0)
    found = F.filter(F.concat("words", "pairs", "triples"), lambda gram: known(_place(gram)))
    placed = settle(_with_grams(cut).withColumn("places", F.array_sort(F.array_distinct(F.transform(found, _place)))), "places")
    some = F.size("places") > 0
    return placed.select(*[F.when(some, F.col(name)).alias(name) for name in ("doc_id", "_t", "number", "unit")], "places",
                         F.when(~some, F.xxhash64("unit")).alias("_h"))


def _featured(rows: DataFrame) -> DataFrame:
    """A vector of ones at the ``places``: they are hashed anew, each from one gram of the fixed texts that has it."""
    fixed = _fixed_grams(rows.sparkSession).groupBy("place").agg(F.min("gram").alias("gram")).collect()
    gram_of = {row["place"]: row["gram"] for row in fixed}
    held = F.from_json(F.lit(json.dumps([gram_of.get(place, 0) for place in range(FEATURES)])), "array<bigint>")
    grams = rows.withColumn("_grams", F.transform("places", lambda place: F.get(held, place)))
    return HashingTF(numFeatures=FEATURES, inputCol="_grams", outputCol="features", binary=True).transform(grams).drop("_grams")


def ordinary_vectors(rows: DataFrame) -> DataFrame:
    """places, and the number n of distinct units that have them, over all rows but those near a template.

    Near is a unit with at least ``LEAST_OVERLAP`` of a template's places, one of them of the template's longest grams.
    """
    spark = rows.sparkSession
    texts = spark.createDataFrame([(text,) for texts in TEMPLATES.values() for text in texts], "unit string")
    grams = _with_settled_grams(texts.withColumn("tokens", _tokens(F.col("unit"))))
    templates = [row[0] for row in grams.select(F.array_distinct(F.transform("grams", _place))).collect()]
    longest = _one_of([row[0] for row in template_rows(spark).select(F.explode(F.transform("own", _place))).collect()])
    held = F.from_json(F.lit(json.dumps(templates)), "array<array<int>>")
    near = F.when(F.exists("places", longest), F.exists(held, lambda t: F.size(F.array_intersect(t, F.col("places"))) >= LEAST_OVERLAP * F.size(t))).otherwise(False)
    distinct = rows.select("places", F.coalesce("_h", F.xxhash64("unit")).alias("_h")).distinct()
    return settle(distinct.groupBy("places").agg(F.count(F.lit(1)).alias("n")).withColumn("_near", near), "_near").where(~F.col("_near")).drop("_near")


def below_limit(model: LogisticRegressionModel, limit: float) -> Column:
    """Whether the probability of being ordinary, given ``places``, may be below the limit: true wherever it is, false for most other units.

    The odds of a licence are a sum over its classes. They grow, with each place, by no more than the largest lead that a class has there.
    """
    if not 0 < limit < 1:
        return F.lit(limit >= 1)
    intercepts, coefficients = model.interceptVector.toArray(), model.coefficientMatrix.toArray()
    lead = (coefficients[1:] - coefficients[0]).max(axis=0)
    least = math.log(1 / limit - 1) - math.log(sum(math.exp(i - intercepts[0]) for i in intercepts[1:]))
    leads = F.from_json(F.lit(json.dumps([value or 0 for value in lead.tolist()])), "array<double>")
    return F.aggregate("places", F.lit(0.0), lambda total, place: total + F.get(leads, place)) > least - 1e-6  # far more than rounding


def _limit(below: list[tuple[int, int]], allowed: int, most: float) -> float:
    """The highest step, ``most`` at most, below which there are no more than ``allowed`` units; ``below`` has their numbers by step."""
    for step, n in below:
        if n > allowed:
            return min(most, 2 ** (step / STEPS))
        allowed -= n
    return most


def fit_classifier(rows: DataFrame) -> tuple[LogisticRegressionModel, float, float]:
    """``train_classifier`` for the rows of ``unit_rows``, which are read once."""
    spark = rows.sparkSession
    vectors = saved(ordinary_vectors(rows), "license-vectors")
    n = vectors.agg(F.sum("n")).first()[0] or 0
    share = min(1.0, ORDINARY_WEIGHT / max(n, 1))
    fixed = _fixed_units(spark).select(F.array_sort(F.array_distinct(F.transform("grams", _place))).alias("places"), "label", "weight")
    fitted = fixed.unionByName(vectors.select("places", F.lit(0.0).alias("label"), (F.col("n") * share).alias("weight")))
    parts = max(4, spark.sparkContext.defaultParallelism)  # each sends a gradient per step
    model = LogisticRegression(weightCol="weight", regParam=1e-3, maxIter=40, family="multinomial").fit(
        _featured(fitted).select("features", "label", "weight").coalesce(parts))
    plain = settle(model.transform(_featured(vectors.where(below_limit(model, CANDIDATE)))).withColumn("_p", vector_to_array("probability")[0]), "_p").where(F.col("_p") < CANDIDATE)
    step = F.floor(F.log2(F.greatest("_p", F.lit(1e-300))) * STEPS).cast("int")
    below = [tuple(row) for row in plain.groupBy(step.alias("step")).agg(F.sum("n").alias("n")).orderBy("step").collect()]  # 64,000 steps at most
    # Units without features are never candidates.
    intercepts = model.interceptVector.toArray()
    empty = math.exp(intercepts[0] - intercepts.max()) / sum(math.exp(i - intercepts.max()) for i in intercepts)
    limit = min(_limit(below, n // ONE_CANDIDATE_IN, CANDIDATE), empty)
    return model, limit, min(limit, _limit(below, n // ONE_UNKNOWN_IN, SURE))


def train_classifier(documents: DataFrame) -> tuple[LogisticRegressionModel, float, float]:
    """The classifier, and two limits for the probability of being ordinary: of candidates, and of unknown licences.

    It is fitted on the variants and all distinct ordinary units of the corpus, which together weigh ``ORDINARY_WEIGHT`` at most. All of
    them calibrate the limits. Below the first, never over ``CANDIDATE``, a unit is compared with templates; at most one ordinary unit in
    1,000 falls below it. A passage that no template confirms is an unknown licence only if a unit falls below the second, which is never
    over ``SURE`` and below which at most one ordinary unit in 4,000 falls.
    """
    return fit_classifier(saved(unit_rows(documents), "license-units"))


def license_passages(documents: DataFrame, model: LogisticRegressionModel, limit: float, unknown_limit: float, least_overlap: float = LEAST_OVERLAP) -> DataFrame:
    """doc_id, start (number of its first unit), n_units, text, family, probability (of a licence), overlap, for each passage and each of its families.

    A passage is a run of units found to be licences, without a blank line between them. ``overlap`` is the largest share of a
    template's word triples (pairs or single words, for shorter templates) that the passage holds, over the templates of the family.
    The families are those that the classifier names for a unit and that ``least_overlap`` confirms; a passage without one is
    ``unknown`` or none. Rows equal in doc_id and text count once.
    """
    return passages_of_units(unit_rows(documents), model, limit, unknown_limit, least_overlap)


def passages_of_units(rows: DataFrame, model: LogisticRegressionModel, limit: float, unknown_limit: float, least_overlap: float = LEAST_OVERLAP) -> DataFrame:
    """``license_passages`` for the rows of ``unit_rows``. Units that cannot be below the limit are not scored."""
    spark = rows.sparkSession
    maybe = rows.where(F.size("places") > 0).where(below_limit(model, limit))
    scored = settle(model.transform(_featured(maybe)).withColumn("_p", vector_to_array("probability")), "_p")
    best = F.array_position("_p", F.array_max(F.slice("_p", 2, len(CLASSES)))).cast("int")
    found = scored.where(F.col("_p")[0] < limit).select(
        "doc_id", "_t", "number", "unit", _tokens(F.col("unit")).alias("tokens"), F.col("_p")[0].alias("_plain"), F.element_at(F.array(*[F.lit(c) for c in CLASSES]), best).alias("family"))
    found = found.dropDuplicates(["doc_id", "_t", "number"])
    found = found.withColumn("_run", F.col("number") - F.row_number().over(Window.partitionBy("doc_id", "_t").orderBy("number")))
    runs = found.groupBy("doc_id", "_t", "_run").agg(
        F.array_sort(F.collect_list(F.struct("number", "unit", "tokens"))).alias("_units"), F.collect_set("family").alias("_named"), F.min("_plain").alias("_plain"))
    passages = _with_settled_grams(runs.select("doc_id", "_units", "_named", "_plain", F.flatten(F.col("_units.tokens")).alias("tokens")))
    confirmed = F.transform(F.filter(_families(spark), lambda f: (f["family"] != UNKNOWN) & F.array_contains("_named", f["family"])), lambda f: F.struct(
        f["family"].alias("family"), _overlap(f["own"]).alias("overlap")))
    confirmed = F.filter(confirmed, lambda f: f["overlap"] >= least_overlap)
    compared = settle(passages.withColumn("_confirmed", confirmed), "_confirmed")
    unknown = F.when(F.col("_plain") < unknown_limit, F.array(F.struct(F.lit(UNKNOWN).alias("family"), F.lit(0.0).alias("overlap"))))
    families = F.when(F.size("_confirmed") > 0, F.col("_confirmed")).otherwise(unknown)
    return compared.select("doc_id", "_units", "_plain", F.explode(families).alias("f")).select(
        "doc_id", F.col("_units")[0]["number"].alias("start"), F.size("_units").alias("n_units"), F.array_join("_units.unit", " ").alias("text"),
        "f.family", (1 - F.col("_plain")).alias("probability"), "f.overlap")


def scan_licenses(documents: DataFrame) -> DataFrame:
    """doc_id, licenses (families found, sorted, comma-joined, empty for none), n_licenses (passages and their families), n_unknown, a row per row.

    Null, empty and blank texts have none. Rows that share a doc_id (or have none) get what was found in all of them; equal texts among them count once.
    """
    rows = saved(unit_rows(documents), "license-units")
    found = passages_of_units(rows, *fit_classifier(rows))
    per_doc = found.groupBy(F.col("doc_id").alias("_id")).agg(
        F.array_join(F.array_sort(F.collect_set("family")), ",").alias("licenses"), F.count(F.lit(1)).alias("n_licenses"),
        F.count(F.when(F.col("family") == UNKNOWN, 1)).alias("n_unknown"))
    joined = documents.select("doc_id").join(per_doc, F.col("doc_id").eqNullSafe(F.col("_id")), "left").drop("_id")
    return joined.select("doc_id", F.coalesce("licenses", F.lit("")).alias("licenses"), F.coalesce("n_licenses", F.lit(0)).cast("long").alias("n_licenses"),
                         F.coalesce("n_unknown", F.lit(0)).cast("long").alias("n_unknown"))

"""License scans: a trained paragraph classifier with an unknown class, confirmed by comparison with templates.

DataFrame operations and Spark's own JVM learner only. A paragraph (a run of lines with words) and each of its lines
is read in the windows of ``WINDOWS``
(words, step): long ones for whole notices, short ones so that the text around a short notice does not hide it. Features are the word 1- and 2-grams that occur in the training notices, so a window without any notice word is unknown by
its features alone and is not scored further. A multinomial logistic regression gives the family; its probabilities are calibrated by
a temperature fitted on held-out samples (which the fit has seen of the notices: an open point). A family is reported when its calibrated probability is high enough, the window has a
telling 2-gram of the family (one of at most ``KIN`` families and of no ordinary line), and enough 2-grams of the smaller of window and
template are in the other.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lineage_spark.llm.common import hash_sample
from lineage_spark.session import cut_lineage

WINDOWS = ((40, 20), (12, 6))
WINDOW_WORDS = WINDOWS[0][0]
KIN = 3  # the GNU licenses share their words, and so do those of Creative Commons
LEAST_BIGRAMS = 3  # a window of fewer 2-grams counts as so many, unless the template itself is shorter
MIN_PROBABILITY, MIN_SIMILARITY = 0.6, 0.5
ORDINARY_LINES = 3000
TEMPERATURES = (0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 4.0)
UNKNOWN = "unknown"

# fixed values: notices of each license family, as their authors publish or recommend them
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license. See the LICENSE file in the project root for full license information.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    "Apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements.",
    ),
    "BSD": (
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer.",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "Released under the GNU GPL version 2.",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-only",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation.",
    ),
    "AGPL": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    ),
    "MPL": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "CC-BY-SA": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ),
    "CC-BY-NC": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "CC0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Released under CC0 1.0 Universal.",
        "SPDX-License-Identifier: CC0-1.0",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Released under the Unlicense.",
        "SPDX-License-Identifier: Unlicense",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
        "Licensed under the ISC License.",
        "SPDX-License-Identifier: ISC",
    ),
    "proprietary": (
        "All rights reserved. No part of this publication may be reproduced without the prior written permission of the publisher.",
        "This software is proprietary and confidential. Unauthorized copying of this file is strictly prohibited.",
    ),
}
# fixed values: short notices, which often stand alone
SHORT_NOTICES = {
    "MIT": ("MIT License", "The MIT License (MIT)",),
    "Apache": ("Apache License", "Apache License, Version 2.0", "Apache-2.0",),
    "BSD": ("BSD License", "BSD 2-Clause License", "BSD 3-Clause License",),
    "GPL": ("GNU General Public License", "GNU GPL", "GPL-3.0",),
    "LGPL": ("GNU Lesser General Public License", "GNU LGPL", "LGPL-2.1",),
    "AGPL": ("GNU Affero General Public License", "GNU AGPL", "AGPL-3.0",),
    "MPL": ("Mozilla Public License", "MPL 2.0",),
    "CC-BY": ("CC BY 4.0", "Creative Commons Attribution 4.0",),
    "CC-BY-SA": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0",),
    "CC-BY-NC": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0",),
    "CC0": ("CC0 1.0", "CC0 1.0 Universal",),
    "Unlicense": ("The Unlicense",),
    "ISC": ("ISC License",),
    "proprietary": ("All rights reserved.", "Proprietary and confidential.",),
}
# fixed values: sentences with license words that name no license
NOT_LICENSES = (
    "The driver showed a license plate and a driving license to the officer.",
    "A fishing license costs ten dollars a year in this state.",
    "The public library is free for every person in the city.",
    "The general version of this work was published in the copy of the software manual.",
    "Version 3 of the software was released under pressure by the foundation.",
    "You may not use the following file without the author.",
    "He took artistic license with the source of the notice.",
    "See the file for more information about the project and the terms of use.",
)

_WORDS = r"[\p{L}\p{N}]+"
_MARK = r"(?i)^\s*(?:rem|dnl)\b"  # comment marks that are words
_MARKS = r"(?im)^[^\S\n]*(?:rem|dnl)\b"  # the same on every line of a text


def _with_words(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn("words", F.regexp_extract_all(F.lower(text), F.lit(_WORDS), F.lit(0)))


def _bigrams(words):
    n = F.size(words)
    return F.zip_with(F.slice(words, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(words, F.lit(2), F.greatest(n - 1, F.lit(0))),
                      lambda a, b: F.concat_ws(" ", a, b))


def _slices(n: int, step: int):
    """The windows of ``n`` words that cover ``words``, each with the line numbers ``ats`` of its words."""
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - step), F.lit(step))
    return F.transform(starts, lambda i: F.struct(F.slice("words", i, n).alias("words"), F.slice("ats", i, n).alias("ats")))


def _grams(words):
    """Distinct word 1- and 2-grams."""
    return F.array_distinct(F.concat(words, _bigrams(words)))


def templates(spark: SparkSession) -> DataFrame:
    """``family, template, words`` of the notices."""
    rows = [(family, i, t) for family, texts in TEMPLATES.items() for i, t in enumerate(texts + SHORT_NOTICES[family])]
    return _with_words(spark.createDataFrame(rows, "family string, template int, text string")).drop("text")


def samples(spark: SparkSession, docs: DataFrame, text: str = "text", key: str = "doc_id", max_lines: int = ORDINARY_LINES) -> DataFrame:
    """Labelled samples ``family, words, ordinary`` (a line of ``docs``): notices, their cuttings of 5 to 24 words, sentences that name no license, and at most
    ``max_lines`` lines of ``docs`` (of smallest hash of id and line number) without the words of a notice."""
    notices = templates(spark)
    cuttings = notices.where(F.size("words") > 5).select("family", F.explode(F.flatten(F.transform(
        F.array(*[F.lit(n) for n in (5, 8, 12, 24)]),
        lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - n + 1), F.lit(3)), lambda i: F.slice("words", i, n))
    ))).alias("words"))
    # a cutting must still say whose notice it is: one of the family's own words
    own = notices.select("family", F.explode("words").alias("w")).distinct().groupBy("w").agg(
        F.count(F.lit(1)).alias("n"), F.min("family").alias("family")).where("n <= 2").groupBy().agg(F.collect_set("w").alias("own"))
    telling = [r for r in own.first()["own"]]  # words of the fixed notices
    cuttings = cuttings.where(F.arrays_overlap("words", F.array(*[F.lit(w) for w in sorted(telling)])))
    named = _with_words(spark.createDataFrame([(UNKNOWN, t) for t in NOT_LICENSES], "family string, text string")).drop("text")
    lines = docs.select(docs[key].alias("key"), F.posexplode(F.split(docs[text], "\n")).alias("at", "text"))
    plain = lines.where((F.length("text") > 20) & ~F.lower("text").rlike("licen|copyright|spdx|rights reserved|public domain|permission"))
    plain = hash_sample(plain, max_lines, F.col("key"), F.col("at")).select("text")
    ordinary = _with_words(plain).select(F.lit(UNKNOWN).alias("family"), F.slice("words", 1, WINDOW_WORDS).alias("words"))
    written = notices.select("family", "words").union(cuttings).union(named).withColumn("ordinary", F.lit(False))
    return written.union(ordinary.withColumn("ordinary", F.lit(True))).where(F.size("words") > 0).distinct()


@dataclass
class LicenseModel:
    """Families, the weight of every (gram, family), the families' intercepts, the temperature, the telling 2-grams, and the words that call
    for scoring (one of each telling 2-gram)."""

    families: list[str]
    weights: list[tuple[str, list[float]]]
    intercepts: list[float]
    temperature: float
    telling: list[str]
    cues: list[str]


def _logits(scored_words: DataFrame, model: LicenseModel, keys: list[str]) -> DataFrame:
    """``keys`` and ``logits`` (array by family) of rows with ``words``: a join of their grams with the weights."""
    spark = scored_words.sparkSession
    table = F.broadcast(spark.createDataFrame(model.weights, "gram string, w array<double>"))  # grams of the fixed notices
    grams = scored_words.select(*keys, F.explode(_grams(F.col("words"))).alias("gram"))
    n = len(model.families)
    sums = grams.join(table, "gram", "left").groupBy(*keys).agg(
        *[F.coalesce(F.sum(F.get("w", F.lit(i))), F.lit(0.0)).alias(f"s{i}") for i in range(n)])
    return sums.select(*keys, F.array(*[F.col(f"s{i}") + F.lit(model.intercepts[i]) for i in range(n)]).alias("logits"))


def _softmax(logits, temperature):
    top = F.array_max(logits)
    e = F.transform(logits, lambda x: F.exp((x - top) / temperature))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, y: a + y))


def train(labelled: DataFrame, notices: DataFrame) -> LicenseModel:
    """Fit on ``family, words, ordinary`` rows; every fifth (by hash) is held out of the fit and sets the temperature."""
    rows = cut_lineage(labelled.select("family", "words", "ordinary", _grams(F.col("words")).alias("grams"),
                                       (F.pmod(F.xxhash64("words"), F.lit(5)) == 0).alias("held")))
    vocabulary = cut_lineage(notices.select(_grams(F.col("words")).alias("grams")))
    vectors = CountVectorizer(inputCol="grams", outputCol="features", binary=True).fit(vocabulary)
    families = sorted(TEMPLATES) + [UNKNOWN]
    place = F.array_position(F.array(*[F.lit(f) for f in families]), F.col("family")) - 1
    # classes differ in size: every family weighs the same, the unknown class as much as all families
    sizes = {r["family"]: r["count"] for r in rows.groupBy("family").count().collect()}  # one row per family
    share = {f: (len(TEMPLATES) if f == UNKNOWN else 1.0) / sizes.get(f, 1) for f in families}
    weight = F.get(F.array(*[F.lit(share[f]) for f in families]), place.cast("int"))
    data = vectors.transform(rows.where("not held or family <> 'unknown'").withColumn("label", place.cast("double")).withColumn("weight", weight))
    fit = LogisticRegression(family="multinomial", regParam=0.002, maxIter=60, weightCol="weight").fit(data)
    matrix = fit.coefficientMatrix.toArray()
    weights = [(g, [float(v) for v in matrix[:, i]]) for i, g in enumerate(vectors.vocabulary)]
    ordinary = rows.where("family = 'unknown'").select(F.explode("grams").alias("g")).groupBy("g").count()
    common = {r["g"]: r["count"] for r in ordinary.collect()}  # grams of the bounded sample's lines and of the fixed sentences
    named = notices.select("family", F.explode(_bigrams(F.col("words"))).alias("g")).distinct().groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    telling = sorted({r["g"] for r in named.where(F.col("n") <= KIN).collect()} - set(common))  # 2-grams of the fixed notices
    # a window is reported only with a telling 2-gram, so the rarer word of each is a necessary condition, and cheap to test
    cues = {min(reversed(g.split(" ")), key=lambda w: common.get(w, 0)) for g in telling}
    model = LicenseModel(families, weights, [float(v) for v in fit.interceptVector], 1.0, telling, sorted(cues))
    held = rows.where("held").withColumn("row", F.monotonically_increasing_id())
    held = cut_lineage(held.select("row", "words", place.cast("int").alias("label")))
    scored = _logits(held.select("row", "words"), model, ["row"]).join(held.select("row", "label"), "row")
    losses = scored.agg(*[F.avg(-F.log(F.greatest(F.get(_softmax(F.col("logits"), F.lit(t)), F.col("label")), F.lit(1e-12)))).alias(f"t{i}")
                          for i, t in enumerate(TEMPERATURES)]).first()
    best = min((loss, t) for loss, t in zip(losses, TEMPERATURES)) if losses[0] is not None else (0.0, 1.0)
    model.temperature = best[1]
    return model


def find_licenses(docs: DataFrame, model: LicenseModel, notices: DataFrame, text: str = "text", key: str = "doc_id",
                  min_probability: float = MIN_PROBABILITY, min_similarity: float = MIN_SIMILARITY) -> DataFrame:
    """``key, paragraph, family, probability, similarity``: one row per license notice.

    ``paragraph`` is the number from 0 of the line in which the notice starts. A paragraph is a run of lines with words (comment marks are no
    words), so that a notice wrapped over several lines is one notice; notices of their own on neighbouring lines are rows each. Of a long
    notice the most similar window counts. Null and empty texts have no notice; repeated rows give rows each; other columns are ignored.
    """
    cues, telling = (F.array(*[F.lit(x) for x in xs]) for xs in (model.cues, model.telling))
    told = docs.select(docs[key].alias("key"), docs[text].alias("t"))
    # only documents with a telling 2-gram are written; the cue words come first as they cost less
    told = _with_words(told.withColumn("plain", F.regexp_replace("t", _MARKS, "")), "plain").where(F.arrays_overlap("words", cues))
    told = told.where(F.arrays_overlap(_bigrams(F.col("words")), telling)).select("key", "t")
    told = cut_lineage(told.withColumn("row", F.monotonically_increasing_id()))
    lines = told.select("row", "key", F.posexplode(F.split("t", "\n")).alias("at", "text"))
    lines = _with_words(lines.withColumn("text", F.regexp_replace("text", _MARK, ""))).drop("text").where(F.size("words") > 0)
    # without the blank lines, the lines of a paragraph have one difference of line number and rank; all lines of a row come from one text
    rank = F.row_number().over(Window.partitionBy("row").orderBy("at"))
    lines = lines.withColumn("run", F.col("at") - rank).withColumn("ats", F.array_repeat("at", F.size("words")))
    runs = lines.groupBy("row", "key", "run").agg(F.sort_array(F.collect_list(F.struct("at", "words", "ats"))).alias("ls"))
    runs = cut_lineage(runs.withColumn("words", F.flatten("ls.words")).where(F.arrays_overlap(_bigrams(F.col("words")), telling)))
    joined = runs.where(F.size("ls") > 1).select("row", "key", "run", "words", F.flatten("ls.ats").alias("ats"))
    alone = runs.select("row", "key", "run", F.explode("ls").alias("l")).select("row", "key", "run", "l.words", "l.ats")
    slices = F.array_distinct(F.concat(*[_slices(n, step) for n, step in WINDOWS]))
    windows = joined.union(alone).select("row", "key", "run", F.explode(slices).alias("w")).select("row", "key", "run", "w.words", "w.ats")
    windows = windows.withColumn("grams2", _bigrams(F.col("words"))).where(F.arrays_overlap("grams2", telling))
    windows = cut_lineage(windows.withColumn("window", F.monotonically_increasing_id()))
    scores = _logits(windows, model, ["window"])
    p = _softmax(F.col("logits"), F.lit(model.temperature))
    family = F.get(F.array(*[F.lit(f) for f in model.families]), (F.array_position("p", F.array_max("p")) - 1).cast("int"))
    likely = scores.withColumn("p", p).select("window", family.alias("family"), F.array_max("p").alias("probability")) \
        .where((F.col("family") != UNKNOWN) & (F.col("probability") >= min_probability))
    known = notices.select("family", "template", F.array_distinct(_bigrams(F.col("words"))).alias("known"))
    shared = windows.join(likely, "window").withColumn("own", F.array_distinct("grams2")).join(F.broadcast(known), "family") \
        .withColumn("shared", F.array_intersect("own", "known")).where(F.arrays_overlap("shared", telling))
    compared = shared.withColumn(
        "similarity", F.size("shared") / F.least(F.size("known"), F.greatest(F.size("own"), F.lit(LEAST_BIGRAMS))))
    hits = compared.where(F.col("similarity") >= min_similarity)
    return _notices_of(hits, telling).select("key", F.col("line").cast("long").alias("paragraph"), "best.family", "best.probability", "best.similarity")


def _notices_of(hits: DataFrame, telling) -> DataFrame:
    """``key, line, best``: the notices that the ``hits`` (a window and a template like it) are parts of, by their first line."""
    # the shared 2-grams, those that stand by themselves only if they are telling
    at = F.transform("grams2", lambda g: F.array_contains("shared", g))
    marks = F.zip_with("grams2", at, lambda g, m: F.struct(g.alias("g"), m.alias("m")))
    here = F.transform(marks, lambda x, i: F.struct(
        F.get("ats", i).alias("line"), F.get("ats", i + 1).alias("next"),
        F.array_contains(telling, x["g"]).alias("tells"),
        ((F.element_at("known", 1) == x["g"]) & ((i == 0) | (F.get("ats", i - 1) != F.get("ats", i)))).alias("opens"),
        (x["m"] & (F.array_contains(telling, x["g"]) | F.coalesce(F.get(at, i - 1), F.lit(False)) | F.coalesce(F.get(at, i + 1), F.lit(False))))
        .alias("counts")))
    keep = ["row", "key", "run", "family", "window", "template", "similarity", "probability", "n"]
    grams = hits.withColumn("n", F.size("shared")).select(*keep, F.explode(here).alias("h")).where("h.counts")
    first = grams.select(*keep, F.col("h.line").alias("line"), "h.tells", "h.opens", F.lit(False).alias("linked"),
                         (F.col("h.line") != F.col("h.next")).alias("links"))
    second = grams.where("h.line <> h.next").select(*keep, F.col("h.next").alias("line"), F.lit(False).alias("tells"), F.lit(False).alias("opens"),
                                                    F.lit(True).alias("linked"), F.lit(False).alias("links"))
    # a line belongs to the family whose template it shares most with, and counts if it tells or a shared 2-gram joins it to its neighbour
    flags = [F.max(c).alias(c) for c in ("tells", "opens", "linked", "links")]
    lines = first.union(second).groupBy(*keep, "line").agg(F.count(F.lit(1)).alias("here"), *flags)
    lines = lines.groupBy("row", "key", "run", "line", "family").agg(
        F.max(F.struct("here", "n", "similarity", "probability")).alias("most"), F.max(F.struct("similarity", "probability", "family")).alias("best"), *flags)
    lines = lines.where("tells or linked or links").groupBy("row", "key", "run", "line").agg(
        F.max(F.struct("most", "family", "best", "tells", "opens", "linked")).alias("x")).select("row", "key", "run", "line", "x.*")
    # the next line goes on with a notice unless it opens one
    order = Window.partitionBy("row", "run").orderBy("line")
    before = F.lag(F.struct("line", "family")).over(order)
    goes_on = (before["line"] == F.col("line") - 1) & (before["family"] == F.col("family")) & (F.col("linked") | ~F.col("opens"))
    lines = lines.withColumn("starts", (~F.coalesce(goes_on, F.lit(False))).cast("int"))
    lines = lines.withColumn("notice", F.sum("starts").over(order))
    return lines.groupBy("row", "key", "run", "notice").agg(
        F.min("line").alias("line"), F.max("best").alias("best"), F.max("tells").alias("tells")).where("tells")

"""Licence notices: a trained paragraph classifier, confirmed by comparison with templates."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.llm.common import stored, table
from stratalake.llm.registry import query

UNKNOWN = "unknown"

#: Notices of licence families, as their stewards word them; fixed values.
NOTICES = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or "
        "(at your option) any later version.",
    ),
    "LGPL-3.0": (
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
    ),
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License",
    ),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
    ),
    "MPL-2.0": (
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC0-1.0": (
        "Licensed under CC0 1.0.",
        "This work has been dedicated to the public domain under the CC0 1.0 Universal license.",
    ),
    "ISC": (
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted",
    ),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
    "All rights reserved": (
        "Copyright. All rights reserved.",
        "No part of this publication may be reproduced without the prior written permission of the copyright holder.",
    ),
}

#: Short names of the families, and their SPDX identifiers; fixed values.
SHORT_NAMES = {
    "MIT": ("the MIT licence", "MIT"),
    "Apache-2.0": ("Apache 2.0", "Apache-2.0"),
    "GPL-3.0": ("the GNU GPL v3", "GPL-3.0"),
    "GPL-2.0": ("the GNU GPL v2", "GPL-2.0"),
    "LGPL-3.0": ("the GNU LGPL v3", "LGPL-3.0"),
    "AGPL-3.0": ("the GNU AGPL v3", "AGPL-3.0"),
    "BSD-3-Clause": ("the BSD 3-Clause License", "BSD-3-Clause"),
    "MPL-2.0": ("MPL 2.0", "MPL-2.0"),
    "CC-BY-4.0": ("CC BY 4.0", "CC-BY-4.0"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "CC-BY-SA-4.0"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "CC-BY-NC-4.0"),
    "CC0-1.0": ("CC0 1.0", "CC0-1.0"),
    "ISC": ("the ISC license", "ISC"),
    "Unlicense": ("the Unlicense", "Unlicense"),
}
VERBS = ("Licensed", "Released", "Distributed")


def _templates() -> dict[str, tuple[str, ...]]:
    """The notices, and the short forms of each family that they do not hold yet."""
    found = {}
    for family, notices in NOTICES.items():
        name, spdx = SHORT_NAMES.get(family, (None, None))
        short = [f"{verb} under {name}." for verb in VERBS] + [f"SPDX-License-Identifier: {spdx}"] if name else []
        low = {n.lower() for n in notices}
        found[family] = (*notices, *(t for t in short if t.lower() not in low))
    return found


TEMPLATES = _templates()

#: Every template has one of these in a fifth of its shingles or more; a text with none matches no template.
TELLING = (
    "licen", "copyright", "permission", "redistribut", "software", "modif", "public domain", "released under",
    "distributed under",
)

#: Hashed features, and steps of the probability by which the threshold is set.
FEATURES = 1 << 14
STEPS = 1 << 16
#: Share of unknown paragraphs that the calibrated threshold lets through at most.
FALSE_SHARE = 0.01
#: Steps in which the tasks sum up a gradient: the driver gets some n^(1/4) sums of n tasks, each as large as the model.
DEPTH = 4
#: Words of a window, and from one window to the next: what is up to 48 words long lies whole in one of them.
WINDOW = 64
STEP = 16


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))


def grams(words: Column, n: int) -> Column:
    """The distinct word n-grams; the whole sequence if it is shorter, none if it is empty."""
    many = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(words) - n + 1, F.lit(1))),
        lambda i: F.array_join(F.slice(words, i, n), " "),
    )
    return F.array_distinct(F.when(F.size(words) > 0, many).otherwise(F.array().cast("array<string>")))


def _features(words: Column) -> Column:
    return F.array_union(grams(words, 1), F.array_union(grams(words, 2), grams(words, 3)))


def _may_match(text: Column) -> Column:
    low = F.lower(text)
    # The words of a telling phrase may be on two lines.
    phrases = "|".join(t.replace(" ", r"\W+") for t in TELLING if " " in t)
    one = [F.contains(low, F.lit(t)) for t in TELLING if " " not in t]
    return F.coalesce(reduce(or_, [*one, F.rlike(low, F.lit(phrases))]), F.lit(False))


def _once(rows: DataFrame, **columns: Column) -> DataFrame:
    """The rows with columns that are computed once a row: a lambda would repeat what a projection holds."""
    return rows.select("*", F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))


def template_rows(spark: SparkSession, templates: dict[str, tuple[str, ...]] = TEMPLATES) -> DataFrame:
    rows = [(family, text) for family, texts in templates.items() for text in texts]
    return spark.createDataFrame(rows, "family string, template string").withColumn("words", words_of(F.col("template")))


def paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The lines of every document, numbered from 0."""
    lines = F.posexplode(F.split(F.col(text_col), r"\R")).alias("paragraph", "line")
    return docs.select(F.col(id_col).alias("doc_id"), lines)


class LicenseModel:
    """Sparse logistic regression over hashed word n-grams, and the threshold of its unknown class."""

    def __init__(self, classifier: LogisticRegressionModel, families: list[str], threshold: float) -> None:
        self.classifier, self.families, self.threshold = classifier, families, threshold

    def predict(self, rows: DataFrame) -> DataFrame:
        """``family`` and ``probability`` of the likeliest family of each row with ``words``, ``chances`` of all."""
        hashed = HashingTF(inputCol="grams", outputCol="features", numFeatures=FEATURES, binary=True)
        scored = self.classifier.transform(hashed.transform(rows.withColumn("grams", _features(F.col("words")))))
        chances = F.slice(vector_to_array("probability"), 1, len(self.families))
        best = F.array_max(chances)
        named = F.array(*map(F.lit, self.families))[(F.array_position(chances, best) - 1).cast("int")]
        return scored.withColumn("_p", best).withColumn(
            "family", F.when(F.col("_p") >= self.threshold, named).otherwise(UNKNOWN)
        ).withColumnRenamed("_p", "chance").select(*rows.columns, "family", F.col("chance").alias("probability"), chances.alias("chances"))


def fit_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LicenseModel:
    """A classifier of the templates' families and of what is none of them, learned from all documents.

    Known rows are the templates, each with every single word left out and cut short, and a template between the first
    and last words of each unknown window; unknown ones are all windows of the documents that have a telling word but
    no shingle of any template, and small pieces of templates. Text without a telling word is never classified, and
    so not learned from. A fifth of the rows, by hash, and half of these windows are left out to calibrate: a family is named only
    from the probability on that all but ``FALSE_SHARE`` of such windows left out stay below (of all unknown rows,
    where there is no such window).
    """
    spark = docs.sparkSession
    strays = _once(windows(docs, id_col, text_col), held=_held(F.col("words"), *_wanted(TEMPLATES, 5)))
    # Equal windows are one.
    strays = stored(strays.where("size(held) = 0").select("words").distinct(), "license-strays")
    templates = template_rows(spark).select("family", "words")
    size = F.size("words")
    at = templates.withColumn("j", F.explode(F.sequence(F.lit(0), size - 1)))
    without = at.select("family", F.concat(F.slice("words", F.lit(1), F.col("j")), F.slice("words", F.col("j") + 2, size)).alias("words"))
    short = at.where(F.col("j") >= 0.7 * size).select("family", F.slice("words", F.lit(1), F.col("j") + 1).alias("words"))
    # One row with all templates: a constant of this module. Each window gets one of them, by its hash.
    every = templates.agg(F.sort_array(F.collect_list(F.struct("family", "words"))).alias("every"))
    nth = F.pmod(F.xxhash64("words", F.lit(7)), F.size("every")).cast("int")
    set_in = strays.crossJoin(F.broadcast(every)).withColumn("t", F.get("every", nth))
    around = (F.slice("words", 1, 8), F.col("t.words"), F.slice("words", -F.least(F.lit(4), size), F.lit(4)))
    between = set_in.select("t.family", F.concat(*around).alias("words"))
    quarter = F.greatest(F.lit(1), F.floor(size / 4)).cast("int")
    pieces = at.select(F.lit(UNKNOWN).alias("family"), F.slice("words", F.col("j") + 1, quarter).alias("words")).where(F.size("words") <= 3)
    known = templates.unionByName(without).unionByName(short).unionByName(between)
    known, unknown = (part.withColumn("stray", F.lit(False)) for part in (known, pieces))
    unknown = unknown.unionByName(strays.select(F.lit(UNKNOWN).alias("family"), "words", F.lit(True).alias("stray")))
    families = sorted(TEMPLATES)
    label = F.array_position(F.array(*map(F.lit, [*families, UNKNOWN])), F.col("family")) - 1
    rows = stored(
        known.unionByName(unknown).where(F.size("words") > 0)
        .groupBy("family", "words").agg(F.max("stray").alias("stray"))
        .withColumn("label", label.cast("double")).withColumn("aside", F.pmod(F.xxhash64("words"), F.lit(10)) < F.when(F.col("stray"), 5).otherwise(2)),
        "license-rows",
    )
    hashed = HashingTF(inputCol="grams", outputCol="features", numFeatures=FEATURES, binary=True)
    learned = hashed.transform(rows.where("NOT aside").withColumn("grams", _features(F.col("words"))))
    classifier = LogisticRegression(maxIter=40, regParam=0.002, family="multinomial", aggregationDepth=DEPTH).fit(learned.select("label", "features"))
    model = LicenseModel(classifier, families, 0.0)
    aside = model.predict(rows.where(f"aside AND label = {len(families)}").select("words", "stray"))
    # Counts by steps of the probability: as many rows as there are steps, whatever the number of windows.
    step = F.floor(F.col("probability") * STEPS).alias("step")
    counts = {True: {}, False: {}}
    for r in aside.groupBy("stray", step).count().collect():
        counts[r.stray][r.step] = r["count"]
    model.threshold = _threshold(counts[True] or counts[False])
    return model


def _threshold(counts: dict[int, int]) -> float:
    """The least step of the probability that at most ``FALSE_SHARE`` of the counted rows reach; 0.5 without rows."""
    if not counts:
        return 0.5
    allowed, at = FALSE_SHARE * sum(counts.values()), STEPS + 1
    for step in sorted(counts, reverse=True):
        allowed -= counts[step]
        if allowed < 0:
            return (step + 1) / STEPS
        at = step
    return at / STEPS


def blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Runs of lines between blank ones: ``doc_id``, ``block``, ``first`` (its first line's number) and ``lines``."""
    lines = _once(docs.select(F.col(id_col).alias("doc_id"), F.split(F.col(text_col), r"\R").alias("all")), filled=F.transform("all", lambda line: line.rlike(r"\S")))
    places = F.sequence(F.lit(0), F.size("filled") - 1)
    begins = F.filter(places, lambda i: F.get("filled", i) & ~F.coalesce(F.get("filled", i - 1), F.lit(False)))
    found = _once(lines, begins=begins)
    ends = F.concat(F.slice("begins", F.lit(2), F.size("begins")), F.array(F.size("all")))
    whole = F.arrays_zip(F.col("begins").alias("a"), ends.alias("z"))
    made = found.where(F.size("begins") > 0).select("doc_id", "all", F.explode(whole).alias("at")).select(
        "doc_id", F.col("at.a").alias("first"), F.slice("all", F.col("at.a") + 1, F.col("at.z") - F.col("at.a")).alias("lines")
    )
    return made.withColumn("block", F.monotonically_increasing_id())


def windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The words of every line and block with a telling word, in windows of ``WINDOW`` words that hold one.

    ``joined`` tells the windows of blocks of several lines; their ``paragraph`` is the block's first line.
    """
    read = blocks(docs.where(_may_match(F.col(text_col))), id_col, text_col)
    read = read.where(_may_match(F.array_join("lines", " ")))
    lines = F.transform("lines", lambda line, i: F.struct(i.alias("i"), F.lit(False).alias("joined"), line.alias("text")))
    joined = F.array(F.struct(F.lit(0).alias("i"), F.lit(True).alias("joined"), F.array_join("lines", " ").alias("text")))
    items = F.concat(lines, F.when(F.size("lines") > 1, joined).otherwise(F.slice(joined, 1, 0)))
    texts = read.select("doc_id", "block", "first", F.inline(items)).where(_may_match(F.col("text")))
    texts = _once(texts.withColumn("paragraph", F.col("first") + F.col("i")), all_words=words_of(F.col("text")))
    last = F.greatest(F.lit(0), F.ceil((F.size("all_words") - WINDOW) / STEP).cast("int")) * STEP
    cut = F.transform(F.sequence(F.lit(0), last, F.lit(STEP)), lambda a: F.slice("all_words", a + 1, WINDOW))
    cut = texts.select("doc_id", "block", "paragraph", "joined", F.explode(cut).alias("words"))
    return cut.where(_may_match(F.array_join("words", " ")))


def scan_licenses(
    docs: DataFrame,
    model: LicenseModel,
    words_per_shingle: int = 5,
    threshold: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The licence families of every paragraph (line, or lines up to a blank one) that may hold a notice.

    Only windows of words with a telling word are classified: no template can be confirmed without one. A
    family is confirmed if a window holds the word shingles of one of its templates to the share of
    ``threshold`` or more, unless all of them are also those of another family's template that has a larger
    share, or the same and a larger probability. A line has a row for each confirmed family, or else one for the
    likeliest family of its windows, ``unknown`` below the calibrated threshold. Families that only the
    joined lines up to a blank one confirm have a row at the first of these lines. ``similarity`` is the
    best share of the family's templates (null for unknown).

    Null and empty texts have no paragraphs of that kind, repeated rows and paragraphs are all reported,
    and an empty table gives no rows. Only the two named columns are read. Returns ``doc_id``,
    ``paragraph`` (the line's number from 0), ``family``, ``probability``, ``similarity``, ``confirmed``.
    """
    # One row with all templates: a constant of this module.
    size = F.least(F.size("words"), F.lit(words_per_shingle))
    templates = template_rows(docs.sparkSession).select(F.struct("family", _shingles_of(F.col("words"), size).alias("shingles")).alias("t"), size.alias("k"))
    templates = templates.agg(F.collect_list("t").alias("templates"), F.collect_set("k").alias("sizes"))
    templates = templates.withColumn("wanted", F.array_distinct(F.flatten(F.col("templates.shingles"))))
    predicted = model.predict(windows(docs, id_col, text_col)).withColumnsRenamed({"family": "likeliest", "probability": "chance"})
    held = _held(F.col("words"), F.col("wanted"), F.col("sizes"))
    rows = _once(predicted.crossJoin(F.broadcast(templates)), held=held)

    def compared(t: Column) -> Column:
        both = F.array_intersect(t["shingles"], "held")
        chance = F.get("chances", (F.array_position(F.lit(model.families), t["family"]) - 1).cast("int"))
        return F.struct(t["family"].alias("family"), chance.alias("probability"), (F.size(both) / F.size(t["shingles"])).alias("similarity"), both.alias("both"))

    rows = _once(rows, shares=F.transform("templates", compared))
    rows = _once(rows, near=F.filter("shares", lambda s: s["similarity"] >= threshold))

    def explains(other: Column, own: Column) -> Column:
        better = (other["similarity"] > own["similarity"]) | (
            (other["similarity"] == own["similarity"]) & (other["probability"] > own["probability"])
        )
        return (other["family"] != own["family"]) & better & (F.size(F.array_except(own["both"], other["both"])) == 0)

    def row(s: Column, confirmed: bool) -> Column:
        return F.struct(s["family"].alias("family"), s["probability"].alias("probability"), s["similarity"].alias("similarity"), F.lit(confirmed).alias("confirmed"))

    sure = F.filter("near", lambda own: ~F.exists("near", lambda other: explains(other, own)))
    share = F.array_max(F.transform(F.filter("shares", lambda s: s["family"] == F.col("likeliest")), lambda s: s["similarity"]))
    guess = F.struct(F.col("likeliest").alias("family"), F.col("chance").alias("probability"), share.alias("similarity"))
    rows = _once(rows, sure=F.transform(sure, lambda s: row(s, True)), guess=row(guess, False))
    keys = ["doc_id", "block", "paragraph", "joined"]
    found = rows.select(*keys, F.inline(F.when(F.size("sure") > 0, F.col("sure")).otherwise(F.array("guess"))))
    found = found.where("confirmed OR NOT joined")

    # Lines before the block they are part of, and one row of each family; all in one exchange by block.
    of_block = Window.partitionBy("block", "family", "confirmed")
    of_line = Window.partitionBy("block", "paragraph", "joined")
    best = [F.desc("similarity"), F.desc("probability")]
    found = found.repartition("block")
    found = found.withColumn("_lines", F.min("joined").over(of_block)).where("NOT joined OR _lines")
    found = found.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys[1:], "family", "confirmed").orderBy(*best))).where("_rank = 1")
    found = found.withColumn("_sure", F.max("confirmed").over(Window.partitionBy("block", "paragraph"))).where("confirmed = _sure")
    unsure = [F.desc("confirmed"), F.col("family") == UNKNOWN, F.desc("probability"), F.col("family")]
    found = found.withColumn("_place", F.row_number().over(of_line.orderBy(*unsure))).where("confirmed OR _place = 1")
    return found.select("doc_id", "paragraph", "family", "probability", "similarity", "confirmed")


def _wanted(templates: dict[str, tuple[str, ...]], words_per_shingle: int) -> tuple[Column, Column]:
    """The shingles of all templates and their lengths, as literals."""
    shingles, sizes = set(), set()
    for text in (t for texts in templates.values() for t in texts):
        words = re.findall(r"[^\W_]+", text.lower())
        k = min(len(words), words_per_shingle)
        shingles |= {" ".join(words[i : i + k]) for i in range(len(words) - k + 1)}
        sizes.add(k)
    return F.lit(sorted(shingles)), F.lit(sorted(sizes))


def _held(words: Column, wanted: Column, sizes: Column) -> Column:
    """The wanted shingles that the words hold."""
    return F.flatten(F.transform(sizes, lambda k: F.array_intersect(wanted, _shingles_of(words, k))))


def _shingles_of(words: Column, k: Column) -> Column:
    return F.array_distinct(
        F.transform(
            F.sequence(F.lit(1), F.greatest(F.size(words) - k + 1, F.lit(1))),
            lambda i: F.array_join(F.slice(words, i, k), " "),
        )
    )


@query("op7_license_scan")
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scan_licenses(docs, fit_licenses(docs))

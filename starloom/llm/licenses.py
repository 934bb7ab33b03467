"""License scan: Dice coefficient over word bigrams between text segments and licence templates.

Segments are the lines of a text and the whole text.  Normalised text has lower
case letters and digits, all else is one space.  A segment of a bigrams can reach
the threshold t with a template of b bigrams only if
``t / (2 - t) <= a / b <= (2 - t) / t``, so segments outside the sizes of all
templates are dropped before their bigrams are looked at, and the same bound is
part of the join with the templates.  Segments meet templates by shared bigrams.
What reaches 0.8 has 2/3 of the template's bigrams, hence one of any choice of more
than a third of them: only texts with a word of each template's most telling
bigrams are cut into segments.

What lies outside the lines that match is read again in windows of as many words as
a template has, so that a notice is found inside a line and over several lines.
Of windows that overlap the best one counts.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import same_row, written

THRESHOLD = 0.8

#: Fixed values: (licence, notice).  Notices as licences ask to be stated, and their short forms.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction.'),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


def templates(spark: SparkSession) -> DataFrame:
    """The built-in templates as (license, notice)."""
    return spark.createDataFrame(TEMPLATES, "license string, notice string")


def _normalised(text):
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def _bigrams(words):
    """Distinct pairs of neighbouring words."""
    count = F.greatest(F.size(words) - 1, F.lit(0))
    return F.array_distinct(F.zip_with(F.slice(words, 1, count), F.slice(words, 2, count), lambda a, b: F.concat(a, F.lit(" "), b)))


def _told(rows: DataFrame, known: DataFrame, threshold: float) -> DataFrame:
    """The rows, each once, that may have a segment or window that reaches the threshold."""
    # both / b is at least t / (2 - t), as a segment has both or more; the longer word of a bigram stands for it.
    missed = F.floor(F.col("b_size") * (1 - threshold / (2 - threshold)) + 1e-9).cast("int") + 1
    words = F.transform("b", lambda g: F.array_max(F.transform(F.split(g, " "), lambda w: F.struct(F.length(w).alias("n"), w.alias("w")))))
    telling = known.select(F.explode(F.slice(F.sort_array(words, asc=False), 1, missed)).alias("x")).select("x.w").distinct().collect()
    words = F.split(_normalised(F.col("text")), " ")
    return rows.where(F.arrays_overlap(words, F.array(*[F.lit(r["w"]) for r in telling]).cast("array<string>"))).dropDuplicates(["doc_id", "text_key"])


def _windows(told: DataFrame, best: DataFrame, known: DataFrame, threshold: float) -> DataFrame:
    """(doc_id, text_key, at, m) of windows of a template's size outside matching segments; ``at`` is below 0."""
    row = ["doc_id", "text_key"]
    hits = best.groupBy(*row).agg(F.collect_set("at").alias("hits"))
    hits = hits.withColumnsRenamed({"doc_id": "hit_id", "text_key": "hit_key"})
    told = told.join(hits, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_key") == F.col("hit_key")), "left")
    lines = F.split("text", "\n")
    hit = F.coalesce("hits", F.array().cast("array<int>"))
    whole = F.array_contains(hit, F.when(F.size(lines) > 1, F.size(lines)).otherwise(0))
    # A matching line is a word that no template has.
    left = F.array_join(F.transform(lines, lambda line, i: F.when(F.array_contains(hit, i), F.lit("\u00b6")).otherwise(line)), " ")
    left = F.split(F.trim(F.regexp_replace(F.lower(left), "[^a-z0-9\u00b6]+", " ")), " ")
    count = F.greatest(F.size("w") - 1, F.lit(0))
    grams = told.where(~whole).select(*row, left.alias("w")).select(*row, F.posexplode(F.zip_with(F.slice("w", 1, count), F.slice("w", 2, count), lambda a, b: F.concat(a, F.lit(" "), b))).alias("p", "gram"))
    kept = known.select("license", "template", "b_size", F.explode("b").alias("gram"))
    met = grams.join(kept, "gram")
    one = [*row, "license", "template", "b_size"]
    place = Window.partitionBy(*one).orderBy("p")
    # Rows between, as a window has at most ``b_size`` places; those too far away are left out.
    near = F.collect_list(F.struct("p", "gram")).over(place.rowsBetween(0, int(known.agg(F.coalesce(F.max("b_size"), F.lit(1))).first()[0]) - 1))
    met = met.withColumn("both", F.size(F.array_distinct(F.transform(F.filter(near, lambda x: x["p"] < F.col("p") + F.col("b_size")), lambda x: x["gram"]))))
    close = met.select(*one, "p", (F.col("both") / F.col("b_size")).alias("dice")).where(F.col("dice") >= threshold)
    # Of the windows of a template that overlap one after another the best, then of those of all templates.
    text, each = Window.partitionBy(*row).orderBy("p", "b_size", "template", "license"), Window.partitionBy(*one).orderBy("p")
    close = close.withColumn("run", F.sum(F.when(F.col("p") >= F.lag("p").over(each) + F.col("b_size"), 1).otherwise(0)).over(each))
    close = close.groupBy(*one, "run").agg(F.max(F.struct("dice", (-F.col("p")).alias("q"))).alias("x")).select(*row, "license", "template", "b_size", (-F.col("x.q")).alias("p"), "x.dice")
    before = F.max(F.col("p") + F.col("b_size")).over(text.rowsBetween(Window.unboundedPreceding, -1))
    close = close.withColumn("starts", F.when(F.col("p") >= before, 1).otherwise(0)).withColumn("at", (-1 - F.sum("starts").over(text)).cast("int"))
    return close.groupBy(*row, "at").agg(F.min(F.struct((-F.col("dice")).alias("d"), "license")).alias("m"))


def license_matches(docs: DataFrame, notices: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_segments (that match, lines, whole texts and windows elsewhere), licenses (distinct, sorted), best_license and best_dice.

    A segment goes to the template of the highest coefficient, of equal ones to the
    first licence by name; so does the document.  Without a match
    licenses is empty, best_license null and best_dice 0.  Null and empty texts,
    and templates without two words, match nothing.  Rows that repeat a doc_id are
    judged one by one, a null doc_id is kept.  Other columns are ignored.
    ``notices`` has license and notice; null stands for the built-in ones.
    """
    spark = docs.sparkSession
    notices = templates(spark) if notices is None else notices
    known = notices.where("license IS NOT NULL").select(F.col("license").cast("string").alias("license"), _bigrams(F.split(_normalised(F.coalesce("notice", F.lit(""))), " ")).alias("b")).distinct()
    known = written(known.where(F.size("b") > 0).select("license", "b", F.size("b").alias("b_size"), F.xxhash64("b").alias("template")))
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    bounds = known.agg(F.coalesce(F.min("b_size"), F.lit(1)).alias("least"), F.coalesce(F.max("b_size"), F.lit(0)).alias("most")).first()

    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("text_key", F.xxhash64("text"))
    row = ["doc_id", "text_key"]
    lines = F.split("text", "\n")
    told = written(_told(rows, known, threshold))
    segments = told.select(*row, F.posexplode(F.when(F.size(lines) > 1, F.concat(lines, F.array("text"))).otherwise(lines)).alias("at", "segment"))
    # The count of words bounds the count of distinct bigrams from above; a segment repeated in itself has fewer.
    spaced = segments.select(*row, "at", _normalised(F.col("segment")).alias("s"))
    spaced = spaced.where(F.length("s") - F.length(F.translate("s", " ", "")) >= bounds["least"] * low)
    paired = spaced.select(*row, "at", _bigrams(F.split("s", " ")).alias("a"))
    paired = paired.select("*", F.size("a").alias("a_size")).where(F.col("a_size").between(bounds["least"] * low, bounds["most"] * high))
    grams = paired.select(*row, "at", "a_size", F.explode("a").alias("gram"))
    kept = known.select("license", "template", "b_size", F.explode("b").alias("gram"))
    fits = (F.col("a_size") >= F.col("b_size") * low - 1e-9) & (F.col("a_size") <= F.col("b_size") * high + 1e-9)
    # Bounded by the bigrams of a template.
    shared = grams.join(kept, "gram").where(fits).groupBy(*row, "at", "a_size", "template", "b_size", "license").agg(F.size(F.collect_set("gram")).alias("both"))
    dice = shared.select(*row, "at", "license", (F.col("both") * 2.0 / (F.col("a_size") + F.col("b_size"))).alias("dice")).where(F.col("dice") >= threshold)
    best = written(dice.groupBy(*row, "at").agg(F.min(F.struct((-F.col("dice")).alias("d"), "license")).alias("m")))
    best = best.unionByName(_windows(told, best, known, threshold))
    found = written(best.groupBy(*row).agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_set("m.license")).alias("l"), F.min("m").alias("m")))
    rows = rows.select(*row)
    return rows.join(found, same_row(rows, found), "left").select(
        rows["doc_id"], F.coalesce("n", F.lit(0).cast("long")).alias("n_segments"), F.concat_ws(",", F.coalesce("l", F.array().cast("array<string>"))).alias("licenses"),
        F.col("m.license").alias("best_license"), F.coalesce(-F.col("m.d"), F.lit(0.0)).alias("best_dice"),
    )

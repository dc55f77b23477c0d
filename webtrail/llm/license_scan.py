"""License scans: sparse TF-IDF cosine to templates, then nearest-ancestor inheritance by path.

Every line of a file is a passage.  Lines that hold ``min_terms`` different words of the templates,
function words apart, are scored: words weigh their count times their inverse document frequency (over all files; words
outside the templates weigh the templates' mean), and the line's licence is the template of the
highest cosine, if that reaches ``threshold``.  A file's own licence is its best line's.  A file is
a licence file if its name says so or if licence lines hold at least ``FILE_SHARE`` of its words; it
covers its directory.  A file without one of its own takes that of the nearest directory above it
(or its own one) with a licence file: paths are expanded to their ancestors and joined by
directory.

Only DataFrame functions run here; the templates are a small literal table.  A hot directory is
one row of the joined side, and files carry no text through the join.

Null and empty texts and null paths have no licence of their own; a null path inherits nothing.
Ties go to the licence, line and path that come first.  Rows that repeat id and path are one file
with the lines of all.  An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webtrail.llm import common

#: Licence ids and the wording of their notices.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("LGPL-2.1", "licensed under the GNU Lesser General Public License, version 2.1"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
)
THRESHOLD, MIN_TERMS = 0.6, 2
#: Words of the templates that any prose holds: a line needs MIN_TERMS others to be scored.
FUNCTION_WORDS = frozenset("a and any are as at by can either except for in is it may not of or that the this to under with "
                           "without you".split())
#: Share of a file's words in licence lines from which it is a licence file.
FILE_SHARE = 0.25
#: Names of licence files, in lower case.
LICENCE_NAME = r"^(licen[cs]e|copying|notice|unlicense)([.\-_].*)?$"
_SPLIT = r"[^\p{L}\p{N}]+"


def _terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _SPLIT), lambda x: x != "")


def own_licenses(files: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD,
                 min_terms: int = MIN_TERMS) -> DataFrame:
    """(id, path, line_no, n_words, license, cosine) of each line that states a licence, from files
    (id, path, t)."""
    spark = files.sparkSession
    listed = spark.createDataFrame([(i, *x) for i, x in enumerate(templates)], "template int, license string, t string")
    words = listed.select("template", "license", F.explode(_terms(F.col("t"))).alias("term")).groupBy(
        "template", "license", "term").agg(F.count("*").alias("tf"))
    vocabulary = sorted(r.term for r in words.select("term").distinct().collect())  # the templates' own words
    known = F.array(*[F.lit(x) for x in vocabulary])
    telling = F.array(*[F.lit(x) for x in vocabulary if x not in FUNCTION_WORDS])

    held = files.select(F.explode(F.array_intersect(_terms(F.col("t")), known)).alias("term"))
    held = {r.term: r["count"] for r in held.groupBy("term").count().collect()}  # one row per word of the templates
    n = files.count()
    weights = spark.createDataFrame([(x, held.get(x, 0)) for x in vocabulary], "term string, df long").select(
        "term", (F.log((F.lit(n) + 1.0) / (F.col("df") + 1.0)) + 1.0).alias("idf"))
    mean = weights.agg(F.avg("idf")).first()[0]
    vectors = words.join(weights, "term").select("template", "license", "term", (F.col("tf") * F.col("idf")).alias("w"))
    norms = vectors.groupBy("template").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    vectors = vectors.join(norms, "template").select("license", "template", "term", (F.col("w") / F.col("norm")).alias("w"))

    lines = files.select("id", "path", F.posexplode(F.split("t", "\n")).alias("line_no", "line"))
    lines = lines.withColumn("terms", _terms(F.col("line"))).filter(
        F.size(F.array_intersect("terms", telling)) >= min_terms).drop("line")
    lines = lines.withColumn("n_words", F.size("terms"))
    key = ["id", "path", "line_no", "n_words"]
    counted = lines.select(*key, F.explode("terms").alias("term")).groupBy(*key, "term").agg(F.count("*").alias("tf"))
    weighed = counted.join(F.broadcast(weights), "term", "left").withColumn(
        "w", F.col("tf") * F.coalesce("idf", F.lit(mean)))
    products = weighed.select(*key, "term", "w").join(F.broadcast(vectors.withColumnRenamed("w", "tw")), "term", "left")
    sums = products.groupBy(*key, "license", "template").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
    squares = weighed.groupBy(*key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    same = [F.col(k).eqNullSafe(F.col(f"s_{k}")) for k in key]
    scored = sums.filter("template is not null").join(squares.toDF(*(f"s_{k}" for k in key), "norm"), same)
    cosine = F.round(F.col("dot") / F.col("norm"), 6)
    best = scored.withColumn("cosine", cosine).filter(F.col("cosine") >= threshold).groupBy(*key).agg(
        F.min(F.struct((-F.col("cosine")).alias("c"), "license")).alias("best"))
    return best.select(*key, "best.license", (-F.col("best.c")).alias("cosine"))


def _parents(path: Column) -> Column:
    """(depth, directory) of the file's directory and each above it; the topmost is ''."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: F.struct(
        i.cast("int").alias("depth"), F.when(i == 0, "").otherwise(F.concat_ws("/", F.slice(parts, 1, i))).alias("dir")))


def scan(files: DataFrame, doc_id: str, path: str, text: str, templates: Sequence[tuple[str, str]] = TEMPLATES,
         threshold: float = THRESHOLD, min_terms: int = MIN_TERMS) -> DataFrame:
    """One row per file: (id, path, own_license, own_cosine, own_line, is_license_file,
    inherited_license, inherited_from, license)."""
    rows = files.select(F.col(doc_id).alias("id"), F.col(path).alias("path"), F.col(text).alias("t"))
    own = common.stored(own_licenses(rows, templates, threshold, min_terms), "license-lines")
    order = F.struct((-F.col("cosine")).alias("c"), "license", "line_no")
    per_file = own.groupBy("id", "path").agg(F.min(order).alias("best"), F.sum("n_words").alias("licensed"))
    words = F.coalesce(F.size(_terms(F.col("t"))), F.lit(0)).cast("long")
    sizes = rows.groupBy("id", "path").agg(F.sum(F.when(F.col("t").isNull(), 0).otherwise(words)).alias("words"))
    side = common.small_side(common.stored(per_file, "license-files"), 1_000_000).toDF("i", "p", "best", "licensed")
    state = sizes.join(side, [F.col("id").eqNullSafe(F.col("i")), F.col("path").eqNullSafe(F.col("p"))], "left")
    named = F.lower(F.element_at(F.split("path", "/"), -1)).rlike(LICENCE_NAME)
    is_file = F.col("best").isNotNull() & F.col("path").isNotNull() & (named | (F.col("licensed") >= FILE_SHARE * F.col("words")))
    state = common.stored(state.select(
        "id", "path", F.col("best.license").alias("own_license"), (-F.col("best.c")).alias("own_cosine"),
        F.col("best.line_no").alias("own_line"), F.coalesce(is_file, F.lit(False)).alias("is_license_file")), "license-state")

    covers = state.filter("is_license_file").select(
        F.element_at(_parents(F.col("path")), -1)["dir"].alias("dir"), "own_license", "own_cosine", "path").groupBy("dir").agg(
        F.min(F.struct((-F.col("own_cosine")).alias("c"), "path", "own_license")).alias("cover"))
    covers = common.small_side(common.stored(covers.select("dir", F.col("cover.own_license").alias("cover")), "license-dirs"),
                               200_000)
    above = state.filter(F.col("path").isNotNull() & F.col("own_license").isNull()).select(
        "id", "path", F.explode(_parents(F.col("path"))).alias("up")).select("id", "path", "up.depth", "up.dir")
    nearest = above.join(covers, "dir").groupBy("id", "path").agg(
        F.max(F.struct("depth", "cover", "dir")).alias("n")).select(F.col("id").alias("i"), F.col("path").alias("p"), "n")
    out = state.join(nearest, [F.col("id").eqNullSafe(F.col("i")), F.col("path").eqNullSafe(F.col("p"))], "left")
    return out.select(F.col("id").alias(doc_id), "path", "own_license", "own_cosine", "own_line", "is_license_file",
                      F.col("n.cover").alias("inherited_license"), F.col("n.dir").alias("inherited_from"),
                      F.coalesce("own_license", "n.cover").alias("license"))

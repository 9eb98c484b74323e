"""License scan: TF-IDF cosine to templates, then inheritance by directory (operator 6).

Passages of a file are its lines, the sentences of lines that have several, and its blocks
of lines without a blank one between them (comment marks alone leave a line blank); a
licence file, told by its name, is also a passage as a whole. Passages are compared with
templates, notices and the titles and decisive paragraphs of licence texts, as sparse
TF-IDF vectors. A file without a licence of its own takes that of the nearest directory
above it (its own first) that has a licence file.

Some texts also stand in files of other licences: licences in ``YIELDING`` count only
where no other one is found, the later ones in that list last.

DataFrame functions only. Document frequencies of the templates' terms are counted over
all files. A passage that reaches the threshold with some template must hold one of the
template's heaviest terms, those without which the rest of its vector is too short; the
others are never taken apart.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.scratch import materialize

THRESHOLD = 0.6

# Licence notices, by SPDX identifier where there is one.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0-or-later", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("AGPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0-only", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Proprietary", "All rights reserved."),
    ("MIT", "MIT License"),
    ("ISC", "ISC License"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("GPL-3.0-only", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-2.0-only", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-3.0-only", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1-only", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("AGPL-3.0-only", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("EPL-2.0", "Eclipse Public License - v 2.0"),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003"),
]

# BSD with three clauses opens like the one with two; many licences reserve all rights first.
YIELDING = ("BSD-2-Clause", "Proprietary")

_LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|notice|unlicense)[^/]*$"
_BREAK = r"[^\p{L}\p{N}]+"
_BLANK_LINES = r"\n(?:[^\p{L}\p{N}\n]*\n)+"
_SENTENCE_END = r"(?<=[.;!?])\s+"


def terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _BREAK), lambda t: t != "")


def _split(text: str) -> list[str]:
    return [t for t in re.split(r"[\W_]+", text.lower()) if t]


def passages_of(path: Column, text: Column) -> Column:
    """Lines, sentences of lines with several, blocks of several lines, whole licence files."""
    lines = F.split(text, "\n")
    sentences = F.filter(F.transform(lines, lambda x: F.split(x, _SENTENCE_END)), lambda x: F.size(x) > 1)
    blocks = F.filter(F.split(text, _BLANK_LINES), lambda x: x.contains("\n"))
    found = F.concat(lines, F.flatten(sentences), blocks)
    return F.when(path.rlike(_LICENCE_FILE), F.concat(found, F.array(text))).otherwise(found)


def _rank(license_: Column) -> Column:
    """0, or the place among the licences that yield to others."""
    return F.array_position(F.array(*[F.lit(y) for y in YIELDING]), license_)


def term_weights(files: DataFrame, text: str, vocabulary: Sequence[str]) -> dict[str | None, float]:
    """Inverse document frequencies over all files; under None, that of any other term.

    The result has a row for each term of the templates, no more.
    """
    known = F.array(*[F.lit(t) for t in vocabulary])
    inside = F.array_intersect(terms(F.coalesce(F.col(f"`{text}`"), F.lit(""))), known)
    # The empty term counts the files, those without any term too.
    found = files.select(F.explode(F.concat(inside, F.array(F.lit("")))).alias("t"))
    counts = {r["t"]: r["n"] for r in found.groupBy("t").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = counts.pop("", 0)
    weight = lambda n: math.log((1 + total) / (1 + n)) + 1
    return {t: weight(counts.get(t, 0)) for t in vocabulary} | {None: weight(0)}


def anchors(
    templates: Sequence[tuple[str, str]], weights: dict[str | None, float], threshold: float
) -> list[str]:
    """Terms of which every passage that reaches the threshold holds one."""
    chosen: set[str] = set()
    for _, text in templates:
        words = _split(text)
        vector = {t: words.count(t) * weights[t] for t in words}
        norm = math.sqrt(sum(v * v for v in vector.values()))
        rest = 1.0
        for t in sorted(vector, key=lambda t: (-vector[t], t)):
            if rest < (threshold * 0.999) ** 2:
                break
            chosen.add(t)
            rest -= (vector[t] / norm) ** 2
    return sorted(chosen)


def own_licenses(
    files: DataFrame,
    path: str = "path",
    text: str = "text",
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``file_key, path, license, cosine`` of the files that a template matches: the closest
    one, ties by name, those of ``YIELDING`` last. Files are told apart by path and text (``file_key``), so neither
    several texts of one path nor files without a path share a licence."""
    spark = files.sparkSession
    body, name = F.col(f"`{text}`"), F.col(f"`{path}`")
    vocabulary = sorted({t for _, x in templates for t in _split(x)})
    weights = term_weights(files, text, vocabulary)
    marks = "|".join(map(re.escape, anchors(templates, weights, threshold)))
    holds = rf"(?i)(?<![\p{{L}}\p{{N}}])(?:{marks})(?![\p{{L}}\p{{N}}])"
    taken = (
        files.where(body.rlike(holds))
        .select(_file_key(name, body).alias("path"), F.posexplode(passages_of(name, body)).alias("line", "passage"))
        .where(F.col("passage").rlike(holds))
        .select("path", "line", F.explode(terms(F.col("passage"))).alias("term"))
        .groupBy("path", "line", "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    vectors = F.broadcast(_vectors(spark, templates, weights))  # the templates' terms
    weighed = F.broadcast(
        spark.createDataFrame([(t, w) for t, w in weights.items() if t is not None], "term string, idf double")
    )
    parts = materialize(
        taken.join(weighed, "term", "left").select(
            "path", "line", "term",
            (F.col("tf") * F.coalesce("idf", F.lit(float(weights[None])))).alias("w"),
        ),
        "passage-terms",
    )
    norms = parts.groupBy("path", "line").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = parts.join(vectors, "term").groupBy("path", "line", "template", "license").agg(
        F.sum(F.col("w") * F.col("u")).alias("dot")
    )
    both = dots.join(
        norms.withColumnRenamed("path", "p").withColumnRenamed("line", "l"),
        (F.col("path") == F.col("p")) & (F.col("line") == F.col("l")),
    ).withColumn("cosine", F.round(F.col("dot") / F.col("norm"), 6))
    best = both.where(F.col("cosine") >= threshold).groupBy("path").agg(
        F.min(F.struct(_rank(F.col("license")).alias("r"), (-F.col("cosine")).alias("c"), "license")).alias("best")
    )
    best = best.select(F.col("path").alias("file_key"), "best.license", (-F.col("best.c")).alias("cosine"))
    names = files.select(_file_key(name, body).alias("k"), name.alias("path"))
    found = best.join(names, F.col("file_key") == F.col("k"))
    return found.select("file_key", "path", "license", "cosine").distinct()


def _file_key(path: Column, text: Column) -> Column:
    return F.xxhash64(path, text)


def _vectors(
    spark: SparkSession, templates: Sequence[tuple[str, str]], weights: dict[str | None, float]
) -> DataFrame:
    rows = []
    for i, (license_, text) in enumerate(templates):
        words = _split(text)
        vector = {t: words.count(t) * weights[t] for t in words}
        norm = math.sqrt(sum(v * v for v in vector.values()))
        rows += [(i, license_, t, v / norm) for t, v in sorted(vector.items())]
    return spark.createDataFrame(rows, "template int, license string, term string, u double")


def _folder(path: Column) -> Column:
    """The directory of a path; the empty text is the root."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def scan_licenses(
    files: DataFrame,
    path: str = "path",
    text: str = "text",
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``keep, path, license, cosine, inherited_from`` for every row of ``files``.

    ``inherited_from`` is the directory whose licence file decided (root: empty text),
    null where the file decided itself or nothing did; then license and cosine may be
    null too. Of several licence files in a directory the closest to its template counts,
    ties by licence name, those of ``YIELDING`` last. A row's own licence is that of its text, also where rows share a
    path; a null path has no directory, gives none and inherits nothing. Null and empty texts match no template.
    """
    own = materialize(own_licenses(files, path, text, templates, threshold), "licenses")
    carried = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.lit(None)
    named = files.select(
        carried.alias("carried"), F.col(f"`{path}`").alias("path"),
        _file_key(F.col(f"`{path}`"), F.col(f"`{text}`")).alias("key"),
        _folder(F.col(f"`{path}`")).alias("folder"),
    )
    givers = own.where(F.col("path").rlike(_LICENCE_FILE)).groupBy(_folder(F.col("path")).alias("above")).agg(
        F.min(F.struct(_rank(F.col("license")).alias("r"), (-F.col("cosine")).alias("c"), "license")).alias("given")
    )
    folders = named.select("folder").where("folder is not null").distinct()
    parts = F.split("folder", "/")
    chain = F.transform(
        F.sequence(F.lit(0), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/")
    )
    nearest = (
        folders.select("folder", F.posexplode(F.array_distinct(chain)).alias("depth", "above"))
        .join(givers, "above")
        .groupBy("folder")
        .agg(F.max(F.struct("depth", "above", "given")).alias("n"))
        .select("folder", F.col("n.above").alias("above"), F.col("n.given").alias("given"))
    )
    nearest = materialize(nearest, "licensed-folders")
    mine = own.select(F.col("file_key").alias("key"), F.col("license").alias("own"), F.col("cosine").alias("own_cosine"))
    joined = named.join(mine, "key", "left").join(nearest, "folder", "left")
    inherits = F.col("own").isNull()
    return joined.select(
        *[F.col(f"carried.`{c}`") for c in keep],
        "path",
        F.coalesce("own", "given.license").alias("license"),
        F.coalesce("own_cosine", -F.col("given.c")).alias("cosine"),
        F.when(inherits, F.col("above")).alias("inherited_from"),
    )

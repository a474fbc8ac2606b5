"""Licence statements by sparse TF-IDF cosine to templates; files without one inherit along their path.

Statements are lines, sentences, paragraphs, and files as a whole, that hold a licence word. Their
terms are counted, weighted by how few of all statements use a term, and multiplied with the
templates' terms in one join with that fixed small table. A licence file covers its directory and everything
below; the nearest one above a file wins.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut

# Short notices by licence.
TEMPLATES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License, CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright. CC0 1.0 Universal, public domain.",
    "EPL-2.0": "This program is made available under the terms of the Eclipse Public License, version 2.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Released under the ISC License.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "Subject to the terms of the Mozilla Public License, version 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
# Paragraphs that open a licence's text or stand at the head of a file.
PARAGRAPHS = [
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
]
#: A statement has one of these; every template does.
MARK = r"(?i)licen[cs]e|copyright|redistribut|public domain|all rights reserved|permission (is hereby|to use)|free to copy|unencumbered"
#: Terms that make up at least this share of all counted terms are sent to every task; there are at most 1 / share of them.
FREQUENT = 1e-4
LICENCE_FILE = r"(?i)(^|/)(un)?(licen[cs]e|copying|notice)[^/]*$"


def terms(text: Column) -> Column:
    """Lower-case runs of letters, digits, points and hyphens, without points or hyphens at their ends."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[a-z0-9](?:[a-z0-9.-]*[a-z0-9])?"), F.lit(0))


def statements(files: DataFrame, path: str, text: str) -> DataFrame:
    """``path, row, unit, term, tf`` of every line or sentence, paragraph, and file as a whole (unit 0) that has a licence word."""
    marked = files.filter(F.col(text).rlike(MARK)).select(
        F.col(path).alias("path"), F.col(text).alias("text"), F.xxhash64(path, text).alias("row")
    ).distinct()
    units = marked.select(
        "path", "row",
        F.posexplode(F.array_distinct(F.concat(
            F.array("text"), F.split("text", r"\n[ \t\r]*\n"), F.split("text", r"\n|(?<=[.!?])[ \t\r]+"),
        ))).alias("unit", "words"),
    ).filter(F.col("words").rlike(MARK))
    return (
        units.select("path", "row", "unit", F.explode(terms(F.col("words"))).alias("term"))
        .groupBy("path", "row", "unit", "term")
        .agg(F.count("*").alias("tf"))
    )


def template_terms(spark: SparkSession, templates: Mapping[str, str]) -> DataFrame:
    """``licence, number, term, tt`` of the notices and, for licences among them, of the paragraphs."""
    listed = [*sorted(templates.items()), *[p for p in PARAGRAPHS if p[0] in templates]]
    rows = spark.createDataFrame([(name, i, words) for i, (name, words) in enumerate(listed)], "licence string, number int, words string")
    return rows.select("licence", "number", F.explode(terms(F.col("words"))).alias("term")).groupBy("licence", "number", "term").agg(F.count("*").alias("tt"))


def similarities(counted: DataFrame, templates: Mapping[str, str]) -> DataFrame:
    """The best licence of each statement and its cosine; ties go to the smaller name.

    A term weighs 1 + ln((1 + n) / (1 + df)) times its count, over all n statements; a template's
    term that no statement has counts as met once. Weights of the templates' terms and of frequent
    terms go to every task, those of the others, with few rows each, are joined by term.
    """
    spark = counted.sparkSession
    wanted = template_terms(spark, templates)
    n = counted.select("path", "row", "unit").distinct().count()
    cells = counted.count()
    met = cut(counted.groupBy("term").agg(F.count("*").alias("df")))
    idf = lambda df: 1 + F.log((1 + F.lit(float(n))) / (1 + df))
    named = met.join(F.broadcast(wanted.select("term").distinct()), "term")
    weights = wanted.join(named, "term", "left").select("licence", "number", "term", "tt", idf(F.coalesce("df", F.lit(1))).alias("idf"))
    sides = weights.withColumn("tw", F.col("tt") * F.col("idf"))
    norms = sides.groupBy("number").agg(F.sqrt(F.sum(F.col("tw") * F.col("tw"))).alias("tnorm"))
    per_term = sides.join(norms, "number").groupBy("term").agg(
        F.collect_list(F.struct("licence", "number", (F.col("tw") / F.col("tnorm")).alias("share"))).alias("to")
    )
    frequent = F.col("df") >= max(1.0, FREQUENT * cells)
    # at most 1 / FREQUENT rows, and one for each word of the templates
    everywhere = met.join(F.broadcast(per_term), "term", "left").filter(frequent | F.col("to").isNotNull()).select("term", "df", "to")
    known = counted.join(F.broadcast(everywhere), "term", "left")
    others = known.filter(F.col("df").isNull()).select(*counted.columns).join(met.filter(~frequent), "term")
    unit = ["path", "row", "unit"]
    squares = known.filter(F.col("df").isNotNull()).select(*unit, "tf", "df").unionByName(others.select(*unit, "tf", "df"))
    w = F.col("tf") * idf(F.col("df"))
    length = squares.groupBy(*unit).agg(F.sqrt(F.sum(w * w)).alias("norm"))
    dots = (
        known.filter(F.col("to").isNotNull())
        .select(*unit, w.alias("w"), F.explode("to").alias("to"))
        .groupBy(*unit, "to.licence", "to.number").agg(F.sum(F.col("w") * F.col("to.share")).alias("dot"))
    )
    scored = dots.join(length, unit).select(*unit, "licence", F.round(F.col("dot") / F.col("norm"), 6).alias("cosine"))
    return scored.groupBy(*unit).agg(
        F.max("cosine").alias("cosine"), F.min_by("licence", F.struct(-F.col("cosine"), F.col("licence"))).alias("licence")
    )


def parent(path: Column) -> Column:
    """The directory of a path; a name without one lies in the root, the empty path."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def scan(
    files: DataFrame, templates: Mapping[str, str] = TEMPLATES, path: str = "path", text: str = "text",
    least: float = 0.5, file_least: float = 0.9,
) -> DataFrame:
    """``path, own, cosine, inherited, source``: a row for every distinct path that is not null.

    ``own`` is the licence of the file's closest statement with a cosine of at least ``least``,
    else null; ``cosine`` that cosine. ``inherited`` is what the nearest directory at or above
    gives through a licence file (by name, or a file whose whole text has a cosine of at least
    ``file_least``), set only where ``own`` is null; ``source`` is that file. Of several licence files in a
    directory the closest statement counts, then the smaller path. Several texts of one path
    count as one file. Null and empty texts have no statement of their own but inherit.
    """
    named = files.filter(F.col(path).isNotNull())
    close = similarities(cut(statements(named, path, text)), templates).filter(F.col("cosine") >= least)
    own = close.groupBy("path").agg(
        F.max("cosine").alias("cosine"),
        F.min_by("licence", F.struct(-F.col("cosine"), F.col("licence"))).alias("own"),
        F.max((F.col("unit") == 0) & (F.col("cosine") >= file_least)).alias("whole"),
    )
    covering = (
        own.filter(F.col("whole") | F.col("path").rlike(LICENCE_FILE))
        .groupBy(parent(F.col("path")).alias("folder"))
        .agg(F.min_by(F.struct("own", "path"), F.struct(-F.col("cosine"), F.col("path"))).alias("by"))
    )
    paths = named.select(F.col(path).alias("path")).distinct().withColumn("folder", parent(F.col("path")))
    # the folders above each folder, once per folder, however many files it holds
    steps = F.split("folder", "/")
    above = paths.select("folder").distinct().select(
        "folder",
        F.explode(F.concat(F.array(F.struct(F.lit(0).alias("depth"), F.lit("").alias("up"))), F.transform(
            F.sequence(F.lit(1), F.size(steps)),
            lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(steps, 1, n), "/").alias("up")),
        ))).alias("at"),
    )
    nearest = (
        above.select("folder", "at.depth", F.col("at.up").alias("up"))
        .join(covering.withColumnRenamed("folder", "up"), "up")
        .groupBy("folder")
        .agg(F.max_by("by", "depth").alias("by"))
    )
    return (
        paths.join(own.drop("whole"), "path", "left")
        .join(nearest, "folder", "left")
        .select(
            "path", "own", "cosine",
            F.when(F.col("own").isNull(), F.col("by.own")).alias("inherited"),
            F.when(F.col("own").isNull(), F.col("by.path")).alias("source"),
        )
    )

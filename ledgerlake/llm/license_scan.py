"""Licence scan, in DataFrame functions only.

Texts are compared with licence templates by the cosine of sparse TF-IDF vectors, in two units that line ends do not cut. A
notice is compared with every window of as many words of the text that begins at one of the notice's terms (the last windows end with
the text). A full licence text is compared with the whole text. A text that reaches ``threshold`` with a full licence has that licence,
else that of its best window (ties: earlier template). A text is a licence file if it reaches the threshold as a whole, or if the terms of
notices in their windows are at least ``file_share`` of its words: it governs its directory, and texts without a licence of their
own take that of the nearest ancestor directory that has one (path joins).

Terms are runs of a-z and 0-9 after lower-casing. The vector space has one dimension per template term, weighed by
tf * (ln((1 + N) / (1 + df)) + 1) with N and df counted over all rows, and every other term counts with the template terms' median
weight. By Cauchy-Schwarz the cosine is at most the length of the template's unit vector over the terms that both have, so texts and windows
whose shared terms are too light are skipped without a loss; for notices, texts without any of the heaviest terms (those that the rest
cannot make up for) first.

Templates are a bounded table of notices and licence texts. Equal texts are scored once.

Defined results: null text = empty text = no licence. A null path has no directory and inherits nothing. Repeated rows and null ids are
reported each. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .license_texts import TEXTS
from .store import written

# Notices by which well-known public licences are named in files.
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file"),
    ("GPL-2.0", "This program is free software, licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("LGPL-2.1", "This library is licensed under the GNU Lesser General Public License, version 2.1"),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version"),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
]
SPLIT = "[^a-z0-9]+"


@dataclass(frozen=True)
class LicenseParams:
    threshold: float = 0.7
    file_share: float = 0.5


def template_table(spark: SparkSession, templates: list[tuple[str, str]] = TEMPLATES, texts: list[tuple[str, str]] = TEXTS) -> DataFrame:
    """Notices, then full licence texts (``whole``)."""
    rows = [(i, name, text, i >= len(templates)) for i, (name, text) in enumerate([*templates, *texts])]
    return spark.createDataFrame(rows, "template int, license string, notice string, whole boolean")


def _terms(text):
    return F.filter(F.split(F.lower(text), SPLIT), lambda t: t != "")


def _term_counts(df: DataFrame, keys: list[str], terms: str) -> DataFrame:
    return df.select(*keys, F.explode(terms).alias("term")).groupBy(*keys, "term").agg(F.count(F.lit(1)).cast("double").alias("tf"))


def scan(files: DataFrame, templates: DataFrame, params: LicenseParams = LicenseParams()) -> DataFrame:
    """doc_id, path, license, score, is_file, inherited_license, inherited_from per row of (doc_id, path, text)."""
    src = files.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("path").cast("string").alias("path"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    of_template = written(_term_counts(templates.select("template", "license", "whole", _terms(F.col("notice")).alias("terms")),
                                       ["template", "license", "whole"], "terms"), "license_terms")
    vocabulary = of_template.select("term").distinct()  # bounded by the template table, as are all broadcasts below

    # document frequencies of the template terms over all rows
    found = src.select(F.explode(F.array_distinct(_terms(F.col("text")))).alias("term")).join(F.broadcast(vocabulary), "term")
    total = src.count()
    idf = (vocabulary.join(found.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "term", "left")
           .select("term", (F.log(F.lit(1.0 + total) / (F.coalesce("df", F.lit(0)) + 1.0)) + 1.0).alias("idf")))
    idf = written(idf, "license_idf")
    other = idf.agg(F.percentile("idf", 0.5)).first()[0] or 1.0
    weighed = of_template.join(idf, "term").withColumn("w", F.col("tf") * F.col("idf"))
    norms = weighed.groupBy("template").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    unit = written(weighed.join(norms, "template").select("template", "license", "whole", "term", "tf", (F.col("w") / F.col("norm")).alias("u")), "license_unit")
    least = (params.threshold - 1e-6) ** 2  # of the squared unit vector must be shared

    # whole texts against full licences
    key = F.md5("text").alias("text_key")
    rare = src.sparkSession.createDataFrame(_rare_terms(unit.filter("whole").join(idf, "term"), least), "template int, license string, term string, power double, need double")
    near = (src.select("text", F.explode(F.array_distinct(_terms(F.col("text")))).alias("term")).join(F.broadcast(rare), "term")
            .select(key, "template", "license", "power", "need").groupBy("text_key", "template", "license", "need").agg(F.sum("power").alias("power"))
            .filter(F.col("power") >= F.col("need")).select("text_key", "template", "license"))  # the sum is more for equal texts, never less
    near = written(near, "license_near")
    near_texts = (src.select(key, "text").join(near.select("text_key").distinct(), "text_key", "left_semi").dropDuplicates(["text_key"])
                  .select("text_key", _terms(F.col("text")).alias("words")))
    whole = (_cosines(near.join(near_texts, "text_key").withColumn("start", F.lit(-1)), unit, idf, other)
             .filter(F.col("cosine") >= params.threshold))

    # windows against notices
    notices = _notices(unit.filter("not whole"), params.threshold)
    heavy = sorted({t for n in notices for t in n[5]})
    any_heavy = F.lit(False)
    for t in heavy:
        any_heavy = any_heavy | F.contains(F.col("low"), F.lit(t))
    held = F.array(*[F.lit(t) for t in heavy]) if heavy else F.array().cast("array<string>")
    some = src.select("text", F.lower("text").alias("low")).filter(any_heavy)  # substrings first, then whole terms: only texts with a heavy term are shuffled
    suspects = written(some.filter(F.arrays_overlap(_terms(F.col("text")), held)).select(key, "text")
                       .dropDuplicates(["text_key"]).select("text_key", _terms(F.col("text")).alias("terms")), "license_suspects")
    table = src.sparkSession.createDataFrame(notices, "template int, license string, size int, notice array<string>, power array<double>, heavy array<string>")

    def shared(words):
        return F.aggregate(F.array_intersect("notice", words), F.lit(0.0), lambda sum_, t: sum_ + F.element_at("power", F.array_position("notice", t).cast("int")))

    starts = F.filter(F.sequence(F.lit(0), F.size("terms") - 1), lambda i: F.array_contains("notice", F.get("terms", i)))
    cut = F.transform(starts, lambda i: F.struct(i.alias("start"), F.slice("terms", i + 1, F.col("size")).alias("words")))
    windows = (suspects.join(F.broadcast(table), F.arrays_overlap("terms", "heavy"))
               .select("text_key", "template", "license", "notice", F.explode(F.filter(cut, lambda x: shared(x["words"]) >= least)).alias("w"))
               .select("text_key", "template", "license", "notice", "w.start", "w.words"))
    windows = written(windows, "license_windows")
    passing = written(_cosines(windows, unit, idf, other).filter(F.col("cosine") >= params.threshold), "license_passing")
    covered = (windows.join(passing.select("text_key", "template", "start"), ["text_key", "template", "start"], "left_semi")
               .select("text_key", "start", "notice", F.posexplode("words").alias("at", "word")).filter(F.array_contains("notice", F.col("word")))
               .select("text_key", (F.col("start") + F.col("at")).alias("at")).distinct()
               .groupBy("text_key").agg(F.count(F.lit(1)).alias("licensed")))
    sizes = suspects.select("text_key", F.size("terms").alias("words"))
    of_text = (passing.withColumn("whole", F.lit(False)).unionByName(whole.withColumn("whole", F.lit(True)))
               .groupBy("text_key").agg(F.max(F.struct("whole", "cosine", (-F.col("template")).alias("order"), "license")).alias("best"))
               .join(covered, "text_key", "left").join(sizes, "text_key", "left")
               .select("text_key", F.col("best.license").alias("license"), F.col("best.cosine").alias("score"),
                       (F.col("best.whole") | F.coalesce(F.col("licensed") >= params.file_share * F.col("words"), F.lit(False))).alias("is_file")))
    of_text = written(of_text, "license_texts")

    directory = F.when(F.contains("path", F.lit("/")), F.regexp_replace("path", "/[^/]*$", "")).when(F.col("path").isNotNull(), F.lit(""))
    rows = written(src.select("doc_id", "path", directory.alias("dir"), F.md5("text").alias("text_key"))
                   .join(of_text, "text_key", "left")
                   .select("doc_id", "path", "dir", "license", "score", F.coalesce("is_file", F.lit(False)).alias("is_file")), "license_rows")
    # nearest licensed ancestor of every distinct directory; the path decides between two files of one directory
    governs = rows.filter("is_file and dir is not null").groupBy("dir").agg(
        F.max_by(F.struct("license", "path"), F.struct("score", "license", "path")).alias("file")).select("dir", "file.license", "file.path")
    dirs = rows.select("dir").filter("dir is not null").distinct()
    parts = F.split("dir", "/")
    up = dirs.select("dir", F.explode(F.sequence(F.lit(0), F.when(F.col("dir") == "", 0).otherwise(F.size(parts)))).alias("depth"))
    up = up.select("dir", "depth", F.array_join(F.slice(F.split("dir", "/"), 1, F.col("depth")), "/").alias("ancestor"))
    nearest = (up.join(governs.withColumnRenamed("dir", "ancestor"), "ancestor")
               .groupBy("dir").agg(F.max_by(F.struct("license", "ancestor"), "depth").alias("g"))
               .select("dir", F.col("g.license").alias("dir_license"), F.col("g.ancestor").alias("from_dir")))
    nearest = written(nearest, "license_dirs")
    return rows.join(nearest, "dir", "left").select(
        "doc_id", "path", "license", "score", "is_file",
        F.when(F.col("license").isNull(), F.col("dir_license")).alias("inherited_license"),
        F.when(F.col("license").isNull(), F.col("from_dir")).alias("inherited_from"))


def _cosines(parts: DataFrame, unit: DataFrame, idf: DataFrame, other: float) -> DataFrame:
    """text_key, template, license, start, cosine of (text_key, template, license, start, words)."""
    keys = ["text_key", "template", "license", "start"]
    weight = F.col("tf") * F.coalesce("idf", F.lit(other))
    weighed = (_term_counts(parts, keys, "words").join(F.broadcast(idf), "term", "left")
               .join(F.broadcast(unit.select("template", "term", "u")), ["template", "term"], "left").withColumn("w", weight))
    return (weighed.groupBy(*keys).agg(F.sum(F.col("w") * F.coalesce("u", F.lit(0.0))).alias("dot"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
            .select(*keys, F.round(F.col("dot") / F.col("norm"), 6).alias("cosine")))


def _rare_terms(unit: DataFrame, least: float) -> list[tuple]:
    """(template, license, term, power, need): of every template the terms besides its commonest, which any text is taken to have and
    which hold at most 0.8 ``least`` of the squared unit vector; the others must make up for ``need``."""
    of: dict[int, list] = {}
    for r in unit.collect():  # bounded by the template table
        of.setdefault(r["template"], []).append(r)
    out = []
    for i, rows in sorted(of.items()):
        given, rest = 0.0, []
        for r in sorted(rows, key=lambda r: (r["idf"], r["term"])):
            if not rest and given + r["u"] ** 2 <= 0.8 * least:
                given += r["u"] ** 2
            else:
                rest.append(r)
        out.extend((i, r["license"], r["term"], r["u"] ** 2, least - given - 1e-9) for r in rest)
    return out


def _notices(unit: DataFrame, threshold: float) -> list[tuple]:
    """(template, license, words, distinct terms, their squared unit weights, heaviest terms) of every notice."""
    of: dict[tuple[int, str], list] = {}
    for r in unit.collect():  # bounded by the template table
        of.setdefault((r["template"], r["license"]), []).append(r)
    return [(i, name, int(sum(r["tf"] for r in rows)), [r["term"] for r in rows], [r["u"] ** 2 for r in rows], _heaviest([(r["u"], r["term"]) for r in rows], threshold))
            for (i, name), rows in sorted(of.items())]


def _heaviest(weights: list[tuple[float, str]], threshold: float) -> list[str]:
    """The fewest heaviest terms without which a unit vector's dot product stays below the threshold."""
    rest = sum(u * u for u, _ in weights)
    taken = []
    for u, term in sorted(weights, reverse=True):
        if rest < (threshold - 1e-6) ** 2:
            break
        taken.append(term)
        rest -= u * u
    return taken

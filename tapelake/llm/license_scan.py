"""License scans: TF-IDF cosine of notices and licence files to templates, then inheritance from the nearest directory above.

Built-in functions only. A *unit* is a line of a file (a header or notice, wherever it stands) or a whole file. Its vector holds, for
each word, the number of times it occurs times its inverse document frequency over all files, ln((1 + files) / (1 + files with it)) + 1;
words that no template has weigh as words of no file. Templates are weighted alike.

1. Document frequencies of the templates' words over all whole texts, in one pass without a shuffle of words.
2. Anchors: the fewest words, heaviest first, such that the part of each template without them is shorter than the threshold
   times the template. By Cauchy-Schwarz a unit without anchors can't reach the threshold, so only lines with one are compared.
3. Sparse cosines: units' words joined with templates' words, summed per unit and template; the best template of each unit, and the
   best line of each file (ties: smaller template name, earlier line).
   Whole files are also compared to the texts of licence files (``licenses/``), with weights of those texts' own words. By the same
   bound a file needs a certain number of a text's words, so one more pass finds all files that either comparison can concern, and
   only those are compared. A file that reaches ``TEXT_COSINE`` with one has that licence, whatever notices stand in it.
4. A file is a licence file of its directory if its name says so or if as a whole it reaches ``FILE_COSINE``. A directory's licence is
   that of its most similar licence file. Each distinct directory is expanded into its ancestors, joined by path with the licensed
   ones, and takes the deepest. A file has its own licence, else its directory's.

The templates are fixed here or given by the caller as a list, so what is broadcast has the size of that list.

Defined results: null and empty texts have no licence of their own; a null path is a file without a directory, which inherits
nothing; rows that repeat a path are files of their own, told apart by their text; no files give no rows. Columns other than those
named are ignored.
"""

from __future__ import annotations

import math
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapelake.plans.staging import stage

LINE_COSINE = 0.6
FILE_COSINE = 0.5
TEXT_COSINE = 0.75

# Short notices of well-known licences, by SPDX identifier.
TEMPLATES = [
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LicenseRef-Reserved", "All rights reserved."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]
# Texts of licence files by SPDX identifier, read by the driver only.
TEXTS = [(path.stem, path.read_text("utf-8")) for path in sorted((Path(__file__).parent / "licenses").glob("*.txt"))]
NAMES = r"(?i)^(licen[cs]e|copying|unlicense)([._-].*)?$"
# Runs of letters and digits are words.
GAP = r"[^\p{L}\p{N}]+"


def template_words(templates: list[tuple[str, str]]) -> list[dict[str, int]]:
    """Word counts of each template."""
    out = []
    for _, text in templates:
        words = re.findall(r"[^\W_]+", text.lower())
        out.append({word: words.count(word) for word in words})
    return out


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), GAP), lambda word: word != "")


def known_words(text: Column, vocabulary: list[str]) -> Column:
    """The words of a text that are in the vocabulary, each once."""
    return F.array_intersect(F.split(F.lower(text), GAP), F.array(*map(F.lit, vocabulary)))


def document_frequencies(files: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """Number of files, and of files with each word."""
    if not vocabulary:
        return files.count(), {}
    found = files.select(F.explode(known_words(F.col("text"), vocabulary)).alias("word"))
    counts = found.groupBy("word").count().collect()  # one row per template word at most
    return files.count(), {row["word"]: row["count"] for row in counts}


def weights(templates: list[dict[str, int]], total: int, frequency: dict[str, int]) -> tuple[list[dict[str, float]], dict[str, float], float]:
    """Unit vectors of the templates, the weight of each of their words, and that of any other word."""
    other = math.log(1 + total) + 1
    idf = {word: math.log((1 + total) / (1 + frequency.get(word, 0))) + 1 for words in templates for word in words}
    vectors = []
    for words in templates:
        raw = {word: count * idf[word] for word, count in words.items()}
        length = math.sqrt(sum(value * value for value in raw.values()))
        vectors.append({word: value / length for word, value in raw.items()})
    return vectors, idf, other


def anchors(vectors: list[dict[str, float]], idf: dict[str, float], threshold: float) -> list[str]:
    """Words of which a unit needs one to reach the threshold with any template."""
    chosen: set[str] = set()
    for vector in vectors:
        rest = sum(value * value for word, value in vector.items() if word not in chosen)
        for word in sorted(vector, key=lambda w: (-idf[w], w)):
            if rest < threshold * threshold * (1 - 1e-9):
                break
            if word not in chosen:
                chosen.add(word)
                rest -= vector[word] ** 2
    return sorted(chosen)


def least_words(vector: dict[str, float], threshold: float) -> int:
    """The fewest distinct words of a template that a unit needs to reach the threshold with it.

    The part of the template on the unit's words must be as long as the threshold, and no set of fewer words is, the longest ones
    included (Cauchy-Schwarz).
    """
    mass = 0.0
    for n, value in enumerate(sorted(vector.values(), reverse=True), 1):
        mass += value * value
        if mass >= threshold * threshold * (1 - 1e-9):
            return n
    return len(vector)


def may_reach(text: Column, vectors: list[dict[str, float]], idf: dict[str, float], threshold: float) -> Column:
    """Whether a whole text has an anchor and enough of the words of any template; the text is cut into words once."""
    needed = [(sorted(vector), least_words(vector, threshold)) for vector in vectors if vector]
    if not needed:
        return F.lit(False)
    marks = F.array(*map(F.lit, anchors(vectors, idf, threshold)))

    def enough(known: Column) -> Column:
        some = F.lit(False)
        for words, least in needed:
            some = some | (F.size(F.array_intersect(known, F.array(*map(F.lit, words)))) >= least)
        return (F.size(known) >= min(least for _, least in needed)) & F.arrays_overlap(known, marks) & some

    # A lambda over an array of one binds the words, which would else be cut anew for each template.
    return F.coalesce(F.exists(F.array(known_words(text, sorted(idf))), enough), F.lit(False))


def cosines(units: DataFrame, keys: list[str], vectors: list[dict[str, float]], idf: dict[str, float], other: float, names: list[str]) -> DataFrame:
    """For units (keys, words): keys, license, score of the best template; units without a common word are left out."""
    spark = units.sparkSession
    rows = [(word, idf[word], [(k, vector[word]) for k, vector in enumerate(vectors) if word in vector]) for word in sorted(idf)]
    table = F.broadcast(spark.createDataFrame(rows, "word string, idf double, entries array<struct<template:int,value:double>>"))
    counted = units.select(*keys, F.explode("words").alias("word")).groupBy(*keys, "word").agg(F.count("*").alias("tf"))
    weighted = counted.join(table, "word", "left").withColumn("weight", F.col("tf") * F.coalesce("idf", F.lit(other)))
    lengths = weighted.groupBy(*keys).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("length"))
    parts = weighted.where("entries IS NOT NULL").select(*keys, "weight", F.explode("entries").alias("entry"))
    dots = parts.groupBy(*keys, F.col("entry.template").alias("template")).agg(F.sum(F.col("weight") * F.col("entry.value")).alias("dot"))
    scored = dots.join(lengths, keys).withColumn("score", F.round(F.col("dot") / F.col("length"), 6))
    license = F.element_at(F.array(*map(F.lit, names)), F.col("template") + 1)
    best = F.min(F.struct((-F.col("score")).alias("minus"), license.alias("license"), "score")).alias("best")
    return scored.groupBy(*keys).agg(best).select(*keys, F.col("best.license").alias("license"), F.col("best.score").alias("score"))


def directory(path: Column) -> Column:
    """What stands before the last ``/``; null without one."""
    return F.when(F.instr(path, "/") > 0, F.regexp_extract(path, r"^(.*)/[^/]*$", 1))


def nearest(directories: DataFrame, licensed: DataFrame) -> DataFrame:
    """For each directory: the licence of the nearest licensed directory at or above it, as (directory, from_directory, license)."""
    steps = F.split("directory", "/", -1)
    ancestors = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(steps, F.lit(1), k), "/").alias("above")))
    expanded = directories.select("directory", F.explode(ancestors).alias("step")).select("directory", "step.depth", "step.above")
    found = expanded.join(licensed.select(F.col("directory").alias("above"), "license"), "above")
    deepest = F.max(F.struct("depth", "above", "license")).alias("deepest")
    return found.groupBy("directory").agg(deepest).select("directory", F.col("deepest.above").alias("from_directory"), F.col("deepest.license").alias("license"))


def has_anchor(vectors: list[dict[str, float]], idf: dict[str, float], threshold: float) -> Column:
    words = "|".join(anchors(vectors, idf, threshold))
    return F.lower("text").rlike(rf"(?<![\p{{L}}\p{{N}}])({words})(?![\p{{L}}\p{{N}}])")


def scan(files: DataFrame, templates: list[tuple[str, str]] | None = None, line_cosine: float = LINE_COSINE, file_cosine: float = FILE_COSINE, texts: list[tuple[str, str]] | None = None) -> DataFrame:
    """A row per file (file_id, path, text): file_id, path, own_license, own_score, license, from_directory.

    ``license`` is the file's own or the inherited one, null without either; ``from_directory`` tells where it is inherited from.
    """
    templates = templates or TEMPLATES
    names = [name for name, _ in templates]
    files = files.select("file_id", F.col("path").cast("string").alias("path"), F.col("text").cast("string").alias("text"))
    texts = TEXTS if texts is None else texts
    counts, text_counts = template_words(templates), template_words(texts)
    total, frequency = document_frequencies(files, sorted({word for words in counts + text_counts for word in words}))
    vectors, idf, other = weights(counts, total, frequency)
    text_vectors, text_idf, _ = weights(text_counts, total, frequency)

    def anchored(threshold: float) -> Column:
        return has_anchor(vectors, idf, threshold)

    keys = ["file_id", "path", "tie"]
    lowest = min(line_cosine, file_cosine)
    flagged = files.select(
        "file_id",
        "path",
        "text",
        F.xxhash64("text").alias("tie"),
        may_reach(F.col("text"), text_vectors, text_idf, TEXT_COSINE).alias("full"),
        F.coalesce(F.arrays_overlap(F.split(F.lower("text"), GAP), F.array(*map(F.lit, anchors(vectors, idf, lowest)))), F.lit(False)).alias("noticed"),
    )
    some = stage(flagged.where("full OR noticed").dropDuplicates(keys), "anchored")
    long = some.where("full").select(F.struct(*keys).alias("unit"), words_of(F.col("text")).alias("words"))
    full = cosines(long, ["unit"], text_vectors, text_idf, other, [name for name, _ in texts]).where(F.col("score") >= TEXT_COSINE)
    full = full.select(F.col("unit").alias("file"), F.col("license").alias("text_license"), F.col("score").alias("text_score"))
    some = some.where("noticed")
    lines = some.select(*keys, F.posexplode(F.split("text", r"\n", -1)).alias("line_no", "text")).where(anchored(line_cosine))
    # Nulls among the keys must not part a unit from itself: they are joined as structs.
    unit = F.struct(*keys)
    lines = lines.select(F.struct(unit.alias("file"), "line_no").alias("unit"), words_of(F.col("text")).alias("words"))
    notices = cosines(lines, ["unit"], vectors, idf, other, names).where(F.col("score") >= line_cosine)
    own = F.min(F.struct((-F.col("score")).alias("minus"), F.col("unit.line_no").alias("line_no"), "license", "score")).alias("own")
    notices = notices.groupBy(F.col("unit.file").alias("file")).agg(own).select("file", F.col("own.license").alias("license"), F.col("own.score").alias("score"))
    whole = some.where(anchored(file_cosine)).select(unit.alias("unit"), words_of(F.col("text")).alias("words"))
    whole = cosines(whole, ["unit"], vectors, idf, other, names).select(F.col("unit").alias("file"), F.col("license").alias("whole_license"), F.col("score").alias("whole_score"))
    notices = notices.join(whole, "file", "full").join(full, "file", "full")
    for name in ("license", "whole_license"):
        notices = notices.withColumn(name, F.coalesce("text_license", name))
    for name in ("score", "whole_score"):
        notices = notices.withColumn(name, F.coalesce("text_score", name))
    notices = stage(notices.drop("text_license", "text_score"), "notices")

    # A licence file tells its directory's licence by its best notice, or by the whole of it.
    name = F.element_at(F.split("file.path", "/", -1), -1)
    is_license = (F.col("whole_score") >= file_cosine) | (name.rlike(NAMES) & F.col("score").isNotNull())
    told = notices.where(is_license).select(
        directory(F.col("file.path")).alias("directory"),
        F.when(F.coalesce("whole_score", F.lit(0.0)) >= F.coalesce("score", F.lit(0.0)), F.col("whole_license")).otherwise(F.col("license")).alias("license"),
        F.greatest("whole_score", "score").alias("score"),
    )
    best = F.min(F.struct((-F.col("score")).alias("minus"), "license")).alias("best")
    licensed = stage(told.where("directory IS NOT NULL").groupBy("directory").agg(best).select("directory", F.col("best.license").alias("license")), "licensed")

    placed = files.select("file_id", "path", F.xxhash64("text").alias("tie"), directory(F.col("path")).alias("directory"))
    inherited = nearest(placed.select("directory").where("directory IS NOT NULL").distinct(), licensed).withColumnRenamed("license", "above_license")
    mine = notices.where("license IS NOT NULL").select("file", F.col("license").alias("own_license"), F.col("score").alias("own_score"))
    out = placed.withColumn("file", F.struct(*keys)).join(mine, "file", "left").join(inherited, "directory", "left")
    own = F.col("own_license").isNotNull()
    return out.select("file_id", "path", "own_license", "own_score", F.coalesce("own_license", "above_license").alias("license"), F.when(~own, F.col("from_directory")).alias("from_directory"))


def document_files(documents: DataFrame) -> DataFrame:
    """Documents (doc_id, text, lang, source) as files: ``source/lang/thousands of doc_id/doc_id.txt``."""
    path = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("unknown")), F.expr("doc_id div 1000").cast("string"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return documents.select(F.col("doc_id").alias("file_id"), F.when(F.col("doc_id").isNotNull(), path).alias("path"), "text")

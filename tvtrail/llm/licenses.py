"""License notices in texts by diagonal voting; built-in functions only.

Every run of ``GRAM`` consecutive words of a text is joined by hash, and by the words
themselves, with the places it has in the license templates.  Each match votes for a
diagonal, the place in the text less the place in the template: the votes of one notice
share a diagonal, and words put in or left out move the rest to a neighbouring one.
Neighbouring diagonals are merged, and a merged span holds if it covers enough of its
template, versions included.  A template marked exact counts the diagonals that cover it wholly.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

GRAM = 3
# Neighbouring diagonals lie this far apart at most, and no further than words may be missing.
SHIFT = 4
# Of every ten words of its template a span may leave out so many; a word with a digit, a version, never.
MISSING = 2
# Templates are broadcast up to this many words; more are joined by shuffle.
BROADCAST_WORDS = 100_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """A passage that names a license; of an ``exact`` one, every whole place is told."""

    label: str
    text: str
    exact: bool = False


# The base phrases, then notices as the licenses word them.
TEMPLATES = (
    Template("mit", "under the mit license", exact=True),
    Template("apache-2", "apache license version 2", exact=True),
    Template("cc-by-nc", "cc by nc", exact=True),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    Template("apache-2", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    Template("gpl-2", "GNU General Public License, version 2"),
    Template("gpl-2", "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    Template("gpl-3", "GNU General Public License, version 3"),
    Template("gpl-3", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    Template("lgpl", "GNU Lesser General Public License"),
    Template("agpl-3", "GNU Affero General Public License"),
    Template("mpl-2", "subject to the terms of the Mozilla Public License, v. 2.0"),
    Template("cc-by-nc", "Creative Commons Attribution-NonCommercial 4.0 International"),
    Template("cc-by-sa", "Creative Commons Attribution-ShareAlike 4.0 International"),
    Template("cc-by", "Creative Commons Attribution 4.0 International"),
    Template("cc0", "CC0 1.0 Universal Public Domain Dedication"),
    Template("unlicense", "This is free and unencumbered software released into the public domain"),
)


def words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; none for null."""
    value = F.coalesce(text, F.lit(""))
    plain = F.octet_length(value) == F.char_length(value)
    lowered = F.when(plain, F.lower(value)).otherwise(F.translate(value, _UPPER, _LOWER))
    return F.regexp_extract_all(lowered, F.lit(_WORD), F.lit(0))


def template_grams(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """One row per run of words of a template: ``_gram`` (hash), its place and the template's measures."""
    given = json.dumps([{"template": n, **asdict(t)} for n, t in enumerate(templates)])
    listed = spark.range(1).select(F.inline(F.from_json(
        F.lit(given), "array<struct<template:int,label:string,text:string,exact:boolean>>")))
    split = listed.select("template", "label", "exact", words(F.col("text")).alias("t_words"))
    versions = F.filter(F.transform("t_words", lambda w, i: F.when(w.rlike("[0-9]"), i)), lambda i: i.isNotNull())
    placed = split.where(F.size("t_words") >= GRAM).select(
        "*", F.size("t_words").alias("t_length"), versions.alias("versions"), F.explode(F.sequence(F.lit(0), F.size("t_words") - GRAM)).alias("t_at"))
    run = [F.get("t_words", F.col("t_at") + k) for k in range(GRAM)]
    return placed.select(F.xxhash64(*run).alias("_gram"), *[w.alias(f"t_{k}") for k, w in enumerate(run)],
                         "template", "label", "exact", "t_length", "versions", "t_at")


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, text: str = "text", into: str = "licenses") -> DataFrame:
    """The columns of ``docs`` but its text, and a struct of what was found.

    n_words; spans: (label, start, end, score, exact) of verified notices, in order of place,
    places counted in words, end exclusive, score the share of the template that is covered.  A merged
    span holds if it covers its template but for ``MISSING`` of every ten words and is at most twice as long; a
    place of an exact template covers all of it.  Templates of fewer than ``GRAM`` words match nothing.

    A null text is an empty one: no words, no spans.  Every input row gives one row, repeated rows
    and rows without key too: rows are told apart by a number of their own.  The text itself is not
    shuffled: a row leaves the scan once without it, and once more for every match.
    """
    spark = docs.sparkSession
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != text.lower()])
    rows = docs.select(
        F.monotonically_increasing_id().alias("_id"), others.alias("_row"), words(F.col(f"`{text}`")).alias("_words"))
    # Place -1 is the row itself, whether or not it has words.
    places = F.sequence(F.lit(-1), F.greatest(F.lit(-1), F.size("_words") - GRAM))
    placed = rows.select("*", F.explode(places).alias("_at"))
    run = [F.get("_words", F.col("_at") + k) for k in range(GRAM)]
    grams = template_grams(spark, templates)
    if sum(len(t.text) for t in templates) <= BROADCAST_WORDS:
        grams = F.broadcast(grams)  # a text has more letters than words
    same = F.col("_hash") == F.col("_gram")
    for k, word in enumerate(run):
        same &= word == F.col(f"t_{k}")
    votes = (
        placed.withColumn("_hash", F.when(F.col("_at") >= 0, F.xxhash64(*run)))
        .join(grams, same, "left")
        .where((F.col("_at") < 0) | F.col("template").isNotNull())
        .select("_id", F.when(F.col("_at") < 0, F.struct("_row", F.size("_words").alias("n_words"))).alias("_own"),
                "template", "label", "exact", "t_length", "versions", "t_at", (F.col("_at") - F.col("t_at")).alias("diagonal"))
        .repartition("_id")  # one shuffle: all that follows is grouped by the row first
    )
    found = _spans(votes)
    spans = F.array_sort(F.collect_list(F.when(F.col("label").isNotNull(), F.struct(
        "start", "end", "label", "score", "exact"))))
    whole = found.groupBy("_id").agg(F.first("_own", ignorenulls=True).alias("_own"), spans.alias("spans"))
    old = [c for c in docs.columns if c.lower() not in {text.lower(), into.lower()}]
    return whole.select(
        *[F.col("_own._row")[c].alias(c) for c in old],
        F.struct(F.col("_own.n_words").cast("bigint").alias("n_words"), "spans").alias(into))


def _spans(votes: DataFrame) -> DataFrame:
    """Votes to verified spans (``label`` set) beside one row per text (``_own`` set)."""
    key = ["_id", "template"]
    same = [F.max(c).alias(c) for c in ("label", "exact", "t_length", "versions")]
    diagonals = votes.groupBy(*key, "diagonal").agg(
        F.first("_own", ignorenulls=True).alias("_own"), *same, F.collect_list("t_at").alias("hits"))
    allowed = F.when(F.col("exact"), 0).otherwise(F.floor(F.col("t_length") / 10) * MISSING)
    before = Window.partitionBy(*key).orderBy("diagonal")
    cut = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(before) > F.least(F.lit(SHIFT), allowed), F.lit(True))
    merged = (
        diagonals.withColumn("_cut", cut.cast("int"))
        .withColumn("_group", F.sum("_cut").over(before.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*key, "_group").agg(
            F.first("_own", ignorenulls=True).alias("_own"), *same, F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits"),
            F.min(F.col("diagonal") + F.array_min("hits")).alias("start"),
            F.max(F.col("diagonal") + F.array_max("hits") + GRAM).alias("end"))
    )
    covered = F.array_distinct(F.flatten(F.transform("hits", lambda t: F.sequence(t, t + GRAM - 1))))
    missing = F.col("t_length") - F.size("covered")
    holds = (
        (missing <= allowed) & (F.size(F.array_except("versions", "covered")) == 0)
        & (F.col("end") - F.col("start") <= 2 * F.col("t_length")))
    return merged.withColumn("covered", covered).where(F.col("_own").isNotNull() | holds).select(
        "_id", "_own", "label", "exact", "start", "end", (F.size("covered") / F.col("t_length")).alias("score"))

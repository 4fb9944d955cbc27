"""License scans with DataFrame functions only: MinHash bands over overlapping windows, then exact containment."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage.llm.common import text_or_empty

WORDS = 5  # words in a shingle
CONTAINMENT = 0.8  # least share of a template's shingles found in one window
BANDS = 64  # of one MinHash value each
SIZES = (4, 8, 16, 32)  # template classes, in shingles

# Notice texts of common licenses.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0 notice", "you may not use this file except in compliance with the License"),
    ("MIT", "Released under the MIT License"),
    ("MIT grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL notice", "This program is free software: you can redistribute it and/or modify it under the terms of"),
    ("LGPL", "under the terms of the GNU Lesser General Public License"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY notice", "This work is licensed under a Creative Commons Attribution"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("all rights", "All rights reserved. No part of this work may be reproduced"),
)


def word_array(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def shingle_hashes(words: Column, size: int = WORDS) -> Column:
    """64-bit hashes of all runs of ``size`` words, in order; a shorter text has none."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    starts = F.when(F.size(words) >= size, F.sequence(F.lit(0), F.size(words) - size))
    # The hashes pass through a one-element array so that they are computed once per text, not once per shingle.
    per_text = F.transform(
        F.array(hashes),
        lambda h: F.transform(
            F.coalesce(starts, F.array().cast("array<int>")), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(size)])
        ),
    )
    return F.get(per_text, F.lit(0))


def signature(shingles: Column, bands: int = BANDS) -> Column:
    """One band key per hash function: the function's number with its least value over the set."""

    def band(number: int) -> Column:
        return F.xxhash64(F.lit(number), F.array_min(F.transform(shingles, lambda s: F.xxhash64(s, F.lit(number)))))

    return F.array(*[band(j) for j in range(bands)])


def template_table(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """``license, shingles, class`` per template; a template needs at least ``WORDS`` words and at most 36."""
    rows = F.array(*[F.struct(F.lit(name).alias("license"), F.lit(text).alias("notice")) for name, text in templates])
    table = spark.range(1).select(F.inline(rows)).withColumn(
        "shingles", F.array_distinct(shingle_hashes(word_array(F.col("notice"))))
    )
    size = F.size("shingles")
    bounds = F.coalesce(*[F.when(size <= c, F.lit(c)) for c in SIZES])
    return table.select("license", "shingles", bounds.alias("class"))


def families(shingles: dict[str, list[int]], containment: float) -> dict[str, str]:
    """Templates so alike that one notice would match both (versions of a license) get one name, the first in order."""
    out: dict[str, str] = {}
    for name in sorted(shingles):
        own = set(shingles[name])
        near = (o for o in out if len(own & set(shingles[o])) >= containment * min(len(own), len(shingles[o])))
        out[name] = next((out[o] for o in near), name)
    return out


def scan_licenses(
    docs: DataFrame,
    templates=TEMPLATES,
    id_col: str = "doc_id",
    text_col: str = "text",
    containment: float = CONTAINMENT,
) -> DataFrame:
    """One row per document and license found: ``doc_id, license, containment, windows, first_word``.

    A template of at most c shingles (c a power of two, more than half full
    unless it is the smallest) is looked for in windows of 3c/2 shingles that
    start every c/2, so each occurrence lies whole in some window.  A window
    that holds 80 % of it has similarity of about 1/4 or more (1/6 for a single
    shingle), and shares one of 64 bands with probability of at least
    1 - (5/6)**64 = 0.99999.  Windows that share a band with a template are
    confirmed by the exact share of its shingles that they hold.

    A text or window without any template shingle has containment 0, so it is
    passed over before signatures are computed; this drops nothing.

    Everything is built-in functions.  The template table is fixed and small;
    its band table (templates x bands rows) is the only thing broadcast.
    Of templates that are nearly the same text, a window counts for the one it
    holds most of.  ``containment`` is the best window's, ``windows`` the number of windows that
    hold the license, ``first_word`` the first such window's first word (from 0).

    Defined cases: null, empty and short texts give no row; repeated ids are
    one document with the best of their rows; other columns are ignored.
    """
    spark = docs.sparkSession
    fixed = [
        (r["license"], r["shingles"], r["class"]) for r in template_table(spark, templates).collect()
    ]  # as many rows as templates
    for name, shingles, size in fixed:
        if not shingles or size is None:
            raise ValueError(f"template {name!r} needs {WORDS} to {max(SIZES) + WORDS - 1} words")
    every = F.array(*[F.lit(x) for x in sorted({x for _, shingles, _ in fixed for x in shingles})]) if fixed else F.array().cast("array<bigint>")
    texts = (
        docs.select(F.col(id_col).alias("doc_id"), shingle_hashes(word_array(text_or_empty(text_col))).alias("s"))
        .where(F.arrays_overlap("s", every))
    )
    size = F.col("size")
    windows = (
        texts.withColumn("size", F.explode(F.array(*[F.lit(c) for c in SIZES])))
        .select(
            "doc_id",
            "size",
            "s",
            F.explode(F.sequence(F.lit(0), F.size("s") - 1, F.expr("size div 2"))).alias("at"),
        )
        .select("doc_id", "size", "at", F.array_distinct(F.slice("s", F.col("at") + 1, F.expr("size * 3 div 2"))).alias("w"))
        .where(F.arrays_overlap("w", every))
    )
    bands = windows.select("doc_id", "size", "at", "w", F.explode(F.array_distinct(signature(F.col("w")))).alias("band"))
    known = template_table(spark, templates)
    known_bands = known.select(
        "license", F.col("shingles").alias("t"), F.col("class"), F.explode(F.array_distinct(signature(F.col("shingles")))).alias("tband")
    )
    held = F.size(F.array_intersect("w", "t")) / F.size("t")
    alike = families({name: shingles for name, shingles, _ in fixed}, containment)
    family = F.coalesce(*[F.when(F.col("license") == name, F.lit(alike[name])) for name in alike], F.col("license"))
    return (
        bands.join(F.broadcast(known_bands), (F.col("band") == F.col("tband")) & (size == F.col("class")))
        .withColumn("held", held)
        .where(F.col("held") >= F.lit(containment))
        .groupBy("doc_id", "size", "at", family.alias("family"))
        .agg(F.max(F.struct("held", "license")).alias("best"))
        .groupBy("doc_id", F.col("best.license").alias("license"))
        .agg(
            F.max("best.held").alias("containment"),
            F.count_distinct("at").alias("windows"),
            F.min("at").cast("long").alias("first_word"),
        )
    )


def oracle_sql(templates=TEMPLATES, containment: float = CONTAINMENT) -> str:
    """The same windows searched without signatures: every window around a template shingle is measured."""
    sets = {}
    for name, text in templates:
        found = re.findall(r"[^\W_]+", text.lower())
        sets[name] = sorted({" ".join(found[i : i + WORDS]) for i in range(len(found) - WORDS + 1)})
    alike = families(sets, containment)
    rows = ", ".join(
        f"('{name}', {next(c for c in SIZES if len(own) <= c)}, '{alike[name]}', {len(own)}, '{shingle}')"
        for name, own in sets.items()
        for shingle in own
    )
    return f"""
WITH t AS (SELECT * FROM (VALUES {rows}) AS v(license, size, family, total, shingle)),
d AS (
  SELECT doc_id, [x FOR x IN string_split_regex(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+') IF x <> ''] AS w
  FROM documents),
s AS (
  SELECT doc_id, unnest(range(0, len(w) - {WORDS - 1})) AS pos,
         unnest([array_to_string(w[i:i + {WORDS - 1}], ' ') FOR i IN range(1, len(w) - {WORDS - 2})]) AS shingle
  FROM d WHERE len(w) >= {WORDS}),
h AS (
  SELECT s.doc_id, t.*, s.pos,
         unnest(range(greatest(0, (pos - size * 3 // 2 + size // 2) // (size // 2)), pos // (size // 2) + 1)) * (size // 2) AS begin_at
  FROM s JOIN t ON s.shingle = t.shingle),
w AS (
  SELECT doc_id, license, size, family, begin_at, count(DISTINCT shingle) / total AS held
  FROM h WHERE pos >= begin_at AND pos < begin_at + size * 3 // 2 GROUP BY doc_id, license, size, family, begin_at, total),
b AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, size, begin_at, family ORDER BY held DESC, license DESC) AS place
  FROM w WHERE held >= {containment})
SELECT doc_id, license, max(held) AS containment, count(DISTINCT begin_at) AS windows, min(begin_at)::BIGINT AS first_word
FROM b WHERE place = 1 GROUP BY doc_id, license
"""

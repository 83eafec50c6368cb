"""License notices by MinHash bands over overlapping text windows, with built-in functions only.

Texts and templates become hashes of five-word shingles.  Windows of ``WINDOW`` shingles
begin at every shingle, and before the first one and after the last one they are cut, so
every shingle of a text, also at both ends, lies in ``WINDOW`` windows.  Each of the
``BANDS`` bands is the minimum of one hash function over the shingles; a template has the
keys of each of its shingles.  A shingle is the minimum in one of its two windows unless
both neighbours are smaller, so a band misses a lone one with 1/3 and all of them with
3 ** -BANDS, about 2e-8; the first and the last shingle of a text, and two in a row, are
windows of their own and never missed.  A template that shares a band with a document is
retrieved, and its shingles are then counted over all of the document.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.plans.materialize import checkpointed

SHINGLE, WINDOW, BANDS = 5, 2, 16

#: Wording of published licence notices.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def _words(text: Column) -> Column:
    """Runs of a-z and 0-9 after lower-casing."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+"), "")


def _shingled(rows: DataFrame) -> DataFrame:
    """``words`` replaced by ``hashes``, one for each five-word shingle; null with fewer words."""
    last = F.size("words") - SHINGLE
    hashes = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.xxhash64(*(F.get(F.col("words"), i + k) for k in range(SHINGLE)))
    )
    return rows.withColumn("hashes", F.when(last >= 0, hashes)).drop("words")


def _windows(hashes: str) -> Column:
    """Slices of ``WINDOW`` that end at every shingle and, cut, beyond the last; the first ones are cut too."""
    n = F.size(hashes)
    ends = F.sequence(F.lit(1), n + WINDOW - 1)
    begin = lambda end: F.greatest(end - WINDOW + 1, F.lit(1))
    return F.transform(ends, lambda end: F.slice(F.col(hashes), begin(end), F.least(end, n) - begin(end) + 1))


def _banded(parts: DataFrame, length: int) -> DataFrame:
    """Columns ``k0, k1, ...``, the minimum of every hash function; a missing place repeats the first shingle."""
    places = [F.coalesce(F.get("part", F.lit(j)), F.get("part", F.lit(0))).alias(f"p{j}") for j in range(length)]
    keys = [F.least(*(F.xxhash64(F.lit(b), F.col(f"p{j}")) for j in range(length))).alias(f"k{b}") for b in range(BANDS)]
    return parts.select("*", *places).select(*parts.columns, *keys)


_KEYS = [f"k{b}" for b in range(BANDS)]


def templates_frame(spark: SparkSession, templates: tuple[tuple[str, str], ...]) -> DataFrame:
    """``template, license, hashes``; a template needs five words."""
    rows = F.array(*(F.struct(F.lit(i).alias("template"), F.lit(n).alias("license"), F.lit(t).alias("text")) for i, (n, t) in enumerate(templates)))
    frame = spark.range(1).select(F.inline(rows))
    return _shingled(frame.select("template", "license", _words(F.col("text")).alias("words")))


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES,
    percent: int = 75,
) -> DataFrame:
    """``id_col, license, template, n_found, containment``: one row for each document and template in it.

    A template is in a document when ``percent`` of its distinct shingles are anywhere in
    it.  Null and short texts have none; rows with equal ids count as one document; extra
    columns are ignored.
    """
    known = checkpointed(templates_frame(docs.sparkSession, templates))
    single = known.select("template", F.explode(F.array_distinct("hashes")).alias("shingle"))
    banded = _banded(single.withColumn("part", F.array("shingle")), WINDOW)
    # place BANDS is the shingle itself
    keys = checkpointed(banded.select("template", F.array(*_KEYS, "shingle").alias("keys")))
    # the templates are a parameter: BANDS keys for each shingle of their text
    wanted = [sorted(w) for w in zip(*{tuple(r["keys"]) for r in keys.collect()}, strict=True)] or [[]] * (BANDS + 1)
    texts = docs.select(F.col(id_col).alias("id"), _words(F.col(text_col)).alias("words"))
    windows = _shingled(texts).select("id", F.explode(_windows("hashes")).alias("part"))
    # every shingle of a text is the last of a window
    own = F.element_at("part", -1)
    places = [*map(F.col, _KEYS), own]
    some = reduce(or_, (k.isin(w) for k, w in zip(places, wanted, strict=True)))
    # the test is part of the generator: as a filter it would be pushed below the bands and repeat them
    alike = _banded(windows, WINDOW).select("id", F.posexplode(F.when(some, F.array(*places))).alias("place", "key"))
    lookup = keys.select("template", F.posexplode("keys").alias("place", "key"))
    full = known.select("template", "license", F.size(F.array_distinct("hashes")).alias("n")).where("n > 0")
    hits = alike.join(F.broadcast(lookup.join(full, "template")), ["place", "key"]).select(
        "id", "license", "template", "n", F.when(F.col("place") == BANDS, F.col("key")).alias("shingle")
    )
    share = F.col("n_found") / F.col("n")
    return (
        hits.groupBy("id", "license", "template", "n", "shingle").agg(F.lit(1).alias("one"))
        .groupBy("id", "license", "template", "n")
        .agg(F.count("shingle").alias("n_found"), F.bool_or(F.col("shingle").isNull()).alias("retrieved"))
        .where(F.col("retrieved") & (100 * F.col("n_found") >= percent * F.col("n")))
        .select(F.col("id").alias(id_col), "license", "template", "n_found", share.alias("containment"))
    )

"""License scan in DataFrame functions only: MinHash bands over overlapping text windows retrieve
license templates, exact shingle containment verifies them.

A window is ``WINDOW`` shingles of ``SHINGLE`` words, the next one begins ``STEP`` shingles later.
Template windows begin at every place. A band is one MinHash: the least of the shingles' hashes,
hashed once more with a constant of the band. Some document window holds a template of up to
``WINDOW - STEP + 1`` shingles as a whole and lies within a longer one as a whole or overlaps it by
as much, so their similarity is at least ``LEAST_SHINGLES / WINDOW`` and the number of bands follows
from the collision probability that is asked for.

A template of fewer shingles has to be contained as a whole, so it is found by its first shingle: a
window of one shingle that begins at every place, with similarity 1 and one band, the shingle's hash.
"""

from __future__ import annotations

import math
import random
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskgraph.llm.shingles import token_hashes
from riskgraph.sources.staging import stage

SHINGLE, WINDOW, STEP = 3, 8, 4
LEAST_SHINGLES = 3
COLLISION = 0.995
CONTAINMENT = 0.8
#: Template keys (two numbers each) that are broadcast; more are joined by shuffling.
BROADCAST_KEYS = 1_000_000

#: Whole texts of licenses, a file each.
TEXTS = Path(__file__).parent / "license_texts"

# Notices of public licenses.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain"
                   " a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
            " software and associated documentation files"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are"
            " permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the"
            " terms of the GNU General Public License as published by the Free Software"
            " Foundation"),
    ("LGPL", "under the terms of the GNU Lesser General Public License as published by the Free"
             " Software Foundation"),
    ("AGPL-3.0", "licensed under the GNU Affero General Public License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License,"
                " v. 2.0"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with"
            " or without fee is hereby granted"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0"),
    ("CC-BY", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related"
                " or neighboring rights to this work"),
    ("All-Rights-Reserved", "Copyright. All rights reserved. No part of this publication may be"
                            " reproduced"),
    ("All-Rights-Reserved", "All rights reserved"),
)


def bands_for(similarity: float, collision: float) -> int:
    """Bands of one MinHash each that collide at least once with the asked probability."""
    return math.ceil(math.log(1 - collision) / math.log(1 - similarity))


BANDS = bands_for(LEAST_SHINGLES / WINDOW, COLLISION)


def _constants() -> list[int]:
    rng = random.Random(2024)
    return [rng.getrandbits(63) for _ in range(BANDS)]


def templates(spark: SparkSession) -> DataFrame:
    """(template_id, license, text) of the built-in notices, then of the whole license texts that
    stand beside this module. They are few and of fixed size; ``read_templates`` takes larger sets."""
    texts = [(p.stem, p.read_text(encoding="utf-8")) for p in sorted(TEXTS.glob("*.txt"))]
    return spark.createDataFrame([(k, *row) for k, row in enumerate([*TEMPLATES, *texts])],
                                 "template_id int, license string, text string")


def read_templates(spark: SparkSession, path: str) -> DataFrame:
    """(template_id, license, text) of a folder of text files, each named after its license and
    holding one whole text. Ids are hashes of the file names, so they do not change as files are
    added; files without words are left out. The folder may lie in any store that Spark reads."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.txt").select(
        F.element_at(F.split(F.input_file_name(), "/"), -1).alias("name"),
        F.col("value").alias("text"))
    return files.where(F.col("text").rlike(r"[\p{L}\p{N}]")).select(
        F.xxhash64("name").alias("template_id"),
        F.url_decode(F.regexp_replace("name", r"\.txt$", "")).alias("license"), "text")


def _permuted(shingle: Column, flip: Column) -> Column:
    """Hash of a shingle in a band; null for none, whose own hash would be one key of all windows at
    the end of a text or template."""
    return F.when(shingle.isNotNull(), F.xxhash64(shingle.bitwiseXOR(flip)))


def _banded(places: DataFrame, kept: list[str], singles: int = 0) -> DataFrame:
    """``places`` (tokens, at, kept columns) with ``window`` (its shingle hashes) and, one row per
    band, ``band`` and ``key``, the window's MinHash in the band.

    Bands are rows before the MinHash is taken, so that the generated code stays small. Bands from
    ``BANDS`` on have the hash of one shingle each, of the window's first ``singles`` ones.
    """
    words, windows = range(WINDOW + SHINGLE - 1), range(WINDOW)
    read = places.select(*kept, *[F.get("tokens", F.col("at") + k).alias(f"t{k}") for k in words])
    hashed = read.select(*kept, *[
        F.when(F.col(f"t{k + SHINGLE - 1}").isNotNull(),
               F.xxhash64(*[f"t{k + j}" for j in range(SHINGLE)])).alias(f"w{k}")
        for k in windows]).where("w0 is not null")
    own = ["w0", *[f"w{k}" for k in windows if k]]
    banded = hashed.select(*kept, *own, F.posexplode(F.array(
        *[F.lit(c) for c in _constants()], *own[:singles])).alias("band", "flip"))
    key = F.least(*[_permuted(F.col(w), F.col("flip")) for w in own])
    if singles:
        key = F.when(F.col("band") < BANDS, key).otherwise(F.col("flip"))
    return banded.select(*kept, "band", F.array(*own).alias("window"), key.alias("key"))


def _is_short() -> Column:
    """True of templates that are found by one shingle."""
    return F.size("tokens") < SHINGLE + LEAST_SHINGLES - 1


def _template_keys(known: DataFrame) -> DataFrame:
    """(template_id, key) of all windows of the templates, beginning at every place. Near the end
    of a template its windows are the shorter rests, down to LEAST_SHINGLES shingles. A template
    with fewer has its first shingle."""
    rests = F.size("tokens") - F.lit(SHINGLE + LEAST_SHINGLES - 2)
    places = known.select("template_id", "tokens",
                          F.posexplode("tokens").alias("at", "token")).where(F.col("at") < rests)
    short = known.where(_is_short()).select(
        "template_id", F.xxhash64(*[F.get("tokens", F.lit(j)) for j in range(SHINGLE)])
        .alias("key"))
    return (_banded(places, ["template_id"]).select("template_id", "key").unionAll(short)
            .distinct())


def _first_hit(own: Column) -> Column:
    """True unless the window met the template in an earlier band already."""
    flips = F.slice(F.array(*[F.lit(c) for c in _constants()]), F.lit(1), F.col("band"))
    return ~F.exists(flips, lambda c: F.array_contains(own, F.array_min(
        F.transform("window", lambda w: _permuted(w, c)))))


def _shingles(tokens: str, first: Column, end: Column) -> Column:
    """Distinct shingle hashes of the places from ``first`` up to ``end`` of a column of token
    hashes. Places are read one by one, as a slice in the lambda would be cut anew for each."""
    return F.array_distinct(F.transform(
        F.sequence(first, F.greatest(F.least(end, F.size(tokens)) - SHINGLE, first)),
        lambda i: F.xxhash64(*[F.get(F.col(tokens), i + j) for j in range(SHINGLE)])))


def _verify(hits: DataFrame) -> DataFrame:
    """Share of the template's shingles that stand around the window, for (doc_id, at, tokens,
    template_id, template)."""
    reach = F.size("template")
    first = F.greatest(F.col("at") - reach, F.lit(0))
    end = first + WINDOW + SHINGLE + 2 * reach
    found = F.array_intersect(F.col("shingles"), _shingles("tokens", first, end))
    return (hits.withColumn("containment", F.size(found) / F.size("shingles"))
            .where(F.col("containment") >= CONTAINMENT)
            .select("doc_id", "template_id", "at", "containment"))


def scan_licenses(docs: DataFrame, known: DataFrame,
                  broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """(doc_id, license, template_id, containment, at): notices found in whole texts.

    One row for each document and template: the best containment and the token at which the first
    verified window begins. ``known`` has template_id, license and text; a template needs
    ``SHINGLE`` words or more, a shorter one is an error. Null and empty texts
    and tables have no notices; repeated doc_ids count as one document. While the templates have
    few keys these are broadcast and windows are verified where the documents are read.
    """
    least = SHINGLE
    known = known.select("template_id", "license", token_hashes("text").alias("tokens"))
    known = known.withColumn("tokens", F.when(F.size("tokens") >= least, F.col("tokens")).otherwise(
        F.expr(f"raise_error('a template needs {least} words')")))
    known = stage(known.withColumn("shingles", _shingles(
        "tokens", F.lit(0), F.size("tokens"))), "license-templates")
    keys = stage(_template_keys(known), "license-keys")
    short = not known.where(_is_short()).isEmpty()
    own = keys.groupBy("template_id").agg(F.collect_set("key").alias("own"))
    known = known.select("template_id", "license", F.col("tokens").alias("template"), "shingles")
    tokens = docs.select("doc_id", token_hashes("text").alias("tokens"))
    # The outer form keeps the planner from computing the tokens once more for a filter.
    starts = F.explode_outer(F.sequence(
        F.lit(0), F.greatest(F.size("tokens") - 1, F.lit(0)), F.lit(STEP)))
    banded = _banded(tokens.select("doc_id", "tokens", starts.alias("at")),
                     ["doc_id", "tokens", "at"], STEP if short else 0)
    place = (F.col("at") + F.greatest(F.col("band") - BANDS, F.lit(0))).alias("at")
    small = keys.count() <= broadcast_keys
    if small:
        hits = (banded.join(F.broadcast(keys), "key")
                .join(F.broadcast(known.join(own, "template_id")), "template_id")
                .where(_first_hit(F.col("own"))).withColumn("at", place))
    else:
        pairs = (banded.select("doc_id", "band", "at", "key").join(keys, "key")
                 .select("doc_id", place, "template_id").distinct())
        hits = pairs.join(tokens, "doc_id").join(known, "template_id")
    best = _verify(hits).groupBy("doc_id", "template_id").agg(
        F.max("containment").alias("containment"), F.min("at").alias("at"))
    names = known.select("template_id", "license")
    return best.join(F.broadcast(names) if small else names, "template_id").select(
        "doc_id", "license", "template_id", "containment", "at")

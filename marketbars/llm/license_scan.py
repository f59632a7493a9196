"""License scans: MinHash bands retrieve templates, exact containment verifies.

Texts and templates become words (letters and digits, lower case) and shingles
of five words. A template of m shingles is looked for in overlapping windows of
2m shingles that start every m/2, so an occurrence lies whole in at least one.
Each window and template has ``BANDS`` MinHash values, each a band of its own;
a window is compared with a template when any band is equal. A window holding
the share c of a template's shingles has a Jaccard similarity of at least
c / (3 - c), so it is retrieved with probability 1 - (1 - c / (3 - c)) ** BANDS:
over 0.99999 for whole templates and 0.9997 for those of containment 0.8. The
shingles themselves then decide: the share of the template's that the window
holds has to reach ``LEAST``.

A band of one value can only be equal if the window holds the shingle that is
the template's minimum. So windows are made around those shingles only; all
others cannot be retrieved. Templates are a parameter of fixed size, so all of
this runs where the text is read and nothing but matches is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketbars.llm.common import let

SHINGLE = 5
BANDS = 24
LEAST = 0.8
MOST_TEMPLATES = 500  # bounds the broadcast of sketches and the list of anchors

NOT_WORD = r"[^\p{L}\p{N}]+"

# Usual notices of public licenses, by SPDX identifier.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at"
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met"
    ),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0-or-later": (
        "under the terms of the GNU General Public License as published by the Free Software "
        "Foundation; either version 2 of the License, or (at your option) any later version"
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted"
    ),
    "MIT": "Released under the MIT License.",
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files"
    ),
    "MPL-2.0": "subject to the terms of the Mozilla Public License, v. 2.0.",
}


def shingles(text: Column) -> Column:
    """64-bit hashes of each five words in a row; none for fewer words."""
    words = F.filter(
        F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD), lambda w: w != F.lit("")
    )

    def hashed(of: Column) -> Column:
        starts = F.when(
            F.size(of) >= SHINGLE, F.sequence(F.lit(0), F.size(of) - SHINGLE)
        ).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.xxhash64(*(of[i + k] for k in range(SHINGLE))))

    return let(words, hashed)


def bands(hashes: Column) -> Column:
    """The minimum of the shingles under each hash."""

    def least(k: int) -> Column:
        return F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, F.lit(k))))

    return F.array(*map(least, range(BANDS)))


def anchors(hashes: Column) -> Column:
    """The shingles that are a minimum under any hash."""

    def least(k: int) -> Column:
        pairs = F.transform(
            hashes, lambda h: F.struct(F.xxhash64(h, F.lit(k)).alias("v"), h.alias("h"))
        )
        return F.array_min(pairs)["h"]

    return F.array_distinct(F.array(*(least(k) for k in range(BANDS))))


def notices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sorted(NOTICES.items()), "license string, notice string")


def sketches(templates: DataFrame) -> DataFrame:
    """license, m, t_shingles, t_bands, anchors of each template of five words or more."""
    hashed = templates.select("license", shingles(F.col("notice")).alias("hashes"))
    return hashed.where(F.size("hashes") > 0).select(
        "license",
        F.size("hashes").alias("m"),
        F.array_distinct("hashes").alias("t_shingles"),
        bands(F.col("hashes")).alias("t_bands"),
        anchors(F.col("hashes")).alias("anchors"),
    )


def _around(hits: Column, hashes: Column, reach: int) -> Column:
    """Each hit with the shingles up to ``reach`` before and after it."""

    def near(at: Column) -> Column:
        start = F.greatest(at - reach, F.lit(0))
        return F.struct(
            at.alias("at"),
            hashes[at].alias("anchor"),
            start.alias("start"),
            F.slice(hashes, start + 1, F.lit(2 * reach + 1)).alias("near"),
        )

    return F.transform(hits, near)


def _matching(window: Column, shingle_set: Column) -> Column:
    """Places in the window of shingles of the template."""
    return F.filter(
        F.sequence(F.lit(0), F.size(window) - 1),
        lambda i: F.array_contains(shingle_set, window[i]),
    )


def scan(docs: DataFrame, templates: DataFrame, least: float = LEAST) -> DataFrame:
    """Every match: doc_id, license, containment, first_word, last_word.

    Places count words from 0. Verified windows of one template that overlap are
    one match, from its first to its last shingle, with the best containment, so
    copies of a notice that follow each other are one. Null, empty and shorter
    texts have no match; a null doc_id is kept; rows that repeat id and text are
    reported once; other columns are not read; an empty table, of documents or
    templates, gives no rows. Templates of fewer than five words match nothing.
    """
    spark = docs.sparkSession
    n = templates.count()
    if n > MOST_TEMPLATES:
        raise ValueError(f"{n} templates are too many to broadcast; the most is {MOST_TEMPLATES}")
    known = sketches(templates).collect()  # MOST_TEMPLATES bounds it
    kinds = "license string, m int, t_shingles array<bigint>, t_bands array<bigint>"
    small = spark.createDataFrame([tuple(r)[:4] for r in known], kinds)
    by_anchor = spark.createDataFrame(
        [(a, r["license"]) for r in known for a in r["anchors"]], "_anchor bigint, license string"
    )
    listed = sorted({a for r in known for a in r["anchors"]})
    reach = 2 * max((r["m"] for r in known), default=1)

    def hits(hashes: Column) -> Column:
        starts = F.when(
            F.size(hashes) > 0, F.sequence(F.lit(0), F.size(hashes) - 1)
        ).otherwise(F.array().cast("array<int>"))
        return _around(F.filter(starts, lambda i: hashes[i].isin(listed)), hashes, reach)

    found = docs.select(
        "doc_id",
        F.xxhash64("text").alias("_text"),
        F.explode(let(shingles(F.col("text")), hits)).alias("hit"),
    ).select("doc_id", "_text", "hit.*")
    stride = F.greatest(F.lit(1), F.floor(F.col("m") / 2).cast("int"))
    last = F.floor(F.col("at") / F.col("stride")).cast("int")
    first = F.greatest(
        F.lit(0), F.ceil((F.col("at") - 2 * F.col("m") + 1) / F.col("stride")).cast("int")
    )
    windows = (
        found.join(F.broadcast(by_anchor), F.col("anchor") == F.col("_anchor"))
        .join(F.broadcast(small), "license")
        .withColumn("stride", stride)
        .withColumn("grid", F.explode(F.sequence(first, last)))
        .withColumn("from", F.col("grid") * F.col("stride"))
        .withColumn(
            "w", F.slice("near", F.col("from") - F.col("start") + 1, 2 * F.col("m"))
        )
    )
    retrieved = windows.where(
        let(
            bands(F.col("w")),
            lambda b: F.exists(
                F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: b[k] == F.col("t_bands")[k]
            ),
        )
    )
    share = F.size(F.array_intersect("t_shingles", "w")) / F.size("t_shingles")
    verified = (
        retrieved.withColumn("containment", share)
        .where(F.col("containment") >= least)
        .withColumn("places", _matching(F.col("w"), F.col("t_shingles")))
        .select(
            "doc_id",
            "_text",
            "license",
            "containment",
            (F.col("from") + F.array_min("places")).alias("first_word"),
            (F.col("from") + F.array_max("places") + SHINGLE - 1).alias("last_word"),
        )
        .distinct()
    )
    # Overlapping matches join: the windows of one document and template, no more.
    text = Window.partitionBy("doc_id", "_text", "license").orderBy("first_word", "last_word")
    before = text.rowsBetween(Window.unboundedPreceding, -1)
    new = F.coalesce(F.col("first_word") > F.max("last_word").over(before), F.lit(True))
    return (
        verified.withColumn("_new", new.cast("int"))
        .withColumn("_match", F.sum("_new").over(text))
        .groupBy("doc_id", "_text", "license", "_match")
        .agg(
            F.max("containment").alias("containment"),
            F.min("first_word").cast("long").alias("first_word"),
            F.max("last_word").cast("long").alias("last_word"),
        )
        .select("doc_id", "license", "containment", "first_word", "last_word")
    )

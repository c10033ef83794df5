"""License scans: MinHash bands over text windows retrieve templates, shingle containment verifies them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aqlake.llm.shared import alnum_words, store

# Common public license notices.
NOTICES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS '
        "OF ANY KIND, either express or implied."
    ),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"
    ),
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "mit": "Released under the MIT License.",
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions"
    ),
}

SHINGLE = 5  # words
SHORT = 24  # templates of up to so many shingles use windows of a single shingle
WINDOW, STRIDE = 8, 3  # shingles, for longer templates
# One row a band: two windows of similarity s meet with probability 1 - (1 - s) ** 3, at 0.8 in 99.2 of 100 cases.
# A band is the minimum under another order of the hashes: x, x from the top, x with these bits flipped.
FLIPPED = 0x5555555555555555


def _shingles(hashes: str, size: int) -> Column:
    """Hash of the ``size`` words from each position on, made from the words' hashes."""
    made = F.transform(
        hashes, lambda x, i: F.xxhash64(F.lit(size), x, *(F.get(hashes, i + j) for j in range(1, size)))
    )
    return F.slice(made, 1, F.greatest(F.size(hashes) - (size - 1), F.lit(0)))


def _with_shingles(words: DataFrame, sizes: list[int]) -> DataFrame:
    """Each word is hashed once, whatever the number of sizes and of shingles it is in."""
    hashed = words.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    return hashed.select(*words.columns, *(_shingles("hashes", size).alias(f"s{size}") for size in sizes))


def _bands(shingles: Column, starts: Column) -> Column:
    """Band keys of the windows that begin at ``starts``."""

    def keys(at: Column) -> Column:
        window = F.slice(shingles, at + 1, F.lit(WINDOW))
        return F.array(
            F.xxhash64(F.lit("a"), F.array_min(window)),
            F.xxhash64(F.lit("b"), F.array_max(window)),
            F.xxhash64(F.lit("c"), F.array_min(F.transform(window, lambda x: x.bitwiseXOR(F.lit(FLIPPED))))),
        )

    return F.flatten(F.transform(starts, keys))


def _starts(shingles: str, stride: int) -> Column:
    """Window starts; a text of fewer shingles than a window has one window if it has any shingle."""
    last = F.greatest(F.size(shingles) - WINDOW, F.lit(0))
    return F.when(F.size(shingles) == 0, F.array().cast("array<int>")).otherwise(
        F.array_distinct(F.concat(F.sequence(F.lit(0), last, F.lit(stride)), F.array(last)))
    )


def _templates(notices: DataFrame) -> DataFrame:
    """(license_id, size of a shingle, its different shingles as texts, their number)."""
    words = notices.select("license_id", alnum_words(F.col("text")).alias("words")).where(F.size("words") > 0)
    sized = words.withColumn("k", F.least(F.size("words"), F.lit(SHINGLE)))
    texts = F.transform(
        F.sequence(F.lit(1), F.size("words") - F.col("k") + 1), lambda i: F.array_join(F.slice("words", i, F.col("k")), " ")
    )
    return sized.select("license_id", "words", "k", F.array_distinct(texts).alias("texts")).withColumn("n", F.size("texts"))


def scan_licenses(docs: DataFrame, notices: DataFrame, min_containment: float = 0.8) -> DataFrame:
    """License notices in documents, ``notices`` being (license_id, text) templates.

    Words are digits, ASCII letters and characters beyond ASCII, A-Z lower-cased; shingles
    are 5 words, or the whole template if it has fewer. Containment of a template at a
    word position is the share of its different shingles among the document's shingles
    from there on, over a quarter more positions than the template has different shingles
    (rounded up). Returns (doc_id, license_id, containment, first_word), one row for
    each document row and template that reach ``min_containment`` somewhere: the largest
    containment and the first position (from 0) with it.

    Retrieval: overlapping windows of a document's shingles meet windows of the templates
    in MinHash bands. Templates of up to 24 shingles use windows of one shingle, whose
    MinHash is the shingle itself, so none with a shared shingle is missed. Longer ones
    use windows of 8 shingles at every third position of a document that has a shingle of
    such a template (no other can meet one in a band) and at every position of the template: a
    shared run of 10 shingles holds an equal window, and with a containment of 0.8 under
    replaced words there is such a run. Verification reads
    only the retrieved documents again and compares shingles as texts.

    Null or empty text matches nothing, also a template without words. Rows with one
    doc_id are scanned each by its own text, a null doc_id is kept. With no documents or
    templates the result is empty. Other columns are not read. Template sizes are at
    most 5 numbers on the driver.
    """
    docs = docs.select("doc_id", "text")
    templates = store(_templates(notices))
    sizes = sorted(row[0] for row in templates.select("k").distinct().collect()) or [SHINGLE]
    long = templates.where(F.col("n") > SHORT)
    any_long = not long.isEmpty()

    short_keys = [
        _with_shingles(templates.where((F.col("n") <= SHORT) & (F.col("k") == size)), [size]).select(
            "license_id", F.explode(f"s{size}").alias("key")
        )
        for size in sizes
    ]
    long_keys = _with_shingles(long, [SHINGLE]).select(
        "license_id", F.explode(_bands(F.col(f"s{SHINGLE}"), _starts(f"s{SHINGLE}", 1))).alias("key")
    )
    # Windows that meet in a band share the shingle that is the least there: documents without a shingle of a
    # long template need no windows.
    nameless = F.lit(None).cast(templates.schema["license_id"].dataType).alias("license_id")
    parts = _with_shingles(long, [SHINGLE]).select(nameless, F.explode(f"s{SHINGLE}").alias("key"))
    known = store(
        reduce(DataFrame.unionByName, [*short_keys, parts])
        .groupBy("key")
        .agg(F.collect_set("license_id").alias("license_ids"), F.bool_or(F.col("license_id").isNull()).alias("long"))
    )
    shingled = _with_shingles(docs.select("doc_id", alnum_words(F.col("text")).alias("words")), sizes)
    met = store(
        shingled.select("doc_id", F.explode(F.array_distinct(F.concat(*(F.col(f"s{size}") for size in sizes)))).alias("key"))
        .join(known, "key")
        .select("doc_id", F.explode_outer("license_ids").alias("license_id"), "long")
        .distinct()
    )
    held = met.where(F.col("license_id").isNotNull()).select("doc_id", "license_id")
    if any_long:
        keys = store(long_keys.groupBy("key").agg(F.collect_set("license_id").alias("license_ids")))
        near = store(met.where("long").select(F.col("doc_id").alias("near_doc")).distinct())
        windowed = docs.join(near, F.col("doc_id").eqNullSafe(F.col("near_doc")), "left_semi").select(
            "doc_id", alnum_words(F.col("text")).alias("words")
        )
        bands = _bands(F.col(f"s{SHINGLE}"), _starts(f"s{SHINGLE}", STRIDE))
        held = held.unionByName(
            _with_shingles(windowed, [SHINGLE])
            .select("doc_id", F.explode(F.array_distinct(bands)).alias("key"))
            .join(keys, "key")
            .select("doc_id", F.explode("license_ids").alias("license_id"))
        )
    found = (
        held.distinct()
        .join(templates.select("license_id", "k", "n", "texts"), "license_id")
        .groupBy(F.col("doc_id").alias("in_doc"))
        .agg(F.collect_set(F.struct("license_id", "k", "n", "texts")).alias("templates"))
    )
    suspects = docs.join(store(found), F.col("doc_id").eqNullSafe(F.col("in_doc"))).select(
        "doc_id", "templates", alnum_words(F.col("text")).alias("words")
    )
    return _verify(suspects, min_containment)


def _verify(suspects: DataFrame, min_containment: float) -> DataFrame:
    """Best containment of each retrieved template, its shingles compared as texts."""
    each = suspects.select("doc_id", "words", F.explode("templates").alias("t")).select("doc_id", "words", "t.*")
    held = F.filter(
        F.transform(
            F.sequence(F.lit(0), F.greatest(F.size("words") - F.col("k"), F.lit(0))),
            lambda i: F.struct(i.alias("at"), F.array_join(F.slice("words", i + 1, F.col("k")), " ").alias("text")),
        ),
        lambda s: F.array_contains("texts", s["text"]),
    )
    reach = F.col("n") + F.floor((F.col("n") + 3) / 4)
    counts = F.transform(
        "held",
        lambda first: F.struct(
            F.size(
                F.array_distinct(
                    F.transform(
                        F.filter("held", lambda s: (s["at"] >= first["at"]) & (s["at"] < first["at"] + reach)),
                        lambda s: s["text"],
                    )
                )
            ).alias("n"),
            (-first["at"]).alias("back"),
        ),
    )
    return (
        each.select("doc_id", "license_id", "n", held.alias("held"))
        .where(F.size("held") > 0)
        .select("doc_id", "license_id", "n", F.array_max(counts).alias("best"))
        .select(
            "doc_id",
            "license_id",
            (F.col("best.n") / F.col("n")).alias("containment"),
            (-F.col("best.back")).cast("long").alias("first_word"),
        )
        .where(F.col("containment") >= min_containment)
    )


def default_notices(spark) -> DataFrame:
    return spark.createDataFrame(sorted(NOTICES.items()), "license_id string, text string")


def license_scan(docs: DataFrame) -> DataFrame:
    """``scan_licenses`` with the notices above."""
    return scan_licenses(docs, default_notices(docs.sparkSession))

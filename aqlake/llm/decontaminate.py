"""Benchmark decontamination by winnowing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aqlake.llm.shared import alnum_words, store

WINDOW = 13
GRAM = 8  # so that a window of 13 words holds 6 grams, one of which is its fingerprint


def _grams(hashes: str, size: int) -> Column:
    """Hash of the ``size`` words from each position on; the last size - 1 entries are cut short."""
    return F.transform(
        hashes, lambda x, i: F.xxhash64(F.lit(size), x, *(F.get(hashes, i + j) for j in range(1, size)))
    )


def _least(grams: str, width: int) -> Column:
    """Minimum of ``width`` neighbouring grams from each position on."""
    return F.transform(grams, lambda x, i: F.least(x, *(F.get(grams, i + j) for j in range(1, width))))


def _head(values: str, window: int) -> Column:
    return F.slice(F.col(values), 1, F.greatest(F.size("words") - (window - 1), F.lit(0)))


def fingerprints(words: DataFrame, levels: list[int]) -> DataFrame:
    """Add a column ``fp<length>`` for each window length: the fingerprint of the window at each position.

    At length 13 it is the least 8-gram hash of the window (winnowing); a shorter window
    is its own gram. Equal windows always have equal fingerprints.
    """
    df = words.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    df = df.select("*", *(_grams("hashes", min(size, GRAM if size == WINDOW else size)).alias(f"g{size}") for size in levels))
    df = df.select(
        "*", *((_least("g13", WINDOW - GRAM + 1) if size == WINDOW else F.col(f"g{size}")).alias(f"m{size}") for size in levels)
    )
    return df.select(*words.columns, *(_head(f"m{size}", size).alias(f"fp{size}") for size in levels))


def benchmark_windows(benchmark: DataFrame) -> tuple[DataFrame, list[int]]:
    """(fp, windows: array of (text, items)) and the window lengths that occur.

    An item of fewer than 13 words, but not none, is one window. The lengths are at most
    13 numbers.
    """
    items = store(
        benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), alnum_words(F.col("text")).alias("words"))
        .where(F.size("words") > 0)
        .withColumn("length", F.least(F.size("words"), F.lit(WINDOW)))
    )
    levels = sorted(row[0] for row in items.select("length").distinct().collect())
    if not levels:
        empty = items.sparkSession.createDataFrame([], "fp long, windows array<struct<text:string,items:array<string>>>")
        return empty, [WINDOW]
    each = []
    for size in levels:
        marked = fingerprints(items.where(F.col("length") == size), [size])
        each.append(
            marked.select("item", "words", F.posexplode_outer(f"fp{size}").alias("at", "fp")).select(
                "fp", F.array_join(F.slice("words", F.col("at") + 1, F.lit(size)), " ").alias("text"), "item"
            )
        )
    windows = (
        reduce(DataFrame.unionByName, each)
        .groupBy("fp", "text")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
        .groupBy("fp")
        .agg(F.sort_array(F.collect_list(F.struct("text", "items"))).alias("windows"))
    )
    return store(windows), levels


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Find the benchmark windows that occur in each document.

    Words are ``alnum_words``. A window is 13 consecutive words of an item; an item of
    fewer words is one window. A document word inside an occurrence of a window is hit.
    Returns (doc_id, n_words, n_hit, items, contaminated), one row per row of ``docs``;
    ``items`` are the ids, as text in order, of the items with occurring windows.
    Contaminated: some word is hit and the hit words are a twentieth of the words or more.

    Every document's winnowed fingerprints meet those of the benchmark in one join; only
    documents that share one are read again, and there every window with a shared
    fingerprint is compared word by word, so nothing rests on hashes alone. A shared span
    of 13 words always shares its fingerprint, so none is missed.

    Null or empty text has no words and is clean. A null doc_id is kept; rows with one
    doc_id are judged each by its own text. A null item_id counts as the item "null".
    Repeated items are one. With an empty benchmark all documents are clean. Other
    columns are not read. A document's list of windows is bounded by what it shares with
    the benchmark, and an item list by the benchmark.
    """
    docs = docs.select("doc_id", "text")
    windows, levels = benchmark_windows(benchmark)
    words = docs.select("doc_id", alnum_words(F.col("text")).alias("words"))
    every = fingerprints(words, levels).select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.array_distinct(F.concat(F.array().cast("array<bigint>"), *(F.col(f"fp{size}") for size in levels))).alias("fps"),
    )
    # the first row of each document carries its number of words, under a key spread like the others
    rows = every.select(
        "doc_id", "n_words", F.posexplode_outer(F.concat(F.array(F.xxhash64(F.lit(0), "doc_id")), "fps")).alias("at", "fp")
    )
    known = windows.select("fp", F.lit(True).alias("shared"))
    seen = store(
        rows.join(known, "fp", "left")
        .where((F.col("at") == 0) | F.col("shared"))
        .select("doc_id", "n_words", "fp", (F.col("at") == 0).alias("first"), F.coalesce("shared", F.lit(False)).alias("shared"))
    )
    suspects = store(
        seen.where("shared")
        .join(windows, "fp")
        .groupBy(F.col("doc_id").alias("in_doc"))
        .agg(F.collect_set("fp").alias("fps"), F.array_distinct(F.flatten(F.collect_list("windows"))).alias("windows"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("in_doc"))
    # stored, so that no filter on the result is worked into these expressions
    judged = store(
        _extend(docs.hint("merge").join(suspects, same).select("doc_id", "fps", "windows", alnum_words(F.col("text")).alias("words")), levels)
    )
    clean = (
        seen.where("first")
        .join(suspects.select("in_doc"), same, "left_anti")
        .select("doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items"))
    )
    hit = (F.col("n_hit") > 0) & (F.lit(20) * F.col("n_hit") >= F.col("n_words"))
    return clean.unionByName(judged).withColumn("contaminated", hit)


def _extend(suspects: DataFrame, levels: list[int]) -> DataFrame:
    """Compare the windows with shared fingerprints word by word and join hits to spans."""
    marked = fingerprints(suspects, levels)

    def at(size: int) -> Column:
        shared = F.filter(
            F.sequence(F.lit(0), F.size(f"fp{size}")), lambda i: F.array_contains("fps", F.get(f"fp{size}", i))
        )
        return F.transform(
            shared,
            lambda i: F.struct(
                i.alias("start"),
                (i + size).alias("stop"),
                F.array_join(F.slice("words", i + 1, F.lit(size)), " ").alias("text"),
            ),
        )

    found = marked.select(
        "doc_id",
        "windows",
        F.transform("windows", lambda w: w["text"]).alias("texts"),
        F.size("words").cast("long").alias("n_words"),
        F.sort_array(F.concat(*(at(size) for size in levels))).alias("spans"),
    )
    found = found.withColumn("spans", F.filter("spans", lambda s: F.array_contains("texts", s["text"])))
    hits = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("n")),
        lambda acc, s: F.struct(
            F.greatest(acc["upto"], s["stop"]).alias("upto"),
            (acc["n"] + F.greatest(s["stop"] - F.greatest(acc["upto"], s["start"]), F.lit(0))).alias("n"),
        ),
        lambda acc: acc["n"],
    )
    texts = F.transform("spans", lambda s: s["text"])
    return found.select("doc_id", "n_words", hits.alias("n_hit"), "windows", texts.alias("hit_texts")).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.sort_array(
            F.array_distinct(
                F.flatten(
                    F.transform(
                        F.filter("windows", lambda w: F.array_contains("hit_texts", w["text"])), lambda w: w["items"]
                    )
                )
            )
        ).alias("items"),
    )


def decontaminate_digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``decontaminate`` with the items as their number and the SHA-256 of their list."""
    return decontaminate(docs, benchmark).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )

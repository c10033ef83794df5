"""Line dedup over levelled sorted runs of line hashes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aqlake.llm.shared import BLANKS, ascii_lower, store


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(docs: DataFrame, batches: int, min_chars: int) -> DataFrame:
    """Each document's different long lines: (batch, h1, h2, doc_id), the key as 128 bits."""
    return (
        docs.select("doc_id", F.explode(_lines(F.col("text"))).alias("line"))
        .select("doc_id", line_key(F.col("line")).alias("key"))
        .where(F.char_length("key") >= min_chars)
        .select(
            F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int").alias("batch"),
            F.xxhash64("key").alias("h1"),
            F.xxhash64(F.lit(1), F.col("key")).alias("h2"),
            "doc_id",
        )
        .distinct()
    )


class LineRuns:
    """Levelled sorted runs of (h1, h2, n_docs, last_doc), newest totals of a line.

    ``add`` takes one batch of (h1, h2, doc_id) rows whose documents came in no earlier
    batch. Lines that no run holds (merge anti-join) enter with the batch's own counts;
    for lines that some run holds, the batch's run carries the new totals. Totals only
    grow, so of several entries of a line the largest is the valid one. When a level
    has ``fanout`` runs, they are compacted into one run of the next level: a line is
    rewritten once per level, and a batch is joined with at most ``fanout`` runs a level.
    """

    def __init__(self, fanout: int = 4):
        self.fanout = fanout
        self.levels: list[list[DataFrame]] = []

    def _run(self, entries: DataFrame) -> DataFrame:
        return store(entries.sortWithinPartitions("h1", "h2"))

    def _merged(self, runs: list[DataFrame]) -> DataFrame:
        both = reduce(DataFrame.unionByName, runs)
        return both.groupBy("h1", "h2").agg(F.max("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"))

    def add(self, batch: DataFrame) -> None:
        own = batch.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc"))
        held = [run for level in self.levels for run in level]
        if held:
            own = store(own)
            # a run written earlier can only hold smaller totals, so one pass per run is enough
            fresh = reduce(lambda left, run: left.join(run, ["h1", "h2"], "left_anti"), held, own)
            known = own.join(
                self._merged(held).select("h1", "h2", F.col("n_docs").alias("n"), F.col("last_doc").alias("last")),
                ["h1", "h2"],
            ).select(
                "h1",
                "h2",
                (F.col("n_docs") + F.col("n")).alias("n_docs"),
                F.greatest("last_doc", "last").alias("last_doc"),
            )
            own = fresh.unionByName(known)
        self._put(0, self._run(own))

    def _put(self, level: int, run: DataFrame) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._put(level + 1, self._run(self._merged(full)))

    def totals(self) -> DataFrame:
        return self._merged([run for level in self.levels for run in level])


def dedup_lines(
    docs: DataFrame, min_chars: int = 20, min_docs: int = 3, batches: int = 4, fanout: int = 4, also: tuple[str, ...] = ()
) -> DataFrame:
    """Drop lines that recur in many documents, but for the largest doc_id that holds them.

    A text splits at newlines; null or empty text is one empty line. A line whose key
    (``line_key``) has at least ``min_chars`` code points and occurs in at least
    ``min_docs`` documents loses all its occurrences except in the largest doc_id
    holding it. Returns (doc_id, text, n_lines, n_dropped, kept), one row per row of
    ``docs``; ``text`` is the input and ``kept`` the remaining lines joined by newlines.

    Rows with one doc_id are one document, and each gives its row. A null doc_id is one
    document, smaller than any other. Of the other columns only those named in ``also``
    are read, and come out as they are (none may be called like a column returned).
    Only hashes of lines are shuffled by line; a common line's rows are counted before
    the shuffle and joined from stored tables, where Spark can split a hot key. Texts
    move once, to meet their document's list of dropped lines.
    """
    docs = docs.select("doc_id", "text", *also)
    pairs = store(line_hashes(docs, batches, min_chars), "batch")
    runs = LineRuns(fanout)
    for number in range(batches):
        runs.add(pairs.where(F.col("batch") == number).select("h1", "h2", "doc_id"))
    common = store(runs.totals().where(F.col("n_docs") >= min_docs).select("h1", "h2", "last_doc"))
    dropped = (
        pairs.hint("merge").join(common, ["h1", "h2"])
        .where(~F.col("doc_id").eqNullSafe(F.col("last_doc")))
        .groupBy(F.col("doc_id").alias("in_doc"))
        .agg(F.collect_list("h1").alias("hashes"))
    )
    gone = F.transform(F.col("lines"), lambda x: F.array_contains("hashes", F.xxhash64(line_key(x))))
    return (
        docs.hint("merge").join(store(dropped), F.col("doc_id").eqNullSafe(F.col("in_doc")), "left")
        .select("doc_id", "text", *also, "hashes", _lines(F.col("text")).alias("lines"))
        .select("*", F.when(F.col("hashes").isNotNull(), gone).alias("gone"))
        .select(
            "doc_id",
            "text",
            *also,
            F.size("lines").cast("long").alias("n_lines"),
            F.coalesce(F.size(F.filter("gone", lambda x: x)), F.lit(0)).cast("long").alias("n_dropped"),
            F.when(F.col("gone").isNull(), F.coalesce("text", F.lit("")))
            .otherwise(F.array_join(F.filter("lines", lambda x, i: ~F.get("gone", i)), "\n"))
            .alias("kept"),
        )
    )


def line_dedup_digest(docs: DataFrame) -> DataFrame:
    """``dedup_lines`` with production settings, the kept text as its SHA-256."""
    return dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )

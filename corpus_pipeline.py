"""Corpus pipeline: quality, line dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
result as Parquet into the shared folder and reads it again as the next stage's ``docs``.
All stages but the last return the columns of ``documents``. Tables that a stage has
stored on its way are deleted when the next stage is called: its result must be written by then.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aqlake.llm.decontaminate import decontaminate
from aqlake.llm.line_dedup import dedup_lines
from aqlake.llm.packing import packing_digest
from aqlake.llm.quality import fit_quality, score_quality
from aqlake.llm.shared import drop_stored, fold, listing, store
from aqlake.llm.simhash import near_duplicates

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
MIN_QUALITY = 0.7

# A stage fits models and joins by document id, which SQL cannot express.
ORACLE_SQL = None

_on_the_way: list[str] = []  # tables that the stage called last has stored


def _stage(work):
    @wraps(work)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_stored(spark, _on_the_way)
        with listing(_on_the_way):
            return work(spark, docs, sf_dir)

    return stage


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` stored with a number ``row``, as ids may be null or repeat."""
    return store(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()))


def _as_ids(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("row").alias("doc_id"), "text")


def _without(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    return rows.join(store(dropped), "row", "left_anti").select(*COLUMNS)


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier scores at 0.7 or more."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit_quality(docs.where(fold(F.col("doc_id"), 4) != 2), labels)
    return score_quality(docs.select(*COLUMNS), model).where(F.col("score") >= MIN_QUALITY).select(*COLUMNS)


@_stage
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that recur in many documents go; all documents stay, with their new text and length."""
    return dedup_lines(docs, also=("lang", "source")).select(
        "doc_id",
        F.col("kept").alias("text"),
        "lang",
        "source",
        F.char_length("kept").cast(docs.schema["n_chars"].dataType).alias("n_chars"),
    )


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash group: that with the smallest doc_id, null being the largest.

    Of rows with that doc_id the one with the smallest hash of its text stays, of rows
    that also share the text the first by lang, source and n_chars.
    """
    rows = _numbered(docs)
    grouped = near_duplicates(_as_ids(rows)).select(F.col("doc_id").alias("row"), F.col("component_id").alias("group"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.md5(F.col("text").cast("binary")), "lang", "source", "n_chars", "row")
    placed = store(grouped.join(rows.select("row", order.alias("place")), "row"))
    kept = store(placed.groupBy("group").agg(F.min("place").alias("place")).select("place.row"))
    return _without(rows, placed.select("row").join(kept, "row", "left_anti"))


@_stage
def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text is not contaminated by benchmark passages."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = _numbered(docs)
    judged = decontaminate(_as_ids(rows), items)
    return _without(rows, judged.where("contaminated").select(F.col("doc_id").alias("row")))


@_stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents' pieces in sequences of 2048 tokens."""
    return packing_digest(docs)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", benchmark),
    ("best-fit packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

"""Helpers of the llm operators: stored intermediates, words, ids and connected components."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = " \t\n\x0b\x0c\r"
_local_base: list[str] = []
_listed: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder of this application below ``spark.checkpoint.dir``, removed when the application ends.

    Where the setting is missing, a local session takes a temporary folder (tests); any
    other session is refused, as its executors would not share that folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        if not _local_base:
            _local_base.append(tempfile.mkdtemp(prefix="aqlake-"))
        base = _local_base[0]
    folder = f"{base.rstrip('/')}/aqlake-{spark.sparkContext.applicationId}"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def store(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it again.

    This cuts the lineage (a lost executor costs a re-read, not a recomputation), runs
    costly expressions once and gives Spark the true size to choose joins by.
    """
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    for paths in _listed:
        paths.append(path)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def listing(paths: list[str]):
    """Within it, ``store`` also adds the paths of its tables to ``paths``."""
    _listed.append(paths)
    try:
        yield
    finally:
        _listed.remove(paths)


def drop_stored(spark: SparkSession, paths: list[str]) -> None:
    """Delete stored tables and empty the list; nothing that still reads them may be used any more."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(conf).delete(path, True)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; the plain function serves where all characters are ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def alnum_words(text: Column) -> Column:
    """Lower-cased words of digits, ASCII letters and all characters beyond ASCII; null text has none."""
    cut = F.split(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.array_remove(cut, "")


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus)


def hashed_sample(rows: DataFrame, key: list[str], n: int) -> DataFrame:
    """At most ``n`` rows of ``rows``, one for each different ``key``, those with the least hashes of their key.

    Only hashes are ordered and sent to the driver; the rows are fetched by them afterwards, so
    that no task sends whole rows that do not belong to the sample.
    """
    h = F.xxhash64(*key)
    chosen = [r[0] for r in rows.select(h.alias("h")).distinct().orderBy("h").limit(n).collect()]
    held = rows.where(h.isin(chosen)).groupBy(h.alias("h"))
    return held.agg(F.min(F.struct(*rows.columns)).alias("row")).orderBy("h").select("row.*")


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of links ``(a, b)``: (node, root), root being the least node reachable.

    Alternates the large-star and small-star steps until nothing changes, a number of
    rounds logarithmic in the number of nodes. Minima combine map-side; they are joined
    from stored tables, so that a hub with many links can be split among tasks. Only
    nodes with a link to another node are returned.
    """

    def smallest(links: DataFrame, value: Column) -> DataFrame:
        return store(links.groupBy("a").agg(value.alias("m")))

    now = store(edges.select("a", "b").where("a <> b").distinct())
    before = None
    while (seen := _fingerprint(now)) != before:
        before = seen
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = smallest(both, F.least(F.col("a"), F.min("b")))
        large = store(
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        )
        # every link now points from the larger node to a smaller one
        least = smallest(large, F.min("b"))
        moved = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = store(moved.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def schema(text: str) -> T.StructType:
    return T._parse_datatype_string(text)

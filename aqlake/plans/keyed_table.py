"""A table kept by key, whose upserts rewrite only the buckets that hold a matched key.

Rows are spread over buckets by a hash of their key. No file that readers may be using is ever changed::

    <root>/rows/version=<n>/bucket=<b>/...    rows
    <root>/versions/version=<n>/...           buckets written by version n, the number of buckets

An upsert writes a bucket anew if one of its rows is matched; a bucket that only gets new keys
is left as it is, and they are added beside it. All other buckets keep their files. The list of buckets is
written last, so an upsert that dies half-way is invisible and simply runs again.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aqlake.operators.upsert import upsert
from aqlake.session import drop_folder, folder_exists, materialize

_BUCKET = T.StructField("bucket", T.IntegerType())
_VERSION = T.StructField("version", T.LongType())
_LISTED = T.StructType([_BUCKET, T.StructField("replaces", T.BooleanType()), T.StructField("buckets", T.IntegerType()), _VERSION])
MAX_ADDED = 20  # versions a bucket may be spread over before the next upsert writes it anew


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket")


def _listed(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root}/versions"
    return spark.read.schema(_LISTED).parquet(path) if folder_exists(spark, path) else spark.createDataFrame([], _LISTED)


def _in_force(listed: DataFrame) -> list[Row]:
    """(bucket, version) of the files that make up the table: of each bucket the last that replaced it, and later ones."""
    last = listed.where("replaces").groupBy("bucket").agg(F.max("version").alias("_last"))
    kept = listed.where("bucket IS NOT NULL").join(last, "bucket", "left").where("_last IS NULL OR version >= _last")
    return kept.select("bucket", "version").collect()


def _read(spark: SparkSession, root: str, schema: T.StructType, parts: list[Row]) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], T.StructType([*schema.fields, _BUCKET]))
    # One flat list of literals on the partition columns: other folders are not opened.
    held_in = F.concat(F.col("version").cast("string"), F.lit("/"), F.col("bucket").cast("string"))
    rows = spark.read.schema(T.StructType([*schema.fields, _VERSION, _BUCKET])).parquet(f"{root}/rows")
    return rows.where(held_in.isin([f"{r.version}/{r.bucket}" for r in parts])).drop("version")


def read_keyed(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The rows as of the last finished upsert; none if there has been none."""
    return _read(spark, root, schema, _in_force(_listed(spark, root))).select(*schema.names)


def upsert_keyed(
    source: DataFrame, root: str, schema: T.StructType, keys: Sequence[str], update: Sequence[str], buckets: int = 64
) -> int:
    """Upsert ``source`` (see ``operators.upsert``) into the table below ``root``; returns the new version.

    ``buckets`` counts when the table is made; later ones follow it. Choose it so that a bucket is a few
    files: what an upsert reads of the table is the keys of the source's buckets, what it writes is the
    matched buckets and the new rows. The driver holds the list of versions in force, at most
    ``MAX_ADDED`` + 1 a bucket. Source rows whose key is NULL or new are added; a key that is in the
    table and more than once in the source is an error. An empty source changes nothing but the version.
    The table may not have columns named ``bucket`` or ``version``. One upsert at a time.
    """
    spark = source.sparkSession
    if taken := {"bucket", "version"} & set(schema.names):
        raise ValueError(f"columns {sorted(taken)} are names the table needs itself")
    listed = _listed(spark, root)
    before = listed.agg(F.max("version").alias("version"), F.max("buckets").alias("buckets")).first()
    version, buckets = (before.version or 0) + 1, before.buckets or buckets
    typed = source.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])  # equal keys, equal hashes
    fresh = materialize(typed.select("*", _bucket(keys, buckets)), "upsert-source")
    aimed = {r.bucket for r in fresh.select("bucket").distinct().collect()}
    parts = [r for r in _in_force(listed) if r.bucket in aimed] if before.version else []
    by = [*keys, "bucket"]
    times = fresh.groupBy(*by).agg(F.count(F.lit(1)).alias("times"))
    found = _read(spark, root, schema, parts).select(*by).join(times, by).groupBy("bucket").agg(F.max("times").alias("times"))
    matched = {r.bucket: r.times for r in found.collect()}
    if any(times > 1 for times in matched.values()):
        raise ValueError("the source holds several rows for a key already in the table")
    files = Counter(r.bucket for r in parts)
    replaced = {b for b in aimed if b in matched or files[b] > MAX_ADDED}
    whole = F.col("bucket").isin(sorted(replaced))
    anew = upsert(_read(spark, root, schema, [r for r in parts if r.bucket in replaced]), fresh.where(whole), by, update)
    rows = anew.unionByName(fresh.where(~whole))
    path = f"{root}/rows/version={version}"
    drop_folder(spark, path)  # an upsert that died may have left other buckets there
    rows.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(path)
    stamps = [(b, b in replaced, buckets) for b in sorted(aimed)] or [(None, False, buckets)]
    stamped = spark.createDataFrame(stamps, T.StructType(_LISTED.fields[:-1]))
    stamped.coalesce(1).write.mode("overwrite").parquet(f"{root}/versions/version={version}")
    return version


def drop_replaced(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete files of buckets that a version before the last ``keep`` has replaced; returns how many folders."""
    listed = _listed(spark, root)
    newest = listed.agg(F.max("version")).first()[0]
    if newest is None:
        return 0
    last = listed.where(F.col("replaces") & (F.col("version") <= newest - keep)).groupBy("bucket").agg(F.max("version").alias("_last"))
    old = materialize(listed.join(last, "bucket").where("version < _last").select("bucket", "version"), "replaced")
    return sum(drop_folder(spark, f"{root}/rows/version={r.version}/bucket={r.bucket}") for r in old.toLocalIterator())

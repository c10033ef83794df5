"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# AQE sizes the shuffles, splits hot join partitions and swaps in broadcasts
# from measured sizes; every operator here leans on it instead of fixed hints.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}

# Listing many files starts one task for each up to this number; the default of
# 10,000 suits a cluster and an object store, not the threads of one machine.
LOCAL_SETTINGS = {"spark.sql.sources.parallelPartitionDiscovery.parallelism": "16"}

# A document is read whole, so its parts need no columns of their own: guessing them holds back
# thousands of documents a file, and reading puts them together again.
WHOLE_VARIANTS = {"spark.sql.variant.inferShreddingSchema": "false"}

# How tables of whole documents are stored, as one may have megabytes: a writer looks at its buffer from the first
# row on, not after a hundred, and a row group (by its compressed bytes), whose first rows a reader holds all at once, is small.
DOCUMENT_ROWS = {"parquet.page.size.row.check.min": "1", "parquet.block.size": str(4 * 2**20)}

_local_scratch: list[str] = []


def build_session(app_name: str = "aqlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; cluster settings stay with the cluster."""
    builder = SparkSession.builder.appName(app_name)
    settings = SETTINGS | WHOLE_VARIANTS
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            settings |= LOCAL_SETTINGS
    for key, value in (settings | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def settle(spark: SparkSession) -> None:
    """Settings for documents and folders of many files, where the caller's session has none of its own.

    Folders are listed by a few tasks a core. By default each of up to 10,000 folders gets a task, and
    each task sends its own report to the driver, larger than the names it has found.
    """
    listing = str(8 * spark.sparkContext.defaultParallelism)
    for key, value in {"spark.sql.sources.parallelPartitionDiscovery.parallelism": listing, **WHOLE_VARIANTS}.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine: on a
    cluster other machines could not read it, so there the setting is required.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if not _local_scratch:
            _local_scratch.append(tempfile.mkdtemp(prefix="aqlake-"))
        base = _local_scratch[0]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder, with the writer's ``options``, and read it back.

    Used for small intermediates (one row per key) that several later steps
    need. Afterwards Spark knows the true size, so its own broadcast threshold
    decides between a broadcast and a shuffled join, and a shuffled join has a
    plain scan on both sides, which is the shape AQE can split when a key is hot.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder, system = _file_system(spark, path)
    return system.exists(folder)


def make_folder(spark: SparkSession, path: str) -> None:
    folder, system = _file_system(spark, path)
    system.mkdirs(folder)


def replace_folder(spark: SparkSession, path: str, content: bytes, name: str) -> None:
    """Make a folder hold one small file of this content; its readers never see half of it."""
    drop_folder(spark, path)
    _, system = _file_system(spark, path)
    names = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    begun, whole = names(f"{path}/_{name}"), names(f"{path}/{name}")  # files with an underscore are not listed
    out = system.create(begun, True)
    out.write(bytearray(content))
    out.close()
    if not system.rename(begun, whole):
        raise OSError(f"cannot write {path}/{name}")


def drop_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder with all it holds; whether there was one."""
    folder, system = _file_system(spark, path)
    return system.delete(folder, True)

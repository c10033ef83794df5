"""Load a register file into the register table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aqlake.operators.upsert import ambiguous_matches, upsert
from aqlake.plans.keyed_table import upsert_keyed
from aqlake.sources.register import read_register
from aqlake.sources.schemas import REGISTER, REGISTER_KEYS


def load_register(spark: SparkSession, csv_path: str, target: DataFrame | None, out_path: str) -> str:
    """Upsert the good rows of ``csv_path`` into ``target`` and write the result to ``out_path``.

    ``out_path`` must not be the folder ``target`` is read from. Rows that do
    not fit the schema are skipped and counted in the returned message.
    """
    if target is None:
        target = spark.createDataFrame([], REGISTER)
    source, bad = read_register(spark, csv_path)
    repeated = ambiguous_matches(target, source, REGISTER_KEYS).limit(1).count()
    if repeated:
        raise ValueError(f"{csv_path} holds several rows for a city already in the register")
    update = [c for c in REGISTER.names if c not in REGISTER_KEYS]
    upsert(target, source, REGISTER_KEYS, update).write.mode("overwrite").parquet(out_path)
    skipped = bad.agg(F.count(F.lit(1))).first()[0]
    return f"register load completed, {skipped} rows skipped"


def update_register(spark: SparkSession, csv_path: str, root: str) -> str:
    """``load_register`` into the register kept below ``root`` (``plans.keyed_table``).

    Only the buckets that hold a city of the file are written anew. ``read_keyed`` reads the register.
    """
    source, bad = read_register(spark, csv_path)
    update = [c for c in REGISTER.names if c not in REGISTER_KEYS]
    upsert_keyed(source, root, REGISTER, REGISTER_KEYS, update)
    skipped = bad.agg(F.count(F.lit(1))).first()[0]
    return f"register load completed, {skipped} rows skipped"

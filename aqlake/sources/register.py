"""The location register: a semicolon CSV with a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aqlake.session import materialize
from aqlake.sources.schemas import REGISTER

_CORRUPT = "_corrupt_record"


def read_register(spark: SparkSession, path: str, schema: T.StructType = REGISTER) -> tuple[DataFrame, DataFrame]:
    """Good rows, and rows that do not fit the schema (kept with their raw text).

    Columns are taken by position. A byte order mark before the header, and separators,
    line breaks and doubled quotes within quotes are understood, so a file is read by one
    task: deliver a large register in several files. One bad row does not stop the load.

    The parsed rows are kept in a staging table: read straight from the file, a
    row is only judged by the columns a query happens to select.
    """
    parsed = (
        spark.read.schema(T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())]))
        .option("sep", ";")
        .option("quote", '"')
        .option("escape", '"')  # a quote within quotes is doubled
        .option("header", True)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .csv(path)
    )
    rows = materialize(parsed, "staging-register")
    return rows.where(F.col(_CORRUPT).isNull()).drop(_CORRUPT), rows.where(F.col(_CORRUPT).isNotNull())


def coordinate_pairs(register: DataFrame) -> DataFrame:
    """The places to ask for: latitude and longitude of every register row."""
    return register.select("lat", "lon")


def peek_lines(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """First field of every record of a raw file, header included, by position."""
    first = T.StructType([T.StructField("first_field", T.StringType())])
    reader = spark.read.schema(first).option("header", False).option("sep", sep)
    return reader.option("escape", '"').option("multiLine", True).csv(path)

"""Keys derived from values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(*columns: Column | str) -> Column:
    """64-bit hash key. Both sides of a join must hash the same types.

    NULL parts are skipped by the hash, so ``(1.5, NULL)`` and ``(NULL, 1.5)``
    get the same key: use it on columns that are not NULL.
    """
    return F.xxhash64(*columns)


def coord_prefix(coordinate: Column | str, length: int = 5) -> Column:
    """The first ``length`` characters of a coordinate's decimal text.

    Spark writes numbers below 0.001 and from ten million on with an exponent;
    those go through a decimal, so that 0.00051 gives ``0.000``.
    """
    column = F.col(coordinate) if isinstance(coordinate, str) else coordinate
    plain = (F.abs(column) >= 0.001) & (F.abs(column) < 10_000_000)
    spelled_out = F.rtrim(column.try_cast("decimal(38,15)").cast("string"), F.lit("0"))
    return F.substring(F.when(plain, column.cast("string")).otherwise(spelled_out), 1, length)

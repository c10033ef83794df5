"""Vectors as exact integers, and packed blocks of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """Whether a vector of doubles is neither null nor empty and holds no null or non-finite component."""
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(fine & (F.size(vector) > 0), F.lit(False))


def scaled(vector: Column, scale: int, shift: int = 0, most: int = 1 << 40) -> Column:
    """``floor(scale * c) + shift`` of each component; beyond ``most`` a product counts as ``most``."""
    held = lambda c: F.greatest(F.least(scale * c, F.lit(float(most))), F.lit(-float(most)))
    return F.transform(vector, lambda c: F.floor(held(c)) + F.lit(shift).cast("bigint"))


def of_common_length(rows: DataFrame, column: str) -> tuple[DataFrame, int]:
    """The rows whose array has the commonest length (of equally common ones the longest), and that length; 0 without rows."""
    lengths = rows.groupBy(F.size(column).alias("length")).count()
    top = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    length = top["length"] if top else 0
    return rows.where(F.size(column) == length), length

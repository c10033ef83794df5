"""Update matched rows, insert the rest."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str]) -> DataFrame:
    """The target after the upsert, with the target's columns.

    Matched rows take the source's ``update`` columns (NULLs included); source
    rows without a match are added; nothing is removed. NULL keys match nothing.
    Source keys must be unique among matched rows: see ``ambiguous_matches``.

    Two one-sided joins rather than one full outer join: a small source can then
    be broadcast to the target, which stays where it is, and a hot target key
    can be split. The target's keys are cut down to the matched ones before the
    inserts are found. Both inputs are read more than once: pass stored tables.
    """
    fresh = source.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        F.struct(*update).alias("_new"),
    )
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_key_{k}") for k in keys])
    updated = target.join(fresh, same, "left").select(
        *[
            F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c)
            if c in update
            else F.col(c)
            for c in target.columns
        ]
    )
    matched = target.select(*keys).join(source.select(*keys), list(keys), "left_semi")
    inserted = source.join(matched, list(keys), "left_anti").select(*target.columns)
    return updated.unionByName(inserted)


def ambiguous_matches(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys present in the target that the source holds more than once."""
    repeated = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_source")).where("n_source > 1")
    return repeated.join(target.select(*keys), list(keys), "left_semi")

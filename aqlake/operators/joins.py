"""Joining the two feeds, and joining places to the register."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aqlake.functions.keys import coord_prefix

FEED_KEYS = ("record_ts", "lat", "lon")


def join_feeds(left: DataFrame, right: DataFrame, on: Sequence[str] = FEED_KEYS) -> DataFrame:
    """Inner equi-join of two feeds on time and place.

    Both sides reach the join as plain shuffles, so AQE can split a hot key.
    """
    return left.join(right, list(on), "inner")


def unmatched_counts(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str] = FEED_KEYS,
    by: Sequence[str] = ("record_ts",),
) -> DataFrame:
    """How many rows of each side the inner join drops, per ``by`` columns.

    The feeds meet only if times agree to the second, so lost rows should be
    seen. One aggregation over the union of both key sets: counts are combined
    map-side, and no row pair is built.
    """
    sides = left.select(*on, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionAll(
        right.select(*on, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    per_key = sides.groupBy(*on).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    null_key = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    return (
        per_key.where(null_key | (F.col("_l") == 0) | (F.col("_r") == 0))
        .groupBy(*by)
        .agg(F.sum("_l").alias("left_unmatched"), F.sum("_r").alias("right_unmatched"))
    )


def attach_register(
    rows: DataFrame,
    register: DataFrame,
    columns: Sequence[str] = ("city", "population"),
    coord_match: str = "prefix",
    prefix: int = 5,
    lat: str = "lat",
    lon: str = "lon",
) -> DataFrame:
    """Left join of places to the register; unmatched places keep NULL ``columns``.

    ``prefix`` compares the first characters of both coordinates' decimal text,
    so a place next to two register rows is returned once for each. ``exact``
    compares the numbers. Either way it is an equi-join: no row pairs are
    tested. The register is not hinted; Spark broadcasts it while its size is
    below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it beyond that.
    """
    if coord_match == "prefix":
        def key(column: str):
            return coord_prefix(column, prefix)
    elif coord_match == "exact":
        key = F.col
    else:
        raise ValueError(f"coord_match must be 'prefix' or 'exact', not {coord_match!r}")
    places = register.select(key(lat).alias("_lat"), key(lon).alias("_lon"), *columns)
    return rows.join(
        places, (key(lat) == F.col("_lat")) & (key(lon) == F.col("_lon")), "left"
    ).drop("_lat", "_lon")

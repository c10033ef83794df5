"""From staging rows to the wide table and the star schema."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aqlake.feeds import POLLUTANTS, WEATHER_MEASURES, Feed
from aqlake.functions.labels import prominent_pollutant
from aqlake.functions.timeparts import calendar_parts
from aqlake.operators.deliveries import newest_deliveries
from aqlake.operators.flatten import flatten_results
from aqlake.operators.joins import attach_register, join_feeds
from aqlake.operators.star import conditions_fact, date_dim, location_dim


class Star(NamedTuple):
    fact: DataFrame
    locations: DataFrame
    dates: DataFrame


def curate(
    staging: DataFrame, feed: Feed, strict: bool = True, ties: str = "keep", rejected: str | None = None
) -> DataFrame:
    """Newest complete delivery of every time, flattened. Whole deliveries are ranked, not elements.

    Deliveries of equal time and load time are all kept, or with ``ties="one"``
    the one whose file name comes last. ``strict`` and ``rejected`` as in ``flatten_results``.
    """
    return flatten_results(newest_deliveries(staging, ties), feed.fields, strict=strict, rejected=rejected)


def conditions_wide(
    pollution: DataFrame, weather: DataFrame, register: DataFrame, coord_match: str = "prefix"
) -> DataFrame:
    """Both feeds and the register, one row per time, place and register match."""
    air = pollution.select("record_ts", "lat", "lon", "aqi", *POLLUTANTS)
    sky = weather.select("record_ts", "lat", "lon", "weather_con", *WEATHER_MEASURES)
    placed = attach_register(join_feeds(air, sky), register, coord_match=coord_match)
    return placed.select(
        "record_ts",
        *calendar_parts("record_ts"),
        "city",
        "population",
        "lat",
        "lon",
        "aqi",
        *POLLUTANTS,
        prominent_pollutant().alias("prominent_pollutant"),
        "weather_con",
        *WEATHER_MEASURES,
    )


def build_star(wide: DataFrame) -> Star:
    """Fact and dimensions. Pass a stored wide table: it is read three times."""
    return Star(conditions_fact(wide), location_dim(wide), date_dim(wide))


def with_record_date(df: DataFrame, time: str = "record_ts") -> DataFrame:
    """Add the storage partition column."""
    return df.withColumn("record_date", F.to_date(time))

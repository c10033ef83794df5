"""Declared schemas of stored tables. Nothing is ever inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

from aqlake.feeds import AVERAGED_MEASURES, POLLUTANTS, POLLUTION, WEATHER, WEATHER_MEASURES, Feed

_SPARK_TYPES = {
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
}

# Register columns in file order (loading is by position).
REGISTER = T.StructType([
    T.StructField("city", T.StringType()),
    T.StructField("city_ascii", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("country_code", T.StringType()),
    T.StructField("population", T.IntegerType()),
    T.StructField("timezone", T.StringType()),
    T.StructField("country", T.StringType()),
])
REGISTER_KEYS = ("city", "lat", "lon")

# One row per landed document; ``record_date`` is the storage partition. ``delivery``,
# ``part`` and ``parts`` say which documents belong together (NULL, 0, 1: a document by itself);
# ``reason`` why one without a ``record_ts`` is not loaded.
STAGING = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("record_ts", T.TimestampNTZType()),
    T.StructField("json_data", T.VariantType()),
    T.StructField("ingestion_ts", T.TimestampType()),
    T.StructField("source_filename", T.StringType()),
    T.StructField("stg_file_md5", T.StringType()),
    T.StructField("delivery", T.StringType()),
    T.StructField("part", T.IntegerType()),
    T.StructField("parts", T.IntegerType()),
    T.StructField("reason", T.StringType()),
    T.StructField("record_date", T.DateType()),
])
# A value that could not be read as its column's type, as JSON text.
REJECTED = T.ArrayType(
    T.StructType([
        T.StructField("column", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("value", T.StringType()),
    ])
)


def curated(feed: Feed) -> T.StructType:
    """Schema of a feed's flattened table."""
    return T.StructType([
        T.StructField("record_ts", T.TimestampNTZType()),
        *[T.StructField(name, _SPARK_TYPES[dtype]) for name, _, dtype in feed.fields],
        T.StructField("ingestion_ts", T.TimestampType()),
        T.StructField("source_filename", T.StringType()),
        T.StructField("stg_file_md5", T.StringType()),
    ])


_TYPE_OF = {name: _SPARK_TYPES[dtype] for feed in (POLLUTION, WEATHER) for name, _, dtype in feed.fields}
_CALENDAR = [T.StructField(f"meas_{p}", T.IntegerType()) for p in ("year", "quarter", "month", "day", "hour")]
_PLACE = [
    T.StructField("city", T.StringType()),
    T.StructField("population", T.IntegerType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
]
_POLLUTANTS = [T.StructField(name, T.DoubleType()) for name in POLLUTANTS]
_WEATHER = [T.StructField(name, _TYPE_OF[name]) for name in WEATHER_MEASURES]
_AQI = T.StructField("aqi", T.IntegerType())
_PROMINENT = T.StructField("prominent_pollutant", T.StringType())
_CONDITION = T.StructField("weather_con", T.StringType())

WIDE = T.StructType([
    T.StructField("record_ts", T.TimestampNTZType()),
    *_CALENDAR, *_PLACE, _AQI, *_POLLUTANTS, _PROMINENT, _CONDITION, *_WEATHER,
])
DATE_DIM = T.StructType([
    T.StructField("date_pk", T.LongType()),
    T.StructField("measurement_time", T.TimestampNTZType()),
    *_CALENDAR,
])
LOCATION_DIM = T.StructType([T.StructField("location_pk", T.LongType()), *_PLACE])
FACT = T.StructType([
    T.StructField("measurement_pk", T.LongType()),
    T.StructField("date_fk", T.LongType()),
    T.StructField("location_fk", T.LongType()),
    _AQI, _PROMINENT, _CONDITION, *_POLLUTANTS, *_WEATHER,
])
DAY_AGG = T.StructType([
    T.StructField("city", T.StringType()),
    T.StructField("measurement_date", T.DateType()),
    T.StructField("measurement_time", T.TimestampNTZType()),
    *[T.StructField(f"{name}_avg", T.DoubleType()) for name in AVERAGED_MEASURES],
])

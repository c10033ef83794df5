"""Derived tables kept up to date by day.

A refresh recomputes whole days and writes them as a new version; it never
changes files that readers may be using::

    <root>/<table>/version=<n>/record_date=<day>/...   rows
    <root>/register/version=<n>/...                    the register, where version n brought a new one
    <root>/versions/version=<n>/...                    days replaced by version n

The list of days is written last, so a refresh that dies half-way is invisible
and simply runs again. It names every refreshed day, also those left without
rows: a later delivery can take a day's last row away, and then the day has to
become empty (a dynamic partition overwrite would keep the old rows).

The list is also the stamp of each day's inputs: ``version`` says which version holds
the tables that depend on the register, ``curated_version`` which one holds the
flattened documents. All days always rest on one and the same register, the newest that a
listed version has brought: when it changes, the days whose places changed are derived
again from their flattened documents, in the same version.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aqlake.feeds import POLLUTION, WEATHER, Feed
from aqlake.operators.joins import attach_register
from aqlake.operators.star import PLACE, conditions_fact, date_dim, day_agg, location_dim
from aqlake.plans.conditions import conditions_wide, curate, with_record_date
from aqlake.session import drop_folder, materialize
from aqlake.sources import schemas
from aqlake.streaming.ingest import read_staging

CURATED = {f"curated_{feed.name}": feed for feed in (POLLUTION, WEATHER)}
_REJECTED = T.StructField("rejected", schemas.REJECTED)
_STORED_BY = [T.StructField("version", T.LongType()), T.StructField("record_date", T.DateType())]
_TABLES = {
    # Values that could not be read stand beside the rows they are missing from.
    **{table: T.StructType([*schemas.curated(feed).fields, _REJECTED]) for table, feed in CURATED.items()},
    "wide": schemas.WIDE,
    "conditions_fact": schemas.FACT,
    # Its date is the day it is stored under, so it is not stored a second time.
    "day_agg": T.StructType([f for f in schemas.DAY_AGG.fields if f.name != "measurement_date"]),
    "dates": schemas.DATE_DIM,
    "locations": schemas.LOCATION_DIM,
}
_VERSIONS = T.StructType([
    T.StructField("record_date", T.DateType()),
    T.StructField("curated_version", T.LongType()),
    T.StructField("version", T.LongType()),
])
# What derived rows take from the register, and how they found it.
_PLACES = T.StructType([
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("city", T.StringType()),
    T.StructField("population", T.IntegerType()),
    T.StructField("coord_match", T.StringType()),
])


def _existing(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table, empty if there is none yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _listed(spark: SparkSession, root: str) -> DataFrame:
    return _existing(spark, f"{root}/versions", _VERSIONS)


def _newest(listed: DataFrame) -> DataFrame:
    """Newest version of every day, and the version that holds its flattened documents."""
    # Both numbers only grow, so each is the largest by itself.
    return listed.groupBy("record_date").agg(F.max("version").alias("version"), F.max("curated_version").alias("curated_version"))


def _versions(spark: SparkSession, root: str) -> DataFrame:
    """At most one row per calendar day."""
    return _newest(_listed(spark, root))


def list_days(rows: DataFrame) -> list[dt.date]:
    """The distinct ``record_date`` values of ``rows``: at most one per calendar day."""
    found = rows.where("record_date IS NOT NULL").select("record_date").distinct().collect()
    return [r.record_date for r in found]


def _stored(spark: SparkSession, root: str, table: str) -> DataFrame:
    schema = T.StructType([*_TABLES[table].fields, *_STORED_BY])
    return _existing(spark, f"{root}/{table}", schema)


def read_current(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Rows of a derived table as of the last finished refresh, with ``record_date``."""
    rows = _current(spark, root, table)
    return rows.drop("rejected") if table in CURATED else rows


def _current(spark: SparkSession, root: str, table: str) -> DataFrame:
    rows = _stored(spark, root, table)
    # One flat list of literals on the partition columns, however many days there are:
    # outdated versions are not even opened, and the plan does not nest.
    held_by = "curated_version" if table in CURATED else "version"
    current = [f"{row[held_by]}/{row.record_date}" for row in _versions(spark, root).collect()]
    stored_as = F.concat(F.col("version").cast("string"), F.lit("/"), F.col("record_date").cast("string"))
    return rows.where(stored_as.isin(current)).drop("version")


def read_rejected(spark: SparkSession, root: str) -> DataFrame:
    """Values of the current documents that could not be read as their column's type.

    (feed, record_ts, lat, lon, source_filename, stg_file_md5, column, path, value,
    record_date): the file, the place in the document's element, and the value as JSON text. The
    column of the flattened table is NULL there. Corrected documents take their rejects away.
    """
    def of(table: str, feed: Feed) -> DataFrame:
        return (
            _current(spark, root, table)
            .where(F.col("rejected").isNotNull())
            .select("*", F.explode("rejected").alias("one"))
            .select(
                F.lit(feed.name).alias("feed"), "record_ts", "lat", "lon", "source_filename", "stg_file_md5",
                "one.column", "one.path", "one.value", "record_date",
            )
        )

    return reduce(DataFrame.unionAll, [of(table, feed) for table, feed in CURATED.items()])


def read_day_agg(spark: SparkSession, root: str) -> DataFrame:
    """The hourly averages; a filter on ``measurement_date`` opens that day's files only."""
    return (
        read_current(spark, root, "day_agg")
        .withColumnRenamed("record_date", "measurement_date")
        .select(*schemas.DAY_AGG.names)
    )


def read_date_dim(spark: SparkSession, root: str) -> DataFrame:
    """The date dimension: days share no measuring time, so their lists just add up."""
    return read_current(spark, root, "dates").drop("record_date")


def read_location_dim(spark: SparkSession, root: str) -> DataFrame:
    """The location dimension, from the places already reduced to one row per day."""
    return read_current(spark, root, "locations").drop("record_date").distinct()


def _pinned_register(spark: SparkSession, root: str) -> DataFrame | None:
    """The register that all current days rest on."""
    version = T.StructField("version", T.LongType())
    committed = _listed(spark, root).agg(F.max("version")).first()[0]
    if committed is None:
        return None
    stored = _existing(spark, f"{root}/register", T.StructType([*_PLACES.fields, version]))
    newest = stored.where(F.col("version") <= committed).agg(F.max("version")).first()[0]
    return stored.where(F.col("version") == newest).drop("version") if newest is not None else None


def _places_of(register: DataFrame, coord_match: str) -> DataFrame:
    columns = [F.col(f.name).cast(f.dataType) for f in _PLACES.fields[:-1]]
    return register.select(*columns, F.lit(coord_match).alias("coord_match"))


def _changed_places(old: DataFrame | None, new: DataFrame) -> DataFrame | None:
    """Rows (places) that only one of the registers has; None if they hold the same rows equally often."""
    if old is None:
        return new
    counted = [df.groupBy(*_PLACES.names).agg(F.count(F.lit(1)).alias("n")) for df in (old, new)]
    signed = counted[0].unionAll(counted[1].withColumn("n", -F.col("n")))
    changed = materialize(signed.groupBy(*_PLACES.names).agg(F.sum("n").alias("n")).where("n <> 0").drop("n"), "changed-places")
    return None if changed.isEmpty() else changed


def days_of_places(spark: SparkSession, root: str, changed: DataFrame, coord_match: str) -> list[dt.date]:
    """The stored days with a row whose place matches one of ``changed``.

    Read off the places already reduced to one row per day. A change of ``coord_match`` touches
    every place, and with it all days.
    """
    if not changed.where(F.col("coord_match") != coord_match).isEmpty():
        return [row.record_date for row in _versions(spark, root).select("record_date").collect()]
    places = read_current(spark, root, "locations").select("lat", "lon", "record_date")
    touched = attach_register(places, changed.select("lat", "lon").distinct().withColumn("touched", F.lit(True)), ["touched"], coord_match)
    return list_days(touched.where("touched"))


def refresh(
    spark: SparkSession,
    pollution_path: str,
    weather_path: str,
    register: DataFrame,
    root: str,
    days: list[dt.date] | None = None,
    coord_match: str = "prefix",
) -> None:
    """Bring ``days`` up to date with both staging tables, or all days if ``days`` is None.

    A day depends on that day's documents and on the register. If the register (its
    coordinates, names and populations, or ``coord_match``) is not the one the stored days
    rest on, the days whose places changed are derived again too, from the
    flattened documents they already have: no document is read for it. With no days
    and an unchanged register nothing is written.

    A value of the wrong type does not stop a refresh: its column is NULL, and
    ``read_rejected`` lists it. One refresh at a time.
    """
    staging = {
        POLLUTION.name: read_staging(spark, pollution_path, days),
        WEATHER.name: read_staging(spark, weather_path, days),
    }
    everything = days is None
    register = materialize(_places_of(register, coord_match), "register")  # one state of it, whatever happens meanwhile
    pinned = _pinned_register(spark, root)
    changed = _changed_places(pinned, register)
    if everything:
        known = _versions(spark, root).select("record_date")
        replaced = reduce(DataFrame.unionAll, [known, *[s.select("record_date") for s in staging.values()]])
        days = list_days(replaced)
    renamed: list[dt.date] = []
    if pinned is not None and changed is not None and not everything:
        renamed = sorted(set(days_of_places(spark, root, changed, coord_match)) - set(days))
    if not days and not renamed and changed is None:
        return
    version = (_listed(spark, root).agg(F.max("version")).first()[0] or 0) + 1

    def store(df: DataFrame, table: str, gather: bool = True) -> DataFrame:
        if gather:  # few files for small days, several for a hot one
            df = df.hint("rebalance", "record_date")
        path = f"{root}/{table}/version={version}"
        df.write.mode("overwrite").partitionBy("record_date").parquet(path)
        # Read back from its own folder: older versions are not even listed.
        by_day = T.StructType([*_TABLES[table].fields, T.StructField("record_date", T.DateType())])
        return spark.read.schema(by_day).parquet(path)

    # Each step reads what the one before it stored: documents are parsed once,
    # the feeds are joined once, and a lost executor never sends work further back.
    # Rows that come straight from files of single days need no shuffle to be
    # written by day again; only after a join or aggregation are they gathered.
    # Rebuilding all days, the dedup join may have been a shuffled one.
    curated = []
    for table, feed in CURATED.items():
        kept = _current(spark, root, table).where(F.col("record_date").isin(renamed)) if renamed else None
        if days:
            flat = with_record_date(curate(staging[feed.name], feed, strict=False, rejected="rejected"))
            rows = store(flat, table, gather=everything)
            kept = rows if kept is None else rows.unionByName(kept)
        curated.append(kept)
    if days or renamed:
        wide = store(with_record_date(conditions_wide(*curated, register, coord_match)), "wide")
        # By place within a day: a place's rows stand together, and row groups without it are skipped.
        placed = conditions_fact(wide, extra=("record_date",)).sortWithinPartitions("record_date", "location_fk", "date_fk")
        fact = store(placed, "conditions_fact", gather=False)
        dates = store(with_record_date(date_dim(wide), "measurement_time"), "dates")
        locations = store(location_dim(wide, (*PLACE, "record_date")), "locations")
        averages = day_agg(fact, locations, dates)
        store(averages.withColumnRenamed("measurement_date", "record_date"), "day_agg")
    if changed is not None:
        register.write.mode("overwrite").parquet(f"{root}/register/version={version}")
    else:  # a refresh that died half-way may have left another one there
        drop_folder(spark, f"{root}/register/version={version}")
    # Days by number of rows: one per calendar day. A version without any day still commits its register.
    held_by = {row.record_date: row.curated_version for row in _versions(spark, root).collect()} if renamed else {}
    stamps = [(day, version) for day in days] + [(day, held_by[day]) for day in renamed] or [(None, None)]
    listed = spark.createDataFrame(stamps, T.StructType(_VERSIONS.fields[:2]))
    listed.coalesce(1).write.mode("overwrite").parquet(f"{root}/versions/version={version}")


def drop_outdated(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete stored days that a later version has replaced; returns how many.

    Days replaced by one of the last ``keep`` versions stay, for readers that
    planned before. Only folders are listed and deleted; no data is read.
    """
    listed = _listed(spark, root)
    newest = listed.agg(F.max("version")).first()[0]
    if newest is None:
        return 0
    settled = materialize(_newest(listed.where((F.col("version") <= newest - keep) & F.col("record_date").isNotNull())), "settled")
    dropped = 0
    for table in _TABLES:
        stored = _stored(spark, root, table).select("version", "record_date").distinct()
        last = settled.select("record_date", F.col("curated_version" if table in CURATED else "version").alias("_last"))
        outdated = stored.join(last, "record_date").where(F.col("version") < F.col("_last"))
        for row in outdated.select("version", "record_date").toLocalIterator():
            dropped += drop_folder(spark, f"{root}/{table}/version={row.version}/record_date={row.record_date}")
    return dropped

"""The test tables seen as the library's inputs.

Events stand for readings: all events of a user within an hour make one reading
at that user's place. Customers stand for the register of places. Orders and
line items are used as plain keyed tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aqlake.feeds import POLLUTANTS, Feed
from aqlake.operators.envelope import build_envelope, document_name
from aqlake.operators.star import conditions_fact, day_agg
from aqlake.plans.conditions import Star, build_star, conditions_wide, with_record_date
from aqlake.session import scratch_path

EVENT_TYPES = ("click", "view", "purchase", "signup", "error")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hour_of(ts: str | Column) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def epoch_of(ts: str | Column) -> Column:
    """Epoch seconds of a UTC wall clock, whatever the session zone."""
    column = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_timestamp(F.from_utc_timestamp(column.cast("timestamp"), F.current_timezone())).cast("bigint")


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as register rows."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("place_id"),
        F.col("c_name").alias("city"),
        F.col("c_acctbal").alias("lat"),
        F.col("c_custkey").cast("double").alias("lon"),
        F.col("c_nationkey").alias("population"),
    )


def readings(events: DataFrame) -> DataFrame:
    """One row per user and hour. Combined map-side, so a busy user or hour is no burden."""
    k = F.get_json_object("props", "$.k").cast("int")
    measured = events.groupBy(hour_of("ts").alias("record_ts"), "user_id").agg(
        F.count(F.lit(1)).cast("int").alias("n"),
        *[F.max(F.when(F.col("event_type") == t, F.col("value"))).alias(t) for t in EVENT_TYPES],
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        F.min(k).alias("k_low"),
        F.max(k).alias("k_high"),
    )
    # First type by name. Read off the maxima: aggregating text would sort, not hash.
    first = F.coalesce(*[F.when(F.col(t).isNotNull(), F.lit(t)) for t in sorted(EVENT_TYPES)])
    return measured.withColumn("first_type", first)


def placed_readings(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    events = table(spark, sf_dir, "events") if events is None else events
    where = places(spark, sf_dir).select("place_id", "lat", "lon")
    return readings(events).join(where, F.col("user_id") == F.col("place_id"), "inner")


def _pollutants() -> list[Column]:
    sources = (F.col("k_high").try_cast("double"), *[F.col(t) for t in EVENT_TYPES], F.col("high"), F.col("low"))
    return [c.alias(name) for c, name in zip(sources, POLLUTANTS, strict=True)]


def _has_weather() -> Column:
    return F.coalesce("click", "view", "purchase").isNotNull()


def pollution_rows(placed: DataFrame) -> DataFrame:
    return placed.select("record_ts", "lat", "lon", F.col("n").alias("aqi"), *_pollutants())


def weather_rows(placed: DataFrame) -> DataFrame:
    """Only users who clicked, viewed or bought have weather: the feeds do not match everywhere."""
    return placed.where(_has_weather()).select(
        "record_ts", "lat", "lon",
        F.col("first_type").alias("weather_con"),
        F.col("low").alias("temp"),
        F.col("high").alias("feels_like"),
        F.col("low").alias("min_temp"),
        F.col("high").alias("max_temp"),
        F.col("k_low").cast("double").alias("pressure"),
        F.col("k_high").cast("double").alias("humidity"),
        F.col("k_low").alias("visibility"),
        (F.col("high") / 2).alias("wind_speed"),
        F.round("high").cast("int").alias("wind_deg"),
        F.col("n").alias("clouds"),
    )


def pollution_element() -> Column:
    return F.struct(
        F.struct("lat", "lon").alias("coord"),
        F.array(
            F.struct(
                epoch_of("record_ts").alias("dt"),
                F.struct(F.col("n").alias("aqi")).alias("main"),
                F.struct(*_pollutants()).alias("components"),
            )
        ).alias("list"),
    )


def weather_element() -> Column:
    return F.struct(
        F.col("user_id").alias("id"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("name"),
        epoch_of("record_ts").alias("dt"),
        F.col("k_low").alias("visibility"),
        F.struct("lat", "lon").alias("coord"),
        F.array(F.struct(F.col("first_type").alias("description"))).alias("weather"),
        F.struct(
            F.col("low").alias("temp"), F.col("high").alias("feels_like"),
            F.col("low").alias("temp_min"), F.col("high").alias("temp_max"),
            F.col("k_low").alias("pressure"), F.col("k_high").alias("humidity"),
        ).alias("main"),
        # The bearing keeps its fraction: reading it as int has to round.
        F.struct((F.col("high") / 2).alias("speed"), F.col("high").alias("deg")).alias("wind"),
        F.struct(F.col("n").alias("all")).alias("clouds"),
    )


def feed_documents(placed: DataFrame, feed_name: str) -> DataFrame:
    """Hourly documents of a feed."""
    if feed_name == "pollution":
        rows, element = placed, pollution_element()
    else:
        rows, element = placed.where(_has_weather()), weather_element()
    return build_envelope(rows, ["record_ts"], element, epoch_of("record_ts"), ["user_id"])


def spoilt_readings(placed: DataFrame) -> DataFrame:
    """Readings whose documents hold words or huge numbers for some values; numbers are sent as text."""
    return (
        placed.withColumn("n", F.when(F.col("high") > 90, F.lit("n/a")).otherwise(F.col("n").cast("string")))
        .withColumn("k_high", F.when(F.col("low") < 5, F.lit("wet")).otherwise(F.col("k_high").cast("string")))
        .withColumn("k_low", F.when(F.col("low") > 95, F.lit(10**12)).otherwise(F.col("k_low").cast("bigint")))
    )


def event_documents(events: DataFrame, max_elements: int = 10_000) -> DataFrame:
    """Hourly documents whose elements are the events themselves."""
    element = F.struct(
        "event_id", "user_id", "event_type", "value", epoch_of("ts").alias("dt"),
        F.struct(F.get_json_object("props", "$.k").cast("int").alias("k")).alias("props"),
    )
    return build_envelope(
        events.withColumn("hour", hour_of("ts")), ["hour"], element, epoch_of("ts"), ["ts", "event_id"], max_elements
    )


EVENT_FIELDS = (
    ("event_id", "$.event_id", "bigint"),
    ("user_id", "$.user_id", "int"),
    ("event_type", "$.event_type", "string"),
    ("value", "$.value", "double"),
    ("k", "$.props.k", "int"),
)


def as_files(documents: DataFrame, feed: Feed, run_ts: str) -> DataFrame:
    """Documents in the shape the file source gives, without going through files."""
    return documents.select(
        F.concat_ws("/", document_name(feed, F.col(run_ts)), "part").alias("path"),
        F.col("document").alias("content"),
    )


def wide(spark: SparkSession, sf_dir: str, coord_match: str = "prefix") -> DataFrame:
    placed = placed_readings(spark, sf_dir)
    return conditions_wide(pollution_rows(placed), weather_rows(placed), places(spark, sf_dir), coord_match)


_stored: dict[tuple[str, str, str], str] = {}


def store_once(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """Path of stored derived data, written on first use in this session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        path = scratch_path(spark, name)
        write(path)
        _stored[key] = path
    return _stored[key]


_tables: dict[tuple[str, str, str], DataFrame] = {}


def stored_table(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A derived table, written on first use in this session and then only read."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _tables:
        df = build()
        writer = df.write
        if name == "day_agg":  # by day, as the serving queries filter it
            writer = df.hint("rebalance", "measurement_date").write.partitionBy("measurement_date")
        if name == "conditions_fact":  # as a refresh stores it
            by_day = df.hint("rebalance", "record_date").sortWithinPartitions("record_date", "location_fk", "date_fk")
            writer = by_day.write.partitionBy("record_date")
        path = store_once(spark, sf_dir, name, writer.parquet)
        _tables[key] = spark.read.schema(df.schema).parquet(path)
    return _tables[key]


def stored_star(spark: SparkSession, sf_dir: str) -> Star:
    """Fact and dimensions as stored tables, as the dashboard finds them."""
    def stored_wide() -> DataFrame:
        return stored_table(spark, sf_dir, "wide", lambda: wide(spark, sf_dir))

    def built() -> Star:
        return build_star(stored_wide())

    return Star(
        stored_table(spark, sf_dir, "conditions_fact", lambda: conditions_fact(with_record_date(stored_wide()), extra=("record_date",))),
        stored_table(spark, sf_dir, "location_dim", lambda: built().locations),
        stored_table(spark, sf_dir, "date_dim", lambda: built().dates),
    )


def stored_day_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_table(spark, sf_dir, "day_agg", lambda: day_agg(*stored_star(spark, sf_dir)))

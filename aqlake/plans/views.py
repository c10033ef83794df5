"""The stored tables under the names that SQL users query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aqlake.functions.labels import register_functions
from aqlake.plans.refresh import read_current, read_date_dim, read_day_agg, read_location_dim, read_rejected
from aqlake.streaming.ingest import read_staging


def create_views(
    spark: SparkSession,
    root: str,
    pollution_path: str | None = None,
    weather_path: str | None = None,
    register: DataFrame | None = None,
) -> list[str]:
    """Register the derived tables as temporary views, and ``prominent_index`` as a function.

    The views show the state of the last finished refresh at the time of this
    call; call again after a refresh. Returns the view names.
    """
    views = {
        "curated_pollution": read_current(spark, root, "curated_pollution"),
        "curated_weather": read_current(spark, root, "curated_weather"),
        "final_conditions_wide": read_current(spark, root, "wide"),
        "conditions_fact": read_current(spark, root, "conditions_fact"),
        "rejected_values": read_rejected(spark, root),
    }
    # The day a row is stored under is not part of the tables users know.
    views = {name: df.drop("record_date") for name, df in views.items()}
    views["conditions_fact_day_agg"] = read_day_agg(spark, root)
    views["date_dim"] = read_date_dim(spark, root)
    views["location_dim"] = read_location_dim(spark, root)
    if pollution_path:
        views["staging_pollution"] = read_staging(spark, pollution_path).drop("record_date")
    if weather_path:
        views["staging_weather"] = read_staging(spark, weather_path).drop("record_date")
    if register is not None:
        views["cities_pop"] = register
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    register_functions(spark)
    return sorted(views)

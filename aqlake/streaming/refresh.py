"""Incremental refresh: newly landed documents bring their days up to date."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from aqlake.plans.refresh import list_days, refresh
from aqlake.streaming.ingest import staging_days


def refresh_landed(
    spark: SparkSession,
    pollution_path: str,
    weather_path: str,
    register: Callable[[], DataFrame],
    root: str,
    checkpoint: str,
    coord_match: str = "prefix",
) -> StreamingQuery:
    """Refresh the days of all documents landed since the last run, then stop.

    Either feed can trigger a day, and a day is always recomputed from both.
    A micro-batch that runs twice computes the same days again, which does no
    harm. ``register`` is called per micro-batch, to read the current register.
    """

    def on_batch(batch: DataFrame, _batch_id: int) -> None:
        session = batch.sparkSession
        days = list_days(batch)
        refresh(session, pollution_path, weather_path, register(), root, days, coord_match)

    days = staging_days(spark, pollution_path).unionAll(staging_days(spark, weather_path))
    return (
        days.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

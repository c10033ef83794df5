"""Everything from landed files to served tables, in dependency order."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession

from aqlake.feeds import POLLUTION, WEATHER, Feed
from aqlake.plans.refresh import refresh
from aqlake.session import folder_exists, make_folder
from aqlake.streaming.ingest import ingest
from aqlake.streaming.refresh import refresh_landed


class Lake(NamedTuple):
    """Folders of one lake, all below ``root``."""

    root: str

    @property
    def derived(self) -> str:
        return f"{self.root}/derived"

    def staging(self, feed: Feed) -> str:
        return f"{self.root}/staging_{feed.name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"


def catch_up(
    spark: SparkSession,
    landing: str,
    lake: Lake,
    register: Callable[[], DataFrame],
    coord_match: str = "prefix",
    gather_days: bool = False,
) -> None:
    """Take in what has landed in ``<landing>/<feed>`` and refresh the days it belongs to.

    Both feeds are taken in side by side, then their days are refreshed, and so are the days
    whose places the register has changed since. How often to call this decides how fresh
    the tables are. A feed whose folder does not exist (yet) has no documents. If one feed
    cannot be taken in, the other is taken in nevertheless, nothing is refreshed, and
    the error is raised.
    """
    queries = []
    for feed in (POLLUTION, WEATHER):
        source, target = f"{landing}/{feed.name}", lake.staging(feed)
        if folder_exists(spark, source):
            queries.append(ingest(spark, source, feed, target, lake.checkpoint(feed.name), gather_days=gather_days))
        else:
            make_folder(spark, target)
            make_folder(spark, f"{target}-days")
    failed = []
    for query in queries:
        try:
            query.awaitTermination()
        except StreamingQueryException as error:
            failed.append(error)
    if failed:
        raise failed[0]
    staged = (lake.staging(POLLUTION), lake.staging(WEATHER))
    refreshed = refresh_landed(spark, *staged, register, lake.derived, lake.checkpoint("refresh"), coord_match)
    refreshed.awaitTermination()
    if not any(progress["numInputRows"] for progress in refreshed.recentProgress):
        # Without new documents no micro-batch has looked at the register.
        refresh(spark, *staged, register(), lake.derived, [], coord_match)

"""Time the headline queries and print one JSON line.

Each query is built and run to the end (``noop`` sink). The first run of a query
is a warm-up; the better of two further runs is reported. Queries that ingest
and refresh by streaming, or store tables on first use, are timed once, cold:
a second run would find its work done. Log output goes to stderr.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from aqlake.session import build_session
from checks.queries import QUERIES

WARM = (
    "latest_per_key", "envelope", "flatten_json", "argmax_label", "calendar", "prefix_join", "two_feed_join",
    "unmatched_feeds", "wide", "wide_from_documents", "location_dim", "star_join", "day_agg", "city_list",
    "series_all", "latest_snapshot", "city_points", "upsert", "csv_ingest",
)
COLD = ("stream_ingest", "refresh_incremental")


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in WARM:
        run(spark, name, sf_dir)
        times[name] = round(min(run(spark, name, sf_dir) for _ in range(2)), 3)
    for name in COLD:
        times[name] = round(run(spark, name, sf_dir), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total query time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()

"""Run registered queries and their SQL side by side: ``python -m checks.compare [name ...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb

from aqlake.session import build_session
from checks.oracle import ORACLE
from checks.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def sql_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    result = con.execute(sql)
    return [c[0] for c in result.description], result.fetchall()


def same_rows(names: list[str], rows: list[tuple], sql_names: list[str], sql_result: list[tuple]) -> str:
    """Empty if both hold the same rows (any order), else what differs."""
    if sorted(names) != sorted(sql_names):
        return f"columns {sorted(names)} != {sorted(sql_names)}"
    order = [sql_names.index(n) for n in names]
    expected = sorted(repr(tuple(r[i] for i in order)) for r in sql_result)
    found = sorted(map(repr, rows))
    if expected == found:
        return ""
    missing, extra = list(set(expected) - set(found)), list(set(found) - set(expected))
    return f"{len(found)} rows, expected {len(expected)}; missing {missing[:2]}, extra {extra[:2]}"


def main(wanted: list[str]) -> int:
    sf_dir = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    spark = build_session(
        "compare",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in wanted or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            difference = same_rows(df.columns, rows, *sql_rows(ORACLE[name], sf_dir)) if name in ORACLE else "no SQL"
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            difference = f"{type(error).__name__}: {str(error)[:1500]}"
            rows = []
        failed += bool(difference)
        print(f"{name:22} {len(rows):7} rows {time.time() - start:6.2f}s  {difference or 'same'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)

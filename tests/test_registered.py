"""Every registered query against its SQL at the smallest scale."""

import os
import shutil
import subprocess
import sys

import pytest

from checks.compare import same_rows, sql_rows
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_same_as_sql(spark, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    assert same_rows(df.columns, rows, *sql_rows(ORACLE[name], SF)) == ""


@pytest.mark.parametrize("name", ["calendar", "envelope", "record_ts_first", "wide_from_documents", "date_dim"])
def test_same_in_another_session_zone(spark, conf, name):
    conf(spark__sql__session__timeZone="Europe/Warsaw")
    test_same_as_sql(spark, name)


def test_entry(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).count() > 0
    assert set(QUERIES) <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("removed", [("aqlake/llm",), ("aqlake/llm", "corpus_pipeline.py")])
def test_imports_without_the_training_data_operators(tmp_path, removed):
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for name in ("aqlake", "checks", "__spark_entry__.py", "corpus_pipeline.py"):
        if os.path.isdir(f"{top}/{name}"):
            shutil.copytree(f"{top}/{name}", tmp_path / name, ignore=shutil.ignore_patterns("__pycache__", "llm"))
        elif name not in removed and os.path.exists(f"{top}/{name}"):
            shutil.copy(f"{top}/{name}", tmp_path)
    ask = "import __spark_entry__ as d; from checks.queries import QUERIES; assert set(d.queries()) == set(d.oracle_sql()) == set(QUERIES)"
    subprocess.run([sys.executable, "-c", ask], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": ""})

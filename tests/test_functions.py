import datetime as dt

import pytest
from pyspark.sql import functions as F

from aqlake.functions import (
    argmax_label,
    calendar_parts,
    coord_prefix,
    epoch_to_ntz,
    field,
    local_stamp,
    prominent_pollutant,
    register_functions,
    surrogate_key,
)
from aqlake.operators.serve import run_sql

SEVEN = "no double, no2 double, o3 double, so2 double, pm2_5 double, pm10 double, nh3 double"
CASES = [
    ((1.0, 2.0, 3.0, 4.0, 5.0, 9.0, 6.0), "PM10"),
    ((9.0, 2.0, 3.0, 4.0, 5.0, 9.0, 6.0), "NO"),  # tie: first declared
    ((None, 2.0, 3.0, None, 1.0, 1.0, 1.0), "O3"),  # NULLs are passed over
    ((None,) * 7, None),
    ((0.0,) * 7, "NO"),
]


def labels(spark):
    rows = spark.createDataFrame([(i, *values) for i, (values, _) in enumerate(CASES)], f"i int, {SEVEN}")
    return rows.withColumn("co", F.lit(1e6))


def test_prominent_pollutant(spark):
    found = labels(spark).orderBy("i").select(prominent_pollutant().alias("p")).collect()
    assert [r.p for r in found] == [label for _, label in CASES]  # CO is far above and never named


def test_prominent_index_in_sql(spark):
    register_functions(spark)
    query = "SELECT prominent_index(no, no2, o3, so2, pm2_5, pm10, nh3) AS p FROM {rows} WHERE i >= :low ORDER BY i"
    found = run_sql(spark, query, {"low": 1}, rows=labels(spark))
    assert [r.p for r in found.collect()] == [label for _, label in CASES[1:]]
    assert "Python" not in found._jdf.queryExecution().toString()


def test_argmax_label_of_one_column(spark):
    rows = spark.createDataFrame([(1.0,), (None,)], "a double")
    assert [r[0] for r in rows.select(argmax_label({"a": "A"})).collect()] == ["A", None]


@pytest.mark.parametrize("zone", ["UTC", "Europe/Warsaw", "America/New_York"])
def test_epoch_at_the_autumn_clock_change(spark, conf, zone):
    conf(spark__sql__session__timeZone=zone)
    rows = spark.createDataFrame([(1729989000,), (1729992600,), (-1,), (10**15,), (None,)], "s bigint")
    found = [r.t for r in rows.select(epoch_to_ntz(F.col("s")).alias("t")).collect()]
    assert found == [
        dt.datetime(2024, 10, 27, 0, 30),
        dt.datetime(2024, 10, 27, 1, 30),
        dt.datetime(1969, 12, 31, 23, 59, 59),
        None,
        None,
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_local_stamp_and_calendar(spark, conf, zone):
    conf(spark__sql__session__timeZone=zone)
    rows = spark.sql("SELECT timestamp_ntz'2024-06-30 23:15:00' AS t")
    row = rows.select(local_stamp(F.col("t")).alias("s"), *calendar_parts("t")).first()
    assert row.s == "2024-07-01T01-15"
    assert (row.meas_year, row.meas_quarter, row.meas_month, row.meas_day, row.meas_hour) == (2024, 2, 6, 30, 23)


def test_field(spark):
    doc = """{"deg": 2.7, "half": 2.5, "neg": -2.7, "null": null, "text": "x", "a": [{"b": 1}], "big": 5000000000}"""
    v = F.parse_json(F.lit(doc))
    paths = [
        ("$.deg", "int", 3), ("$.half", "int", 3), ("$.neg", "int", -3), ("$.deg", "double", 2.7),
        ("$.null", "double", None), ("$.missing", "double", None), ("$.text", "string", "x"),
        ("$.a[0].b", "int", 1), ("$.a[1].b", "int", None), ("$.big", "bigint", 5_000_000_000),
    ]
    row = spark.range(1).select(*[field(v, p, t).alias(f"c{i}") for i, (p, t, _) in enumerate(paths)]).first()
    assert list(row) == [expected for *_, expected in paths]


def test_field_of_wrong_type(spark):
    v = F.parse_json(F.lit('{"temp": "x"}'))
    assert spark.range(1).select(field(v, "$.temp", "double", strict=False)).first()[0] is None
    assert spark.range(1).select(field(v, "$.temp", "int", strict=False)).first()[0] is None
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        spark.range(1).select(field(v, "$.temp", "double")).collect()


def test_surrogate_key_skips_nulls(spark):
    rows = spark.createDataFrame([(1.5, None), (None, 1.5), (1.5, 2.0), (2.0, 1.5)], "a double, b double")
    keys = [r[0] for r in rows.select(surrogate_key("a", "b")).collect()]
    assert keys[0] == keys[1]  # documented: use it on non-null columns
    assert len(set(keys[1:])) == 3


def test_coord_prefix(spark):
    cases = {
        52.22977: "52.22", 51.1: "51.1", 51.104: "51.10", -0.12345: "-0.12", 20.0: "20.0",
        0.00051: "0.000", 0.0001: "0.000", 0.0: "0.", -0.0004: "-0.00", 12345678.5: "12345", 1e30: None, None: None,
    }
    rows = spark.createDataFrame([(x,) for x in cases], "x double")
    assert [r[0] for r in rows.select(coord_prefix("x")).collect()] == list(cases.values())

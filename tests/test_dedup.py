import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from aqlake.feeds import POLLUTION
from aqlake.operators.dedup import latest_per_key
from aqlake.plans.conditions import curate
from tests import shapes

FIRST, LATER = "2024-01-01 01:00:00", "2024-01-01 02:00:00"


def delivered(spark, *times):
    return shapes.staging(
        spark,
        POLLUTION,
        *[(at, shapes.document(shapes.pollution_element(1.0, 1.0, aqi=i))) for i, at in enumerate(times)],
    )


def test_later_delivery_replaces(spark):
    assert [r.aqi for r in curate(delivered(spark, FIRST, LATER), POLLUTION).collect()] == [1]


def test_tie_keeps_both_or_one(spark):
    staged = delivered(spark, FIRST, FIRST)
    assert latest_per_key(staged, ["record_ts"], "ingestion_ts").count() == 2
    one = latest_per_key(staged, ["record_ts"], "ingestion_ts", ties="one", tie_break=["source_filename"])
    assert [r.source_filename for r in one.collect()] == ["f1"]


def test_curate_one_of_a_tie(spark):
    staged = delivered(spark, FIRST, LATER, LATER)
    assert sorted(r.aqi for r in curate(staged, POLLUTION).collect()) == [1, 2]
    assert [r.aqi for r in curate(staged, POLLUTION, ties="one").collect()] == [2]


def test_arguments(spark):
    rows = spark.range(1)
    with pytest.raises(ValueError):
        latest_per_key(rows, ["id"], "id", ties="some")
    with pytest.raises(ValueError):
        latest_per_key(rows, ["id"], "id", ties="one")


@pytest.mark.parametrize("seed", range(3))
def test_same_as_rank_window(spark, seed):
    pick = random.Random(seed)
    data = [
        (i, pick.choice([None, 1, 2, 3]), pick.choice([None, "a", "b"]), pick.choice([None, 1.0, 2.0, 3.0]))
        for i in range(200)
    ]
    rows = spark.createDataFrame(data, "i int, k int, l string, v double")
    window = Window.partitionBy("k", "l").orderBy(F.desc_nulls_first("v"))
    expected = rows.withColumn("r", F.rank().over(window)).where("r = 1").drop("r")
    assert sorted(map(repr, latest_per_key(rows, ["k", "l"], "v").collect())) == sorted(map(repr, expected.collect()))
    window = Window.partitionBy("k", "l").orderBy(F.desc_nulls_first("v"), F.desc("i"))
    expected = rows.withColumn("r", F.row_number().over(window)).where("r = 1").drop("r")
    one = latest_per_key(rows, ["k", "l"], "v", ties="one", tie_break=["i"])
    assert sorted(map(repr, one.collect())) == sorted(map(repr, expected.collect()))

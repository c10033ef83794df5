import datetime as dt

import pytest

from aqlake.feeds import POLLUTION, WEATHER
from aqlake.operators import serve
from aqlake.operators.joins import attach_register, unmatched_counts
from aqlake.operators.star import day_agg, star_join
from aqlake.plans.conditions import build_star, conditions_wide, curate
from aqlake.sources import schemas
from tests import shapes

AT = "2024-01-01 01:00:00"
REGISTER_ROWS = (("Warszawa", *shapes.WARSAW, 1702139), ("Warszawa-Śródmieście", *shapes.CENTRE, 134306))


def feeds(spark, points, dts=(shapes.HOUR,), weather_shift=0):
    pollution = shapes.staging(
        spark, POLLUTION,
        *[(AT, shapes.document(*[shapes.pollution_element(*p, dt=d, aqi=i + 1, co=float(i)) for i, p in enumerate(points)])) for d in dts],
    )
    weather = shapes.staging(
        spark, WEATHER,
        *[(AT, shapes.document(*[shapes.weather_element(*p, dt=d + weather_shift) for p in points])) for d in dts],
    )
    return curate(pollution, POLLUTION), curate(weather, WEATHER)


@pytest.mark.parametrize(("mode", "wide_rows", "places", "star_rows"), [("prefix", 4, 4, 8), ("exact", 2, 2, 2)])
def test_colliding_prefixes_fan_out(spark, mode, wide_rows, places, star_rows):
    wide = conditions_wide(*feeds(spark, [shapes.WARSAW, shapes.CENTRE]), shapes.register(spark, *REGISTER_ROWS), mode)
    star = build_star(wide)
    assert wide.count() == wide_rows
    assert star.locations.count() == places
    assert star.locations.select("location_pk").distinct().count() == 2
    assert star_join(*star).count() == star_rows


def test_schemas(spark):
    wide = conditions_wide(*feeds(spark, [shapes.WARSAW]), shapes.register(spark, *REGISTER_ROWS))
    star = build_star(wide)
    for df, schema in (
        (wide, schemas.WIDE), (star.fact, schemas.FACT), (star.locations, schemas.LOCATION_DIM),
        (star.dates, schemas.DATE_DIM), (day_agg(*star), schemas.DAY_AGG),
    ):
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schema]


def test_unmatched_place_is_kept(spark):
    wide = conditions_wide(*feeds(spark, [(10.0, 10.0)]), shapes.register(spark, *REGISTER_ROWS))
    assert [(r.city, r.population, r.lat) for r in wide.collect()] == [(None, None, 10.0)]
    assert build_star(wide).locations.count() == 1
    assert serve.city_list(day_agg(*build_star(wide))).first().city is None


def test_unknown_match_mode(spark):
    register = shapes.register(spark, *REGISTER_ROWS)
    with pytest.raises(ValueError):
        attach_register(register.select("lat", "lon"), register, coord_match="near")


def test_feeds_a_second_apart_do_not_meet(spark):
    pollution, weather = feeds(spark, [shapes.WARSAW, (1.0, 1.0)], weather_shift=1)
    assert conditions_wide(pollution, weather, shapes.register(spark, *REGISTER_ROWS)).count() == 0
    report = {r.record_ts: (r.left_unmatched, r.right_unmatched) for r in unmatched_counts(pollution, weather).collect()}
    assert report == {dt.datetime(2024, 1, 1): (2, 0), dt.datetime(2024, 1, 1, 0, 0, 1): (0, 2)}


def test_unmatched_counts_null_keys_and_repeats(spark):
    left = spark.createDataFrame([(1, 1), (1, 1), (1, None), (2, 5), (2, 5)], "t int, k int")
    right = spark.createDataFrame([(1, 1), (1, None), (3, 5)], "t int, k int")
    report = unmatched_counts(left, right, on=["t", "k"], by=["t"]).collect()
    assert {r.t: (r.left_unmatched, r.right_unmatched) for r in report} == {1: (1, 1), 2: (2, 0), 3: (0, 1)}


HOURS = (shapes.HOUR, shapes.HOUR + 3600, shapes.HOUR + 86400)


@pytest.fixture(scope="module")
def served(spark):
    star = build_star(
        conditions_wide(*feeds(spark, [shapes.WARSAW, (1.0, 1.0)], dts=HOURS),
                        shapes.register(spark, REGISTER_ROWS[0], ("Else", 1.0, 1.0, 5)))
    )
    return star, day_agg(*star)


def test_lists(served):
    _, averages = served
    assert [r.city for r in serve.city_list(averages).collect()] == ["Warszawa", "Else"]
    assert [r.measurement_date.day for r in serve.date_list(averages, "Else").collect()] == [2, 1]


def test_series(served):
    _, averages = served
    rows = serve.series_all(averages, "Else", "2024-01-01")
    assert rows.columns == ["Hour", "CO", "NO", "NO2", "O3", "SO2", "PM2_5", "PM10", "NH3"]
    assert [(r.Hour, r.CO, r.NO) for r in rows.collect()] == [(0, 1.0, 1.0), (1, 1.0, 1.0)]
    one = serve.series_one(averages, "Else", dt.date(2024, 1, 2), "co")
    assert one.columns == ["Hour", "CO"] and [tuple(r) for r in one.collect()] == [(0, 1.0)]
    weather = serve.series_weather(averages, "Warszawa", "2024-01-02")
    assert weather.columns == ["Hour", "AQI", "Temp", "WindSpeed"]
    assert [tuple(r) for r in weather.collect()] == [(0, 1.0, 3.5, 2.5)]


def test_values_are_not_pasted_into_sql(served):
    _, averages = served
    assert serve.series_all(averages, "x' OR '1'='1", "2024-01-01").count() == 0
    with pytest.raises(ValueError):
        serve.series_one(averages, "Else", "2024-01-01", "co_avg, city")


def test_maps(served):
    star, _ = served
    snapshot = serve.latest_snapshot(*star).collect()
    assert sorted((r.lat, r.aqi) for r in snapshot) == [(1.0, 2), (shapes.WARSAW[0], 1)]
    assert serve.city_points(star.fact, star.locations, "Else").count() == 3
    assert serve.city_points(star.fact, star.locations, "Else", distinct=True).count() == 1

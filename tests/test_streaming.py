import bz2
import datetime as dt
import gzip
import hashlib
import itertools
import os
import time

import pyarrow.parquet as pq
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from aqlake.feeds import POLLUTION, WEATHER
from aqlake.operators import serve
from aqlake.plans.conditions import curate
from aqlake.plans.refresh import (
    drop_outdated, read_current, read_date_dim, read_day_agg, read_location_dim, read_rejected, refresh,
)
from aqlake.plans.views import create_views
from aqlake.sources import schemas
from aqlake.streaming.catch_up import Lake, catch_up
from aqlake.streaming.ingest import ingest, read_quarantine, read_staging
from tests import shapes

DAY = 86400
PLACE = (1.0, 1.0)


class Site:
    """Landing folder and lake of one test."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.lake = spark, folder, Lake(str(folder / "lake"))
        self.derived = self.lake.derived
        self.names = itertools.count()
        self.places = [("A", *PLACE, 10)]
        for feed in (POLLUTION, WEATHER):
            (folder / "landing" / feed.name).mkdir(parents=True)

    def land(self, feed, *bodies):
        for body in bodies:
            shapes.write_file(self.folder / "landing" / feed.name, f"{next(self.names):03d}.json", body)

    def land_both(self, *dts, place=PLACE, aqi=2, temp=3.5):
        self.land(POLLUTION, *[shapes.document(shapes.pollution_element(*place, dt=d, aqi=aqi)) for d in dts])
        self.land(WEATHER, *[shapes.document(shapes.weather_element(*place, dt=d, temp=temp)) for d in dts])

    def ingest(self, feed, **options):
        query = ingest(
            self.spark, str(self.folder / "landing" / feed.name), feed, self.lake.staging(feed),
            self.lake.checkpoint(feed.name), **options,
        )
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress)

    def staging(self, feed):
        return read_staging(self.spark, self.lake.staging(feed))

    def register(self):
        return shapes.register(self.spark, *self.places)

    def run(self):
        catch_up(self.spark, str(self.folder / "landing"), self.lake, self.register)

    def full(self, root=None):
        root = root or str(self.folder / "full")
        refresh(self.spark, self.lake.staging(POLLUTION), self.lake.staging(WEATHER), self.register(), root)
        return root

    def read(self, table, root=None):
        return read_current(self.spark, root or self.derived, table)

    def rows(self, table, root=None):
        return sorted(map(repr, self.read(table, root).collect()))


@pytest.fixture
def site(spark, tmp_path):
    return Site(spark, tmp_path)


def test_each_file_is_taken_once(site):
    site.land_both(shapes.HOUR, shapes.HOUR + 3600)
    assert site.ingest(POLLUTION) == 2
    assert site.ingest(POLLUTION) == 0
    site.land(POLLUTION, shapes.document(shapes.pollution_element(*PLACE, dt=shapes.HOUR)))
    assert site.ingest(POLLUTION) == 1
    staged = site.staging(POLLUTION)
    assert [(f.name, f.dataType) for f in staged.schema] == [(f.name, f.dataType) for f in schemas.STAGING]
    rows = staged.collect()
    assert len({r.id for r in rows}) == 3 and len({r.ingestion_ts for r in rows}) == 2
    assert len({r.stg_file_md5 for r in rows}) == 2  # the redelivered body is byte for byte the same


def test_small_batches_and_archive(site):
    site.land_both(*[shapes.HOUR + 3600 * i for i in range(5)])
    assert site.ingest(WEATHER, max_files=2, archive_path=str(site.folder / "archive")) == 5
    assert site.staging(WEATHER).count() == 5


def test_a_micro_batch_takes_few_jobs_and_accounts_for_all_files(site):
    site.land(WEATHER, *[shapes.document(shapes.weather_element(*PLACE, dt=shapes.HOUR + 86400 * i)) for i in range(8)], "no json")
    shapes.write_file(site.folder / "landing" / "weather", "zz.json.gz", b"no gzip")
    staging = site.lake.staging(WEATHER)
    query = ingest(site.spark, str(site.folder / "landing" / "weather"), WEATHER, staging, site.lake.checkpoint("weather"), max_files=1)
    query.awaitTermination()
    batches = sum(1 for p in query.recentProgress if p["numInputRows"])
    jobs = site.spark.sparkContext.statusTracker().getJobIdsForGroup(str(query.runId))
    # names, documents and days; the first batch looks at the folder and the last writes a file without documents
    assert batches == 10 and len(jobs) <= 3 * batches + 12
    assert site.staging(WEATHER).count() == 8
    reasons = sorted(r.reason for r in read_quarantine(site.spark, staging).collect())
    assert reasons == ["no document", "unreadable file"]
    days = site.spark.read.parquet(f"{staging}-days").groupBy("batch").count().collect()
    assert [r["count"] for r in days] == [1] * 8


def test_a_small_micro_batch_takes_two_jobs_and_a_file_a_day(site):
    hours = [shapes.HOUR + 3600 * i for i in range(24)]
    site.land(WEATHER, *[shapes.document(shapes.weather_element(*PLACE, dt=h)) for h in hours])
    staging, landing = site.lake.staging(WEATHER), str(site.folder / "landing" / "weather")

    def run():
        query = ingest(site.spark, landing, WEATHER, staging, site.lake.checkpoint("weather"), max_files=2)
        query.awaitTermination()
        return len(site.spark.sparkContext.statusTracker().getJobIdsForGroup(str(query.runId)))

    def lists():
        return {file.name for file in (site.folder / "lake").glob("staging_weather-days/batch=*/*.parquet")}

    assert run() <= 2 * 12 + 11  # names and documents; the first batch looks at the folder
    assert site.staging(WEATHER).count() == 24 and len(site.staging(WEATHER).inputFiles()) == 12
    days = site.spark.read.schema("record_date date, batch string").parquet(f"{staging}-days").collect()
    assert len(days) == 12 and {r.record_date for r in days} == {dt.date(2024, 1, 1)}
    before = lists()
    commits = site.folder / "lake" / "checkpoints" / "weather" / "commits"
    for commit in commits.glob("*11*"):  # as if the run had died before its last batch was done
        commit.unlink()
    run()
    # a stream passes over a file it has seen, so the batch's list has a new name
    assert len(lists()) == 12 and len(lists() - before) == 1 and site.staging(WEATHER).count() == 24


def test_unloadable_documents_are_quarantined(site):
    good = shapes.document(shapes.weather_element(*PLACE))
    site.land(WEATHER, '{"results": []}', "no json", b"\xff\xfe\x00{", good, b"", " \n", f"{good}\n{{")
    shapes.write_file(site.folder / "landing" / "weather", "x [1]*{a}?.json.gz", b"no gzip")
    site.ingest(WEATHER)
    staged, bad = site.staging(WEATHER), read_quarantine(site.spark, site.lake.staging(WEATHER))
    assert sorted((r.source_filename.rsplit("/", 1)[1], r.reason) for r in bad.collect()) == [
        ("000.json", "no time"), ("001.json", "no document"), ("002.json", "no document"), ("004.json", "empty file"),
        ("005.json", "no document"), ("006.json", "no document"), ("x [1]*{a}?.json.gz", "unreadable file"),
    ]
    assert staged.count() == 2 and staged.where("reason IS NOT NULL").count() == 0
    assert staged.unionAll(bad).select("id").distinct().count() == 9
    # every file is accounted for, also by the next run
    site.land(WEATHER, good, b"")
    site.ingest(WEATHER)
    landed = site.staging(WEATHER).unionAll(read_quarantine(site.spark, site.lake.staging(WEATHER)))
    assert landed.select("source_filename").distinct().count() == 10 and landed.count() == 11
    md5 = {r.source_filename[-8:]: r.stg_file_md5 for r in site.staging(WEATHER).collect()}
    assert md5["003.json"] == md5["007.json"] == hashlib.md5(good.encode()).hexdigest()


def test_a_batch_that_runs_again_doubles_nothing(site):
    site.land(WEATHER, shapes.document(shapes.weather_element(*PLACE)), b"", "no json")
    site.ingest(WEATHER)
    ids = sorted(r.id for r in site.staging(WEATHER).collect())
    commits = site.folder / "lake" / "checkpoints" / "weather" / "commits"
    for commit in commits.iterdir():  # as if the run had died before it was done
        commit.unlink()
    assert site.ingest(WEATHER) == 2  # no scan shows the empty file
    assert sorted(r.id for r in site.staging(WEATHER).collect()) == ids
    assert read_quarantine(site.spark, site.lake.staging(WEATHER)).count() == 2


def test_another_checkpoint_keeps_what_was_staged(site):
    site.land(WEATHER, shapes.document(shapes.weather_element(*PLACE)))
    site.ingest(WEATHER)
    query = ingest(site.spark, str(site.folder / "landing" / "weather"), WEATHER, site.lake.staging(WEATHER), str(site.folder / "other"))
    query.awaitTermination()
    assert site.staging(WEATHER).count() == 2
    assert curate(site.staging(WEATHER), WEATHER).count() == 1


def test_compressed_files_and_byte_order_marks(site):
    body = shapes.document(shapes.weather_element(*PLACE, name="Łódź")).encode()
    folder = site.folder / "landing" / "weather" / "Łódź +1 %"
    for name, content in (
        ("a.json", body), ("b.json.gz", gzip.compress(body)), ("c.json.bz2", bz2.compress(body)),
        ("d.json", b"\xef\xbb\xbf" + body),
    ):
        shapes.write_file(folder, name, content)
    site.ingest(WEATHER)
    rows = curate(site.staging(WEATHER), WEATHER).collect()
    assert [r.city for r in rows] == ["Łódź"] * 4
    assert {r.source_filename.split("/weather/")[1] for r in rows} == {
        f"Łódź +1 %/{name}" for name in ("a.json", "b.json.gz", "c.json.bz2", "d.json")
    }


def check_against_full(site):
    full = site.full()
    for table in ("wide", "conditions_fact", "day_agg", "dates", "locations"):
        assert site.rows(table) == site.rows(table, full), table


def test_later_delivery_refreshes_its_day(site):
    site.land_both(shapes.HOUR, shapes.HOUR + DAY)
    site.run()
    assert site.read("day_agg").count() == 2
    site.land_both(shapes.HOUR, aqi=5, temp=9.0)
    site.run()
    check_against_full(site)
    averages = read_day_agg(site.spark, site.derived)
    assert [tuple(r) for r in serve.series_weather(averages, "A", "2024-01-01").collect()] == [(0, 5.0, 9.0, 2.5)]
    assert [tuple(r) for r in serve.series_weather(averages, "A", "2024-01-02").collect()] == [(0, 2.0, 3.5, 2.5)]


def test_nothing_landed_refreshes_nothing(site):
    site.land_both(shapes.HOUR)
    site.run()
    before = site.rows("wide")
    site.run()
    assert site.rows("wide") == before
    assert len(list((site.folder / "lake" / "derived" / "wide").glob("version=*"))) == 1


def test_emptied_day_becomes_empty(site):
    site.land_both(shapes.HOUR, shapes.HOUR + DAY)
    site.run()
    # The only weather of the first day is replaced by that of another place.
    site.land(WEATHER, shapes.document(shapes.weather_element(5.0, 5.0, dt=shapes.HOUR)))
    site.run()
    check_against_full(site)
    assert [r.record_date.day for r in site.read("wide").collect()] == [2]
    assert read_date_dim(site.spark, site.derived).count() == 1


def test_feeds_may_arrive_apart(site):
    site.land(POLLUTION, shapes.document(shapes.pollution_element(*PLACE)))
    site.land(WEATHER, shapes.document(shapes.weather_element(*PLACE, dt=shapes.HOUR + DAY)))
    site.run()
    assert site.rows("wide") == []
    site.land(WEATHER, shapes.document(shapes.weather_element(*PLACE)))
    site.run()
    check_against_full(site)
    assert len(site.rows("wide")) == 1


def test_register_change_needs_full_refresh(site):
    site.land_both(shapes.HOUR, shapes.HOUR + DAY)
    site.run()
    site.places = [("A", *PLACE, 11), ("B", *PLACE, 12)]
    site.full(site.derived)
    check_against_full(site)
    locations = read_location_dim(site.spark, site.derived)
    assert sorted((r.city, r.population) for r in locations.collect()) == [("A", 11), ("B", 12)]
    star = (
        site.read("conditions_fact"),
        locations,
        read_date_dim(site.spark, site.derived),
    )
    assert serve.latest_snapshot(*star).count() == 4  # two fact rows, each with two places


def test_half_done_refresh_is_invisible(site):
    site.land_both(shapes.HOUR)
    site.run()
    before = site.rows("wide")
    lost = site.folder / "lake" / "derived" / "wide" / "version=2" / "record_date=2024-01-01"
    site.read("wide").drop("record_date").write.parquet(str(lost))
    stale = site.spark.createDataFrame([(*PLACE, "A", 99, "prefix")], "lat double, lon double, city string, population int, coord_match string")
    stale.write.parquet(str(site.folder / "lake" / "derived" / "register" / "version=2"))
    assert site.rows("wide") == before
    site.land_both(shapes.HOUR, aqi=4)
    site.run()
    check_against_full(site)
    site.run()  # the register that was left half-way is not taken for the one in force
    assert len(list((site.folder / "lake" / "derived" / "versions").glob("version=*"))) == 2


def test_thousands_of_days_with_a_version_each(spark, tmp_path, monkeypatch):
    first = dt.date(2010, 1, 1)
    days = [(first + dt.timedelta(days=i), i + 1) for i in range(5000)]
    listed = spark.createDataFrame(days, "record_date date, version bigint")
    monkeypatch.setattr("aqlake.plans.refresh._versions", lambda *_: listed)
    one = spark.range(1).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.LOCATION_DIM.fields))
    for version in (4999, 5000):
        one.write.parquet(f"{tmp_path}/locations/version={version}/record_date={days[-1][0]}")
    assert read_current(spark, str(tmp_path), "locations").count() == 1


def test_all_documents_of_a_file_are_taken(site):
    one, two = (shapes.document(shapes.pollution_element(*PLACE, dt=shapes.HOUR + h)) for h in (0, 3600))
    site.land(POLLUTION, one, f"{one}\n{two}", f"[{one}, {two}]", f"{one}\n{{")
    site.ingest(POLLUTION)
    rows = site.staging(POLLUTION).collect()
    assert len(rows) == 6 and len({r.id for r in rows}) == 6
    assert read_quarantine(site.spark, site.lake.staging(POLLUTION)).count() == 1


def test_a_register_change_refreshes_the_days_of_its_places(site):
    site.places = [("A", *PLACE, 10), ("B", 5.0, 5.0, 20)]
    site.land_both(shapes.HOUR, shapes.HOUR + DAY)
    site.land_both(shapes.HOUR + DAY + 3600, place=(5.0, 5.0))
    site.land_both(shapes.HOUR + 2 * DAY, place=(9.0, 9.0))
    site.run()
    documents = site.rows("curated_weather")
    site.places = [("A", *PLACE, 10), ("B", 5.0, 5.0, 21), ("C", 7.0, 7.0, 1)]
    site.run()  # no new documents
    check_against_full(site)
    assert site.rows("curated_weather") == documents
    stored = {
        t: sorted(p.parent.name[8:] + p.name[-2:] for p in (site.folder / "lake/derived" / t).glob("*/record_date=*"))
        for t in ("wide", "curated_weather")
    }
    # only the second day's tables were written again, and none of its documents read
    assert stored == {"wide": ["101", "102", "103", "202"], "curated_weather": ["101", "102", "103"]}
    site.run()
    assert len(list((site.folder / "lake/derived/versions").glob("version=*"))) == 2
    # the register and documents of another day change together
    site.places = [("A", *PLACE, 11), ("B", 5.0, 5.0, 21), ("D", 9.0, 9.0, 2)]
    site.land_both(shapes.HOUR + DAY, aqi=5)
    site.run()
    check_against_full(site)
    locations = read_location_dim(site.spark, site.derived).collect()
    assert sorted((r.city, r.population) for r in locations) == [("A", 11), ("B", 21), ("D", 2)]
    # outdated days go, but not the documents that a day still rests on
    assert drop_outdated(site.spark, site.derived, keep=0) > 0
    site.places = [("A", *PLACE, 12)]
    site.run()
    check_against_full(site)


def test_another_match_derives_all_days_again(site):
    site.places = [("A", 52.2297, 21.0117, 10)]
    site.land_both(shapes.HOUR, place=(52.2299, 21.0119))
    site.run()
    assert [r.city for r in site.read("wide").collect()] == ["A"]
    staged = (site.lake.staging(POLLUTION), site.lake.staging(WEATHER))
    refresh(site.spark, *staged, site.register(), site.derived, [], "exact")
    assert [r.city for r in site.read("wide").collect()] == [None]


def test_a_bad_value_does_not_stop_catch_up(site):
    site.land_both(shapes.HOUR)
    site.land(POLLUTION, shapes.document(shapes.pollution_element(*PLACE, dt=shapes.HOUR + DAY, aqi="bad", no="none")))
    site.land(WEATHER, shapes.document(shapes.weather_element(*PLACE, dt=shapes.HOUR + DAY)))
    site.run()
    assert sorted(r.aqi or 0 for r in site.read("wide").collect()) == [0, 2]
    rejected = read_rejected(site.spark, site.derived).collect()
    assert sorted((r.feed, r.column, r.path, r.value) for r in rejected) == [
        ("pollution", "aqi", "$.list[0].main.aqi", '"bad"'), ("pollution", "no", "$.list[0].components.no", '"none"'),
    ]
    assert {r.source_filename.rsplit("/", 1)[1] for r in rejected} == {"002.json"} and rejected[0].record_date.day == 2
    site.land_both(shapes.HOUR + DAY, aqi=4)  # corrected
    site.run()
    assert read_rejected(site.spark, site.derived).count() == 0
    check_against_full(site)


def test_a_feed_without_a_folder(site):
    (site.folder / "landing" / "weather").rmdir()
    site.land(POLLUTION, shapes.document(shapes.pollution_element(*PLACE)))
    site.run()
    assert site.rows("wide") == [] and len(site.rows("curated_pollution")) == 1
    site.land(WEATHER, shapes.document(shapes.weather_element(*PLACE)))
    site.run()
    assert len(site.rows("wide")) == 1


def test_one_failing_feed_does_not_keep_the_other_out(site):
    site.land_both(shapes.HOUR)
    (site.folder / "lake" / "staging_pollution").mkdir(parents=True)
    (site.folder / "lake" / "staging_pollution" / "record_date=2024-01-01").write_text("a file where a folder should be")
    with pytest.raises(StreamingQueryException):
        site.run()
    assert site.staging(WEATHER).count() == 1


def test_a_file_older_than_the_others_is_taken(site):
    site.land_both(shapes.HOUR)
    site.run()
    site.land_both(shapes.HOUR + DAY)
    old = time.time() - 20 * 86400
    for folder, _, files in os.walk(site.folder / "landing"):
        for name in files:
            os.utime(os.path.join(folder, name), (old, old))
    site.run()
    assert len(site.rows("wide")) == 2


def test_stored_partitions_are_pruned(site):
    site.land_both(shapes.HOUR, shapes.HOUR + DAY)
    site.run()
    site.land_both(shapes.HOUR, aqi=4)
    site.run()
    averages = read_day_agg(site.spark, site.derived)
    assert [(f.name, f.dataType) for f in averages.schema] == [(f.name, f.dataType) for f in schemas.DAY_AGG]
    picked = serve.series_weather(averages, "A", "2024-01-02")
    filters = picked._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1].split("PushedFilters")[0]
    # Day and version are both decided on the folders' names: replaced versions are not opened.
    assert "cast(version#" in filters and "(record_date#" in filters


def test_outdated_days_are_dropped(site):
    for aqi in range(3):
        site.land_both(shapes.HOUR, *[shapes.HOUR + DAY][:1 - aqi], aqi=aqi)
        site.run()
    before = {t: site.rows(t) for t in ("curated_weather", "wide", "conditions_fact", "day_agg", "dates", "locations")}
    assert drop_outdated(site.spark, site.derived, keep=1) == 7  # the first day's first version, of every table
    assert {t: site.rows(t) for t in before} == before
    stored = sorted(p.parent.name + "/" + p.name for p in (site.folder / "lake" / "derived" / "wide").glob("*/record_date=*"))
    assert stored == [
        "version=1/record_date=2024-01-02", "version=2/record_date=2024-01-01", "version=3/record_date=2024-01-01",
    ]


def test_sql_views(site):
    site.land_both(shapes.HOUR, shapes.HOUR + DAY)
    site.run()
    names = create_views(
        site.spark, site.derived, site.lake.staging(POLLUTION), site.lake.staging(WEATHER), site.register()
    )
    expected = {
        "final_conditions_wide": schemas.WIDE, "conditions_fact": schemas.FACT, "date_dim": schemas.DATE_DIM,
        "location_dim": schemas.LOCATION_DIM, "conditions_fact_day_agg": schemas.DAY_AGG,
        "curated_pollution": schemas.curated(POLLUTION), "curated_weather": schemas.curated(WEATHER),
        "cities_pop": schemas.REGISTER,
    }
    for name, schema in expected.items():
        assert site.spark.table(name).schema.names == schema.names
        assert site.spark.table(name).count() > 0
    assert set(names) == {*expected, "staging_pollution", "staging_weather", "rejected_values"}
    assert site.spark.table("rejected_values").count() == 0
    labels = site.spark.sql("SELECT DISTINCT prominent_index(no, no2, o3, so2, pm2_5, pm10, nh3) FROM conditions_fact")
    assert [r[0] for r in labels.collect()] == ["NO"]


def test_one_feed_without_any_file(site):
    site.land(POLLUTION, shapes.document(shapes.pollution_element(*PLACE)))
    site.run()
    assert site.rows("wide") == [] and len(site.rows("curated_pollution")) == 1
    site.land(WEATHER, shapes.document(shapes.weather_element(*PLACE)))
    site.run()
    assert len(site.rows("wide")) == 1


def test_documents_are_stored_whole(site, conf):
    """Parts of a document get no columns of their own: it is always read whole."""
    shredding = "spark.sql.variant.inferShreddingSchema"
    conf(**{shredding.replace(".", "__"): "true"})
    site.spark.conf.unset(shredding)  # as in a session that the library has not built
    site.land_both(0, DAY)
    site.ingest(POLLUTION)
    stored = next((site.folder / "lake" / "staging_pollution").rglob("*.parquet"))
    document = pq.read_schema(stored).field("json_data").type
    assert sorted(document.field(i).name for i in range(document.num_fields)) == ["metadata", "value"]

import datetime as dt
import hashlib
import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from aqlake.feeds import POLLUTION, WEATHER
from aqlake.operators.dedup import latest_per_key
from aqlake.operators.deliveries import incomplete_deliveries, newest_deliveries
from aqlake.operators.envelope import FILE_BYTES, build_envelope, override_coords, read_manifest, write_documents
from aqlake.operators.flatten import flatten_results
from aqlake.operators.quality import split_not_null
from aqlake.plans.conditions import curate
from aqlake.session import materialize, scratch_path
from aqlake.sources import schemas
from aqlake.sources.documents import file_inventory, read_document_files, stage_documents
from aqlake.streaming.ingest import write_staging
from tests import shapes

MIDNIGHT = dt.datetime(2024, 1, 1)


def test_curated_schemas(spark):
    for feed, element in ((POLLUTION, shapes.pollution_element(1.0, 2.0)), (WEATHER, shapes.weather_element(1.0, 2.0))):
        rows = curate(shapes.staging(spark, feed, ("2024-01-01 01:00:00", shapes.document(element))), feed)
        assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in schemas.curated(feed)]
        assert rows.count() == 1


def test_weather_values(spark):
    row = curate(
        shapes.staging(spark, WEATHER, ("2024-01-01 01:00:00", shapes.document(shapes.weather_element(1.5, 2.5)))), WEATHER
    ).first()
    assert (row.location_id, row.city, row.lat, row.lon, row.weather_con) == (7, "x", 1.5, 2.5, "mist")
    assert (row.wind_deg, row.wind_speed, row.visibility, row.clouds, row.pressure) == (3, 2.5, 10000, 90, 1000.0)


def test_first_element_time_stands_for_all(spark):
    body = shapes.document(
        shapes.pollution_element(1.0, 1.0, dt=shapes.HOUR), shapes.pollution_element(2.0, 2.0, dt=shapes.HOUR + 59)
    )
    rows = curate(shapes.staging(spark, POLLUTION, ("2024-01-01 01:00:00", body)), POLLUTION).collect()
    assert [r.record_ts for r in rows] == [MIDNIGHT, MIDNIGHT]


def test_missing_and_null_fields(spark):
    element = shapes.pollution_element(1.0, 1.0, no=None)
    del element["list"][0]["components"]["nh3"]
    row = curate(shapes.staging(spark, POLLUTION, ("2024-01-01 01:00:00", shapes.document(element))), POLLUTION).first()
    assert row.no is None and row.nh3 is None and row.co == 1.0


def test_wrong_type_raises_unless_lenient(spark):
    staged = shapes.staging(
        spark, WEATHER, ("2024-01-01 01:00:00", shapes.document(shapes.weather_element(1.0, 1.0, temp="x")))
    )
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        curate(staged, WEATHER).collect()
    assert curate(staged, WEATHER, strict=False).first().temp is None


def test_quarantine(spark):
    ok = shapes.document(shapes.weather_element(1.0, 1.0))
    bodies = [ok, '{"results": []}', "{}", "not json", "", "[1]", '{"results": [{"dt": "noon"}]}', '{"results": [{"dt": 1e300}]}']
    good, bad = split_not_null(stage_documents(shapes.files(spark, *bodies), WEATHER), "record_ts")
    assert good.count() == 1 and bad.count() == len(bodies) - 1
    assert flatten_results(bad.where("json_data IS NOT NULL").limit(2), WEATHER.fields).count() >= 0
    empties = stage_documents(shapes.files(spark, '{"results": []}', "{}"), WEATHER)
    assert flatten_results(empties, WEATHER.fields).count() == 0


def test_staging_ids_are_stable(spark):
    files = shapes.files(spark, shapes.document(shapes.weather_element(1.0, 1.0)), "{}")
    first, second = (stage_documents(files, WEATHER).select("id", "stg_file_md5") for _ in range(2))
    assert sorted(first.collect()) == sorted(second.collect())
    assert first.distinct().count() == 2


def test_reply_coordinates_are_replaced(spark):
    replies = spark.sql(
        "SELECT * FROM VALUES (1, named_struct('lat', 50.0D, 'lon', 20.0D)), (2, NULL), "
        "(3, named_struct('lat', 1.0D, 'lon', 1.0D)) AS r(place, coord)"
    )
    places = spark.createDataFrame([(1, 50.01, 20.02), (2, 5.0, 5.0)], "id int, lat double, lon double")
    fixed = override_coords(replies, places, "place", "id").collect()
    assert [(r.place, tuple(r.coord)) for r in fixed] == [(1, (50.01, 20.02))]


def records(spark, n, runs=1):
    """``n`` records per run, the first one a minute before the others."""
    return spark.range(n * runs).select(
        (F.col("id") % runs).alias("run"),
        F.floor(F.col("id") / runs).alias("place"),
        F.concat(F.lit("Łódź "), F.col("id").cast("string")).alias("name"),
        F.when(F.col("id") == 0, F.col("id")).alias("maybe"),
        F.when(F.col("id") < runs, shapes.HOUR).otherwise(shapes.HOUR + 60).cast("bigint").alias("dt"),
    )


ELEMENT_FIELDS = (("place", "$.place", "bigint"), ("name", "$.name", "string"), ("maybe", "$.maybe", "bigint"))


def envelope(rows, **options):
    return build_envelope(
        rows, ["run"], F.struct("place", "name", "maybe", "dt"), F.col("dt"), ["place"], **options
    )


def test_build_then_flatten_returns_the_input(spark):
    rows = records(spark, 50, runs=3)
    documents = envelope(rows)
    assert documents.count() == 3
    back = flatten_results(
        documents.withColumn("json_data", F.parse_json("document")), ELEMENT_FIELDS, before=["run"], after=[]
    )
    assert sorted(map(repr, back.collect())) == sorted(map(repr, rows.select("run", "place", "name", "maybe").collect()))


def test_envelope_order_nulls_and_text(spark):
    body = envelope(records(spark, 20), pretty=True).first().document
    results = json.loads(body)["results"]
    assert [r["place"] for r in results] == list(range(20))
    assert results[1]["maybe"] is None and "Łódź" in body and "\n" in body


def test_hot_run_is_split_without_loss(spark):
    rows = records(spark, 1000).unionByName(records(spark, 5).withColumn("run", F.lit(9).cast("bigint")))
    documents = envelope(rows, max_elements=100)
    sizes = {(r.run, r.part): r.n_elements for r in documents.collect()}
    assert sum(n for (run, _), n in sizes.items() if run == 0) == 1000
    assert len(sizes) == 11 and max(sizes.values()) < 200 and [n for (run, _), n in sizes.items() if run == 9] == [5]
    # every document looks alike, however many there are
    bodies = [json.loads(r.document) for r in documents.collect()]
    assert {tuple(b) for b in bodies} == {("delivery", "dt", "part", "parts", "results")}
    assert {b["parts"] for b in bodies} == {1, 10} and len({b["delivery"] for b in bodies}) == 1
    files = documents.select(
        F.concat_ws("-", "run", "part").alias("path"), F.col("document").alias("content")
    )
    staged = stage_documents(files, WEATHER)
    # Every part has the time of the run's first record, so none looks like a run of its own.
    assert {r.record_ts for r in staged.collect()} == {MIDNIGHT}
    stored = materialize(staged, "staged")
    # Both runs have one time here: of the large one a part is missing, of the small one none.
    assert newest_deliveries(stored.where("source_filename NOT LIKE '0-1'")).count() == 0
    kept = latest_per_key(staged, ["record_ts"], "ingestion_ts")
    flat = flatten_results(kept, ELEMENT_FIELDS, before=["record_ts"])
    assert flat.count() == 1005 and flat.where("source_filename LIKE '0-%'").select("place").distinct().count() == 1000


def test_copies_of_one_record_are_spread(spark):
    rows = records(spark, 10).unionByName(records(spark, 1).crossJoin(spark.range(990)).drop("id"))
    documents = envelope(rows, max_elements=100)
    sizes = [r.n_elements for r in documents.collect()]
    assert sum(sizes) == 1000 and max(sizes) <= 300
    back = flatten_results(
        documents.withColumn("json_data", F.parse_json("document")), ELEMENT_FIELDS, before=["run"], after=[]
    )
    assert sorted(map(repr, back.collect())) == sorted(map(repr, rows.select("run", "place", "name", "maybe").collect()))


def test_written_documents(spark):
    root = scratch_path(spark, "raw")
    documents = spark.sql(
        "SELECT timestamp_ntz'2024-07-01 10:05:00' + make_interval(0, 0, 0, 0, 0, 0, s) AS run, 0 AS part, "
        "concat('{\"results\": [\n {\"dt\": ', s, ', \"name\": \"Łódź\"}]}') AS document "
        "FROM VALUES (0), (30), (90000), (600) AS t(s)"
    )
    write_documents(documents, WEATHER, "run", root)
    write_documents(documents.where("run > timestamp_ntz'2024-07-02 00:00:00'"), WEATHER, "run", root, per_file=1)
    listed = file_inventory(spark, f"{root}/weather")
    assert listed.columns == ["path", "length", "modificationTime"]
    assert listed.count() == 3  # a file for each day and sending
    held = read_manifest(spark, root, WEATHER).collect()
    assert sorted(r.name for r in held) == [
        "2024-07-01T12-05_weather_data.json", "2024-07-01T12-05_weather_data.json",
        "2024-07-01T12-15_weather_data.json", *["2024-07-02T13-05_weather_data.json"] * 2,
    ]
    for row in held:
        with open(row.path.removeprefix("file:"), "rb") as file:
            file.seek(row.offset)
            body = file.read(row.length)
        assert json.loads(body)["results"][0]["name"] == "Łódź" and hashlib.md5(body).hexdigest() == row.md5
    assert stage_documents(read_document_files(spark, f"{root}/weather"), WEATHER).where("record_ts IS NOT NULL").count() == 5


def test_a_big_day_lands_in_small_files_and_row_groups(spark):
    root, staging = scratch_path(spark, "raw"), scratch_path(spark, "staging")
    documents = spark.range(64, numPartitions=4).select(
        F.expr("if(id < 62, timestamp_ntz'2024-07-01 10:00:00', if(id = 62, timestamp_ntz'2024-07-02 10:00:00', null))").alias("run"),
        F.lit(0).alias("part"),
        F.expr("""concat('{"results": [{"dt": ', id, ', "name": "',
            array_join(transform(sequence(1, 8192), n -> sha2(concat(id, '/', n), 256)), ''), '"}]}')""").alias("document"),
    )
    write_documents(documents, WEATHER, "run", root)
    files = file_inventory(spark, f"{root}/weather").collect()
    total = sum(f.length for f in files)
    assert total > 30_000_000 and max(f.length for f in files) < 16_000_000
    assert len(files) <= 2 + -(-total // FILE_BYTES)
    held = read_manifest(spark, root, WEATHER).collect()
    assert len(held) == 64 and {f.path for f in files} == {r.path for r in held}
    for row in held:
        with open(row.path.removeprefix("file:"), "rb") as file:
            file.seek(row.offset)
            assert hashlib.md5(file.read(row.length)).hexdigest() == row.md5
    # below a hundred documents, which a writer would by itself put into one row group
    write_staging(stage_documents(read_document_files(spark, f"{root}/weather"), WEATHER).coalesce(1), staging)
    (file,) = spark.read.parquet(staging).inputFiles()
    stored = pq.ParquetFile(file.removeprefix("file://")).metadata
    assert stored.num_rows == 64 and max(stored.row_group(i).total_byte_size for i in range(stored.num_row_groups)) < 20_000_000


def test_documents_of_one_file(spark):
    one = shapes.document(shapes.weather_element(1.0, 2.0, name="x}\n{[\""))
    flat = json.dumps(json.loads(one))
    bodies = {
        "a line each": (f"{flat}\n{flat}\n", 2, 2), "spread": (f"{one}\n\n  {one}\r\n{one}", 3, 3), "array": (f"[{one},\n{one}]", 2, 2),
        "lines in an array": (f"[\n{flat},\n{flat}\n]\n", 2, 2), "alone": (one, 1, 1), "empty": ("", 1, 0), "no document": ("[]", 1, 0),
        "blank": (" \n", 1, 0), "comma": (f"{flat},{flat}", 1, 0), "one line": (f"{flat} {flat}", 1, 0), "numbers": ("[1, 2]", 2, 0),
        "bad tail": (f'{flat}\n{{"a": ', 2, 1), "bad head": (f"{{x}}\n{flat}", 2, 1), "spaces": (f"{flat}{' ' * 200_000}\n{flat}", 2, 2),
    }
    rows = spark.createDataFrame([(k, v[0]) for k, v in bodies.items()], "path string, content string")
    staged = materialize(stage_documents(rows, WEATHER), "staged")
    found = staged.groupBy("source_filename").agg(F.count("*"), F.count("record_ts"), F.count_distinct("id"))
    assert {r[0]: (r[1], r[2]) for r in found.collect()} == {k: v[1:] for k, v in bodies.items()}
    assert all(r[1] == r[3] for r in found.collect()) and {r.city for r in curate(staged, WEATHER).collect()} == {'x}\n{["'}


def delivered(spark, *rows):
    """Staging rows of (delivery, part, parts, minute, value), all of one time."""
    bodies = [
        (f"2024-01-01 01:{minute:02d}:00", json.dumps({
            "delivery": delivery, "dt": shapes.HOUR, "part": part, "parts": parts, "results": [shapes.weather_element(1.0, 1.0, name=value)],
        }))
        for delivery, part, parts, minute, value in rows
    ]
    return materialize(shapes.staging(spark, WEATHER, *bodies), "staged")


def cities(staged, ties="keep"):
    return sorted(r.city for r in curate(staged, WEATHER, ties=ties).collect())


def test_a_delivery_counts_when_all_parts_have_landed(spark):
    first = [("d1", 0, 2, 1, "old0"), ("d1", 1, 2, 3, "old1")]
    assert cities(delivered(spark, first[0])) == []
    assert cities(delivered(spark, *first)) == ["old0", "old1"]
    half = [*first, ("d2", 0, 3, 5, "new0"), ("d2", 2, 3, 9, "new2")]
    staged = delivered(spark, *half)
    assert cities(staged) == ["old0", "old1"]
    assert [(r.delivery, r.parts, r.landed) for r in incomplete_deliveries(staged).collect()] == [("d2", 3, 2)]
    # a part that comes again counts once, as it came last; another delivery between does not matter
    whole = [*half, ("d3", 0, 1, 6, "between"), ("d2", 1, 3, 10, "new1"), ("d2", 0, 3, 11, "newer0")]
    assert cities(delivered(spark, *whole)) == ["new1", "new2", "newer0"]


def test_deliveries_completed_together(spark):
    rows = [("d1", 0, 2, 1, "a0"), ("d1", 1, 2, 5, "a1"), ("d2", 0, 1, 5, "b"), (None, 7, 9, 5, "c")]
    staged = delivered(spark, *rows)
    assert cities(staged) == ["a0", "a1", "b", "c"]
    assert cities(staged, "one") == ["c"]  # its file name comes last
    with pytest.raises(ValueError, match="ties"):
        curate(staged, WEATHER, ties="some")


def test_rejected_values_are_listed(spark):
    bad = shapes.weather_element(1.0, 1.0, temp="x", deg=1e12) | {"visibility": {"a": None}, "name": None}
    good = shapes.weather_element(2.0, 2.0, temp="4.5")
    staged = shapes.staging(spark, WEATHER, ("2024-01-01 01:00:00", shapes.document(bad, good)))
    rows = {r.lat: r for r in curate(staged, WEATHER, strict=False, rejected="rejected").collect()}
    assert rows[2.0].rejected is None and rows[2.0].temp == 4.5
    assert [tuple(r) for r in rows[1.0].rejected] == [
        ("temp", "$.main.temp", '"x"'), ("visibility", "$.visibility", '{"a":null}'), ("wind_deg", "$.wind.deg", "1000000000000"),
    ]
    with pytest.raises(ValueError, match="strict"):
        curate(staged, WEATHER, rejected="rejected")

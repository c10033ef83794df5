import gzip

import pytest
from pyspark.sql import types as T

from aqlake.operators.upsert import ambiguous_matches, upsert
from aqlake.plans import keyed_table
from aqlake.plans.keyed_table import drop_replaced, read_keyed, upsert_keyed
from aqlake.plans.register_load import load_register, update_register
from aqlake.session import scratch_path
from aqlake.sources.register import coordinate_pairs, peek_lines, read_register
from aqlake.sources.schemas import REGISTER, REGISTER_KEYS
from tests import shapes

BOM = "﻿"
HEADER = f"{BOM}Name;ASCII Name;Latitude;Longitude;Country Code;Population;Timezone;Country\n"
LINES = (
    "Łódka;Lodka;51.5;19.5;PL;768;Europe/Warsaw;Poland\n"
    '"A;B";AB;50.1;20.5;PL;100;Europe/Warsaw;Poland\n'
    '"Two\nlines ""quoted""";T;50.2;20.5;PL;7;Europe/Warsaw;Poland\n'
    "Bad;Bad;fifty;20.5;PL;100;Europe/Warsaw;Poland\n"
    "Short;Short;50.1\n"
    "Long;Long;50.1;20.5;PL;100;Europe/Warsaw;Poland;more\n"
)
UPDATE = [c for c in REGISTER.names if c not in REGISTER_KEYS]


@pytest.fixture(params=["register.csv", "register.csv.gz"])
def csv(tmp_path, request):
    content = (HEADER + LINES).encode()
    shapes.write_file(tmp_path / "in", request.param, gzip.compress(content) if request.param.endswith("gz") else content)
    return str(tmp_path / "in")


def test_good_and_bad_rows(spark, csv):
    good, bad = read_register(spark, csv)
    assert good.schema.names == REGISTER.names
    assert {(r.city, r.lat, r.population) for r in good.collect()} == {
        ("Łódka", 51.5, 768), ("A;B", 50.1, 100), ('Two\nlines "quoted"', 50.2, 7),
    }
    assert good.count() == 3 and bad.count() == 3  # counting selects no column at all
    assert {r._corrupt_record.split(";")[0] for r in bad.select("_corrupt_record").collect()} == {"Bad", "Short", "Long"}
    assert sorted(map(tuple, coordinate_pairs(good).collect())) == [(50.1, 20.5), (50.2, 20.5), (51.5, 19.5)]


def test_peek_includes_header(spark, csv):
    lines = [r.first_field for r in peek_lines(spark, csv, sep=";").collect()]
    assert [line.lstrip(BOM) for line in lines] == ["Name", "Łódka", "A;B", 'Two\nlines "quoted"', "Bad", "Short", "Long"]


def test_upsert(spark):
    target = shapes.register(spark, ("a", 1.0, 1.0, 10), ("moved", 1.0, 1.0, 20), (None, 1.0, 1.0, 30))
    source = shapes.register(
        spark, ("a", 1.0, 1.0, 11), ("moved", 1.5, 1.0, 21), ("new", 2.0, 2.0, None), (None, 1.0, 1.0, 31)
    )
    found = upsert(target, source, REGISTER_KEYS, UPDATE)
    assert found.columns == target.columns
    assert sorted(((r.city, r.lat, r.population) for r in found.collect()), key=repr) == sorted(
        [
            ("a", 1.0, 11),  # matched: updated
            ("moved", 1.0, 20), ("moved", 1.5, 21),  # moved coordinates are another key
            ("new", 2.0, None),
            (None, 1.0, 30), (None, 1.0, 31),  # NULL keys match nothing
        ],
        key=repr,
    )


def test_upsert_writes_nulls_and_is_idempotent(spark):
    target = shapes.register(spark, ("a", 1.0, 1.0, 10), ("b", 1.0, 1.0, 20))
    source = shapes.register(spark, ("a", 1.0, 1.0, None), ("c", 1.0, 1.0, 5))
    once = upsert(target, source, REGISTER_KEYS, UPDATE)
    assert {r.city: r.population for r in once.collect()} == {"a": None, "b": 20, "c": 5}
    twice = upsert(once, source, REGISTER_KEYS, UPDATE)
    assert sorted(map(repr, once.collect())) == sorted(map(repr, twice.collect()))


def test_ambiguous_matches(spark):
    target = shapes.register(spark, ("a", 1.0, 1.0, 1))
    source = shapes.register(spark, ("a", 1.0, 1.0, 2), ("a", 1.0, 1.0, 3), ("new", 1.0, 1.0, 2), ("new", 1.0, 1.0, 2))
    assert [r.city for r in ambiguous_matches(target, source, REGISTER_KEYS).collect()] == ["a"]


def test_load_register_twice(spark, csv):
    first, second = scratch_path(spark, "register"), scratch_path(spark, "register")
    assert load_register(spark, csv, None, first) == "register load completed, 3 rows skipped"
    load_register(spark, csv, spark.read.parquet(first), second)
    once, twice = (sorted(map(repr, spark.read.parquet(p).collect())) for p in (first, second))
    assert once == twice and len(once) == 3


def test_update_register_twice(spark, csv):
    root = scratch_path(spark, "register")
    for _ in range(2):
        assert update_register(spark, csv, root) == "register load completed, 3 rows skipped"
        assert read_keyed(spark, root, REGISTER).count() == 3


def put(spark, root, *rows, buckets=8):
    source = spark.createDataFrame(list(rows), "k long, v int, note string")
    return upsert_keyed(source, root, SCHEMA, ["k"], ["v"], buckets)


def kept(spark, root):
    return sorted((tuple(r) for r in read_keyed(spark, root, SCHEMA).collect()), key=repr)


SCHEMA = T.StructType().add("k", "long").add("v", "integer").add("note", "string")


def test_keyed_table_rewrites_matched_buckets_only(spark, tmp_path):
    root = str(tmp_path / "t")
    assert kept(spark, root) == []
    put(spark, root, *((k, 0, "old") for k in range(64)), (None, 0, "old"))
    files = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet") if "rows" in p.parts}
    assert put(spark, root, (5, 1, "new"), (None, 1, "new")) == 2
    want = [(k, int(k == 5), "old") for k in range(64)] + [(None, 0, "old"), (None, 1, "new")]
    assert kept(spark, root) == sorted(want, key=repr)
    assert all(p.stat().st_mtime_ns == t for p, t in files.items())
    anew = {p.parent.name for p in (tmp_path / "t/rows/version=2").rglob("*.parquet")}
    assert 1 <= len(anew) <= 2  # the bucket of 5, and the one of the new row without a key
    read = {f.split("/rows/")[1].rsplit("/", 1)[0] for f in read_keyed(spark, root, SCHEMA).inputFiles()}
    assert read <= {str(p.parent.relative_to(tmp_path / "t/rows")) for p in tmp_path.rglob("*.parquet") if "rows" in p.parts}
    assert drop_replaced(spark, root, keep=0) == 1
    assert kept(spark, root) == sorted(want, key=repr)


def test_keyed_table_adds_new_keys_beside_a_bucket(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed_table, "MAX_ADDED", 2)
    root = str(tmp_path / "t")
    for k in range(4):
        put(spark, root, (k, 0, "old"), buckets=1 + k)  # the number of buckets stays as it was
    assert kept(spark, root) == [(k, 0, "old") for k in range(4)]
    assert drop_replaced(spark, root, keep=0) == 3  # the fourth has gathered the three before it
    assert kept(spark, root) == [(k, 0, "old") for k in range(4)]


def test_an_upsert_that_died_is_invisible(spark, tmp_path):
    root = str(tmp_path / "t")
    put(spark, root, (1, 0, "old"), (2, 0, "old"))
    left = spark.createDataFrame([(1, 9, "lost", b) for b in range(8)], "k long, v int, note string, bucket int")
    left.write.partitionBy("bucket").parquet(f"{root}/rows/version=2")
    assert kept(spark, root) == [(1, 0, "old"), (2, 0, "old")]
    put(spark, root, (2, 5, "new"))
    assert kept(spark, root) == [(1, 0, "old"), (2, 5, "old")]


def test_keyed_table_casts_keys_and_refuses_ambiguous_ones(spark, tmp_path):
    root = str(tmp_path / "t")
    put(spark, root, (1, 0, "old"))
    upsert_keyed(spark.createDataFrame([(1, 7, "x")], "k int, v int, note string"), root, SCHEMA, ["k"], ["v"])
    assert kept(spark, root) == [(1, 7, "old")]
    with pytest.raises(ValueError, match="several rows"):
        put(spark, root, (1, 1, "a"), (1, 2, "b"))
    with pytest.raises(ValueError, match="bucket"):
        upsert_keyed(spark.createDataFrame([(1,)], "bucket int"), root, T.StructType().add("bucket", "integer"), ["bucket"], [])
    put(spark, root)
    assert kept(spark, root) == [(1, 7, "old")]


def test_load_register_refuses_ambiguous_file(spark, tmp_path):
    line = "a;a;1.0;1.0;PL;5;Europe/Warsaw;Poland\n"
    shapes.write_file(tmp_path, "r.csv", HEADER + line + line)
    target = shapes.register(spark, ("a", 1.0, 1.0, 1))
    with pytest.raises(ValueError, match="several rows"):
        load_register(spark, str(tmp_path), target, scratch_path(spark, "register"))


def test_doubled_quotes(spark, tmp_path):
    head = "city;city_ascii;lat;lon;country_code;population;timezone;country\n"
    path = tmp_path / "quotes.csv"
    path.write_text(head + '"A ""B""";x;1;2;XX;5;UTC;"C""; D"\n', encoding="utf-8")
    good, bad = read_register(spark, str(path))
    assert [(r.city, r.country) for r in good.collect()] == [('A "B"', 'C"; D')] and bad.count() == 0

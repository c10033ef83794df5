"""What the plans look like, since that decides how they scale."""

import pytest
from pyspark.sql import functions as F

from aqlake.operators import serve
from aqlake.operators.dedup import latest_per_key
from aqlake.operators.joins import attach_register, join_feeds
from aqlake.session import scratch_path
from checks import tables as t
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"
STREAMING = {"stream_ingest", "stream_quarantine", "refresh_incremental", "refresh_star", "refresh_dims", "curated_tables", "sql_over_views", "refresh_full",
             "register_change", "rejected_values", "split_runs", "many_documents_per_file", "landed_files"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMING))
def test_no_python_no_pair_joins_no_windows(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "Window"):
        assert node not in plan


def test_joins_do_not_need_broadcasts(spark, conf):
    """With broadcasts off the same rows come from shuffled joins."""
    names = ["wide", "latest_per_key", "star_join", "upsert", "prefix_join_fanout"]
    with_broadcast = {n: sorted(map(repr, QUERIES[n](spark, SF).collect())) for n in names}
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    for name in names:
        df = QUERIES[name](spark, SF)
        assert "BroadcastHashJoin" not in plan_of(df)
        assert sorted(map(repr, df.collect())) == with_broadcast[name]


def skewed(spark, name, rows=60_000):
    """A third of the rows share one key."""
    path = scratch_path(spark, name)
    spark.range(rows).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 7).alias("at"),
        F.sha2(F.col("id").cast("string"), 512).alias("payload"),
    ).repartition(16).write.parquet(path)
    return spark.read.parquet(path)


def test_hot_key_is_split(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB",
    )
    rows = skewed(spark, "skewed")
    newest = latest_per_key(rows, ["k"], "at")
    hot = newest.where("k = -1").count()
    assert hot == rows.where("k = -1 AND at = 6").count() > 0
    newest.collect()
    assert "SortMergeJoin(skew=true)" in plan_of(newest)

    other_path = scratch_path(spark, "other")
    spark.range(60_000).select((F.col("id") - 1).alias("k"), F.lit("x").alias("tag")).write.parquet(other_path)
    joined = join_feeds(rows, spark.read.parquet(other_path), on=["k"])
    assert len(joined.select("k", "payload", "tag").collect()) == rows.count() - rows.where("k > 59998").count()
    joined.collect()
    assert "SortMergeJoin(skew=true)" in plan_of(joined)


def test_hot_place_is_split(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB",
    )
    path = scratch_path(spark, "places")
    skewed(spark, "rows").select(
        F.col("k").cast("double").alias("lat"), F.lit(1.5).alias("lon"), "payload"
    ).write.parquet(path)
    rows = spark.read.parquet(path)
    register_path = scratch_path(spark, "register")
    spark.range(-1, 9999).select(
        F.col("id").cast("double").alias("lat"), F.lit(1.5).alias("lon"), F.col("id").alias("city")
    ).write.parquet(register_path)
    placed = attach_register(rows, spark.read.parquet(register_path), ["city"], coord_match="exact")
    found = placed.collect()
    assert len(found) == rows.count() and sum(r.city == -1 for r in found) == 20_000
    assert "SortMergeJoin(skew=true)" in plan_of(placed)


def test_serving_filters_reach_the_scan(spark):
    plan = plan_of(serve.series_one(t.stored_day_agg(spark, SF), "Customer#000000008", "2024-01-29", "CO"))
    assert "PushedFilters: [IsNotNull(city), EqualTo(city,Customer#000000008)]" in plan
    assert "measurement_date" in plan.split("PartitionFilters")[1].split("]")[0]
    assert "ReadSchema: struct<city:string,measurement_time:timestamp_ntz,co_avg:double>" in plan


def test_newest_snapshot_is_one_subquery(spark):
    plan = plan_of(serve.latest_snapshot(*t.stored_star(spark, SF)))
    assert "Subquery" in plan and "TakeOrderedAndProject" in plan


def test_inventory_reads_no_bodies(spark, tmp_path):
    from aqlake.sources.documents import file_inventory

    (tmp_path / "a.json").write_text("{}")
    assert "content" not in plan_of(file_inventory(spark, str(tmp_path)))


def test_feeds_meet_as_stored_tables(spark):
    """A plan takes exploded documents for a fraction of their size, and would broadcast millions of rows."""
    plan = plan_of(QUERIES["wide_from_documents"](spark, SF))
    assert "Generate" not in plan and "curated-pollution" in plan and "curated-weather" in plan


def test_settings_of_the_caller_stay(spark, conf):
    from aqlake.session import settle

    listing, shredding = "spark.sql.sources.parallelPartitionDiscovery.parallelism", "spark.sql.variant.inferShreddingSchema"
    conf(**{listing.replace(".", "__"): "3", shredding.replace(".", "__"): "true"})
    settle(spark)
    assert (spark.conf.get(listing), spark.conf.get(shredding)) == ("3", "true")
    spark.conf.unset(listing), spark.conf.unset(shredding)
    settle(spark)
    assert int(spark.conf.get(listing)) == 8 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(shredding) == "false"

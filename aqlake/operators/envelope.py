"""Per-location records into documents, and documents into files."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aqlake.feeds import Feed
from aqlake.functions.timeparts import local_stamp
from aqlake.session import DOCUMENT_ROWS, materialize
from aqlake.sources.documents import DOCUMENT_GAP, as_documents

# Of documents to a landed file, about: whoever reads a file holds it whole, several times over.
FILE_BYTES = 8 * 2**20


def override_coords(
    records: DataFrame,
    register: DataFrame,
    request_id: str,
    register_id: str,
    coord: str = "coord",
) -> DataFrame:
    """Replace each reply's coordinates by those of the place that was asked for.

    ``register`` has ``register_id``, ``lat`` and ``lon``. A reply without a
    coordinate object, or for an unknown place, is left out.
    """
    places = register.select(
        F.col(register_id).alias("_place"), F.struct("lat", "lon").alias("_asked")
    )
    return (
        records.where(F.col(coord).isNotNull())
        .join(places, F.col(request_id) == F.col("_place"), "inner")
        .withColumn(coord, F.col("_asked"))
        .drop("_place", "_asked")
    )


def build_envelope(
    records: DataFrame,
    run: Sequence[str],
    element: Column,
    dt: Column,
    order_by: Sequence[str],
    max_elements: int = 10_000,
    pretty: bool = False,
    delivery: str | None = None,
) -> DataFrame:
    """Each run as a delivery of ``{"delivery", "dt", "part", "parts", "results": [...]}`` documents.

    A delivery has as many parts as it takes for about ``max_elements`` records in
    each, so no task ever holds a whole hot run; most have one. All parts have the same shape, carry
    their number, how many there are, and the time ``dt`` of the run's first record (by
    ``order_by``), and are sorted each by itself; numbers may be left out.
    ``delivery`` names this sending, by default anew on every call: parts of one sending
    with one ``dt`` belong together, and count only when all of them have landed (``newest_deliveries``).

    ``records`` is read once. Copies of a record are counted and cut into chunks, so that
    they spread over the parts too. Returns the run columns, ``part``, ``parts``, ``n_elements`` and
    ``document``.
    """
    delivery = delivery or uuid.uuid4().hex
    rows = records.select(*run, F.struct(*order_by).alias("_order"), dt.alias("_dt"), element.alias("_element"))
    # Written once, then read for the sizes and for the documents: see ``materialize``.
    counted = materialize(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n")), "records")
    wanted = F.ceil(F.sum("_n") / max_elements).cast("int").alias("_wanted")
    first = F.min(F.struct("_order", "_dt"))["_dt"].alias("dt")
    sizes = materialize(counted.groupBy(*run).agg(wanted, first), "run-sizes")
    chunk = max(1, max_elements // 10)
    last = F.ceil(F.col("_n") / chunk).cast("int") - 1
    copies = F.least(F.col("_n") - F.col("_chunk") * chunk, F.lit(chunk)).cast("int")
    chunks = counted.select("*", F.explode(F.sequence(F.lit(0), last)).alias("_chunk")).withColumn("_copies", copies)
    part = F.pmod(F.xxhash64("_order", "_chunk"), F.col("_wanted")).cast("int")

    def with_run(left: DataFrame, right: DataFrame, *columns: str) -> DataFrame:
        named = right.select(*[F.col(c).alias(f"_run_{i}") for i, c in enumerate(run)], *columns)
        same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_run_{i}")) for i, c in enumerate(run)])
        return left.join(named, same).drop(*[f"_run_{i}" for i in range(len(run))])

    placed = with_run(chunks, sizes, "dt", "_wanted").withColumn("part", part)
    if sizes.where("_wanted > 1").isEmpty():
        placed = placed.withColumn("parts", F.lit(1))
    else:  # hashing may leave a part without records: only those that have some are counted
        there = placed.select(*run, "part").distinct().groupBy(*run).agg(F.count(F.lit(1)).cast("int").alias("parts"))
        placed = with_run(placed, materialize(there, "run-parts"), "parts")
    # sort_array, not array_sort: the latter compares through an interpreted lambda.
    members = F.sort_array(F.collect_list(F.struct("_order", "_chunk", "_copies", "_element")))
    repeated = F.when(
        F.exists("_members", lambda m: m["_copies"] > 1),
        F.flatten(F.transform("_members", lambda m: F.array_repeat(m["_element"], m["_copies"]))),
    ).otherwise(F.col("_members._element"))
    documents = (
        placed.groupBy(*run, "parts", "dt", "part").agg(members.alias("_members")).withColumn("results", repeated)
    )
    options = {"ignoreNullFields": "false", "pretty": str(pretty).lower()}
    body = F.struct(F.lit(delivery).alias("delivery"), "dt", "part", "parts", "results")
    return documents.select(
        *run, "part", "parts", F.size("results").alias("n_elements"), F.to_json(body, options).alias("document")
    )


def document_name(feed: Feed, run_ts: Column, zone: str = "Europe/Warsaw") -> Column:
    """``<local minute>_<file name>``, for all parts of a delivery alike."""
    return F.concat_ws("_", local_stamp(run_ts, zone), F.lit(feed.file_name))


def write_documents(
    documents: DataFrame, feed: Feed, run_ts: str, root: str, per_file: int | None = None, file_bytes: int = FILE_BYTES
) -> None:
    """Land documents below ``<root>/<feed>/run_date=<day>/sending=<id>/``, many to a file, and list them.

    This is the layout that ``catch_up`` takes in with ``root`` as its landing folder. A file
    holds the documents of one day one after another, at most ``per_file`` of them. If a day has more
    than ``file_bytes``, the days' documents are dealt by hash to folders ``piece=<n>/`` of about that size
    each, so a file stays small however big the day (a single document is never cut). Old days can be moved away whole.

    ``documents`` has ``run_ts``, ``part`` and ``document`` and is evaluated once. The manifest
    below ``<root>/_manifest`` has a row for each: (name, part, path, offset, length, md5), places in bytes; see
    ``read_manifest``. It is written after the files, so it lists nothing that is not there.
    """
    spark, sending = documents.sparkSession, uuid.uuid4().hex
    named = documents.select(
        F.to_date(run_ts).alias("run_date"),
        F.lit(sending).alias("sending"),
        document_name(feed, F.col(run_ts)).alias("name"),
        "part",
        F.col("document").alias("value"),
        F.octet_length("document").alias("_size"),
        F.monotonically_increasing_id().alias("_row"),
    )
    named = materialize(named, "documents", **DOCUMENT_ROWS)
    pieces = F.ceil(F.sum("_size") / file_bytes).alias("_pieces")
    days = materialize(named.groupBy(F.col("run_date").alias("_day")).agg(pieces), "days")
    folders = ["run_date", "sending"]
    landed = named
    if not days.where("_pieces > 1").isEmpty():
        folders.append("piece")
        dealt = F.pmod(F.xxhash64("_row"), F.col("_pieces")).alias("piece")
        landed = named.join(days, F.col("run_date").eqNullSafe(F.col("_day"))).select("run_date", "sending", dealt, "value")
    by_day = [c for c in folders if c != "sending"]
    writer = landed.select(*folders, "value").hint("rebalance", *by_day).write.mode("append")
    if per_file:
        writer = writer.option("maxRecordsPerFile", per_file)
    writer.partitionBy(*folders).text(f"{root}/{feed.name}")
    _located(spark, f"{root}/{feed.name}/run_date=*/sending={sending}", named).write.parquet(
        f"{root}/_manifest/{feed.name}/sending={sending}"
    )


def _located(spark: SparkSession, path: str, named: DataFrame) -> DataFrame:
    """Where in which file each document stands, found by its MD5. Only a file's own documents are numbered together."""
    files = as_documents(spark.read, path)
    pieces = files.select("path", F.posexplode(F.split("content", DOCUMENT_GAP)).alias("at", "text"))
    body = F.rtrim("text", F.lit("\n"))
    before = Window.partitionBy("path").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    # one newline stands between two documents
    offset = F.coalesce(F.sum(F.col("length") + 1).over(before), F.lit(0)).alias("offset")
    sized = pieces.select("path", "at", F.octet_length(body).cast("bigint").alias("length"), F.md5(body).alias("md5"))
    places = sized.select("path", "at", "length", "md5", offset)
    # Equal documents of one sending have one name.
    names = named.select(F.md5("value").alias("md5"), "name", "part").groupBy("md5").agg(
        F.min("name").alias("name"), F.min("part").alias("part")
    )
    return places.join(names, "md5").select("name", "part", "path", "offset", "length", "md5")


def read_manifest(spark: SparkSession, root: str, feed: Feed) -> DataFrame:
    """All documents that ``write_documents`` has landed: (name, part, path, offset, length, md5)."""
    schema = "name string, part int, path string, offset bigint, length bigint, md5 string"
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{root}/_manifest/{feed.name}")

"""JSON document files and the documents in them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

from aqlake.feeds import Feed
from aqlake.functions.json_paths import field
from aqlake.functions.keys import surrogate_key
from aqlake.functions.timeparts import epoch_to_ntz

Steps = list[list[Column | str]]

_BYTE_ORDER_MARK = "\ufeff"

# Why a document or file is in quarantine.
EMPTY_FILE, UNREADABLE_FILE, NO_DOCUMENT, NO_TIME = "empty file", "unreadable file", "no document", "no time"


def file_name() -> Column:
    """The path of a row's file. The source gives it URL-encoded, with "+" standing for itself."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def as_documents(reader: DataFrameReader | DataStreamReader, path: str | list[str]) -> DataFrame:
    """Every file below ``path`` as a row of ``path`` and ``content``, batch or stream.

    A file is read whole; compressed ones are unpacked by their extension. Empty
    files give no row.
    """
    files = reader.format("text").option("wholetext", True).option("recursiveFileLookup", True).load(path)
    return files.select(file_name().alias("path"), F.col("value").alias("content"))


def read_document_files(spark: SparkSession, path: str) -> DataFrame:
    """Every document below ``path``, one row per file."""
    return as_documents(spark.read, path)


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Name, size and modification time of every file below ``path``; no body is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "length", "modificationTime")


# Between two documents of one file. A raw newline never stands within a JSON string, and within
# a document a closing bracket is never followed by an opening one without a comma.
DOCUMENT_GAP = r"(?<=[}\]])[^\S\n]*+\n\s*+(?=[{\[])"


def split_documents(files: DataFrame) -> DataFrame:
    """Every document of every file: (path, stg_file_md5, piece, element, json_data).

    A file holds one document, several with newlines between them (one a line, or
    spread over lines), or an array of documents. ``piece`` and ``element`` number them.
    A piece that is no JSON gives one row with NULL ``json_data``, as does an empty file or
    array; the other pieces of the file are not affected. Documents on one line without a
    newline between them are no JSON.
    """
    return _selected(files, _split_steps())


def _selected(rows: DataFrame, steps: Steps) -> DataFrame:
    return reduce(lambda found, columns: found.select(*columns), steps, rows)


def _split_steps() -> Steps:
    body = F.ltrim("content", F.lit(_BYTE_ORDER_MARK))
    pieces = F.posexplode(F.split(body, DOCUMENT_GAP)).alias("piece", "_text")
    # The parser stops after the first value; in brackets, whatever follows it shows.
    whole = F.try_parse_json(F.concat(F.lit("["), F.col("_text"), F.lit("]")))
    alone = F.try_variant_get(F.col("_whole"), "$[1]", "variant").isNull()
    value = F.when(alone, F.try_variant_get(F.col("_whole"), "$[0]", "variant"))
    elements = F.coalesce(F.try_variant_get(F.col("_value"), "$", "array<variant>"), F.array("_value"))
    numbered = ["path", "stg_file_md5", "piece"]
    return [
        ["path", F.md5("content").alias("stg_file_md5"), pieces],
        [*numbered, whole.alias("_whole")],
        [*numbered, value.alias("_value")],
        [*numbered, F.posexplode_outer(elements).alias("element", "json_data")],
    ]


def stage_documents(files: DataFrame, feed: Feed, steps: Steps | None = None) -> DataFrame:
    """Document files (batch or stream) as staging rows, one a document.

    The document's time is that of its first element. A delivery split over
    several documents repeats that time as ``$.dt`` and says by ``$.delivery``, ``$.part`` and
    ``$.parts`` what belongs together (see ``build_envelope``); without these
    the document counts by itself. What is no JSON, or has no
    usable time, keeps a NULL ``record_ts``: such rows land in the NULL
    partition of ``record_date``, which is the quarantine.

    Who stages many small batches of one feed passes its ``staging_steps``, to put them together once.
    """
    return _selected(files, steps or staging_steps(feed))


def staging_steps(feed: Feed) -> Steps:
    """The selections that ``stage_documents`` makes one after another."""
    json_data = F.col("json_data")

    def lenient(path: str, dtype: str):
        return field(json_data, path, dtype, strict=False)

    epoch = F.coalesce(lenient("$.dt", "bigint"), lenient(feed.dt_path, "bigint"))
    timed = [
        "*",
        epoch_to_ntz(epoch).alias("record_ts"),
        lenient("$.delivery", "string").alias("_delivery"),
        lenient("$.part", "int").alias("_part"),
        lenient("$.parts", "int").alias("_parts"),
    ]
    fits = F.col("_delivery").isNotNull() & (F.col("_part") >= 0) & (F.col("_parts") >= 1)
    staged = [
        # Same file, same place in it, same id: a replayed micro-batch cannot renumber rows.
        surrogate_key("path", "stg_file_md5", "piece", F.coalesce("element", F.lit(0))).alias("id"),
        "record_ts",
        "json_data",
        F.current_timestamp().alias("ingestion_ts"),
        F.col("path").alias("source_filename"),
        "stg_file_md5",
        F.when(fits, F.col("_delivery")).alias("delivery"),
        F.when(fits, F.col("_part")).otherwise(0).alias("part"),
        F.when(fits, F.col("_parts")).otherwise(1).alias("parts"),
        F.when(json_data.isNull(), NO_DOCUMENT).when(F.col("record_ts").isNull(), NO_TIME).alias("reason"),
        F.to_date("record_ts").alias("record_date"),
    ]
    return [*_split_steps(), timed, staged]

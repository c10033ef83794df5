"""Registered queries of the llm operators: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from aqlake.llm.decontaminate import decontaminate_digest
from aqlake.llm.hard_negatives import hard_negatives_digest
from aqlake.llm.html_text import extraction_digest
from aqlake.llm.language import language_digest
from aqlake.llm.license_scan import license_scan
from aqlake.llm.line_dedup import line_dedup_digest
from aqlake.llm.minhash import minhash_digest
from aqlake.llm.neighbours import neighbours_digest
from aqlake.llm.packing import packing_digest
from aqlake.llm.quality import quality_digest
from aqlake.llm.simhash import simhash_digest
from aqlake.llm.url_filter import url_digest
from aqlake.llm.whitening import whitening_digest


def _query(digest: Callable[..., DataFrame], *tables: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return digest(*(spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in tables))

    return query


QUERIES = {
    "op1_simhash": _query(simhash_digest, "documents"),
    "op2_html_text": _query(extraction_digest, "pages"),
    "op3_url_filter": _query(url_digest, "pages"),
    "op4_language": _query(language_digest, "documents"),
    "op5_line_dedup": _query(line_dedup_digest, "documents"),
    "op6_decontaminate": _query(decontaminate_digest, "documents", "benchmark"),
    "op7_neighbours": _query(neighbours_digest, "embeddings"),
    "op8_quality": _query(quality_digest, "documents", "labels"),
    "op9_packing": _query(packing_digest, "documents"),
    "op10_license_scan": _query(license_scan, "documents"),
    "op11_minhash": _query(minhash_digest, "documents"),
    "op12_whitening": _query(whitening_digest, "embeddings"),
    "op13_hard_negatives": _query(hard_negatives_digest, "embeddings"),
}

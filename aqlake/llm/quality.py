"""Quality by compression: which class's zstandard dictionary shortens a text more."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aqlake.llm.calibrate import fit_logistic, logistic
from aqlake.llm.shared import fold, hashed_sample, schema, store

CHUNK = 1024  # bytes compressed at a time: a dictionary only shortens what it stands near to
SAMPLE = 2048  # bytes of a training chunk
LEVEL = 3
SLICE = 512  # texts scored at a time


class CompressionModel:
    """Two dictionaries and a calibration; small (twice ``dict_bytes``), so it travels with the tasks."""

    def __init__(self, good: list[bytes], bad: list[bytes], dict_bytes: int):
        self.contents = [_dictionary(texts, dict_bytes) for texts in (good, bad)]
        self.slope, self.offset = 1.0, 0.0

    def compressors(self):
        made = []
        for content in self.contents:
            words = zstandard.ZstdCompressionDict(content)
            words.precompute_compress(level=LEVEL)
            made.append(
                zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=words, write_content_size=False, write_checksum=False, write_dict_id=False
                )
            )
        return made

    def difference(self, text: str, compressors) -> float:
        """(size by the bad dictionary - size by the good one) / plain size, over the whole text."""
        data = text.encode("utf-8", "surrogatepass")
        if not data:
            return 0.0
        good, bad = (
            sum(len(c.compress(data[i : i + CHUNK])) for i in range(0, len(data), CHUNK)) for c in compressors
        )
        return (bad - good) / len(data)

    def calibrate(self, texts: list[str], labels: list[int]) -> None:
        made = self.compressors()
        self.slope, self.offset = fit_logistic([self.difference(t, made) for t in texts], labels)

    def scores(self, texts, made=None) -> np.ndarray:
        made = made or self.compressors()
        return logistic([self.difference(t, made) for t in texts], self.slope, self.offset)


def _dictionary(texts: list[bytes], dict_bytes: int) -> bytes:
    """A dictionary trained on all chunks of the texts; their own bytes where these are too few to train on."""
    chunks = [t[i : i + SAMPLE] for t in texts for i in range(0, len(t), SAMPLE)]
    try:
        return zstandard.train_dictionary(dict_bytes, chunks).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(chunks)[-dict_bytes:].rjust(8, b"\n")


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = 1500, dict_bytes: int = 112_640) -> CompressionModel:
    """Fit on at most ``sample`` labelled texts of each class, one a doc_id, chosen by hash of the id.

    Two thirds of them fill the dictionaries, one third calibrates. The bound on the rows
    is what makes collecting them safe; it is the only thing that does not cover all rows:
    the calibration is brought to the classes' shares among all labelled rows.
    Rows without doc_id, text or a label of 0 or 1 teach nothing.
    """
    marks = labels.where(F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("int").alias("quality"))
    given = docs.where(F.col("text").isNotNull()).select("doc_id", "text")
    # ids and labels alone decide which texts are fetched
    marked = store(given.select("doc_id").hint("merge").join(marks.dropna(subset=["doc_id"]), "doc_id"))
    totals = dict(marked.groupBy("quality").count().collect())
    chosen = []
    for kind in (0, 1):
        ids = [row[0] for row in hashed_sample(marked.where(F.col("quality") == kind).select("doc_id"), ["doc_id"], sample).collect()]
        rows = given.where(F.col("doc_id").isin(ids)).groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
        chosen.append([row["text"] for row in rows.orderBy(F.xxhash64("doc_id")).collect()])
    bad, good = chosen
    encode = lambda texts: [t.encode("utf-8", "surrogatepass") for i, t in enumerate(texts) if i % 3]
    model = CompressionModel(encode(good), encode(bad), dict_bytes)
    model.calibrate(good[::3] + bad[::3], [1] * len(good[::3]) + [0] * len(bad[::3]))
    if good and bad:  # from the sample's share of each class to the share among all labelled rows
        model.offset += float(np.log(totals[1] / totals[0] * len(bad) / len(good)))
    return model


def score_quality(docs: DataFrame, model: CompressionModel) -> DataFrame:
    """Add ``score`` (0 to 1, higher: better) to every row; null text scores as empty text.

    Other columns are kept; one named ``score`` is replaced.
    """
    kept = docs.drop("score")
    out = schema("score double")
    for field in reversed(kept.schema.fields):
        out.fields.insert(0, field)
        out.names.insert(0, field.name)

    def run(batches):
        made = model.compressors()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                scores = model.scores((text.as_py() or "" for text in part.column("text")), made)
                # other columns stay as they come: as numbers beside a null, ids would be rounded
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores)], names=out.names)

    return kept.mapInArrow(run, out)


def quality_digest(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Held-out flag, score and decision of every document.

    Labels are learnt only from documents whose crc32(doc_id as text) mod 4 is not 2.
    """
    taught = docs.where(fold(F.col("doc_id"), 4) != 2)
    model = fit_quality(taught, labels)
    return score_quality(docs.select("doc_id", "text"), model).select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )

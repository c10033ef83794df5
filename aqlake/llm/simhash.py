"""SimHash near-dedup by bit-sliced comparison."""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aqlake.llm.shared import components, schema, store

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
BLOCK = 1024  # fingerprints of one side of a comparison
LANES = 64
STRIDE = 1 << 16  # shingles hashed at a time


def fingerprint(text: str | None, size: int = 3) -> int:
    """SimHash of the whole text: a bit is set if over half the shingle hashes have it; 0 without words."""
    words = WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())  # bytes: A-Z only
    if not words:
        return 0
    n = max(1, len(words) - size + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, STRIDE):
        hashes = np.fromiter(
            (xxhash.xxh64_intdigest(b" ".join(words[i : i + size]), 42) for i in range(at, min(n, at + STRIDE))), np.uint64
        )
        ones += _bits(hashes).sum(axis=0, dtype=np.int64)
    return int(sum(1 << int(b) for b in np.flatnonzero(2 * ones > n)))


def _bits(values: np.ndarray) -> np.ndarray:
    """(n, 64) bits, lowest first."""
    return np.unpackbits(np.ascontiguousarray(values, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def planes(values: np.ndarray) -> np.ndarray:
    """Bit planes stored vertically: (64, n / 64) words, one lane a value."""
    bits = np.zeros((64, -(-len(values) // LANES) * LANES), np.uint8)
    bits[:, : len(values)] = _bits(values).T
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


class Counters:
    """Distances of many lanes at once: carry-save counters with a sticky bit for "beyond the radius"."""

    def __init__(self, shape, radius: int):
        self.digits = [np.zeros(shape, np.uint64) for _ in range(radius.bit_length() or 1)]
        self.over, self.radius = np.zeros(shape, np.uint64), radius

    def add(self, carry: np.ndarray) -> None:
        for k, digit in enumerate(self.digits):
            self.digits[k], carry = digit ^ carry, digit & carry
        self.over |= carry

    def beyond(self) -> np.ndarray:
        """Lanes whose count is over the radius: the counter compared with the radius, highest digit first."""
        more, same = self.over.copy(), ~self.over
        for k in range(len(self.digits) - 1, -1, -1):
            if self.radius >> k & 1:
                same = same & self.digits[k]
            else:
                more |= same & self.digits[k]
                same = same & ~self.digits[k]
        self.over |= more
        return self.over

    def keep(self, rows: np.ndarray) -> None:
        self.digits, self.over = [d[rows] for d in self.digits], self.over[rows]


def close(values: np.ndarray, radius: int, step: int = 8) -> np.ndarray:
    """(n, n) matrix: which values differ in at most ``radius`` bits.

    Each value against all lanes; after every ``step`` planes, values whose lanes are all
    beyond the radius are abandoned. The comparison with itself always holds, so it is
    masked out meanwhile.
    """
    n = len(values)
    vertical, bits = planes(values), _bits(values)
    rows = np.arange(n)
    counters = Counters((n, vertical.shape[1]), radius)
    pad = np.zeros(vertical.shape[1] * LANES, np.uint8)
    pad[n:] = 1
    counters.over |= np.packbits(pad, bitorder="little").view(np.uint64)
    own = np.zeros((n, pad.size), np.uint8)
    own[rows, rows] = 1
    counters.over |= np.packbits(own, axis=1, bitorder="little").view(np.uint64)
    for b in range(64):
        wanted = np.where(bits[rows, b] == 1, ~np.uint64(0), np.uint64(0))
        counters.add(vertical[b][None, :] ^ wanted[:, None])
        if b % step == step - 1:
            alive = ~(counters.beyond() == ~np.uint64(0)).all(axis=1)
            if not alive.all():
                rows = rows[alive]
                counters.keep(alive)
                if not len(rows):
                    break
    found = np.zeros((n, n), bool)
    if len(rows):
        near = ~counters.beyond()
        found[rows] = np.unpackbits(near.view(np.uint8), axis=1, bitorder="little")[:, :n].astype(bool)
    return found


def _roots(found: np.ndarray) -> np.ndarray:
    """Least index reachable within the block."""
    label = np.arange(len(found))
    found = found | np.eye(len(found), dtype=bool)
    while True:
        low = np.where(found, label[None, :], len(found)).min(axis=1)
        low = np.minimum(low, low[low])
        if (low == label).all():
            return label
        label = low


def links_of_blocks(blocks: list[np.ndarray], radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is linked within each block: each value to the least-placed one it reaches.

    Blocks of up to 64 values are compared together, value i with value i + r for every
    shift r, with one pair a lane; larger ones each by ``close``.
    """
    left, right = [], []
    small = [b for b in blocks if len(b) <= LANES]
    if small:
        values, sizes = np.concatenate(small), np.array([len(b) for b in small])
        ends = np.repeat(np.cumsum(sizes), sizes)
        at = np.arange(len(values))
        for shift in range(1, sizes.max()):
            at = at[at + shift < ends[at]]
            if not len(at):
                break
            mixed = planes(values[at] ^ values[at + shift])
            counters = Counters(mixed.shape[1:], radius)
            for b in range(64):
                counters.add(mixed[b])
                if b % 8 == 7 and (counters.beyond() == ~np.uint64(0)).all():
                    break
            near = np.unpackbits((~counters.beyond()).view(np.uint8), bitorder="little")[: len(at)].astype(bool)
            left.append(values[at[near]])
            right.append(values[at[near] + shift])
    for block in blocks:
        if len(block) > LANES:
            root = _roots(close(block, radius))
            moved = np.flatnonzero(root != np.arange(len(block)))
            left.append(block[moved])
            right.append(block[root[moved]])
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _keys(radius: int) -> Column:
    """Equal bits that two fingerprints within the radius must share: radius + 2 stripes, any two of them."""
    n = radius + 2
    cuts = [64 * i // n for i in range(n + 1)]
    mask = lambda i: ((1 << cuts[i + 1]) - (1 << cuts[i]))
    pairs = []
    for i, j in combinations(range(n), 2):
        bits = mask(i) | mask(j)
        signed = bits - (1 << 64) if bits >> 63 else bits
        pairs.append(F.struct(F.lit(i * n + j).alias("stripe"), F.col("fp").bitwiseAND(F.lit(signed)).alias("bits")))
    return F.array(*pairs)


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """(doc_id, fp) of each row's whole text; fp as a signed 64-bit number."""

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), size) for t in batch.column("text")], np.uint64).view(np.int64)
            # ids stay Arrow columns: as numbers beside a null they would be rounded
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps)], names=["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, schema(f"doc_id {kind}, fp bigint"))


def fingerprint_links(fps: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) that connect all different fingerprints within ``radius`` bits.

    Two such fingerprints agree on at least two of radius + 2 stripes of bits, so they meet
    under one of the keys. A key with more than ``BLOCK`` fingerprints is split by hash
    into parts; every two parts meet in a block of their own.
    """
    keyed = store(fps.select("fp").distinct().select("fp", F.explode(_keys(radius)).alias("key")).select("fp", "key.*"))
    sizes = store(keyed.groupBy("stripe", "bits").count().where("count > 1"))
    parts = F.ceil(F.col("count") / BLOCK).cast("int")
    met = (
        keyed.join(sizes, ["stripe", "bits"])
        .select("stripe", "bits", "fp", parts.alias("parts"), F.pmod(F.xxhash64("fp"), parts).cast("int").alias("part"))
        .select(
            "stripe",
            "bits",
            "fp",
            "part",
            F.explode(
                F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(
                    F.array_remove(F.sequence(F.lit(0), F.col("parts") - 1), F.col("part"))
                )
            ).alias("other"),
        )
        .groupBy("stripe", "bits", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"))
        .agg(F.collect_list("fp").alias("fps"))
        .select("fps")
    )

    def run(batches):
        for batch in batches:
            blocks = [np.sort(np.asarray(x, np.int64)).view(np.uint64) for x in batch["fps"]]
            a, b = links_of_blocks(blocks, radius)
            yield pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)}).drop_duplicates()

    return met.mapInPandas(run, schema("a bigint, b bigint"))


def near_duplicates(docs: DataFrame, size: int = 3, radius: int = 2) -> DataFrame:
    """Group documents by SimHash: (doc_id, fp, component_id), one row per row of ``docs``.

    Two fingerprints link if they differ in at most ``radius`` bits; component_id is the
    smallest doc_id reachable over links. Texts without words have fingerprint 0 and link
    like any other. A null doc_id is kept and is never the smallest unless it is alone.
    Rows with one doc_id are fingerprinted each by its own text. Other columns are not
    read. An empty table gives an empty one.
    """
    fps = store(fingerprints(docs, size))
    rooted = store(components(fingerprint_links(fps, radius)).select(F.col("node").alias("fp"), "root"))
    each = store(
        fps.groupBy("fp")
        .agg(F.min("doc_id").alias("least"))
        .join(rooted, "fp", "left")
        .select("fp", F.coalesce("root", "fp").alias("root"), "least")
    )
    least = each.groupBy("root").agg(F.min("least").alias("component_id"))
    named = store(each.join(least, "root").select("fp", "component_id"))
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def simhash_digest(docs: DataFrame) -> DataFrame:
    """``near_duplicates`` with 3-word shingles and 2 bits, fingerprints as 16 hex digits."""
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )

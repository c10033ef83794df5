"""Near-duplicate texts by SuperMinHash, banding, exact verification and connected components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aqlake.llm.shared import components, schema, store
from aqlake.llm.superminhash import Words, band_keys, shingle_set, signatures

BANDS = 32
ROWS = 4  # registers a band: four 16-bit hashes make one 64-bit key
ELEMENTS = 1 << 18  # of the sets in one part of a bucket
SLICE = 512  # texts whose sets are held at a time


def _text_keys() -> list:
    """128 bits that stand for a whole text."""
    return [F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2")]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def signed_sets(docs: DataFrame, size: int = 2) -> DataFrame:
    """(doc_id, k1, k2, n, s1, s2, bands) of each row: text key, set size, set key, packed band keys."""

    def run(batches):
        words = Words()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                sets = [shingle_set(t, words, size) for t in part.column("text").to_pylist()]
                ids = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets), "<i8").reshape(-1, 2)
                keys = band_keys(signatures(sets, BANDS * ROWS), ROWS)
                starts = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * BANDS)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("k1"),
                        part.column("k2"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(ids[:, 0].copy()),
                        pa.array(ids[:, 1].copy()),
                        pa.ListArray.from_arrays(starts, pa.array(keys.ravel())),
                    ],
                    names=["doc_id", "k1", "k2", "n", "s1", "s2", "bands"],
                )

    source = _texts(docs).select("doc_id", *_text_keys(), "text")
    kept = T.StructType([f for f in source.schema.fields if f.name != "text"])
    more = schema("n bigint, s1 bigint, s2 bigint, bands array<bigint>")
    return source.mapInArrow(run, T.StructType([*kept.fields, *more.fields]))


def _members(classes: DataFrame) -> DataFrame:
    """(band, key, rid, shared): the buckets of two classes or more; ``shared`` is the bucket's size."""
    keyed = classes.select("rid", F.posexplode("bands").alias("band", "key"))
    sizes = keyed.groupBy("band", "key").agg(F.count("*").alias("shared")).where("shared > 1")
    return store(keyed.join(sizes.hint("merge"), ["band", "key"]).select("band", "key", "rid", "shared"))


def _stars(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of each bucket's leader with every other member.

    The leader is the member whose buckets are the largest: the original among edited
    copies shares more bands than any copy does. One order for all bands keeps the number of different pairs low.
    """
    popular = store(members.groupBy("rid").agg(F.sum("shared").alias("reach")))
    ranked = members.join(popular, "rid")
    first = F.max(F.struct(F.col("reach"), (-F.col("rid")).alias("turned")))
    leaders = store(ranked.groupBy("band", "key").agg((-first["turned"]).alias("a")))
    return members.join(leaders, ["band", "key"]).where("rid <> a").select("a", F.col("rid").alias("b")).distinct()


def spanning_links(rid: np.ndarray, root: np.ndarray, sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Links (a, b) that join whatever similar sets of different components there are in a block.

    Members outside the block's largest component are compared with all others, each by
    counting its elements in all sets at once. A link is given only where it joins two
    components that earlier links have not joined (union-find), so there are fewer links
    than components.
    """
    sizes = np.array([len(s) for s in sets])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    _, elements = np.unique(np.concatenate(sets), return_inverse=True)
    names, label, counts = np.unique(root, return_inverse=True, return_counts=True)
    up = np.arange(len(names))

    def find(k: int) -> int:
        while up[k] != k:
            up[k] = up[up[k]]
            k = up[k]
        return k

    found = []
    marked = np.zeros(elements.max() + 1, np.int64)
    for at in np.flatnonzero(label != counts.argmax()):
        own = elements[starts[at] : starts[at] + sizes[at]]
        marked[own] = 1
        both = np.add.reduceat(marked[elements], starts)
        marked[own] = 0
        near = np.flatnonzero(100 * both >= percent * (sizes + sizes[at] - both))
        others, first = np.unique(label[near], return_index=True)
        for other, place in zip(others, near[first]):
            one, two = find(int(other)), find(int(label[at]))
            if one != two:
                up[one] = two
                found.append((rid[at], rid[place]))
    return np.array(found, np.int64).reshape(-1, 2)


def _open_links(members: DataFrame, sets: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between members of a bucket that no links connect yet, compared on their full sets.

    Buckets whose members all lie in one component are passed over. Of the others, every
    two members of different components are compared. A bucket with more than ``ELEMENTS`` elements is
    cut by hash into parts, and every two parts meet in a block of their own.
    """
    placed = members.join(roots.withColumnRenamed("node", "rid"), "rid", "left").select(
        "band", "key", "rid", F.coalesce("root", "rid").alias("root")
    )
    sized = placed.join(sets.select("rid", F.size("shingles").alias("n")), "rid")
    parts = F.ceil(F.sum("n") / ELEMENTS).cast("int").alias("parts")
    mixed = store(
        sized.groupBy("band", "key").agg(F.min("root").alias("low"), F.max("root").alias("high"), parts).where("low < high")
    )
    rows = store(placed.join(mixed.select("band", "key", "parts"), ["band", "key"])).withColumn(
        "part", F.pmod(F.xxhash64("rid"), F.col("parts")).cast("int")
    )
    others = F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(
        F.array_remove(F.sequence(F.lit(0), F.col("parts") - 1), F.col("part"))
    )
    blocks = (
        rows.withColumn("other", F.explode(others))
        .select("band", "key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "rid", "root")
        .hint("merge")
        .join(sets, "rid")
        .groupBy("band", "key", "i", "j")
        .agg(F.collect_list(F.struct("rid", "root", "shingles")).alias("rows"))
        .select("rows")
    )

    def run(batches):
        for batch in batches:
            links = [np.zeros((0, 2), np.int64)]
            for block in batch.column(0):
                rows = block.values
                held = rows.field("shingles")
                held = [x.values.to_numpy() for x in held]
                links.append(spanning_links(rows.field("rid").to_numpy(), rows.field("root").to_numpy(), held, percent))
            pairs = np.concatenate(links)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["a", "b"])

    return blocks.mapInArrow(run, schema("a bigint, b bigint"))


def _candidate_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(rid, shingles): the full sets of the classes in ``wanted`` (rid, doc_id, k1, k2).

    The texts are joined in the same way at every size, by a sort-merge join, so that what is moved stays in proportion.
    """
    # repeated rows fall together before they move
    texts = _texts(docs).groupBy("doc_id", *_text_keys()).agg(F.max("text").alias("text"))
    wanted = wanted.select("rid", F.col("doc_id").alias("in_doc"), F.col("k1").alias("in1"), F.col("k2").alias("in2"))
    same = F.col("doc_id").eqNullSafe(F.col("in_doc")) & (F.col("k1") == F.col("in1")) & (F.col("k2") == F.col("in2"))

    def run(batches):
        words = Words()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                sets = [shingle_set(t, words, size) for t in part.column("text").to_pylist()]
                starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                values = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("rid"), pa.ListArray.from_arrays(pa.array(starts), pa.array(values))], names=["rid", "shingles"]
                )

    found = texts.hint("merge").join(wanted, same).select("rid", "text")
    return store(found.mapInArrow(run, schema("rid bigint, shingles array<bigint>")))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets have 100 * intersection >= percent * union."""
    left = sets.select(F.col("rid").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("rid").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    # a leader has many pairs, so its set is joined while the pairs are narrow
    return (
        pairs.hint("merge").join(left, "a").hint("merge").join(right, "b")
        .select("a", "b", (F.size("x") + F.size("y")).alias("total"), both.alias("both"))
        .where(100 * F.col("both") >= percent * (F.col("total") - F.col("both")))
        .select("a", "b")
    )


def near_duplicate_texts(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Group rows by the similarity of their word shingles: (doc_id, n_shingles, component_id, kept).

    A row's set holds its text's distinct shingles of ``size`` lower-cased (A-Z) words, as
    64-bit hashes; a text with fewer words is one shingle. Two sets link if
    100 * intersection >= ``percent`` * union, counted on the full sets. Candidates agree
    in one of 32 bands of four SuperMinHash registers: at a similarity of 0.8 a pair is
    missed once in 2 * 10**7. Equal sets are one class and are compared once. First each
    bucket's members are verified against its leader; then, in buckets whose members are not yet
    all connected, those of different components are compared with each other in blocks.

    component_id is the smallest doc_id reachable, the row's own included; ``kept`` says
    that it is the row's own. Rows without words (null or empty text) have no shingles and
    link with nothing. Rows that repeat a doc_id are judged each by its own text. A null
    doc_id is never the smallest unless all of the group are null; then each such row is kept. Other
    columns are not read. An empty table gives an empty one.
    """
    signed = store(signed_sets(docs, size))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "k1", "k2")
    classes = store(
        signed.where("n > 0")
        .groupBy("s1", "s2")
        .agg(F.min("doc_id").alias("least"), F.min_by(F.struct("doc_id", "k1", "k2", "n", "bands"), order).alias("one"))
        .select(F.monotonically_increasing_id().alias("rid"), "s1", "s2", "least", "one.*")
    )
    members = _members(classes)
    stars = store(_stars(members))
    sets = _candidate_sets(docs, classes.join(members.select("rid").distinct(), "rid", "left_semi"), size)
    links = store(_verified(stars, sets, percent))
    roots = store(components(links))
    links = links.union(_open_links(members, sets, roots, percent))
    roots = store(components(links)).withColumnRenamed("node", "rid")
    rooted = store(classes.join(roots, "rid", "left").select("s1", "s2", "least", F.coalesce("root", "rid").alias("root")))
    groups = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = store(rooted.join(groups, "root").select("s1", "s2", "component_id"))
    joined = signed.select("doc_id", "n", "s1", "s2").join(named, ["s1", "s2"], "left")
    # without words there is no class, and the row is its own component
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def minhash_digest(docs: DataFrame) -> DataFrame:
    """``near_duplicate_texts`` over shingles of two words at a similarity of 0.8."""
    return near_duplicate_texts(docs, size=2, percent=80)

"""Hard negatives by Fagin's threshold algorithm over blocks of rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aqlake.llm.shared import schema, store
from aqlake.llm.vectors import finite, of_common_length, scaled

ROWS = 4096  # candidates of one block, and anchors of one group
HELD = 8  # blocks that one group holds at most
FIRST = 32  # depth of the first round of sorted access
TOGETHER = 128  # anchors that search a block together
LARGEST = 1 << 25  # beyond it an inner product might not fit into a long
NEVER = np.iinfo(np.int64).min


class Block:
    """Candidates with, for each dimension, their places by falling and by rising component."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, labels: np.ndarray, x: np.ndarray, falling: np.ndarray):
        self.ids, self.rows, self.labels, self.x = ids, rows, labels, x
        self.lists = np.concatenate([falling, falling[:, ::-1]])
        self.values = x.T[np.arange(len(self.lists))[:, None] % x.shape[1], self.lists]

    @staticmethod
    def falling(x: np.ndarray) -> np.ndarray:
        return np.argsort(-x.T, axis=1, kind="stable").astype(np.int16)


def _best(scores: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> np.ndarray:
    """For each window the ``k``th highest of the falling ``scores`` within it, or its lower end if it has fewer."""
    if not len(scores):
        return low
    # falling scores, so places are counted on the negated ones
    at = np.searchsorted(-scores, -high, side="left") + k - 1
    held = scores[np.minimum(at, len(scores) - 1)]
    return np.where((at < len(scores)) & (held >= low), held, low)


def _product(vectors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Random access: scores of some candidates for some anchors, an anchor a row."""
    return vectors @ rows.T


def threshold_search(block: Block, anchor: np.ndarray, eligible: np.ndarray, low: np.ndarray, high: np.ndarray, k: int):
    """``group_search`` for one anchor: a list of (scores, places), a pair for each window."""
    return group_search(block, anchor[None], eligible[None], low[None], high[None], k)[0][0]


def group_search(block: Block, anchors: np.ndarray, eligible: np.ndarray, low: np.ndarray, high: np.ndarray, k: int):
    """For each anchor the ``k`` best eligible candidates of each of its windows, and the windows' floors.

    ``anchors``, ``eligible``, ``low`` and ``high`` have a row for each anchor. Returns a pair for each:
    a list of (scores, places), best first, for its windows, and the scores from which on they were looked at.

    A window holds scores from ``low`` to ``high``; ties go to the smaller id, then row. Sorted
    access goes down every dimension's list, from the end that the sign of an anchor's
    component favours; the anchors go down together, and a candidate met by any of them for the first
    time is scored at once on all dimensions (random access) for all that still search. No candidate
    still unmet can score above an anchor's threshold, its product with the values at the
    current depth, so its access ends as soon as the threshold is strictly below the kth score of every
    window (its lower end while it holds fewer). The depth doubles each round.
    """
    m, dims = len(block.ids), anchors.shape[1]
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    lists = np.flatnonzero(np.concatenate([up.any(axis=0), down.any(axis=0)]))
    met = np.zeros(m, bool) if len(lists) else np.ones(m, bool)
    scores = np.zeros((len(anchors), m), np.int64)
    known: list[np.ndarray] = [met] * len(anchors)
    top = low.max(axis=1)  # no floor can be above it
    live = np.arange(len(anchors))
    depth, step = 0, FIRST

    def floor(i: int) -> np.ndarray:
        own = scores[i][known[i] & eligible[i] & (scores[i] >= low[i].min())]
        return _best(-np.sort(-own), low[i], high[i], k)

    while len(live) and not met.all():
        seen = met.copy()
        seen[block.lists[lists, depth : depth + step]] = True
        fresh = np.flatnonzero(seen & ~met)
        if len(fresh):
            scored = _product(anchors[live], block.x[fresh]).astype(np.int64, copy=False)
            scores[live[:, None], fresh] = scored
            top[live] = np.maximum(top[live], scored.max(axis=1))
        met = seen
        depth = min(m, depth + step)
        step = depth
        for i in live:
            known[i] = met
        if depth == m:
            break
        bound = up[live] @ block.values[:dims, depth - 1] + down[live] @ block.values[dims:, depth - 1]
        done = bound < top[live]
        for at in np.flatnonzero(done):
            done[at] = np.all(bound[at] < floor(live[at]))
        live = live[~done]
    found = []
    for i in range(len(anchors)):
        least = floor(i)
        places = np.flatnonzero(known[i] & eligible[i] & (scores[i] >= least.min()))
        held = scores[i][places]
        order = np.lexsort((block.rows[places], block.ids[places], -held))
        places, held = places[order], held[order]
        inside = (held >= least[:, None]) & (held <= high[i][:, None])
        found.append(([(held[w][:k], places[w][:k]) for w in inside], least))
    return found


def _numbers(column, kind=np.int64) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(kind, copy=False)


def _packed(rows: DataFrame) -> DataFrame:
    """Rows of (row, vec_id, label, x) packed in arriving order: (block, ids, rows, labels, x, falling)."""

    def pack(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                x = part.column("x").flatten().to_numpy().astype(np.int32).reshape(part.num_rows, -1)
                whole = lambda values: pa.array([values.tobytes()], pa.binary())
                labels = part.column("label")
                yield pa.RecordBatch.from_arrays(
                    [
                        whole(_numbers(part.column("vec_id"))),
                        whole(_numbers(part.column("row"))),
                        pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), labels),
                        whole(x),
                        whole(Block.falling(x)),
                    ],
                    names=["ids", "rows", "labels", "x", "falling"],
                )

    packed = rows.select("row", "vec_id", "label", "x").mapInArrow(
        pack, schema("ids binary, rows binary, labels array<string>, x binary, falling binary")
    )
    return store(packed.select(F.monotonically_increasing_id().alias("block"), "*"))


def _unpacked(blocks: pa.Table, at: int) -> Block:
    ids = np.frombuffer(blocks.column("ids")[at].as_buffer(), np.int64)
    x = np.frombuffer(blocks.column("x")[at].as_buffer(), np.int32).reshape(len(ids), -1)
    # doubles hold the products exactly while they stay below 2**53
    exact = x.shape[1] * (int(np.abs(x).max()) + 1) * LARGEST < 1 << 53
    return Block(
        ids,
        np.frombuffer(blocks.column("rows")[at].as_buffer(), np.int64),
        np.array(blocks.column("labels")[at].as_py(), object),
        x.astype(np.float64 if exact else np.int64),
        np.frombuffer(blocks.column("falling")[at].as_buffer(), np.int16).reshape(x.shape[1], -1),
    )


def _together(windows: list[np.ndarray]) -> list[np.ndarray]:
    """Places of anchors that search together: of equally many windows, and not too many."""
    number = np.array([w.shape[1] for w in windows])
    places = [np.flatnonzero(number == n) for n in np.unique(number)]
    return [p[at : at + TOGETHER] for p in places for at in range(0, len(p), TOGETHER)]


def _searched(anchors: DataFrame, blocks: DataFrame, sizes: tuple[int, int, int], k: int, same: bool) -> DataFrame:
    """(row, slot, score, vec_id, other): each block's best rows for each window of each anchor.

    ``anchors`` has (row, label, x, low, high), the last two arrays of equal length, a
    window each. Anchors and blocks are dealt into a grid: every group of anchors meets every
    group of blocks, both of bounded size, in a task of its own.
    """
    many, held, parallel = sizes
    heaps = max(1, -(-many // ROWS))
    shelves = max(1, min(held, 4 * parallel), -(-held // HELD))
    spread = F.sequence(F.lit(0), F.lit(shelves - 1)), F.sequence(F.lit(0), F.lit(heaps - 1))
    asked = anchors.select(
        F.pmod(F.xxhash64("row"), F.lit(heaps)).cast("int").alias("heap"), F.explode(spread[0]).alias("shelf"), "*"
    )
    dealt = blocks.select(
        F.explode(spread[1]).alias("heap"), F.pmod(F.xxhash64("block"), F.lit(shelves)).cast("int").alias("shelf"), "*"
    )
    names = ["row", "slot", "score", "vec_id", "other"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[] for _ in names]
        if left.num_rows and right.num_rows:
            rows, labels = _numbers(left.column("row")), left.column("label").to_pylist()
            vectors = [np.array(x, np.int64) for x in left.column("x").to_pylist()]
            windows = [np.array(w, np.int64).reshape(2, -1) for w in zip(left.column("low").to_pylist(), left.column("high").to_pylist())]
            matrix = np.stack(vectors)
            lows, highs = (list(side) for side in zip(*windows))
            for at in range(right.num_rows):
                block = _unpacked(right, at)
                codes: dict = {}
                own, theirs = (np.array([codes.setdefault(x, len(codes)) for x in side]) for side in (labels, block.labels))
                for some in _together(windows):
                    eligible = own[some][:, None] == theirs
                    eligible = eligible & (rows[some][:, None] != block.rows) if same else ~eligible
                    some = some[asked := eligible.any(axis=1)]
                    if not len(some):
                        continue
                    low, high = np.stack([lows[i] for i in some]), np.stack([highs[i] for i in some])
                    searched = group_search(block, matrix[some].astype(block.x.dtype), eligible[asked], low, high, k)
                    for i, (slots, floor) in zip(some, searched):
                        # k rows of this block reach the floor, so rows of the next ones need to
                        lows[i] = floor
                        for slot, (scores, places) in enumerate(slots):
                            if len(places):
                                for got, values in zip(out, (np.full(len(places), rows[i]), np.full(len(places), slot), scores, block.ids[places], block.rows[places])):
                                    got.append(values)
        return pa.table([pa.array(np.concatenate(o) if o else [], k) for o, k in zip(out, kinds)], names=names)

    keys = ["heap", "shelf"]
    return (
        asked.groupBy(*keys).cogroup(dealt.groupBy(*keys))
        .applyInArrow(search, schema("row bigint, slot int, score bigint, vec_id bigint, other bigint"))
    )


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    percent: tuple[int, int] = (50, 95),
    scale: int = 256,
) -> DataFrame:
    """For each anchor and each of its positives, the best rows of other labels that are near, but not too near.

    ``vectors`` has vec_id, embedding and label; ``is_anchor`` says which rows are anchors.
    Components become floor(``scale`` * c); a row's score is its integer inner product with
    the anchor, higher first, ties to the smaller vec_id. Positives are the anchor's first
    ``positives`` other rows of its label; a negative's score in hundredths of the
    positive's lies within ``percent``, both ends included (no row can if the positive's score is negative). Returns
    (anchor_id, positive_id, rank, negative_id, positive_score, negative_score), all that there
    are where fewer fit.

    Rows with a null id, label or vector, an empty vector or one with a null or non-finite
    component take no part, nor do vectors of another length than most, nor those with a
    component of 2**25 or more after scaling, whose products might not fit into a long. Labels are compared as
    text. Rows that repeat a vec_id count each, and each is an anchor of its own. An empty table
    gives an empty result. Other columns are not read.
    """
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("label").cast("string").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
        v.alias("v"),
    ).where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite(F.col("v")))
    rows, _ = of_common_length(rows, "v")
    rows = rows.select("vec_id", "label", "anchor", scaled(F.col("v"), scale).alias("x"))
    rows = rows.where(F.forall("x", lambda c: F.abs(c) < LARGEST))
    rows = store(rows.select(F.monotonically_increasing_id().alias("row"), "*"))
    asked = rows.where("anchor").drop("anchor")
    blocks = _packed(rows)
    sizes = (asked.count(), blocks.count(), vectors.sparkSession.sparkContext.defaultParallelism)

    every = asked.select("row", "label", "x", F.array(F.lit(NEVER + 1)).alias("low"), F.array(F.lit(-NEVER - 1)).alias("high"))
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id", "other")
    found = _searched(every, blocks, sizes, positives, same=True)
    kept = store(
        found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
        .select("row", "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
        .where("positive_score >= 0")
    )
    # 100 * score >= low * positive, and 100 * score <= high * positive, in whole numbers
    low = F.expr(f"(positive_score * {percent[0]} + 99) div 100").alias("low")
    high = F.expr(f"(positive_score * {percent[1]}) div 100").alias("high")
    windows = kept.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("place", low, high))).alias("windows"))
    narrowed = store(
        asked.join(windows, "row").select("row", "label", "x", F.col("windows.low").alias("low"), F.col("windows.high").alias("high"), "windows.place")
    )
    found = _searched(narrowed.drop("place"), blocks, sizes, negatives, same=False)
    order = Window.partitionBy("row", "slot").orderBy(F.desc("score"), "vec_id", "other")
    best = store(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives))
    return (
        best.join(kept.withColumn("slot", F.col("place") - 1), ["row", "slot"])
        .join(asked.select("row", F.col("vec_id").alias("anchor_id")), "row")
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )


def hard_negatives_digest(embeddings: DataFrame) -> DataFrame:
    """Anchors are the rows whose vec_id is divisible by 50; every seventh row's label is moved on by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    moved = embeddings.select("vec_id", "embedding", label.alias("label"))
    return hard_negatives(moved, F.col("vec_id") % 50 == 0)

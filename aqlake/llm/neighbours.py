"""Approximate nearest neighbours over learned partitions of a neighbour graph."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aqlake.llm.shared import hashed_sample, schema, store

SAMPLE = 8192  # vectors that the graph and the classifier are fitted on, at most
PER_PART = 1024  # distinct vectors a partition should hold
MAX_PARTS = 256
BLOCK = 4096  # candidates of one comparison
QUERIES = 2048  # queries of one comparison


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = np.asarray(rows, np.float64)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def neighbour_graph(unit: np.ndarray, k: int) -> np.ndarray:
    """(n, k): the most similar other rows."""
    k = min(k, len(unit) - 1)
    out = np.zeros((len(unit), k), np.int64)
    for at in range(0, len(unit), 1024):
        near = unit[at : at + 1024] @ unit.T
        near[np.arange(len(near)), np.arange(at, at + len(near))] = -np.inf
        out[at : at + 1024] = np.argpartition(-near, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(unit: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12) -> np.ndarray:
    """Partition the graph into equal parts with few cut links.

    Starts from halving along the direction of most variance, then moves each vertex to
    the part of most of its neighbours while that part has room (a twentieth over the mean).
    """
    n = len(unit)
    label, groups = np.zeros(n, np.int64), [(np.arange(n), parts)]
    made = 0
    while groups:
        rows, share = groups.pop()
        if share == 1:
            label[rows] = made
            made += 1
            continue
        centred = unit[rows] - unit[rows].mean(axis=0)
        direction = np.linalg.eigh(centred.T @ centred)[1][:, -1]
        order = rows[np.argsort(centred @ direction, kind="stable")]
        cut = len(rows) * (share // 2) // share
        groups += [(order[:cut], share // 2), (order[cut:], share - share // 2)]
    room = int(np.ceil(1.05 * n / parts))
    for _ in range(rounds):
        votes = np.zeros((n, parts), np.int32)
        for column in graph.T:
            np.add.at(votes, (np.arange(n), label[column]), 1)
            np.add.at(votes, (column, label), 1)
        gain = votes.max(axis=1) - votes[np.arange(n), label]
        sizes = np.bincount(label, minlength=parts)
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            to = int(votes[i].argmax())
            if sizes[to] < room:
                sizes[label[i]] -= 1
                sizes[to] += 1
                label[i] = to
                moved += 1
        if not moved:
            break
    return label


class Router:
    """A softmax classifier from a vector to partitions, and how many of them a query must visit."""

    def __init__(self, unit: np.ndarray, recall: float, rounds: int = 150):
        n, dims = unit.shape
        parts = int(min(MAX_PARTS, max(1, n // 64)))
        self.weights, self.offset, self.probes = np.zeros((dims, 1)), np.zeros(1), 1
        self.parts = 1
        if parts == 1:
            return
        graph = neighbour_graph(unit, 10)
        self._fit(unit, balanced_parts(unit, graph, parts), parts, rounds)
        self.parts = parts
        # visits needed so that the sample's own nearest neighbours are found
        ranked = np.argsort(-(unit @ self.weights + self.offset), axis=1)
        place = np.empty_like(ranked)
        np.put_along_axis(place, ranked, np.broadcast_to(np.arange(parts), ranked.shape), axis=1)
        home = ranked[:, 0]
        visits = np.sort(np.take_along_axis(place, home[graph[:, :5]], axis=1).ravel())
        self.probes = int(visits[min(len(visits) - 1, int(np.ceil(recall * len(visits))))]) + 1

    def _fit(self, unit: np.ndarray, label: np.ndarray, parts: int, rounds: int) -> None:
        means = np.stack([unit[label == p].mean(axis=0) if (label == p).any() else unit[0] * 0 for p in range(parts)])
        self.weights, self.offset = 8.0 * means.T, -4.0 * (means**2).sum(axis=1)
        target = np.zeros((len(unit), parts))
        target[np.arange(len(unit)), label] = 1
        speed_w, speed_b = np.zeros_like(self.weights), np.zeros_like(self.offset)
        for _ in range(rounds):
            logits = unit @ self.weights + self.offset
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            wrong = (p / p.sum(axis=1, keepdims=True) - target) / len(unit)
            speed_w = 0.9 * speed_w - 4.0 * (unit.T @ wrong)
            speed_b = 0.9 * speed_b - 4.0 * wrong.sum(axis=0)
            self.weights, self.offset = self.weights + speed_w, self.offset + speed_b

    def route(self, vectors, visits: int) -> np.ndarray:
        """(n, visits): the most probable partitions first."""
        logits = _unit(vectors) @ self.weights + self.offset
        return np.argsort(-logits, axis=1, kind="stable")[:, :visits]


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, v): rows with an id and a vector that is not null, empty, zero, or holding null or non-finite parts."""
    v = F.col(vector_column).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.select(F.col(id_column).cast("bigint").alias("vec_id"), v.alias("v"))
        .where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)))
        .where(F.exists("v", lambda x: x != 0))
    )


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    recall: float = 0.97,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """The ``k`` rows of ``vectors`` nearest by cosine to each row of ``queries``, the row itself left out.

    Returns (query_id, rank from 1, vec_id, score), nearest first, ties to the smaller id.
    Scores are computed in double precision on the original vectors. Vectors that are
    null, empty, zero or hold null or non-finite parts take no part. Vectors of another
    length than most of the sample's are not comparable and take no part either. Fewer
    candidates than ``k`` give fewer rows, an empty table none. Other columns are not read.

    Equal vectors are indexed once, with their ``k`` + 1 smallest ids: no other copy can
    be among the ``k`` nearest of anything. The graph, its partition and the classifier are fitted on
    at most ``SAMPLE`` vectors chosen by hash; every vector is then indexed in its most probable
    partition. A query visits as many partitions as the sample needed for ``recall``.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_column, vector_column)
    asked = usable(queries, id_column, vector_column)
    smallest = Window.partitionBy("v").orderBy("vec_id")
    copies = store(
        rows.distinct().withColumn("place", F.row_number().over(smallest)).where(F.col("place") <= k + 1).drop("place")
    )
    base = store(copies.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    out = schema("query_id bigint, rank int, vec_id bigint, score double")
    sample = hashed_sample(base.select("v"), ["v"], SAMPLE).toPandas()["v"].tolist()
    if not sample:
        return spark.createDataFrame([], out)
    lengths = np.array([len(v) for v in sample])
    dims = int(np.bincount(lengths).argmax())
    router = Router(_unit(np.stack([v for v in sample if len(v) == dims])), recall)
    base, asked = base.where(F.size("v") == dims), asked.where(F.size("v") == dims)

    def routed(df: DataFrame, visits: int) -> DataFrame:
        def run(batches):
            for batch in batches:
                if len(batch):
                    batch["parts"] = list(router.route(np.stack(batch["v"].to_list()), visits).astype(np.int32))
                    yield batch

        return df.mapInPandas(run, T.StructType([*df.schema.fields, T.StructField("parts", T.ArrayType(T.IntegerType()))]))

    indexed = store(routed(base, 1).select("ids", "v", F.col("parts")[0].alias("part")))
    sizes = indexed.groupBy("part").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    blocks = indexed.join(sizes, "part").select(
        "part", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int").alias("block"), "ids", "v"
    )
    # each different query vector is searched once
    wanted = store(routed(asked.select("v").distinct(), router.probes))
    heaps = wanted.select(F.explode("parts").alias("part")).groupBy("part").agg(
        F.ceil(F.count("*") / QUERIES).cast("int").alias("heaps")
    )
    visits = (
        wanted.select(F.explode("parts").alias("part"), "v")
        .join(heaps, "part")
        .join(sizes, "part")
        .select(
            "part",
            F.pmod(F.xxhash64("v"), F.col("heaps")).cast("int").alias("heap"),
            F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
            "v",
        )
    )
    spread = blocks.join(heaps, "part").select(
        "part", "block", F.explode(F.sequence(F.lit(0), F.col("heaps") - 1)).alias("heap"), "ids", "v"
    )

    def compare(ask: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(ask) or not len(held):
            return pd.DataFrame({"v": [], "vec_id": [], "score": []})
        left, right = np.stack(ask["v"].to_list()), np.stack(held["v"].to_list())
        norms = np.linalg.norm(right, axis=1)
        found = []
        for q in left:
            score = np.clip(right @ q / (norms * np.linalg.norm(q)), -1.0, 1.0)
            # all rows tied with the last place stay
            last = -np.partition(-score, min(k, len(score) - 1))[min(k, len(score) - 1)]
            near = [(s, i) for at in np.flatnonzero(score >= last) for s, i in ((score[at], i) for i in held["ids"].iat[at])]
            near.sort(key=lambda x: (-x[0], x[1]))
            found += [(q, int(i), float(s)) for s, i in near[: k + 1]]
        return pd.DataFrame(found, columns=["v", "vec_id", "score"])

    keys = ["part", "block", "heap"]
    near = (
        visits.groupBy(*keys).cogroup(spread.groupBy(*keys)).applyInPandas(compare, schema("v array<double>, vec_id bigint, score double"))
    )
    order = Window.partitionBy("v").orderBy(F.desc("score"), "vec_id")
    best = store(
        near.withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= k + 1)
        .groupBy("v")
        .agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("near"))
    )
    own = F.filter("near", lambda x: x["vec_id"] != F.col("query_id"))
    return (
        asked.withColumnRenamed("vec_id", "query_id")
        .distinct()
        .join(best, "v")
        .select("query_id", F.posexplode(F.slice(own, 1, k)).alias("at", "n"))
        .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "n.vec_id", "n.score")
    )


def neighbours_digest(embeddings: DataFrame) -> DataFrame:
    """The 5 nearest rows of every row whose vec_id is divisible by 50."""
    return search(embeddings, embeddings.where(F.col("vec_id") % 50 == 0))

"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation over distributed rows."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aqlake.llm.shared import schema, store
from aqlake.llm.vectors import finite, of_common_length, scaled

BLOCK_BYTES = 1 << 19  # of vectors that are packed together
EPSILON = np.finfo(float).eps


def _matrix(column, length: int) -> np.ndarray:
    """An Arrow array of equally long lists as (rows, length)."""
    return column.flatten().to_numpy().reshape(-1, length)


class FitList:
    """Different vectors, packed into stored blocks, with their number and sums."""

    def __init__(self, rows: DataFrame, length: int):
        self.length, most = length, max(1, BLOCK_BYTES // (8 * max(1, length)))

        def pack(batches):
            for batch in batches:
                for at in range(0, batch.num_rows, most):
                    part = _matrix(batch.column("x").slice(at, most), length)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([len(part)], pa.int64()), pa.array([part.tobytes()], pa.binary())], names=["n", "block"]
                    )

        self.blocks = store(rows.select("x").distinct().mapInArrow(pack, schema("n bigint, block binary")))
        self.n = self.blocks.agg(F.sum("n")).first()[0] or 0
        self.sums: list[int] = []
        if self.n:
            self.sums = self._sums()
        # x - S / n as (x - whole) - rest, so that nothing is lost to the size of x
        self.whole = np.array([s // self.n for s in self.sums], np.int64)
        self.rest = np.array([(s % self.n) / self.n for s in self.sums])

    def _sums(self) -> list[int]:
        length = self.length

        def add(batches):
            total = [0] * length
            for batch in batches:
                for block in batch.column("block"):
                    part = np.frombuffer(block.as_buffer(), np.int64).reshape(-1, length)
                    total = [t + int(s) for t, s in zip(total, part.sum(axis=0))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(length), pa.int32()), pa.array(map(str, total))], names=["dim", "total"]
            )

        parts = self.blocks.select("block").mapInArrow(add, schema("dim int, total string"))
        exact = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
        return [int(r["total"]) for r in parts.groupBy("dim").agg(exact).orderBy("dim").collect()]

    def gather(self, numbers: int, of_block) -> np.ndarray:
        """Sums over all blocks of ``of_block(centred rows)``, an array of ``numbers`` numbers.

        Each task adds up its blocks and gives one array; the arrays are added in Spark.
        """
        length, whole, rest = self.length, self.whole, self.rest

        def add(batches):
            total = np.zeros(numbers)
            for batch in batches:
                for block in batch.column("block"):
                    part = np.frombuffer(block.as_buffer(), np.int64).reshape(-1, length)
                    total += of_block((part - whole).astype(float) - rest)
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["part"])

        parts = self.blocks.select("block").mapInArrow(add, schema("part array<double>"))
        summed = parts.select(F.posexplode("part").alias("at", "part")).groupBy("at").agg(F.sum("part").alias("part"))
        out = np.zeros(numbers)
        for row in summed.collect():  # as many rows as numbers
            out[row["at"]] = row["part"]
        return out


class Components(NamedTuple):
    """``vectors`` (dimensions, k) with falling ``values``; ``trace`` of the covariance; ``steps`` taken."""

    vectors: np.ndarray
    values: np.ndarray
    trace: float
    steps: int


def bidiagonalise(fit: FitList, wanted: int, seed: int = 7) -> Components:
    """The leading components of the centred rows X by Golub-Kahan-Lanczos bidiagonalisation.

    With A = X / sqrt(n), each step forms A v for the newest right vector v and, from the
    result u, the product with A's transpose; both are sums over blocks of rows, made in
    one pass. Left vectors are as long as the table, so they are never stored: each is
    A y for a short y that the driver keeps, and tasks form it again from their rows.
    Every new left and right vector is orthogonalised against all earlier ones. If a
    direction gives nothing new, a random one orthogonal to all others goes on. Steps end when the
    wanted singular values' residuals are at rounding level, at the latest after as many
    steps as there are dimensions. The small bidiagonal matrix's singular values and
    vectors give the components; as many are returned as the rank allows.
    """
    d, n = fit.length, fit.n
    random = np.random.default_rng(seed)
    trace = float(fit.gather(1, lambda x: np.array([(x * x).sum()]))[0]) / n
    right = np.zeros((d, 0))  # v
    left = np.zeros((d, 0))  # y, with u = A y
    image = np.zeros((d, 0))  # transposed A times u
    alphas: list[float] = []
    betas: list[float] = []  # betas[j] leads from u[j] to v[j + 1]
    if trace <= 0:
        return Components(np.zeros((d, 0)), np.zeros(0), 0.0, 0)

    def orthogonal(vector: np.ndarray) -> np.ndarray:
        for _ in range(2):
            vector = vector - right @ (right.T @ vector)
        return vector

    def triangle() -> np.ndarray:
        small = np.zeros((len(alphas), right.shape[1]))
        for j, alpha in enumerate(alphas):
            small[j, j] = alpha
            if j + 1 < right.shape[1]:
                small[j, j + 1] = betas[j]
        return small

    tiny = 8 * d * EPSILON * np.sqrt(trace)
    vector, beta = random.standard_normal(d), 0.0
    vector /= np.linalg.norm(vector)
    while right.shape[1] < d:
        j = len(alphas)
        right = np.column_stack([right, vector])
        way = vector - beta * left[:, -1] if j else vector
        others = left

        def products(x: np.ndarray, way=way, others=others) -> np.ndarray:
            u = x @ way
            return np.concatenate([[u @ u], u @ (x @ others), x.T @ u]) / n

        sums = fit.gather(1 + j + d, products)
        along, back = sums[1 : 1 + j], sums[1 + j :]
        alpha = np.sqrt(max(0.0, sums[0] - along @ along))
        if alpha <= tiny:
            break  # all that is left of A is zero
        left = np.column_stack([left, (way - left @ along) / alpha])
        image = np.column_stack([image, (back - image @ along) / alpha])
        alphas.append(float(alpha))
        vector = orthogonal(image[:, -1] - alpha * vector)
        beta = float(np.linalg.norm(vector))
        betas.append(beta)
        if right.shape[1] == d:
            break
        if beta <= tiny:
            betas[-1] = beta = 0.0
            vector = orthogonal(random.standard_normal(d))
            vector /= np.linalg.norm(vector)
            continue
        vector /= beta
        p, s, _ = np.linalg.svd(triangle())
        if len(s) >= wanted and np.all(beta * np.abs(p[-1, :wanted]) <= EPSILON * s[0]):
            break
    _, s, q = np.linalg.svd(triangle(), full_matrices=False)
    rank = int((s > d * EPSILON * s[0] * 8).sum()) if len(s) else 0
    k = min(wanted, rank)
    return Components(right @ q[:k].T, s[:k] ** 2, trace, len(alphas))


def whiten(
    vectors: DataFrame, k: int = 16, scale: int = 64, shift: int = 1_000_000, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """Whitened coordinates: (vec_id, component from 1, n, deviation, whitened, explained, identity_error).

    Each component c of a vector becomes the integer floor(``scale`` * c) + ``shift``; the
    fit list is each different integer vector once. One row per input row and component, up
    to ``k`` or the rank of the fit list. ``deviation`` is the exact sum of (n * x - S)^2,
    null where it exceeds a long; ``whitened`` is x - S / n along the component over the square root of
    its eigenvalue; ``identity_error`` is measured over the fit list.

    Rows whose vector is null, empty or holds a null or non-finite component are dropped, as
    are rows with another length than most. Products beyond 2**40 count as 2**40. Repeated
    rows come out each; null ids stay. A table without two different vectors has no components and
    gives no rows, as does an empty one. Other columns are not read.
    """
    v = F.col(vector_column).cast("array<double>")
    rows = vectors.select(F.col(id_column).alias("vec_id"), v.alias("v")).where(finite(F.col("v")))
    rows, length = of_common_length(rows, "v")
    rows = store(rows.select("vec_id", scaled(F.col("v"), scale, shift).alias("x")))
    kind = T.StructType([rows.schema["vec_id"]])
    more = schema("component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
    out = T.StructType([*kind.fields, *more.fields])
    fit = FitList(rows, length)
    if fit.n < 2:
        return vectors.sparkSession.createDataFrame([], out)
    found = bidiagonalise(fit, k)
    k, error = len(found.values), 0.0
    turn = found.vectors / np.sqrt(found.values)
    if k:
        spread = fit.gather(k * k, lambda x: ((x @ turn).T @ (x @ turn)).ravel()).reshape(k, k) / fit.n
        error = float(np.abs(spread - np.eye(k)).max())
    n, whole, rest = fit.n, fit.whole, fit.rest
    odd = np.array([s % n for s in fit.sums], object)
    explained = found.values / found.trace if k else found.values

    def run(batches):
        for batch in batches:
            if not batch.num_rows or not k:
                continue
            x = _matrix(batch.column("x"), length) - whole
            most = n * (int(np.abs(x).max()) + 1)
            if length * most * most < 1 << 62:
                apart = n * x - odd.astype(np.int64)
                deviation = pa.array((apart * apart).sum(axis=1))
            else:  # whole numbers of any size
                exact = (((n * x.astype(object)) - odd) ** 2).sum(axis=1)
                deviation = pa.array([int(e) if e < 1 << 63 else None for e in exact], pa.int64())
            white = (x.astype(float) - rest) @ turn
            at = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(at),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(at), n, np.int64)),
                    deviation.take(at),
                    pa.array(white.ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(at), error)),
                ],
                names=out.names,
            )

    return rows.mapInArrow(run, out)


def whitening_digest(embeddings: DataFrame) -> DataFrame:
    """Up to 16 whitened coordinates of every usable row."""
    return whiten(embeddings)

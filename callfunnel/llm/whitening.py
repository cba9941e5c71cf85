"""Whitening by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

Each entry c becomes x = floor(scale * c) + shift; distinct x vectors are the rows that are fitted.
They are stored once, centred, in blocks of bounded size (n * x - S is taken in whole numbers, so
centring loses nothing). A step multiplies the rows with the newest right vector (X v) and the
result back (X' u) in one pass. Left vectors are as long as the table and stay on the cluster: each
is kept as its coordinates y with u = X y, and a task makes its own piece of all of them again from
its block. Both sides are orthogonalised against all earlier vectors, twice where it matters.

After as many steps as there are dimensions the bidiagonal matrix holds the whole spectrum, repeated
values included: where a new right vector vanishes, the next one starts afresh orthogonally to
all before. Its small SVD turns the right vectors into components, ordered by falling eigenvalue; a
component's entry of largest magnitude is positive. The driver holds matrices of dimensions by
dimensions only. Components whose eigenvalue is zero (to rounding, 1e-12 of the largest) can't be
whitened and are not returned.

Vectors that are null, hold a null or non-finite entry, or are of another length than most take no
part (lengths tied: the shorter). Rows with a null id, repeated rows and ids keep their rows. An
empty table, or one whose fitted rows are all alike, gives an empty result. Other columns are not
read. Entries too large for a long take the end of its range; a deviation too large for one is null.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callfunnel.llm.common import drop_stored, stored

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
BLOCK_BYTES = 1 << 20  # of a block of centred rows
FLAT = 1e-12  # eigenvalues below this share of the largest count as zero
AGAIN = 1e-6  # share of a vector found along earlier ones that calls for a second pass
SAFE = 1 << 62


@dataclass
class Whitening:
    """centre (S, whole numbers) and n, components as columns, their eigenvalues, the trace of the covariance, the identity error."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): finite vectors of the commonest length, as doubles."""
    v = F.col("v")
    out = vectors.select(vectors[id_col].alias("vec_id"), vectors[vector_col].cast("array<double>").alias("v")).filter(
        v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
    lengths = out.groupBy(F.size("v").alias("length")).agg(F.count("*").alias("rows"))
    most = lengths.orderBy(F.desc("rows"), "length").first()
    return out.filter(F.size("v") == (most["length"] if most else 0))


def quantised(v):
    """floor(scale * c) + shift per entry; saturates at the ends of a long."""
    top = float(SAFE)
    return F.transform(v, lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(top)), F.lit(-top))) + SHIFT)


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def numerators(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S in whole numbers, in Python's own where 64 bits could overflow."""
    if max(int(x.max()), -int(x.min())) * n < SAFE and max(map(abs, sums)) < SAFE:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def deviations(gaps: np.ndarray) -> list:
    """Per row the exact sum of squares, null beyond a long."""
    top = int(max(abs(gaps.max()), abs(gaps.min())))
    if top * top * gaps.shape[1] < SAFE * 2:
        return (gaps.astype(np.int64) ** 2).sum(axis=1).tolist()
    return [s if (s := sum(int(g) ** 2 for g in row)) < 1 << 63 else None for row in gaps]


def centred_blocks(distinct: DataFrame, n: int, sums: list[int], width: int) -> DataFrame:
    """(block): centred rows as doubles, many to a block."""
    rows = max(1, BLOCK_BYTES // (8 * width))

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = matrix(batch.column(0).slice(at, rows))
                held.append((numerators(part, n, sums) / n).astype(np.float64))
                size += len(part)
                if size >= rows:
                    yield block(held)
                    held, size = [], 0
        if held:
            yield block(held)

    def block(held):
        return pa.RecordBatch.from_arrays([pa.array([np.concatenate(held).tobytes()], pa.binary())], ["block"])

    return distinct.mapInArrow(run, "block binary")


def summed(blocks: DataFrame, width: int, of) -> np.ndarray:
    """Sum over all blocks of the vector `of(rows, shared)`; one vector a task, added on the cluster."""
    def run(batches):
        total = None
        for batch in batches:
            for b in batch.column(0):
                part = of(np.frombuffer(b.as_buffer(), np.float64).reshape(-1, width))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["at", "value"])

    rows = blocks.mapInArrow(run, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(rows.num_rows)
    out[rows["at"].to_numpy()] = rows["value"].to_numpy()
    return out


def step(blocks: DataFrame, width: int, w: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """For p = X w: X' p, its products with the earlier left vectors X y, and its squared length."""
    spark = blocks.sparkSession
    shared = spark.sparkContext.broadcast((w, left))

    def of(x):
        w, left = shared.value
        p = x @ w
        return np.concatenate([x.T @ p, (x @ left).T @ p, [p @ p]])

    total = summed(blocks, width, of)
    shared.destroy()
    return total[:width], total[width:-1], float(total[-1])


def orthogonal(r: np.ndarray, basis: np.ndarray) -> np.ndarray:
    for _ in range(2):
        r = r - basis @ (basis.T @ r)
    return r


def bidiagonalise(blocks: DataFrame, width: int, steps: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Right vectors V (columns) and the upper bidiagonal B with X V = U B, U and V orthonormal."""
    rng = np.random.default_rng(seed)
    right, left, back = np.zeros((width, 0)), np.zeros((width, 0)), np.zeros((width, 0))  # V; U's coordinates; X' U
    small = np.zeros((steps, steps))
    v, beta, scale = rng.normal(size=width), 0.0, 0.0
    v /= np.linalg.norm(v)
    for j in range(steps):
        right = np.column_stack([right, v])
        w = v - beta * left[:, -1] if j else v
        product, along, length = step(blocks, width, w, left)
        for _ in range(2):
            # p less its part along the earlier left vectors, by linearity of all three figures
            w, product, length = w - left @ along, product - back @ along, length - along @ along
            if np.linalg.norm(along) <= AGAIN * max(scale, np.sqrt(max(length, 0.0))):
                break
            product, along, length = step(blocks, width, w, left)
        alpha = np.sqrt(max(length, 0.0))
        scale = max(scale, alpha)
        if alpha <= 1e-13 * scale or not scale:  # v is in the null space: no left vector belongs to it
            alpha, w, product = 0.0, np.zeros(width), np.zeros(width)
        else:
            w, product = w / alpha, product / alpha
        small[j, j] = alpha
        left, back = np.column_stack([left, w]), np.column_stack([back, product])
        if j + 1 == steps:
            break
        r = orthogonal(product - alpha * v, right)
        beta = float(np.linalg.norm(r))
        if beta <= 1e-13 * scale or not scale:  # an invariant subspace: go on from a new direction
            beta, r = 0.0, orthogonal(rng.normal(size=width), right)
        small[j, j + 1] = beta
        v = r / np.linalg.norm(r)
    return right, small


def fit(x: DataFrame, components: int = COMPONENTS, steps: int | None = None) -> Whitening | None:
    """Fitted to the distinct rows of `x` (a column x, array<long> of one length); None where there are no rows."""
    spark = x.sparkSession
    distinct = stored(x.select("x").distinct(), "distinct")
    sums = distinct.select(F.posexplode("x").alias("at", "value")).groupBy("at").agg(
        F.sum(F.col("value").cast("decimal(38,0)")).alias("sum"), F.count("*").alias("n")).orderBy("at").collect()  # a row a dimension
    if not sums:
        drop_stored(spark, distinct)
        return None
    n, s, width = sums[0]["n"], [int(r["sum"]) for r in sums], len(sums)
    blocks = stored(centred_blocks(distinct, n, s, width), "centred")
    right, small = bidiagonalise(blocks, width, min(width, steps or width))
    _, sigma, turn = np.linalg.svd(small)
    eigenvalues = sigma ** 2 / n
    k = int((eigenvalues > FLAT * max(eigenvalues[0], 0.0)).sum()) if eigenvalues[0] > 0 else 0
    k = min(k, components)
    found = (right @ turn.T)[:, :k]
    found = found * np.sign(found[np.abs(found).argmax(axis=0), np.arange(k)]) if k else found
    white = found / np.sqrt(eigenvalues[:k])
    shared = spark.sparkContext.broadcast(white)

    def moments(x):
        y = x @ shared.value
        return np.concatenate([[(x * x).sum()], y.sum(axis=0), (y.T @ y).ravel()])

    total = summed(blocks, width, moments)
    mean, second = total[1:k + 1] / n, total[k + 1:].reshape(k, k) / n
    error = float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max()) if k else 0.0
    drop_stored(spark, distinct, blocks)
    return Whitening(n, s, found, eigenvalues[:k], float(total[0]) / n, error)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
           steps: int | None = None) -> DataFrame:
    """Per usable row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark, kind = vectors.sparkSession, vectors.schema[id_col].dataType.simpleString()
    rows = usable(vectors, id_col, vector_col).select("vec_id", quantised(F.col("v")).alias("x"))
    layout = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    model = fit(rows, components, steps)
    if model is None or not len(model.eigenvalues):
        return spark.createDataFrame([], layout)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        k = len(m.eigenvalues)
        white = m.components / np.sqrt(m.eigenvalues)
        explained = np.array(m.eigenvalues) / m.trace
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                gaps = numerators(matrix(part.column(1)), m.n, m.sums)
                y = (gaps / m.n).astype(np.float64) @ white
                size, each = part.num_rows, np.repeat(np.arange(part.num_rows), k)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), size)),
                     pa.array(np.full(size * k, m.n)), pa.array(deviations(gaps), pa.int64()).take(pa.array(each)), pa.array(y.ravel()),
                     pa.array(np.tile(explained, size)), pa.array(np.full(size * k, m.identity_error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, layout)

"""Whitening of embeddings: principal components by spectral divide-and-conquer, applied to every row by broadcast.

The covariance is small (dimension by dimension), so its decomposition runs on the driver; everything that touches rows runs in tasks.
A symmetric matrix A is split at a shift s: the polar factor U of A - sI, by the dynamically weighted Halley iteration (QDWH), is the
matrix sign function, (U + I) / 2 projects on the eigenvalues above s, and orthonormal bases of that subspace and of its complement
give two smaller matrices, which are split in turn until single components are left.

Entries are counted in steps of 1/64 (``x``), so counts, sums and deviations are exact integers.  The model is fitted on each distinct
vector once; partial matrices are added up in a tree, and at most ``FAN`` of them reach the driver.

Defined results: vectors that are null, empty, or hold null, non-finite or enormous (2^53 and more) entries are left out, and so are
vectors of another length than the most frequent one (of equally frequent ones, the shortest).  Components without variance (below the rounding of the
largest) whiten to 0 and take no part in the identity error.  A deviation beyond 64 bits is null.  Without usable vectors there is no
model and no row comes back.  Null ids and repeated rows are whitened row by row; extra columns are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimloom.sources.settle import settle

STEPS, OFFSET, LARGEST = 64, 1_000_000, 2.0**53
#: Partial results that one task, and in the end the driver, adds up.
FAN = 32
EPS = np.finfo(float).eps


# ---------------------------------------------------------------- decomposition

def polar(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix, by the QDWH iteration; cubic convergence, six steps at most in theory."""
    m = len(a)
    x = a / np.linalg.norm(a)
    try:
        low = 1.0 / (np.linalg.norm(np.linalg.inv(x), 1) * np.sqrt(m))
    except np.linalg.LinAlgError:
        low = 0.0
    low = min(max(low, EPS), 1.0)
    for _ in range(30):
        d = np.cbrt(4.0 * max(1.0 - low**2, 0.0) / low**4)
        root = np.sqrt(1.0 + d)
        alpha = root + 0.5 * np.sqrt(max(8.0 - 4.0 * d + 8.0 * (2.0 - low**2) / (low**2 * root), 0.0))
        beta = (alpha - 1.0) ** 2 / 4.0
        gamma = alpha + beta - 1.0
        before = x
        if gamma > 100.0:  # badly conditioned still: by QR
            q, _ = np.linalg.qr(np.vstack([np.sqrt(gamma) * x, np.eye(m)]))
            x = beta / gamma * x + (alpha - beta / gamma) / np.sqrt(gamma) * (q[:m] @ q[m:].T)
        else:
            z = np.eye(m) + gamma * (x.T @ x)
            x = beta / gamma * x + (alpha - beta / gamma) * np.linalg.solve(z, x.T).T
        x = (x + x.T) / 2.0
        low = min(low * (alpha + beta * low**2) / (1.0 + gamma * low**2), 1.0)
        if np.linalg.norm(x - before) <= np.cbrt(4.0 * EPS) and abs(1.0 - low) <= 10.0 * EPS:
            break
    return x


def _bases(a: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below the shift; None where it does not split them cleanly."""
    m = len(a)
    u = polar(a - shift * np.eye(m))
    above = int(round((np.trace(u) + m) / 2.0))
    if not 0 < above < m or np.linalg.norm(u @ u - np.eye(m)) > 1e-8:
        return None
    up, down = (np.eye(m) + u) / 2.0, (np.eye(m) - u) / 2.0
    q, _ = np.linalg.qr(up @ np.random.default_rng(m).standard_normal((m, above)), mode="complete")
    # One more step of subspace iteration takes what the first basis holds of the other subspace.
    q, _ = np.linalg.qr(np.hstack([up @ q[:, :above], down @ q[:, above:]]))
    return q[:, :above], q[:, above:]


def _split(a: np.ndarray, basis: np.ndarray, scale: float, found: list[np.ndarray]) -> None:
    todo = [(a, basis)]
    while todo:
        a, basis = todo.pop()
        m = len(a)
        off = a - np.diag(np.diag(a))
        if m == 1 or np.abs(off).max() <= EPS * scale:
            found.append(basis)
            continue
        mean = np.trace(a) / m
        spread = max(np.linalg.norm(a - mean * np.eye(m)) / np.sqrt(m), EPS * scale)
        # The median of the diagonal halves the work; the mean lies strictly inside every spectrum of unlike eigenvalues.
        shifts = [float(np.median(np.diag(a))), mean, *[mean + f * spread for f in (0.05, -0.05, 0.13, -0.13, 0.31, -0.31, 0.7, -0.7)]]
        halves = next((b for s in shifts if (b := _bases(a, s)) is not None), None)
        if halves is None:  # eigenvalues alike to the last digits: any basis will do
            found.append(basis)
            continue
        for q in halves:
            part = q.T @ a @ q
            todo.append(((part + part.T) / 2.0, basis @ q))


def components_of(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as rows."""
    v = (v + v.T) / 2.0
    scale = float(np.linalg.norm(v))
    if scale == 0.0:
        return np.zeros(len(v)), np.eye(len(v))
    found: list[np.ndarray] = []
    _split(v / scale, np.eye(len(v)), 1.0, found)
    vectors = np.hstack(found)
    values = np.einsum("ij,ij->j", vectors, v @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order].T / np.linalg.norm(vectors[:, order], axis=0)[:, None]


# ---------------------------------------------------------------- rows

def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) >= LARGEST))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & ~bad, F.lit(False))


def entries(vector: Column) -> Column:
    """The vector in whole steps."""
    return F.transform(vector, lambda c: F.floor(F.lit(float(STEPS)) * c.cast("double")) + F.lit(OFFSET).cast("bigint"))


def _rows_of(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _summed(rows: DataFrame, kernel: Callable[[np.ndarray], np.ndarray], size: int, shape: tuple[int, ...], kind: str) -> np.ndarray:
    """The kernel's results, summed: one partial per task, added up ``FAN`` at a time, so that few reach the driver."""
    def partial(batches):
        total = np.zeros(shape, kind)
        for batch in batches:
            if batch.num_rows:
                total += kernel(_rows_of(batch.column(0), size))
        yield pa.RecordBatch.from_pydict({"part": [total.tobytes()]})

    def again(batches):
        total = np.zeros(shape, kind)
        for batch in batches:
            for piece in batch.column(0).to_pylist():
                total += np.frombuffer(piece, kind).reshape(shape)
        yield pa.RecordBatch.from_pydict({"part": [total.tobytes()]})

    parts, n = rows.mapInArrow(partial, "part binary"), rows.rdd.getNumPartitions()
    while n > FAN:
        n = -(-n // FAN)
        parts = parts.repartition(n).mapInArrow(again, "part binary")
    total = np.zeros(shape, kind)
    for row in parts.collect():
        total += np.frombuffer(row[0], kind).reshape(shape)
    return total


@dataclass(frozen=True)
class Model:
    n: int
    sums: np.ndarray  # long, by dimension
    values: np.ndarray  # eigenvalues of all components, falling
    vectors: np.ndarray  # unit eigenvectors as rows
    trace: float
    kept: int
    identity_error: float

    @property
    def projection(self) -> np.ndarray:
        """Dimensions by components; zero for components without variance."""
        e = self.values[:self.kept]
        live = e > len(self.values) * EPS * max(self.values[0], 0.0)
        return self.vectors[:self.kept].T * np.where(live, 1.0 / np.sqrt(np.where(live, e, 1.0)), 0.0)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S/n; the difference is taken in whole numbers, before the division."""
    return (n * x - sums) / float(n)


def fit(rows: DataFrame, column: str = "embedding", kept: int = 16) -> Model | None:
    """Components of the distinct vectors of ``column``; ``kept`` of them are whitened to."""
    fine = rows.select(F.col(column).alias("v")).filter(usable(F.col("v")))
    most = fine.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if most is None:
        return None
    d = int(most["size"])
    distinct = settle(fine.filter(F.size("v") == d).select(entries(F.col("v")).alias("x")).distinct(), "vectors")
    n, *sums = _summed(distinct, lambda x: np.concatenate([[len(x)], x.sum(axis=0)]), d, (d + 1,), "int64").tolist()
    s = np.array(sums, "int64")
    v = _summed(distinct, lambda x: (y := _centred(x, n, s)).T @ y, d, (d, d), "float64") / n
    values, vectors = components_of(v)
    model = Model(n, s, values, vectors, float(np.trace(v)), min(kept, d), 0.0)
    w = model.projection
    k = model.kept

    def moments(x: np.ndarray) -> np.ndarray:
        y = _centred(x, n, s) @ w
        return np.vstack([y.sum(axis=0), y.T @ y])

    got = _summed(distinct, moments, d, (k + 1, k), "float64") / n
    live = np.abs(w).sum(axis=0) > 0
    error = np.abs(got[1:] - np.outer(got[0], got[0]) - np.eye(k))[np.ix_(live, live)]
    return Model(n, s, values, vectors, model.trace, k, float(error.max(initial=0.0)))


def _deviation(y: np.ndarray) -> list[int | None]:
    if len(y) == 0:
        return []
    if float(np.abs(y).max(initial=0)) ** 2 * y.shape[1] < 2.0**62:
        return (y * y).sum(axis=1).tolist()
    whole = [sum(int(e) ** 2 for e in row) for row in y]
    return [t if t < 2**63 else None for t in whole]


def whiten(rows: DataFrame, model: Model | None, column: str = "embedding") -> DataFrame:
    """(row, deviation, whitened): each usable row as a struct, its exact squared distance from the mean times n², its whitened vector."""
    out = rows.select(F.struct("*").alias("row"))
    if model is None:
        return out.filter(F.lit(False)).select("row", F.lit(None).cast("bigint").alias("deviation"), F.lit(None).cast("array<double>").alias("whitened"))
    n, sums, d, w = model.n, model.sums, len(model.sums), model.projection

    @F.pandas_udf("deviation bigint, whitened array<double>")
    def run(x: pd.Series) -> pd.DataFrame:
        y = n * (np.stack(x.to_list()) if len(x) else np.zeros((0, d), "int64")) - sums
        return pd.DataFrame({"deviation": pd.array(_deviation(y), "Int64"), "whitened": list((y / float(n)) @ w)})

    vector = F.col("row").getField(column)
    fine = out.filter(usable(vector) & (F.size(vector) == d))
    return fine.select("row", run(entries(vector)).alias("w")).select("row", "w.deviation", "w.whitened")


def components(rows: DataFrame, model: Model | None) -> DataFrame:
    """One row per vector and component, with what the model says of the component."""
    white = whiten(rows.select("vec_id", "embedding"), model).select(
        F.col("row.vec_id").alias("vec_id"), "deviation", F.posexplode("whitened").alias("at", "whitened"))
    if model is None:
        shares, n, error = [], 0, 0.0
    else:
        shares = [float(e) / model.trace if model.trace > 0 else 0.0 for e in model.values[:model.kept]]
        n, error = model.n, model.identity_error
    return white.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
        F.element_at(F.array(*[F.lit(s) for s in shares or [0.0]]), F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error"))

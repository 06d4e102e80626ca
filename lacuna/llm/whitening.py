"""Embedding whitening: distributed centred covariance, eigenvectors of the tridiagonal form, projection.

Vectors become whole numbers. The list that the covariance is over holds each distinct vector once; its
count and per-dimension sums are exact, and each task subtracts the mean before it multiplies. Tasks
hand on one triangle of products, which Spark adds up, so the driver gets d (d + 1) / 2 numbers for
d dimensions, however many vectors there are. There Householder reflections bring the covariance to
tridiagonal form, bisection on Sturm counts finds the leading eigenvalues, inverse iteration their
vectors (made orthogonal within a cluster), and the reflections take these back. The projection, d
numbers for a component, goes to all tasks with the plan.

Rows: vectors that are null or hold a null or non-finite entry are left out. Shorter vectors count as
padded with zeros to the longest. Repeated rows, rows without vec_id and equal vectors under several
ids all get rows of their own; equal vectors are fitted once. An empty table, or one of empty
vectors only, gives no rows. Of a component without variance (at most d times the rounding unit of
the largest) ``whitened`` is null; without any variance ``explained`` and ``identity_error`` are null too.
Entries or deviations beyond a long raise an error. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lacuna.llm.topk import usable
from lacuna.session import cut_lineage

EPS = float(np.finfo(np.float64).eps)


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the unit vectors of the Householder reflections of a symmetric matrix."""
    a, d = np.array(a, np.float64), len(a)
    off, mirrors = np.zeros(max(0, d - 1)), []
    for k in range(d - 1):
        x = a[k + 1:, k].copy()
        length = np.linalg.norm(x)
        off[k] = x[0]
        v = np.zeros(d - k - 1)
        if k < d - 2 and np.any(x[1:]):
            off[k] = -np.copysign(length, x[0])
            x[0] -= off[k]
            v = x / np.linalg.norm(x)
            p = a[k + 1:, k + 1:] @ v
            q = p - (v @ p) * v
            a[k + 1:, k + 1:] -= 2 * (np.outer(v, q) + np.outer(q, v))
        mirrors.append(v)
    return np.diag(a).copy(), off, mirrors


def sturm_count(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix lie below each of ``at``: sign changes of the Sturm sequence."""
    tiny = np.finfo(np.float64).tiny / EPS
    count, q = np.zeros(len(at), np.int64), np.ones(len(at))
    for i, x in enumerate(diagonal):
        q = x - at - (off[i - 1] ** 2 / q if i else 0)
        q = np.where(np.abs(q) < tiny, -tiny, q)
        count += q < 0
    return count


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, by bisection down to neighbouring doubles."""
    d = len(diagonal)
    reach = np.abs(np.concatenate([[0], off])) + np.abs(np.concatenate([off, [0]]))
    width = np.max(np.abs(diagonal) + reach) * 4 * EPS
    low, high = np.full(k, np.min(diagonal - reach) - width), np.full(k, np.max(diagonal + reach) + width)
    place = d - 1 - np.arange(k)  # eigenvalues below the wanted one
    for _ in range(200):
        middle = low + (high - low) / 2
        if np.all((middle <= low) | (middle >= high)):
            break
        above = sturm_count(diagonal, off, middle) > place
        low, high = np.where(above, low, middle), np.where(above, middle, high)
    return low + (high - low) / 2


def _solve(diagonal: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray, least: float) -> np.ndarray:
    """(T - shift) x = b by elimination with row exchanges; pivots of at least ``least``."""
    d = len(diagonal)
    main, up, up2, b = diagonal - shift, np.append(off, 0.0), np.zeros(d), b.copy()
    for i in range(d - 1):
        below, nxt, after = off[i], main[i + 1], up[i + 1]
        if abs(below) > abs(main[i]):
            # the row below becomes the pivot row
            f = main[i] / below
            main[i], up_i, up2[i] = below, nxt, after
            main[i + 1], up[i + 1] = up[i] - f * nxt, -f * after
            up[i] = up_i
            b[i], b[i + 1] = b[i + 1], b[i] - f * b[i + 1]
        else:
            if abs(main[i]) < least:
                main[i] = least
            f = below / main[i]
            main[i + 1] = nxt - f * up[i]
            b[i + 1] -= f * b[i]
    x = np.zeros(d)
    for i in range(d - 1, -1, -1):
        pivot = main[i] if abs(main[i]) >= least else least
        x[i] = (b[i] - (up[i] * x[i + 1] if i + 1 < d else 0) - (up2[i] * x[i + 2] if i + 2 < d else 0)) / pivot
    return x


def _orthogonal(x: np.ndarray, to: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for v in to:
            x = x - (v @ x) * v
    return x


def eigenvectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (rows) of falling eigenvalues by inverse iteration; those of a cluster, values
    within a thousandth of the norm of their neighbour, are kept orthogonal to each other."""
    norm = float(np.max(np.abs(diagonal), initial=0) + 2 * np.max(np.abs(off), initial=0)) or 1.0
    draw, out, cluster, shift = np.random.default_rng(1), [], 0, 0.0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * norm:
            cluster = j
        shift = min(float(value), shift - 10 * EPS * norm) if j > cluster else float(value)
        x = draw.normal(size=len(diagonal))
        for _ in range(6):
            x = _orthogonal(_solve(diagonal, off, shift, x / np.linalg.norm(x), EPS * norm), out[cluster:])
        out.append(x / np.linalg.norm(x))
    return np.array(out).reshape(len(values), len(diagonal))


def leading_components(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as rows."""
    size = float(np.max(np.abs(a), initial=0)) or 1.0
    diagonal, off, mirrors = tridiagonal(a / size)
    values = leading_eigenvalues(diagonal, off, min(k, len(a)))
    vectors = eigenvectors(diagonal, off, values)
    for i in range(len(mirrors) - 1, -1, -1):
        v = mirrors[i]
        vectors[:, i + 1:] -= 2 * np.outer(vectors[:, i + 1:] @ v, v)
    return values * size, vectors


def quantised(vector: Column, scale: float = 256) -> Column:
    """floor(scale * x) of each entry as long."""
    def whole(x):
        y = F.lit(float(scale)) * x.cast("double")
        return F.when(F.abs(y) < float(1 << 62), F.floor(y)).otherwise(F.raise_error(F.lit("entry beyond a long")).cast("long"))

    return F.transform(vector, whole)


def _rows(vectors: DataFrame, scale: float) -> DataFrame:
    return vectors.filter(usable(F.col("embedding"))).select(F.col("vec_id").cast("long").alias("vec_id"), quantised(F.col("embedding"), scale).alias("x"))


def _padded(rows: DataFrame, d: int) -> DataFrame:
    zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(d) - F.size("x"))
    return rows.withColumn("x", F.when(F.size("x") < d, F.concat("x", zeros)).otherwise(F.col("x")))


def _matrix(column: pa.ListArray, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)


@dataclass(frozen=True)
class Whitening:
    """What a list of distinct vectors gives: its count, sums, leading eigenvalues, components (rows),
    the trace of the covariance, and how far the whitened list's covariance is from the identity."""
    n: int
    sums: list[int]
    biggest: int
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float | None

    def scales(self) -> np.ndarray:
        """One over the root of each eigenvalue; NaN for a component without variance."""
        some = self.values > len(self.sums) * EPS * np.max(self.values, initial=0)
        return np.where(some, 1 / np.sqrt(np.where(some, self.values, 1)), np.nan)


def _moments(fit: DataFrame, d: int) -> tuple[int, list[int], int]:
    """Count, exact sums of each dimension and the largest absolute entry."""
    def run(batches):
        for b in batches:
            if len(b):
                x = _matrix(b.column(0), d)
                sums = x.sum(axis=0, dtype=np.int64) if len(x) * (int(np.abs(x).max()) + 1) < 1 << 63 else x.astype(object).sum(axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([len(x)] * d, pa.int64()),
                                                  pa.array([str(s) for s in sums]), pa.array(np.abs(x).max(axis=0), pa.int64())], ["i", "n", "s", "top"])

    parts = fit.mapInArrow(run, "i int, n long, s string, top long")
    found = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.max("top").alias("top")).collect()
    found.sort(key=lambda r: r.i)  # a row for each dimension
    return found[0].n, [int(r.s) for r in found], max(r.top for r in found)


def _covariance(fit: DataFrame, n: int, sums: list[int], project: np.ndarray | None = None) -> np.ndarray:
    """Covariance, divisor n, of the centred vectors or of their projections (columns of ``project``)."""
    d = len(sums)
    mean = np.array([s / n for s in sums])
    size = d if project is None else project.shape[1]
    upper = np.triu_indices(size)

    def run(batches):
        total = np.zeros((size, size))
        for b in batches:
            for at in range(0, len(b), 4096):
                y = _matrix(b.column(0).slice(at, 4096), d) - mean
                y = y if project is None else y @ project
                total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()), pa.array(total[upper])], ["i", "j", "v"])

    sums_ = fit.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((size, size))
    for r in sums_.collect():  # one triangle
        out[r.i, r.j] = out[r.j, r.i] = r.v / n
    return out


def fit(vectors: DataFrame, components: int = 4, scale: float = 256) -> Whitening | None:
    """The whitening of the distinct vectors of ``vectors.embedding``; None if there is nothing to fit."""
    distinct = cut_lineage(_rows(vectors, scale).select("x").distinct())
    lengths = distinct.agg(F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("most")).first()
    if not lengths.most:
        return None
    d = lengths.most
    if lengths.least < d:
        distinct = cut_lineage(_padded(distinct, d).distinct())
    n, sums, biggest = _moments(distinct, d)
    covariance = _covariance(distinct, n, sums)
    values, vectors_ = leading_components(covariance, components)
    found = Whitening(n, sums, biggest, values, vectors_, float(np.trace(covariance)), None)
    scales = found.scales()
    some = ~np.isnan(scales)
    if not some.any():
        return found
    project = (vectors_[some] * scales[some, None]).T
    error = float(np.abs(_covariance(distinct, n, sums, project) - np.eye(int(some.sum()))).max())
    return Whitening(n, sums, biggest, values, vectors_, found.trace, error)


def deviations(x: np.ndarray, n: int, sums: list[int], biggest: int) -> np.ndarray:
    """Sum over dimensions of (n x - S)^2, exact."""
    if len(sums) * (n * biggest + max(map(abs, sums), default=0)) ** 2 < 1 << 63:
        m = n * x - np.array(sums, np.int64)
        return (m * m).sum(axis=1)
    m = n * x.astype(object) - np.array(sums, object)
    found = (m * m).sum(axis=1)
    if any(v >= 1 << 63 for v in found):
        raise ArithmeticError("deviation beyond a long")
    return found.astype(np.int64)


OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def apply(vectors: DataFrame, found: Whitening | None, scale: float = 256) -> DataFrame:
    """A row for each usable vector and component: vec_id, component (from 1), n, deviation, whitened, explained, identity_error."""
    if found is None:
        return vectors.sparkSession.createDataFrame([], OUT)
    d, k = len(found.sums), len(found.values)
    mean = np.array([s / found.n for s in found.sums])
    project = (found.components * np.nan_to_num(found.scales())[:, None]).T
    none = np.isnan(found.scales())
    explained = found.values / found.trace if found.trace > 0 else None

    def run(batches):
        for b in batches:
            for at in range(0, len(b), 4096):
                part = b.slice(at, 4096)
                m, x = len(part), _matrix(part.column(1), d)
                white = np.zeros((m, k))
                for i in range(d):  # in one order for every row, so equal vectors get equal values to the last bit
                    white += (x[:, i, None] - mean[i]) * project[i]
                white = white.ravel()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                     pa.array(np.full(m * k, found.n)), pa.array(np.repeat(deviations(x, found.n, found.sums, found.biggest), k)),
                     pa.array(white, mask=np.tile(none, m)), pa.nulls(m * k, pa.float64()) if explained is None else pa.array(np.tile(explained, m)),
                     pa.array([found.identity_error] * (m * k), pa.float64())],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return _padded(_rows(vectors, scale), d).mapInArrow(run, OUT)


def whiten(vectors: DataFrame, components: int = 4, scale: float = 256) -> DataFrame:
    """``apply`` of the whitening fitted on ``vectors`` (vec_id, embedding) itself."""
    return apply(vectors, fit(vectors, components, scale), scale)

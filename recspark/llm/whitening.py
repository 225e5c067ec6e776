"""Embedding whitening by QDWH spectral divide and conquer.

The covariance of the distinct quantised vectors is summed by the tasks, each over its own rows, and added up by cell; the driver holds one
matrix of dimensions x dimensions.  Its leading eigenvectors come from spectral divide and conquer: the polar factor U of the shifted
covariance (QDWH, the dynamically weighted Halley iteration) gives the projector (U + I) / 2 on the invariant subspace of the
eigenvalues above the shift, an orthonormal basis of it and of its complement splits the matrix into two smaller ones, and these
are split again until single components are left; subspaces below the components asked for are not entered.  The components over the
roots of their eigenvalues are broadcast (dimensions x components numbers) and every row is projected in its task.

Only the distinct vectors are shuffled, pre-aggregated before it, so a vector that a third of all rows hold moves once per task.

Figures: x = floor(scale * c) + offset is a long; n is the number of distinct vectors x and S their sum per dimension, both exact; the
covariance sums products of (n * x - S) / n, so it is centred first, from exact integers, and rounded once per entry.

Defined cases: rows whose vector is null, empty or holds null or non-finite entries are dropped, and so are rows with an entry too large
for x to be a long (|scale * c| of 2^62 or more) and rows whose length is not that of most rows (of equally frequent lengths the longer counts),
as they have no place in one covariance.  Components without variance (an eigenvalue within rounding of zero: at most dimensions * 2^-52 times
the largest) have no whitened value and no rows, so a table with fewer than two distinct vectors gives an empty result.  Repeated rows count once
in the covariance and each get their rows; null ids stay; equal eigenvalues get an arbitrary orthonormal basis, the same for all rows; a
deviation that does not fit in a long is null; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.functions.shipping import ship_by_value
from recspark.llm.common import col
from recspark.session import materialize

ship_by_value(__name__)

RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
EPS = 2.0 ** -52
SAFE = 1 << 62


# ---- the spectral part, on one matrix of dimensions x dimensions ----

def polar_factor(a: np.ndarray) -> np.ndarray:
    """The symmetric orthogonal factor U of a symmetric matrix a = U H, by the QDWH iteration."""
    m = len(a)
    x = a / np.abs(a).sum(axis=1).max()
    low, eye = EPS, np.eye(m)  # a lower bound of the smallest singular value of x, as far as doubles can tell
    for _ in range(30):
        l2 = low * low
        d = np.cbrt(4 * (1 - l2) / (l2 * l2))
        g = math.sqrt(1 + d) + 0.5 * math.sqrt(8 - 4 * d + 8 * (2 - l2) / (l2 * math.sqrt(1 + d)))
        b = (g - 1) ** 2 / 4
        c = g + b - 1
        if c > 100:  # by QR while the weights are large
            q, _ = np.linalg.qr(np.vstack([math.sqrt(c) * x, eye]))
            y = (b / c) * x + (g - b / c) / math.sqrt(c) * (q[:m] @ q[m:].T)
        else:
            y = (b / c) * x + (g - b / c) * np.linalg.solve(eye + c * (x @ x), x)
        y = (y + y.T) / 2
        moved, x = np.linalg.norm(y - x), y
        low = min(1.0, low * (g + b * l2) / (1 + c * l2))
        if moved <= 4 * EPS * m and abs(low - 1) < 10 * EPS * m:
            break
    return x


def _split(a: np.ndarray, shift: float):
    """Orthonormal bases of the invariant subspaces above and below ``shift``, or None if the shift does not tell them apart."""
    m = len(a)
    projector = (polar_factor(a - shift * np.eye(m)) + np.eye(m)) / 2
    k = int(round(np.trace(projector)))
    if not 0 < k < m:
        return None
    q = np.linalg.qr(np.random.default_rng(m).standard_normal((m, m)))[0]
    for _ in range(2):  # the second pass mends what a poor start loses
        q = np.linalg.qr(np.hstack([projector @ q[:, :k], q[:, k:] - projector @ q[:, k:]]))[0]
    up, down = q[:, :k], q[:, k:]
    return (up, down) if np.linalg.norm(down.T @ a @ up) <= 50 * m * EPS * np.linalg.norm(a) else None


def _shifts(a: np.ndarray):
    """Candidates inside the spectrum: the median of the diagonal, the mean eigenvalue, and points around it."""
    m, diagonal = len(a), np.diag(a)
    mean = diagonal.mean()
    spread = np.linalg.norm(a - mean * np.eye(m)) / math.sqrt(m)  # of the eigenvalues about their mean
    yield float(np.median(diagonal))
    for step in (0.0, 0.11, -0.13, 0.29, -0.31, 0.53, -0.59, 0.03, -0.05, 0.83, -0.89):
        yield float(mean + step * spread)


def leading_components(a: np.ndarray, want: int, floor: float | None = None) -> np.ndarray:
    """Orthonormal eigenvectors (columns) of the ``want`` largest eigenvalues of a symmetric matrix, by falling eigenvalue."""
    m = len(a)
    floor = EPS * np.linalg.norm(a) if floor is None else floor
    if want <= 0:
        return np.zeros((m, 0))
    if m == 1 or np.linalg.norm(a - np.trace(a) / m * np.eye(m)) <= floor:  # one eigenvalue as far as doubles can tell
        return np.eye(m)[:, :want]
    parts = next((p for p in map(lambda s: _split(a, s), _shifts(a)) if p is not None), None)
    if parts is None:
        raise ArithmeticError("no shift splits the spectrum")
    out = []
    for basis in parts:
        inner = basis.T @ a @ basis
        out.append(basis @ leading_components((inner + inner.T) / 2, min(want, basis.shape[1]), floor))
        want -= out[-1].shape[1]
    return np.hstack(out)


def spectrum(v: np.ndarray, want: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors as columns) of the components with variance, at most ``want``, by falling eigenvalue."""
    if not v.any():
        return np.zeros(0), np.zeros((len(v), 0))
    q = leading_components(v, min(want, len(v)))
    e = np.einsum("ij,ij->j", q, v @ q)
    order = np.argsort(-e, kind="stable")
    e, q = e[order], q[:, order]
    keep = e > len(v) * EPS * e[0]
    e, q = e[keep], q[:, keep]
    return e, q * np.sign(q[np.abs(q).argmax(axis=0), np.arange(len(e))])  # the largest entry of a component is positive


# ---- the distributed part ----

def _matrix(batch, dims: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(-1, dims)


def _spread(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: as longs, or as Python integers where longs could overflow."""
    if len(x) and max(int(x.max()), -int(x.min())) * n + max(map(abs, sums)) >= SAFE:
        return x.astype(object) * n - np.array(sums, object)
    return x * n - np.array(sums, np.int64)


def _summer(dims: int):
    def sums(batches):
        rows, total = 0, np.zeros(dims, object)
        for batch in batches:
            x = _matrix(batch, dims)
            rows += len(x)
            small = len(x) == 0 or max(int(x.max()), -int(x.min())) * len(x) < SAFE
            total = total + (x.sum(axis=0).astype(object) if small else x.astype(object).sum(axis=0))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array([rows] * dims, pa.int64()),
                                              pa.array([str(t) for t in total], pa.string())], names=["dim", "rows", "total"])

    return sums


def _gram(project, cells: int):
    """Sums of the products of the columns of ``project(batch)``, and of the columns, over a task's rows: one row per cell."""

    def gram(batches):
        total = np.zeros((cells + 1, cells), np.float64)
        seen = False
        for batch in batches:
            y = project(batch)
            total[:cells] += y.T @ y
            total[cells] += y.sum(axis=0)
            seen = seen or len(y) > 0
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], names=["cell", "value"])

    return gram


def _covariance(fit: DataFrame, project, cells: int, n: int) -> np.ndarray:
    """Covariance of the centred columns ``project(batch)`` over the fit list; what rounding leaves of their mean is taken off."""
    rows = fit.mapInArrow(_gram(project, cells), "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    total = np.zeros((cells + 1) * cells)
    for cell, value in rows:
        total[cell] = value
    total = total.reshape(cells + 1, cells) / n
    return total[:cells] - np.outer(total[cells], total[cells])


def _whitener(plan):
    def whiten(batches):
        n, sums, axes, explained, error = plan.value
        k, dims = len(explained), len(sums)
        for batch in batches:
            d = _spread(_matrix(batch, dims), n, sums)
            rows = len(d)
            if d.dtype == object or (rows and int(np.abs(d).max()) ** 2 * dims >= SAFE):
                squares = [(lambda v: v if v < 1 << 63 else None)(sum(int(e) ** 2 for e in r)) for r in d]
                deviation = pa.array([v for v in squares for _ in range(k)], pa.int64())
            else:
                deviation = pa.array(np.repeat((d * d).sum(axis=1), k))
            ids = batch.column("vec_id").take(pa.array(np.repeat(np.arange(rows), k)))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, n, np.int64)), deviation,
                 pa.array((d.astype(np.float64) / n @ axes).ravel()), pa.array(np.tile(explained, rows)), pa.array(np.full(rows * k, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return whiten


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: float, offset: int) -> DataFrame:
    """(vec_id, x) of the rows that have a place in the covariance; see the module's defined cases."""
    v = col(vector_col)
    fits = F.forall("v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c * F.lit(float(scale))) < F.lit(float(SAFE))), F.lit(False)))
    rows = (vectors.select(col(id_col).cast("long").alias("vec_id"), v.cast("array<double>").alias("v")).where(F.size("v") > 0).where(fits)
            .select("vec_id", F.transform("v", lambda c: F.floor(c * F.lit(float(scale))) + F.lit(int(offset))).alias("x")))
    sizes = rows.groupBy(F.size("x").alias("dims")).agg(F.count(F.lit(1)).alias("rows"))
    most = sizes.orderBy(F.desc("rows"), F.desc("dims")).first()
    return rows.where(F.size("x") == (most["dims"] if most else 0))


def whiten(vectors: DataFrame, components: int = 16, scale: float = 64.0, offset: int = 1_000_000, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """One row per kept input row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = vectors.sparkSession
    rows = quantised(vectors, id_col, vector_col, scale, offset)
    fit = materialize(rows.select("x").distinct(), "whitening-fit")
    first = fit.first()
    if first is None:
        return spark.createDataFrame([], RESULT)
    dims = len(first["x"])
    found = (fit.mapInArrow(_summer(dims), "dim int, rows long, total string").groupBy("dim")
             .agg(F.sum("rows").alias("rows"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).orderBy("dim").collect())  # a row per dimension
    n, sums = int(found[0]["rows"]), [int(r["total"]) for r in found]
    centred = lambda batch: _spread(_matrix(batch, dims), n, sums).astype(np.float64) / n
    v = _covariance(fit, centred, dims, n)
    v = (v + v.T) / 2
    e, q = spectrum(v, components)
    if not len(e):
        return spark.createDataFrame([], RESULT)
    axes = q / np.sqrt(e)
    error = float(np.abs(_covariance(fit, lambda batch: centred(batch) @ axes, len(e), n) - np.eye(len(e))).max())
    plan = spark.sparkContext.broadcast((n, sums, axes, e / np.trace(v), error))
    return rows.mapInArrow(_whitener(plan), RESULT)

"""Operator 12: whitening of embeddings by their leading principal components.

Entries are fixed-point integers, x = floor(256 * c).  The covariance is fitted on
the distinct vectors: tasks sum exact integers, then products of entries that are
centred beforehand; what reaches the driver is one d x d matrix, whatever the number
of rows.  There Householder reflections make it tridiagonal, Sturm counts bisect the
leading eigenvalues, inverse iteration gives their vectors, orthogonalised again
within clusters of close eigenvalues, and the reflections are undone.  The
components (d x k numbers) go to the tasks, which project every row.

Skew: copies of a vector collapse in partial sums before the shuffle; nothing is
grouped by a key of the data afterwards.

Defined results: rows whose vector is null or holds a null, NaN or infinite entry
are dropped; a vector shorter than the longest is filled with zeros; entries beyond
the range of a long stay at its ends; components whose eigenvalue is zero up to
rounding are left out, so equal vectors, one vector or an empty table give no rows;
a deviation beyond a long is null; rows with equal or null ids stay separate rows;
other columns are ignored.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milepost.llm.common import map_batches, read_table
from milepost.session import ensure_checkpoint_dir, remove_folder

COMPONENTS = 4
SCALE = 256
ROWS = 4096  # vectors multiplied at once


def fixed_point(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                scale: int = SCALE) -> DataFrame:
    """vec_id, x (array of long) of the rows whose vector is whole."""
    v = F.col("v")
    whole = v.isNotNull() & ~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")) \
        .where(F.coalesce(whole, F.lit(False))) \
        .select("vec_id", F.transform("v", lambda c: F.floor(c * float(scale))).alias("x"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    """Rows of equal length d; shorter ones end in zeros."""
    off = np.asarray(column.offsets)
    flat = column.values.to_numpy(zero_copy_only=False)
    size = np.diff(off)
    if (size == d).all():
        return flat[off[0]:off[-1]].reshape(-1, d)
    out = np.zeros((len(size), d), np.int64)
    at = np.arange(d) < size[:, None]
    out[at] = flat[off[0]:off[-1]]
    return out


def _blocks(batches, d: int):
    for batch in batches:
        for i in range(0, batch.num_rows, ROWS):
            part = batch.slice(i, ROWS)
            yield part, _matrix(pa.concat_arrays([part.column("x")]), d)


def _sums(fit: DataFrame) -> tuple[int, list[int]]:
    """n and the exact sum of each dimension."""
    d = fit.agg(F.max(F.size("x"))).first()[0] or 0
    n = fit.count()
    if not n or not d:
        return n, []

    def run(batches):
        total = [0] * d
        for _, x in _blocks(batches, d):
            if np.abs(x).max(initial=0) < 1 << 50:  # a block's sum fits a long
                total = [t + s for t, s in zip(total, x.sum(axis=0).tolist())]
            else:
                total = [t + sum(c) for t, c in zip(total, x.T.tolist())]
        yield pa.RecordBatch.from_pydict({"dim": pa.array(range(d), pa.int32()),
                                          "total": pa.array([str(t) for t in total], pa.string())})

    parts = map_batches(fit.select("x"), run, "dim int, total string")
    rows = parts.groupBy("dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    return n, [int(r.total) for r in sorted(rows, key=lambda r: r.dim)]


def _outer(fit: DataFrame, d: int, values, k: int) -> np.ndarray:
    """Sum over all vectors of the outer products of ``values(x)`` (k numbers each)."""
    def run(batches):
        total = np.zeros((k, k))
        for _, x in _blocks(batches, d):
            y = values(x)
            total += y.T @ y
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(k), pa.int32()),
                                          "row": pa.array(list(total), pa.list_(pa.float64()))})

    parts = map_batches(fit.select("x"), run, "i int, row array<double>")
    cells = parts.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    rows = cells.groupBy("i").agg(F.sort_array(F.collect_list(F.struct("j", "v"))).alias("row")).collect()
    out = np.zeros((k, k))
    for r in rows:
        out[r.i] = [c.v for c in r.row]
    return (out + out.T) / 2


def covariance(fit: DataFrame) -> tuple[int, list[int], np.ndarray]:
    """n, sums and covariance (divisor n) of the vectors, centred before multiplying."""
    n, sums = _sums(fit)
    if not sums:
        return n, sums, np.zeros((0, 0))
    mean = np.array([s / n for s in sums])
    return n, sums, _outer(fit, len(sums), lambda x: x - mean, len(sums)) / n


# the symmetric eigenproblem: leading pairs only

def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, side diagonal and the Householder vectors that lead there."""
    a, d = a.copy(), len(a)
    reflections = []
    for k in range(d - 2):
        v = a[k + 1:, k].copy()
        scale = np.abs(v[1:]).max(initial=0.0)
        if scale:
            v[0] += np.copysign(np.linalg.norm(v), v[0])
            v /= np.linalg.norm(v)
            sub = a[k + 1:, k + 1:]
            p = sub @ v
            w = 2 * (p - (v @ p) * v)
            sub -= np.outer(v, w) + np.outer(w, v)
            a[k + 1, k] -= 2 * v[0] * (v @ a[k + 1:, k])
        else:
            v[:] = 0
        reflections.append(v)
    return a.diagonal().copy(), a.diagonal(-1).copy(), reflections


def _below(diag: np.ndarray, side2: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Sturm count: how many eigenvalues lie below each x."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    count = np.zeros(len(x), np.int64)
    q = np.ones(len(x))
    for i, value in enumerate(diag):
        q = value - x - (side2[i - 1] / q if i else 0.0)
        q = np.where(np.abs(q) < tiny, -tiny, q)
        count += q < 0
    return count


def leading_values(diag: np.ndarray, side: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, each bisected to neighbouring doubles."""
    d, side2 = len(diag), side * side
    reach = np.r_[0.0, np.abs(side)] + np.r_[np.abs(side), 0.0]
    pad = np.finfo(float).eps * (np.abs(diag) + reach).max()
    lo = np.full(k, (diag - reach).min() - 2 * pad)
    hi = np.full(k, (diag + reach).max() + 2 * pad)
    want = d - 1 - np.arange(k)  # the j-th largest has d - 1 - j below it
    for _ in range(2200):  # any two doubles are fewer halvings apart
        mid = lo + (hi - lo) / 2
        if ((mid <= lo) | (mid >= hi) | (hi - lo <= pad / 4)).all():
            break
        under = _below(diag, side2, mid) <= want
        lo, hi = np.where(under, mid, lo), np.where(under, hi, mid)
    return lo + (hi - lo) / 2


def _solve(diag: np.ndarray, side: np.ndarray, shift: float, b: np.ndarray) -> np.ndarray:
    """(T - shift) x = b for a tridiagonal T, rows exchanged for the larger pivot."""
    d = len(diag)
    tiny = np.finfo(float).eps * (np.abs(diag).max() + np.abs(side).max(initial=0.0) + np.finfo(float).tiny)
    main, up, up2, b = diag - shift, np.r_[side, 0.0], np.zeros(d), b.copy()
    for i in range(d - 1):
        low = side[i]
        if abs(low) > abs(main[i]):
            main[i], low, up[i], main[i + 1] = low, main[i], main[i + 1], up[i]
            up2[i], up[i + 1] = up[i + 1], 0.0
            b[i], b[i + 1] = b[i + 1], b[i]
        f = low / (main[i] if main[i] else tiny)
        main[i + 1] -= f * up[i]
        up[i + 1] -= f * up2[i]
        b[i + 1] -= f * b[i]
    x = np.zeros(d + 2)
    for i in range(d - 1, -1, -1):
        p = main[i] if abs(main[i]) > tiny else np.copysign(tiny, main[i])
        x[i] = (b[i] - up[i] * x[i + 1] - up2[i] * x[i + 2]) / p
    return x[:d]


def leading_vectors(diag: np.ndarray, side: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors by inverse iteration, one a column; those of close
    eigenvalues are made orthogonal to one another in every step."""
    d, norm = len(diag), np.abs(diag).max() + 2 * np.abs(side).max(initial=0.0)
    out = np.zeros((d, len(values)))
    first = 0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * norm:
            first = j  # a new cluster
        x = np.random.default_rng(j).standard_normal(d)
        shift = value - (j - first) * 4 * np.finfo(float).eps * norm  # equal values need different shifts
        for _ in range(6):
            x /= np.abs(x).max()
            for _ in range(2):
                x -= out[:, first:j] @ (out[:, first:j].T @ x)
            x = _solve(diag, side, shift, x / np.linalg.norm(x))
        for _ in range(2):
            x /= np.linalg.norm(x)
            x -= out[:, first:j] @ (out[:, first:j].T @ x)
        out[:, j] = x / np.linalg.norm(x)
    return out


def leading_pairs(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix:
    the k largest, without those that are zero up to rounding."""
    scale = np.abs(v).max(initial=0.0)
    k = min(k, len(v))
    if not scale or not k:
        return np.zeros(0), np.zeros((len(v), 0))
    diag, side, reflections = tridiagonal(v / scale)
    values = leading_values(diag, side, k)
    vectors = leading_vectors(diag, side, values)
    for i in range(len(reflections) - 1, -1, -1):
        r, part = reflections[i], vectors[i + 1:]
        part -= 2 * np.outer(r, r @ part)
    keep = values > len(v) * np.finfo(float).eps * max(values[0], 0.0)
    return values[keep] * scale, vectors[:, keep]


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over the dimensions of (n * x - S)^2, in exact integers."""
    top = max(int(x.max(initial=0)), -int(x.min(initial=0)))
    if (n * top + max(map(abs, sums))) ** 2 * len(sums) < 1 << 62:
        y = n * x - np.array(sums, np.int64)
        return (y * y).sum(axis=1).tolist()
    out = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x.tolist()]
    return [a if a < 1 << 63 else None for a in out]


SCHEMA = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")


def whiten(rows: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding",
           scale: int = SCALE) -> DataFrame:
    """A row per vector and component."""
    spark = rows.sparkSession
    all_x = fixed_point(rows, id_col, vector_col, scale)
    folder = f"{ensure_checkpoint_dir(spark)}/whitening-{uuid.uuid4().hex}"
    longest = all_x.agg(F.max(F.size("x"))).first()[0] or 0
    padded = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(longest) - F.size("x")))
    all_x.select(padded.alias("x")).distinct().write.parquet(folder)
    fit = spark.read.parquet(folder)
    n, sums, v = covariance(fit)
    values, vectors = leading_pairs(v, components)
    k, d = len(values), len(sums)
    if not k:
        remove_folder(spark, folder)
        return spark.createDataFrame([], SCHEMA)
    mean, frame = np.array([s / n for s in sums]), vectors / np.sqrt(values)
    error = float(np.abs(_outer(fit, d, lambda x: (x - mean) @ frame, k) / n - np.eye(k)).max())
    remove_folder(spark, folder)
    explained = values / np.trace(v)

    def run(batches):
        for part, x in _blocks(batches, d):
            m = len(x)
            ids = part.column("vec_id").take(pa.array(np.repeat(np.arange(m), k)))
            yield pa.RecordBatch.from_pydict({
                "vec_id": ids, "component": pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                "n": pa.array(np.full(m * k, n), pa.int64()),
                "deviation": pa.array(_deviations(x, n, sums), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                "whitened": pa.array(((x - mean) @ frame).ravel(), pa.float64()),
                "explained": pa.array(np.tile(explained, m), pa.float64()),
                "identity_error": pa.array(np.full(m * k, error), pa.float64())})

    return map_batches(all_x, run, SCHEMA)


def query(spark, sf_dir: str) -> DataFrame:
    return whiten(read_table(spark, sf_dir, "embeddings"))

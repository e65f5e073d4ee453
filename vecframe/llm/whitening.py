"""Embedding whitening (operator 13).

Every entry ``c`` of a vector becomes the integer ``x = floor(64 c) + 1,000,000``.  The model is fitted on each distinct
integer vector once: their number ``n`` and per-dimension sums ``S`` are exact; the covariance is summed from rows that
are centred first, a partial matrix a task, and the partial matrices are added row by row.  The leading eigenvalues and
eigenvectors of that one ``dim x dim`` matrix come from Householder tridiagonalisation, bisection by Sturm counts, and
inverse iteration that makes the vectors of close eigenvalues orthogonal to each other.  Components are broadcast, and
every row is projected on them.

Defined results: a row whose vector is null or empty, or holds a null or non-finite entry (also one that is not below
2**62 after scaling), is dropped; so is one whose length is not that of most rows (of equally common lengths the
smallest).  Repeated vectors and rows all get results.  Components whose eigenvalue is nought but for rounding are left
out, for nothing can be divided by it, so a constant table, or one distinct vector, gives no rows, like an empty one.  A
null id is an id like any other.  ``deviation`` is null if it has more than 38 digits.  Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecframe.llm.common import files_for, written

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Rows that one matrix product takes.
BLOCK = 4096


def usable(vector: Column) -> Column:
    entry = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float(2 ** 62) / SCALE)
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, entry), F.lit(False))


def integers(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, x array<long>)`` of the rows that remain."""
    v = F.col(vector_col).cast("array<double>")
    good = rows.where(usable(v)).select(F.col(id_col), F.transform(v, lambda c: F.floor(c * SCALE) + F.lit(SHIFT).cast("long")).alias("x"))
    lengths = good.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.col("n").desc(), "d").first()
    return good.where(F.size("x") == (most.d if most else 0))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column without nulls as a matrix of integers."""
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 0), np.int64)


def blocks(batches, column: str):
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            yield part, matrix(part.column(batch.schema.get_field_index(column)))


@dataclass
class Fit:
    """What the covariance is centred on, in two parts so that nothing is lost: a whole number and the rest below 1."""

    n: int
    sums: list[int]
    whole: np.ndarray
    rest: np.ndarray

    @classmethod
    def of(cls, n: int, sums: list[int]) -> "Fit":
        whole = [s // n for s in sums]
        return cls(n, sums, np.array(whole, np.int64), np.array([(s - w * n) / n for s, w in zip(sums, whole)]))

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.rest


def exact_sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and exact sums of each dimension (one row a dimension reaches the driver)."""
    def run(batches):
        n, total = 0, None
        for part, x in blocks(batches, "x"):
            total = [0] * x.shape[1] if total is None else total
            n += len(x)
            # halves of the integers cannot overflow a block's sum
            high, low = (x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0)
            total = [t + (h << 32) + w for t, h, w in zip(total, high.tolist(), low.tolist())]
        if n:
            parts = [pa.array([f(t) for t in total], pa.int64()) for f in (lambda t: t >> 32, lambda t: t & 0xFFFFFFFF)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array([n] * len(total), pa.int64()), *parts],
                                             ["dim", "n", "high", "low"])

    rows = (vectors.select("x").mapInArrow(run, "dim int, n long, high long, low long").groupBy("dim")
            .agg(F.sum("n").alias("n"), F.sum(F.col("high").cast("decimal(38,0)")).alias("high"), F.sum("low").alias("low")).orderBy("dim").collect())
    return (rows[0].n, [(int(r.high) << 32) + r.low for r in rows]) if rows else (0, [])


def added(rows: DataFrame, kernel) -> np.ndarray | None:
    """The sum over all blocks of ``kernel(integers) -> matrix``: a partial matrix a task, added up row by row."""
    def partial(batches):
        total = None
        for _, x in blocks(batches, "x"):
            got = kernel(x)
            total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["row", "entries"])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for row, entries in zip(batch.column(0).to_pylist(), matrix(batch.column(1))):
                total[row] = total[row] + entries if row in total else entries.copy()
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.list_(pa.float64()))], ["row", "entries"])

    schema = "row int, entries array<double>"
    got = rows.select("x").mapInArrow(partial, schema).repartition("row").mapInArrow(add, schema).collect()  # one row of the matrix each
    return np.array([r.entries for r in sorted(got, key=lambda r: r.row)]) if got else None


def covariance(rows: DataFrame, n: int, values, size: int) -> np.ndarray:
    """Covariance (divisor ``n``) of ``values(integers)``: their mean first, then products of centred rows."""
    mean = added(rows, lambda x: values(x).sum(0)[None, :])[0] / n

    def products(x):
        y = values(x) - mean
        return y.T @ y

    total = added(rows, products)
    return (total + total.T) / (2 * n) if total is not None else np.zeros((size, size))


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Householder: diagonal and off-diagonal of ``H a H``, and the unit vectors of the reflections."""
    a = a.copy()
    d = len(a)
    mirrors = []
    for k in range(d - 2):
        x = a[k + 1:, k].copy()
        length = np.linalg.norm(x)
        v = np.zeros(d - k - 1)
        if length > 0:
            x[0] += length if x[0] >= 0 else -length
            v = x / np.linalg.norm(x)
            part = a[k + 1:, k + 1:]
            p = part @ v
            w = 2 * (p - (v @ p) * v)
            part -= np.outer(v, w) + np.outer(w, v)
            a[k + 1:, k] -= 2 * v * (v @ a[k + 1:, k])
            a[k, k + 1:] = a[k + 1:, k]
        mirrors.append(v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), mirrors


def below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sturm count: eigenvalues of the tridiagonal matrix that are less than each value of ``at``."""
    tiny = np.finfo(float).tiny * 2 ** 60 + np.finfo(float).eps * max(1e-300, float(np.abs(off).max(initial=0))) * 1e-16
    count = np.zeros(len(at), np.int64)
    q = np.ones(len(at))
    for i, x in enumerate(diagonal):
        q = x - at - (off[i - 1] ** 2 / q if i else 0)
        q = np.where(np.abs(q) < tiny, -tiny, q)
        count += q < 0
    return count


def leading(diagonal: np.ndarray, off: np.ndarray, m: int) -> np.ndarray:
    """The ``m`` largest eigenvalues, falling: each is bisected until its bounds are neighbouring numbers."""
    d = len(diagonal)
    near = np.concatenate((np.abs(off), [0])) + np.concatenate(([0], np.abs(off)))
    low = np.full(m, (diagonal - near).min())
    high = np.full(m, (diagonal + near).max())
    pad = 1e-12 * max(abs(low[0]), abs(high[0])) + np.finfo(float).tiny
    low, high = low - pad, high + pad
    rank = d - np.arange(m)  # the j-th largest has at least this many eigenvalues at or below it
    for _ in range(200):
        middle = (low + high) / 2
        if ((middle <= low) | (middle >= high)).all():
            break
        up = below(diagonal, off, middle) < rank
        low, high = np.where(up, middle, low), np.where(up, high, middle)
    return (low + high) / 2


def solve(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray, least: float) -> np.ndarray:
    """``(T - shift)`` solved by elimination with row exchanges; pivots that vanish become ``least``."""
    d = len(diagonal)
    a, b, c = (diagonal - shift).tolist(), [*off.tolist(), 0.0], [0.0] * d  # a row's entries on the diagonal and the two places after it
    low, y = off.tolist(), right.tolist()
    for i in range(d - 1):
        if abs(low[i]) > abs(a[i]):
            a[i], b[i], c[i], a[i + 1], b[i + 1], low_i = low[i], a[i + 1], b[i + 1], b[i], c[i], a[i]
            y[i], y[i + 1] = y[i + 1], y[i]
        else:
            low_i = low[i]
        if abs(a[i]) < least:
            a[i] = least
        f = low_i / a[i]
        a[i + 1] -= f * b[i]
        b[i + 1] -= f * c[i]
        y[i + 1] -= f * y[i]
    if abs(a[-1]) < least:
        a[-1] = least
    for i in range(d - 1, -1, -1):
        rest = y[i] - (b[i] * y[i + 1] if i + 1 < d else 0) - (c[i] * y[i + 2] if i + 2 < d else 0)
        y[i] = rest / a[i]
    return np.array(y)


def components(a: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``m`` largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as rows; fewer if the
    others are nought but for rounding."""
    d = len(a)
    diagonal, off, mirrors = tridiagonal(a)
    values = leading(diagonal, off, min(m, d))
    size = max(float(np.abs(values).max(initial=0)), np.finfo(float).tiny)
    values = values[values > size * d * 8 * np.finfo(float).eps]
    found = np.zeros((len(values), d))
    least = np.finfo(float).eps * size
    random = np.random.default_rng(0)
    start = 0  # of the cluster
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * size:
            start = j
        y = random.standard_normal(d)
        for _ in range(5):
            for _ in range(2):  # twice is enough
                y -= found[start:j].T @ (found[start:j] @ y)
            y = solve(diagonal, off, value, y / np.linalg.norm(y), least)
            y /= np.linalg.norm(y)
        for _ in range(2):
            y -= found[start:j].T @ (found[start:j] @ y)
            y /= np.linalg.norm(y)
        found[j] = y
    for k in range(len(mirrors) - 1, -1, -1):
        v = mirrors[k]
        found[:, k + 1:] -= 2 * np.outer(found[:, k + 1:] @ v, v)
    return values, found


@dataclass
class Model:
    """``values`` falling, ``vectors`` as rows, and how far the whitened vectors' covariance is from the identity."""

    fit: Fit
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    identity_error: float


def fit(rows: DataFrame, most: int = COMPONENTS) -> Model | None:
    """Whitening of the distinct integer vectors of ``rows.x``; None if there is nothing to whiten."""
    distinct = written(rows.select("x").distinct(), "vectors")
    n, sums = exact_sums(distinct)
    if not n:
        return None
    at = Fit.of(n, sums)
    v = covariance(distinct, n, at.centred, len(sums))
    values, vectors = components(v, most)
    if not len(values):
        return None
    axes = (vectors / np.sqrt(values)[:, None]).T
    own = covariance(distinct, n, lambda x: at.centred(x) @ axes, len(values))
    return Model(at, float(np.trace(v)), values, vectors, float(np.abs(own - np.eye(len(values))).max()))


def deviations(x: np.ndarray, at: Fit) -> pa.Array:
    """Exact sums over dimensions of ``(n x - S) ** 2``."""
    far = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
    largest = at.n * far + max(abs(s) for s in at.sums)
    if largest < 2 ** 62:
        y = x * at.n - np.array(at.sums, np.int64)
        top = int(np.abs(y).max(initial=0))
        if top * top * x.shape[1] < 2 ** 63:
            return pa.array(np.einsum("ij,ij->i", y, y), pa.int64()).cast(pa.decimal128(38, 0))
    from decimal import Decimal
    out = [sum((at.n * c - s) ** 2 for c, s in zip(row, at.sums)) for row in x.tolist()]
    return pa.array([Decimal(v) if v < 10 ** 38 else None for v in out], pa.decimal128(38, 0))


def project(rows: DataFrame, model: Model, id_col: str) -> DataFrame:
    """``(id, deviation decimal(38,0), whitened array<double>)`` of every row of ``(id, x)``."""
    shared = rows.sparkSession.sparkContext.broadcast((model.fit, (model.vectors / np.sqrt(model.values)[:, None]).T))
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches):
        at, axes = shared.value
        for part, x in blocks(batches, "x"):
            if len(x):
                yield pa.RecordBatch.from_arrays([part.column(0), deviations(x, at), pa.array(list(at.centred(x) @ axes), pa.list_(pa.float64()))],
                                                 [id_col, "deviation", "whitened"])

    return rows.select(id_col, "x").mapInArrow(run, f"`{id_col}` {kind}, deviation decimal(38,0), whitened array<double>")


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """``(id, component int, n long, deviation decimal(38,0), whitened, explained, identity_error double)`` of every row that
    remains and every component."""
    clean = integers(rows, id_col, vector_col)
    model = fit(clean, most)
    if model is None:
        kind = rows.schema[id_col].dataType.simpleString()
        return rows.sparkSession.createDataFrame([], f"`{id_col}` {kind}, component int, n long, deviation decimal(38,0), "
                                                     "whitened double, explained double, identity_error double")
    share = F.array(*[F.lit(float(e) / model.trace) for e in model.values])
    found = project(clean, model, id_col).select(id_col, "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return found.select(id_col, (F.col("at") + 1).alias("component"), F.lit(model.fit.n).cast("long").alias("n"), "deviation", "whitened",
                        F.get(share, F.col("at")).alias("explained"), F.lit(model.identity_error).alias("identity_error"))

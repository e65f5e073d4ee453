"""8-bit scalar quantization (A2, the SQ8 part of IVF_SQ8).

Per dimension ``lo = min``, ``hi = max`` over the table; a value codes to
``floor((x - lo) / (hi - lo) * 255 + 0.5)`` clamped to 0..255 (``hi = lo``
codes to 0) and decodes to ``lo + code * (hi - lo) / 255``.  Codes are stored
as one ``binary`` column of ``dim`` bytes per row - a quarter of the float
size.  Values outside a stored range (rows added later) clamp.  Beside the
codes stands how far the decoded vector is from the row (rounded up), so that
a search can tell which rows may be among the best without reading them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecframe.operators import _kernels as K
from vecframe.session import ship_package


def sq8_ranges(base: DataFrame, dim: int, vector_col: str = "value") -> tuple[np.ndarray, np.ndarray]:
    """Per-dimension min / max: one partial row per Arrow batch, then a
    ``groupBy(pos)`` over ``batches x dim`` values; ``dim`` rows come back."""
    schema = T.StructType([T.StructField("lo", T.ArrayType(T.DoubleType())), T.StructField("hi", T.ArrayType(T.DoubleType()))])

    def run(batches):
        for rb in batches:
            _, X = K.arrow_vectors(rb.column(vector_col), dim)
            if X.shape[0] == 0:
                continue
            yield pa.RecordBatch.from_pydict({"lo": [np.nanmin(X, axis=0).tolist()], "hi": [np.nanmax(X, axis=0).tolist()]},
                                             schema=pa.schema([("lo", pa.list_(pa.float64())), ("hi", pa.list_(pa.float64()))]))

    ship_package(base.sparkSession)
    part = base.select(vector_col).mapInArrow(run, schema)
    per_dim = (part.select(F.posexplode(F.arrays_zip("lo", "hi")).alias("pos", "p"))
               .groupBy("pos").agg(F.min("p.lo").alias("lo"), F.max("p.hi").alias("hi")).orderBy("pos").collect())
    lo = np.array([r["lo"] for r in per_dim], dtype=np.float64)
    hi = np.array([r["hi"] for r in per_dim], dtype=np.float64)
    return lo, hi


def encode(X: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    span = hi - lo
    with np.errstate(divide="ignore", invalid="ignore"):
        c = np.floor((X - lo[None, :]) / span[None, :] * 255 + 0.5)
    c = np.where(span[None, :] == 0, 0, c)
    return np.clip(np.nan_to_num(c, nan=0.0), 0, 255).astype(np.uint8)


def decode(codes: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    return lo[None, :] + codes.astype(np.float64) * (hi - lo)[None, :] / 255


def code_error(X: np.ndarray, codes: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Upper bound (float32) of the distance from each row to its decoded codes; infinite where a value is not finite."""
    with np.errstate(over="ignore", invalid="ignore"):
        e = X - decode(codes, lo, hi)
        size = np.sqrt(np.einsum("ij,ij->i", e, e)) * (1 + 1e-6) + 1e-12 * np.abs(X).max(axis=1, initial=0)
        return np.where(np.isfinite(size), np.nextafter(size.astype(np.float32), np.float32(np.inf)), np.float32(np.inf)).astype(np.float32)


def error_col(codes_col: str) -> str:
    return f"{codes_col}_err"


def sq8_encode(base: DataFrame, lo: np.ndarray, hi: np.ndarray, vector_col: str = "value",
               codes_col: str = "codes") -> DataFrame:
    """Adds the ``binary`` codes column and the error bound (one scan, ranges broadcast: 2 x dim)."""
    spark = base.sparkSession
    bc = spark.sparkContext.broadcast((lo, hi))
    dim = len(lo)
    schema = T.StructType(base.schema.fields + [T.StructField(codes_col, T.BinaryType(), True),
                                              T.StructField(error_col(codes_col), T.FloatType(), True)])

    def run(batches):
        lo_, hi_ = bc.value
        for rb in batches:
            rows, X = K.arrow_vectors(rb.column(vector_col), dim)
            there = np.zeros(rb.num_rows, bool)
            there[rows] = True
            matrix = encode(X, lo_, hi_)
            codes = matrix.tobytes() if len(rows) else b""  # row after row: one buffer
            err = np.zeros(rb.num_rows, np.float32)
            err[rows] = code_error(X, matrix, lo_, hi_)
            offsets = np.concatenate(([0], np.cumsum(there * dim))).astype(np.int32)
            column = pa.Array.from_buffers(pa.binary(), rb.num_rows, [pa.array(there).buffers()[1], pa.py_buffer(offsets.tobytes()), pa.py_buffer(codes)])
            yield rb.append_column(codes_col, column).append_column(error_col(codes_col), pa.array(err, mask=~there))

    ship_package(spark)
    return base.mapInArrow(run, schema)

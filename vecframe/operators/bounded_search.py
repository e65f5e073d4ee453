"""Exact top-k that reads only what can matter (V4, V5).

Rows are laid out by cell, and for each cell its centre and radius are stored
(how far its farthest row is).  A first pass searches the cell or two that look
best for each query; the k-th score found there is one that the result reaches.
The second pass reads only the cells whose bound - no row of theirs can score
better - reaches that score.  The result is that of a search of all rows: where
rows lie in clusters most cells are skipped, where they do not none is.
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecframe.functions.vector import higher_is_better
from vecframe.operators import _kernels as K
from vecframe.operators.ivf import IVFIndex, _broadcast_ivf, _probes, in_blocks, query_blocks, write_assigned
from vecframe.operators.search import query_frame, rank_candidates
from vecframe.session import scratch_path, ship_package


@dataclasses.dataclass
class Grouped:
    """A table laid out by cell, with the radius of each cell (-1: no rows) and the norm of its longest row."""

    cells: DataFrame
    index: IVFIndex
    radius: np.ndarray
    longest: np.ndarray


def cell_radii(assigned: DataFrame, index: IVFIndex, vector_col: str = "value") -> tuple[np.ndarray, np.ndarray]:
    """The distance of each cell's farthest row from its centre, and its longest row (a row a cell reaches the driver).
    Cosine cells hold directions: their rows are taken at unit length."""
    shared = assigned.sparkSession.sparkContext.broadcast(index.centroids)
    dim, nlist, unit = index.dim, index.nlist, index.metric == "COSINE"

    def run(batches):
        far, norm = np.full(nlist, -1.0), np.zeros(nlist)
        for rb in batches:
            rows, X = K.arrow_vectors(rb.column(vector_col), dim)
            if len(rows):
                cell = rb.column("cell").to_numpy(zero_copy_only=False)[rows].astype(np.int64)
                length = np.linalg.norm(X, axis=1)
                if unit:
                    X = np.divide(X, length[:, None], out=np.zeros_like(X), where=length[:, None] > 0)
                away = np.linalg.norm(X - shared.value[cell], axis=1)
                # of a row that is not finite nothing is known: its cell is always read
                np.maximum.at(far, cell, np.where(np.isfinite(away), away, np.inf))
                np.maximum.at(norm, cell, np.where(np.isfinite(length), length, np.inf))
        used = np.flatnonzero(far >= 0)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(far[used]), pa.array(norm[used])], ["cell", "far", "norm"])

    ship_package(assigned.sparkSession)
    rows = (assigned.select("cell", vector_col).mapInArrow(run, "cell int, far double, norm double").groupBy("cell")
            .agg(F.max("far").alias("far"), F.max("norm").alias("norm")).collect())
    radius, longest = np.full(nlist, -1.0), np.zeros(nlist)
    for r in rows:
        radius[r.cell], longest[r.cell] = r.far, r.norm
    return radius, longest


def grouped(assigned: DataFrame, index: IVFIndex, path: str | None = None, n_files: int | None = None) -> Grouped:
    """Lay out an assigned table by cell (one cell a row: not a spilled one) and measure its cells."""
    path = path or scratch_path(assigned.sparkSession, "grouped")
    write_assigned(assigned, path, n_files, partition_col=None)
    cells = assigned.sparkSession.read.schema(assigned.schema).parquet(path)
    return Grouped(cells, index, *cell_radii(cells, index))


def best_keys(table: Grouped, Q: np.ndarray) -> np.ndarray:
    """``(queries, cells)`` keys (smaller is better) that no row of the cell is better than."""
    C, metric = table.index.centroids, table.index.metric
    eps = (C.shape[1] + 8) * 2.0 ** -50
    qn = np.linalg.norm(Q, axis=1)[:, None]
    size = np.linalg.norm(C, axis=1)[None, :]
    R = table.radius[None, :]
    with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
        if metric == "L2":
            away = np.sqrt(np.maximum(qn ** 2 + size ** 2 - 2 * Q @ C.T, 0))
            near = np.maximum(away - R - np.sqrt(eps) * (qn + size), 0)
            key = near ** 2 * (1 - eps)
        else:
            unit = np.where(qn > 0, qn, 1) if metric == "COSINE" else 1.0
            key = -((Q @ C.T + qn * R) / unit + eps * (qn * (size + R)) / unit + eps)
    key = np.where(np.isnan(key), -np.inf, key)
    return np.where(table.radius[None, :] < 0, np.inf, key)


def bounded_search(table: Grouped, queries, k: int = 10, *, first: int = 2, id_col: str = "id", vector_col: str = "value",
                   fields=(), tie_cols=()) -> DataFrame:
    """Exact top-k by bounds, in bounded blocks of queries; ``first``: cells of the first pass for each query."""
    blocks = query_blocks(query_frame(table.cells.sparkSession, queries), table.index, k)
    return in_blocks(blocks, lambda block: _bounded_block(table, block, k, first, id_col, vector_col, fields, tie_cols))


def _bounded_block(table: Grouped, qdf: DataFrame, k: int, first: int, id_col: str, vector_col: str, fields, tie_cols) -> DataFrame:
    spark, index = table.cells.sparkSession, table.index
    higher = higher_is_better(index.metric)
    keep = list(dict.fromkeys([id_col, *fields, *tie_cols]))
    search = lambda bits: _broadcast_ivf(table.cells, qids, Q, bits, index, k, keep, id_col, "cell", vector_col, None)
    qids, Q, start = _probes(qdf, index, first)
    found = scratch_path(spark, "bounded")
    hits = search(start)
    hits.write.parquet(found)
    seen = spark.read.schema(hits.schema).parquet(found)
    # the k-th score of each query so far: one number a query
    kth = rank_candidates(seen, index.metric, k, id_col, tie_cols, []).where(F.col("rank") == k).select("qid", "score").toArrow()
    reach = np.full(len(qids), np.inf)
    place = {q: i for i, q in enumerate(qids.tolist())}
    for q, s in zip(kth["qid"].to_pylist(), kth["score"].to_pylist()):
        reach[place[q]] = K.to_key(np.float64(s), higher)
    rest, step = np.zeros_like(start), K.block_size(index.nlist, max(1, len(qids)))
    for i in range(0, len(qids), step):
        limit = reach[i:i + step]
        slack = 1e-12 * np.abs(np.where(np.isfinite(limit), limit, 0))
        more = (best_keys(table, Q[i:i + step]) <= (limit + slack)[:, None]) & (table.radius >= 0)[None, :]
        rest[i:i + step] = np.packbits(more, axis=1) & ~start[i:i + step]  # without those of the first pass
    both = seen if not rest.any() else seen.unionByName(search(rest))
    return rank_candidates(both, index.metric, k, id_col, tie_cols, list(dict.fromkeys([*fields, *tie_cols])))

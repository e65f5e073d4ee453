"""Training and calibration of IVF cells (A1, A3).

``two_level_centroids``: a bounded sample of the rows is cut into about
``sqrt(nlist)`` coarse cells, and inside each coarse cell - groups that know
nothing of each other - KMeans makes as many fine cells as its share of the
sample asks for.  Equal vectors are one row with a weight, and a coarse cell with
more rows than a group may have is cut into smaller coarse cells first, so no
round over the whole table is needed and no group grows with it.

``calibrate``: a bounded sample of stored rows is searched exactly; the rank of
the cells that hold their neighbours, and how far these cells' scores fall
behind the best cell's, say what must be probed for a given recall.
"""

from __future__ import annotations

import dataclasses
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecframe.functions.vector import higher_is_better
from vecframe.operators import _kernels as K
from vecframe.operators.ivf import ROW, SPILL, IVFIndex, assign_cells, behind
from vecframe.operators.search import search
from vecframe.session import scratch_path, ship_package

# Rows that the sample has for each cell, and that the coarse cells are made of.
ROWS_PER_CELL = 64
COARSE_ROWS = 16_384
# Rows of one group of the second level.
GROUP_ROWS = 32_768
ROUNDS = 10
# Stored rows that a calibration searches.
CALIBRATION_ROWS = 256
# Recall that a calibration aims at: above 0.9, as other queries do a little worse than those it has seen.
TARGET_RECALL = 0.95
# Share of the neighbours that the early stop may not lose.
STOP_QUANTILE = 0.998


# Times that too large coarse cells are cut.
CUTS = 8


def local_kmeans(X: np.ndarray, k: int, seed: int, weight: np.ndarray | None = None, rounds: int = ROUNDS) -> np.ndarray:
    """KMeans of one bounded group: equal rows count as one, seeds by squared distance, at most one cell a row."""
    X, at = np.unique(X, axis=0, return_inverse=True)
    weight = np.bincount(at.ravel(), weights=weight, minlength=len(X)).astype(np.float64)
    if len(X) <= k:
        return X
    rng = np.random.default_rng(seed)
    C = np.empty((k, X.shape[1]))
    C[0] = X[rng.choice(len(X), p=weight / weight.sum())]
    xn = np.einsum("ij,ij->i", X, X)
    near = np.maximum(xn - 2 * X @ C[0] + C[0] @ C[0], 0)
    for j in range(1, k):
        odds = near * weight
        total = odds.sum()
        C[j] = X[rng.choice(len(X), p=odds / total) if total > 0 else rng.integers(len(X))]
        near = np.minimum(near, np.maximum(xn - 2 * X @ C[j] + C[j] @ C[j], 0))
    for _ in range(rounds):
        cell = _closest(X, C)
        count = np.bincount(cell, weights=weight, minlength=k)
        total = np.zeros_like(C)
        np.add.at(total, cell, X * weight[:, None])
        moved = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], C)
        if np.array_equal(moved, C):
            break
        C = moved
    return C


def _closest(X: np.ndarray, C: np.ndarray) -> np.ndarray:
    out = np.empty(len(X), np.int64)
    cn = np.einsum("ij,ij->i", C, C)
    step = K.block_size(len(C), len(X))
    for i in range(0, len(X), step):
        out[i:i + step] = np.argmin(cn[None, :] - 2 * X[i:i + step] @ C.T, axis=1)
    return out


def _group_kmeans(rows: DataFrame, sizes: dict[int, int], vector_col: str, dim: int, seed: int) -> list[tuple[int, np.ndarray]]:
    """``(cell, centroid)`` of every group ``cell`` of ``rows``; a group is one task's work."""
    def run(key, table):
        cell = key[0].as_py()
        _, X = K.arrow_vectors(table.column(vector_col), dim)
        weight = table.column("_w").to_numpy().astype(np.float64)
        ok = np.isfinite(X).all(axis=1)
        C = local_kmeans(X[ok], sizes.get(cell, 1), seed + 7919 * cell, weight[ok]) if ok.any() else np.zeros((0, dim))
        return pa.table([pa.array([cell] * len(C), pa.int32()), pa.array(list(C), pa.list_(pa.float64()))], names=["cell", "v"])

    ship_package(rows.sparkSession)
    got = rows.select("cell", "_w", vector_col).groupBy("cell").applyInArrow(run, "cell int, v array<double>").toArrow().sort_by("cell")
    return list(zip(got["cell"].to_pylist(), K.arrow_vectors(got["v"], dim)[1])) if got.num_rows else []


def two_level_centroids(base: DataFrame, nlist: int, vector_col: str = "value", seed: int = 42, n: int | None = None,
                        unit: bool = False, rows_per_cell: int = ROWS_PER_CELL) -> np.ndarray:
    """``nlist`` centroids (fewer if the sample has fewer different rows) from at most about ``rows_per_cell * nlist`` rows."""
    spark = base.sparkSession
    base = base.where(F.col(vector_col).isNotNull()).select(F.col(vector_col).cast("array<double>").alias(vector_col))
    n = base.count() if n is None else n
    share = min(1.0, rows_per_cell * nlist / max(n, 1))
    sample = base if share >= 1 else base.sample(False, share, seed)
    if unit:
        length = F.sqrt(F.aggregate(vector_col, F.lit(0.0), lambda a, x: a + x * x))
        sample = sample.withColumn("_l", length).select(F.when(F.col("_l") > 0, F.transform(vector_col, lambda x: x / F.col("_l"))).otherwise(F.col(vector_col)).alias(vector_col))
    place = scratch_path(spark, "ivf-train")
    # written, so that a task that runs again reads the same sample
    sample.groupBy(vector_col).agg(F.count(F.lit(1)).alias("_w")).withColumn("_i", F.monotonically_increasing_id()).write.parquet(f"{place}/sample")
    sample = spark.read.parquet(f"{place}/sample")
    held = sample.count()
    if not held:
        return np.zeros((0, 0))
    dim = len(sample.first()[vector_col])

    def some(rows, of, most):  # a part of each cell's rows by a hash, so that it sees all of the cell alike
        share = F.expr("element_at(map(" + ", ".join(f"{c}, {min(1 << 20, (most << 20) // max(1, m))}" for c, m in of.items()) + "), cell)") if len(of) > 1 else \
            F.lit(min(1 << 20, (most << 20) // max(1, next(iter(of.values())))))
        return rows.where(F.pmod(F.xxhash64("_i"), F.lit(1 << 20)) < share)

    few = math.ceil(math.sqrt(nlist))
    whole = sample.withColumn("cell", F.lit(0))
    coarse = [c for _, c in _group_kmeans(some(whole, {0: held}, COARSE_ROWS), {0: few}, vector_col, dim, seed)]
    if nlist <= few or not coarse:
        return np.array(coarse)
    for turn in range(CUTS):
        assign_cells(sample, IVFIndex(np.array(coarse), "L2"), vector_col).write.parquet(f"{place}/coarse-{turn}")
        assigned = spark.read.parquet(f"{place}/coarse-{turn}").where("cell is not null")
        # a row a coarse cell
        found = {r.cell: (r.n, r.w) for r in assigned.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.sum("_w").alias("w")).collect()}
        large = {c: m for c, (m, _) in found.items() if m > GROUP_ROWS}
        if not large or turn == CUTS - 1:
            break
        parts = {c: math.ceil(2 * m / GROUP_ROWS) for c, m in large.items()}
        cut = _group_kmeans(some(assigned.where(F.col("cell").isin(sorted(large))), large, COARSE_ROWS), parts, vector_col, dim, seed + turn + 1)
        coarse = [c for i, c in enumerate(coarse) if i not in large] + [c for _, c in cut]
    sizes = shares({c: w for c, (_, w) in found.items()}, nlist)
    return np.array([c for _, c in _group_kmeans(assigned, sizes, vector_col, dim, seed)])


def shares(weights: dict, total: int) -> dict:
    """``total`` dealt out by weight, at least one each; remainders go to the largest."""
    whole = sum(weights.values())
    exact = {key: total * w / whole for key, w in weights.items()}
    out = {key: max(1, int(x)) for key, x in exact.items()}
    left = total - sum(out.values())
    for key in sorted(exact, key=lambda key: (int(exact[key]) - exact[key], key))[:max(0, left)]:
        out[key] += 1
    return out


def cell_spreads(assigned: DataFrame, index: IVFIndex, vector_col: str = "value") -> np.ndarray:
    """Root mean square residual of each cell's rows, per dimension (one row a cell reaches the driver); the mean of all
    where a cell has fewer than two rows."""
    shared = assigned.sparkSession.sparkContext.broadcast(index.centroids)
    dim, nlist, unit = index.dim, index.nlist, index.metric == "COSINE"

    def run(batches):
        total, count = np.zeros(nlist), np.zeros(nlist, np.int64)
        for rb in batches:
            rows, X = K.arrow_vectors(rb.column(vector_col), dim)
            if len(rows):
                cell = rb.column("cell").to_numpy(zero_copy_only=False)[rows].astype(np.int64)
                if unit:
                    length = np.linalg.norm(X, axis=1, keepdims=True)
                    X = np.divide(X, length, out=np.zeros_like(X), where=length > 0)
                e = X - shared.value[cell]
                square = np.einsum("ij,ij->i", e, e)
                ok = np.isfinite(square)
                total += np.bincount(cell[ok], weights=square[ok], minlength=nlist)
                count += np.bincount(cell[ok], minlength=nlist)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(count[used]), pa.array(total[used])], ["cell", "n", "total"])

    ship_package(assigned.sparkSession)
    rows = assigned.select("cell", vector_col).mapInArrow(run, "cell int, n long, total double").groupBy("cell").agg(F.sum("n").alias("n"), F.sum("total").alias("t")).collect()
    n, t = np.zeros(nlist), np.zeros(nlist)
    for r in rows:
        n[r.cell], t[r.cell] = r.n, r.t
    mean = t.sum() / max(n.sum(), 1)
    return np.sqrt(np.where(n > 1, t / np.maximum(n, 1), mean) / dim)


def calibrate(assigned: DataFrame, index: IVFIndex, k: int = 10, target: float = TARGET_RECALL, rows: int = CALIBRATION_ROWS,
              vector_col: str = "value", id_col: str = "id", seed: int = 42) -> IVFIndex:
    """``index`` with the probes that find ``target`` of the ``k`` nearest rows of a sample of at most about ``rows`` stored rows."""
    spark = assigned.sparkSession
    index = dataclasses.replace(index, spread=cell_spreads(assigned, index, vector_col))
    n = assigned.count()
    usable = assigned.where(F.col(vector_col).isNotNull())
    some = usable if n <= rows else usable.sample(False, rows / n, seed)
    place = scratch_path(spark, "ivf-calibration")
    some.select(F.monotonically_increasing_id().alias("qid"), F.col(vector_col).alias("vec")).write.parquet(place)
    queries = spark.read.parquet(place)
    cells = ["cell"] + ([SPILL] if SPILL in assigned.columns else [])
    found = search(assigned, queries, index.metric, k, vector_col=vector_col, id_col=id_col, fields=cells, tie_cols=[ROW] if ROW in assigned.columns else []).toArrow()
    if not found.num_rows:
        return dataclasses.replace(index, nprobe=index.nlist, gap=math.inf)
    asked = queries.toArrow()
    qids = asked["qid"].to_numpy()
    _, Q = K.arrow_vectors(asked["vec"], index.dim)
    key = K.to_key(K.scores(index.metric, index.centroids, Q).T, higher_is_better(index.metric))
    key = np.where(np.isnan(key), np.inf, key)
    rank = np.argsort(np.argsort(key, axis=1, kind="stable"), axis=1, kind="stable")
    far = behind(index.metric, key, Q, index.spread)
    order = np.argsort(qids)
    q = order[np.searchsorted(qids[order], found["qid"].to_numpy())]
    own = [found[c].to_numpy() for c in cells]
    # of a spilled row the cell that is reached first
    ranks = np.min([rank[q, c] for c in own], axis=0)
    gaps = np.min([far[q, c] for c in own], axis=0)
    nprobe = int(np.sort(ranks)[min(len(ranks) - 1, math.ceil(target * len(ranks)) - 1)]) + 1
    inside = np.sort(gaps[ranks < nprobe])
    gap = float(inside[min(len(inside) - 1, math.ceil(STOP_QUANTILE * len(inside)) - 1)])
    return dataclasses.replace(index, nprobe=nprobe, gap=gap)


def trained(base: DataFrame, index: IVFIndex, spill: bool = False, vector_col: str = "value") -> DataFrame:
    """Every row with its cell or cells, written once: what calibration and search read."""
    place = scratch_path(base.sparkSession, "ivf-assigned")
    assigned = assign_cells(base, index, vector_col, spill=spill)
    assigned.write.parquet(place)
    return base.sparkSession.read.schema(assigned.schema).parquet(place)

"""Clustered-cell (IVF) search with optional 8-bit codes (A1-A4).

Build:
* centroids: ``kmeans`` in two levels on a bounded sample (``ivf_train``), or
  ``mean``: the rows with the smallest ``md5(id)`` as seeds and one update of
  every centroid to the mean of its rows (deterministic; the SQL oracle repeats
  it).  There are as many cells as asked for; the centroid matrix
  (``nlist x dim``) is broadcast;
* assignment: every row gets its nearest centroid (squared L2, ties to the
  lowest cell) in one scan - a NumPy product per Arrow batch.  With ``spill``
  it also gets a second cell, the one in which its residual points elsewhere
  than in the first, and :func:`spilled` has a copy of the row for each;
* ``calibrate`` measures on a bounded set of stored rows how many cells, and how
  far behind the best one, must be probed for the recall that is asked for.

Search:
* probes: each query ranks the centroids by the search metric and keeps the best
  ``nprobe`` cells, or the calibrated number; then it stops early at cells
  whose score falls further behind the best than any that mattered in the
  calibration.  With a filter, cells without a passing row are left out, and a
  query goes on until enough passing rows are in its cells;
* queries and their probed cells (a bit a cell) are broadcast, ``cell IN
  (probed)`` is pushed into the scan, and each task scores its (cell, probing
  queries) blocks, or where most are probed all cells of a batch at once - the
  table is never shuffled.  A query set over the bound is cut into blocks by
  ``hash(qid)`` that run one after the other, their hits written;
* on request (``cogroup``) rows and probes meet per cell in ``applyInArrow``
  co-groups.  A hot cell is split into ``nsub`` sub-blocks of at most
  ``max_group_rows`` rows and a much-probed cell into query sub-blocks, so no
  group grows with the data; rows of unprobed cells are dropped before the shuffle;
* either way each task or group emits only its local top-k per query, and a
  per-query (tree) window keeps the final k.  Copies of a spilled row are one
  row again before that;
* SQ8 re-rank is certified: a row's codes and the stored distance between codes
  and row bound its score, and exactly the rows that may be among the best are
  scored on their vectors, in the same task.  The result is that of the search
  on vectors, however alike the codes are.

HNSW / GPU index requests (A3, A4) are answered by the same cell structure
or by exact search; no graph is built.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecframe.functions.vector import check_metric, higher_is_better
from vecframe.operators import _kernels as K
from vecframe.operators.quantize import decode, error_col
from vecframe.session import scratch_path, ship_package
from vecframe.operators.search import query_frame, rank_candidates

# Cells that are made at most when the caller names no number.
DEFAULT_MAX_NLIST = 65_536


@dataclass
class IVFIndex:
    centroids: np.ndarray          # (nlist, dim) float64
    metric: str = "IP"
    lo: np.ndarray | None = None   # SQ8 per-dimension range
    hi: np.ndarray | None = None
    nprobe: int | None = None      # calibrated: cells to probe at most ...
    gap: float | None = None       # ... and how far behind the best one's score, in units of a cell's spread
    spread: np.ndarray | None = None  # (nlist,) root mean square of the residuals, per dimension

    @property
    def nlist(self) -> int:
        return self.centroids.shape[0]

    @property
    def dim(self) -> int:
        return self.centroids.shape[1]


def save_index(spark, index: IVFIndex, path: str) -> None:
    """Centroids (with spreads), SQ8 ranges and the calibration as a small Parquet table: ``nlist + 3`` rows."""
    spread = index.spread if index.spread is not None else [None] * index.nlist
    parts = [("c", np.arange(index.nlist), index.centroids, spread)]
    parts += [(kind, np.zeros(1), v[None, :], [None]) for kind, v in (("lo", index.lo), ("hi", index.hi)) if v is not None]
    if index.nprobe is not None:
        parts.append(("probe", np.array([index.nprobe]), np.zeros((1, 1)), [index.gap]))
    rows = pa.concat_tables([pa.table({"kind": pa.array([kind] * len(v), pa.string()), "cell": pa.array(cell.astype(np.int32)),
                                       "v": pa.array(list(v), pa.list_(pa.float64())), "x": pa.array(list(x), pa.float64())}) for kind, cell, v, x in parts])
    spark.createDataFrame(rows).withColumn("metric", F.lit(index.metric)).coalesce(1).write.mode("overwrite").parquet(path)


def load_index(spark, path: str) -> IVFIndex:
    rows = spark.read.parquet(path).toArrow()  # nlist + 3 rows

    def part(kind):
        t = rows.filter(pa.compute.equal(rows["kind"], kind)).sort_by("cell")
        return t, np.array(t["v"].to_pylist(), dtype=np.float64)

    cells, centroids = part("c")
    spread = cells["x"].to_numpy() if cells.num_rows and cells["x"].null_count == 0 else None
    ranges = [v[0] if t.num_rows else None for t, v in (part("lo"), part("hi"))]
    probe, _ = part("probe")
    return IVFIndex(centroids, rows["metric"][0].as_py() if rows.num_rows else "IP", *ranges,
                    nprobe=probe["cell"][0].as_py() if probe.num_rows else None, gap=probe["x"][0].as_py() if probe.num_rows else None, spread=spread)


def write_assigned(assigned: DataFrame, path: str, n_files: int | None = None, cell_col: str = "cell",
                   partition_col: str | None = "dt", id_col: str = "id") -> None:
    """Lay the assigned rows out range-sorted by cell: each file (and row
    group) covers a narrow cell range, so the probe filter ``cell IN (...)``
    skips most of them.  The ranges also run over a hash of the id, so a hot
    cell is split over files.  Kept partitioned by day, so expiry drops a day
    from the cell table too."""
    keys = [F.col(cell_col), F.xxhash64(id_col)]
    out = (assigned.repartitionByRange(n_files, *keys) if n_files else assigned.repartitionByRange(*keys)).sortWithinPartitions(cell_col)
    w = out.write.mode("overwrite")
    if partition_col and partition_col in assigned.columns:
        w = w.partitionBy(partition_col)
    w.parquet(path)


def default_nlist(n: int) -> int:
    return max(1, min(DEFAULT_MAX_NLIST, math.ceil(4 * math.sqrt(max(n, 1)))))


def default_nprobe(nlist: int) -> int:
    """Half of the cells, for an index that was not calibrated: the least power of two as a share at which KMeans cells find
    0.9 of the given tables' neighbours."""
    return max(1, math.ceil(nlist / 2))


def reference_nprobe(nlist: int) -> int:
    """Same probe share as the reference's 128 of 4096 cells."""
    return max(1, math.ceil(nlist / 32))


def hash_seeds(base: DataFrame, nlist: int, vector_col: str = "value", id_col: str = "id") -> np.ndarray:
    """The vectors of the ``nlist`` rows whose ids have the smallest md5 (cell = rank - 1)."""
    text = F.col(id_col).cast("string")
    rows = base.orderBy(F.md5(text.cast("binary")), id_col).limit(nlist).select(F.col(vector_col).cast("array<double>").alias("v")).toArrow()
    v = rows.column("v").combine_chunks()
    d = len(v[0]) if len(v) else 0
    return v.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)


def mean_centroids(base: DataFrame, nlist: int, vector_col: str = "value", id_col: str = "id") -> np.ndarray:
    """Hash-chosen seeds after one update over all rows: every centroid becomes
    the mean of the rows nearest to it, rounded to six decimals (a seed without
    rows stays).  Tasks add their rows up per cell; ``nlist x dim`` means reach
    the driver."""
    seeds = hash_seeds(base, nlist, vector_col, id_col)
    if not len(seeds):
        return seeds
    near = assign_cells(base.select(id_col, vector_col), IVFIndex(seeds, "L2"), vector_col)
    out = seeds.copy()
    for cell, _, mean in cell_means(near, seeds.shape, vector_col):
        out[cell] = np.round(mean, 6)
    return out


def cell_means(assigned: DataFrame, shape: tuple[int, int], vector_col: str = "value"):
    """``(cell, rows, mean vector)`` of every cell that has rows: tasks add up their rows per cell, one task a cell the rest."""
    dim = shape[1]

    def run(batches):
        total, count = np.zeros(shape), np.zeros(shape[0], np.int64)
        for rb in batches:
            rows, X = K.arrow_vectors(rb.column(vector_col), dim)
            if len(rows):
                cell = rb.column("cell").to_numpy(zero_copy_only=False)[rows].astype(np.int64)
                np.add.at(total, cell, X)
                count += np.bincount(cell, minlength=shape[0])
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(count[used], pa.int64()),
                                          pa.array(list(total[used]), pa.list_(pa.float64()))], ["cell", "n", "total"])

    def add(batches):
        sums: dict[int, list] = {}
        for rb in batches:
            rows, X = K.arrow_vectors(rb.column("total"), dim)
            for cell, n, x in zip(rb.column("cell").to_pylist(), rb.column("n").to_pylist(), X):
                have = sums.setdefault(cell, [0, np.zeros(dim)])
                have[0] += n
                have[1] += x
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([n for n, _ in sums.values()], pa.int64()),
                                              pa.array([x for _, x in sums.values()], pa.list_(pa.float64()))], ["cell", "n", "total"])

    ship_package(assigned.sparkSession)
    schema = "cell int, n long, total array<double>"
    got = assigned.select("cell", vector_col).mapInArrow(run, schema).repartition("cell").mapInArrow(add, schema).toArrow()  # a row a cell
    totals = K.arrow_vectors(got["total"], dim)[1] if got.num_rows else np.zeros((0, dim))
    return [(c, n, x / n) for c, n, x in zip(got["cell"].to_pylist(), got["n"].to_pylist(), totals)]


def _nearest(X: np.ndarray, C: np.ndarray) -> np.ndarray:
    """Index of the nearest centroid by squared L2; ties to the lowest index.
    Rows and centroids are centred, so that vectors far from the origin do not cancel."""
    centre = C.mean(axis=0)
    X, C = X - centre, C - centre
    cn = np.einsum("ij,ij->i", C, C)
    out = np.empty(X.shape[0], dtype=np.int32)
    step = K.block_size(C.shape[0], X.shape[0])
    for i in range(0, X.shape[0], step):
        d = cn[None, :] - 2.0 * (X[i:i + step] @ C.T)
        out[i:i + step] = np.argmin(d, axis=1)
    return out


# Weight of the part of the second residual that points like the first one.
SPILL_WEIGHT = 1.0
#: Columns of rows with a second cell: that cell, and the row's key.
SPILL, ROW = "spill", "_row"


def _second(X: np.ndarray, C: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The cell (not the first) with the least ``|r|^2 + w (r . u)^2``: ``r`` is its residual, ``u`` the direction of the
    first cell's.  A query that misses the row in its first cell does so along ``u``, and there the second one is good."""
    centre = C.mean(axis=0)
    X, C = X - centre, C - centre
    cn = np.einsum("ij,ij->i", C, C)
    u = X - C[first]
    length = np.linalg.norm(u, axis=1, keepdims=True)
    u = np.divide(u, length, out=np.zeros_like(u), where=length > 0)
    out = np.empty(len(X), np.int32)
    step = K.block_size(C.shape[0], X.shape[0])
    for i in range(0, len(X), step):
        x, v = X[i:i + step], u[i:i + step]
        along = np.einsum("ij,ij->i", x, v)[:, None] - v @ C.T
        cost = cn[None, :] - 2.0 * (x @ C.T) + SPILL_WEIGHT * along ** 2
        cost[np.arange(len(x)), first[i:i + step]] = np.inf
        out[i:i + step] = np.argmin(cost, axis=1)
    return out


def assign_cells(base: DataFrame, index: IVFIndex, vector_col: str = "value", cell_col: str = "cell", spill: bool = False) -> DataFrame:
    """Every row with its cell: one scan, centroids broadcast (``nlist x dim``).  ``spill`` adds a second cell and a row key."""
    spark = base.sparkSession
    bc = spark.sparkContext.broadcast(index.centroids)
    dim = index.dim
    spill = spill and index.nlist > 1
    if spill:
        base = base.withColumn(ROW, F.monotonically_increasing_id())
    fields = [T.StructField(c, T.IntegerType(), True) for c in ([cell_col, SPILL] if spill else [cell_col])]
    schema = T.StructType(base.schema.fields + fields)

    cosine = index.metric == "COSINE"

    def run(batches):
        C = bc.value
        for rb in batches:
            cells = np.full(rb.num_rows, -1, dtype=np.int32)
            seconds = cells.copy()
            rows, X = K.arrow_vectors(rb.column(vector_col), dim)
            if len(rows):
                if cosine:  # nearest unit centroid of the unit row = highest cosine
                    norms = np.linalg.norm(X, axis=1, keepdims=True)
                    X = np.divide(X, norms, out=np.zeros_like(X), where=norms > 0)
                cells[rows] = _nearest(X, C)
                if spill:
                    seconds[rows] = _second(X, C, cells[rows])
            mask = cells < 0
            rb = rb.append_column(cell_col, pa.array(cells, pa.int32(), mask=mask))
            yield rb.append_column(SPILL, pa.array(seconds, pa.int32(), mask=mask)) if spill else rb

    ship_package(spark)
    return base.mapInArrow(run, schema)


def spilled(assigned: DataFrame, cell_col: str = "cell") -> DataFrame:
    """A copy of every row for each of its cells; searches make them one row again by the row key.

    The copies of a row must agree on its key wherever they are read, so write them before they are searched in parts."""
    if SPILL not in assigned.columns:
        return assigned
    both = F.explode_outer(F.array_compact(F.array(cell_col, SPILL)))
    return assigned.select(*[c for c in assigned.columns if c not in (cell_col, SPILL)], both.alias(cell_col))


def probe_cells(queries: DataFrame, index: IVFIndex, nprobe: int | None, passing: np.ndarray | None = None, least: int = 0) -> DataFrame:
    """``(qid, cell)``: the best cells of each query under the metric.

    As many as ``nprobe`` says; without it as many as the calibration says, and none whose score falls further behind the
    best than its gap.  ``passing``: rows of each cell that a filter lets through; cells without any are left out, and a
    query goes on until its cells have ``least`` such rows."""
    schema = T.StructType([T.StructField("qid", T.LongType(), False), T.StructField("cell", T.IntegerType(), False)])

    def pairs(qids, wanted):
        q, cell = np.nonzero(wanted)
        return pa.RecordBatch.from_arrays([pa.array(qids[q], pa.int64()), pa.array(cell.astype(np.int32))],
                                          schema=pa.schema([pa.field("qid", pa.int64(), False), pa.field("cell", pa.int32(), False)]))

    return _probed(queries, index, nprobe, passing, least, pairs, schema)


def probe_bits(queries: DataFrame, index: IVFIndex, nprobe: int | None, passing: np.ndarray | None = None, least: int = 0) -> DataFrame:
    """``(qid, bits)``: :func:`probe_cells` as one row a query, a bit a cell."""
    schema = T.StructType([T.StructField("qid", T.LongType(), False), T.StructField("bits", T.BinaryType(), False)])

    def packed(qids, wanted):
        return pa.RecordBatch.from_arrays([pa.array(qids, pa.int64()), pa.array([b.tobytes() for b in np.packbits(wanted, axis=1)], pa.binary())],
                                          schema=pa.schema([pa.field("qid", pa.int64(), False), pa.field("bits", pa.binary(), False)]))

    return _probed(queries, index, nprobe, passing, least, packed, schema)


def _probed(queries: DataFrame, index: IVFIndex, nprobe: int | None, passing: np.ndarray | None, least: int, made, schema: T.StructType) -> DataFrame:
    """What ``made`` makes of some queries' ids and their ``(queries, cells)`` booleans."""
    spark = queries.sparkSession
    bc = spark.sparkContext.broadcast((index.centroids, index.spread, passing))
    metric = index.metric
    higher = higher_is_better(metric)
    dim = index.dim
    gap = index.gap if nprobe is None else None
    most = min(nprobe or index.nprobe or default_nprobe(index.nlist), index.nlist)

    def run(batches):
        C, spread, passing = bc.value
        for rb in batches:
            rows, Q = K.arrow_vectors(rb.column("vec"), dim)
            if len(rows) == 0:
                continue
            qids = rb.column("qid").to_numpy(zero_copy_only=False)[rows]
            step = max(1, K.block_size(C.shape[0], len(Q)) // 8)  # several tables of this size stand side by side
            for i in range(0, len(Q), step):
                part = Q[i:i + step]
                key = K.to_key(K.scores(metric, C, part).T, higher)
                key = np.where(np.isnan(key), np.inf, key)
                order = np.argsort(key, axis=1, kind="stable")
                place = np.arange(C.shape[0])[None, :]
                wanted = np.broadcast_to(place < most, order.shape)
                if gap is not None:
                    wanted = wanted & (np.take_along_axis(behind(metric, key, part, spread), order, axis=1) <= gap)
                if passing is not None:
                    n = passing[order]
                    wanted = (wanted | (np.cumsum(n, axis=1) - n < least)) & (n > 0)
                of_cell = np.zeros(order.shape, bool)
                np.put_along_axis(of_cell, order, wanted, axis=1)
                yield made(qids[i:i + len(part)], of_cell)

    ship_package(spark)
    return queries.select("qid", F.col("vec").cast("array<double>")).mapInArrow(run, schema)


def behind(metric: str, key: np.ndarray, Q: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """How far each cell's key falls behind the query's best, in units of what the cell's rows vary by along the query."""
    best = key.min(axis=1, keepdims=True)
    if metric == "L2":  # distances, not squares
        key, best, unit = np.sqrt(np.maximum(key, 0)), np.sqrt(np.maximum(best, 0)), spread[None, :]
    elif metric == "IP":
        unit = spread[None, :] * np.linalg.norm(Q, axis=1)[:, None]
    else:
        unit = spread[None, :]
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(key <= best, 0.0, np.where(unit > 0, (key - best) / unit, np.inf))


def _split_table(spark, counts: dict[int, int], max_rows: int) -> dict[int, int]:
    return {int(c): max(1, math.ceil(n / max_rows)) for c, n in counts.items()}


# Candidates of one Arrow batch that are gathered before they are reduced to each query's best.
BATCH_CANDIDATES = 1_000_000

# Bytes of the probes (a bit a query and cell) that are shipped to every task.
MAX_PROBE_BYTES = 64 << 20

# Share of a batch's (row, query) pairs, as one in so many, from which all its cells are scored at once.
DENSE_SHARE = 8


def _arrow_rows(rb, dim, codes_col, vector_col, lo, hi):
    """Float rows of a batch: decoded SQ8 codes or the stored vectors."""
    if codes_col:
        col = rb.column(codes_col)
        valid = np.asarray(col.is_valid().to_numpy(zero_copy_only=False), dtype=bool)
        rows = np.nonzero(valid)[0]
        if len(rows) == 0:
            return rows, np.zeros((0, dim))
        codes = np.frombuffer(b"".join(col.drop_null().to_pylist()), dtype=np.uint8).reshape(-1, dim)
        return rows, decode(codes, lo, hi)
    return K.arrow_vectors(rb.column(vector_col), dim)


def _codes(column, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, dim)


def _by_cell(bits: np.ndarray, nlist: int) -> np.ndarray:
    """``(cells, queries)`` of ``(queries, cells)`` bits, both packed."""
    out = np.zeros((nlist, (len(bits) + 7) // 8), np.uint8)
    for j in range(bits.shape[1]):
        part = np.packbits(np.unpackbits(bits[:, j, None], axis=1).T, axis=1)
        out[8 * j:8 * j + 8] = part[:nlist - 8 * j]
    return out


def _allowed(cell_bits: np.ndarray, cells: np.ndarray):
    """``allow(j0, j1) -> (rows, j1 - j0)`` booleans: does query j probe the cell of row i?"""
    def allow(j0, j1):
        byte = j0 // 8
        return np.unpackbits(cell_bits[cells, byte:(j1 + 7) // 8], axis=1)[:, j0 - 8 * byte:j1 - 8 * byte].astype(bool)
    return allow


def _broadcast_ivf(assigned: DataFrame, qids: np.ndarray, Q: np.ndarray, bits: np.ndarray, index: IVFIndex,
                   k: int, keep_cols: list[str], id_col: str, cell_col: str, vector_col: str,
                   codes_col: str | None, precision: str = "float64", certified: bool = False, count_only: bool = False) -> DataFrame:
    """Queries and their probed cells (``bits``: a row a query, a bit a cell) broadcast; the table is scanned once,
    rows of unprobed cells are filtered at the scan, and each task scores
    every (cell, probing queries) block it holds - the base is never shuffled.

    ``certified``: codes choose the rows whose vectors are scored.  ``count_only``: ``(probed, scored)`` pairs of each task,
    cell by cell (a search that takes several cells at once scores no more)."""
    spark = assigned.sparkSession
    metric = index.metric
    higher = higher_is_better(metric)
    dim = index.dim
    cell_bits = _by_cell(bits, index.nlist)
    probing = np.array([np.unpackbits(b).sum() for b in cell_bits], np.int64)  # queries of each cell
    cells = np.flatnonzero(probing).tolist()
    bc = spark.sparkContext.broadcast((qids, Q, cell_bits, probing, index.lo, index.hi))
    score_cols = [vector_col, codes_col, error_col(codes_col)] if certified else [codes_col or vector_col]
    in_cols = list(dict.fromkeys(keep_cols + score_cols + [cell_col]))
    fields = [T.StructField("qid", T.LongType(), False), T.StructField("score", T.DoubleType(), True)]
    schema = T.StructType(fields + [assigned.schema[c] for c in keep_cols])
    out_arrow = pa.schema([pa.field("qid", pa.int64(), False), pa.field("score", pa.float64())])

    def run(batches):
        q_ids, Qm, cell_bits, probing, lo, hi = bc.value
        acc, acc_rows = [], 0
        limit = 4 * k * max(1, len(q_ids)) + 65536
        probed = scored = 0
        for rb in batches:
            if rb.num_rows == 0:
                continue
            if certified:
                rb = rb.filter(rb.column(vector_col).is_valid())
            rows, X = _arrow_rows(rb, dim, None if certified else codes_col, vector_col, lo, hi)
            if len(rows) == 0:
                continue
            if certified:
                codes, err = _codes(rb.column(codes_col), dim), rb.column(error_col(codes_col)).to_numpy(zero_copy_only=False)
            ids = rb.column(id_col).to_numpy(zero_copy_only=False)[rows]
            rc = rb.column(cell_col).to_numpy(zero_copy_only=False)[rows].astype(np.int64)  # of rows without a vector it is null
            by = np.argsort(rc, kind="stable")
            edges = np.concatenate(([0], np.flatnonzero(np.diff(rc[by])) + 1, [len(by)]))
            rr, qq, ss = [], [], []
            size = 0
            pairs = int(probing[rc].sum())
            if not count_only and pairs * DENSE_SHARE >= len(rc) * len(q_ids) > 0:  # one product for all cells
                allow = _allowed(cell_bits, rc)
                most = 2 * k if ROW in keep_cols else k  # a spilled row may be there twice
                if certified:
                    r, q, sc, _ = K.coded_topk(metric, higher, codes, err, lo, (hi - lo) / 255, X, ids, Qm, most, allow)
                else:
                    r, q, sc = K.local_topk(metric, higher, X, ids, Qm, most, allow, precision)
                rr, qq, ss, edges = [r], [q], [sc], edges[:1]
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                if size > BATCH_CANDIDATES:  # many small cells: of a batch no query needs more than its best
                    r, q, sc = np.concatenate(rr), np.concatenate(qq), np.concatenate(ss)
                    # a spilled row may be there twice
                    best = K.select_topk(q, -sc if higher else sc, ids[r], 2 * k if ROW in keep_cols else k)
                    rr, qq, ss = [r[best]], [q[best]], [sc[best]]
                    size = 0
                sel = by[a:b]
                cell = int(rc[sel[0]])
                if not probing[cell]:
                    continue
                qidx = np.flatnonzero(np.unpackbits(cell_bits[cell], count=len(q_ids)))
                if certified:
                    r, q, sc, n = K.coded_topk(metric, higher, codes[sel], err[sel], lo, (hi - lo) / 255, X[sel], ids[sel], Qm[qidx], k)
                else:
                    r, q, sc = K.local_topk(metric, higher, X[sel], ids[sel], Qm[qidx], k, precision=precision)
                    n = len(sel) * len(qidx)
                probed += len(sel) * len(qidx)
                scored += n
                if count_only:
                    continue
                rr.append(sel[r])
                qq.append(qidx[q])
                ss.append(sc)
                size += len(r)
            if not rr:
                continue
            r, q, sc = np.concatenate(rr), np.concatenate(qq), np.concatenate(ss)
            taken = pa.Table.from_batches([rb]).select(keep_cols).take(pa.array(rows[r]))
            head = pa.table([pa.array(q_ids[q], pa.int64()), pa.array(sc, pa.float64())], schema=out_arrow)
            acc.append(pa.Table.from_arrays(head.columns + taken.columns, names=["qid", "score"] + keep_cols))
            acc_rows += len(r)
            if acc_rows > limit:
                acc = [_reduce_topk(acc, id_col, k, higher)]
                acc_rows = acc[0].num_rows
        if count_only:
            yield pa.RecordBatch.from_arrays([pa.array([probed], pa.int64()), pa.array([scored], pa.int64())], ["probed", "scored"])
        elif acc:
            yield from _reduce_topk(acc, id_col, k, higher).to_batches()

    base = assigned.select(*in_cols)
    if cells and len(cells) < index.nlist:
        base = base.where(F.expr(f"`{cell_col}` IN ({', '.join(map(str, cells))})"))  # pushed to the scan: unprobed cells are skipped
    ship_package(spark)
    return base.mapInArrow(run, "probed long, scored long" if count_only else schema)


def _reduce_topk(tables, id_col, k, higher):
    t = pa.concat_tables(tables)
    s = t.column("score").to_numpy()
    g = t.column("qid").to_numpy()
    if ROW in t.column_names:  # copies of a spilled row
        row = t.column(ROW).to_numpy()
        first = np.sort(np.unique(np.column_stack([g, row]), axis=0, return_index=True)[1])
        t, s, g = t.take(pa.array(first)), s[first], g[first]
    sel = K.select_topk(g, -s if higher else s, t.column(id_col).to_numpy(zero_copy_only=False), k)
    return t.take(pa.array(sel))


def _passing(assigned: DataFrame, index: IVFIndex, k: int, where, least: int | None, cell_col: str):
    """``(rows to search, passing rows of each cell, least of them)``; with a filter they are counted first (one scan of
    the filter's columns, a row a cell reaches the driver)."""
    if where is None:
        return assigned, None, 0
    assigned = assigned.where(where)
    passing = np.zeros(index.nlist, np.int64)
    for cell, n in assigned.where(F.col(cell_col).isNotNull()).groupBy(cell_col).agg(F.count(F.lit(1)).alias("n")).collect():
        passing[cell] = n
    return assigned, passing, FILTERED_ROWS * k if least is None else least


# Passing rows that a filtered query looks at, for each neighbour it asks for: few passing rows lie anywhere.
FILTERED_ROWS = 64


def _probes(qdf: DataFrame, index: IVFIndex, nprobe: int | None, passing: np.ndarray | None = None, least: int = 0):
    """``(qids, vectors, bits)`` of one block of queries."""
    from vecframe.operators.search import _collect_queries
    qids, Q, _ = _collect_queries(qdf)
    order = np.argsort(qids, kind="stable")
    if len(np.unique(qids)) < len(qids):
        raise ValueError("query ids must be unique")
    bits = np.zeros((len(qids), (index.nlist + 7) // 8), np.uint8)
    found = probe_bits(qdf, index, nprobe, passing, least).toArrow()
    if found.num_rows:
        at = order[np.searchsorted(qids[order], found.column("qid").to_numpy())]
        for batch in found.to_batches(max_chunksize=4096):
            part, at = at[:batch.num_rows], at[batch.num_rows:]
            bits[part] = np.frombuffer(b"".join(batch.column("bits").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
    return qids, Q, bits


def query_blocks(qdf: DataFrame, index: IVFIndex, k: int) -> list[DataFrame]:
    """The queries, cut by a hash into blocks whose vectors, probes and candidates are bounded."""
    from vecframe.operators.search import query_bound
    n, most = qdf.count(), min(query_bound(index.dim, k), max(1, MAX_PROBE_BYTES // ((index.nlist + 7) // 8 or 1)))
    if n <= most:
        return [qdf]
    blocks = math.ceil(2 * n / most)  # half full on average: hash blocks are uneven
    return [qdf.where(F.pmod(F.xxhash64("qid"), F.lit(blocks)) == b) for b in range(blocks)]


def in_blocks(blocks: list[DataFrame], answer) -> DataFrame:
    """``answer(block)`` of one block, or of each in turn, written to the shared folder so that one is held at a time."""
    if len(blocks) == 1:
        return answer(blocks[0])
    spark = blocks[0].sparkSession
    path = scratch_path(spark, "query-blocks")
    for block in blocks:
        found = answer(block)
        found.write.mode("append").parquet(path)
    return spark.read.schema(found.schema).parquet(path)


def probe_work(assigned: DataFrame, queries, index: IVFIndex, k: int = 10, nprobe: int | None = None, *, vector_col: str = "value",
               id_col: str = "id", cell_col: str = "cell", codes_col: str | None = None, where=None, least: int | None = None) -> DataFrame:
    """One row ``(probed, scored)``: (row, query) pairs that a search of these queries visits, and those whose vectors it scores."""
    certified = codes_col is not None
    assigned, passing, least_rows = _passing(assigned, index, k, where, least, cell_col)

    def count(block):
        qids, Q, bits = _probes(block, index, nprobe, passing, least_rows)
        return _broadcast_ivf(assigned, qids, Q, bits, index, k, [id_col], id_col, cell_col, vector_col, codes_col, certified=certified, count_only=True)

    done = in_blocks(query_blocks(query_frame(assigned.sparkSession, queries), index, k), count)
    return done.agg(F.sum("probed").alias("probed"), F.sum("scored").alias("scored"))


def ivf_search(assigned: DataFrame, queries, index: IVFIndex, k: int = 10, nprobe: int | None = None, *,
               vector_col: str = "value", id_col: str = "id", cell_col: str = "cell",
               fields: Sequence[str] = (), tie_cols: Sequence[str] = (), codes_col: str | None = None,
               rerank: bool = False, max_group_rows: int = 50000, max_group_queries: int = 4096,
               method: str = "auto", precision: str = "float64", where=None, least: int | None = None) -> DataFrame:
    """Top-k per query over the probed cells of an assigned table.

    ``codes_col``: score the SQ8 codes (decoded with ``index.lo/hi``) instead
    of the float vectors; ``rerank=True`` scores the vectors of exactly those rows
    whose codes leave it open whether they are among the best, so that the
    result is that of a search on vectors (needs ``vector_col``).
    ``where``: a predicate on the rows; ``least``: passing rows that a query's cells have at least
    (``FILTERED_ROWS`` for each neighbour if not given).
    ``method``: ``"broadcast"`` = ``"auto"`` (queries + probes shipped to the scan in
    bounded blocks, no shuffle of the table), or ``"cogroup"`` (both sides meet per cell).
    """
    metric = check_metric(index.metric)
    spark = assigned.sparkSession
    if rerank and codes_col is None:
        raise ValueError("rerank needs codes_col")
    qdf = query_frame(spark, queries)
    assigned, passing, least_rows = _passing(assigned, index, k, where, least, cell_col)
    copies = [ROW] if ROW in assigned.columns else []
    keep_cols = list(dict.fromkeys([id_col] + list(fields) + list(tie_cols) + copies))

    def ranked(cands):
        if copies:
            cands = cands.dropDuplicates(["qid", ROW])
        return rank_candidates(cands, metric, k, id_col, tie_cols, list(fields) + list(tie_cols))

    if method in ("auto", "broadcast"):
        def answer(block):
            qids, Q, bits = _probes(block, index, nprobe, passing, least_rows)
            return ranked(_broadcast_ivf(assigned, qids, Q, bits, index, k, keep_cols, id_col, cell_col, vector_col, codes_col, precision, certified=rerank))

        return in_blocks(query_blocks(qdf, index, k), answer)
    probes = probe_cells(qdf, index, nprobe, passing, least_rows)
    # bounded side tables: one row per cell
    row_counts = {r[cell_col]: r["n"] for r in assigned.groupBy(cell_col).agg(F.count(F.lit(1)).alias("n")).collect()
                  if r[cell_col] is not None}
    probe_counts = {r["cell"]: r["n"] for r in probes.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    nsub = _split_table(spark, row_counts, max_group_rows)
    nqsub = _split_table(spark, probe_counts, max_group_queries)
    info_rows = [(c, nsub.get(c, 1), nqsub.get(c, 1)) for c in set(nsub) | set(nqsub)]
    info = F.broadcast(spark.createDataFrame(info_rows, "cell int, nsub int, nqsub int"))  # <= nlist rows

    score_cols = [vector_col, codes_col, error_col(codes_col)] if rerank else [codes_col or vector_col]
    in_cols = list(dict.fromkeys(keep_cols + score_cols + [cell_col]))
    # the inner join with the per-cell table (probed cells only) drops rows of
    # unprobed cells before the shuffle
    info_probed = F.broadcast(spark.createDataFrame([r for r in info_rows if r[0] in probe_counts],
                                                    "cell int, nsub int, nqsub int"))
    b = (assigned.select(*in_cols).withColumnRenamed(cell_col, "cell").join(info_probed, "cell")
         .withColumn("_sub", F.pmod(F.xxhash64(*keep_cols), F.col("nsub")).cast("int"))
         .withColumn("_qsub", F.explode(F.sequence(F.lit(0), F.col("nqsub") - 1)))
         .drop("nsub", "nqsub"))
    p = (probes.join(qdf, "qid").join(info, "cell")
         .withColumn("_qsub", F.pmod(F.xxhash64("qid"), F.col("nqsub")).cast("int"))
         .withColumn("_sub", F.explode(F.sequence(F.lit(0), F.col("nsub") - 1)))
         .drop("nsub", "nqsub"))

    cand_fields = [T.StructField("qid", T.LongType(), False), T.StructField("score", T.DoubleType(), True)]
    cand_fields += [assigned.schema[c] for c in keep_cols]
    schema = T.StructType(cand_fields)
    dim = index.dim
    higher = higher_is_better(metric)
    lo, hi = index.lo, index.hi
    out_arrow = pa.schema([pa.field("qid", pa.int64(), False), pa.field("score", pa.float64())])
    names = ["qid", "score"] + keep_cols

    def group(left, right):  # of a probed cell without rows one side is empty
        held = left if not rerank else left.filter(left.column(vector_col).is_valid())
        held = pa.RecordBatch.from_arrays([pa.concat_arrays(c.chunks) if c.num_chunks else pa.array([], c.type) for c in held.columns], held.column_names)
        rows, X = _arrow_rows(held, dim, None if rerank else codes_col, vector_col, lo, hi)
        of, Q = K.arrow_vectors(right.column("vec"), dim)
        r, qi, s = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        ids = held.column(id_col).to_numpy(zero_copy_only=False)[rows]
        if len(rows) and len(of) and rerank:
            r, qi, s, _ = K.coded_topk(metric, higher, _codes(held.column(codes_col), dim), held.column(error_col(codes_col)).to_numpy(zero_copy_only=False),
                                       lo, (hi - lo) / 255, X, ids, Q, k)
        elif len(rows) and len(of):
            r, qi, s = K.local_topk(metric, higher, X, ids, Q, k, precision=precision)
        head = pa.table([pa.array(right.column("qid").to_numpy()[of][qi], pa.int64()), pa.array(s, pa.float64())], schema=out_arrow)
        taken = pa.Table.from_batches([held]).select(keep_cols).take(pa.array(rows[r], pa.int64()))
        return pa.Table.from_arrays(head.columns + taken.columns, names=names)

    ship_package(spark)
    cands = b.groupBy("cell", "_sub", "_qsub").cogroup(p.groupBy("cell", "_sub", "_qsub")).applyInArrow(group, schema)
    return ranked(cands)


decode_sq8 = decode


def build_index(base: DataFrame, metric: str = "IP", nlist: int | None = None, method: str = "kmeans",
                vector_col: str = "value", id_col: str = "id", seed: int = 42) -> IVFIndex:
    """A1/A3: centroids by ``kmeans`` or ``mean`` (see the module's docstring); ``nlist`` as asked, at most one per row."""
    metric = check_metric(metric)
    n = base.count()
    nlist = min(nlist or default_nlist(n), max(n, 1))
    if method == "mean":
        C = mean_centroids(base, nlist, vector_col, id_col)
    elif method == "kmeans":
        from vecframe.operators.ivf_train import two_level_centroids
        C = two_level_centroids(base, nlist, vector_col, seed, n=n, unit=metric == "COSINE")
    else:
        raise ValueError("method must be 'kmeans' or 'mean'")
    if metric == "COSINE":  # cosine cells live on the unit sphere
        norms = np.linalg.norm(C, axis=1, keepdims=True)
        C = np.where(norms > 0, C / np.where(norms > 0, norms, 1), C)
    return IVFIndex(C, metric)


def index_request(kind: str) -> str:
    """A4 / L1: map an index name to how it is answered here."""
    k = kind.upper()
    if k in ("IVF_FLAT", "GPU_IVF_FLAT"):
        return "ivf"
    if k == "IVF_SQ8":
        return "ivf_sq8"
    if k in ("HNSW", "FLAT", "AUTOINDEX"):
        return "exact"
    return "none"  # unknown names create no index; search then does nothing


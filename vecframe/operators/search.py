"""Exact top-k similarity search.

``search(base, queries, metric, k)`` returns one row per (query, hit):
``qid, rank, <id>, score, <fields...>``, best first, ``rank`` from 1.

Plan shape (method ``"arrow"``, the default):

* the query block is broadcast - only after its size is checked;
* each task scores its Arrow batches with one matrix product per block and
  keeps a running top-k per query, so a task emits at most
  ``k x queries`` rows (plus exact ties);
* a window ``row_number() over (partition by qid order by score, id, ...)``
  picks the final k; only those few candidates are shuffled.

A query set too large to broadcast is cut into blocks by ``hash(qid)``, small
enough for the broadcast and for what a task keeps; the blocks run one after
the other, each one more scan of the base (never a shuffle of it), and their
hits are written to the shared folder.

Method ``"expr"`` keeps scoring inside the JVM with ``zip_with``/``aggregate``
(single query vectors only); it is the reference the Arrow path is tested
against.

Ordering (our definition): score (desc for IP/COSINE, asc for L2), then id,
then the extra tie-break columns; NULL and NaN scores are removed; k > n
returns n rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecframe.functions.vector import check_metric, higher_is_better, metric_score, vector_literal
from vecframe.operators import _kernels as K
from vecframe.session import scratch_path, ship_package

# A broadcast query block is at most this large (float64 matrix bytes).
MAX_BROADCAST_QUERY_BYTES = 64 << 20
# Candidate rows that one task keeps for a query block (it keeps up to 4 k per query).
MAX_TASK_CANDIDATES = 4_000_000


def vector_dim(df: DataFrame, vector_col: str) -> int | None:
    """Dimension from column metadata, else from the first non-NULL row."""
    md = df.schema[vector_col].metadata or {}
    if "dim" in md:
        return int(md["dim"])
    row = df.where(F.col(vector_col).isNotNull()).select(F.size(vector_col).alias("d")).limit(1).collect()
    return int(row[0]["d"]) if row else None


def query_frame(spark: SparkSession, queries, qid_col: str = "qid", vec_col: str = "vec",
                parts_col: str | None = None) -> DataFrame:
    """Normalise queries to a DataFrame ``(qid long, vec array<double>[, parts])``.

    ``parts_col``: per-query partition names (``array<string>``, NULL = all)."""
    if isinstance(queries, DataFrame):
        cols = [F.col(qid_col).cast("long").alias("qid"), F.col(vec_col).cast("array<double>").alias("vec")]
        if parts_col:
            cols.append(F.col(parts_col).cast("array<string>").alias("parts"))
        return queries.select(*cols)
    vecs = [queries] if queries and not isinstance(queries[0], (list, tuple, np.ndarray)) else queries
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vecs)]
    schema = T.StructType([T.StructField("qid", T.LongType(), False),
                           T.StructField("vec", T.ArrayType(T.DoubleType(), False), False)])
    return spark.createDataFrame(rows, schema)


def _collect_queries(qdf: DataFrame):
    """``(qids, Q, parts)``; ``parts`` is None or one set (or None) per query."""
    has_parts = "parts" in qdf.columns
    tbl = qdf.select("qid", "vec", *(["parts"] if has_parts else [])).toArrow()
    parts = None
    if has_parts:
        parts = [None if p is None else set(p) for p in tbl.column("parts").to_pylist()]
        if all(p is None for p in parts):  # every query searches every partition
            parts = None
    qids = tbl.column("qid").to_numpy()
    vec = tbl.column("vec").combine_chunks()
    lengths = np.asarray(vec.value_lengths().to_numpy(zero_copy_only=False))
    if len(lengths) and (lengths != lengths[0]).any():
        raise ValueError("query vectors differ in dimension")
    d = int(lengths[0]) if len(lengths) else 0
    Q = vec.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d) if d else np.zeros((0, 0))
    return qids, Q, parts


def _candidate_schema(base: DataFrame, keep_cols: Sequence[str]) -> T.StructType:
    fields = [T.StructField("qid", T.LongType(), False), T.StructField("score", T.DoubleType(), True)]
    fields += [base.schema[c] for c in keep_cols]
    return T.StructType(fields)


def _broadcast_candidates(base: DataFrame, vector_col: str, id_col: str, keep_cols: list[str],
                          metric: str, k: int, qids: np.ndarray, Q: np.ndarray, dim: int,
                          parts=None, partition_col: str = "dt", precision: str = "float64", ks: np.ndarray | None = None) -> DataFrame:
    """``ks``: how many rows each query asks for (``k`` for all if not given).  Queries of one size are scored together:
    a task keeps what each asks for, in one pass over its rows."""
    spark = base.sparkSession
    higher = higher_is_better(metric)
    sizes = [(k, np.arange(len(qids)))] if ks is None else [(int(x), np.flatnonzero(ks == x)) for x in np.unique(ks)]
    bq = spark.sparkContext.broadcast((qids, Q, parts, sizes))
    schema = _candidate_schema(base, keep_cols)
    in_cols = list(dict.fromkeys(keep_cols + [vector_col, id_col] + ([partition_col] if parts is not None else [])))
    out_arrow = pa.schema([pa.field("qid", pa.int64(), False), pa.field("score", pa.float64())])

    def run(batches):
        q_ids, Qm, q_parts, sizes = bq.value
        acc: list[pa.Table] = []
        acc_rows = 0
        limit = 4 * sum(n * len(own) for n, own in sizes) + 65536
        most = {q: n for n, own in sizes for q in q_ids[own].tolist()}
        for rb in batches:
            if rb.num_rows == 0:
                continue
            rows, X = K.arrow_vectors(rb.column(vector_col), dim)
            if len(rows) == 0:
                continue
            ids = rb.column(id_col).to_numpy(zero_copy_only=False)[rows]
            hits = []
            for n, own in sizes:
                allow = None
                if q_parts is not None:
                    allow = K.partition_mask(rb.column(partition_col).take(pa.array(rows)), [q_parts[i] for i in own.tolist()])
                r, q, s = K.local_topk(metric, higher, X, ids, Qm[own], n, allow, precision)
                hits.append((r, own[q], s))
            r, q, s = (np.concatenate(x) for x in zip(*hits)) if hits else (np.zeros(0, int),) * 3
            if len(r) == 0:
                continue
            taken = pa.Table.from_batches([rb]).select(keep_cols).take(pa.array(rows[r]))
            head = pa.table([pa.array(q_ids[q], pa.int64()), pa.array(s, pa.float64())], schema=out_arrow)
            acc.append(pa.Table.from_arrays(head.columns + taken.columns,
                                            names=["qid", "score"] + keep_cols))
            acc_rows += len(r)
            if acc_rows > limit:
                acc = [_reduce(acc, id_col, most, higher)]
                acc_rows = acc[0].num_rows
        if acc:
            for b in _reduce(acc, id_col, most, higher).to_batches():
                yield b

    ship_package(spark)
    return base.select(*in_cols).mapInArrow(run, schema)


def _reduce(tables: list[pa.Table], id_col: str, most: dict[int, int], higher: bool) -> pa.Table:
    """What each query asks for of the rows gathered so far."""
    t = pa.concat_tables(tables)
    g = t.column("qid").to_numpy()
    s = t.column("score").to_numpy()
    key = -s if higher else s
    ids = t.column(id_col).to_numpy(zero_copy_only=False)
    names, at = np.unique(g, return_inverse=True)
    asked = np.array([most[q] for q in names.tolist()], np.int64)[at]
    sel = [np.flatnonzero(asked == k)[K.select_topk(g[asked == k], key[asked == k], ids[asked == k], int(k))] for k in np.unique(asked)]
    return t.take(pa.array(np.concatenate(sel) if sel else np.zeros(0, np.int64)))


def query_bound(dim: int | None, k: int) -> int:
    """Queries of one block: its bytes are bounded, and the candidates a task keeps for it."""
    return max(1, min(MAX_BROADCAST_QUERY_BYTES // (8 * max(dim or 1, 1)), MAX_TASK_CANDIDATES // (4 * max(k, 1))))


def _blocked_search(base: DataFrame, qdf: DataFrame, vector_col: str, id_col: str, keep_cols: list[str], fields: list[str],
                    tie_cols, metric: str, k: int, nq: int, dim: int, partition_col: str, precision: str) -> DataFrame:
    """A query set over the bound: ``ceil(queries / bound)`` hash blocks, one
    after the other - collected, broadcast, searched in one scan of the base,
    its k hits a query written to the shared folder, and the broadcast freed -
    so the driver and the executors hold one block at a time.  The base is
    never shuffled."""
    spark = base.sparkSession
    n_blocks = math.ceil(2 * nq / query_bound(dim, k))  # half full on average: hash blocks are uneven
    blk = F.pmod(F.xxhash64("qid"), F.lit(n_blocks))
    path = scratch_path(spark, "query-blocks")
    empty = rank_candidates(spark.createDataFrame([], _candidate_schema(base, keep_cols)), metric, k, id_col, tie_cols, fields)
    empty.write.parquet(path)
    for b in range(n_blocks):
        qids, Q, parts = _collect_queries(qdf.where(blk == b))
        if len(qids):
            c = _broadcast_candidates(base, vector_col, id_col, keep_cols, metric, k, qids, Q, dim, parts, partition_col, precision)
            rank_candidates(c, metric, k, id_col, tie_cols, fields).write.mode("append").parquet(path)
    return spark.read.schema(empty.schema).parquet(path)


def _expr_candidates(base: DataFrame, vector_col: str, keep_cols: list[str], metric: str,
                     qids: np.ndarray, Q: np.ndarray) -> DataFrame:
    if len(qids) != 1:
        raise ValueError("method='expr' scores one query vector; use method='arrow' for many")
    score = metric_score(metric, vector_col, vector_literal(Q[0]))
    return base.select(F.lit(int(qids[0])).cast("long").alias("qid"), score.alias("score"), *keep_cols)


def search(base: DataFrame, queries, metric: str = "IP", k: int = 10, *, vector_col: str = "value",
           id_col: str = "id", fields: Sequence[str] | None = None, tie_cols: Sequence[str] = (),
           partitions: Sequence[str] | None = None, partition_col: str = "dt",
           where=None, method: str = "auto", dim: int | None = None,
           query_partitions_col: str | None = None, precision: str = "float64") -> DataFrame:
    """Top-k rows of ``base`` for each query vector.

    ``queries``: one vector, a list of vectors, or a DataFrame ``(qid, vec)``.
    ``partitions``: names of ``partition_col`` to search (None or [] = all);
    ``where``: an extra predicate applied *before* scoring (filtered search);
    ``query_partitions_col``: a column of the query DataFrame holding each
    query's own partition names (``array<string>``, NULL = all) - applied as
    a mask inside the scoring tasks, so one search serves mixed requests;
    ``precision="float32"``: float32 products, survivors re-scored in float64
    (same rows; the product is the cost that grows with the table).
    """
    metric = check_metric(metric)
    if k <= 0:
        raise ValueError("k must be positive")
    spark = base.sparkSession
    if partitions:
        base = base.where(F.col(partition_col).isin(list(partitions)))
    if where is not None:
        base = base.where(where)
    fields = list(fields) if fields is not None else [c for c in base.columns if c != vector_col]
    keep_cols = list(dict.fromkeys([id_col] + fields + list(tie_cols)))
    qdf = query_frame(spark, queries, parts_col=query_partitions_col)

    base_dim = dim or vector_dim(base, vector_col)
    if method == "auto":
        method = "arrow"
    # one bounded collect decides: it either fits the broadcast bound or the
    # query set goes to the blocked path (counted only then); vectors given
    # on the driver are used as they are, without a job
    bound = query_bound(base_dim, k)
    if not isinstance(queries, DataFrame):
        vecs = [queries] if queries and not isinstance(queries[0], (list, tuple, np.ndarray)) else queries
        if len({len(v) for v in vecs}) > 1:
            raise ValueError("query vectors differ in dimension")
        qids = np.arange(len(vecs), dtype=np.int64)
        Q = np.array([[float(x) for x in v] for v in vecs], dtype=np.float64).reshape(len(vecs), -1)
        parts = None
    else:
        probe = qdf.limit(bound + 1) if method != "expr" else qdf
        qids, Q, parts = _collect_queries(probe)
    if method == "expr" or len(qids) <= bound:
        if base_dim is not None and len(qids) and Q.shape[1] != base_dim:
            raise ValueError(f"query dimension {Q.shape[1]} does not match table dimension {base_dim}")
        if base_dim is None:  # empty table
            cands = spark.createDataFrame([], _candidate_schema(base, keep_cols))
        elif method == "expr":
            if parts is not None:
                raise ValueError("method='expr' takes no per-query partitions")
            cands = _expr_candidates(base, vector_col, keep_cols, metric, qids, Q)
        else:
            cands = _broadcast_candidates(base, vector_col, id_col, keep_cols, metric, k, qids, Q, base_dim,
                                          parts, partition_col, precision)
    else:
        if base_dim is not None and Q.shape[1] != base_dim:
            raise ValueError("query dimension does not match table dimension")
        if base_dim is None:  # empty table
            cands = spark.createDataFrame([], _candidate_schema(base, keep_cols))
        else:
            if not isinstance(queries, DataFrame):
                qdf = query_frame(spark, queries)
            return _blocked_search(base, qdf, vector_col, id_col, keep_cols, fields, tie_cols, metric, k, qdf.count(), base_dim,
                                   partition_col, precision)
    return rank_candidates(cands, metric, k, id_col, tie_cols, fields)


# Buckets of the first level of a top-k tree.
TOPK_BUCKETS = 64


def top_k_per_group(df: DataFrame, keys: Sequence[str], order: Sequence, k: int,
                    buckets: int = TOPK_BUCKETS) -> DataFrame:
    """``row_number() <= k`` per group, in two levels.

    Each input partition holds at most k rows per group after the partial
    ``WindowGroupLimit``, so one level would bring ``partitions x k`` rows of a
    group into a task.  The first level keeps the top k per ``(group, partition
    bucket)``, the second at most ``buckets x k`` rows per group.  Planning it
    runs nothing.  Adds ``rank``.
    """
    w1 = Window.partitionBy(*keys, "_tb").orderBy(*order)
    df = (df.withColumn("_tb", F.pmod(F.spark_partition_id(), F.lit(buckets)))
          .withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= k).drop("_r1", "_tb"))
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def rank_candidates(cands: DataFrame, metric: str, k: int, id_col: str = "id",
                    tie_cols: Sequence[str] = (), fields: Sequence[str] | None = None) -> DataFrame:
    """Final per-query top-k over a candidate table ``(qid, score, id, ...)``."""
    cands = cands.where(F.col("score").isNotNull() & ~F.isnan("score"))
    order = [F.desc("score") if higher_is_better(metric) else F.asc("score"), F.asc(id_col)]
    order += [F.asc_nulls_last(c) for c in tie_cols]
    ranked = top_k_per_group(cands, ["qid"], order, k)
    fields = [c for c in (fields if fields is not None else cands.columns) if c not in ("qid", "score", "rank", id_col)]
    return ranked.select("qid", F.col("rank").cast("long").alias("rank"), id_col, "score", *fields)


def sized_search(base: DataFrame, queries: DataFrame, metric: str, *, dim: int, vector_col: str = "value", id_col: str = "id",
                 fields: Sequence[str] = (), tie_cols: Sequence[str] = (), partition_col: str = "dt") -> DataFrame | None:
    """Top-k with a number for each query, in one scan: ``queries`` are ``(qid, vec, parts, k)``.

    None if the set is over what one broadcast, or the candidates that a task keeps, may hold."""
    metric = check_metric(metric)
    n, total = queries.agg(F.count(F.lit(1)), F.coalesce(F.sum("k"), F.lit(0))).first()
    if n * dim * 8 > MAX_BROADCAST_QUERY_BYTES or 4 * total > MAX_TASK_CANDIDATES:
        return None
    # numbered, so that the sizes stand beside their queries
    rows = queries.select("qid", F.col("vec").cast("array<double>").alias("vec"), "parts", "k").toArrow()
    spark = base.sparkSession
    keep_cols = list(dict.fromkeys([id_col, *fields, *tie_cols]))
    if not rows.num_rows:
        return rank_candidates(spark.createDataFrame([], _candidate_schema(base, keep_cols)), metric, 1, id_col, tie_cols, fields)
    Q = K.arrow_vectors(rows["vec"], dim)[1]
    parts = [None if p is None else set(p) for p in rows["parts"].to_pylist()]
    ks = rows["k"].to_numpy().astype(np.int64)
    cands = _broadcast_candidates(base, vector_col, id_col, keep_cols, metric, int(ks.max()), rows["qid"].to_numpy(), Q, dim,
                                  None if all(p is None for p in parts) else parts, partition_col, ks=ks)
    return rank_candidates(cands, metric, int(ks.max()), id_col, tie_cols, fields)


def search_one(base: DataFrame, query: Sequence[float], metric: str = "IP", k: int = 10, **kw) -> DataFrame:
    """V4: top-k for a single vector, without the ``qid`` column."""
    return search(base, [list(query)], metric, k, **kw).drop("qid")


def stored_vector(base: DataFrame, id_value, *, vector_col: str = "value", id_col: str = "id") -> DataFrame:
    """V7: the stored vector(s) of one id as a one-row query frame."""
    return (base.where(F.col(id_col) == F.lit(id_value))
            .select(F.lit(0).cast("long").alias("qid"), F.col(vector_col).alias("vec")).limit(1))

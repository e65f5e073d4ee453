"""Ground truth, recall and latency.

Percentiles are exact (:func:`latency_summary`), or from stored sketches that runs and days merge into
(:func:`latency_sketches`).  A neighbours table follows its collection (:func:`add_neighbours`, :func:`drop_neighbours`)."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ground_truth(exact: DataFrame, id_col: str = "id") -> DataFrame:
    """``(qid, ids)`` with the exact neighbour ids in rank order (k per query)."""
    return (exact.groupBy("qid")
            .agg(F.array_sort(F.collect_list(F.struct("rank", id_col))).alias("_r"))
            .select("qid", F.array_join(F.transform("_r", lambda x: x[id_col].cast("string")), ",").alias("ids")))


def recall_at_k(approx: DataFrame, exact: DataFrame, id_col: str = "id") -> DataFrame:
    """Hits of the approximate result among the exact top-k, averaged.

    ``(queries, hits, expected, recall)``; a join on ``(qid, id)``.
    """
    ex = exact.select("qid", id_col).distinct()
    ap = approx.select("qid", id_col).distinct()
    hits = ap.join(ex, ["qid", id_col], "inner").agg(F.count(F.lit(1)).alias("hits"))
    tot = ex.agg(F.count(F.lit(1)).alias("expected"), F.countDistinct("qid").alias("queries"))
    return (tot.join(hits, how="left")  # both sides are single rows
            .select("queries", F.coalesce("hits", F.lit(0)).alias("hits"), "expected",
                    F.round(F.coalesce("hits", F.lit(0)) / F.col("expected"), 6).alias("recall")))


# -- neighbours kept up to date ----------------------------------------------

def add_neighbours(stored: DataFrame, new_rows: DataFrame, queries: DataFrame, metric: str = "IP", k: int = 10, *, id_col: str = "id",
                   fields: Sequence[str] = ("dt",)) -> DataFrame:
    """E1 after an append: the ``k`` best of the stored neighbours and of the new rows, which alone are searched.

    ``stored``: ``(qid, rank, id, score, fields...)`` of the same queries."""
    from vecframe.operators.search import rank_candidates, search
    found = search(new_rows, queries, metric, k, id_col=id_col, fields=list(fields))
    return rank_candidates(stored.drop("rank").unionByName(found.drop("rank")), metric, k, id_col, [], list(fields))


def drop_neighbours(stored: DataFrame, left: DataFrame, queries: DataFrame, gone, metric: str = "IP", k: int = 10, *, id_col: str = "id",
                    fields: Sequence[str] = ("dt",)) -> DataFrame:
    """E1 after an expiry: only the queries that lose a neighbour (``gone``: a predicate on its fields) are searched again,
    over the rows that are ``left``; the others keep theirs."""
    from vecframe.operators.search import search
    from vecframe.session import bounded_broadcast
    lost = bounded_broadcast(stored.where(gone).select("qid").distinct())
    again = search(left, queries.join(lost, "qid", "left_semi"), metric, k, id_col=id_col, fields=list(fields))
    return stored.join(lost, "qid", "left_anti").unionByName(again.select(*stored.columns))


# Largest number of distinct values of one group handled by a single window.
MAX_WINDOW_VALUES = 2_000_000


def exact_percentiles(df: DataFrame, group_cols: Sequence[str], value_col: str,
                      ps: Sequence[float] = (0.5, 0.95, 0.99), names: Sequence[str] | None = None,
                      max_window_values: int = MAX_WINDOW_VALUES, with_mean: bool = False) -> DataFrame:
    """Exact, linearly interpolated percentiles without buffering a group.

    1. a histogram ``(group, value, count)`` - partial aggregation, one row
       per distinct value;
    2. running counts over the histogram: when every group has at most
       ``max_window_values`` distinct values, one window per group; else the
       histogram is range-partitioned on ``(group, value)`` so a hot group is
       split over many tasks, and each row's global position is its
       partition's offset (a small per-(partition, group) table) plus its
       running count inside the partition;
    3. the value at index i is the smallest value whose running count
       exceeds i - a conditional ``min`` per group.
    """
    from vecframe.session import cut_lineage
    g = list(group_cols)
    names = list(names or [f"p{int(round(p * 100))}" for p in ps])
    hist = df.where(F.col(value_col).isNotNull()).groupBy(*g, value_col).agg(F.count(F.lit(1)).alias("_c"))
    widest = hist.groupBy(*g).agg(F.count(F.lit(1)).alias("_d")).agg(F.max("_d")).first()[0] or 0
    if widest <= max_window_values:
        w = Window.partitionBy(*g).orderBy(value_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        cum = hist.withColumn("_cum", F.sum("_c").over(w)).withColumn("_n", F.sum("_c").over(Window.partitionBy(*g)))
    else:
        ranged = cut_lineage(hist.repartitionByRange(*[F.col(c) for c in g], F.col(value_col)))
        tagged = ranged.withColumn("_pid", F.spark_partition_id())
        part = tagged.groupBy("_pid", *g).agg(F.sum("_c").alias("_np"))  # partitions x groups: small
        wo = Window.partitionBy(*g).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
        part = (part.withColumn("_off", F.coalesce(F.sum("_np").over(wo), F.lit(0)))
                .withColumn("_n", F.sum("_np").over(Window.partitionBy(*g))).drop("_np"))
        wl = Window.partitionBy("_pid", *g).orderBy(value_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        named = part.select(F.col("_pid").alias("_of"), *[F.col(c).alias(f"_of_{c}") for c in g], "_off", "_n")
        same = F.col("_pid") == F.col("_of")
        for c in g:  # a group may be NULL
            same &= F.col(c).eqNullSafe(F.col(f"_of_{c}"))
        cum = (tagged.withColumn("_local", F.sum("_c").over(wl)).join(named, same)
               .withColumn("_cum", F.col("_off") + F.col("_local")))
    aggs = [F.first("_n").alias("_n"), (F.sum(F.col(value_col) * F.col("_c")) / F.sum("_c")).alias("_mean")]
    for p, nm in zip(ps, names):
        h = (F.col("_n") - 1) * F.lit(float(p))
        aggs.append(F.min(F.when(F.col("_cum") > F.floor(h), F.col(value_col))).alias(f"{nm}_lo"))
        aggs.append(F.min(F.when(F.col("_cum") > F.ceil(h), F.col(value_col))).alias(f"{nm}_hi"))
        aggs.append(F.first(h - F.floor(h)).alias(f"{nm}_f"))
    out = cum.groupBy(*g).agg(*aggs)
    cols = [F.col(c) for c in g] + [F.col("_n").alias("n")]
    if with_mean:
        cols.append(F.col("_mean").alias("mean"))
    for nm in names:
        lo, hi, f = F.col(f"{nm}_lo"), F.col(f"{nm}_hi"), F.col(f"{nm}_f")
        cols.append((lo + f * (hi - lo)).alias(nm))
    return out.select(*cols)


def latency_summary(runs: DataFrame, group_cols: Sequence[str], ms_col: str = "ms") -> DataFrame:
    """Count, p50 / p95 / p99 and mean of a run-log table (a NULL group is a group)."""
    return (exact_percentiles(runs, group_cols, ms_col, with_mean=True)
            .select(*group_cols, "n", *[F.round(c, 6).alias(c) for c in ("p50", "p95", "p99", "mean")]))


# Size of a percentile sketch: ranks are off by less than a thousandth of the rows or so, whatever their number.
SKETCH_K = 4096


def latency_sketches(runs: DataFrame, group_cols: Sequence[str], ms_col: str = "ms", k: int = SKETCH_K) -> DataFrame:
    """E3 to be added up: a quantile sketch, the count and the sum for each group (for instance day and kind of request)."""
    value = F.col(ms_col).cast("double")
    return (runs.where(value.isNotNull()).groupBy(*group_cols)
            .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.kll_sketch_agg_double(value, F.lit(k)).alias("sketch")))


def merged_sketches(sketches: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    """Sketches of runs, days or kinds as those of the coarser groups; nothing but the sketches is read."""
    return sketches.groupBy(*group_cols).agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.kll_merge_agg_double("sketch").alias("sketch"))


def sketched_summary(sketches: DataFrame, group_cols: Sequence[str], ps: Sequence[float] = (0.5, 0.95, 0.99)) -> DataFrame:
    """Count, percentiles and mean of each sketch; a percentile is a value whose rank is nearly the one asked for."""
    found = [F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(f"p{int(round(p * 100))}") for p in ps]
    return sketches.select(*group_cols, "n", *found, (F.col("total") / F.col("n")).alias("mean"))


def timed(action: Callable[[], object]) -> tuple[object, int]:
    """V9: run an action and return ``(result, whole milliseconds)``."""
    t0 = time.perf_counter()
    out = action()
    return out, int((time.perf_counter() - t0) * 1000)


def capacity(df: DataFrame, dim: int | None = None, partition_col: str = "dt", vector_col: str = "value", with_files: bool = False) -> DataFrame:
    """Rows and vector bytes per day (of each row's own length, unless ``dim`` is given); with ``with_files``
    also files and their bytes on disk, for a file table (``_metadata`` column)."""
    size = F.lit(dim) if dim else F.coalesce(F.size(vector_col), F.lit(0))
    aggs = [F.count(F.lit(1)).alias("rows"), F.sum((size * 4).cast("long")).alias("vector_bytes")]
    if not with_files:
        return df.groupBy(partition_col).agg(*aggs)
    per_file = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_size").alias("_size")).groupBy(partition_col, "_file", "_size").agg(*aggs)
    return per_file.groupBy(partition_col).agg(F.sum("rows").alias("rows"), F.sum("vector_bytes").alias("vector_bytes"),
                                               F.count(F.lit(1)).alias("files"), F.sum("_size").alias("file_bytes"))

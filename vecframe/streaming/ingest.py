"""Structured Streaming ingest (T1, T2, T4) and periodic search.

Streams are append-only and keep no state beyond source offsets, but for the
standing queries, whose state is their top k; every query has its own checkpoint folder under the shared checkpoint directory,
so a restarted driver resumes where it stopped and adds no row twice.
"""

from __future__ import annotations

import datetime as _dt
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vecframe.functions.dates import day_partition
from vecframe.session import scratch_path


def file_stream(spark: SparkSession, source_dir: str, schema, glob: str | None = None,
                max_files_per_trigger: int | None = None, fmt: str = "parquet") -> DataFrame:
    """A file source with an explicit schema (new files are picked up in order)."""
    r = spark.readStream.schema(schema).format(fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(source_dir)


def _trigger(writer, trigger: str | float):
    if trigger == "availableNow":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{float(trigger)} seconds")


def daily_append(stream: DataFrame, sink_path: str, checkpoint: str, ts_col: str = "ts",
                 trigger: str | float = "availableNow", partition_col: str = "dt") -> StreamingQuery:
    """Each row goes to its own day partition ``dt = yyyyMMdd(ts)``."""
    out = stream.withColumn(partition_col, day_partition(F.col(ts_col)))
    w = (out.writeStream.format("parquet").option("path", sink_path).option("checkpointLocation", checkpoint)
         .partitionBy(partition_col).outputMode("append"))
    return _trigger(w, trigger).start()


def rate_ingest(spark: SparkSession, rows_per_second: int, make_rows: Callable[[DataFrame], DataFrame],
                sink_path: str, checkpoint: str, trigger_seconds: float = 1.0) -> StreamingQuery:
    """T1 with a clock-driven source: ``rows_per_second`` rows into today's day.

    ``make_rows`` turns the rate source's ``(timestamp, value)`` rows into
    table rows (for instance :func:`vecframe.sources.generate.bench_rows`).
    """
    src = spark.readStream.format("rate").option("rowsPerSecond", str(rows_per_second)).load()
    rows = make_rows(src.withColumnRenamed("value", "id")).withColumn("dt", day_partition(F.current_timestamp()))
    w = (rows.writeStream.format("parquet").option("path", sink_path).option("checkpointLocation", checkpoint)
         .partitionBy("dt").outputMode("append"))
    return _trigger(w, trigger_seconds).start()


def phase_rates(df: DataFrame, ts_col: str = "ts", cycle_seconds: int = 60, high_seconds: int = 10) -> DataFrame:
    """Rows per load phase of a repeating cycle (first ``high_seconds`` of
    each ``cycle_seconds`` = "high", the rest "low"), and cycles seen."""
    ts = F.col(ts_col)
    # epoch seconds of a wall-clock (NTZ) time, read as UTC whatever the session zone
    sec = (F.unix_date(F.to_date(ts)).cast("long") * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60
           + F.second(ts))
    x = df.select(F.floor(sec / cycle_seconds).alias("cycle"),
                  F.when(F.pmod(sec, F.lit(cycle_seconds)) < high_seconds, F.lit("high")).otherwise(F.lit("low")).alias("phase"))
    return x.groupBy("phase").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("cycle").alias("cycles"))


def cycle_rates(df: DataFrame, ts_col: str = "ts", cycle_seconds: int = 60, high_seconds: int = 10, high_rows: int = 10_000,
                low_rate: int = 50) -> DataFrame:
    """T2 cycle by cycle: rows of each phase against what the load plan expects - ``high_rows`` in the high phase,
    ``low_rate`` for each second of the low phase that has rows."""
    ts = F.col(ts_col)
    sec = F.unix_date(F.to_date(ts)).cast("long") * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    x = df.where(ts.isNotNull()).select(
        F.floor(sec / cycle_seconds).alias("cycle"), sec.alias("sec"),
        F.when(F.pmod(sec, F.lit(cycle_seconds)) < high_seconds, "high").otherwise("low").alias("phase"))
    seconds = x.groupBy("cycle", "phase", "sec").agg(F.count(F.lit(1)).alias("n"))
    per = seconds.groupBy("cycle", "phase").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("seconds"))
    expected = F.when(F.col("phase") == "high", F.lit(high_rows)).otherwise(F.col("seconds") * low_rate).cast("long")
    return per.select("cycle", "phase", "rows", "seconds", expected.alias("expected"))


def periodic_search(trigger_stream: DataFrame, snapshot: Callable[[], DataFrame],
                    run_search: Callable[[DataFrame], DataFrame], sink_path: str, checkpoint: str,
                    trigger: str | float = 60.0) -> StreamingQuery:
    """On each trigger, search the *current* snapshot and append the hits
    with the batch id and the search time in whole ms.  Each batch writes
    ``batch_id=<id>`` with overwrite, so a replayed batch replaces itself."""

    def each(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        hits = run_search(snapshot())
        place = scratch_path(spark, "tick")
        t0 = time.perf_counter()
        hits.write.parquet(place)  # the search runs here, once; what follows reads its few hits
        ms = int((time.perf_counter() - t0) * 1000)
        spark.read.schema(hits.schema).parquet(place).withColumn("ms", F.lit(ms)).write.mode("overwrite").parquet(f"{sink_path}/batch_id={batch_id}")

    w = trigger_stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def standing_topk(rows: DataFrame, queries, sink_path: str, checkpoint: str, metric: str = "IP", k: int = 10, *, dim: int,
                  id_col: str = "id", vector_col: str = "value", tie_cols: Sequence[str] = (), trigger: str | float = "availableNow") -> StreamingQuery:
    """T3 without a rescan: standing queries over a stream of new rows.

    Each query's current top k is its state.  A micro-batch is searched by itself (the queries are broadcast, every task
    keeps its best), and only these candidates go to the state.  A tick appends ``(qid, rank, id, score, ties...)`` of the
    queries that had candidates, as ``batch_id=<id>`` with overwrite; ids and tie columns are numbers."""
    from vecframe.functions.vector import check_metric, higher_is_better
    from vecframe.operators.search import MAX_BROADCAST_QUERY_BYTES, _broadcast_candidates, _collect_queries, query_frame
    metric = check_metric(metric)
    spark = rows.sparkSession
    qids, Q, _ = _collect_queries(query_frame(spark, queries))
    if Q.nbytes > MAX_BROADCAST_QUERY_BYTES or len(qids) and Q.shape[1] != dim:
        raise ValueError("the standing queries are one bounded set of vectors of the table's dimension")
    keep = list(dict.fromkeys([id_col, *tie_cols]))
    found = _broadcast_candidates(rows, vector_col, id_col, keep, metric, k, qids, Q, dim)
    order, better = ["score", *keep], [not higher_is_better(metric)] + [True] * len(keep)
    names = ["score", *keep]
    kinds = [rows.schema[c].dataType.simpleString() for c in keep]
    state_schema = "score array<double>, " + ", ".join(f"`{c}` array<{t}>" for c, t in zip(keep, kinds))
    out_schema = "qid long, rank long, score double, " + ", ".join(f"`{c}` {t}" for c, t in zip(keep, kinds))

    def update(key, frames, state):
        import pandas as pd
        parts = [f[names] for f in frames]
        if state.exists:
            parts.append(pd.DataFrame(dict(zip(names, (list(x) for x in state.get)))))
        parts = [p for p in parts if len(p)] or parts[:1]
        best = pd.concat(parts, ignore_index=True).dropna(subset=["score"]).sort_values(order, ascending=better, kind="stable").head(k)
        state.update(tuple(best[c].tolist() for c in names))
        best.insert(0, "rank", range(1, len(best) + 1))
        best.insert(0, "qid", key[0])
        yield best

    current = found.groupBy("qid").applyInPandasWithState(update, out_schema, state_schema, "update", "NoTimeout")

    def each(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.select("qid", "rank", id_col, "score", *[c for c in tie_cols if c != id_col]).write.mode("overwrite").parquet(f"{sink_path}/batch_id={batch_id}")

    w = current.writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def expiry_job(spark: SparkSession, table: str, today: _dt.date, keep_days: int = 7) -> str:
    """T4: the daily batch job - drop exactly the day ``today - keep_days``."""
    from vecframe.operators.tables import expire_day
    return expire_day(spark, table, today, keep_days)


def run_to_end(q: StreamingQuery, timeout_s: float = 600) -> None:
    """Wait for an ``availableNow`` query; re-raise its failure."""
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError("stream did not finish in time")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def scratch(spark: SparkSession, name: str) -> tuple[str, str]:
    """``(sink, checkpoint)`` folders for one stream run."""
    base = scratch_path(spark, name)
    return f"{base}/sink", f"{base}/checkpoint"

"""Request streams (T5 search requests, T6 insert requests).

A request is a row, not an HTTP call: ``(qid, vec, topk, partitions)`` for a
search and ``(req_id, num_text)`` for an insert.  ``foreachBatch`` joins each
micro-batch of requests with the static collection; results are written per
batch id (overwrite), so a replayed batch is idempotent.  A request that can't
be answered fails alone: it goes to the error output, the others are served.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vecframe.functions.text import split_by_comma, validate_insert_num
from vecframe.operators.search import search, sized_search, vector_dim
from vecframe.session import cut_lineage

# What a request gets that names no number.
DEFAULT_TOPK = 10
DEFAULT_INSERT = "1000"


def checked_requests(requests: DataFrame, dim: int | None) -> DataFrame:
    """Requests with a number of their own, their day list, the default ``topk``, and ``error`` where they can't be answered.

    ``qid`` need not be unique.  The numbered rows are checkpointed, so that all later steps see the same numbers."""
    topk = F.coalesce(F.col("topk").cast("int"), F.lit(DEFAULT_TOPK))
    error = (F.when(F.col("vec").isNull(), "no vector").when(F.size("vec") != (dim or 0), f"a vector of {dim} values is needed")
             .when(topk < 1, "topk must be positive"))
    return cut_lineage(requests.select("qid", "vec", topk.alias("topk"), split_by_comma(F.col("partitions")).alias("parts"),
                                       F.monotonically_increasing_id().alias("_no"), error.alias("error")))


def answer_checked(base: DataFrame, checked: DataFrame, dim: int | None, metric: str = "IP", fields=("deviceCode", "createTime"),
                   tie_cols=(), partition_col: str = "dt") -> DataFrame:
    """``(qid, rank, id, score, fields...)``: as many hits as each request asks for.

    All requests of a batch are answered in one scan; a task keeps for each as many candidates as its size class (16, 32,
    64 ...) says, so that one large request does not make the others keep as many.  A batch that asks for more than a task
    may keep is answered class by class."""
    good = checked.where(F.col("error").isNull()).withColumn("_class", F.greatest(F.lit(4), F.ceil(F.log2("topk"))).cast("int"))
    fields = [c for c in fields if c in base.columns]
    asked = good.select(F.col("_no").alias("qid"), "vec", "parts", F.pow(F.lit(2.0), F.col("_class")).cast("long").alias("k"))
    names = good.select(F.col("_no"), F.col("qid").alias("_qid"), "topk")

    def named(hits):
        return (hits.join(names, hits["qid"] == names["_no"]).where(F.col("rank") <= F.col("topk"))
                .select(F.col("_qid").alias("qid"), *[c for c in hits.columns if c != "qid"]))

    if dim is not None:
        hits = sized_search(base, asked, metric, dim=dim, fields=fields, tie_cols=list(tie_cols), partition_col=partition_col)
        if hits is not None:
            return named(hits)
    out = None
    for (size,) in sorted(tuple(r) for r in good.select("_class").distinct().collect()):  # 28 at most
        mine = good.where(F.col("_class") == size)
        k = mine.agg(F.max("topk")).first()[0]
        hits = search(base, mine.select(F.col("_no").alias("qid"), "vec", "parts"), metric, k, fields=fields, tie_cols=list(tie_cols),
                      partition_col=partition_col, dim=dim, query_partitions_col="parts")
        out = named(hits) if out is None else out.unionByName(named(hits))
    if out is None:
        cols = [base.schema[c] for c in ["id", *fields]]
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cols[1:])
        return base.sparkSession.createDataFrame([], f"qid {checked.schema['qid'].dataType.simpleString()}, rank long, "
                                                     f"id {cols[0].dataType.simpleString()}, score double" + (", " + kinds if kinds else ""))
    return out


def answer_search_requests(base: DataFrame, requests: DataFrame, metric: str = "IP", fields=("deviceCode", "createTime"),
                           tie_cols=(), partition_col: str = "dt") -> DataFrame:
    """Top-``topk`` per request over the request's own days (``''`` = all);
    requests that can't be answered have no rows (see ``checked_requests``)."""
    dim = vector_dim(base, "value")
    return answer_checked(base, checked_requests(requests, dim), dim, metric, fields, tie_cols, partition_col)


def search_request_stream(requests: DataFrame, base: DataFrame, sink_path: str, checkpoint: str,
                          metric: str = "IP", trigger="availableNow", error_path: str | None = None,
                          fields=("deviceCode", "createTime"), tie_cols=()) -> StreamingQuery:
    """T5: answer each micro-batch of search requests; with ``error_path`` the
    rejected ones go there as ``(qid, error)``."""

    def each(batch_df: DataFrame, batch_id: int) -> None:
        dim = vector_dim(base, "value")
        checked = checked_requests(batch_df, dim)
        if error_path:
            checked.where(F.col("error").isNotNull()).select("qid", "error").write.mode("overwrite").parquet(f"{error_path}/batch_id={batch_id}")
        answer_checked(base, checked, dim, metric, fields, tie_cols).write.mode("overwrite").parquet(f"{sink_path}/batch_id={batch_id}")

    w = requests.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger == "availableNow" else w.trigger(processingTime=f"{trigger} seconds")
    return w.start()


def validated_inserts(requests: DataFrame, text_col: str = "num_text") -> DataFrame:
    """``num`` (accepted; 1000 where none is named) or ``error`` for each insert request."""
    num, err = validate_insert_num(F.coalesce(F.col(text_col), F.lit(DEFAULT_INSERT)))
    return requests.withColumn("num", num).withColumn("error", err)


def insert_request_stream(requests: DataFrame, sink_path: str, checkpoint: str, trigger="availableNow",
                          table: str | None = None, dim: int | None = None, time_col: str | None = None) -> StreamingQuery:
    """Validate a stream of insert requests.  Every request (accepted or
    with its error text) goes to the sink; with ``table`` the accepted ones
    also append their generated rows to the day of ``time_col`` (epoch ms of
    the request; without it, the clock's).

    A table that was created with ``batch_key=True`` takes a micro-batch as the
    partition ``batch_id`` of a day and overwrites it, so a replayed batch adds
    nothing twice; so does the request log.  Other tables are appended to."""
    out = validated_inserts(requests)

    def each(batch_df: DataFrame, batch_id: int) -> None:
        import time as _time
        batch_df.write.mode("overwrite").parquet(f"{sink_path}/batch_id={batch_id}")
        if table is not None:
            from vecframe.functions.dates import day_partition
            from vecframe.operators.tables import append, request_rows
            now = F.col(time_col).cast("long") if time_col else F.lit(int(_time.time() * 1000)).cast("long")
            rows = request_rows(batch_df, dim or 0, now)
            append(batch_df.sparkSession, table, rows.withColumn("dt", day_partition(F.timestamp_millis(F.col("createTime")))),
                   batch_id=batch_id)

    w = out.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger == "availableNow" else w.trigger(processingTime=f"{trigger} seconds")
    return w.start()

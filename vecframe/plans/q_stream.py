"""Registered streaming queries (T1, T2, T5, T6): each runs a stream to the
end (``availableNow``) over a file source, then reads its sink back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecframe.plans.q_functions import _REQ_SQL
from vecframe.plans.registry import register
from vecframe.plans.sqlgen import topk_sql
from vecframe.plans.views import QUERY_STEP, SQL_COLLECTION, SQL_STORED_QUERIES, collection_view, stored_queries, table
from vecframe.session import scratch_path
from vecframe.streaming.ingest import cycle_rates, daily_append, file_stream, phase_rates, run_to_end, scratch
from vecframe.streaming.requests import insert_request_stream, search_request_stream


def _stream_of(spark, sf_dir, name):
    schema = table(spark, sf_dir, name).schema
    return file_stream(spark, sf_dir, schema, glob=f"{name}.parquet"), schema


@register("stream_daily_append", """
SELECT strftime(ts, '%Y%m%d') AS dt, count(*) AS n FROM events GROUP BY 1
""")
def stream_daily_append(spark, sf_dir):
    """Events streamed into day partitions; rows per day read back from the sink."""
    src, schema = _stream_of(spark, sf_dir, "events")
    sink, ckpt = scratch(spark, "daily-append")
    run_to_end(daily_append(src, sink, ckpt, ts_col="ts"))
    out_schema = T.StructType(schema.fields + [T.StructField("dt", T.StringType())])
    return spark.read.schema(out_schema).parquet(sink).groupBy("dt").agg(F.count(F.lit(1)).alias("n"))


@register("ingest_phase_rates", """
WITH x AS (SELECT CAST(floor(epoch(ts)) AS BIGINT) AS sec FROM events)
SELECT CASE WHEN sec % 60 < 10 THEN 'high' ELSE 'low' END AS phase, count(*) AS rows,
       count(DISTINCT sec // 60) AS cycles
FROM x GROUP BY 1
""")
def ingest_phase_rates(spark, sf_dir):
    """Rows in the high (first 10 s) and low phase of each 60 s cycle."""
    return phase_rates(table(spark, sf_dir, "events"), "ts")


@register("ingest_cycle_rates", """
WITH x AS (SELECT CAST(floor(epoch(ts)) AS BIGINT) AS sec FROM events),
y AS (SELECT sec // 60 AS cycle, CASE WHEN sec % 60 < 10 THEN 'high' ELSE 'low' END AS phase, sec FROM x)
SELECT cycle, phase, count(*) AS rows, count(DISTINCT sec) AS seconds,
       CAST(CASE phase WHEN 'high' THEN 10000 ELSE 50 * count(DISTINCT sec) END AS BIGINT) AS expected
FROM y GROUP BY cycle, phase
""")
def ingest_cycle_rates(spark, sf_dir):
    """Rows of each phase of each cycle against the load plan."""
    return cycle_rates(table(spark, sf_dir, "events"), "ts")


_REQUESTS_SQL = f"""
c AS ({SQL_COLLECTION}),
qs AS ({SQL_STORED_QUERIES}),
whole AS (SELECT qid, qv, CASE (qid // 20) % 4 WHEN 0 THEN 10 WHEN 1 THEN 3 WHEN 2 THEN 25 ELSE 100 END AS topk, '' AS days FROM qs WHERE qid NOT IN (100, 140)),
reqs AS (SELECT * FROM whole
         UNION ALL SELECT qid, qv, topk, CASE (qid // 20) % 3 WHEN 1 THEN '20250817,,20250815' ELSE '20250816' END FROM whole WHERE (qid // 20) % 3 <> 0
         UNION ALL SELECT qid, qv, 2, '' FROM qs WHERE qid = 60),
n AS (SELECT *, row_number() OVER () AS no FROM reqs),
s AS (SELECT no, qid, topk, c.id, list_inner_product(c.value, qv) AS score, deviceCode, createTime, dt
      FROM n JOIN c ON days = '' OR list_contains(string_split(days, ','), c.dt)),
r AS (SELECT *, row_number() OVER (PARTITION BY no ORDER BY score DESC, id, dt, createTime) AS rk FROM s)
"""


@register("stream_request_topk", f"""
WITH {_REQUESTS_SQL}
SELECT qid, CAST(rk AS BIGINT) AS rank, id, round(score, 6) AS score, deviceCode, createTime, NULL AS error FROM r WHERE rk <= topk
UNION ALL SELECT 100, NULL, NULL, NULL, NULL, NULL, 'a vector of 64 values is needed'
UNION ALL SELECT 140, NULL, NULL, NULL, NULL, NULL, 'no vector'
UNION ALL SELECT 160, NULL, NULL, NULL, NULL, NULL, 'topk must be positive'
""")
def stream_request_topk(spark, sf_dir):
    """T5: a stream of search requests, every 20th row against all rows: topk absent (10), small and large; two of three
    ask again with a day list, one with another topk; requests that can't be answered."""
    view = collection_view(spark, sf_dir)
    qs = stored_queries(view)
    topk = F.expr("CASE qid div 20 % 4 WHEN 1 THEN 3 WHEN 2 THEN 25 WHEN 3 THEN 100 END").cast("int")
    vec = F.when(F.col("qid") == 100, F.slice("vec", 1, 10)).when(F.col("qid") != 140, F.col("vec"))
    reqs = qs.select("qid", vec.alias("vec"), topk.alias("topk"), F.lit("").alias("partitions"))
    listed = reqs.where("qid div 20 % 3 <> 0 AND qid NOT IN (100, 140)").withColumn(
        "partitions", F.expr("CASE qid div 20 % 3 WHEN 1 THEN '20250817,,20250815' ELSE '20250816' END"))
    again = qs.where("qid = 60").select("qid", "vec", F.lit(2).alias("topk"), F.lit("").alias("partitions"))
    none = qs.where("qid = 160").select("qid", "vec", F.lit(0).alias("topk"), F.lit("").alias("partitions"))
    source = scratch_path(spark, "request-rows")
    rows = reqs.unionByName(listed).unionByName(again).unionByName(none)
    rows.write.parquet(source)
    sink, ckpt = scratch(spark, "search-requests")
    run_to_end(search_request_stream(file_stream(spark, source, rows.schema), view.select("id", "value", "deviceCode", "createTime", "dt"), sink, ckpt, "IP",
                                     error_path=f"{sink}-errors", tie_cols=["dt", "createTime"]))
    hits = spark.read.parquet(sink).select("qid", "rank", "id", F.round("score", 6).alias("score"), "deviceCode", "createTime")
    return hits.withColumn("error", F.lit(None).cast("string")).unionByName(
        spark.read.parquet(f"{sink}-errors").select("qid", "error"), allowMissingColumns=True)


@register("stream_insert_requests", f"""
WITH r AS ({_REQ_SQL}), p AS (SELECT *, TRY_CAST(num_text AS BIGINT) AS v FROM r),
x AS (SELECT CASE WHEN v IS NOT NULL AND v BETWEEN 0 AND 50000 THEN v END AS num,
             CASE WHEN v IS NULL THEN 'not an integer' WHEN v > 50000 THEN 'too many rows'
                  WHEN v < 0 THEN 'negative' END AS error FROM p)
SELECT error, count(*) AS requests, CAST(sum(num) AS BIGINT) AS rows_requested FROM x GROUP BY error
""")
def stream_insert_requests(spark, sf_dir):
    """A stream of insert requests validated; requests and rows asked for, per outcome."""
    src, _ = _stream_of(spark, sf_dir, "events")
    t = (F.when(F.col("event_type") == "error", F.concat(F.lit("n"), F.col("user_id").cast("string")))
         .when(F.col("event_type") == "signup", F.concat(F.lit("-"), F.col("user_id").cast("string")))
         .otherwise(F.floor(F.col("value") * 1000).cast("long").cast("string")))
    reqs = src.select(F.col("event_id").alias("req_id"), t.alias("num_text"))
    sink, ckpt = scratch(spark, "insert-requests")
    run_to_end(insert_request_stream(reqs, sink, ckpt))
    out = spark.read.parquet(sink)
    return out.groupBy("error").agg(F.count(F.lit(1)).alias("requests"), F.sum("num").alias("rows_requested"))


@register("stream_insert_rows", """
WITH e AS (SELECT epoch_ms(ts) AS ms, strftime(ts, '%Y%m%d') AS dt, CASE WHEN event_id % 5 = 4 THEN NULL ELSE event_id % 5 - 1 END AS num FROM events
           WHERE event_id % 5 <> 4 OR event_id % 1000 = 4),
r AS (SELECT dt, ms, unnest(range(0, coalesce(num, 1000))) AS id FROM e WHERE coalesce(num, 1000) > 0)
SELECT dt, count(*) AS n, CAST(sum(id) AS BIGINT) AS id_sum, count(DISTINCT ms) AS times FROM r GROUP BY dt
""")
def stream_insert_rows(spark, sf_dir):
    """T6 + S8: accepted insert requests append their rows to the request's day, also when a micro-batch is
    written again; a request without a number makes 1000 rows, a negative one none."""
    import uuid

    from vecframe.functions.dates import epoch_millis_utc
    from vecframe.operators import tables as TB
    src, _ = _stream_of(spark, sf_dir, "events")
    num = F.when(F.col("event_id") % 5 != 4, (F.col("event_id") % 5 - 1).cast("string"))
    reqs = src.where("event_id % 5 <> 4 OR event_id % 1000 = 4").select(
        F.col("event_id").alias("req_id"), num.alias("num_text"), epoch_millis_utc("ts").alias("at_ms"))
    name = f"vf_ins_{uuid.uuid4().hex[:10]}"
    TB.create_collection(spark, name, dim=2, location=scratch_path(spark, "inserts"), batch_key=True)
    for turn in range(2):  # the second run, with a checkpoint of its own, writes batch 0 once more
        sink, ckpt = scratch(spark, f"insert-rows-{turn}")
        run_to_end(insert_request_stream(reqs, sink, ckpt, table=name, dim=2, time_col="at_ms"))
    spark.catalog.refreshTable(name)
    counts = spark.table(name).groupBy("dt").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("id_sum"), F.countDistinct("createTime").alias("times"))
    path = scratch_path(spark, "insert-counts")
    counts.write.parquet(path)
    TB.drop_collection(spark, name)
    return spark.read.schema(counts.schema).parquet(path)


_STEP_SQL = topk_sql("SELECT * FROM all_rows WHERE {}", SQL_STORED_QUERIES, "IP", 5, fields="", out_fields="").replace("WITH c AS", "c AS", 1)


def _step(number: int, where: str) -> str:
    return f"SELECT {number} AS step, t.* FROM (WITH all_rows AS ({SQL_COLLECTION}), {_STEP_SQL.format(where).strip()}) t"


@register("search_while_inserting", _step(1, "id % 2 = 0") + " UNION ALL " + _step(2, "TRUE"))
def search_while_inserting(spark, sf_dir):
    """A collection is searched after each of two ingest steps and finds what has been committed by then."""
    import uuid

    from vecframe.operators import tables as TB
    from vecframe.operators.search import search
    view = collection_view(spark, sf_dir)
    name = f"vf_live_{uuid.uuid4().hex[:10]}"
    TB.create_collection(spark, name, dim=64, location=scratch_path(spark, "live"))
    path = scratch_path(spark, "live-hits")
    for step, part in ((1, "id % 2 = 0"), (2, "id % 2 = 1")):
        TB.append_today(spark, name, view.where(part).select("id", "value", "deviceCode", "createTime"))
        spark.catalog.refreshTable(name)
        now = spark.table(name).join(view.select("id", "label"), "id")
        hits = search(spark.table(name), stored_queries(now), "IP", 5, fields=[], tie_cols=["dt", "createTime"])
        hits.select(F.lit(step).alias("step"), "qid", "rank", "id", F.round("score", 6).alias("score")).write.mode("append").parquet(path)
    TB.drop_collection(spark, name)
    return spark.read.parquet(path)


@register("request_topk_own_days", f"""
WITH c AS ({SQL_COLLECTION}), qs AS (SELECT id AS qid, value AS qv, dt AS day FROM c WHERE id % {QUERY_STEP} = 0),
s AS (SELECT qid, c.id, list_inner_product(c.value, qv) AS score, c.dt
      FROM qs JOIN c ON c.dt IN (day, strftime(strptime(day, '%Y%m%d') - INTERVAL 1 DAY, '%Y%m%d'))),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rk FROM s)
SELECT qid, CAST(rk AS BIGINT) AS rank, id, round(score, 6) AS score, dt FROM r WHERE rk <= 5
""")
def request_topk_own_days(spark, sf_dir):
    """T5 with per-request day lists: every 20th row asks for its own day and the day before."""
    from vecframe.functions.dates import day_shift
    from vecframe.streaming.requests import answer_search_requests
    view = collection_view(spark, sf_dir)
    reqs = view.where(F.col("id") % QUERY_STEP == 0).select(
        F.col("id").alias("qid"), F.col("value").alias("vec"), F.lit(5).alias("topk"),
        F.concat_ws(",", "dt", day_shift(F.to_date("dt", "yyyyMMdd"), 1)).alias("partitions"))
    res = answer_search_requests(view.select("id", "value", "dt"), reqs, "IP", fields=["dt"])
    return res.select("qid", "rank", "id", F.round("score", 6).alias("score"), "dt")


@register("stream_periodic_topk", topk_sql(SQL_COLLECTION, "SELECT id AS qid, value AS qv FROM c WHERE id = 0",
                                           "IP", 10, with_qid=False))
def stream_periodic_topk(spark, sf_dir):
    """Every micro-batch of the events stream is a tick that searches the
    current collection snapshot (row 0's vector, IP, k = 10); hits read back."""
    from vecframe.operators.search import search
    from vecframe.plans.views import query_of
    from vecframe.streaming.ingest import periodic_search
    src, _ = _stream_of(spark, sf_dir, "events")
    sink, ckpt = scratch(spark, "periodic")
    view = collection_view(spark, sf_dir)
    q = query_of(view, 0)
    run_to_end(periodic_search(src.select("event_id"), lambda: view,
                               lambda base: search(base, q, "IP", 10, fields=["deviceCode", "createTime", "dt"],
                                                   tie_cols=["dt", "createTime"]).drop("qid"),
                               sink, ckpt, trigger="availableNow"))
    return spark.read.parquet(sink).select("rank", "id", F.round("score", 6).alias("score"),
                                           "deviceCode", "createTime", "dt")


def _tick(number: int, parts: str) -> str:
    return _step(number, f"id % 3 IN ({parts})").replace(" AS step", " AS tick").replace("FROM c WHERE id % 20", "FROM all_rows WHERE id % 20")


@register("stream_standing_topk", _tick(0, "0") + " UNION ALL " + _tick(1, "0, 1") + " UNION ALL " + _tick(2, "0, 1, 2"))
def stream_standing_topk(spark, sf_dir):
    """T3 with state: standing queries (every 20th row) over a collection that grows by a third with each of three
    micro-batches; what each tick says is what a search of all rows so far would."""
    import time

    from vecframe.streaming.ingest import standing_topk
    view = collection_view(spark, sf_dir).select("id", "value")
    source = scratch_path(spark, "growing")
    for part in range(3):  # the file source takes files by their time
        view.where(F.col("id") % 3 == part).coalesce(1).write.parquet(f"{source}/part={part}")
        time.sleep(0.05)
    sink, ckpt = scratch(spark, "standing")
    rows = file_stream(spark, f"{source}/part=*", view.schema, max_files_per_trigger=1)
    run_to_end(standing_topk(rows, stored_queries(view), sink, ckpt, "IP", 5, dim=64))
    schema = T.StructType([T.StructField("qid", T.LongType()), T.StructField("rank", T.LongType()), T.StructField("id", T.LongType()),
                           T.StructField("score", T.DoubleType()), T.StructField("batch_id", T.IntegerType())])
    return spark.read.schema(schema).parquet(sink).select(F.col("batch_id").alias("tick"), "qid", "rank", "id", F.round("score", 6).alias("score"))


@register("insert_lifecycle", """
WITH e AS (SELECT epoch_ms(ts) AS ms, strftime(ts, '%Y%m%d') AS dt, event_id % 5 AS num FROM events),
r AS (SELECT dt, unnest(range(0, num)) AS id FROM e WHERE num > 0),
days AS (SELECT dt, row_number() OVER (ORDER BY dt) AS i FROM (SELECT DISTINCT dt FROM r)),
left_ AS (SELECT r.* FROM r JOIN days USING (dt) WHERE i <> 2)
SELECT dt, count(*) AS n, CAST(sum(id) AS BIGINT) AS id_sum, 1 AS listed, CASE WHEN dt = (SELECT min(dt) FROM days) THEN 1 ELSE 2 END AS partitions
FROM left_ GROUP BY dt
""")
def insert_lifecycle(spark, sf_dir):
    """T6 then L7, T4 and P1's compaction on a table of batches: two micro-batches of insert requests, the second day
    expires, the first is compacted, and the days are listed and counted."""
    import datetime as dt_
    import time
    import uuid

    from vecframe.functions.dates import epoch_millis_utc
    from vecframe.operators import tables as TB
    ev = table(spark, sf_dir, "events")
    reqs = ev.select(F.col("event_id").alias("req_id"), (F.col("event_id") % 5).cast("string").alias("num_text"), epoch_millis_utc("ts").alias("at_ms"))
    source = scratch_path(spark, "insert-source")
    for part in range(2):
        reqs.where(F.pmod(F.xxhash64("req_id"), F.lit(2)) == part).coalesce(1).write.parquet(f"{source}/part={part}")
        time.sleep(0.05)
    name = f"vf_cycle_{uuid.uuid4().hex[:10]}"
    TB.create_collection(spark, name, dim=2, location=scratch_path(spark, "cycle"), batch_key=True)
    sink, ckpt = scratch(spark, "cycle-requests")
    stream = file_stream(spark, f"{source}/part=*", reqs.schema, max_files_per_trigger=1)
    run_to_end(insert_request_stream(stream, sink, ckpt, table=name, dim=2, time_col="at_ms"))
    days = TB.list_partitions(spark, name)
    second = dt_.datetime.strptime(days[1], "%Y%m%d").date()
    TB.expire_day(spark, name, second + dt_.timedelta(days=7), 7)
    TB.compact_day(spark, name, days[0], 2, scratch_path(spark, "compacted"))
    spark.catalog.refreshTable(name)
    listed = [(d, len(TB.partition_specs(spark, name, d))) for d in TB.list_partitions(spark, name)]
    rows = spark.table(name).groupBy("dt").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("id_sum"))
    named = spark.createDataFrame([(d, 1, p) for d, p in listed], "day string, listed int, partitions int")
    out = rows.join(F.broadcast(named), F.col("dt") == F.col("day"), "left").select("dt", "n", "id_sum", "listed", "partitions")
    path = scratch_path(spark, "cycle-counts")
    out.write.parquet(path)
    TB.drop_collection(spark, name)
    return spark.read.schema(out.schema).parquet(path)

"""Registered queries for scalar functions, batching and generators."""

from __future__ import annotations

from pyspark.sql import functions as F

from vecframe.functions.dates import day_shift, parse_date_string
from vecframe.functions.text import split_by_comma, validate_insert_num
from vecframe.functions.vector import chunk_array, vector_text
from vecframe.plans.registry import register
from vecframe.plans.views import SQL_COLLECTION, collection_view, table

_SPARK_LAYOUTS = ["yyyy-MM-dd", "yyyy/MM/dd", "dd-MM-yyyy", "dd/MM/yyyy", "yyyyMMdd", "yyyy-MM-dd HH:mm:ss",
                  "yyyy-M-d"]


def _date_inputs(spark, sf_dir):
    """Event times written in the six layouts, one unpadded layout, and non-dates."""
    ev = table(spark, sf_dir, "events")
    k = F.pmod(F.col("event_id"), F.lit(8))
    s = F.when(k == 7, F.col("event_type"))
    for i, fmt in enumerate(_SPARK_LAYOUTS):
        s = s.when(k == i, F.date_format("ts", fmt))
    return ev.select("event_id", s.alias("s"))


_PARSE_SQL = r"""
WITH x AS (
  SELECT event_id,
         CASE event_id % 8
           WHEN 0 THEN strftime(ts, '%Y-%m-%d') WHEN 1 THEN strftime(ts, '%Y/%m/%d')
           WHEN 2 THEN strftime(ts, '%d-%m-%Y') WHEN 3 THEN strftime(ts, '%d/%m/%Y')
           WHEN 4 THEN strftime(ts, '%Y%m%d') WHEN 5 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
           WHEN 6 THEN strftime(ts, '%Y-%-m-%-d') ELSE event_type END AS s
  FROM events)
SELECT event_id, s,
  strftime(CASE
    WHEN regexp_full_match(s, '\d{4}-\d{2}-\d{2}') THEN try_strptime(s, '%Y-%m-%d')
    WHEN regexp_full_match(s, '\d{4}/\d{2}/\d{2}') THEN try_strptime(s, '%Y/%m/%d')
    WHEN regexp_full_match(s, '\d{2}-\d{2}-\d{4}') THEN try_strptime(s, '%d-%m-%Y')
    WHEN regexp_full_match(s, '\d{2}/\d{2}/\d{4}') THEN try_strptime(s, '%d/%m/%Y')
    WHEN regexp_full_match(s, '\d{8}') THEN try_strptime(s, '%Y%m%d')
    WHEN regexp_full_match(s, '\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}') THEN try_strptime(s, '%Y-%m-%d %H:%M:%S')
  END, '%Y-%m-%d %H:%M:%S') AS parsed
FROM x
"""


@register("parse_dates", _PARSE_SQL)
def parse_dates(spark, sf_dir):
    """six layouts tried in order; anything else is NULL."""
    x = _date_inputs(spark, sf_dir)
    return x.select("event_id", "s", F.date_format(parse_date_string("s"), "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@register("day_shift", """
SELECT DISTINCT strftime(ts, '%Y%m%d') AS dt, strftime(CAST(ts AS DATE) - 7, '%Y%m%d') AS expire_dt FROM events
""")
def day_shift_q(spark, sf_dir):
    """the day to expire (7 days back) for every event day."""
    ev = table(spark, sf_dir, "events")
    return (ev.select(F.date_format("ts", "yyyyMMdd").alias("dt"), day_shift(F.col("ts"), 7).alias("expire_dt"))
            .distinct())


_SPLIT_INPUT_SQL = """
SELECT event_id, CASE WHEN event_type = 'view' THEN '' ELSE event_type || ',,' || CAST(user_id AS VARCHAR) END AS s
FROM events
"""


@register("split_csv", f"""
WITH x AS ({_SPLIT_INPUT_SQL}),
p AS (SELECT event_id, CASE WHEN s = '' THEN NULL ELSE string_split(s, ',') END AS parts FROM x)
SELECT event_id, CAST(generate_subscripts(parts, 1) - 1 AS BIGINT) AS pos, unnest(parts) AS part FROM p
""")
def split_csv(spark, sf_dir):
    """Split lists like 'click,,17'; empty parts kept, '' gives no parts."""
    ev = table(spark, sf_dir, "events")
    s = F.when(F.col("event_type") == "view", F.lit("")).otherwise(
        F.concat(F.col("event_type"), F.lit(",,"), F.col("user_id").cast("string")))
    x = ev.select("event_id", split_by_comma(s).alias("parts"))
    return x.select("event_id", F.posexplode("parts").alias("pos", "part")).withColumn("pos", F.col("pos").cast("long"))


_VTEXT_SQL = "'[' || array_to_string(list_transform(embedding, lambda x: printf('%.7f', x)), ',') || ']'"


@register("vector_text", f"SELECT vec_id AS id, {_VTEXT_SQL} AS value_text FROM embeddings")
def vector_text_q(spark, sf_dir):
    """vectors as text with 7 decimals."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"), vector_text("embedding").alias("value_text"))


@register("chunk_array", """
WITH c AS (SELECT vec_id, embedding, unnest(generate_series(0, len(embedding) // 16 - 1)) AS chunk FROM embeddings)
SELECT vec_id AS id, CAST(chunk AS BIGINT) AS chunk,
       '[' || array_to_string(list_transform(embedding[chunk * 16 + 1 : chunk * 16 + 16], lambda x: printf('%.7f', x)), ',') || ']' AS chunk_text
FROM c
""")
def chunk_array_q(spark, sf_dir):
    """each 64-value vector cut into rows of 16 values."""
    e = table(spark, sf_dir, "embeddings")
    x = e.select(F.col("vec_id").alias("id"), F.posexplode(chunk_array("embedding", 16)).alias("chunk", "v"))
    return x.select("id", F.col("chunk").cast("long").alias("chunk"), vector_text("v").alias("chunk_text"))


_REQ_SQL = """
SELECT event_id,
  CASE event_type WHEN 'error' THEN 'n' || CAST(user_id AS VARCHAR)
                  WHEN 'signup' THEN '-' || CAST(user_id AS VARCHAR)
                  ELSE CAST(CAST(floor(value * 1000) AS BIGINT) AS VARCHAR) END AS num_text
FROM events
"""


@register("validate_requests", f"""
WITH r AS ({_REQ_SQL}), p AS (SELECT *, TRY_CAST(num_text AS BIGINT) AS v FROM r)
SELECT event_id, num_text,
  CASE WHEN v IS NOT NULL AND v BETWEEN 0 AND 50000 THEN v END AS num,
  CASE WHEN v IS NULL THEN 'not an integer' WHEN v > 50000 THEN 'too many rows'
       WHEN v < 0 THEN 'negative' END AS error
FROM p
""")
def validate_requests(spark, sf_dir):
    """Insert-size requests parsed; bad ones carry an error text."""
    ev = table(spark, sf_dir, "events")
    t = (F.when(F.col("event_type") == "error", F.concat(F.lit("n"), F.col("user_id").cast("string")))
         .when(F.col("event_type") == "signup", F.concat(F.lit("-"), F.col("user_id").cast("string")))
         .otherwise(F.floor(F.col("value") * 1000).cast("long").cast("string")))
    r = ev.select("event_id", t.alias("num_text"))
    num, err = validate_insert_num(F.col("num_text"))
    return r.select("event_id", "num_text", num.alias("num"), err.alias("error"))


@register("batch_counts", """
SELECT CAST(rn // 1000 AS BIGINT) AS batch, count(*) AS n
FROM (SELECT row_number() OVER () - 1 AS rn FROM lineitem) GROUP BY 1
""")
def batch_counts_q(spark, sf_dir):
    """Lineitem cut into batches of 1000 rows; rows per batch."""
    from vecframe.sources.batches import batch_counts
    return batch_counts(table(spark, sf_dir, "lineitem").select("l_orderkey"), 1000, stable=True)


@register("pick_query", f"""
SELECT id, '[' || array_to_string(list_transform(value, lambda x: printf('%.7f', x)), ',') || ']' AS value_text
FROM ({SQL_COLLECTION}) ORDER BY md5(id || '-42'), id LIMIT 1
""")
def pick_query(spark, sf_dir):
    """One repeatable pick from the query set (hash order)."""
    from vecframe.sources.generate import pick_one
    view = collection_view(spark, sf_dir)
    return pick_one(view).select("id", vector_text("value").alias("value_text"))


@register("epoch_millis", "SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events")
def epoch_millis_q(spark, sf_dir):
    """epoch milliseconds of every event's wall-clock time."""
    from vecframe.functions.dates import epoch_millis_utc
    return table(spark, sf_dir, "events").select("event_id", epoch_millis_utc("ts").cast("long").alias("ms"))


@register("assigned_ids", """
SELECT count(*) AS n, 7 AS first_id, CAST(count(*) + 6 AS BIGINT) AS last_id, count(*) AS distinct_ids FROM orders
""")
def assigned_ids(spark, sf_dir):
    """Dense ids from 7 on for every order."""
    from vecframe.sources.batches import assign_ids
    rows = assign_ids(table(spark, sf_dir, "orders").select("o_orderkey"), start=7, stable=True)
    return rows.agg(F.count(F.lit(1)).alias("n"), F.min("id").cast("int").alias("first_id"), F.max("id").alias("last_id"),
                    F.countDistinct("id").alias("distinct_ids"))

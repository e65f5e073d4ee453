"""Registered source / sink and document-merge queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecframe.functions.vector import vector_text
from vecframe.operators.merge import merge_tables
from vecframe.plans.registry import register
from vecframe.plans.views import table
from vecframe.session import scratch_path
from vecframe.sources.readers import head_rows, read_query_vectors, read_vectors, vector_profile, write_query_vectors

_VTEXT = "'[' || array_to_string(list_transform(embedding, lambda x: printf('%.7f', x)), ',') || ']'"


@register("json_queries", f"SELECT vec_id AS id, {_VTEXT} AS value_text FROM embeddings")
def json_queries(spark, sf_dir):
    """S3 then S2: query vectors written as JSON Lines and read back with a schema."""
    path = scratch_path(spark, "query-json")
    e = table(spark, sf_dir, "embeddings")
    write_query_vectors(e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec")), path, extra=("id",))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("vec", T.ArrayType(T.FloatType()))])
    back = read_query_vectors(spark, path, schema)
    return back.select("id", vector_text("vec").alias("value_text"))


_NOTE = 'a"}, {' + "\\"  # what a reader of strings must not trip over


@register("json_array_queries", f"SELECT vec_id AS id, {_VTEXT} AS value_text, '{_NOTE}' || CAST(vec_id AS VARCHAR) || '[' AS note FROM embeddings")
def json_array_queries(spark, sf_dir):
    """A JSON array a file, each read by many tasks; its strings hold quotes, backslashes, braces and brackets."""
    from vecframe.sources.json_arrays import array_elements, write_json_array
    e = table(spark, sf_dir, "embeddings")
    note = F.concat(F.lit(_NOTE), F.col("vec_id").cast("string"), F.lit("["))
    rows = e.select(F.to_json(F.struct(F.col("vec_id").alias("id"), F.struct(F.col("embedding").alias("vec")).alias("inner"), note.alias("note"))).alias("text"))
    path = scratch_path(spark, "query-array")
    write_json_array(rows, path)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("inner", T.StructType([T.StructField("vec", T.ArrayType(T.FloatType()))])),
                           T.StructField("note", T.StringType())])
    found = array_elements(spark, path).select(F.from_json("text", schema).alias("r"))
    return found.select("r.id", vector_text("r.inner.vec").alias("value_text"), "r.note")


@register("vector_profile", """
SELECT count(*) AS n, CAST(min(len(embedding)) AS BIGINT) AS dim_min, CAST(max(len(embedding)) AS BIGINT) AS dim_max,
       count(*) FILTER (WHERE embedding IS NULL) AS null_vectors
FROM embeddings
""")
def vector_profile_q(spark, sf_dir):
    """Size and shape of an imported vector set (float32 cast, one pass)."""
    v = read_vectors(spark, f"{sf_dir}/embeddings.parquet", vector_col="embedding", id_col="vec_id")
    return vector_profile(v)


@register("vector_head", f"""
SELECT vec_id AS id, {_VTEXT} AS value_text FROM embeddings ORDER BY vec_id LIMIT 5
""")
def vector_head(spark, sf_dir):
    """The first five vectors by id (a top-n report)."""
    v = read_vectors(spark, f"{sf_dir}/embeddings.parquet", vector_col="embedding", id_col="vec_id")
    return head_rows(v, 5).select("id", vector_text("value").alias("value_text"))


@register("custom_dataset", """
SELECT label AS category, count(*) AS n, CAST(min(len(embedding)) AS BIGINT) AS dim FROM embeddings GROUP BY label
""")
def custom_dataset(spark, sf_dir):
    """A dataset read through a user column mapping (label -> category)."""
    v = read_vectors(spark, f"{sf_dir}/embeddings.parquet", vector_col="embedding", id_col="vec_id",
                     mapping={"label": "category"})
    return v.groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.min(F.size("value")).cast("long").alias("dim"))


_MERGE_SQL = """
WITH e AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, user_id, event_type, value
           FROM events),
b AS (SELECT * FROM e WHERE event_type <> 'signup'),
p AS (SELECT * FROM e WHERE value >= 25)
SELECT coalesce(b.event_id, p.event_id) AS key,
  CASE WHEN p.event_id IS NULL
         THEN '{"k":' || CAST(b.k AS VARCHAR) || ',"user":{"id":' || CAST(b.user_id AS VARCHAR) || ',"tags":["'
              || b.event_type || '"]}}'
       WHEN b.event_id IS NULL
         THEN '{"k":null,"user":{"tags":["' || p.event_type || '","hot"],"v":' || CAST(p.value AS VARCHAR)
              || '},"new":[1,1]}'
       ELSE '{"k":null,"user":{"id":' || CAST(b.user_id AS VARCHAR) || ',"tags":["' || b.event_type
            || '","hot"],"v":' || CAST(p.value AS VARCHAR) || '},"new":[1,1]}'
  END AS doc
FROM b FULL OUTER JOIN p ON b.event_id = p.event_id
"""


@register("deep_merge", _MERGE_SQL)
def deep_merge(spark, sf_dir):
    """Nested documents built from events merged with a patch table by key."""
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    base = ev.where(F.col("event_type") != "signup").select(
        F.col("event_id").alias("key"),
        F.to_json(F.struct(k.alias("k"), F.struct(F.col("user_id").alias("id"),
                                                  F.array("event_type").alias("tags")).alias("user"))).alias("doc"))
    patch = ev.where(F.col("value") >= 25).select(
        F.col("event_id").alias("key"),
        F.to_json(F.struct(F.lit(None).cast("long").alias("k"),
                           F.struct(F.array("event_type", F.lit("hot")).alias("tags"), F.col("value").alias("v")).alias("user"),
                           F.array(F.lit(1), F.lit(1)).alias("new")), {"ignoreNullFields": "false"}).alias("doc"))
    return merge_tables(base, patch, "key", "doc")



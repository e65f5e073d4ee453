"""The working collection view over the driver's ``embeddings`` table.

``id = vec_id``, ``value = embedding``, ``label``,
``deviceCode = device(100 + vec_id % 100)``,
``dt = yyyyMMdd(2025-08-17 - vec_id div 100 days)``,
``createTime = epoch ms of that day + vec_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecframe.functions.text import device_code

# Fixed values of the working view.
TODAY = "2025-08-17"
ROWS_PER_DAY = 100


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def collection_view(spark: SparkSession, sf_dir: str, scaled: bool = False, shift: int = 0) -> DataFrame:
    """Bench-schema collection derived from ``embeddings``.

    ``scaled=True`` multiplies each vector by ``1 + vec_id % 3`` so that IP,
    L2 and COSINE rank differently (the raw vectors all have unit length);
    ``shift`` moves every value away from the origin (in float32).
    """
    e = table(spark, sf_dir, "embeddings")
    day = F.date_sub(F.lit(TODAY).cast("date"), (F.col("vec_id") / ROWS_PER_DAY).cast("int"))
    value = F.col("embedding")
    if scaled:
        factor = (F.lit(1) + F.pmod(F.col("vec_id"), F.lit(3))).cast("float")
        value = F.transform(value, lambda x: x * factor)
    if shift:
        value = F.transform(value, lambda x: (x.cast("double") + shift).cast("float"))
    return e.select(
        F.col("vec_id").alias("id"),
        value.alias("value"),
        F.col("label"),
        device_code(F.col("vec_id")).alias("deviceCode"),
        (F.unix_date(day).cast("long") * 86400000 + F.col("vec_id")).alias("createTime"),  # no session-zone dependence
        F.date_format(day, "yyyyMMdd").alias("dt"),
    )


# Of a stored collection every row whose id this divides is a query.
QUERY_STEP = 20


def stored_queries(view: DataFrame) -> DataFrame:
    """The query set ``(qid, vec)``: every 20th stored vector, so it grows with the table."""
    return view.where(F.col("id") % QUERY_STEP == 0).select(F.col("id").alias("qid"), F.col("value").alias("vec"))


def query_of(view: DataFrame, qid: int) -> DataFrame:
    return view.where(F.col("id") == qid).select(F.col("id").alias("qid"), F.col("value").alias("vec"))


# DuckDB twin of collection_view (tables are pre-registered views).
SQL_COLLECTION = """
SELECT vec_id AS id,
       CAST(embedding AS DOUBLE[]) AS value,
       label,
       'device' || CAST(100 + vec_id % 100 AS VARCHAR) AS deviceCode,
       epoch_ms(CAST(DATE '2025-08-17' - CAST(vec_id // 100 AS INTEGER) AS TIMESTAMP)) + vec_id AS createTime,
       strftime(DATE '2025-08-17' - CAST(vec_id // 100 AS INTEGER), '%Y%m%d') AS dt
FROM embeddings
"""

SQL_COLLECTION_SCALED = """
SELECT vec_id AS id,
       CAST(list_transform(embedding, lambda x: CAST(x * CAST(1 + vec_id % 3 AS FLOAT) AS FLOAT)) AS DOUBLE[]) AS value,
       label,
       'device' || CAST(100 + vec_id % 100 AS VARCHAR) AS deviceCode,
       epoch_ms(CAST(DATE '2025-08-17' - CAST(vec_id // 100 AS INTEGER) AS TIMESTAMP)) + vec_id AS createTime,
       strftime(DATE '2025-08-17' - CAST(vec_id // 100 AS INTEGER), '%Y%m%d') AS dt
FROM embeddings
"""

SQL_COLLECTION_SHIFTED = SQL_COLLECTION.replace(
    "CAST(embedding AS DOUBLE[])", "CAST(list_transform(embedding, lambda x: CAST(CAST(x AS DOUBLE) + 10000 AS FLOAT)) AS DOUBLE[])")

# DuckDB twin of stored_queries over a relation ``c``.
SQL_STORED_QUERIES = f"SELECT id AS qid, value AS qv FROM c WHERE id % {QUERY_STEP} = 0"

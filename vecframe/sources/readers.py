"""Vector dataset readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERY_SCHEMA = T.StructType([T.StructField("vec", T.ArrayType(T.FloatType()), True)])


def read_vectors(spark: SparkSession, path: str, vector_col: str = "emb", id_col: str = "id",
                 mapping: dict[str, str] | None = None) -> DataFrame:
    """A Parquet vector dataset as ``(id, value)`` plus other columns.

    ``mapping`` renames user columns (custom datasets) before the cast."""
    df = spark.read.parquet(path)
    for src, dst in (mapping or {}).items():
        df = df.withColumnRenamed(src, dst)
    return df.withColumnRenamed(id_col, "id").withColumn("value", F.col(vector_col).cast("array<float>")) \
        .drop(*([vector_col] if vector_col != "value" else []))


def read_query_vectors(spark: SparkSession, path: str, schema: T.StructType = QUERY_SCHEMA) -> DataFrame:
    """JSON query vectors, either JSON arrays of ``{"vec": [...]}`` objects - each read by as many tasks as its file
    has splits - or JSON Lines (what :func:`write_query_vectors` produces)."""
    # one character reaches the driver: an array may be one line of any length, so the pieces end where objects do
    pieces = spark.read.option("lineSep", "}").text(path)
    first = pieces.select(F.regexp_extract("value", r"^\s*(\S)", 1).alias("c")).where("c <> ''").limit(1).collect()
    if first and first[0][0] == "[":
        from vecframe.sources.json_arrays import array_elements
        return array_elements(spark, path).select(F.from_json("text", schema).alias("row")).select("row.*")
    return spark.read.schema(schema).json(path)


def write_query_vectors(df: DataFrame, path: str, vector_col: str = "vec", extra=()) -> None:
    """S3: compact JSON Lines, one ``{"vec": [...]}`` per row (many files)."""
    df.select(*extra, F.col(vector_col).cast("array<float>").alias("vec")).write.mode("overwrite").json(path)


def vector_profile(df: DataFrame, vector_col: str = "value") -> DataFrame:
    """Rows, min / max dimension and NULL vectors - one pass, one row."""
    return df.agg(F.count(F.lit(1)).alias("n"),
                  F.min(F.size(vector_col)).cast("long").alias("dim_min"),
                  F.max(F.size(vector_col)).cast("long").alias("dim_max"),
                  F.count(F.when(F.col(vector_col).isNull(), 1)).alias("null_vectors"))


def head_rows(df: DataFrame, n: int = 5, id_col: str = "id") -> DataFrame:
    """The first ``n`` rows by id (a top-n, not a full sort)."""
    return df.orderBy(id_col).limit(n)

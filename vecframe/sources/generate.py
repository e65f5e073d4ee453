"""Repeatable row generators.

Values come from ``xxhash64(id, j, seed)`` instead of a clock-seeded random
source, so every run - and every re-executed task - produces the same rows.
The generators take a DataFrame of ids (``spark.range`` or ids read from a
table), so their work is spread over its partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecframe.functions.text import device_code

# The word list used for generated sentences.
WORDS = ("the", "of", "and", "to", "in", "is", "vector", "search", "index", "day", "table", "query",
         "score", "text", "row", "batch", "partition", "cell", "code", "term")


def uniform(id_col: Column, j: Column | int, seed: int) -> Column:
    """Float in [0, 1) from 24 hash bits."""
    jj = j if isinstance(j, Column) else F.lit(j)
    h = F.xxhash64(id_col, jj, F.lit(seed))
    return ((h.bitwiseAND(F.lit(16777215))).cast("double") / F.lit(16777216.0))


def random_vector(id_col: Column, dim: int, seed: int) -> Column:
    return F.transform(F.sequence(F.lit(1), F.lit(dim)), lambda j: uniform(id_col, j, seed).cast("float"))


def bench_rows(ids: DataFrame, dim: int, now_ms, seed: int = 7, id_col: str = "id") -> DataFrame:
    """``id, value, deviceCode, createTime`` for each input id; ``now_ms`` is epoch ms or a column."""
    i = F.col(id_col).cast("long")
    return ids.select(
        i.alias("id"),
        random_vector(i, dim, seed).alias("value"),
        device_code(F.xxhash64(i, F.lit(seed + 1))).alias("deviceCode"),
        (now_ms if isinstance(now_ms, Column) else F.lit(int(now_ms))).cast("long").alias("createTime"))


def hello_rows(ids: DataFrame, dim: int, seed: int = 11, id_col: str = "id") -> DataFrame:
    """``ID, f1 double, embeddings``."""
    i = F.col(id_col).cast("long")
    return ids.select(i.alias("ID"), uniform(i, 0, seed).alias("f1"),
                      random_vector(i, dim, seed + 1).alias("embeddings"))


def text_columns(i: Column, dim: int, seed: int = 13) -> list[Column]:
    """S11 columns for an id column: ``id, value, indexText, docId``."""
    words = F.array(*[F.lit(w) for w in WORDS])
    n_words = (F.lit(10) + F.pmod(F.xxhash64(i, F.lit(seed)), F.lit(11))).cast("int")
    sentence = F.array_join(F.transform(
        F.sequence(F.lit(1), n_words),
        lambda j: F.element_at(words, (F.pmod(F.xxhash64(i, j, F.lit(seed + 2)), F.lit(len(WORDS))) + 1).cast("int"))), " ")
    return [i.alias("id"), random_vector(i, dim, seed + 3).alias("value"), sentence.alias("indexText"),
            F.xxhash64(i, F.lit(seed + 4)).bitwiseAND(F.lit(0x7FFFFFFFFFFFFFFF)).alias("docId")]


def text_rows(ids: DataFrame, dim: int, seed: int = 13, id_col: str = "id") -> DataFrame:
    """``id, value, indexText`` (10-20 words), ``docId`` (63-bit)."""
    return ids.select(*text_columns(F.col(id_col).cast("long"), dim, seed))


def query_vector(spark, dim: int, seed: int = 5) -> list[float]:
    """One repeatable query vector (tiny: one row)."""
    row = spark.range(1).select(random_vector(F.col("id"), dim, seed).alias("v")).first()
    return [float(x) for x in row["v"]]


def pick_one(df: DataFrame, id_col: str = "id", seed: int = 42) -> DataFrame:
    """A repeatable "random" row: smallest ``md5(id || '-' || seed)``."""
    text = F.concat(F.col(id_col).cast("string"), F.lit(f"-{seed}"))
    return df.orderBy(F.md5(text.cast("binary")), F.col(id_col)).limit(1)

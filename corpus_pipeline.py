"""The training-data pipeline: documents through the stages of ``STAGES``, each written as Parquet and read again.

Every stage but the last returns the columns of its documents; the last returns token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vecframe.llm import byte_bpe, decontaminate, near_dup, quality, secrets_scan
from vecframe.llm.common import read_table
from vecframe.llm.queries import tokenizer_file
from vecframe.session import scratch_path, ship_package


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that importance resampling does not draw go."""
    ship_package(spark)
    return quality.keep(docs, read_table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: of each group of near copies the document with the smallest id stays.

    Texts of a repeated id that are no near copies are documents of their own."""
    ship_package(spark)
    return near_dup.keep_one(docs, words=3, max_bits=2, one_per_id=False)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents with a ten-word window of a benchmark item go."""
    ship_package(spark)
    return decontaminate.remove(docs, read_table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scans: every secret is replaced by a mark; all documents stay."""
    ship_package(spark)
    return secrets_scan.redact(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: the token ids of every document."""
    ship_package(spark)
    return byte_bpe.stage(spark, docs, tokenizer_file("byte_bpe_multi_50k.tiktoken"))


STAGES = [
    ("quality", good_documents),
    ("near_dedup", one_of_each_group),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("byte_bpe", token_ids),
]

#: No SQL: models, fingerprints and tokenizers are beyond it; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = scratch_path(spark, f"stage-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs

"""What a task of the BM25 build or search sorts does not grow with the index."""

from pyspark.sql import functions as F

from vecframe.operators import bm25


def test_shards_of_a_task_stay_few(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(bm25, "SHARD_DOCS", 10)
    monkeypatch.setattr(bm25, "SMALL_SHARD", 10)
    monkeypatch.setattr(bm25, "SPREAD_SHARDS", 4)
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.format_string("common word%d", F.col("id") % 7).alias("text"))
    index = bm25.build_index(docs, path=tmp_dir + "/bm25")
    per_file = index.blocks.groupBy(F.input_file_name().alias("f")).agg(F.countDistinct("shard").alias("n"))
    assert index.shards == 40 and per_file.agg(F.max("n")).first()[0] <= 7
    monkeypatch.setattr(bm25, "_tasks", lambda df: 2)
    assert index.tasks == 10
    queries = spark.createDataFrame([(1, "word3"), (2, "common")], "qid long, text string")
    assert bm25.match(index, queries, "all").groupBy("qid").count().orderBy("qid").collect() == [(1, 57), (2, 400)]

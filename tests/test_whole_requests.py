"""Request queries do their whole job: every 20th row asks, of all rows or of its own days."""

from pyspark.sql import functions as F

from vecframe.operators.search import search
from vecframe.plans.q_stream import request_topk_own_days, stream_request_topk
from vecframe.plans.views import collection_view, stored_queries


def table_of(spark, place, n=1400):
    vec = F.transform(F.sequence(F.lit(1), F.lit(64)), lambda j: F.sin(F.col("vec_id") * j * 0.37 + j).cast("float"))
    spark.range(n).select(F.col("id").alias("vec_id")).withColumn("embedding", vec).withColumn("label", (F.col("vec_id") % 10).cast("int")).write.parquet(f"{place}/embeddings.parquet")
    return place


def test_every_request_asks_for_its_own_day_and_the_day_before(spark, tmp_dir):
    place = table_of(spark, tmp_dir)
    hits = request_topk_own_days(spark, place).collect()
    assert len(hits) == 70 * 5
    assert {h.id // 100 - h.qid // 100 for h in hits} <= {0, 1}


def test_every_request_is_answered_from_all_rows(spark, tmp_dir):
    place = table_of(spark, tmp_dir)
    view = collection_view(spark, place)
    got = {(r.qid, r.id) for r in stream_request_topk(spark, place).where("error IS NULL").collect()}
    best = search(view, stored_queries(view).where("qid NOT IN (100, 140)"), "IP", 3, fields=[]).collect()
    assert len(best) == 68 * 3 and {(r.qid, r.id) for r in best} <= got

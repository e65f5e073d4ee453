"""Physical-plan assertions for the scale properties the README claims."""

import re

from pyspark.sql import functions as F

from vecframe.operators import bm25
from vecframe.operators.ivf import assign_cells, build_index, ivf_search
from vecframe.operators.search import search
from helpers import all_queries
from vecframe.plans.views import collection_view

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_exact_search_never_exchanges_the_base(spark):
    view = collection_view(spark, SF)
    plan = plan_of(search(view, all_queries(view), "IP", 10, fields=[]))
    # one exchange only: the k-per-task candidates, keyed by qid
    assert plan.count("Exchange") == 2 and "hashpartitioning(qid" in plan  # the two levels of the top-k tree
    assert "MapInArrow" in plan and "WindowGroupLimit" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_bm25_reads_only_the_asked_terms(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    qs = spark.createDataFrame([(1, "the Quick zzyzx")], "qid long, text string")
    index = bm25.build_index(docs)
    plan = plan_of(bm25.search(index, qs, 10))
    # the scan is asked for the query's terms; their blocks meet by shard, then only each task's best k are shuffled
    assert re.search(r"PushedFilters: \[[^]]*(In|EqualTo)\(term", plan)
    assert plan.count("Exchange") == 3 and plan.index("MapInArrow") > plan.rindex("Exchange hashpartitioning(qid")
    assert "Join" not in plan
    read = index.blocks.where(F.col("term").isin(["the", "quick", "zzyzx"])).count()
    assert 0 < read < index.blocks.count() / 50


def test_text_is_not_shuffled_to_be_matched(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").repartition(8).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    qs = spark.read.parquet(f"{SF}/benchmark.parquet").select(F.col("item_id").alias("qid"), "text")
    plan = plan_of(bm25.scan_match(docs, qs, "all"))
    assert "Exchange" not in plan and "Join" not in plan


def test_ivf_broadcast_path_never_exchanges_the_table(spark):
    view = collection_view(spark, SF).select("id", "value")
    idx = build_index(view, "IP", nlist=8, method="mean")
    res = ivf_search(assign_cells(view, idx), all_queries(view).where("qid < 20"), idx, k=5, nprobe=2)
    plan = plan_of(res)
    assert plan.count("Exchange") == 2 and "hashpartitioning(qid" in plan  # the two levels of the top-k tree


def test_counts_read_no_vector_column(spark):
    view = collection_view(spark, SF)
    plan = plan_of(view.groupBy("dt").count())
    assert "ReadSchema: struct<vec_id:bigint>" in plan


def test_sorted_layout_gives_disjoint_file_ranges(spark, tmp_path):
    from vecframe.operators.filters import layout_sorted, range_filter
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    layout_sorted(orders, "o_orderkey", 4).write.parquet(str(tmp_path / "o"))
    t = spark.read.parquet(str(tmp_path / "o"))
    ranges = sorted((r["lo"], r["hi"]) for r in t.groupBy("_metadata.file_path").agg(
        F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi")).collect())
    assert len(ranges) == 4 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    plan = plan_of(range_filter(t, "o_orderkey", 100, 200))
    assert "GreaterThanOrEqual(o_orderkey,100)" in plan and "LessThanOrEqual(o_orderkey,200)" in plan


def test_bounded_broadcast_falls_back_past_its_bound(spark):
    from vecframe.session import bounded_broadcast
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = spark.range(1000).withColumnRenamed("id", "k")
        small = spark.range(10).withColumnRenamed("id", "k")
        assert "BroadcastHashJoin" in plan_of(big.join(bounded_broadcast(small, max_rows=100), "k"))
        assert "BroadcastHashJoin" not in plan_of(big.join(bounded_broadcast(small, max_rows=5), "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

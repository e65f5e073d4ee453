import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecframe.operators import search as S
from vecframe.operators.search import search, search_one

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("value", T.ArrayType(T.FloatType())),
                       T.StructField("dt", T.StringType()), T.StructField("createTime", T.LongType())])


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def ids(df):
    return [r["id"] for r in df.orderBy("rank").collect()]


def test_score_tie_breaks_by_id(spark):
    df = frame(spark, [(7, [1.0, 0.0], "d", 1), (3, [1.0, 0.0], "d", 1), (5, [0.5, 0.0], "d", 1)])
    for method in ("arrow", "expr"):
        assert ids(search_one(df, [1.0, 0.0], "IP", 2, method=method)) == [3, 7]


def test_duplicate_ids_both_returned_ordered_by_dt(spark):
    df = frame(spark, [(1, [1.0, 0.0], "20250817", 5), (1, [1.0, 0.0], "20250816", 9), (2, [0.1, 0.0], "x", 0)])
    res = search_one(df, [1.0, 0.0], "IP", 2, tie_cols=["dt", "createTime"]).orderBy("rank").collect()
    assert [(r["id"], r["dt"]) for r in res] == [(1, "20250816"), (1, "20250817")]


def test_zero_vector_cosine_removed_ip_l2_kept(spark):
    df = frame(spark, [(1, [0.0, 0.0], "d", 0), (2, [1.0, 1.0], "d", 0)])
    assert ids(search_one(df, [1.0, 0.0], "COSINE", 10)) == [2]
    assert sorted(ids(search_one(df, [1.0, 0.0], "IP", 10))) == [1, 2]
    assert ids(search_one(df, [1.0, 0.0], "L2", 10)) == [1, 2]


def test_nan_row_removed(spark):
    df = frame(spark, [(1, [float("nan"), 1.0], "d", 0), (2, [1.0, 1.0], "d", 0)])
    for method in ("arrow", "expr"):
        assert ids(search_one(df, [1.0, 0.0], "IP", 10, method=method)) == [2]


def test_wrong_dimension_is_an_error_before_the_job(spark):
    df = frame(spark, [(1, [1.0, 0.0], "d", 0)])
    with pytest.raises(ValueError, match="dimension"):
        search_one(df, [1.0, 0.0, 0.0], "IP", 10)


def test_k_larger_than_n_and_empty_table(spark):
    df = frame(spark, [(i, [float(i), 1.0], "d", 0) for i in range(3)])
    assert len(ids(search_one(df, [1.0, 0.0], "IP", 10))) == 3
    empty = frame(spark, [])
    res = search_one(empty, [1.0, 0.0], "IP", 10)
    assert res.count() == 0
    assert {"rank", "id", "score"} <= set(res.columns)


def test_partition_lists(spark):
    from vecframe.operators.tables import partition_list
    df = frame(spark, [(1, [1.0, 0.0], "20250817", 0), (2, [1.0, 0.0], "20250816", 0), (3, [1.0, 0.0], "20250815", 0)])

    def days(plist):
        return sorted(r["dt"] for r in search_one(df, [1.0, 0.0], "IP", 10, fields=["dt"],
                                                  partitions=partition_list(plist)).collect())
    assert days("") == ["20250815", "20250816", "20250817"]
    assert days("20250817") == ["20250817"]
    assert days("20250817,,20250816") == ["20250816", "20250817"]
    assert days("19990101") == []


def test_arrow_path_equals_expression_path(spark):
    from vecframe.plans.views import collection_view
    view = collection_view(spark, "/root/testdata/sf0.001", scaled=True)
    q = [float(x) for x in view.where("id = 5").first()["value"]]
    for metric in ("IP", "L2", "COSINE"):
        a = search_one(view, q, metric, 25, method="arrow", fields=[]).collect()
        e = search_one(view, q, metric, 25, method="expr", fields=[]).collect()
        assert [r["id"] for r in a] == [r["id"] for r in e]
        assert np.allclose([r["score"] for r in a], [r["score"] for r in e], rtol=0, atol=1e-9)


def test_blocked_path_equals_broadcast_path(spark, monkeypatch):
    from helpers import all_queries
    from vecframe.plans.views import collection_view
    view = collection_view(spark, "/root/testdata/sf0.001").select("id", "value")
    q = all_queries(view).where("qid < 60")
    a = search(view, q, "IP", 7, fields=[]).collect()
    monkeypatch.setattr(S, "MAX_BROADCAST_QUERY_BYTES", 64 * 8 * 16)  # force ~4 query blocks
    b = search(view, q, "IP", 7, fields=[]).collect()
    key = lambda r: (r["qid"], r["rank"])
    assert [(r["qid"], r["rank"], r["id"]) for r in sorted(a, key=key)] == \
           [(r["qid"], r["rank"], r["id"]) for r in sorted(b, key=key)]


def test_filter_before_topk_equals_search_on_filtered_table(spark):
    from vecframe.plans.views import collection_view
    view = collection_view(spark, "/root/testdata/sf0.001")
    q = [float(x) for x in view.where("id = 0").first()["value"]]
    a = ids(search_one(view, q, "IP", 10, where=F.col("label") == 2, fields=[]))
    b = ids(search_one(view.where("label = 2"), q, "IP", 10, fields=[]))
    assert a == b and len(a) == 10


def test_plan_has_partition_filter_and_group_limit(spark, tmp_dir):
    from vecframe.plans.views import collection_view
    view = collection_view(spark, "/root/testdata/sf0.001")
    view.write.partitionBy("dt").parquet(tmp_dir + "/coll")
    t = spark.read.parquet(tmp_dir + "/coll")
    res = search_one(t, [0.1] * 64, "IP", 10, partitions=["20250817"])
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "20250817" in plan
    assert t.schema["dt"].dataType == T.StringType()


def test_per_query_partitions_mask(spark):
    from vecframe.streaming.requests import answer_search_requests
    from vecframe.plans.views import collection_view
    view = collection_view(spark, "/root/testdata/sf0.001")
    reqs = view.where("id IN (0, 150, 320)").select(
        F.col("id").alias("qid"), F.col("value").alias("vec"),
        F.when(F.col("id") == 0, 3).otherwise(5).alias("topk"),
        F.when(F.col("id") == 0, "").when(F.col("id") == 150, "20250816,,20250814").otherwise("19990101").alias("partitions"))
    got = answer_search_requests(view, reqs, "IP", fields=["dt"]).collect()
    by = {}
    for r in got:
        by.setdefault(r["qid"], []).append(r)
    assert len(by[0]) == 3 and 320 not in by
    assert len(by[150]) == 5 and {r["dt"] for r in by[150]} <= {"20250816", "20250814"}
    q150 = [float(x) for x in view.where("id = 150").first()["value"]]
    want = search_one(view, q150, "IP", 5, partitions=["20250816", "20250814"], fields=[])
    assert sorted(r["id"] for r in by[150]) == sorted(r["id"] for r in want.collect())


def test_two_level_topk_equals_one_level(spark):
    from vecframe.operators.search import top_k_per_group
    df = spark.range(0, 5000, numPartitions=40).select(
        F.pmod("id", F.lit(3)).alias("qid"), F.col("id"), ((F.col("id") * 7919) % 1000).alias("score"))
    order = [F.desc("score"), F.asc("id")]
    a = top_k_per_group(df, ["qid"], order, 7, buckets=1).collect()
    b = top_k_per_group(df, ["qid"], order, 7, buckets=10).collect()
    key = lambda r: (r["qid"], r["rank"])
    assert [(r["qid"], r["rank"], r["id"]) for r in sorted(a, key=key)] == \
           [(r["qid"], r["rank"], r["id"]) for r in sorted(b, key=key)]


def test_float32_precision_returns_the_same_rows(spark):
    from helpers import all_queries
    from vecframe.plans.views import collection_view
    view = collection_view(spark, "/root/testdata/sf0.001", scaled=True).select("id", "value")
    q = all_queries(view).where("qid < 80")
    for metric in ("IP", "L2", "COSINE"):
        a = search(view, q, metric, 10, fields=[]).select("qid", "rank", "id", "score").collect()
        b = search(view, q, metric, 10, fields=[], precision="float32").select("qid", "rank", "id", "score").collect()
        key = lambda r: (r["qid"], r["rank"])
        assert [(r["qid"], r["rank"], r["id"]) for r in sorted(a, key=key)] == \
               [(r["qid"], r["rank"], r["id"]) for r in sorted(b, key=key)]
        assert all(abs(x["score"] - y["score"]) < 1e-9 for x, y in zip(sorted(a, key=key), sorted(b, key=key)))


def test_l2_is_the_direct_difference_far_from_the_origin():
    import numpy as np
    from vecframe.operators import _kernels as K
    rnd = np.random.default_rng(3)
    for d, n, spread, shift in ((64, 300, 1e-3, 1e4), (8, 50, 1.0, 1e8), (16, 200, 1e-6, 1.0), (4, 3, 1.0, 0.0)):
        X, Q = rnd.normal(size=(n, d)) * spread + shift, rnd.normal(size=(7, d)) * spread + shift
        true = ((X[:, None, :] - Q[None]) ** 2).sum(axis=2)
        for precision in ("float64", "float32"):
            r, q, s = K.local_topk("L2", False, X, np.arange(n), Q, 5, precision=precision)
            for j in range(7):
                best = sorted(zip(true[:, j], range(n)))[:5]
                got = sorted(zip(s[q == j], r[q == j]))[:5]
                assert [i for _, i in got] == [i for _, i in best] and np.allclose([v for v, _ in got], [v for v, _ in best], rtol=1e-9)


def test_many_query_blocks_give_the_same(spark, monkeypatch):
    from helpers import all_queries
    from vecframe.operators import search as S
    from vecframe.plans.views import collection_view
    view = collection_view(spark, "/root/testdata/sf0.001")
    q = all_queries(view).where("qid < 60")
    a = search(view, q, "IP", 5, fields=["dt"]).collect()
    monkeypatch.setattr(S, "MAX_TASK_CANDIDATES", 200)  # ten queries a block
    b = search(view, q, "IP", 5, fields=["dt"])
    assert b.columns == ["qid", "rank", "id", "score", "dt"]
    rows = lambda found: sorted((r.qid, r["rank"], r.id, round(r.score, 9), r.dt) for r in found)
    assert rows(a) == rows(b.collect())


def test_requests_fail_alone(spark):
    from vecframe.plans.views import collection_view
    from vecframe.streaming.requests import answer_search_requests, checked_requests
    view = collection_view(spark, "/root/testdata/sf0.001")
    v = [float(x) for x in view.where("id = 0").first()["value"]]
    rows = [(3, v, None, ""), (3, v, 2, ""), (4, v, 120, None), (5, v[:7], 5, ""), (6, None, 5, ""), (7, v, 0, ""), (None, v, 1, "")]
    reqs = spark.createDataFrame(rows, "qid long, vec array<double>, topk int, partitions string")
    got = answer_search_requests(view, reqs).collect()
    assert set(got[0].asDict()) == {"qid", "rank", "id", "score", "deviceCode", "createTime"}
    count = {}
    for r in got:
        count[r.qid] = count.get(r.qid, 0) + 1
    assert count == {3: 12, 4: 120, None: 1}
    bad = {r.qid: r.error for r in checked_requests(reqs, 64).where("error is not null").collect()}
    assert set(bad) == {5, 6, 7}
    assert answer_search_requests(view, reqs.where("qid = 6")).collect() == []


def test_planning_runs_no_job(spark):
    from pyspark.sql import functions as F
    from vecframe.operators.search import rank_candidates
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    df = spark.range(1000).repartition(70).select(F.pmod("id", F.lit(3)).alias("qid"), "id", F.rand(1).alias("score"))
    rank_candidates(df, "IP", 5)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before

"""Results that are kept and added to: standing queries, neighbours, percentile sketches, requests of many sizes."""

import random

import pytest
from pyspark.sql import functions as F

from vecframe.operators import evaluate as E
from vecframe.operators.search import search
from vecframe.plans.views import collection_view, stored_queries
from vecframe.streaming.ingest import file_stream, run_to_end, standing_topk

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("metric", ["IP", "L2"])
def test_standing_queries_equal_a_rescan_at_each_tick(spark, tmp_dir, metric):
    view = collection_view(spark, SF, scaled=True).select("id", "value", "createTime")
    view = view.unionByName(view.where("id < 20"))  # repeated rows stay two
    q = stored_queries(view.dropDuplicates(["id"]))
    schema, seen = view.schema, None
    for turn, where in enumerate(["id % 2 = 0", "id % 2 = 1"]):  # the second run starts from the checkpoint of the first
        view.where(where).coalesce(1).write.parquet(f"{tmp_dir}/in/p{turn}")
        rows = file_stream(spark, f"{tmp_dir}/in/*", schema)
        run_to_end(standing_topk(rows, q, f"{tmp_dir}/out", f"{tmp_dir}/ck", metric, 4, dim=64, tie_cols=["createTime"]))
        seen = view.where("id % 2 = 0") if turn == 0 else view
        tick = spark.read.parquet(f"{tmp_dir}/out/batch_id={turn}")
        want = search(seen, q, metric, 4, fields=[], tie_cols=["createTime"])
        assert sorted((r.qid, r["rank"], r.id, round(r.score, 9)) for r in tick.collect()) == \
            sorted((r.qid, r["rank"], r.id, round(r.score, 9)) for r in want.collect())


def test_neighbours_after_appends_and_expiry(spark, tmp_dir):
    view = collection_view(spark, SF).select("id", "value", "dt")
    q = stored_queries(view)
    hits = lambda df: sorted((r.qid, r["rank"], r.id, r.dt) for r in df.collect())
    kept = search(view.where("id < 200"), q, "IP", 5, fields=["dt"])
    kept = E.add_neighbours(kept, view.where("id >= 200 and id < 330"), q, k=5)
    kept = E.add_neighbours(kept, view.where("id >= 330"), q, k=5)
    assert hits(kept) == hits(search(view, q, "IP", 5, fields=["dt"]))
    left = view.where("dt <> '20250815'")
    out = E.drop_neighbours(kept, left, q, F.col("dt") == "20250815", k=5)
    assert hits(out) == hits(search(left, q, "IP", 5, fields=["dt"]))
    assert hits(E.drop_neighbours(kept, view, q, F.col("dt") == "19990101", k=5)) == hits(kept)


def test_sketches_merge_within_their_error(spark):
    r = random.Random(3)
    rows = [(f"d{i % 7}", "a" if i % 3 else "b", r.lognormvariate(3, 2) if i % 5 else 7.0) for i in range(20_000)] + [("d0", "a", None), ("d1", None, 5.0)]
    df = spark.createDataFrame(rows, "dt string, kind string, ms double").repartition(5)
    stored = E.latency_sketches(df, ["dt", "kind"])
    found = {x.kind: x for x in E.sketched_summary(E.merged_sketches(stored, ["kind"]), ["kind"]).collect()}
    assert set(found) == {"a", "b", None}
    for kind in ("a", "b"):
        values = sorted(v for _, k, v in rows if k == kind and v is not None)
        x = found[kind]
        assert x.n == len(values) and abs(x["mean"] - sum(values) / len(values)) < 1e-6
        for p, got in ((0.5, x.p50), (0.95, x.p95), (0.99, x.p99)):
            assert sum(v < got for v in values) / len(values) <= p + 0.005 and sum(v <= got for v in values) / len(values) >= p - 0.005


def test_requests_of_many_sizes_in_one_scan_and_by_class(spark, monkeypatch):
    from vecframe.operators import search as S
    from vecframe.streaming.requests import answer_search_requests
    view = collection_view(spark, SF).select("id", "value", "dt", "createTime")
    topk = F.expr("CASE id % 5 WHEN 0 THEN 1 WHEN 1 THEN 17 WHEN 2 THEN 33 WHEN 3 THEN 300 END").cast("int")
    days = F.when(F.col("id") % 2 == 0, "").otherwise("20250817,20250814")
    reqs = view.where("id < 12").select(F.col("id").alias("qid"), F.col("value").alias("vec"), topk.alias("topk"), days.alias("partitions"))
    hits = lambda: sorted((r.qid, r["rank"], r.id) for r in answer_search_requests(view, reqs, fields=["dt"]).collect())
    want = []
    for i in range(12):
        k, base = {0: 1, 1: 17, 2: 33, 3: 300, 4: 10}[i % 5], view if i % 2 == 0 else view.where("dt IN ('20250817', '20250814')")
        found = search(base, view.where(F.col("id") == i).select(F.col("id").alias("qid"), F.col("value").alias("vec")), "IP", k, fields=[])
        want += [(r.qid, r["rank"], r.id) for r in found.collect()]
    assert hits() == sorted(want)
    monkeypatch.setattr(S, "MAX_TASK_CANDIDATES", 100)
    assert hits() == sorted(want)

"""Trained cells: two-level training, calibration, second cells, certified codes, filters."""

import dataclasses

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import all_queries
from vecframe.operators import _kernels as K
from vecframe.operators import ivf_train
from vecframe.operators.evaluate import recall_at_k
from vecframe.operators.ivf import assign_cells, build_index, ivf_search, load_index, probe_work, save_index, spilled
from vecframe.operators.quantize import code_error, encode, sq8_encode, sq8_ranges
from vecframe.operators.search import search
from vecframe.plans.views import collection_view, stored_queries

SF = "/root/testdata/sf0.001"


def clustered(spark, n=3000, d=8, centres=40, seed=0):
    r = np.random.default_rng(seed)
    c = r.normal(0, 10, (centres, d))
    x = c[r.integers(0, centres, n)] + r.normal(0, 1, (n, d))
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, value array<float>").repartition(4)


def hits(df):
    return sorted((r.qid, r["rank"], r.id) for r in df.select("qid", "rank", "id").collect())


@pytest.mark.parametrize("nlist", [1, 2, 7, 50, 400])
def test_two_levels_give_as_many_cells_as_asked(spark, nlist):
    view = clustered(spark)
    C = ivf_train.two_level_centroids(view, nlist)
    assert C.shape == (nlist, 8) and len(np.unique(C, axis=0)) == nlist


def test_two_levels_find_the_clusters(spark, monkeypatch):
    view = clustered(spark)
    X = np.array([r.value for r in view.collect()])
    cost = lambda C: ((X[:, None, :] - C[None]) ** 2).sum(2).min(1).mean()
    assert cost(ivf_train.two_level_centroids(view, 60)) < 1.3 * 8  # the noise of 8 dimensions
    monkeypatch.setattr(ivf_train, "GROUP_ROWS", 150)  # coarse cells are cut
    monkeypatch.setattr(ivf_train, "COARSE_ROWS", 500)
    assert cost(ivf_train.two_level_centroids(view, 60)) < 1.6 * 8
    assert cost(ivf_train.two_level_centroids(view, 60, rows_per_cell=20)) < 1.8 * 8


def test_copies_and_nulls_do_not_make_cells(spark):
    rows = [(i, [1.0, 1.0]) for i in range(500)] + [(500, None), (501, [2.0, 0.0]), (502, [0.0, 3.0])]
    view = spark.createDataFrame(rows, "id long, value array<float>")
    assert ivf_train.two_level_centroids(view, 20).shape[0] <= 20
    assert sorted(map(tuple, np.unique(ivf_train.two_level_centroids(view, 20), axis=0).tolist())) == [(0.0, 3.0), (1.0, 1.0), (2.0, 0.0)]
    assert ivf_train.two_level_centroids(view.limit(0), 4).size == 0


def test_shares():
    assert ivf_train.shares({"a": 1, "b": 98, "c": 1}, 10) == {"a": 1, "b": 9, "c": 1}
    assert sum(ivf_train.shares({i: 7 for i in range(9)}, 100).values()) == 100


@pytest.mark.parametrize("metric", ["IP", "L2", "COSINE"])
def test_calibrated_probes_find_nine_of_ten(spark, metric, tmp_dir):
    view = clustered(spark)
    index = build_index(view, metric, nlist=60)
    assigned = ivf_train.trained(view, index)
    index = ivf_train.calibrate(assigned, index)
    queries = stored_queries(view)
    exact = search(view, queries, metric, 10, fields=[])
    assert recall_at_k(ivf_search(assigned, queries, index, k=10), exact).first()["recall"] >= 0.9
    work = probe_work(assigned, queries, index).first()
    share = work["probed"] / (view.count() * queries.count())
    if metric != "IP":  # long rows win everywhere under IP
        assert share < 0.2
    save_index(spark, index, tmp_dir + "/i")
    back = load_index(spark, tmp_dir + "/i")
    assert back.nprobe == index.nprobe and back.gap == index.gap and np.array_equal(back.spread, index.spread) and back.metric == metric
    assert hits(ivf_search(assigned, queries, back, k=10)) == hits(ivf_search(assigned, queries, index, k=10))


@pytest.mark.parametrize("method", ["broadcast", "cogroup"])
def test_second_cells_lose_and_repeat_nothing(spark, method, tmp_dir):
    view = collection_view(spark, SF).select("id", "value")
    view = view.unionByName(view.where("id < 5"))  # rows that repeat stay two rows
    index = build_index(view, "IP", nlist=16, method="mean")
    place = tmp_dir + "/cells"
    assign_cells(view, index, spill=True).write.parquet(place)
    both = spilled(spark.read.parquet(place))
    assert both.count() == 2 * view.count() and both.groupBy("_row").count().where("count <> 2").isEmpty()
    assert both.groupBy("_row").agg(F.countDistinct("cell").alias("n")).where("n <> 2").isEmpty()
    q = all_queries(view).where("qid < 40").dropDuplicates(["qid"])
    assert hits(ivf_search(both, q, index, k=10, nprobe=16, method=method)) == hits(search(view, q, "IP", 10, fields=[]))
    exact = search(view, q, "IP", 10, fields=[])
    one, two = (recall_at_k(ivf_search(t, q, index, k=10, nprobe=4, method=method), exact).first()["hits"] for t in (assign_cells(view, index), both))
    assert two >= one


def test_second_cell_points_elsewhere(spark):
    view = clustered(spark, n=400)
    index = build_index(view, "IP", nlist=20)
    C = index.centroids
    for r in assign_cells(view, index, spill=True).collect()[:100]:
        x = np.array(r.value, dtype=float)
        u = x - C[r.cell]
        u = u / np.linalg.norm(u)
        e = x - C
        cost = (e ** 2).sum(1) + (e @ u) ** 2
        cost[r.cell] = np.inf
        assert r.spill != r.cell and cost[r.spill] <= cost.min() * (1 + 1e-9)


@pytest.mark.parametrize("metric", ["IP", "L2", "COSINE"])
@pytest.mark.parametrize("method", ["broadcast", "cogroup"])
def test_certified_codes_equal_vectors(spark, metric, method, monkeypatch):
    monkeypatch.setattr("vecframe.operators.ivf.BATCH_CANDIDATES", 200)
    view = collection_view(spark, SF, scaled=True).select("id", "value")
    index = build_index(view, metric, nlist=8, method="mean")
    index.lo, index.hi = sq8_ranges(view, 64)
    coded = sq8_encode(assign_cells(view, index), index.lo, index.hi)
    q = all_queries(view).where("qid < 60")
    a = ivf_search(coded, q, index, k=5, nprobe=3, codes_col="codes", rerank=True, method=method)
    assert hits(a) == hits(ivf_search(coded, q, index, k=5, nprobe=3, method=method))


def test_codes_that_say_nothing_lose_nothing(spark):
    """All codes equal, codes of a range that rows have left, all rows equal, rows that are not finite."""
    r = np.random.default_rng(2)
    rows = [(i, [float(x) for x in r.normal(0, 1e-3, 4)]) for i in range(300)] + [(300, [50.0, -50.0, 1.0, 2.0]), (301, [float("nan")] * 4), (302, None)]
    rows += [(400 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(200)]
    view = spark.createDataFrame(rows, "id long, value array<float>")
    for metric in ("IP", "L2", "COSINE"):
        index = build_index(view.where("id < 300"), metric, nlist=3, method="mean")
        for lo, hi in ((np.full(4, -9.0), np.full(4, 9.0)), (np.zeros(4), np.zeros(4)), (np.full(4, -1e-3), np.full(4, 1e-3))):
            index.lo, index.hi = lo, hi
            coded = sq8_encode(assign_cells(view, index), lo, hi)
            q = [[1.0, 0.5, -0.2, 0.1], [0.0, 0.0, 0.0, 1e-9], [0.5, 0.5, 0.5, 0.5]]
            a = ivf_search(coded, q, index, k=6, nprobe=3, codes_col="codes", rerank=True)
            assert hits(a) == hits(search(view, q, metric, 6, fields=[]))


@pytest.mark.parametrize("metric", ["IP", "L2", "COSINE"])
def test_bounds_hold(metric):
    r = np.random.default_rng(3)
    for scale, shift in ((1, 0), (1e-6, 0), (1e6, 1e6), (1, 1e4)):
        X = (r.normal(0, scale, (200, 16)) + shift).astype(np.float32).astype(np.float64)
        X[:3] = 0
        Q = r.normal(0, scale, (9, 16)) + shift
        lo, hi = X[:150].min(0), X[:150].max(0)
        codes = encode(X, lo, hi)
        low, high = K.coded_bounds(metric, codes, code_error(X, codes, lo, hi), lo, (hi - lo) / 255, Q)
        q, x = np.meshgrid(np.arange(9), np.arange(200))
        s = K.pair_scores(metric, X[x.ravel()], Q[q.ravel()]).reshape(200, 9)
        key = K.to_key(s, metric != "L2")
        ok = ~np.isnan(key)
        assert (low[ok] <= key[ok]).all() and (key[ok] <= high[ok]).all()


def test_few_rows_are_scored(spark):
    view = collection_view(spark, SF).select("id", "value")
    index = build_index(view, "IP", nlist=8, method="mean")
    index.lo, index.hi = sq8_ranges(view, 64)
    coded = sq8_encode(assign_cells(view, index), index.lo, index.hi).coalesce(1)
    work = probe_work(coded, stored_queries(view), index, nprobe=8, codes_col="codes").first()
    assert work["probed"] == 500 * 25 and work["scored"] < 0.5 * work["probed"]


@pytest.mark.parametrize("where", ["id % 100 = 3", "id > 2900", "id >= 30", "id < 0"])
def test_filtered_search_goes_on_until_enough_rows_pass(spark, where):
    view = clustered(spark)
    index = build_index(view, "L2", nlist=60)
    assigned = ivf_train.trained(view, index)
    index = ivf_train.calibrate(assigned, index)
    queries = stored_queries(view)
    exact = search(view, queries, "L2", 10, fields=[], where=where)
    found = ivf_search(assigned, queries, index, k=10, where=where)
    if exact.isEmpty():
        assert found.isEmpty()
        return
    assert found.join(view.where(where), "id", "left_anti").isEmpty()
    assert recall_at_k(found, exact).first()["recall"] >= 0.9
    assert found.count() == exact.count()


def test_nprobe_overrides_the_calibration(spark):
    view = clustered(spark, n=500)
    index = dataclasses.replace(build_index(view, "L2", nlist=20), nprobe=1, gap=0.0, spread=np.ones(20))
    assigned = assign_cells(view, index)
    q = stored_queries(view)
    assert hits(ivf_search(assigned, q, index, k=5, nprobe=20)) == hits(search(view, q, "L2", 5, fields=[]))

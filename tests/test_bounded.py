"""Exact search by bounds: equal to a search of all rows, and it leaves out what it may."""

import numpy as np
import pytest

from vecframe.operators.bounded_search import best_keys, bounded_search, grouped
from vecframe.operators.ivf import IVFIndex, assign_cells, build_index
from vecframe.operators.search import search


def table_of(spark, rows, metric, nlist, place):
    view = spark.createDataFrame(rows, "id long, value array<float>").repartition(3)
    index = build_index(view, metric, nlist=nlist)
    return view, grouped(assign_cells(view, index), index, place, 8)


def rows_of(n, seed=0, spread=1.0):
    r = np.random.default_rng(seed)
    c = r.normal(0, 20, (30, 6))
    return [(i, [float(x) for x in c[i % 30] + r.normal(0, spread, 6)]) for i in range(n)]


@pytest.mark.parametrize("metric", ["IP", "L2", "COSINE"])
@pytest.mark.parametrize("spread", [0.5, 30.0])
def test_equals_search(spark, metric, spread, tmp_dir):
    rows = rows_of(900, spread=spread) + [(5000, [0.0] * 6), (5001, None), (5002, [1.0] * 6), (5003, [1.0] * 6)]
    view, grouped_table = table_of(spark, rows, metric, 30, tmp_dir + "/g")
    q = [rows[3][1], rows[40][1], [0.0] * 6, [1.0] * 6, [1e6] * 6, [-3.0, 2.0, 0.0, 0.0, 1.0, 9.0]]
    got = bounded_search(grouped_table, q, 7)
    want = search(view, q, metric, 7, fields=[])
    assert sorted((r.qid, r["rank"], r.id) for r in got.collect()) == sorted((r.qid, r["rank"], r.id) for r in want.collect())
    few = bounded_search(grouped_table, q, 2000, first=1)
    assert few.count() == search(view, q, metric, 2000, fields=[]).count()


def test_cells_out_of_reach_are_not_read(spark, tmp_dir):
    view, grouped_table = table_of(spark, rows_of(900, spread=0.5), "L2", 30, tmp_dir + "/g")
    q = [view.first().value]
    plan = bounded_search(grouped_table, q, 5, first=1)._jdf.queryExecution().executedPlan().toString()
    asked = [p for p in plan.splitlines() if "PushedFilters" in p and "cell" in p]
    # the first pass is written; a second scan, where one is needed, asks for cells by number
    assert all("In(cell" in p or "EqualTo(cell" in p or "IsNotNull(cell" in p for p in asked)
    Q = np.array([[float(x) for x in q[0]]])
    kth = search(view, q, "L2", 5, fields=[]).agg({"score": "max"}).first()[0]
    assert (best_keys(grouped_table, Q) <= kth).sum() <= 4


@pytest.mark.parametrize("metric", ["IP", "L2", "COSINE"])
def test_bounds_hold_for_every_row(spark, metric):
    r = np.random.default_rng(1)
    X = r.normal(0, 3, (400, 5)) + [100, 0, 0, 0, -50]
    C = X[:20]
    if metric == "COSINE":
        C = C / np.linalg.norm(C, axis=1, keepdims=True)
    view = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(X)], "id long, value array<double>")
    index = IVFIndex(C, metric)
    assigned = assign_cells(view, index)
    from vecframe.operators import _kernels as K
    from vecframe.operators.bounded_search import Grouped, cell_radii
    table = Grouped(assigned, index, *cell_radii(assigned, index))
    Q = r.normal(0, 50, (30, 5))
    bound = best_keys(table, Q)
    cell = {r.id: r.cell for r in assigned.collect()}
    key = K.to_key(K.scores(metric, X, Q), metric != "L2").T
    for i in range(400):
        assert (bound[:, cell[i]] <= key[:, i] + 1e-9).all()

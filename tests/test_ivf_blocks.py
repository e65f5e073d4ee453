"""IVF search of many queries: text columns in co-groups, probes as bits, query blocks, all cells of a batch at once."""

import numpy as np
import pytest

from vecframe.operators.ivf import IVFIndex, assign_cells, ivf_search


def made(spark, n=600, nlist=9, metric="IP", seed=3):
    r = np.random.default_rng(seed)
    X = r.normal(0, 1, (n, 6))
    rows = spark.createDataFrame([(i, [float(v) for v in x], f"day{i % 5}") for i, x in enumerate(X)], "id long, value array<double>, dt string")
    index = IVFIndex(X[:nlist].copy(), metric)
    queries = rows.where("id % 4 = 0").selectExpr("id AS qid", "value AS vec")
    return assign_cells(rows, index), queries, index


def hits(df):
    return sorted((r.qid, r["rank"], r.id, r.dt, round(r.score, 9)) for r in df.collect())


def test_cogroup_of_a_probed_cell_without_rows_has_text_columns(spark):
    rows, queries, index = made(spark)
    twice = IVFIndex(np.vstack([index.centroids, index.centroids]), "IP")  # ties go to the first: half of the cells have no row
    want = hits(ivf_search(rows, queries, twice, k=7, nprobe=18, fields=["dt"]))
    got = hits(ivf_search(rows, queries, twice, k=7, nprobe=18, fields=["dt"], method="cogroup"))
    assert got == want and len(got) == 150 * 7


@pytest.mark.parametrize("metric", ["IP", "L2", "COSINE"])
def test_blocks_and_single_cells_give_the_same_hits(spark, metric, monkeypatch):
    from vecframe.operators import ivf
    rows, queries, index = made(spark, metric=metric)
    want = hits(ivf_search(rows, queries, index, k=5, nprobe=4, fields=["dt"]))
    monkeypatch.setattr(ivf, "DENSE_SHARE", 0)  # cell by cell
    assert hits(ivf_search(rows, queries, index, k=5, nprobe=4, fields=["dt"])) == want
    monkeypatch.setattr(ivf, "MAX_PROBE_BYTES", 100)  # fifty queries a block
    assert len(ivf.query_blocks(queries, index, 5)) == 6
    assert hits(ivf_search(rows, queries, index, k=5, nprobe=4, fields=["dt"])) == want


def test_probes_reach_the_driver_as_a_bit_a_cell(spark):
    from vecframe.operators.ivf import _by_cell, _probes, probe_cells
    _, queries, index = made(spark, nlist=13)
    qids, _, bits = _probes(queries, index, 5)
    assert bits.shape == (150, 2) and bits.dtype == np.uint8
    wanted = np.unpackbits(bits, axis=1, count=13)
    pairs = {(r.qid, r.cell) for r in probe_cells(queries, index, 5).collect()}
    assert pairs == {(int(qids[q]), int(c)) for q, c in np.argwhere(wanted)} and len(pairs) == 150 * 5
    assert np.array_equal(np.unpackbits(_by_cell(bits, 13), axis=1, count=150).T, wanted)


def test_many_probes_are_not_grouped_with_their_vectors(spark, monkeypatch):
    from vecframe.operators import ivf
    rows, queries, index = made(spark)
    monkeypatch.setattr(ivf, "MAX_BROADCAST_PROBES", 10, raising=False)  # what sent them to co-groups
    plan = ivf_search(rows, queries, index, k=5, nprobe=9)._jdf.queryExecution().toString()
    assert "CoGroups" not in plan

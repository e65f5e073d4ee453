import math

import numpy as np
import pytest

from vecframe.llm import whitening as W
from vecframe.llm.queries import QUERIES

EXTRA = ["x", "component", "n", "row", "entries", "at", "d"]


def table(spark, rows):
    """``embeddings`` with extra columns whose names the operator uses inside."""
    schema = "vec_id long, embedding array<float>, " + ", ".join(f"`{c}` string" for c in EXTRA)
    return spark.createDataFrame([(i, v, *["s"] * len(EXTRA)) for i, v in rows], schema).repartition(5)


def brute(vectors, most=16):
    """Model by NumPy's own eigenvectors, over the distinct integer vectors."""
    x = [tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v) for v in vectors]
    kept = sorted(set(x))
    a = np.array(kept, dtype=object)
    n, sums = len(kept), a.sum(0)
    y = np.array([[float(n * c - s) / n for c, s in zip(row, sums)] for row in kept])
    v = y.T @ y / n
    values, vectors = np.linalg.eigh(v)
    return x, n, sums, values[::-1][:most], vectors.T[::-1][:most], float(np.trace(v))


def check(rows, ids, vectors, most=16):
    x, n, sums, values, axes, trace = brute(vectors, most)
    got = {}
    for r in rows:
        got.setdefault((r.vec_id, r.deviation), {})[r.component] = r
    m = len(next(iter(got.values())))
    y = np.array([[float(n * c - s) / n for c, s in zip(v, sums)] for v in x])
    signs = None
    for i, v, own in zip(ids, x, y):
        deviation = sum((n * c - s) ** 2 for c, s in zip(v, sums))
        found = got[(i, deviation)]
        w = np.array([found[j + 1].whitened for j in range(m)])
        expected = axes[:m] @ own / np.sqrt(values[:m])
        if signs is None and (np.abs(expected) > 1e-3).all():
            signs = np.sign(w * expected)
        if signs is not None:
            assert np.allclose(w, signs * expected, atol=1e-6)
        assert all(r.n == n and r.identity_error <= 1e-9 and abs(r.explained - values[r.component - 1] / trace) < 1e-9 for r in found.values())
    return m


def test_query_is_numpy(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    rows = QUERIES["op13_whitening"](spark, "/root/testdata/sf0.001")
    assert [t for _, t in rows.dtypes] == ["bigint", "int", "bigint", "bigint", "double", "double", "double"]
    rows = rows.collect()
    assert len(rows) == 16 * len(df)
    assert check(rows, [r.vec_id for r in df], [r.embedding for r in df]) == 16


def test_awkward_rows(spark):
    r = np.random.default_rng(3)
    good = [(i, [float(c) for c in r.normal(0, 2, 5) * [1, 5, 0.1, 3, 2] + [0, 1e4, -7, 0, 2]]) for i in range(40)]
    good += [(3, good[3][1]), (41, good[0][1]), (None, good[1][1])] + [(100 + i, good[2][1]) for i in range(60)]  # copies, and a third of all rows alike
    bad = [(200, None), (201, []), (202, [1.0, None, 2.0, 3.0, 4.0]), (203, [1.0, float("nan"), 1.0, 1.0, 1.0]), (204, [float("inf")] * 5),
           (205, [1.0, 2.0]), (206, [3e38] * 5)]
    rows = W.whiten(table(spark, good + bad)).collect()
    assert {r.vec_id for r in rows} == {i for i, _ in good}
    assert len(rows) == 5 * len(good)
    assert check(rows, [i for i, _ in good], [v for _, v in good]) == 5
    assert {r.n for r in rows} == {40}


def test_no_direction(spark):
    assert W.whiten(table(spark, [])).collect() == []
    assert W.whiten(table(spark, [(1, None), (2, [])])).collect() == []
    assert W.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    # one dimension does not vary, another repeats the first: one direction is left
    rows = W.whiten(table(spark, [(i, [float(i), 5.0, float(i)]) for i in range(9)])).collect()
    assert {r.component for r in rows} == {1} and {round(r.explained, 12) for r in rows} == {1.0}


def test_far_and_large(spark):
    """Far from the origin nothing is lost, and deviations beyond 64 bits are exact."""
    r = np.random.default_rng(8)
    vectors = [[float(np.float32(2 ** 24 + 2 * k)) for k in r.integers(0, 9, 3)] for _ in range(50)] + [[2.0 ** 31, 0.0, -2.0 ** 33]]
    rows = W.whiten(table(spark, list(enumerate(vectors)))).collect()
    x, n, sums, *_ = brute(vectors)
    expected = {i: sum((n * c - s) ** 2 for c, s in zip(v, sums)) for i, v in enumerate(x)}
    assert max(expected.values()) > 2 ** 63
    assert {r.vec_id: int(r.deviation) for r in rows} == expected
    assert max(r.identity_error for r in rows) < 1e-4


@pytest.mark.parametrize("d", [1, 2, 3, 7, 64, 150])
def test_components_are_numpys(d):
    r = np.random.default_rng(d)
    b = r.standard_normal((d, 3 * d))
    a = b @ b.T
    values, vectors = W.components(a, 16)
    assert len(values) == min(16, d)
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:16], rtol=1e-13)
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-13
    assert np.abs(a @ vectors.T - vectors.T * values).max() < 1e-13 * values[0]


@pytest.mark.parametrize("spectrum", [[5.0] * 10 + [4.9999] * 10 + [1.0] * 20, [1e9] + [1.0] * 39, [3.0] * 40, [2.0, 1.0] * 20, [1.0] + [1e-5] * 39])
def test_clusters_stay_orthogonal(spectrum):
    q, _ = np.linalg.qr(np.random.default_rng(1).standard_normal((40, 40)))
    for a in (q @ np.diag(spectrum) @ q.T, np.diag(spectrum), np.kron(np.eye(20), [[2.0, 1.0], [1.0, 2.0]])):
        a = (a + a.T) / 2
        values, vectors = W.components(a, 16)
        assert np.abs(values - np.linalg.eigvalsh(a)[::-1][:16]).max() < 1e-13 * values[0]
        assert np.abs(vectors @ vectors.T - np.eye(16)).max() < 1e-12
        assert np.abs(a @ vectors.T - vectors.T * values).max() < 1e-12 * values[0]


def test_sturm_counts():
    r = np.random.default_rng(2)
    d, e = r.standard_normal(30), r.standard_normal(29)
    e[7] = 0  # the matrix falls into two
    t = np.diag(d) + np.diag(e, 1) + np.diag(e, -1)
    w = np.linalg.eigvalsh(t)
    at = np.concatenate((w - 1e-9, w + 1e-9, [-99, 99]))
    assert W.below(d, e, at).tolist() == [int((w < x).sum()) for x in at]

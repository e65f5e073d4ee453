import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from edge import TEXTS, edge_docs, labels
from vecframe.llm import quality as Q
from vecframe.llm.common import held_out, read_table


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_held_out_accuracy(spark, sf):
    docs, known = (read_table(spark, f"/root/testdata/{sf}", t) for t in ("documents", "labels"))
    rows = Q.resample(docs, known).join(known, "doc_id").where(held_out(F.col("doc_id"))).select("kept", "quality").collect()
    assert all(r.kept for r in rows if r.quality == 1)
    assert sum(r.kept for r in rows if r.quality == 0) <= 1


def test_keep_is_resample(spark):
    docs, known = (read_table(spark, "/root/testdata/sf0.001", t) for t in ("documents", "labels"))
    rows = Q.resample(docs, known)
    kept = Q.keep(docs, known)
    assert kept.columns == docs.columns
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == sorted(r[0] for r in rows.where("kept").select("doc_id").collect())
    for k in (0, 1, 17):
        some = Q.resample(docs, known, k=k).where("kept")
        assert some.count() == k == Q.keep(docs, known, k=k).count()


def test_top_keys_are_kept(spark):
    docs, known = (read_table(spark, "/root/testdata/sf0.001", t) for t in ("documents", "labels"))
    rows = Q.resample(docs, known, k=50).collect()
    assert {r.doc_id for r in rows if r.kept} == {r.doc_id for r in sorted(rows, key=lambda r: -r.key)[:50]}


def test_gumbel_noise_has_its_distribution(spark):
    x = np.array([r[0] for r in spark.range(20_000).select(Q.gumbel(F.col("id"), 3)).collect()])
    assert abs(x.mean() - 0.5772) < 0.03 and abs(x.std() - np.pi / 6 ** 0.5) < 0.03


def test_buckets_match_brute_force():
    """The same texts give the same n-grams alone and in a batch; a text of n tokens has n + 2(n - 1) + (n - 2) of them."""
    texts = ["one two, two! THREE 4x", "", None, "é %%% é", "word"]
    bucket, text = Q.buckets(pa.array(texts))
    for i, t in enumerate(texts):
        alone = np.sort(Q.buckets(pa.array([t], pa.string()))[0])
        assert (np.sort(bucket[text == i]) == alone).all()
    assert [(text == i).sum() for i in range(5)] == [7 + 12 + 5, 0, 0, 3 + 4 + 1, 1]


def test_kth_largest(spark):
    r = np.random.default_rng(1)
    values = np.concatenate((r.normal(size=500), np.full(200, 0.25), [1e9, -1e9, 3.0, 3.0]))
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    for k in (1, 2, 3, 4, 5, 100, 250, 400, 703, 704):
        assert Q.kth_largest(df, "x", k) == np.sort(values)[::-1][k - 1]


def test_parting_takes_the_widest_gap():
    w, good = np.array([-9.0, -8.0, -7.0, 2.0, 3.0, 5.0]), np.array([False, False, False, True, True, True])
    assert Q.parting(w, good) == -2.5
    assert Q.parting(np.array([1.0, 1.0]), np.array([True, False])) in (0.0, 2.0)


@pytest.mark.parametrize("rows", [[], [(1, 1, 0), (6, 0, 0), (9, None, 1), (9, 1, None), (None, 0, 0), (7, 1, 1)]])
def test_edge_table(spark, rows):
    docs, known = edge_docs(spark), labels(spark, rows)
    got = Q.resample(docs, known).collect()
    assert len(got) == len(TEXTS)
    assert {r.log_weight for r in got if r.doc_id in (2, 3, 4)} == {0.0}
    assert len({(r.key, r.kept) for r in got if r.doc_id == 9}) == 1
    assert Q.keep(docs, known).count() == sum(r.kept for r in got)
    if not rows:
        assert all(r.kept for r in got)


def test_empty_table(spark):
    empty, known = edge_docs(spark, []), labels(spark, [(1, 1, 0), (2, 0, 0)])
    assert Q.resample(empty, known).collect() == [] and Q.keep(empty, known).collect() == []

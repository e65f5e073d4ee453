"""The inverted BM25 index against brute force over small tables."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vecframe.operators import bm25


def toks(s):
    return [t for t in re.split(r"[^\w]+|_", (s or "").lower()) if t]


def corpus(seed, n=300):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["the"] * 30
    rows = [(i, " ".join(r.choice(words) for _ in range(r.randrange(0, 30)))) for i in range(n)]
    rows += [(5, "w1 w2 extra"), (5, None), (None, "the w3"), (7, rows[7][1]), (n + 1, ""), (-4, "the the the w39")]
    rows += [(1000 + i, "the same text w1 w2") for i in range(n // 2)]  # a third of all rows alike
    return rows


def documents(rows):
    out = {}
    for i, t in rows:
        out.setdefault(i, Counter()).update(toks(t))
    return out


def brute(docs, queries, k, drop=None):
    n = len(docs)
    avg = sum(sum(c.values()) for c in docs.values()) / n
    df = Counter(t for c in docs.values() for t in c)

    def weight(t, c):
        idf = math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5))
        return idf * (c[t] * 2.2) / (c[t] + 1.2 * (0.25 + 0.75 * sum(c.values()) / avg))

    kept = {}
    for i, c in docs.items():
        w = {t: weight(t, c) for t in c}
        kept[i] = {t: x for t, x in w.items() if drop is None or (sum(y < x for y in w.values()) / max(1, len(w) - 1)) >= drop}
    out = {}
    for qid, q in queries:
        scores = {}
        for i, w in kept.items():
            hit = [(m, w[t]) for t, m in Counter(toks(q)).items() if t in w]
            if hit:
                scores[i] = sum(math.floor(m * x * 1e8 + 0.5) for m, x in hit) / 1e8
        out[qid] = sorted(scores.items(), key=lambda x: (-x[1], x[0] is not None, x[0] or 0))[:k]
    return out


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.qid, r["rank"])):
        out.setdefault(r.qid, []).append((r.doc_id, r.score))
    return out


QUERIES = [(1, "the w1 w1 w2"), (2, "w39 absent"), (3, "the"), (4, "absent"), (5, " ".join(f"w{i}" for i in range(40))), (6, "")]


@pytest.mark.parametrize("shard,cells", [(4096, 1 << 22), (16, 200), (1, 1)])
def test_search_prune_and_match(spark, monkeypatch, shard, cells):
    monkeypatch.setattr(bm25, "SMALL_SHARD", shard)
    monkeypatch.setattr(bm25, "SHARD_DOCS", max(shard, 16))
    monkeypatch.setattr(bm25, "SCORE_CELLS", cells)
    rows = corpus(shard)
    docs = documents(rows)
    index = bm25.build_index(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    qs = spark.createDataFrame(QUERIES, "qid long, text string")
    assert index.n_docs == len(docs)
    assert {(r.doc_id, r.term): (r.tf, r.dl) for r in index.postings.collect()} == {
        (i, t): (n, sum(c.values())) for i, c in docs.items() for t, n in c.items()}
    want = {q: x for q, x in brute(docs, QUERIES, 7).items() if x}
    found = got(bm25.search(index, qs, 7))
    assert {q: [d for d, _ in x] for q, x in found.items()} == {q: [d for d, _ in x] for q, x in want.items()}
    assert all(abs(a - b) < 1e-7 for q in want for (_, a), (_, b) in zip(found[q], want[q]))
    small = got(bm25.search(bm25.pruned(index, 0.2), qs, 7))
    want = {q: x for q, x in brute(docs, QUERIES, 7, drop=0.2).items() if x}
    assert {q: [d for d, _ in x] for q, x in small.items()} == {q: [d for d, _ in x] for q, x in want.items()}
    for mode, fits in (("any", any), ("all", all)):
        pairs = {(q, i) for q, t in QUERIES if toks(t) for i, c in docs.items() if fits(w in c for w in set(toks(t)))}
        rows_of = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        for hits in (bm25.match(index, qs, mode), bm25.scan_match(rows_of, qs, mode)):
            hits = [tuple(r) for r in hits.collect()]
            assert len(hits) == len(set(hits)) and set(hits) == pairs


def test_term_counts_are_the_index_terms(spark):
    rows = corpus(9)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    docs = documents(rows)
    want = {t: (sum(t in c for c in docs.values()), sum(c[t] for c in docs.values())) for t in set().union(*docs.values())}
    assert {r.term: (r.df, r.cf) for r in bm25.term_counts(df).collect()} == want
    assert {r.term: (r.df, r.cf) for r in bm25.term_stats(bm25.build_index(df)).collect()} == want
    assert bm25.term_counts(df.limit(0)).collect() == []


def test_text_ids_and_empty_tables(spark):
    rows = [("b", "x y"), ("a", "x"), (None, "x x"), ("c", "z")]
    index = bm25.build_index(spark.createDataFrame(rows, "doc_id string, text string"))
    qs = spark.createDataFrame([(1, "x")], "qid long, text string")
    assert {r.doc_id for r in bm25.search(index, qs, 5).collect()} == {"a", "b", None}
    assert {r.doc_id for r in bm25.match(index, qs, "all").collect()} == {"a", "b", None}
    empty = bm25.build_index(spark.createDataFrame([], "doc_id long, text string"))
    assert bm25.search(empty, qs, 5).collect() == [] and bm25.match(empty, qs, "any").collect() == []
    assert bm25.scan_match(spark.createDataFrame([], "doc_id long, text string"), qs, "all").collect() == []


def test_low_shards_are_left_out(spark):
    """A term block that can't reach the k-th score is not decoded, and the result is the same."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    qs = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select(F.col("item_id").alias("qid"), "text")
    index = bm25.build_index(docs)
    loose = bm25.BM25Index(index.blocks.withColumn("tf_max", F.lit(10 ** 6)).withColumn("dl_min", F.lit(1)), index.terms, index.n_docs, index.avgdl, index.gaps, index.shards)
    assert got(bm25.search(index, qs, 2)) == got(bm25.search(loose, qs, 2))

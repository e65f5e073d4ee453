"""Registered text and scalar-index queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from vecframe.operators import bm25
from vecframe.operators.filters import prefix_filter, range_filter
from vecframe.plans.registry import register
from vecframe.plans.views import table

_TOK = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda t: t <> '')"

_BM25_CTE = rf"""
d AS (SELECT doc_id, {_TOK} AS toks FROM documents),
dl AS (SELECT doc_id, len(toks) AS dl FROM d),
st AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg(dl) AS avgdl FROM dl),
p AS (SELECT doc_id, t AS term, count(*) AS tf FROM (SELECT doc_id, unnest(toks) AS t FROM d) GROUP BY 1, 2),
df AS (SELECT term, count(*) AS df FROM p GROUP BY term),
w AS (SELECT p.term, p.doc_id,
             ln(1.0::DOUBLE + (st.n - df.df + 0.5::DOUBLE) / (df.df + 0.5::DOUBLE))
             * (p.tf * 2.2::DOUBLE) / (p.tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl.dl / st.avgdl)) AS w
      FROM p JOIN df ON p.term = df.term JOIN dl ON dl.doc_id = p.doc_id CROSS JOIN st),
q AS (SELECT item_id AS qid, t AS term, count(*) AS qtf
      FROM (SELECT item_id, unnest({_TOK}) AS t FROM benchmark) GROUP BY 1, 2)
"""


def _bm25_sql(where_w: str = "w") -> str:
    return f"""
WITH {_BM25_CTE},
ww AS (SELECT * FROM {where_w}),
s AS (SELECT q.qid, ww.doc_id, sum(CAST(floor(q.qtf * ww.w * 100000000.0::DOUBLE + 0.5::DOUBLE) AS BIGINT)) AS score FROM q JOIN ww ON q.term = ww.term GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rk FROM s)
SELECT qid, CAST(rk AS BIGINT) AS rank, doc_id, round(score / 100000000.0::DOUBLE, 6) AS score FROM r WHERE rk <= 10
"""


def _queries(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), "text")


def _index(spark, sf_dir):
    return bm25.build_index(table(spark, sf_dir, "documents"))


@register("bm25_topk", _bm25_sql())
def bm25_topk(spark, sf_dir):
    """A5: BM25 top 10 documents for every benchmark passage."""
    res = bm25.search(_index(spark, sf_dir), _queries(spark, sf_dir), k=10)
    return res.withColumn("score", F.round("score", 6))


@register("bm25_topk_pruned", _bm25_sql(
    "(SELECT * FROM (SELECT *, percent_rank() OVER (PARTITION BY doc_id ORDER BY w) AS pr FROM w) WHERE pr >= 0.2)"))
def bm25_topk_pruned(spark, sf_dir):
    """As bm25_topk with drop ratio 0.2 on the index side."""
    res = bm25.search(bm25.pruned(_index(spark, sf_dir), 0.2), _queries(spark, sf_dir), k=10)
    return res.withColumn("score", F.round("score", 6))


@register("term_stats", rf"""
WITH d AS (SELECT doc_id, {_TOK} AS toks FROM documents),
p AS (SELECT doc_id, t AS term, count(*) AS tf FROM (SELECT doc_id, unnest(toks) AS t FROM d) GROUP BY 1, 2)
SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM p GROUP BY term
""")
def term_stats(spark, sf_dir):
    """A5 statistics: document and collection frequency of every term."""
    return bm25.term_counts(table(spark, sf_dir, "documents"))


_MATCH_CTE = rf"""
dt_ AS (SELECT DISTINCT doc_id, unnest({_TOK}) AS term FROM documents),
qt AS (SELECT DISTINCT item_id AS qid, unnest({_TOK}) AS term FROM benchmark),
nq AS (SELECT qid, count(*) AS nq FROM qt GROUP BY qid),
m AS (SELECT qt.qid, dt_.doc_id, count(*) AS m FROM qt JOIN dt_ ON qt.term = dt_.term GROUP BY 1, 2)
"""


@register("text_match_any", f"""
WITH {_MATCH_CTE}
SELECT qid, count(*) AS n_docs FROM m GROUP BY qid
""")
def text_match_any(spark, sf_dir):
    """Q7 (any): documents sharing at least one term with each passage, counted."""
    hits = bm25.scan_match(table(spark, sf_dir, "documents"), _queries(spark, sf_dir), "any")
    return hits.groupBy("qid").agg(F.count(F.lit(1)).alias("n_docs"))


@register("text_match_all", f"""
WITH {_MATCH_CTE}
SELECT m.qid, m.doc_id FROM m JOIN nq ON m.qid = nq.qid WHERE m.m = nq.nq
""")
def text_match_all(spark, sf_dir):
    """Q7 (all): documents that contain every term of a passage."""
    return bm25.scan_match(table(spark, sf_dir, "documents"), _queries(spark, sf_dir), "all")


@register("text_match_index", f"""
WITH {_MATCH_CTE}
SELECT m.qid, m.doc_id FROM m JOIN nq ON m.qid = nq.qid WHERE m.m = nq.nq
""")
def text_match_index(spark, sf_dir):
    """Q7 (all) on the inverted index: rarest term first, cut term by term."""
    return bm25.match(_index(spark, sf_dir), _queries(spark, sf_dir), "all")


@register("range_filter", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey BETWEEN 1000 AND 4999
""")
def range_filter_q(spark, sf_dir):
    """Q5: inclusive range on an integer key (row-group min/max skipping)."""
    o = table(spark, sf_dir, "orders")
    return range_filter(o, "o_orderkey", 1000, 4999).select("o_orderkey", "o_custkey", "o_totalprice")


@register("prefix_filter", """
SELECT page_id, url FROM pages WHERE starts_with(url, 'https://m.')
""")
def prefix_filter_q(spark, sf_dir):
    """Q6: string prefix, pushed to the scan as StringStartsWith."""
    return prefix_filter(table(spark, sf_dir, "pages"), "url", "https://m.").select("page_id", "url")

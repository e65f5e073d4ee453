"""Registered search queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from vecframe.operators.search import search
from vecframe.plans.registry import register
from vecframe.plans.sqlgen import topk_sql
from vecframe.plans.views import SQL_COLLECTION, SQL_COLLECTION_SCALED, SQL_COLLECTION_SHIFTED, SQL_STORED_QUERIES, collection_view, stored_queries, query_of

BENCH_FIELDS = ["deviceCode", "createTime", "dt"]
TIE = ["dt", "createTime"]


def _round(df):
    return df.withColumn("score", F.round("score", 6))


def _one(view, qid, metric, k, fields=BENCH_FIELDS, **kw):
    return _round(search(view, query_of(view, qid), metric, k, fields=fields, tie_cols=TIE, **kw).drop("qid"))


def _all(view, metric, k, fields=(), **kw):
    return _round(search(view, stored_queries(view), metric, k, fields=list(fields), tie_cols=TIE, **kw)
                  .select("qid", "rank", "id", "score"))


Q_ROW0 = "SELECT id AS qid, value AS qv FROM c WHERE id = 0"
Q_ROW1 = "SELECT id AS qid, value AS qv FROM c WHERE id = 1"
Q_LAST = "SELECT id AS qid, value AS qv FROM c WHERE id = (SELECT max(id) FROM c)"
Q_STORED = SQL_STORED_QUERIES


@register("topk_ip", topk_sql(SQL_COLLECTION, Q_ROW0, "IP", 10, with_qid=False))
def topk_ip(spark, sf_dir):
    """V1 + V4: inner-product top 10 for the vector of row 0 (the flagship)."""
    return _one(collection_view(spark, sf_dir), 0, "IP", 10)


@register("topk_l2", topk_sql(SQL_COLLECTION_SCALED, Q_ROW1, "L2", 10, with_qid=False))
def topk_l2(spark, sf_dir):
    """V2: squared-L2 top 10 on the scaled copy (lower is better)."""
    return _one(collection_view(spark, sf_dir, scaled=True), 1, "L2", 10)


@register("topk_l2_shifted", topk_sql(SQL_COLLECTION_SHIFTED, Q_ROW1, "L2", 10, with_qid=False))
def topk_l2_shifted(spark, sf_dir):
    """V2 far from the origin, where |x|^2 + |q|^2 - 2xq would cancel."""
    return _one(collection_view(spark, sf_dir, shift=10_000), 1, "L2", 10)


@register("topk_batch_l2_shifted", topk_sql(SQL_COLLECTION_SHIFTED, Q_STORED, "L2", 10, fields="", out_fields=""))
def topk_batch_l2_shifted(spark, sf_dir):
    """V2 + V5 far from the origin."""
    return _all(collection_view(spark, sf_dir, shift=10_000), "L2", 10)


@register("topk_cosine", topk_sql(SQL_COLLECTION_SCALED, Q_ROW1, "COSINE", 10, with_qid=False))
def topk_cosine(spark, sf_dir):
    """V3: cosine top 10 on the scaled copy."""
    return _one(collection_view(spark, sf_dir, scaled=True), 1, "COSINE", 10)


@register("topk_ip_scaled", topk_sql(SQL_COLLECTION_SCALED, Q_ROW1, "IP", 10, with_qid=False))
def topk_ip_scaled(spark, sf_dir):
    """V1 on the scaled copy: differs from COSINE and L2 there."""
    return _one(collection_view(spark, sf_dir, scaled=True), 1, "IP", 10)


@register("topk_batch", topk_sql(SQL_COLLECTION_SCALED, Q_STORED, "IP", 10, fields="", out_fields=""))
def topk_batch(spark, sf_dir):
    """V5: every 20th row of the scaled collection is a query; IP top 10 each."""
    return _all(collection_view(spark, sf_dir, scaled=True), "IP", 10)


@register("topk_batch_l2", topk_sql(SQL_COLLECTION_SCALED, Q_STORED, "L2", 10, fields="", out_fields=""))
def topk_batch_l2(spark, sf_dir):
    """V5 under squared L2."""
    return _all(collection_view(spark, sf_dir, scaled=True), "L2", 10)


@register("topk_batch_cosine", topk_sql(SQL_COLLECTION_SCALED, Q_STORED, "COSINE", 10, fields="", out_fields=""))
def topk_batch_cosine(spark, sf_dir):
    """V5 under COSINE."""
    return _all(collection_view(spark, sf_dir, scaled=True), "COSINE", 10)


def _bounded(view, metric):
    from vecframe.operators.bounded_search import bounded_search, grouped
    from vecframe.operators.ivf import assign_cells, build_index
    rows = view.select("id", "value", "dt", "createTime")
    index = build_index(rows, metric, method="kmeans")
    found = bounded_search(grouped(assign_cells(rows, index), index), stored_queries(view), 10, tie_cols=TIE)
    return _round(found.select("qid", "rank", "id", "score"))


@register("topk_bounded", topk_sql(SQL_COLLECTION_SCALED, Q_STORED, "IP", 10, fields="", out_fields=""))
def topk_bounded(spark, sf_dir):
    """V5 that skips what cannot matter: cells whose bound does not reach the k-th score of a first pass are not read."""
    return _bounded(collection_view(spark, sf_dir, scaled=True), "IP")


@register("topk_bounded_l2", topk_sql(SQL_COLLECTION_SCALED, Q_STORED, "L2", 10, fields="", out_fields=""))
def topk_bounded_l2(spark, sf_dir):
    """V2 + V5 by bounds."""
    return _bounded(collection_view(spark, sf_dir, scaled=True), "L2")


@register("collection_loaded", topk_sql(SQL_COLLECTION, Q_ROW0, "IP", 10, with_qid=False, fields="", out_fields="").replace(
    "SELECT CAST(rk AS BIGINT) AS rank", "SELECT TRUE AS from_memory, TRUE AS from_files_after, CAST(rk AS BIGINT) AS rank"))
def collection_loaded(spark, sf_dir):
    """A loaded collection is searched in memory, and after release from its files again."""
    from vecframe.operators.tables import load, release
    view = collection_view(spark, sf_dir).select("id", "value", "dt", "createTime")

    def hits():
        found = search(view, query_of(view, 0), "IP", 10, fields=[], tie_cols=TIE).select("rank", "id", F.round("score", 6).alias("score"))
        return found.collect(), "InMemoryTableScan" in found._jdf.queryExecution().executedPlan().toString()

    load(view)
    _, loaded = hits()
    release(view)
    rows, still = hits()
    return spark.createDataFrame([(loaded, not still, *r) for r in rows], "from_memory boolean, from_files_after boolean, rank long, id long, score double")


@register("generated_rows", """
SELECT count(*) AS n, CAST(sum(vec_id) AS BIGINT) AS id_sum, 8 AS dim, TRUE AS in_range, TRUE AS varied, TRUE AS repeatable,
       16 AS query_dim, TRUE AS query_in_range FROM embeddings
""")
def generated_rows(spark, sf_dir):
    """S10 + S12: one hello row for every stored id, and a query vector: counts, ranges, and the same values again."""
    from vecframe.plans.views import table
    from vecframe.sources.generate import hello_rows, query_vector
    ids = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"))
    rows = hello_rows(ids, 8)
    x = F.concat(F.array(F.col("f1").cast("double")), F.col("embeddings").cast("array<double>"))
    stats = rows.select("ID", F.size("embeddings").alias("d"), F.array_min(x).alias("lo"), F.array_max(x).alias("hi"), "f1", F.xxhash64("f1", "embeddings").alias("h"))
    one = stats.agg(F.count(F.lit(1)).alias("n"), F.sum("ID").alias("id_sum"), F.max("d").alias("dim"), ((F.min("lo") >= 0) & (F.max("hi") < 1)).alias("in_range"),
                    (F.countDistinct("f1") * 100 > F.count(F.lit(1)) * 99).alias("varied"), F.sum(F.col("h") % 1000003).alias("h1"))
    again = hello_rows(ids.repartition(3), 8).agg(F.sum(F.xxhash64("f1", "embeddings") % 1000003).alias("h2"))
    q = query_vector(spark, 16)
    fine = len(set(q)) == 16 and all(0 <= v < 1 for v in q) and q == query_vector(spark, 16)
    return one.join(again, how="left").select(  # both sides are single rows
        "n", "id_sum", "dim", "in_range", "varied", (F.col("h1") == F.col("h2")).alias("repeatable"),
        F.lit(len(q)).alias("query_dim"), F.lit(fine).alias("query_in_range"))


_STORED_SQL = topk_sql(
    SQL_COLLECTION, Q_LAST, "IP", 10, with_qid=False,
    fields="c.deviceCode, c.createTime, c.dt, c.label, c.value",
    out_fields="deviceCode, createTime, dt, label, "
               "'[' || array_to_string(list_transform(value, lambda x: printf('%.7f', x)), ',') || ']' AS value_text")


@register("topk_stored_vector", _STORED_SQL)
def topk_stored_vector(spark, sf_dir):
    """V7: the last inserted row's stored vector as the query, all fields back."""
    from vecframe.functions.vector import vector_text
    view = collection_view(spark, sf_dir)
    last = view.agg(F.max("id").alias("m"))
    q = view.join(last, view["id"] == last["m"], "left_semi").select(F.col("id").alias("qid"), F.col("value").alias("vec"))
    res = search(view, q, "IP", 10, fields=BENCH_FIELDS + ["label", "value"], tie_cols=TIE)
    return _round(res.drop("qid")).select("rank", "id", "score", *BENCH_FIELDS, "label",
                                          vector_text("value").alias("value_text"))


@register("topk_ids_scores", topk_sql(SQL_COLLECTION, Q_ROW0, "IP", 100, with_qid=False, fields="", out_fields=""))
def topk_ids_scores(spark, sf_dir):
    """V8: ids and scores only, k = 100 (the run-notes setting)."""
    return _one(collection_view(spark, sf_dir), 0, "IP", 100, fields=[]).select("rank", "id", "score")


@register("topk_partition", topk_sql(SQL_COLLECTION, Q_ROW0, "IP", 10, with_qid=False,
                                     where="c.dt IN ('20250816', '', '20250814')"))
def topk_partition(spark, sf_dir):
    """V6 + Q3: search only the days of the list '20250816,,20250814'."""
    from vecframe.operators.tables import partition_list
    view = collection_view(spark, sf_dir)
    return _one(view, 0, "IP", 10, partitions=partition_list("20250816,,20250814"))


def _filter_sql(p: float) -> str:
    return topk_sql(SQL_COLLECTION, Q_STORED, "IP", 10, fields="", out_fields="",
                    where=f"c.id >= (SELECT CAST(floor(count(*) * {p}) AS BIGINT) FROM embeddings)")


def _int_filtered(spark, sf_dir, rate):
    from vecframe.operators.filters import int_filter_threshold
    view = collection_view(spark, sf_dir)
    thr = int_filter_threshold(view, rate)
    return _all(view, "IP", 10, where=F.col("id") >= F.lit(thr))


@register("topk_int_filter_1p", _filter_sql(0.01))
def topk_int_filter_1p(spark, sf_dir):
    """1 % of ids filtered out (id >= 1 % of n); every 20th row is a query."""
    return _int_filtered(spark, sf_dir, 0.01)


@register("topk_int_filter_99p", _filter_sql(0.99))
def topk_int_filter_99p(spark, sf_dir):
    """99 % of ids filtered out (id >= 99 % of n); every 20th row is a query."""
    return _int_filtered(spark, sf_dir, 0.99)


@register("topk_label_filter", topk_sql(SQL_COLLECTION, Q_STORED, "IP", 10, fields="", out_fields="",
                                        where="c.label = 3"))
def topk_label_filter(spark, sf_dir):
    """E5: label equality filter before top-k; every 20th row is a query."""
    view = collection_view(spark, sf_dir)
    return _all(view, "IP", 10, where=F.col("label") == 3)


@register("count_all", "SELECT count(*) AS n FROM embeddings")
def count_all(spark, sf_dir):
    """Q1: count(*) of the collection."""
    from vecframe.operators.tables import count_rows
    return count_rows(collection_view(spark, sf_dir))


@register("count_by_partition", f"""
SELECT dt, count(*) AS n FROM ({SQL_COLLECTION}) c
WHERE dt IN ('20250817', '', '20250815') GROUP BY dt
""")
def count_by_partition(spark, sf_dir):
    """Q2 + Q3: row count per named day of '20250817,,20250815'."""
    from vecframe.operators.tables import count_partitions, partition_list
    return count_partitions(collection_view(spark, sf_dir), partition_list("20250817,,20250815"))


@register("count_per_day", f"SELECT dt, count(*) AS n FROM ({SQL_COLLECTION}) c GROUP BY dt")
def count_per_day(spark, sf_dir):
    """Q2 with an empty list: every day."""
    from vecframe.operators.tables import count_partitions, partition_list
    return count_partitions(collection_view(spark, sf_dir), partition_list(""))


@register("project_fields", f"SELECT id, deviceCode, createTime FROM ({SQL_COLLECTION}) c")
def project_fields(spark, sf_dir):
    """Q4: output-field projection over every row; the vector column is never read."""
    view = collection_view(spark, sf_dir)
    return view.select("id", "deviceCode", "createTime")

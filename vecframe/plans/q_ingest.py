"""Registered day-partition ingest queries."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from vecframe.operators.backfill import assign_days, plan_summary, progress
from vecframe.operators.tables import DEFAULT_PARTITION, count_partitions, expire_filter
from vecframe.plans.registry import register
from vecframe.plans.sqlgen import topk_sql
from vecframe.plans.views import SQL_COLLECTION, SQL_STORED_QUERIES, collection_view, stored_queries, table
from vecframe.session import scratch_path

# Fixed parameters of the registered backfill: rows of `embeddings` loaded in
# batches of 50 into days of at most 120 rows, walking back from the day
# before 2025-08-17 over the collection's existing days.
BATCH, MAX_ROWS = 50, 120
START = _dt.date(2025, 8, 16)

_CAL_SQL = f"""
ex AS (SELECT dt, count(*) AS c FROM ({SQL_COLLECTION}) GROUP BY dt),
nb AS (SELECT CAST(ceil(count(*) / {BATCH}.0) AS BIGINT) AS nb, count(*) AS n FROM embeddings),
days AS (SELECT i AS day_index, strftime(DATE '{START.isoformat()}' - CAST(i AS INTEGER), '%Y%m%d') AS dt
         FROM range(0, (SELECT nb FROM nb)) t(i)),
cal AS (SELECT d.day_index, d.dt, coalesce(ex.c, 0) AS existing,
               greatest(1, CAST(ceil(({MAX_ROWS} - coalesce(ex.c, 0)) / {BATCH}.0) AS BIGINT)) AS cap
        FROM days d LEFT JOIN ex ON d.dt = ex.dt),
cum AS (SELECT *, sum(cap) OVER (ORDER BY day_index) - cap AS first_batch FROM cal),
b AS (SELECT i AS batch, CASE WHEN i = nb - 1 THEN n - {BATCH} * (nb - 1) ELSE {BATCH} END AS rows_in
      FROM range(0, (SELECT nb FROM nb)) t(i), nb),
a AS (SELECT b.batch, b.rows_in, cum.dt, cum.existing FROM b JOIN cum
      ON b.batch >= cum.first_batch AND b.batch < cum.first_batch + cum.cap)
"""


def _assigned(spark, sf_dir):
    # the rows that are already there also include some without a day
    view = collection_view(spark, sf_dir)
    stray = view.where("id % 10 = 0").withColumn("dt", F.lit(DEFAULT_PARTITION))
    existing = count_partitions(view.unionByName(stray), None)
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("value"))
    return assign_days(rows, existing, START, BATCH, MAX_ROWS, stable=True)


@register("backfill_plan", f"""
WITH {_CAL_SQL}
SELECT dt, existing, count(*) AS batches, CAST(sum(rows_in) AS BIGINT) AS rows,
       existing + CAST(sum(rows_in) AS BIGINT) AS total
FROM a GROUP BY dt, existing
""")
def backfill_plan(spark, sf_dir):
    """P2 + P4: which day each batch lands in, with capacity roll-back."""
    assigned, cal = _assigned(spark, sf_dir)
    return plan_summary(assigned, cal)


@register("ingest_progress", f"""
WITH {_CAL_SQL}
SELECT batch, dt, CAST(rows_in AS BIGINT) AS rows,
       existing + CAST(sum(rows_in) OVER (PARTITION BY dt ORDER BY batch) AS BIGINT) AS day_total
FROM a
""")
def ingest_progress(spark, sf_dir):
    """Running day total after each batch."""
    assigned, cal = _assigned(spark, sf_dir)
    return progress(assigned, cal)


@register("expire_one_day", f"""
SELECT dt, count(*) AS n FROM ({SQL_COLLECTION}) WHERE dt <> '20250814' GROUP BY dt
""")
def expire_one_day(spark, sf_dir):
    """Today 2025-08-17, keep 3 days: exactly 20250814 goes, older days stay."""
    view = collection_view(spark, sf_dir)
    return count_partitions(expire_filter(view, _dt.date(2025, 8, 17), 3), None)


@register("collection_lifecycle", f"""
SELECT dt, count(*) AS n, CAST(sum(id) AS BIGINT) AS id_sum FROM ({SQL_COLLECTION}) WHERE dt <> '20250814' GROUP BY dt
""")
def collection_lifecycle(spark, sf_dir):
    """L1, S6, L7, L8 on a real table: create it in the shared folder, append
    every row to its own day, drop exactly today - 3, read the files back."""
    import uuid

    from vecframe.operators import tables as TB
    from vecframe.session import scratch_path
    name = f"vf_life_{uuid.uuid4().hex[:10]}"
    location = scratch_path(spark, "life")
    TB.create_collection(spark, name, dim=64, index="HNSW", metric="IP", location=location)
    TB.append(spark, name, collection_view(spark, sf_dir).select("id", "value", "deviceCode", "createTime", "dt"))
    TB.expire_day(spark, name, _dt.date(2025, 8, 17), 3)
    schema = spark.table(name).schema
    TB.drop_collection(spark, name)  # external table: the catalog entry goes, the files stay
    return (spark.read.schema(schema).parquet(location)
            .groupBy("dt").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("id_sum")))


def _new_table(spark, kind: str, **kw) -> str:
    """A collection of its own in the shared folder; returns its name."""
    import uuid

    from vecframe.operators import tables as TB
    from vecframe.session import scratch_path
    name = f"vf_{kind}_{uuid.uuid4().hex[:10]}"
    TB.create_collection(spark, name, dim=64, location=scratch_path(spark, kind), **kw)
    return name


def _kept(spark, df, kind: str):
    """``df`` written to the shared folder, so that its tables can go."""
    from vecframe.session import scratch_path
    path = scratch_path(spark, kind)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_ROWS = ["id", "value", "deviceCode", "createTime", "dt"]


def _grown_sql() -> str:
    """The collection whose ids of 3 modulo 4 are in the default partition."""
    return SQL_COLLECTION.replace("strftime(DATE '2025-08-17' - CAST(vec_id // 100 AS INTEGER), '%Y%m%d') AS dt",
                                  "CASE WHEN vec_id % 4 = 3 THEN '_default' ELSE "
                                  "strftime(DATE '2025-08-17' - CAST(vec_id // 100 AS INTEGER), '%Y%m%d') END AS dt")


def _grown_topk(spark, sf_dir, index: str, search_kw):
    """Half of the rows, then the index, then the other half - to the days that are there and to the default
    partition - then a search."""
    from vecframe.operators import tables as TB
    view = collection_view(spark, sf_dir)
    name = _new_table(spark, "grown", index=index, metric="IP")
    TB.append(spark, name, view.where("id % 2 = 0").select(*_ROWS))
    if index.startswith(("IVF", "GPU")):
        TB.build_collection_index(spark, name, f"{scratch_path(spark, 'grown-index')}", method="mean")
    TB.append(spark, name, view.where("id % 4 = 1").select(*_ROWS))
    TB.append(spark, name, view.where("id % 4 = 3").select(*_ROWS).drop("dt"))
    hits = TB.collection_search(spark, name, stored_queries(view), 10, fields=["dt"], **search_kw)
    out = _kept(spark, hits.select("qid", "rank", "id", F.round("score", 6).alias("score"), "dt"), "hits")
    TB.drop_collection(spark, name)
    return out


_GROWN_TOPK = topk_sql(_grown_sql(), SQL_STORED_QUERIES, "IP", 10, fields="c.dt", out_fields="dt")


@register("collection_ivf_topk", _GROWN_TOPK)
def collection_ivf_topk(spark, sf_dir):
    """A1 + A4 on a growing collection: rows appended after the build, to a built day and to the default
    partition, are found; probing every cell equals exact search."""
    return _grown_topk(spark, sf_dir, "IVF_FLAT", {"nprobe": 1 << 30})


@register("collection_hnsw_topk", _GROWN_TOPK)
def collection_hnsw_topk(spark, sf_dir):
    """A4: the default index name is answered exactly."""
    return _grown_topk(spark, sf_dir, "HNSW", {})


@register("collection_unknown_index", _GROWN_TOPK + " AND FALSE")
def collection_unknown_index(spark, sf_dir):
    """A4: an unknown index name made no index: no rows."""
    return _grown_topk(spark, sf_dir, "NO_SUCH_INDEX", {})


@register("append_today", f"SELECT dt, count(*) AS n, CAST(sum(id) AS BIGINT) AS id_sum FROM ({SQL_COLLECTION}) GROUP BY dt")
def append_today_q(spark, sf_dir):
    """Every row goes to the day of its own time."""
    from vecframe.operators import tables as TB
    name = _new_table(spark, "today")
    TB.append_today(spark, name, collection_view(spark, sf_dir).select("id", "value", "deviceCode", "createTime"))
    out = _kept(spark, spark.table(name).groupBy("dt").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("id_sum")), "today-counts")
    TB.drop_collection(spark, name)
    return out


@register("catalog_outcomes", f"""
SELECT * FROM (VALUES ('exists before', 0), ('exists after create', 1), ('create again keeps the rows', (SELECT count(*) FROM embeddings)),
                      ('days', (SELECT count(DISTINCT dt) FROM ({SQL_COLLECTION}))), ('first day exists', 1), ('other day exists', 0),
                      ('rows after replace', 0), ('exists after drop', 0), ('numbered collections', 3),
                      ('rows of each', (SELECT count(*) FROM region)), ('dropped with all', 2)) t(what, n)
""")
def catalog_outcomes(spark, sf_dir):
    """Outcomes of create, replace, exists, drop, drop all, numbered collections and partition lists."""
    import uuid

    from vecframe.operators import tables as TB
    from vecframe.session import scratch_path
    view = collection_view(spark, sf_dir)
    per = table(spark, sf_dir, "region").count()
    place = scratch_path(spark, "catalog")
    name = f"vf_cat_{uuid.uuid4().hex[:10]}"
    found = [("exists before", int(TB.collection_exists(spark, name)))]
    TB.create_collection(spark, name, dim=64, location=f"{place}/a")
    found.append(("exists after create", int(TB.collection_exists(spark, name))))
    TB.append(spark, name, view.select(*_ROWS))
    TB.create_collection(spark, name, dim=64, location=f"{place}/a")
    days = TB.list_partitions(spark, name)
    found += [("create again keeps the rows", spark.table(name).count()), ("days", len(days)),
              ("first day exists", int(TB.partition_exists(spark, name, max(days)))), ("other day exists", int(TB.partition_exists(spark, name, "19990101")))]
    TB.create_collection(spark, name, dim=64, location=f"{place}/b", replace=True)
    found.append(("rows after replace", spark.table(name).count()))
    TB.drop_collection(spark, name)
    found.append(("exists after drop", int(TB.collection_exists(spark, name))))
    # numbered collections and drop all in a database of their own
    base = f"vf_db_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {base} LOCATION '{place}/db'")
    TB.create_numbered(spark, f"{base}.many", 4, 6, per, dim=4, location=f"{place}/many")
    TB.create_collection(spark, f"{base}.other", dim=4, location=f"{place}/other")
    sizes = {r["collection"]: r["count"] for r in spark.table(f"{base}.many").groupBy("collection").count().collect()}
    found += [("numbered collections", len(sizes)), ("rows of each", per if set(sizes.values()) == {per} else -1),
              ("dropped with all", len(TB.drop_all(spark, base, confirm=True)))]
    spark.sql(f"DROP DATABASE {base}")
    return spark.createDataFrame(found, "what string, n long")

"""Tables whose days are written in batches: listed, expired and compacted by day."""

import datetime as dt
import os

from pyspark.sql import functions as F

from vecframe.operators import tables as TB


def filled(spark, place, name="vf_batch_days"):
    TB.create_collection(spark, name, dim=2, location=place, replace=True, batch_key=True)
    rows = spark.range(12).select(F.col("id"), F.array(F.lit(1.0).cast("float"), F.col("id").cast("float")).alias("value"),
                                  F.lit("d").alias("deviceCode"), F.lit(0).cast("long").alias("createTime"))
    for day, batch in (("20250810", 0), ("20250810", 7), ("20250811", 1), ("it's", 2)):
        TB.append(spark, name, rows.where(F.col("id") % 3 == batch % 3), day=day, batch_id=batch)
    TB.append(spark, name, rows.limit(2), day="20250812")
    return name


def counts(spark, name):
    spark.catalog.refreshTable(name)
    return {r.dt: r.n for r in spark.table(name).groupBy("dt").agg(F.count("*").alias("n")).collect()}


def test_days_are_listed_and_expire_with_their_batches(spark, tmp_dir):
    name = filled(spark, tmp_dir + "/t")
    assert TB.list_partitions(spark, name) == ["20250810", "20250811", "20250812", "it's"]
    assert TB.partition_exists(spark, name, "20250810") and TB.partition_exists(spark, name, "it's") and not TB.partition_exists(spark, name, "20250809")
    assert sorted(p["batch_id"] for p in TB.partition_specs(spark, name, "20250810")) == ["0", "7"]
    assert TB.expire_day(spark, name, dt.date(2025, 8, 17), 7) == "20250810"
    assert TB.list_partitions(spark, name) == ["20250811", "20250812", "it's"] and counts(spark, name) == {"20250811": 4, "20250812": 2, "it's": 4}
    assert not any("part-" in f for d, _, names in os.walk(tmp_dir + "/t/dt=20250810") for f in names)
    TB.expire_day(spark, name, dt.date(2025, 8, 17), 7)  # nothing is left of that day
    TB.drop_collection(spark, name)


def test_many_batches_are_dropped_in_steps(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(TB, "SPECS_PER_DROP", 2)
    name = "vf_many_batches"
    TB.create_collection(spark, name, dim=1, location=tmp_dir + "/t", replace=True, batch_key=True)
    row = spark.range(1).select("id", F.array(F.lit(1.0).cast("float")).alias("value"), F.lit("d").alias("deviceCode"), F.lit(0).cast("long").alias("createTime"))
    for batch in range(5):
        TB.append(spark, name, row, day="20250810", batch_id=batch)
    TB.expire_day(spark, name, dt.date(2025, 8, 10), 0)
    assert TB.list_partitions(spark, name) == []
    TB.drop_collection(spark, name)


def test_a_closed_day_is_compacted_into_one_batch(spark, tmp_dir):
    name = filled(spark, tmp_dir + "/t")
    before = sorted(r.id for r in spark.table(name).where("dt = '20250810'").collect())
    TB.compact_day(spark, name, "20250810", 1, tmp_dir + "/compact")
    assert TB.partition_specs(spark, name, "20250810") == [{"dt": "20250810", "batch_id": str(TB.COMPACTED)}]
    after = spark.table(name).where("dt = '20250810'")
    assert sorted(r.id for r in after.collect()) == before and len(after.inputFiles()) == 1
    assert counts(spark, name)["20250811"] == 4
    assert TB.expire_day(spark, name, dt.date(2025, 8, 10), 0) == "20250810" and "20250810" not in counts(spark, name)
    assert not os.path.exists(tmp_dir + "/compact")
    TB.drop_collection(spark, name)


def test_loaded_rows_are_in_memory_until_released(spark, tmp_dir):
    spark.range(10).write.parquet(tmp_dir + "/r")
    df = spark.read.parquet(tmp_dir + "/r")
    assert TB.load(df).storageLevel.useMemory
    assert "InMemoryTableScan" in spark.read.parquet(tmp_dir + "/r").where("id > 3")._jdf.queryExecution().executedPlan().toString()
    TB.release(df)
    assert "InMemoryTableScan" not in df.where("id > 3")._jdf.queryExecution().executedPlan().toString()


def test_filtered_collection_search(spark, tmp_dir):
    """A filter and the index of a built collection together: as exact filtered search where every cell is probed."""
    from vecframe.operators.search import search
    from vecframe.plans.views import collection_view, stored_queries
    view = collection_view(spark, "/root/testdata/sf0.001")
    cols = ["id", "value", "deviceCode", "createTime", "dt"]
    for kind, spill in (("IVF_FLAT", False), ("IVF_SQ8", False), ("IVF_FLAT", True)):
        name = f"vf_filtered_{kind.lower()}_{int(spill)}"
        TB.create_collection(spark, name, dim=64, index=kind, metric="IP", location=f"{tmp_dir}/{name}", replace=True)
        TB.append(spark, name, view.where("id < 400").select(*cols))
        TB.build_collection_index(spark, name, f"{tmp_dir}/{name}-index", method="mean", spill=spill)
        TB.append(spark, name, view.where("id >= 400").select(*cols))  # found without a new build
        q = stored_queries(view)
        for where in (F.col("deviceCode") == "device120", F.col("id") >= 450, None):
            got = TB.collection_search(spark, name, q, 5, nprobe=1 << 30, rerank=True, where=where)
            want = search(view, q, "IP", 5, fields=[], where=where)
            assert sorted((r.qid, r["rank"], r.id) for r in got.collect()) == sorted((r.qid, r["rank"], r.id) for r in want.collect())
        TB.drop_collection(spark, name)

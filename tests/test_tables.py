import datetime as dt

from pyspark.sql import functions as F

from vecframe.operators import tables as TB
from vecframe.sources.batches import assign_ids, batch_counts, with_row_numbers
from vecframe.sources.generate import bench_rows


def test_lifecycle_append_expire(spark, tmp_dir):
    name = "vf_test_coll"
    TB.drop_collection(spark, name)
    TB.create_collection(spark, name, dim=4, location=tmp_dir + "/coll")
    assert TB.collection_exists(spark, name)
    TB.create_collection(spark, name, dim=4)  # if absent: no error, no change
    assert TB.collection_props(spark, name)["vecframe.dim"] == "4"
    rows = bench_rows(spark.range(6), 4, now_ms=1755388800000)
    for day in ("20250809", "20250810", "20250811"):
        TB.append(spark, name, rows, day=day)
    TB.append(spark, name, rows)  # default partition
    assert sorted(TB.list_partitions(spark, name)) == ["20250809", "20250810", "20250811", "_default"]
    dropped = TB.expire_day(spark, name, dt.date(2025, 8, 17), 7)
    assert dropped == "20250810"
    import os
    assert not os.path.exists(tmp_dir + "/coll/dt=20250810") and os.path.exists(tmp_dir + "/coll/dt=20250809")
    assert sorted(TB.list_partitions(spark, name)) == ["20250809", "20250811", "_default"]
    counts = {r["dt"]: r["n"] for r in TB.count_partitions(spark.table(name), ["20250809", ""]).collect()}
    assert counts == {"20250809": 6}
    plan = TB.count_partitions(spark.table(name), ["20250809"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    TB.drop_collection(spark, name)
    assert not TB.collection_exists(spark, name)


def test_wrong_dimension_rejected_on_write(spark, tmp_dir):
    import pytest
    name = "vf_test_dim"
    TB.create_collection(spark, name, dim=3, location=tmp_dir + "/d", replace=True)
    rows = bench_rows(spark.range(2), 4, now_ms=0)
    with pytest.raises(Exception, match="dimension"):
        TB.append(spark, name, rows, day="20250101")
    TB.drop_collection(spark, name)


def test_row_numbers_dense_and_batches(spark):
    df = spark.range(0, 1003, numPartitions=7).select((F.col("id") * 3).alias("x"))
    rn = sorted(r["row_no"] for r in with_row_numbers(df).collect())
    assert rn == list(range(1003))
    got = {r["batch"]: r["n"] for r in batch_counts(df, 100).collect()}
    assert got == {**{i: 100 for i in range(10)}, 10: 3}
    ids = sorted(r["id"] for r in assign_ids(df.repartition(3), start=5, stable=False).collect())
    assert ids == list(range(5, 1008))


def test_generators_repeatable(spark):
    a = bench_rows(spark.range(50), 8, now_ms=1).collect()
    b = bench_rows(spark.range(0, 50, numPartitions=5), 8, now_ms=1).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    assert all(0.0 <= x < 1.0 for r in a for x in r["value"])
    assert all(r["deviceCode"].startswith("device1") and len(r["deviceCode"]) == 9 for r in a)


def test_numbered_collections_one_job(spark, tmp_dir):
    rows = TB.numbered_rows(spark, 3, 5, 4, 8)
    got = {r["collection"]: r["n"] for r in rows.groupBy("collection").agg(F.count("*").alias("n")).collect()}
    assert got == {"coll_3": 4, "coll_4": 4, "coll_5": 4}
    r = rows.first()
    assert len(r["value"]) == 8 and 10 <= len(r["indexText"].split()) <= 20 and r["docId"] >= 0
    TB.create_numbered(spark, "vf_numbered", 0, 1, 3, 4, location=tmp_dir + "/num")
    assert spark.table("vf_numbered").where("collection = 'coll_1'").count() == 3
    TB.drop_collection(spark, "vf_numbered")


def test_other_generators(spark):
    from vecframe.sources.batches import hash_ids
    from vecframe.sources.generate import hello_rows, pick_one, query_vector
    h = hello_rows(spark.range(300), 4).collect()
    assert len(h) == 300 and all(0 <= r["f1"] < 1 and len(r["embeddings"]) == 4 for r in h)
    assert query_vector(spark, 16) == query_vector(spark, 16)
    df = spark.range(100)
    assert pick_one(df).first()["id"] == pick_one(df.repartition(5)).first()["id"]
    a = {r["id"] for r in hash_ids(spark.range(50).withColumnRenamed("id", "x"), ["x"]).collect()}
    assert len(a) == 50


def test_compact_day(spark, tmp_dir):
    name = "vf_compact"
    TB.create_collection(spark, name, dim=4, location=tmp_dir + "/c", replace=True)
    for i in range(3):
        TB.append(spark, name, bench_rows(spark.range(i * 10, i * 10 + 10), 4, now_ms=0), day="20250101")
    before = sorted(r["id"] for r in spark.table(name).collect())
    TB.compact_day(spark, name, "20250101", 1, tmp_dir + "/c_new/dt=20250101")
    after = spark.table(name)
    assert sorted(r["id"] for r in after.collect()) == before
    files = after.select("_metadata.file_path").distinct().count()
    assert files == 1
    import os
    assert not os.path.exists(tmp_dir + "/c/dt=20250101")  # the old small files are gone
    TB.drop_collection(spark, name)


def test_collection_search_dispatch(spark, tmp_dir):
    rows = bench_rows(spark.range(20), 4, now_ms=0)
    TB.create_collection(spark, "vf_s_hnsw", dim=4, index="HNSW", metric="L2", location=tmp_dir + "/h", replace=True)
    TB.append(spark, "vf_s_hnsw", rows, day="20250817")
    q = [float(x) for x in rows.where("id = 3").first()["value"]]
    res = TB.collection_search(spark, "vf_s_hnsw", [q], k=3).collect()
    assert [r["id"] for r in sorted(res, key=lambda r: r["rank"])][0] == 3 and res[0]["score"] >= 0  # L2 from props
    TB.create_collection(spark, "vf_s_odd", dim=4, index="NO_SUCH_INDEX", location=tmp_dir + "/o", replace=True)
    TB.append(spark, "vf_s_odd", rows, day="20250817")
    none = TB.collection_search(spark, "vf_s_odd", [q], k=3)
    assert none.count() == 0 and "score" in none.columns
    TB.drop_collection(spark, "vf_s_hnsw")
    TB.drop_collection(spark, "vf_s_odd")


def test_collection_index_build_and_fresh_days(spark, tmp_dir):
    from vecframe.operators.search import search
    for kind in ("IVF_FLAT", "IVF_SQ8"):
        name = "vf_ivf_" + kind.lower()
        TB.create_collection(spark, name, dim=8, index=kind, metric="IP", location=f"{tmp_dir}/{name}", replace=True)
        TB.append(spark, name, bench_rows(spark.range(0, 300), 8, now_ms=0), day="20250816")
        assert TB.build_collection_index(spark, name, f"{tmp_dir}/{name}_idx", nlist=4, method="mean") in ("ivf", "ivf_sq8")
        TB.append(spark, name, bench_rows(spark.range(300, 400), 8, now_ms=0), day="20250817")  # after the build
        q = [0.5] * 8
        got = TB.collection_search(spark, name, [q], k=5, nprobe=4, rerank=True).collect()
        want = search(spark.table(name), [q], "IP", 5, fields=["dt"]).collect()
        assert [r["id"] for r in sorted(got, key=lambda r: r["rank"])] == [r["id"] for r in sorted(want, key=lambda r: r["rank"])]
        TB.append(spark, name, bench_rows(spark.range(400, 700), 8, now_ms=0), day="20250816")  # to a built day
        TB.append(spark, name, bench_rows(spark.range(700, 800), 8, now_ms=0))  # to the default partition
        got = TB.collection_search(spark, name, [q], k=40, nprobe=4, rerank=True).collect()
        want = search(spark.table(name), [q], "IP", 40, fields=["dt"]).collect()
        assert [r["id"] for r in sorted(got, key=lambda r: r["rank"])][:30] == [r["id"] for r in sorted(want, key=lambda r: r["rank"])][:30]
        assert {r["id"] for r in TB.collection_search(spark, name, [q], k=1000, nprobe=4).collect()} == set(range(800))
        import pytest
        with pytest.raises(ValueError):
            TB.collection_search(spark, name, [q], k=3, metric="L2")
        fresh_only = TB.collection_search(spark, name, [q], k=3, nprobe=4, partitions=["20250817"]).collect()
        assert len(fresh_only) == 3 and all(r["dt"] == "20250817" for r in fresh_only)
        TB.expire_day(spark, name, dt.date(2025, 8, 17), 1)  # 20250816: built into the cell table
        after = TB.collection_search(spark, name, [q], k=500, nprobe=4).collect()
        assert len(after) == 200 and {r["dt"] for r in after} == {"20250817", "_default"}
        TB.drop_collection(spark, name)


def test_one_large_day_is_written_by_many_tasks(spark, tmp_dir):
    import glob
    TB.create_collection(spark, "vf_wide", dim=64, location=tmp_dir + "/wide", replace=True)
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        TB.append(spark, "vf_wide", bench_rows(spark.range(0, 40_000, numPartitions=8), 64, now_ms=0), day="20250817")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(glob.glob(tmp_dir + "/wide/dt=20250817/*.parquet")) >= 4
    assert spark.table("vf_wide").count() == 40_000
    TB.drop_collection(spark, "vf_wide")


def test_batch_keyed_append_is_replayable(spark, tmp_dir):
    TB.create_collection(spark, "vf_keyed", dim=4, location=tmp_dir + "/keyed", replace=True, batch_key=True)
    for batch in (0, 1, 1, 0):
        TB.append(spark, "vf_keyed", bench_rows(spark.range(10), 4, now_ms=0), day="20250817", batch_id=batch)
    TB.append(spark, "vf_keyed", bench_rows(spark.range(3), 4, now_ms=0), day="20250816")
    assert spark.table("vf_keyed").count() == 23
    TB.drop_collection(spark, "vf_keyed")


def test_backfill_over_the_default_partition(spark):
    from vecframe.operators.backfill import plan_days
    existing = spark.createDataFrame([("_default", 500), ("20250816", 30), (None, 4)], "dt string, n long")
    plan = plan_days(spark, existing, dt.date(2025, 8, 16), 4, 10, 25)
    assert sorted((r.dt, r.batches) for r in plan.prefix.collect()) == [("20250816", 1)]

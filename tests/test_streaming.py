import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecframe.streaming.ingest import daily_append, file_stream, phase_rates, run_to_end


def test_available_now_equals_batch_and_restart_adds_nothing(spark, tmp_dir):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    src_dir = os.path.join(tmp_dir, "src")
    ev.where("event_id < 400").write.parquet(src_dir + "/part1")
    sink, ckpt = os.path.join(tmp_dir, "sink"), os.path.join(tmp_dir, "ckpt")
    out_schema = T.StructType(ev.schema.fields + [T.StructField("dt", T.StringType())])

    def run():
        s = file_stream(spark, src_dir + "/*", ev.schema)
        run_to_end(daily_append(s, sink, ckpt))
        return spark.read.schema(out_schema).parquet(sink)

    assert run().count() == 400
    assert run().count() == 400  # restart from the checkpoint: no row twice
    ev.where("event_id >= 400").write.parquet(src_dir + "/part2")
    out = run()
    assert out.count() == ev.count()
    want = {r["d"]: r["n"] for r in ev.groupBy(F.date_format("ts", "yyyyMMdd").alias("d")).agg(F.count("*").alias("n")).collect()}
    got = {r["dt"]: r["n"] for r in out.groupBy("dt").agg(F.count("*").alias("n")).collect()}
    assert got == want


def test_phase_rates_cycle(spark):
    rows = [(f"2024-01-01 00:00:{s:02d}",) for s in range(10) for _ in range(1000)]
    rows += [(f"2024-01-01 00:00:{s:02d}",) for s in range(10, 60) for _ in range(218)]
    df = spark.createDataFrame(rows, "t string").select(F.col("t").cast("timestamp_ntz").alias("ts"))
    got = {r["phase"]: (r["rows"], r["cycles"]) for r in phase_rates(df).collect()}
    assert got == {"high": (10000, 1), "low": (10900, 1)}


def test_periodic_search_writes_each_batch(spark, tmp_dir):
    from vecframe.operators.search import search_one
    from vecframe.plans.views import collection_view
    from vecframe.streaming.ingest import periodic_search
    view = collection_view(spark, "/root/testdata/sf0.001")
    ticks_dir = os.path.join(tmp_dir, "ticks")
    spark.range(3).write.parquet(ticks_dir + "/t1")
    ticks = file_stream(spark, ticks_dir + "/*", spark.range(1).schema)
    sink, ckpt = os.path.join(tmp_dir, "psink"), os.path.join(tmp_dir, "pckpt")
    q = [0.1] * 64
    run_to_end(periodic_search(ticks, lambda: view, lambda base: search_one(base, q, "IP", 10), sink, ckpt,
                               trigger="availableNow"))
    out = spark.read.parquet(sink)
    assert out.count() == 10 and "ms" in out.columns and "batch_id" in out.columns


def test_insert_requests_append_rows(spark, tmp_dir):
    from vecframe.operators import tables as TB
    from vecframe.streaming.requests import insert_request_stream
    TB.create_collection(spark, "vf_ins", dim=4, location=tmp_dir + "/tbl", replace=True)
    src = os.path.join(tmp_dir, "req")
    spark.createDataFrame([(1, "3"), (2, "abc"), (3, "50001"), (4, "2")], "req_id long, num_text string") \
        .write.parquet(src + "/p1")
    reqs = file_stream(spark, src + "/*", T.StructType([T.StructField("req_id", T.LongType()),
                                                        T.StructField("num_text", T.StringType())]))
    sink, ckpt = os.path.join(tmp_dir, "isink"), os.path.join(tmp_dir, "ickpt")
    run_to_end(insert_request_stream(reqs, sink, ckpt, table="vf_ins", dim=4))
    log = {r["req_id"]: (r["num"], r["error"]) for r in spark.read.parquet(sink).collect()}
    assert log[1] == (3, None) and log[2][0] is None and log[3][0] is None and log[4] == (2, None)
    rows = spark.table("vf_ins")
    assert rows.count() == 5 and sorted(r["id"] for r in rows.collect()) == [0, 0, 1, 1, 2]
    assert TB.bounded_append(spark, "vf_ins", "4", now_ms=0, day="20250101") == 4
    import pytest
    with pytest.raises(ValueError):
        TB.bounded_append(spark, "vf_ins", "50001", now_ms=0)
    TB.drop_collection(spark, "vf_ins")


def test_search_while_inserting(spark, tmp_dir):
    """Each search batch sees the rows the ingest stream has committed so far."""
    from pyspark.sql import types as TT
    from vecframe.operators.search import search_one
    from vecframe.streaming.ingest import periodic_search
    emb = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = emb.select(F.col("vec_id").alias("id"), F.col("embedding").alias("value"),
                      F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("ts"))
    src = os.path.join(tmp_dir, "in")
    sink, ckpt = os.path.join(tmp_dir, "coll"), os.path.join(tmp_dir, "ck")
    schema = rows.schema
    out_schema = TT.StructType(schema.fields + [TT.StructField("dt", TT.StringType())])
    seen = []
    for part in range(2):
        rows.where(F.col("id") % 2 == part).write.parquet(f"{src}/p{part}")
        run_to_end(daily_append(file_stream(spark, src + "/*", schema), sink, ckpt))
        ticks = os.path.join(tmp_dir, f"ticks{part}")
        spark.range(1).write.parquet(ticks + "/t")
        psink = os.path.join(tmp_dir, f"hits{part}")
        run_to_end(periodic_search(file_stream(spark, ticks + "/*", spark.range(1).schema),
                                   lambda: spark.read.schema(out_schema).parquet(sink),
                                   lambda base: search_one(base, [0.1] * 64, "IP", 1000, fields=[]),
                                   psink, os.path.join(tmp_dir, f"pck{part}"), trigger="availableNow"))
        seen.append(spark.read.parquet(psink).count())
    assert seen == [250, 500]


def test_rate_ingest_writes_today(spark, tmp_dir):
    """T1 with the clock-driven source: rows arrive in today's partition."""
    import time
    from vecframe.sources.generate import bench_rows
    from vecframe.streaming.ingest import rate_ingest
    sink, ckpt = os.path.join(tmp_dir, "rsink"), os.path.join(tmp_dir, "rck")
    q = rate_ingest(spark, 50, lambda src: bench_rows(src.select("id"), 4, now_ms=0), sink, ckpt, trigger_seconds=1)
    try:  # a rate source never runs dry: wait for a committed batch, then stop
        deadline = time.time() + 60
        while time.time() < deadline and (q.lastProgress is None or q.lastProgress["numInputRows"] == 0):
            time.sleep(1)
    finally:
        q.stop()
    out = spark.read.parquet(sink)
    today = spark.range(1).select(F.date_format(F.current_timestamp(), "yyyyMMdd").alias("d")).first()["d"]
    assert out.count() > 0 and {r["dt"] for r in out.select(F.col("dt").cast("string")).distinct().collect()} <= \
        {today, str(int(today) - 1)}

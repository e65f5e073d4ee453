import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 10
    assert df.columns == ["rank", "id", "score", "deviceCode", "createTime", "dt"]


def test_every_oracle_has_a_query():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50


def test_entry_works_without_the_training_data_queries(monkeypatch):
    import sys
    for gone in ("corpus_pipeline", "vecframe.llm"):
        with monkeypatch.context() as m:
            m.delitem(sys.modules, "corpus_pipeline", raising=False)
            for name in [n for n in sys.modules if n.startswith("vecframe.llm")]:
                m.delitem(sys.modules, name)
            m.setitem(sys.modules, gone, None)
            names = set(E.queries())
            assert "topk_ip" in names and not any(n.startswith("op") or n == "pipeline" for n in names)
            assert set(E.oracle_sql()) <= names


def test_percentiles_keep_a_null_group(spark):
    from vecframe.operators.evaluate import exact_percentiles, latency_summary
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0), (None, 7.0), (None, None)], "g string, ms double")
    for bound in (2_000_000, 1):
        got = {r["g"]: (r["n"], r["p50"]) for r in exact_percentiles(df, ["g"], "ms", max_window_values=bound).collect()}
        assert got == {"a": (2, 2.0), None: (2, 6.0)}
    assert {(r["g"], r["mean"]) for r in latency_summary(df, ["g"]).collect()} == {("a", 2.0), (None, 6.0)}


def test_exact_percentiles_match_numpy(spark):
    import numpy as np
    from vecframe.operators.evaluate import exact_percentiles
    rnd = np.random.default_rng(1)
    vals = np.round(rnd.exponential(3, 5000), 2)
    grp = rnd.integers(0, 3, 5000)
    df = spark.createDataFrame([(int(g), float(v)) for g, v in zip(grp, vals)], "g int, v double")
    for bound in (2_000_000, 10):  # one window per group / range-split hot groups
        got = {r["g"]: r for r in exact_percentiles(df, ["g"], "v", max_window_values=bound).collect()}
        for g in range(3):
            x = vals[grp == g]
            assert got[g]["n"] == len(x)
            for p, name in ((0.5, "p50"), (0.95, "p95"), (0.99, "p99")):
                assert abs(got[g][name] - np.quantile(x, p)) < 1e-9


def test_code_archive_lives_in_the_shared_folder(spark):
    import glob
    from vecframe.session import local_path, ship_package
    ship_package(spark)
    ckpt = local_path(spark.sparkContext.getCheckpointDir())
    assert glob.glob(f"{ckpt}/vecframe-pyfiles-*/vecframe.zip")

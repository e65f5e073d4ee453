import pytest
from pyspark.sql import functions as F

from vecframe.functions import chunk_array, day_shift, parse_date_string, split_by_comma, validate_insert_num, vector_text


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"s {typ}")


def test_parse_dates_six_layouts(spark):
    vals = ["2025-08-13", "2025/08/13", "13-08-2025", "13/08/2025", "20250813", "2025-08-13 01:02:03",
            "2025-8-1", "x", ""]
    out = one_col(spark, vals).select("s", F.date_format(parse_date_string("s"), "yyyy-MM-dd HH:mm:ss").alias("p"))
    got = {r["s"]: r["p"] for r in out.collect()}
    for v in vals[:5]:
        assert got[v] == "2025-08-13 00:00:00"
    assert got["2025-08-13 01:02:03"] == "2025-08-13 01:02:03"
    assert got["2025-8-1"] is None and got["x"] is None and got[""] is None


def test_driver_side_parse_matches():
    from vecframe.functions.dates import py_parse_day
    assert str(py_parse_day("13/08/2025")) == "2025-08-13"
    with pytest.raises(ValueError):
        py_parse_day("x")


def test_day_shift(spark):
    df = spark.createDataFrame([("2025-08-17",)], "d string").select(day_shift(F.col("d"), 7).alias("x"))
    assert df.first()["x"] == "20250810"


def test_vector_text(spark):
    df = spark.createDataFrame([([0.5, 0.1],), ([],), ([0.12890625],)], "v array<float>")
    assert [r["t"] for r in df.select(vector_text("v").alias("t")).collect()] == \
        ["[0.5000000,0.1000000]", "[]", "[0.1289062]"]


def test_chunk_array(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0, 5.0, 6.0],), ([],)], "v array<float>")
    rows = df.select(F.explode(chunk_array("v", 2)).alias("c")).collect()
    assert [list(r["c"]) for r in rows] == [[1.0, 2.0], [3.0, 4.0], [5.0, 6.0]]
    bad = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0, 5.0],)], "v array<float>")
    with pytest.raises(Exception, match="multiple of dim"):
        bad.select(chunk_array("v", 2)).collect()


def test_insert_size_validation(spark):
    num, err = validate_insert_num(F.col("s"))
    out = {r["s"]: (r["n"], r["e"]) for r in one_col(spark, ["50000", "50001", "abc", "-3", "0"]).select(
        "s", num.alias("n"), err.alias("e")).collect()}
    assert out["50000"] == (50000, None)
    assert out["50001"][0] is None and out["50001"][1]
    assert out["abc"][0] is None and out["abc"][1] == "not an integer"
    assert out["-3"][0] is None and out["0"] == (0, None)


def test_split_by_comma(spark):
    out = [r["p"] for r in one_col(spark, ["a,,b", "", "x"]).select(split_by_comma("s").alias("p")).collect()]
    assert out == [["a", "", "b"], None, ["x"]]


def test_epoch_millis_utc_ignores_session_zone(spark):
    from vecframe.functions.dates import epoch_millis_utc
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        df = spark.createDataFrame([("2025-08-17 01:02:03.456",)], "s string").select(
            epoch_millis_utc(F.col("s").cast("timestamp_ntz")).alias("ms"))
        assert df.first()["ms"] == 1755392523456
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_dates_with_one_digit_hours_and_fractions(spark):
    import datetime as dt
    from pyspark.sql import functions as F
    from vecframe.functions.dates import parse_date_string
    rows = [("2025-08-13 1:02:03", dt.datetime(2025, 8, 13, 1, 2, 3)), ("2025-08-13 01:02:03.5", dt.datetime(2025, 8, 13, 1, 2, 3, 500000)),
            ("2025-08-13 23:02:03,25", dt.datetime(2025, 8, 13, 23, 2, 3, 250000)), ("2025-08-13 1:2:03", None), ("2025-08-13 24:02:03", None)]
    df = spark.createDataFrame([(s,) for s, _ in rows], "s string")
    assert [r.t for r in df.select(parse_date_string(F.col("s")).alias("t")).collect()] == [t for _, t in rows]


def test_sq8_codes_keep_null_vectors(spark):
    import numpy as np
    from vecframe.operators.quantize import sq8_encode
    df = spark.createDataFrame([(1, [0.0, 1.0]), (2, None), (3, [1.0, 0.0])], "id long, value array<float>").coalesce(1)
    got = sq8_encode(df, np.zeros(2), np.ones(2)).orderBy("id").collect()
    assert [None if r.codes is None else bytes(r.codes) for r in got] == [b"\x00\xff", None, b"\xff\x00"]

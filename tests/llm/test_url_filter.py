import re

from pyspark.sql import functions as F

from vecframe.llm import url_filter as U

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"), ("a.example.net", "", "block")]


def brute(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), v, h + p) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fits)[3], max(fits)[2]) if fits else (host, path, None, "allow")


def tables(spark):
    return [U.rule_table(spark, [r[:2] for r in RULES if r[2] == v]) for v in ("block", "allow")]


def test_matches_brute_force(spark):
    hosts = ["net", "example.net", "a.example.net", "EXAMPLE.com", "x.org", "org", "notnet", "a..net", "net.", "", "u@h.net:80", "É.net"]
    paths = ["", "/", "/en/", "/en/1", "/de/x", "/fr/", "/fr", "/EN/", "/en", "/" + "x" * 100_000]
    urls = [None, "", "foo", "http//x", "x://net/://b"] + [f"http://{h}{p}{q}" for h in hosts for p in paths for q in ("", "?a=/b", "#t")]
    rows = [(i if i % 9 else None, u, "clash", "clash") for i, u in enumerate([*urls, *urls[:20]])]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")
    judged = U.build(pages, *tables(spark)).judge(pages).collect()
    assert sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in judged), key=repr) == sorted(((i, *brute(u)) for i, u, _, _ in rows), key=repr)


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    for every, stop in ((37, 20_000), (2, 20_000), (1, 20_000), (7, 20)):
        listed = spark.range(0, stop, every).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
        cascade = U.cascade(listed, universe)
        rows = universe.where(cascade.contains(F.col("key"))).select("key").collect()
        assert {r[0] for r in rows} == {f"k{i}" for i in range(0, stop, every)}


def test_listed_keys_that_no_url_has(spark):
    universe = spark.createDataFrame([("a",), ("b",)], "key string")
    cascade = U.cascade(spark.createDataFrame([("b",), ("z",)], "key string"), universe)
    assert [r[0] for r in universe.where(cascade.contains(F.col("key"))).collect()] == ["b"]


def test_empty_lists_and_tables(spark):
    none = spark.createDataFrame([], "host string, path string")
    pages = spark.createDataFrame([(1, "http://a.net/x")], "page_id long, url string")
    (row,) = U.build(pages, none, none).judge(pages).collect()
    assert (row.rule, row.verdict) == (None, "allow")
    empty = pages.limit(0)
    assert U.build(empty, *tables(spark)).judge(empty).collect() == []


def test_no_python_in_the_plan(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    plan = U.build(pages, *tables(spark)).judge(pages)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Join" not in plan

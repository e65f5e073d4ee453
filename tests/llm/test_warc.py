import random
import re

import numpy as np
import pytest

from vecframe.llm import warc as W
from vecframe.session import scratch_path

FAKE = W.MAGIC + "WARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
BITS = [W.MAGIC, FAKE, "é", "<p>" * 30, "x" * 200, "\r\n", "\r\n\r\n", "W", "WARC/1.0\r", "Content-Length: 3\r\n\r\n", FAKE + W.MAGIC + FAKE]


def read(spark, df, split):
    path = scratch_path(spark, "warc-test")
    W.write_archive(df, path)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        return W.read_archive(spark, path).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("n, split", [(1, 300), (25, 150), (60, 900), (80, 1 << 20)])
def test_round_trip_with_magic_in_payloads(spark, n, split):
    random.seed(n)
    rows = []
    for i in range(n):
        html = random.choice([None, "", "short", "".join(random.choice(BITS) for _ in range(random.randint(0, 12)))])
        rows.append((i if random.random() < 0.95 else None, random.choice([None, "http://a/b\r\nX: y", "u"]), html, "clash", "clash"))
    rows += [(1000 + i, "u", "same" * 50, "", "") for i in range(n // 4)]
    rows += rows[:1]
    got = read(spark, spark.createDataFrame(rows, "page_id long, url string, html string, digest string, head string").repartition(3), split)
    first = {}
    for i, _, html, _, _ in rows:
        body = (html or "").encode()
        if len(body) >= 100 and i is not None:
            first[body] = min(first.get(body, i), i)
    want = []
    for i, _, html, _, _ in rows:
        body = (html or "").encode()
        again = i is not None and len(body) >= 100 and first[body] < i
        want.append(("" if i is None else str(i), "revisit" if again else "response", b"" if again else body, str(first[body]) if again else ""))
    field = lambda head, name: (re.search(rf"(?m)^{name}: *([^\r\n]*)", head) or ["", ""])[1]
    page = lambda urn: urn.removeprefix("<urn:page:").removesuffix(">")
    assert sorted(want) == sorted((page(field(r.head, "WARC-Record-ID")), field(r.head, "WARC-Type"), bytes(r.payload), page(field(r.head, "WARC-Refers-To"))) for r in got)


def test_long_payload_over_many_splits(spark):
    html = (FAKE + "y" * 300) * 60
    rows = [(1, "u", html), (2, "u", html), (3, "u", "z" * 2000)]
    got = read(spark, spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), 500)
    assert sorted(bytes(r.payload) for r in got) == sorted([html.encode(), b"", b"z" * 2000])


def test_chained_leaves_the_split():
    offset, follow = np.array([0, 10, 20, 30]), np.array([10, 30, 25, 99])
    assert W.chained(offset, follow, 40).tolist() == [99, 99, -1, 99]
    assert W.chained(offset, np.array([10, 20, 25, -1]), 40).tolist() == [W.BROKEN, W.BROKEN, -1, -1]


@pytest.mark.parametrize("split", [100, 1 << 20])
@pytest.mark.parametrize("tail", ["garbage", W.MAGIC + "no length\r\n\r\nx", W.MAGIC + "Content-Length: 3\r\n\r\nlonger than three\r\n\r\n" + "record",
                                  W.MAGIC + "Content-Length: 999\r\n\r\ncut off"])
def test_records_before_a_broken_place_are_read(spark, tail, split):
    one = lambda text: W.MAGIC + f"X: y\r\nContent-Length: {len(text)}\r\n\r\n{text}\r\n\r\n"
    good = ["first " * 20, "second " + FAKE, "", "third"]
    archive = "".join(map(one, good)) + tail.replace("record", one("after"))
    path = scratch_path(spark, "warc-broken")
    spark.createDataFrame([(archive,)], "value string").coalesce(1).write.option("lineSep", "\n").text(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        got = [bytes(r.payload).decode() for r in sorted(W.read_archive(spark, path).collect(), key=lambda r: r.offset)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got[:3] == good[:3] and got[3:] in ([], good[3:])


def test_empty_table(spark):
    assert read(spark, spark.createDataFrame([], "page_id long, url string, html string"), 1 << 20) == []

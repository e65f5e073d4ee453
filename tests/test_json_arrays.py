"""A JSON array cut at any byte gives the elements that a parser of the whole file gives."""

import json
import os
import random

import numpy as np
import pytest

from vecframe.sources import json_arrays as J
from vecframe.sources.readers import read_query_vectors


def value(r, depth):
    kind = r.randrange(9 if depth else 5)
    if kind < 2:
        return r.choice([0, -1.5, 1e300, True, None, 12345678901234567890])
    if kind < 5:
        return "".join(r.choice(['a', '"', "\\", "{", "}", "[", "]", ",", "é", "😀", "\n", "\\\\", '\\"', "}{"]) for _ in range(r.randrange(0, 9)))
    if kind < 7:
        return [value(r, depth - 1) for _ in range(r.randrange(0, 4))]
    return {f"k{i}" + r.choice(["", '"', "}", "\\"]): value(r, depth - 1) for i in range(r.randrange(0, 4))}


def elements(seed, n):
    r = random.Random(seed)
    return [{"i": i, **{f"f{j}": value(r, 3) for j in range(r.randrange(0, 4))}} for i in range(n)]


@pytest.mark.parametrize("size", ["150", "1000", "128m"])
def test_any_cut(spark, tmp_dir, size):
    want = []
    for f in range(3):
        rows = elements(f, 40)
        want += rows
        with open(os.path.join(tmp_dir, f"{f}.json"), "w") as out:
            json.dump(rows, out, ensure_ascii=f == 1, indent=None if f else 2)
    with open(os.path.join(tmp_dir, "empty.json"), "w") as out:
        out.write(" [ ] \n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        found = [json.loads(r.text) for r in J.array_elements(spark, tmp_dir).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    key = lambda x: json.dumps(x, sort_keys=True)
    assert sorted(map(key, found)) == sorted(map(key, want))


def test_query_vectors_of_one_long_line(spark, tmp_dir):
    vectors = [[float(i), i / 7, -1.0] for i in range(500)]
    with open(os.path.join(tmp_dir, "q.json"), "w") as out:
        json.dump([{"note": 'a"}]', "vec": v} for v in vectors], out)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        df = read_query_vectors(spark, tmp_dir)
        assert spark.read.option("lineSep", "}").text(tmp_dir).rdd.getNumPartitions() > 10
        assert sorted(r.vec[0] for r in df.collect()) == [v[0] for v in vectors]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_written_arrays_are_read_back(spark, tmp_dir):
    rows = spark.createDataFrame([(json.dumps(x),) for x in elements(5, 40)] + [(None,)], "text string").repartition(3)
    J.write_json_array(rows, tmp_dir + "/out")
    found = [json.loads(r.text)["i"] for r in J.array_elements(spark, tmp_dir + "/out").collect()]
    assert sorted(found) == list(range(40))
    J.write_json_array(rows.limit(0), tmp_dir + "/none")
    assert J.array_elements(spark, tmp_dir + "/none").collect() == []


def test_steps_compose():
    """The effect of a text is the composition of the effects of its parts, wherever it is cut."""
    r = random.Random(1)
    text = json.dumps(elements(2, 12), ensure_ascii=False).encode()
    data = np.frombuffer(text, np.uint8)
    whole, end = J.steps(data, False, False)
    for _ in range(100):
        cut = sorted(r.randrange(0, len(data) + 1) for _ in range(3))
        state, parts = (False, False), []
        for a, b in zip([0, *cut], [*cut, len(data)]):
            deeper, state = J.steps(data[a:b], *state)
            parts.append(deeper)
        assert state == end and np.array_equal(np.concatenate(parts), whole)

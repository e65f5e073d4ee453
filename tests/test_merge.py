import json
import random

import pytest

from vecframe.operators.merge import list_union_col, merge_tables

RULES = [
    ('{"a":[1,1,2]}', '{"a":[3,3,2]}', '{"a":[1,1,2,3,3]}'),
    ('{"a":{"b":1}}', '{"a":5}', '{"a":5}'),
    ('{"a":1}', '{"a":null}', '{"a":null}'),
    ('{"a":{"x":1}}', '{"a":{"y":2}}', '{"a":{"x":1,"y":2}}'),
    ('{"a":{}}', '{"b":1}', '{"a":{},"b":1}'),
    ('{"a":{}}', '{"a":{}}', '{"a":{}}'),
    ('{}', '{}', '{}'),
    ('{"a":[{"b":1,"a":2}]}', '{"a":[{"a":2,"b":1}]}', '{"a":[{"b":1,"a":2}]}'),
    ('{"z":1,"a":2}', '{"m":3,"z":4}', '{"z":4,"a":2,"m":3}'),
    ('{"a":1}', '[1,2]', '{"a":1}'),
    ('{"n":12345678901234567890.125,"m":{"k":98765432109876543210.5}}', '{"m":{"z":1.0}}', '{"n":12345678901234567890.125,"m":{"k":98765432109876543210.5,"z":1.0}}'),
    ('{"a":[]}', '{"a":["x\\"y",null,"é"]}', '{"a":["x\\"y",null,"é"]}'),
    ('{"a":[1,true]}', '{"a":[1.0,"1",true,null]}', '{"a":[1,true,1,"1",null]}'),
    ('{"a.b":{"c d":"5"}}', '{"a.b":{"c\\"d":5}}', '{"a.b":{"c d":"5","c\\"d":5}}'),
    ('{"d":{"e":{"f":{"g":1}}}}', '{"d":{"e":{"f":{"h":[2]},"i":{"j":null}}}}', '{"d":{"e":{"f":{"g":1,"h":[2]},"i":{"j":null}}}}'),
    (None, '{"b":1}', '{"b":1}'),
    ('{"b":1}', None, '{"b":1}'),
    (None, None, None),
]


def merged(spark, pairs):
    base = spark.createDataFrame([(i, b) for i, (b, _) in enumerate(pairs)], "key long, doc string")
    patch = spark.createDataFrame([(i, p) for i, (_, p) in enumerate(pairs)], "key long, doc string")
    return [r.doc for r in sorted(merge_tables(base, patch).collect(), key=lambda r: r.key)]


def test_merge_rules(spark):
    assert merged(spark, [(b, p) for b, p, _ in RULES]) == [w for _, _, w in RULES]


def model(b, p):
    """The rules over flat paths: what is at each path of the result (lists and scalars whole, maps as their keys)."""
    def paths(v, at=()):
        yield at, v
        if isinstance(v, dict):
            for k, x in v.items():
                yield from paths(x, (*at, k))

    base, patch = dict(paths(b)), dict(paths(p))
    hard = [q for q, v in patch.items() if not isinstance(v, dict) or q in base and not isinstance(base[q], dict)]
    out = {}
    for q in {*base, *patch}:
        if q not in patch and any(q[:len(h)] == h and len(h) < len(q) for h in hard):
            continue  # replaced higher up
        v = patch.get(q, base.get(q))
        if isinstance(patch.get(q), list) and isinstance(base.get(q), list):
            text = lambda x: json.dumps(x, sort_keys=True)
            v = base[q] + [x for x in patch[q] if text(x) not in set(map(text, base[q]))]
        out[q] = "map" if isinstance(v, dict) else v
    return out


def test_merge_matches_model(spark):
    rnd = random.Random(4)

    def value(depth):
        kind = rnd.choice("mmlsn" if depth < 4 else "lsn")
        if kind == "m":
            return {rnd.choice("abcd"): value(depth + 1) for _ in range(rnd.randint(0, 3))}
        if kind == "l":
            return [rnd.choice([1, 2, "x", None, True, {"b": 1, "a": [2]}]) for _ in range(rnd.randint(0, 3))]
        return rnd.choice([1, 2.5, "x", "é\"", False]) if kind == "s" else None

    pairs = [({"r": value(0), "a": value(0)}, {"r": value(0), "b": value(0)}) for _ in range(150)]
    got = merged(spark, [(json.dumps(b, separators=(",", ":"), ensure_ascii=False), json.dumps(p, separators=(",", ":"), ensure_ascii=False)) for b, p in pairs])
    for (b, p), text in zip(pairs, got):
        assert model(json.loads(text), {}) == model(b, p), (b, p, text)


def test_duplicate_key_is_an_error(spark):
    with pytest.raises(Exception, match="(?i)duplicate|MALFORMED"):
        merged(spark, [('{"a":1,"a":2}', '{}')])


def test_list_union_column(spark):
    df = spark.createDataFrame([([1, 1, 2, None], [3, 3, 2, None])], "t array<int>, s array<int>")
    assert df.select(list_union_col("t", "s").alias("u")).first()["u"] == [1, 1, 2, None, 3, 3]


def test_merge_tables_full_outer(spark):
    base = spark.createDataFrame([(1, '{"a":{"x":1}}'), (2, '{"b":[1]}')], "key long, doc string")
    patch = spark.createDataFrame([(2, '{"b":[1,2],"c":true}'), (3, '{"n":null}')], "key long, doc string")
    got = {r["key"]: r["doc"] for r in merge_tables(base, patch).collect()}
    assert got == {1: '{"a":{"x":1}}', 2: '{"b":[1,2],"c":true}', 3: '{"n":null}'}


def test_repeated_key_is_rejected(spark):
    base = spark.createDataFrame([(1, '{"a":1}'), (1, '{"a":2}')], "key long, doc string")
    patch = spark.createDataFrame([(1, '{"b":1}')], "key long, doc string")
    with pytest.raises(Exception, match="more than one"):
        merge_tables(base, patch)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "key long, doc string")
    assert merge_tables(none, none).collect() == []

import hashlib
import random

import pytest
import xxhash

from edge import TEXTS, edge_docs
from vecframe.llm import simhash as S


def xxh(data, seed=42):
    return xxhash.xxh64_intdigest(data, seed)


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def fingerprint(text):
    """All votes one by one; a null second word leaves the first word's hash."""
    words = (text or "").translate(str.maketrans("\n\r\t", "   ")).split(" ")
    votes = [0] * 64
    for a, b in zip(words, [*words[1:], None]):
        h = xxh(a.encode())
        h = h if b is None else xxh(b.encode(), h)
        weight = min(16, len(a) + len(b or ""))
        for bit in range(64):
            votes[bit] += weight if h >> bit & 1 else -weight
    return sum(1 << bit for bit in range(64) if votes[bit] > 0)


def edits(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, signed(xxh((r[1] or "").encode()))))
    out = []
    for i, (name, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        q = len(text) // 4
        out.append((name, len(text), text[:len(text) - q] + after[:q], text, after))
    return out


def expected(rows):
    like = lambda a, b: 1 - (a ^ b).bit_count() / 64
    out = []
    for name, n, edited, text, after in edits(rows):
        fp, other = fingerprint(text), fingerprint(edited)
        out.append((name, n, hashlib.sha256(edited.encode()).hexdigest(), fp, other, like(fp, other), like(fp, fingerprint(after))))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.fp % (1 << 64), r.edited_fp % (1 << 64), r.near_edited, r.near_next)
                   for r in S.compared(df).collect()), key=repr)


@pytest.mark.parametrize("n", [1, 2, 7, 60])
def test_matches_brute_force(spark, n):
    random.seed(n)
    rows = [(random.choice([None, i, i, i, 3]), random.choice([None, "", "a b", "é中 x y z w\nq " * random.randint(1, 4), "abc def ghi " * random.randint(1, 9)]))
            for i in range(n)]
    if n > 5:
        rows += [(5, "same text here ok")] * 3
    assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == expected(rows)


def test_a_third_of_all_rows_alike(spark):
    """Equal rows are worked on once: their number does not matter."""
    import time
    rows = [(i, f"word{i} and some more text of row {i}") for i in range(200)]
    many = spark.createDataFrame(rows, "doc_id long, text string").union(spark.range(100_000).selectExpr("cast(77 as long)", "'one text that very many rows have'"))
    start = time.time()
    got = S.compared(many.repartition(8))
    path = S.written(got, "many")
    assert path.count() == 100_200 and time.time() - start < 60
    alike = path.where("doc_id = 77 and n_chars = 33").groupBy("near_next", "edited_sha256").count().collect()
    assert sorted(r["count"] for r in alike) == [1, 99_999] and max(alike, key=lambda r: r["count"]).near_next == 1.0


def test_edge_table(spark):
    docs = edge_docs(spark)
    assert found(docs) == expected(TEXTS)
    assert sorted((r.doc_id, r.fp % (1 << 64)) for r in S.fingerprints(docs).collect() if r.doc_id) == sorted((i, fingerprint(t)) for i, t in TEXTS if i)


def test_empty_table(spark):
    assert S.compared(edge_docs(spark, [])).collect() == [] and S.fingerprints(edge_docs(spark, [])).collect() == []


@pytest.mark.parametrize("radius", [0, 1, 3])
def test_within_misses_no_pair(spark, radius):
    random.seed(radius)
    base = [random.getrandbits(64) for _ in range(20)]
    near = [b ^ sum(1 << x for x in random.sample(range(64), random.randint(0, 5))) for b in base for _ in range(10)]
    stored = spark.createDataFrame([(signed(x),) for x in near] + [(None,), (signed(near[0]),)], "fp long")
    queries = spark.createDataFrame([(signed(x),) for x in base] + [(None,)], "fp long")
    got = {(r.query % (1 << 64), r.fp % (1 << 64), r.bits) for r in S.within(queries, stored, radius).collect()}
    assert got == {(a, b, (a ^ b).bit_count()) for a in base for b in near if (a ^ b).bit_count() <= radius}


def test_no_python_in_the_plan(spark):
    df = S.compared(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan

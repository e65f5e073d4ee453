import random
import re

import pyarrow as pa
import pytest

from edge import TEXTS, edge_docs
from vecframe.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, window=10):
    doc, hit, found = words(text), set(), set()
    for name, t in items:
        item = words(t)
        k = min(window, len(item))
        if not k:
            continue
        own = {tuple(item[q:q + k]) for q in range(len(item) - k + 1)}
        for p in range(len(doc) - k + 1):
            if tuple(doc[p:p + k]) in own:
                hit.update(range(p, p + k))
                found.add(name)
    return len(doc), len(hit), sorted(found)


def kernel(texts, items, window=10):
    tests = D.test_set(items, window)
    bound, position, which = D.search(pa.array(texts, pa.string()), tests)
    spans, found = D.marked(bound, position, which, tests)
    return [(int(bound[i + 1] - bound[i]), sum(spans.get(i, [])[1::2]) - sum(spans.get(i, [])[::2]), found.get(i, [])) for i in range(len(texts))]


def case(rnd):
    alphabet = ["a", "b", "C", "é", "x1", "zz"][:rnd.randint(2, 6)]
    text = lambda n: rnd.choice([" ", ", ", "\n"]).join(rnd.choice(alphabet) for _ in range(n))
    items = [(str(i), text(rnd.choice([0, 1, 2, 3, 5, 9, 10, 12, 20]))) for i in range(rnd.randint(0, 5))] + [("n", None)]
    if rnd.random() < 0.5:
        items = [x for x in items if x[1] is None or len(words(x[1])) >= 10]
    return [rnd.choice([None, "", text(rnd.randint(0, 60)), text(3) + " Q " + text(30)]) for _ in range(6)], items


def test_search_matches_brute_force():
    rnd = random.Random(2)
    for _ in range(300):
        texts, items = case(rnd)
        for window in (10, 3):
            assert kernel(texts, items, window) == [brute(t, items, window) for t in texts]


def test_longest_matches(spark):
    docs = spark.createDataFrame([(1, "x " + " ".join(f"w{i}" for i in range(30)) + " y"), (2, "nothing here")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "q " + " ".join(f"w{i}" for i in range(4, 22)))], "item_id long, text string")
    assert [tuple(r) for r in D.matches(docs, items).collect()] == [(1, "7", 5, 1, 18)]


def test_blocks_of_the_benchmark_give_the_same(spark):
    rnd = random.Random(9)
    texts, items = case(rnd)
    while len(items) < 5:
        texts, items = case(rnd)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    rows = {}
    for size in (1, 1 << 20):
        rows[size] = sorted(tuple(r) for r in D.find(docs, bench, block_bytes=size).collect())
        kept = {r.doc_id for r in D.remove(docs, bench, block_bytes=size).collect()}
        assert kept == {i for i, t in enumerate(texts) if not brute(t, items)[1]}
    assert rows[1] == rows[1 << 20]


def test_edge_table(spark):
    docs = edge_docs(spark)
    items = [("1", "brown fox jumps over the lazy dog again and again"), ("2", "É"), (None, "idiot and"), ("3", ""), ("3", "text without an"), ("4", None)]
    bench = spark.createDataFrame(items, "item_id string, text string")
    named = [(i or "", t) for i, t in items]
    got = sorted(((r.doc_id, r.n_words, sum(r.spans[1::2]) - sum(r.spans[::2]), list(r["items"])) for r in D.find(docs, bench).collect()), key=repr)
    assert got == sorted(((i, *brute(t, named)) for i, t in TEXTS), key=repr)
    kept = D.remove(docs, bench)
    assert kept.columns == docs.columns and kept.count() == sum(not brute(t, named)[1] for _, t in TEXTS)


@pytest.mark.parametrize("empty_docs", [True, False])
def test_empty_tables(spark, empty_docs):
    docs = edge_docs(spark, [] if empty_docs else None)
    bench = spark.createDataFrame([], "item_id long, text string")
    rows = D.find(docs, bench).collect()
    assert all(not r.spans for r in rows) and len(rows) == docs.count() == D.remove(docs, bench).count()
    assert D.matches(docs, bench).count() == 0

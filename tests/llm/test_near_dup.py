import re

import numpy as np
import pandas as pd
import pytest
import xxhash

from edge import TEXTS, edge_docs
from vecframe.llm import near_dup as N


def fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints):
    """id -> least id reachable over links of two bits, by all pairs."""
    ids = sorted(prints)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_groups_match_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    prints = {r.doc_id: fingerprint(r.text) for r in docs.collect()}
    want = components(prints)
    for hot in (128, 2):
        got = N.groups(docs, hot_bucket=hot).collect()
        assert {r.doc_id: r.fp % (1 << 64) for r in got} == prints
        assert {r.doc_id: r.component_id for r in got} == want


@pytest.mark.parametrize("hot, finish", [(1000, 1 << 20), (3, 1 << 20), (1000, 0)])
def test_chains_of_fingerprints(spark, hot, finish):
    """Long chains of one-bit steps and dense clusters, through pairs and through points."""
    r = np.random.default_rng(0)
    prints = set()
    for base in r.integers(0, 2**63, 6):
        x = int(base)
        for _ in range(40):
            prints.add(x)
            x ^= 1 << int(r.integers(0, 64))
    dense = int(r.integers(0, 2**62))
    prints |= {dense ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(12)}
    prints = sorted(prints)
    nodes = spark.createDataFrame(pd.DataFrame({"fp": np.array(prints, np.uint64).view(np.int64)}))
    groups = {}
    for row in N.components(N.close_links(nodes, 2, hot), finish_links=finish).collect():
        groups.setdefault(row.root, {row.root % (1 << 64)}).add(row.node % (1 << 64))
    want = {}
    for p, root in components({p: p for p in prints}).items():
        want.setdefault(root, set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


def test_contract_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(N, "HELD_LINKS", 10)
    edges = spark.range(0, 400).selectExpr("id a", "(id * 7 + 3) % 50 + id div 100 * 100 b")
    whole = {r.node: r.root for r in N.components(edges).collect()}
    monkeypatch.setattr(N, "HELD_LINKS", 1 << 20)
    assert whole == {r.node: r.root for r in N.components(edges).collect()}


def test_edge_table(spark):
    docs = edge_docs(spark)
    rows = N.groups(docs).collect()
    assert sorted(((r.doc_id, r.fp % (1 << 64)) for r in rows), key=repr) == sorted(((i, fingerprint(t)) for i, t in TEXTS), key=repr)
    of = {(r.doc_id, r.fp): r.component_id for r in rows}
    assert all(c == 2 for (i, fp), c in of.items() if fp == 0)  # null, empty and blank texts, and the row without an id
    assert {c for (i, _), c in of.items() if i == 5} == {1}
    kept = N.keep_one(docs).collect()
    assert N.keep_one(docs).columns == docs.columns
    assert sorted((r.doc_id for r in kept), key=repr) == sorted([1, 2, 6, 7, 8, 9, 10, None, None], key=repr)


def test_repeated_ids_with_other_texts(spark):
    """Every group keeps one row, whatever other rows its id has."""
    a, b, c = ("the first text is about rivers and hills", "another one counts ships in a far harbour", "a third tells of bread and of salt")
    near = [(5, a), (7, a), (5, b), (3, b)]
    keep = lambda rows, **how: sorted((r.doc_id, r.text) for r in N.keep_one(edge_docs(spark, rows), **how).collect())
    assert keep(near) == keep(near, one_per_id=False) == [(3, b), (5, a)]
    versions = [(10, a), (10, b), (12, b), (12, c), (12, c), (10, a), (14, c)]
    assert keep(versions, one_per_id=False) == sorted([(10, a), (10, b), (12, c)])
    assert [i for i, _ in keep(versions)] == [10, 12]


def test_stage_keeps_texts_of_a_repeated_id(spark):
    from corpus_pipeline import one_of_each_group
    docs = edge_docs(spark)
    kept = one_of_each_group(spark, docs, None)
    assert kept.columns == docs.columns
    assert sorted(r.text for r in kept.where("doc_id = 10").collect()) == ["same id, another text", "same id, one text"]


def test_empty_table(spark):
    empty = edge_docs(spark, [])
    assert N.groups(empty).collect() == [] and N.keep_one(empty).collect() == []

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from edge import LONG, TEXTS, edge_docs
from vecframe.llm import importance as I
from vecframe.llm.common import read_table
from vecframe.llm.queries import QUERIES


def words_of(text):
    folded = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)


def buckets_of(text, runs=1, size=I.BUCKETS):
    w = words_of(text)
    return [zlib.crc32(" ".join(w[i:i + n]).encode()) % size for n in range(1, runs + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, runs=1, size=I.BUCKETS, seed=2024, least=20, percent=10):
    """Rows ``(id, n_features, weight, score, rank)`` as the definition says it, with equal rows in any order."""
    s, t = (Counter(b for x in texts for b in buckets_of(x, runs, size)) for texts in ([x for _, x in docs], target))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s_all + size) / ((s[b] + 1) * (t_all + size)))) for b in range(size)}
    rows = []
    for i, x in docs:
        b = buckets_of(x, runs, size)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[k] for k in b)
        rows.append([i, len(b), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words_of(x))])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for n, r in enumerate(able[:percent * len(able) // 100], 1):
        r[4] = n
    return Counter(tuple(r[:5]) for r in rows)


def got(df):
    return Counter(tuple(r) for r in df.collect())


def test_query_is_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in read_table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()]
    target = [r.text for r in read_table(spark, "/root/testdata/sf0.001", "benchmark").select("text").collect()]
    rows = QUERIES["op12_importance"](spark, "/root/testdata/sf0.001")
    assert rows.dtypes == [("doc_id", "bigint"), ("n_features", "bigint"), ("weight", "bigint"), ("score", "bigint"), ("rank", "bigint")]
    assert got(rows) == brute(docs, target)


@pytest.mark.parametrize("runs,size,percent", [(1, 10_000, 100), (3, 97, 50), (2, 1, 10)])
def test_edge_table(spark, runs, size, percent):
    target = ["quick lazy dog", None, "", "word5 ab5 and again"]
    rows = I.resample(edge_docs(spark), spark.createDataFrame([(x,) for x in target], "text string"), runs=runs, buckets=size, least_words=3, percent=percent)
    assert got(rows) == brute(TEXTS, target, runs, size, least=3, percent=percent)


def test_empty_tables(spark):
    empty, target = edge_docs(spark, []), spark.createDataFrame([], "text string")
    assert I.resample(empty, target).collect() == []
    assert got(I.resample(edge_docs(spark), target, least_words=1, percent=30)) == brute(TEXTS, [], least=1, percent=30)
    assert all(r.rank is None for r in I.resample(edge_docs(spark), target, percent=0).collect())


def test_crc_of_any_words():
    r = np.random.default_rng(0)
    data = r.integers(0, 256, 5000).astype(np.uint8)
    first = r.integers(0, 4000, 300)
    end = first + np.concatenate((r.integers(0, 40, 290), r.integers(40, 900, 10)))
    state = r.integers(0, 2 ** 32, 300, dtype=np.uint64).astype(np.uint32)
    assert I.crc_on(state, data, first, end).tolist() == [zlib.crc32(data[a:b].tobytes(), int(s)) for s, a, b in zip(state, first, end)]


@pytest.mark.parametrize("runs", [1, 2, 4])
def test_features_of_a_batch(runs):
    texts = ["One two, TWO! three4x", "", None, "é %%% ÉÀ日本語 x", "word", LONG, "[a]{b}\x7fc\x00d"]
    bucket, text, words = I.features(pa.array(texts), runs, 10_000)
    for i, t in enumerate(texts):
        assert Counter(bucket[text == i].tolist()) == Counter(buckets_of(t, runs)) and words[i] == len(words_of(t))


def keys_table(spark, rows, parts):
    return spark.createDataFrame(rows, ", ".join(f"{k} long" for k in I.KEY)).repartition(parts)


@pytest.mark.parametrize("parts", [1, 7])
def test_selection_is_exact(spark, parts):
    r = np.random.default_rng(parts)
    # many ties in the leading parts of the key, and one value that a third of the rows have
    rows = [(int(-5 if i % 3 == 0 else r.integers(-8, 8)), 0, int(r.integers(0, 4)), int(r.integers(0, 3)), i) for i in range(600)]
    df = keys_table(spark, rows, parts).cache()
    for k in (1, 200, 333, 600):
        assert I.nth_key(df, k, last=40) == sorted(rows)[k - 1]
    assert I.nth_key(df, 601) is None and I.nth_key(df, 0) is None and I.nth_key(df.limit(0), 1) is None


def test_each_round_discards_a_quarter(spark):
    """The pivot has at least a quarter of all keys on either side (itself counted on both)."""
    r = np.random.default_rng(5)
    rows = [(int(x), 0, 0, 0, i) for i, x in enumerate(r.normal(0, 1e6, 2000))]
    df = keys_table(spark, rows, 9).cache()
    medians = I.side_medians(df, None)[1]
    assert sum(n for n, _ in medians) == 2000
    pivot = I.weighted_median(medians)
    upto = df.where(I.before(pivot, or_equal=True)).count()
    assert 500 <= upto and 2001 - upto >= 500


def test_equal_rows_share_the_ranks(spark):
    """A third of all rows equal, at the cutoff: as many are drawn as there is room for."""
    text = " ".join(f"w{i}" for i in range(30))
    docs = [(7, text)] * 40 + [(100 + i, f"{text} more{i}") for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    target = [text]
    rows = I.resample(df, spark.createDataFrame([(x,) for x in target], "text string"), percent=25)
    assert got(rows) == brute(docs, target, percent=25)
    assert sorted(r.rank for r in rows.where("rank is not null").collect()) == list(range(1, 26))


def test_noise_is_gumbel(spark):
    x = np.array([r[0] for r in spark.range(20_000).select(I.noise(F.col("id"), 3)).collect()]) / 1000
    assert abs(x.mean() - 0.5772) < 0.03 and abs(x.std() - np.pi / 6 ** 0.5) < 0.03

"""Target-distribution importance resampling (operator 12).

Features are all runs of 1 to ``runs`` consecutive words; a feature's bucket is its CRC-32 modulo ``buckets``.  The corpus
and the target texts are counted by bucket, a bucket's gain is the log ratio of the two in thousandths, and a document
weighs the sum of its features' gains (an array look-up).  Weight plus Gumbel noise of the id is the score; the highest
scores among the eligible documents are drawn.

The cutoff is found by weighted median-of-medians selection over the written keys: every partition gives the median of
its remaining keys and how many remain; the median of those medians, weighted by these sizes, has at least a quarter of
the remaining keys on either side, so each round discards a guaranteed share, until the exact cutoff key is met.  Only
the winners are sorted: ranges over the key, a sort inside each, and the sizes of the ranges before it.

Defined results: a null or empty text has no features and weight 0; a null id hashes as the seed alone and loses ties;
documents that tie in score and id are ordered by their features, and equal rows have ranks one after the other; with
no target texts every gain follows from ``t = T = 0``; an empty table gives no rows; other columns are not read.  A very
long text is one kernel call whose arrays are some forty times as long as its bytes.
"""

from __future__ import annotations

import math
import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecframe.llm.common import files_for, long_lists, map_text, text_buffer, text_slices, written

BUCKETS = 10_000
#: Runs of up to so many words are features.
RUNS = 1
SEED = 2024
#: Documents of fewer words are never drawn.
LEAST_WORDS = 20
#: Of the eligible documents, so many in a hundred are drawn.
PERCENT = 10

FOLD = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
WORD = np.array([c >= 128 or chr(c).isdigit() or 97 <= c <= 122 for c in range(256)])

#: Longer words are summed one by one (by zlib); shorter ones a byte of all words at a time.
SHORT = 32


def crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


CRC = crc_table()


def crc_on(state: np.ndarray, data: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of what ``state`` is the CRC-32 of, each followed by ``data[first:end]``."""
    out = ~state.astype(np.uint32)
    length = end - first
    short = np.flatnonzero(length <= SHORT)
    order = short[np.argsort(-length[short], kind="stable")]
    begin, run, left = first[order], out[order], length[order]
    for i in range(int(left[0]) if len(left) else 0):
        n = int(np.searchsorted(-left, -i, side="left"))  # words of more than i bytes come first
        run[:n] = CRC[(run[:n] ^ data[begin[:n] + i]) & 255] ^ (run[:n] >> 8)
    out[order] = run
    for j in np.flatnonzero(length > SHORT).tolist():
        out[j] = ~np.uint32(zlib.crc32(data[first[j]:end[j]].tobytes(), int(state[j])))
    return ~out


def features(column: pa.Array, runs: int = RUNS, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(bucket, text)`` of every feature, and the number of words of every text."""
    raw, at = text_buffer(column)
    if not raw:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(column), np.int64)
    data = FOLD[np.frombuffer(raw, np.uint8)]
    solid = WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    edge[1:-1] |= solid[1:] != solid[:-1]
    first = np.flatnonzero(solid & edge[:-1])
    end = np.flatnonzero(solid & edge[1:]) + 1
    bound = np.searchsorted(first, at)
    words = np.diff(bound)
    text = np.repeat(np.arange(len(column)), words)
    left = bound[1:][text] - np.arange(len(first))  # words from here to the end of the text
    here, state = np.arange(len(first)), np.zeros(len(first), np.uint32)
    out, of = [], []
    blank = np.array([32], np.uint8)
    for n in range(runs):
        if n:  # a run of n + 1 words is the run of n words, a space and one more word
            more = left[here] > n
            here, state = here[more], state[more]
            zero = np.zeros(len(here), np.int64)
            state = crc_on(state, blank, zero, zero + 1)
        state = crc_on(state, data, first[here + n], end[here + n])
        out.append(state.astype(np.int64) % buckets)
        of.append(text[here])
    return np.concatenate(out), np.concatenate(of), words


def counted(docs: DataFrame, text_col: str = "text", runs: int = RUNS, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over all rows: counted per task, then summed by bucket (a row a bucket reaches the driver)."""
    def run(batches):
        total = np.zeros(buckets, np.int64)
        with long_lists():
            for batch in batches:
                for part in text_slices(batch, 0):
                    total += np.bincount(features(part.column(0), runs, buckets)[0], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], ["bucket", "n"])

    rows = docs.select(text_col).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r[0]] = r[1]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A bucket's log ratio of target to corpus, each with one count more a bucket, in thousandths, rounded down."""
    s_all, t_all, b = int(corpus.sum()), int(target.sum()), len(corpus)
    return np.array([math.floor(1000 * math.log(float(t + 1) * float(s_all + b) / (float(s + 1) * float(t_all + b))))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from the id's SHA-256."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def scores(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", runs: int = RUNS, seed: int = SEED) -> DataFrame:
    """``(id, n_words, n_features, weight, score)`` of every row, all long."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def kernel(part):
        table = shared.value
        bucket, text, words = features(part.column(1), runs, len(table))
        n = part.num_rows
        total = np.zeros(n + 1, np.int64)
        order = np.argsort(text, kind="stable") if runs > 1 else slice(None)
        np.cumsum(np.bincount(text, minlength=n), out=total[1:])
        sums = np.concatenate(([0], np.cumsum(table[bucket][order])))
        return part.column(0), words, np.diff(total), np.diff(sums[total])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = map_text(docs, [id_col, text_col], kernel, f"`{id_col}` {kind}, n_words long, n_features long, weight long")
    return rows.withColumn("score", F.col("weight") + noise(F.col(id_col), seed))


#: The parts of a key, ascending: a better score, then a smaller id (null last), then fewer features, then the row.
KEY = ["k0", "k1", "k2", "k3", "k4"]


def keyed(scored: DataFrame, id_col: str) -> DataFrame:
    """``scored`` with a key of longs that no two rows share; it must be written before it is used."""
    return scored.select("*", (-F.col("score")).alias("k0"), F.col(id_col).isNull().cast("long").alias("k1"),
                         F.coalesce(F.col(id_col).cast("long"), F.lit(0).cast("long")).alias("k2"), F.col("n_features").alias("k3"),
                         F.monotonically_increasing_id().alias("k4"))


def before(key: tuple, or_equal: bool = False) -> Column:
    """Whether a row's key is less than ``key``; the first part by itself goes to the scan."""
    less = reduce(lambda rest, part: (F.col(part[0]) < part[1]) | ((F.col(part[0]) == part[1]) & rest),
                  list(zip(KEY, key))[::-1], F.lit(or_equal))
    return (F.col(KEY[0]) <= key[0]) & less


def side_medians(keys: DataFrame, pivot: tuple | None) -> list[list[tuple[int, tuple]]]:
    """Of every partition how many keys lie before the pivot and after it, and the (lower) median of either side:
    two lists of ``(n, median)``.  Without a pivot all keys lie after it."""
    def run(batches):
        columns = [[] for _ in KEY]
        for batch in batches:
            for c, x in zip(columns, batch.columns):
                c.append(x.to_numpy(zero_copy_only=False))
        parts = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in columns]
        less, same = np.zeros(len(parts[0]), bool), np.ones(len(parts[0]), bool)
        if pivot is None:
            same[:] = False
        else:
            for p, at in zip(parts, pivot):
                less |= same & (p < at)
                same &= p == at
        for side, chosen in enumerate((less, ~less & ~same)):
            rows = [p[chosen] for p in parts]
            n = len(rows[0])
            if n:
                # only the rows whose first part is the median's have to be ordered by the other parts
                middle = (n - 1) // 2
                value = np.partition(rows[0], middle)[middle]
                tied = np.flatnonzero(rows[0] == value)
                at = tied[np.lexsort([p[tied] for p in rows[::-1]])[middle - int((rows[0] < value).sum())]]
                yield pa.RecordBatch.from_arrays([pa.array([side], pa.int32()), pa.array([n], pa.int64()), *(pa.array([p[at]], pa.int64()) for p in rows)],
                                                 ["side", "n", *KEY])

    rows = keys.select(*KEY).mapInArrow(run, "side int, n long, " + ", ".join(f"{k} long" for k in KEY)).collect()  # two rows a partition at most
    return [[(r.n, tuple(r[2:])) for r in rows if r.side == side] for side in (0, 1)]


def weighted_median(medians: list[tuple[int, tuple]]) -> tuple:
    half, seen = sum(n for n, _ in medians) / 2, 0
    for n, key in sorted(medians, key=lambda x: x[1]):
        seen += n
        if seen >= half:
            return key
    raise ValueError("no medians")


#: So few remaining keys are sorted.
LAST_KEYS = 4096


def nth_key(keys: DataFrame, k: int, last: int = LAST_KEYS) -> tuple | None:
    """The exact ``k``-th smallest key, from 1; None if there are fewer.  No two keys are equal.

    At least half of the remaining keys lie in partitions whose medians are not after the pivot, and half of each of those
    are not after it; likewise the other way.  So a round keeps three quarters of the keys at most."""
    if k < 1:
        return None
    _, medians = side_medians(keys, None)
    stored = left = sum(n for n, _ in medians)  # stored: keys when the remaining ones were last written
    if left < k:
        return None
    while left > last:
        pivot = weighted_median(medians)
        low, high = side_medians(keys, pivot)
        n = sum(x for x, _ in low)
        if k == n + 1:
            return pivot
        if k <= n:
            keys, medians, left = keys.where(before(pivot)), low, n
        else:
            keys, medians, left, k = keys.where(~before(pivot, or_equal=True)), high, left - n - 1, k - n - 1
        if last < left < stored / 8:  # later rounds need not read what is discarded
            keys, stored = written(keys.select(*KEY), "keys", files_for(left)), left
    return tuple(keys.select(*KEY).orderBy(*KEY).limit(k).collect()[-1])


def ranked(winners: DataFrame, files: int) -> DataFrame:
    """``winners`` with ``rank``, from 1 by key: sorted in ranges; a range's first rank follows from the sizes of those before."""
    inside = winners.repartitionByRange(*KEY).sortWithinPartitions(*KEY)
    kept = inside.schema

    def number(batches):
        n = 0
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        for batch in batches:
            yield (batch.append_column("part", pa.array(np.full(batch.num_rows, part), pa.int32()))
                   .append_column("place", pa.array(np.arange(n + 1, n + batch.num_rows + 1), pa.int64())))
            n += batch.num_rows

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    placed = written(inside.mapInArrow(number, f"{fields}, part int, place long"), "winners", files)
    sizes = sorted((r[0], r[1]) for r in placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect())  # one row a range
    starts, total = [], 0
    for part, n in sizes:
        starts.append((part, total))
        total += n
    first = winners.sparkSession.createDataFrame(starts, "part int, first long")
    return placed.join(F.broadcast(first), "part").withColumn("rank", F.col("first") + F.col("place")).drop("part", "place", "first")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
             runs: int = RUNS, buckets: int = BUCKETS, seed: int = SEED, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """``(id, n_features, weight, score, rank)`` of every row; the rank of a row that is not drawn is null."""
    gain = gains(counted(docs, text_col, runs, buckets), counted(target, target_col, runs, buckets))
    n = docs.count()
    rows = written(keyed(scores(docs, gain, id_col, text_col, runs, seed), id_col), "scores", files_for(n), dealt=True)
    able = F.col("n_words") >= least_words
    k = percent * rows.where(able).count() // 100
    last = nth_key(rows.where(able).select(*KEY), k)
    out = [id_col, "n_features", "weight", "score"]
    if last is None:
        return rows.select(*out, F.lit(None).cast("long").alias("rank"))
    won = able & before(last, or_equal=True)
    top = ranked(rows.where(won).select(*out, *KEY), files_for(k))
    return top.select(*out, "rank").unionByName(rows.where(~won).select(*out, F.lit(None).cast("long").alias("rank")))

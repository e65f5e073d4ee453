"""Benchmark decontamination with suffix arrays over the training texts (operator 8).

Each task cuts its texts into shards and builds a suffix array of every shard: the word positions sorted by the words
that follow.  A suffix is compared to ``window`` words, the depth to which windows reach, and suffixes that begin with
fewer benchmark words in a row than the shortest window are left out before sorting, since no test suffix can match them.
Every test suffix is then found by binary search in every shard; the hits give the windows' locations, and hits on one
diagonal join into the longest verbatim matches (``matches``).

The benchmark is the query set: it is read in blocks of ``BLOCK_BYTES`` of text, chosen by a hash of the item, and each
block is broadcast by itself; all blocks are searched, one after the other, against all texts.

Defined results: null and empty texts have no words and no hits; an item of fewer words than a window is one window, an
item without words none; repeated documents are judged row by row; repeated item ids count as one item, a null item id
counts as the empty string; a null document id is kept; an empty benchmark leaves every document clean; an empty table
gives no rows; other columns are not read, and ``remove`` returns them as they are.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecframe.llm.common import filter_text, map_text, text_buffer, token_runs

#: Words of a window.
WINDOW = 10
#: Benchmark text (bytes) that is broadcast at a time.
BLOCK_BYTES = 32 << 20

# Words are runs of 0-9, a-z and everything beyond ASCII, after A-Z are lower-cased; other bytes separate them.
WORD_BYTE = np.array([c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 0 for c in range(256)], np.uint8)
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

def split_words(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode().translate(LOWER))


def hash_words(raw: bytes, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(hash, first byte, end, first word of each text and the end)`` of all words of texts laid end to end."""
    data = WORD_BYTE[np.frombuffer(raw, np.uint8)]
    return token_runs(data, data != 0, at)


@dataclass
class TestSet:
    """A block of the benchmark: its vocabulary by hash, its windows as sortable keys, and the items of each window."""

    words: list[bytes]          # by rank of hash; id = rank + 1
    hashes: np.ndarray
    keys: np.ndarray            # distinct windows: ``window`` big-endian ids, zero-filled
    lengths: np.ndarray         # words of each window
    item_from: np.ndarray       # window w has item_at[item_from[w]:item_from[w + 1]]
    item_at: np.ndarray
    place_at: np.ndarray        # word position of the window in the item
    items: list[str]
    window: int

    @property
    def least(self) -> int:
        return int(self.lengths.min()) if len(self.lengths) else 0


def test_set(rows: list[tuple[str, str | None]], window: int = WINDOW) -> TestSet:
    """Index of benchmark rows ``(item id, text)``."""
    texts = [(name, split_words(text)) for name, text in rows]
    vocabulary = sorted({w for _, words in texts for w in words})
    raw = b"".join(vocabulary)
    at = np.concatenate(([0], np.cumsum([len(w) for w in vocabulary], dtype=np.int64))) if vocabulary else np.zeros(1, np.int64)
    hashes = hash_words(raw, at)[0] if vocabulary else np.zeros(0, np.uint64)
    order = np.argsort(hashes, kind="stable")
    if len(np.unique(hashes)) < len(hashes):
        raise ValueError("two benchmark words share a hash")
    ids = {vocabulary[i]: r + 1 for r, i in enumerate(order.tolist())}
    names = sorted({name for name, _ in texts})
    place = {name: i for i, name in enumerate(names)}
    where: dict[tuple, list] = {}
    for name, words in texts:
        coded = [ids[w] for w in words]
        for q in range(max(1, len(coded) - window + 1) if coded else 0):
            where.setdefault(tuple(coded[q:q + window]), []).append((place[name], q))
    windows = list(where)
    matrix = np.zeros((len(windows), window), ">u4")
    for i, w in enumerate(windows):
        matrix[i, :len(w)] = w
    held = [where[w] for w in windows]
    return TestSet([vocabulary[i] for i in order.tolist()], hashes[order], matrix.view(f"S{4 * window}").ravel(),
                   np.array([len(w) for w in windows], np.int64), np.cumsum([0, *map(len, held)]),
                   np.array([i for h in held for i, _ in h], np.int64), np.array([q for h in held for _, q in h], np.int64), names, window)


def search(column: pa.Array, tests: TestSet):
    """Hits of the windows in a shard of texts: ``(words of each text as offsets, word position, window)`` arrays."""
    raw, at = text_buffer(column)
    none = np.zeros(0, np.int64)
    if not raw:
        return np.zeros(len(column) + 1, np.int64), none, none
    hashed, first, end, bound = hash_words(raw, at)
    if not len(tests.keys) or not len(hashed):
        return bound, none, none
    rank = np.searchsorted(tests.hashes, hashed)
    rank[rank == len(tests.hashes)] = 0
    known = tests.hashes[rank] == hashed
    # words from each position to where the run of benchmark words, or the text, ends
    n = len(hashed)
    stop = np.flatnonzero(~known)
    cut = np.unique(np.concatenate((stop, bound[1:], [n])))
    ahead = cut[np.searchsorted(cut, np.arange(n), "left")] - np.arange(n)
    ahead[bound[:-1][bound[:-1] < n]] = 0  # a text's first word is itself in ``cut``
    heads = bound[:-1][np.diff(bound) > 0]
    after = np.append(cut, n)
    ahead[heads] = np.where(known[heads], after[np.minimum(np.searchsorted(cut, heads, "right"), len(cut))] - heads, 0)
    suffix = np.flatnonzero(known & (ahead >= tests.least))
    if not len(suffix):
        return bound, none, none
    reach = np.minimum(ahead[suffix], tests.window)
    # equal hashes are held against the words themselves before they count
    used = np.zeros(n + 1, np.int64)
    np.add.at(used, suffix, 1)
    np.add.at(used, suffix + reach, -1)
    low = raw.translate(LOWER)
    wrong = [i for i, r in ((i, rank[i]) for i in np.flatnonzero(np.cumsum(used[:-1])).tolist()) if low[first[i]:end[i]] != tests.words[r]]
    if wrong:
        bad = np.array(wrong)
        gap = bad[np.minimum(np.searchsorted(bad, suffix), len(bad) - 1)] - suffix
        reach = np.where(gap >= 0, np.minimum(reach, gap), reach)
        suffix, reach = suffix[reach >= tests.least], reach[reach >= tests.least]
    matrix = np.zeros((len(suffix), tests.window), ">u4")
    padded = np.concatenate((rank + 1, np.zeros(tests.window, np.int64)))
    for k in range(tests.window):
        matrix[:, k] = np.where(reach > k, padded[suffix + k], 0)
    keys = matrix.view(f"S{4 * tests.window}").ravel()
    order = np.argsort(keys, kind="stable")  # the suffix array
    keys = keys[order]
    low_at = np.searchsorted(keys, tests.keys, "left")
    high_at = np.searchsorted(keys, tests.keys, "right")
    short = np.flatnonzero(tests.lengths < tests.window)
    if len(short):  # a short window is a prefix of suffixes: up to the last key that begins with it
        ceiling = tests.keys[short].astype(f"S{4 * tests.window}").view(np.uint8).reshape(len(short), -1).copy()
        ceiling[np.arange(4 * tests.window) >= 4 * tests.lengths[short, None]] = 255
        high_at[short] = np.searchsorted(keys, ceiling.view(f"S{4 * tests.window}").ravel(), "right")
    count = high_at - low_at
    window = np.repeat(np.arange(len(count)), count)
    inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return bound, suffix[order[low_at[window] + inside]], window


def marked(bound: np.ndarray, position: np.ndarray, window: np.ndarray, tests: TestSet):
    """For each text: hit spans as a flat list of word positions, and its items' ids."""
    n = int(bound[-1])
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, position, 1)
    np.add.at(cover, position + tests.lengths[window], -1)
    hit = np.concatenate(([0], (np.cumsum(cover[:-1]) > 0).astype(np.int8), [0]))
    text = np.searchsorted(bound, position, "right") - 1
    pair = np.unique(text * max(1, len(tests.lengths)) + window)
    of, window = pair // max(1, len(tests.lengths)), pair % max(1, len(tests.lengths))
    spans: dict[int, list[int]] = {}
    items: dict[int, list[str]] = {}
    for t in np.unique(of).tolist():
        a, b = int(bound[t]), int(bound[t + 1])
        own = np.concatenate(([0], hit[a + 1:b + 1], [0]))
        spans[t] = np.flatnonzero(np.diff(own)).tolist()  # starts and ends by turns
        found = window[np.searchsorted(of, t):np.searchsorted(of, t, "right")]
        items[t] = sorted({tests.items[i] for w in found.tolist() for i in tests.item_at[tests.item_from[w]:tests.item_from[w + 1]].tolist()})
    return spans, items


def merged(spans: list[int], more: list[int]) -> list[int]:
    out: list[int] = []
    for a, b in sorted([*zip(spans[::2], spans[1::2]), *zip(more[::2], more[1::2])]):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def benchmark_blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, block_bytes: int) -> list:
    """The benchmark as broadcast blocks of about ``block_bytes`` of text each."""
    sc = benchmark.sparkSession.sparkContext
    rows = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 + total // block_bytes
    of = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    return [sc.broadcast(test_set([tuple(r) for r in rows.where(of == i).collect()], window)) for i in range(n)]


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", benchmark_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(id, n_words long, spans array<int>, items array<string>)`` of every row: hit words as spans (start and end by
    turns, in words), and the ids of items with a window in the text, sorted."""
    kind = docs.schema[id_col].dataType.simpleString()
    blocks = benchmark_blocks(benchmark, item_col, benchmark_text, window, block_bytes)
    rows = docs.select(F.col(id_col).alias("id"), F.lit(None).cast("array<int>").alias("spans"), F.lit(None).cast("array<string>").alias("items"),
                       F.col(text_col).alias("text"))
    for i, block in enumerate(blocks):
        last = i == len(blocks) - 1

        def kernel(batch, block=block, last=last):
            tests = block.value
            bound, position, which = search(batch.column(3), tests)
            spans, items = marked(bound, position, which, tests)
            if len(blocks) > 1:
                for t, (had, names) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                    if had:
                        spans[t] = merged(had, spans.get(t, []))
                        items[t] = sorted({*names, *items.get(t, [])})
            n = batch.num_rows
            out = [batch.column(0), [spans.get(t, []) for t in range(n)], [items.get(t, []) for t in range(n)]]
            return [out[0], np.diff(bound), *out[1:]] if last else [*out, batch.column(3)]

        schema = f"id {kind}, n_words long, spans array<int>, items array<string>" if last else f"id {kind}, spans array<int>, items array<string>, text string"
        rows = map_text(rows, ["id", "spans", "items", "text"], kernel, schema)
    return rows.withColumnRenamed("id", id_col)


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
            item_col: str = "item_id", benchmark_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(id, item, doc_word long, item_word long, n_words long)``: the longest verbatim matches of a window or more, with their places."""
    kind = docs.schema[id_col].dataType.simpleString()
    out = None
    for block in benchmark_blocks(benchmark, item_col, benchmark_text, window, block_bytes):
        def kernel(batch, block=block):
            tests = block.value
            bound, position, which = search(batch.column(1), tests)
            count = np.diff(tests.item_from)[which]
            flat = np.repeat(tests.item_from[which], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            p, size = np.repeat(position, count), np.repeat(tests.lengths[which], count)
            item, q = tests.item_at[flat], tests.place_at[flat]
            text = np.searchsorted(bound, p, "right") - 1
            order = np.lexsort((p, p - q, item, text))
            text, item, p, q, size = (x[order] for x in (text, item, p, q, size))
            fresh = np.ones(len(p), bool)
            fresh[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (p[1:] != p[:-1] + 1) | (q[1:] != q[:-1] + 1)
            first = np.flatnonzero(fresh)
            final = np.append(first[1:], len(p)) - 1 if len(first) else first
            names = batch.column(0).take(pa.array(text[first], pa.int64()))
            return [names, [tests.items[i] for i in item[first].tolist()], p[first] - bound[text[first]], q[first], p[final] + size[final] - p[first]]

        part = map_text(docs, [id_col, text_col], kernel, f"`{id_col}` {kind}, item string, doc_word long, item_word long, n_words long")
        out = part if out is None else out.unionByName(part)
    return out


def remove(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text", item_col: str = "item_id",
           benchmark_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the rows that have a benchmark window."""
    for block in benchmark_blocks(benchmark, item_col, benchmark_text, window, block_bytes):
        def decide(batch, at, block=block):
            bound, position, _ = search(batch.column(at), block.value)
            clean = np.ones(batch.num_rows, bool)
            clean[np.searchsorted(bound, position, "right") - 1] = False
            return clean

        docs = filter_text(docs, text_col, decide)
    return docs

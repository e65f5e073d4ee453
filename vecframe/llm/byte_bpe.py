"""Byte-level BPE encoding and decoding (operator 9).

Pre-tokenisation runs on whole batches of texts as code-point arrays.  Every code point gets a class; the splitting
automaton has five states, and each class is a function from state to state.  Those functions form a small monoid, so
an associative scan over table look-ups gives the state before every code point, and token starts follow from state
and neighbouring classes - no regular expression is run.  The slices are encoded by pair merging behind a bounded
cache; their offsets into the text stay with the ids.

Defined results: a null or empty text has no tokens (and decodes to nothing); repeated rows and equal ids are encoded
one by one; null ids are kept as they are; other columns are not read; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vecframe.llm.common import map_text, text_buffer

#: Pieces that a worker's cache holds before it starts afresh.
CACHE_PIECES = 150_000

# Classes of code points.  Fixed values: the pattern's letters \p{L}, numbers \p{N}, the space, other white space \s.
LETTER, NUMBER, SPACE, WHITE, OTHER, SHORT, LONG = range(7)
WHITE_SPACE = "\t\n\x0b\x0c\r\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
# The pattern's contractions by length.
SHORT_ENDINGS, LONG_ENDINGS = ("s", "t", "m", "d"), ("re", "ve", "ll")

# States: an apostrophe here may start a contraction; here it joins; two or one letters of a contraction to come; one just ended.
OPEN, JOINS, TWO_LEFT, ONE_LEFT, ENDED = range(5)


@functools.cache
def class_table() -> np.ndarray:
    """Class of every code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    for cp in range(0x110000):
        kind = unicodedata.category(chr(cp))[0]
        if kind == "L":
            table[cp] = LETTER
        elif kind == "N":
            table[cp] = NUMBER
    for c in WHITE_SPACE:
        table[ord(c)] = WHITE
    table[ord(" ")] = SPACE
    return table


def step(state: int, kind: int) -> int:
    """The automaton: state after a code point of this class."""
    if kind in (LETTER, NUMBER):
        return {TWO_LEFT: ONE_LEFT, ONE_LEFT: ENDED}.get(state, OPEN)
    if kind == SPACE:
        return JOINS
    if kind == WHITE:
        return OPEN
    if kind in (SHORT, LONG) and state != JOINS:
        return ONE_LEFT if kind == SHORT else TWO_LEFT
    return JOINS


class TransitionMonoid:
    """All functions that sequences of classes induce on the states, with their composition as a table.

    Symbol ``k`` is class ``k``; symbol ``k + 8`` is class ``k`` as a text's first code point (it forgets the state)."""

    def __init__(self, classes: int = 7, states: int = 5):
        gens = {}
        for k in range(classes):
            gens[k] = tuple(step(s, k) for s in range(states))
            gens[k + 8] = (step(OPEN, k),) * states
        elements = [tuple(range(states))]
        known = {elements[0]: 0}
        for f in elements:  # grows while it is walked
            for g in gens.values():
                h = tuple(g[f[s]] for s in range(states))
                if h not in known:
                    known[h] = len(elements)
                    elements.append(h)
        self.size = len(elements)
        assert self.size <= 256
        self.symbol = np.zeros(16, np.uint8)
        for k, g in gens.items():
            self.symbol[k] = known[g]
        self.apply = np.array(elements, np.uint8)  # [function, state]
        self.then = np.array([[known[tuple(g[x] for x in f)] for g in elements] for f in elements], np.uint8)  # [f, g]: f, then g
        self.flat = np.zeros(self.size << 8, np.uint8)
        for f in range(self.size):
            self.flat[(f << 8):(f << 8) + self.size] = self.then[f]

    def compose(self, f: np.ndarray, g: np.ndarray) -> np.ndarray:
        return self.flat.take((f.astype(np.uint16) << 8) | g)

    def states_before(self, functions: np.ndarray, start: int = OPEN) -> np.ndarray:
        """State before every position, by a blocked scan over composed functions."""
        n = len(functions)
        if n <= 64:
            out, s = np.empty(n, np.uint8), start
            for i, f in enumerate(functions.tolist()):
                out[i] = s
                s = int(self.apply[f, s])
            return out
        length = max(8, min(256, int(n ** 0.5)))
        blocks = -(-n // length)
        padded = np.zeros(blocks * length, np.uint8)
        padded[:n] = functions
        columns = np.ascontiguousarray(padded.reshape(blocks, length).T)
        total = np.zeros(blocks, np.uint8)
        for row in columns:
            total = self.compose(total, row)
        state = self.states_before(total, start).astype(np.uint16)
        out = np.empty((length, blocks), np.uint8)
        act = self.apply.ravel()
        for t, row in enumerate(columns):
            out[t] = state
            state = act.take(row.astype(np.uint16) * 5 + state).astype(np.uint16)
        return np.ascontiguousarray(out.T).ravel()[:n]


@functools.cache
def monoid() -> TransitionMonoid:
    return TransitionMonoid()


def token_starts(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Positions where a token starts.  ``points``: code points of texts laid end to end; ``starts``: where the
    non-empty texts start."""
    n = len(points)
    if n == 0:
        return np.zeros(0, np.int64)
    kind = class_table()[points]
    ends = np.append(starts[1:], n)
    quote = np.flatnonzero(points == 39)
    if len(quote):
        room = ends[np.searchsorted(starts, quote, "right") - 1] - quote - 1  # code points that follow in the text
        one = np.where(room >= 1, points[np.minimum(quote + 1, n - 1)], 0)
        two = np.where(room >= 2, points[np.minimum(quote + 2, n - 1)], 0)
        kind[quote[np.isin(one, [ord(c) for c in SHORT_ENDINGS])]] = SHORT
        pair = (one.astype(np.int64) << 32) | two
        kind[quote[np.isin(pair, [ord(c[0]) << 32 | ord(c[1]) for c in LONG_ENDINGS])]] = LONG
    symbol = kind.copy()
    symbol[starts] += 8
    m = monoid()
    state = m.states_before(m.symbol[symbol])
    run = np.minimum(kind, OTHER)  # apostrophes are in runs of other signs
    white = (run == SPACE) | (run == WHITE)
    before = np.concatenate(([255], run[:-1])).astype(np.uint8)
    before[starts] = 255
    solid_next = np.append(~white[1:], False)
    solid_next[ends - 1] = False  # a text's last run of white space is one token
    inside = (state == TWO_LEFT) | (state == ONE_LEFT)
    joined = ((before == run) & (state != ENDED)) | (before == SPACE) | inside
    white_before = (before == SPACE) | (before == WHITE)
    first = np.where(white, ~white_before | solid_next, ~joined)
    first[starts] = True
    return np.flatnonzero(first)


class PairTable:
    """Rank of the token that two neighbouring tokens make, for arrays of pairs (open addressing)."""

    def __init__(self, ranks: dict[bytes, int]):
        self.none = max(ranks.values(), default=-1) + 1
        pairs = [(ranks[t[:i]] << 32 | ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t))
                 if t[:i] in ranks and t[i:] in ranks]
        key = np.array([k for k, _ in pairs], np.uint64)
        rank = np.array([r for _, r in pairs], np.int32)
        self.bits = max(8, int(len(pairs) * 4).bit_length())
        self.empty = np.uint64(2 ** 64 - 1)
        self.keys = np.full((1 << self.bits) + 1024, self.empty)
        self.ranks = np.full(len(self.keys), self.none, np.int32)
        slot = self.slot(key)
        todo = np.arange(len(key))
        while len(todo):  # each round one key settles in every free slot asked for
            free = todo[self.keys[slot[todo]] == self.empty]
            chosen = free[np.unique(slot[free], return_index=True)[1]]
            self.keys[slot[chosen]], self.ranks[slot[chosen]] = key[chosen], rank[chosen]
            todo = todo[self.keys[slot[todo]] != key[todo]]
            slot[todo] += 1

    def slot(self, key: np.ndarray) -> np.ndarray:
        return ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks; ``none`` where the pair makes no token (ids of -1 are no tokens)."""
        key = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64) & np.uint64(0xFFFFFFFF)
        slot = self.slot(key)
        held = self.keys[slot]
        out = np.where(held == key, self.ranks[slot], self.none).astype(np.int32)
        todo = np.flatnonzero((held != key) & (held != self.empty))
        while len(todo):
            slot[todo] += 1
            held = self.keys[slot[todo]]
            hit = held == key[todo]
            out[todo[hit]] = self.ranks[slot[todo[hit]]]
            todo = todo[~hit & (held != self.empty)]
        return out


class Merger:
    """Pair merging by the ranks of a vocabulary, behind a bounded cache."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = [b""] * (max(ranks.values(), default=-1) + 1)
        for piece, rank in ranks.items():
            self.token[rank] = piece
        self.decimal = [str(i) for i in range(len(self.token))]
        self.cache: dict[str, tuple[int, ...]] = {}

    @functools.cached_property
    def pairs(self) -> PairTable:
        return PairTable(self.ranks)

    def merge_many(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """``merge`` of many short pieces at once: each round joins the best pair of every piece."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        out: list = [()] * len(pieces)
        one = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        for low, high in ((0, 8), (8, 16), (16, 32), (32, 64)):
            rows = np.flatnonzero((size > low) & (size <= high))
            if not len(rows):
                continue
            width = int(size[rows].max())
            raw = np.frombuffer(b"".join(pieces[i].ljust(width, b"\0") for i in rows.tolist()), np.uint8).reshape(-1, width)
            ids = np.where(np.arange(width) < size[rows, None], one[raw], np.int32(-1))
            pair = self.pairs(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(rows), width - 1)
            while True:
                at = pair.argmin(1) if pair.shape[1] else np.zeros(len(rows), np.int64)
                best = pair[np.arange(len(rows)), at] if pair.shape[1] else np.full(len(rows), self.pairs.none)
                over = best == self.pairs.none
                if over.any():
                    done = ids[over]
                    count = (done >= 0).sum(1).tolist()
                    for i, got, n in zip(rows[over].tolist(), done.tolist(), count):
                        out[i] = tuple(got[:n])
                    rows, ids, pair, at, best = (x[~over] for x in (rows, ids, pair, at, best))
                if not len(rows):
                    break
                each = np.arange(len(rows))
                column = np.arange(ids.shape[1] - 1)
                ids = np.take_along_axis(ids, column + (column > at[:, None]), 1)
                ids[each, at] = best
                column = column[:-1]
                pair = np.take_along_axis(pair, column + (column >= at[:, None]), 1)
                for shift in (0, 1):  # the pairs that the new token is in
                    p = at - shift
                    ok = np.flatnonzero((p >= 0) & (p < pair.shape[1]))
                    pair[ok, p[ok]] = self.pairs(ids[ok, p[ok]], ids[ok, p[ok] + 1])
        return out

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Always join the neighbouring pair of least rank, the leftmost of equals."""
        ranks = self.ranks
        if piece in ranks:  # every token is what its own bytes merge to
            return (ranks[piece],)
        far = len(self.token)
        if len(piece) > 64:
            return self.merge_long(piece)
        cut = list(range(len(piece) + 1))
        pair = [ranks.get(piece[i:i + 2], far) for i in range(len(piece) - 1)]
        while pair:
            best = min(pair)
            if best == far:
                break
            i = pair.index(best)
            del cut[i + 1], pair[i]
            if i < len(pair):
                pair[i] = ranks.get(piece[cut[i]:cut[i + 2]], far)
            if i:
                pair[i - 1] = ranks.get(piece[cut[i - 1]:cut[i + 1]], far)
        return tuple(ranks[piece[a:b]] for a, b in zip(cut, cut[1:]))

    def merge_long(self, piece: bytes) -> tuple[int, ...]:
        """The same through a heap, for pieces whose pair list would be walked too often."""
        import heapq
        ranks, n = self.ranks, len(piece)
        after, ahead = list(range(1, n + 1)), list(range(-1, n - 1))
        end = after[:]  # of the part that starts at i; 0 once it is gone
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if not j or j >= n or end[j] != stop:
                continue  # one of the two parts has changed since
            end[i], end[j] = stop, 0
            after[i] = stop
            if stop < n:
                ahead[stop] = i
                if (r := ranks.get(piece[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (h := ahead[i]) >= 0 and (r := ranks.get(piece[h:stop])) is not None:
                heapq.heappush(heap, (r, h, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i:end[i]]])
            i = end[i]
        return tuple(out)

    def encode(self, pieces: list[str]) -> list[tuple[int, ...]]:
        out = list(map(self.cache.get, pieces))
        if None in out:
            new = {pieces[i]: () for i, got in enumerate(out) if got is None}
            short = [p for p in new if len(p) <= 16]
            new.update(zip(short, self.merge_many([p.encode() for p in short])))
            for p in new:
                if len(p) > 16:
                    new[p] = self.merge(p.encode())
            out = [new[p] if got is None else got for got, p in zip(out, pieces)]
            if len(self.cache) + len(new) > CACHE_PIECES:
                self.cache.clear()
            self.cache.update((p, got) for p, got in new.items() if len(p) <= 64)  # longer ones do not come back
        return out

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def load_merger(path: str) -> Merger:
    """A worker's merger for a rank file (lines of base64 token and rank)."""
    with open(path, "rb") as f:
        return Merger({base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())})


def encode_column(column: pa.Array, merger: Merger):
    """For each text: its ids, and the code-point offset of each of its slices with the number of ids before it."""
    raw, at = text_buffer(column)
    whole = raw.decode()
    points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    if len(whole) == len(raw):
        bound = at
    else:  # code points before each text's first byte
        lead = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
        bound = np.concatenate(([0], np.cumsum(lead)))[at]
    filled = bound[:-1][np.diff(bound) > 0]
    first = token_starts(points, filled)
    stops = np.append(first[1:], len(points)).tolist()
    pieces = [whole[a:b] for a, b in zip(first.tolist(), stops)]
    coded = merger.encode(pieces)
    cut = np.searchsorted(first, bound).tolist()
    for i, (a, b) in enumerate(zip(cut, cut[1:])):
        yield coded[a:b], first[a:b] - bound[i]


def encode(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids array<int>, piece_start array<int>, piece_ids array<int>)``: token ids of every text; slice ``j``
    starts at code point ``piece_start[j]`` and has the next ``piece_ids[j]`` ids."""
    kind = docs.schema[id_col].dataType.simpleString()

    def kernel(batch):
        merger = load_merger(ranks_path)
        ids, start, size = [], [], []
        for coded, offsets in encode_column(batch.column(1), merger):
            ids.append(list(chain.from_iterable(coded)))
            start.append(offsets.astype(np.int32))
            size.append(np.fromiter(map(len, coded), np.int32, len(coded)))
        return batch.column(0), ids, start, size

    return map_text(docs, [id_col, text_col], kernel, f"`{id_col}` {kind}, ids array<int>, piece_start array<int>, piece_ids array<int>")


def decode(encoded: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id, decoded binary)``: the bytes that the ids stand for (null ids: no bytes)."""
    def run(batches):
        merger = load_merger(ranks_path)
        for batch in batches:
            got = [merger.decode(x or ()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.binary())], [id_col, "decoded"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {kind}, decoded binary")


def round_trip(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_tokens long, ids_sha256, decoded_sha256)``: every text encoded, its ids decoded again, both as digests."""
    kind = docs.schema[id_col].dataType.simpleString()

    def kernel(batch):
        merger = load_merger(ranks_path)
        count, of_ids, of_bytes = [], [], []
        for coded, _ in encode_column(batch.column(1), merger):
            ids = list(chain.from_iterable(coded))
            count.append(len(ids))
            of_ids.append(hashlib.sha256(",".join(map(merger.decimal.__getitem__, ids)).encode()).hexdigest())
            of_bytes.append(hashlib.sha256(merger.decode(ids)).hexdigest())
        return batch.column(0), count, of_ids, of_bytes

    return map_text(docs, [id_col, text_col], kernel, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def stage(spark, docs: DataFrame, ranks_path: str) -> DataFrame:
    """Pipeline form: ``(doc_id, n_tokens, ids, ids_sha256, decoded_sha256)`` of every document."""
    def kernel(batch):
        merger = load_merger(ranks_path)
        lists, of_ids, of_bytes = [], [], []
        for coded, _ in encode_column(batch.column(1), merger):
            ids = list(chain.from_iterable(coded))
            lists.append(np.array(ids, np.int32))
            of_ids.append(hashlib.sha256(",".join(map(merger.decimal.__getitem__, ids)).encode()).hexdigest())
            of_bytes.append(hashlib.sha256(merger.decode(ids)).hexdigest())
        return batch.column(0), list(map(len, lists)), lists, of_ids, of_bytes

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_text(docs, ["doc_id", "text"], kernel, f"doc_id {kind}, n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string")

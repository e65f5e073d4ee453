"""Token-id output in Simple-8b words (operator 5).

Documents are sorted into ascending id order by a range shuffle, encoded by a tokenizer of the ``tokenizers`` library
and written as blocks.  A block is one binary value with everything that decoding needs (see ``pack_block``): document
ids, their counts, the word offset of every segment of ``SEGMENT`` ids, and 64-bit words.  The low four bits of a word
select how many ids of how many bits it holds; an id that needs more than 60 bits is an escape word followed by the raw
value.  Segments are coded apart from each other, so encoding and decoding run over all segments of a block at once.
Blocks are rows of a Parquet data set ``(part, block, ids_before, n_ids, payload)``: Spark's commit protocol makes the
files safe against lost executors and any store that Spark can write will do.

The tokenizer's pre-tokenizer never lets a token span white space and its normalizer works within it, so texts are
encoded piece by piece between white space, each distinct piece of a slice of texts once, and by the
library once per worker (bounded cache).

Defined results: a null or empty text has the end id alone; null ids sort first; repeated ids sort by text; other columns are not
read; an empty table writes no blocks and reads back as no rows.
"""

from __future__ import annotations

import functools
import os
import re
import struct
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vecframe.llm.common import long_lists, text_slices

# Ids per word and bits per id of the selectors 1 to 14; 0 is a run of zeros, 15 an escape.
PACKED = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
ZEROS, ESCAPE, ZERO_RUN = 0, 15, 240
COUNT = np.array([ZERO_RUN, *(n for n, _ in PACKED), 1], np.int64)
BITS = np.array([0, *(b for _, b in PACKED), 64], np.int64)

#: Ids that are coded together; the last word of a segment may be part empty.
SEGMENT = 240
#: Ids after which a block is closed (it holds whole documents).
BLOCK_IDS = 1 << 16
#: Bytes of text whose pieces are looked up together.
SLICE_BYTES = 8 << 20
#: Distinct pieces (some 200 bytes each) after which a worker's cache becomes the older half of it, and the half before that is dropped.
CACHE_PIECES = 400_000

HEADER = struct.Struct("<4sIIII")
MAGIC = b"S8B1"


def selectors(ids: np.ndarray) -> np.ndarray:
    """For every position the selector that packs most ids from there on."""
    width = np.frexp(ids.astype(np.float64))[1].astype(np.uint8)  # bits; exact below 2**53
    wide = ids >= np.uint64(1 << 53)
    if wide.any():
        width[wide] = [int(x).bit_length() for x in ids[wide].tolist()]
    best = np.full(len(ids), ESCAPE, np.uint8)
    most, reach = width.copy(), 1  # most: largest width of the next ``reach`` ids (beyond the end: 0)
    for s in range(len(PACKED), -1, -1):
        n, bits = int(COUNT[s]), int(BITS[s])
        while reach < n:
            hop = min(reach, n - reach)
            most[:-hop] = np.maximum(most[:-hop], most[hop:]) if hop < len(most) else most[:-hop]
            reach += hop
        fits = most <= bits
        if not fits.any() and n > 8:
            break
        best[fits] = s
    return best


def encode_words(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(words uint64, word offset of every segment and the end)`` for an array of uint64 ids."""
    n = len(ids)
    starts = np.arange(0, n, SEGMENT)
    stops = np.minimum(starts + SEGMENT, n)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(1, np.uint32)
    choice = selectors(ids)
    first = np.zeros(n, bool)
    at, stop = starts, stops
    while len(at):  # one word of every segment at a time
        first[at] = True
        at = at + COUNT[choice[at]]
        more = at < stop
        at, stop = at[more], stop[more]
    where = np.flatnonzero(first)
    s = choice[where]
    slot = np.concatenate(([0], np.cumsum(1 + (s == ESCAPE))))
    words = np.zeros(slot[-1], np.uint64)
    room = np.minimum(COUNT[s], np.minimum((where // SEGMENT + 1) * SEGMENT, n) - where)
    for k in np.unique(s).tolist():
        own = np.flatnonzero(s == k)
        word = np.full(len(own), k, np.uint64)
        if k == ESCAPE:
            words[slot[own] + 1] = ids[where[own]]
        elif k != ZEROS:
            for lane in range(int(COUNT[k])):
                has = room[own] > lane
                value = ids[np.minimum(where[own] + lane, n - 1)] << np.uint64(4 + lane * int(BITS[k]))
                word |= np.where(has, value, np.uint64(0))
        words[slot[own]] = word
    offsets = slot[np.concatenate((np.searchsorted(where, starts), [len(where)]))]
    return words, offsets.astype(np.uint32)


def decode_words(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The ids of ``encode_words``."""
    out = np.zeros(n, np.uint64)
    if n == 0:
        return out
    s = (words & np.uint64(15)).astype(np.int64)
    coded = np.ones(len(words), bool)
    for i in np.flatnonzero(s == ESCAPE).tolist():  # a raw value may look like an escape, so in order
        if coded[i]:
            coded[i + 1] = False
    slot = np.flatnonzero(coded)
    s = s[slot]
    # ids before each word, within its segment
    segment = np.searchsorted(offsets, slot, "right") - 1
    held = np.cumsum(COUNT[s]) - COUNT[s]
    lead = held[np.searchsorted(slot, offsets[:-1])]
    at = held - lead[segment] + segment * SEGMENT
    room = np.minimum((segment + 1) * SEGMENT, n) - at
    for k in np.unique(s).tolist():
        own = np.flatnonzero(s == k)
        if k == ESCAPE:
            out[at[own]] = words[slot[own] + 1]
        elif k != ZEROS:
            mask = np.uint64((1 << int(BITS[k])) - 1)
            for lane in range(int(COUNT[k])):
                has = own[room[own] > lane]
                out[at[has] + lane] = (words[slot[has]] >> np.uint64(4 + lane * int(BITS[k]))) & mask
    return out


def pack_block(doc_ids: np.ndarray, known: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> bytes:
    """Header (magic, documents, ids, segments, words), document ids, whether an id is there (null: 0), counts, segment offsets, words."""
    words, offsets = encode_words(ids.astype(np.uint64))
    return b"".join((HEADER.pack(MAGIC, len(doc_ids), len(ids), len(offsets), len(words)), doc_ids.astype("<i8").tobytes(),
                     known.astype("u1").tobytes(), counts.astype("<u4").tobytes(), offsets.astype("<u4").tobytes(), words.astype("<u8").tobytes()))


def unpack_block(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(doc ids, whether known, counts, ids)``."""
    magic, docs, n, segments, n_words = HEADER.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("not a token block")
    at = HEADER.size
    out = []
    for dtype, k in (("<i8", docs), ("u1", docs), ("<u4", docs), ("<u4", segments), ("<u8", n_words)):
        out.append(np.frombuffer(payload, dtype, k, at))
        at += np.dtype(dtype).itemsize * k
    doc_ids, known, counts, offsets, words = out
    return doc_ids, known.astype(bool), counts.astype(np.int64), decode_words(words, offsets.astype(np.int64), n)


#: A sign of ,. between a letter or number and white space: a token of its own (RE2, as Arrow has it).
LONE_SIGN = r"([a-z0-9])([.,])(\s)"

#: Signs outside ASCII that are common in prose.
SIGNS = "\u2018\u2019\u201c\u201d\u2013\u2014\u2026\u00ab\u00bb"

#: Tokens of a piece in lower case, as the pre-tokenizer splits it, if all of it is ASCII, letters and ``SIGNS``.
RUNS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|[0-9]|(?:[^\w\s]|_)+")
PLAIN = re.compile(f"[\x21-\x7e{SIGNS}]+")


class PieceCoder:
    """A tokenizer behind a bounded cache: pieces between white space and their ids as little-endian uint32.

    Texts are normalized first (lower case; they are in normal form already, or left to the library), so that a word
    has one entry.  Words of letters then need no normalizer: the library encodes many of them in one call."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        size = self.tokenizer.get_vocab_size()
        self.ends_word = np.array([str(self.tokenizer.id_to_token(i)).endswith("</w>") for i in range(size)])
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def words(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters, many in one call: the last token of each is the one that ends a word."""
        out = []
        for i in range(0, len(words), 500):
            part = words[i:i + 500]
            ids = np.array(self.plain.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            stops = (np.flatnonzero(self.ends_word[ids]) + 1).tolist()
            if len(stops) == len(part) and stops[-1] == len(ids):
                raw = ids.tobytes()
                out += [raw[4 * a:4 * b] for a, b in zip([0, *stops], stops)]
            else:
                out += map(self.whole, part)
        return out

    def learn(self, new: list[str]) -> None:
        """Put the ids of new pieces into the cache: words of letters, other pieces by their runs of letters, digits and runs of other signs."""
        cache = self.cache
        runs, rest = {}, set()
        words = []
        for x in new:  # an empty one, before the first or after the last white space, has no runs
            if x.isalpha():
                words.append(x)
            elif x.isascii() or not (y := PLAIN.sub("", x)) or y.isalpha():
                runs[x] = parts = RUNS.findall(x)
                rest.update(parts)
            else:
                rest.add(x)
        rest = [x for x in rest if x not in cache]
        words = list(dict.fromkeys([*words, *(x for x in rest if x.isalpha())]))
        cache.update(zip(words, self.words(words)))
        rest = [x for x in rest if x not in cache]
        cache.update((x, np.array(e.ids, "<u4").tobytes()) for x, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)))
        cache.update((x, b"".join([cache[r] for r in parts])) for x, parts in runs.items())

    def normal(self, text: str | None) -> str | None:
        """The normalized text, which splits at white space; None if only the library itself may split it."""
        if not text:
            return ""
        if not text.isascii():
            # a capital sigma's lower case depends on its place for Python alone
            if "\u03a3" in text or not unicodedata.is_normalized("NFC", text):
                return None
        if any(c in text for c in "\x1c\x1d\x1e\x1f") or any(t in text for t in self.special):  # the first four only Python takes for white space
            return None
        return text.lower()

    def ids_of(self, pieces: list[str]) -> list[bytes]:
        """The ids of distinct pieces."""
        if len(self.cache) > CACHE_PIECES:  # what is asked for again comes back from the older half
            self.older, self.cache = self.cache, {}
        cache, older = self.cache, self.older
        found = list(map(cache.get, pieces))
        missing = [i for i, b in enumerate(found) if b is None]
        if older:
            cache.update((x, older[x]) for x in map(pieces.__getitem__, missing) if x in older)
        self.learn([x for x in map(pieces.__getitem__, missing) if x not in cache])
        for i in missing:
            found[i] = cache[pieces[i]]
        return found

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of every text.  Arrow splits the texts and numbers their distinct pieces, whose ids are then laid out by place."""
        normal = [self.normal(t) for t in texts]
        apart = pc.replace_substring_regex(pa.array([t or "" for t in normal], pa.string()), LONE_SIGN, r"\1 \2\3")
        split = pc.utf8_split_whitespace(apart)
        coded = split.flatten().dictionary_encode()
        parts = self.ids_of(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        place = coded.indices.to_numpy()
        pool = np.frombuffer(b"".join(parts), "<u4")
        length = np.fromiter(map(len, parts), np.int32, len(parts)) // 4
        first = np.cumsum(length, dtype=np.int32) - length
        n = length[place]
        ends = np.concatenate((np.zeros(1, np.int32), np.cumsum(n, dtype=np.int32)))  # no more ids than bytes of text
        flat = pool[np.repeat(first[place] - ends[:-1], n) + np.arange(ends[-1], dtype=np.int32)]
        cuts = ends[split.offsets.to_numpy()].tolist()
        return [np.frombuffer(self.whole(t), "<u4") if x is None else flat[a:b] for t, x, a, b in zip(texts, normal, cuts, cuts[1:])]


@functools.lru_cache(maxsize=2)
def load_coder(path: str) -> PieceCoder:
    return PieceCoder(path)


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                 block_ids: int = BLOCK_IDS) -> None:
    """Encode every text, append ``end_id`` and write blocks in ascending id order to ``path``."""
    def run(batches):
        coder, part = load_coder(tokenizer_path), TaskContext.get().partitionId()
        block = before = size = 0
        held: list[tuple] = []

        def close():
            nonlocal block, before, size, held
            names, known, counts, ids = zip(*held)
            flat = np.concatenate(ids)
            payload = pack_block(np.array(names), np.array(known), np.array(counts), flat)
            row = pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((part, block, before, len(flat), payload), KINDS)], NAMES)
            block, before, size, held = block + 1, before + len(flat), 0, []
            return row

        with long_lists():
            for batch in batches:
                for piece in text_slices(batch, 1, SLICE_BYTES):
                    for name, ids in zip(piece.column(0).to_pylist(), coder.encode(piece.column(1).to_pylist())):
                        ids = np.append(ids, np.uint32(end_id))
                        held.append((name or 0, name is not None, len(ids), ids))
                        size += len(ids)
                        if size >= block_ids:
                            yield close()
        if held:
            yield close()

    ordered = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
               .repartitionByRange("id", F.xxhash64("text")).sortWithinPartitions("id", F.xxhash64("text"), "text"))
    ordered.mapInArrow(run, "part int, block int, ids_before long, n_ids long, payload binary").write.parquet(path)


NAMES = ["part", "block", "ids_before", "n_ids", "payload"]
KINDS = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32[, ids])`` from the files: ``start`` counts the ids of all documents before."""
    def run(batches):
        for batch in batches:
            for part, before, payload in zip(*(batch.column(i).to_pylist() for i in range(3))):
                names, known, counts, ids = unpack_block(payload)
                ends = np.cumsum(counts)
                starts = ends - counts
                plain = ids.astype("<u4")
                crc = [zlib.crc32(plain[a:b].tobytes()) for a, b in zip(starts.tolist(), ends.tolist())]
                columns = [pa.array(np.full(len(names), part), pa.int32()), pa.array(names, pa.int64(), mask=~known), pa.array(starts + before, pa.int64()),
                           pa.array(counts, pa.int64()), pa.array(crc, pa.int64())]
                if with_ids:
                    columns.append(pa.array([ids[a:b].astype(np.int64) for a, b in zip(starts.tolist(), ends.tolist())], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, ["part", "doc_id", "inside", "n_tokens", "ids_crc32", *["ids"] * with_ids])

    blocks = spark.read.schema("part int, block int, ids_before long, n_ids long, payload binary").parquet(path)
    # one row for each partition that was written
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    base = parts.select(F.col("part").alias("of"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    rows = blocks.select("part", "ids_before", "payload").mapInArrow(
        run, "part int, doc_id long, inside long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)
    return rows.join(F.broadcast(base), F.col("part") == F.col("of")).select(
        "doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)

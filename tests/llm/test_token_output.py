import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from edge import TEXTS, edge_docs
from vecframe.llm import token_output as T
from vecframe.session import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("n", [0, 1, 5, 239, 240, 241, 1000, 5000])
def test_words_round_trip(n):
    r = np.random.default_rng(n)
    pick = np.array([0, 0, 0, 15, 2**63 + 15, 2**60, 2**60 - 1, 1, 2**53, 2**53 - 1], np.uint64)
    for ids in (r.integers(0, 49408, n), np.zeros(n), 2 ** r.integers(0, 64, n, dtype=np.uint64), r.integers(0, 3, n), r.choice(pick, n),
                np.where(r.random(n) < 0.01, 70000, 0), 2 ** r.integers(0, 62, n) - 1):
        ids = np.asarray(ids).astype(np.uint64)
        words, offsets = T.encode_words(ids)
        assert (T.decode_words(words, offsets.astype(np.int64), n) == ids).all()


def test_small_ids_pack_tightly():
    words, _ = T.encode_words(np.ones(240, np.uint64))
    assert len(words) == 4
    assert len(T.encode_words(np.zeros(240, np.uint64))[0]) == 1


def test_pieces_as_the_library():
    coder = T.PieceCoder(PATH)
    random.seed(3)
    letters = list("ab's T'DRE vll m 12\n\t  \xa0é'Ñ中😀.,!'’　\x1c\x85́²ⅧİΣΑΣ_#%") + ["<|endoftext|>", "word, ", "Word. "]
    texts = ["".join(random.choice(letters) for _ in range(random.randint(0, 30))) for _ in range(8000)] + ["", "   ", "\x1c", "́ ́a,", "a_, b., c9, d"]
    want = [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
    assert [list(map(int, x)) for x in coder.encode(texts)] == want


def test_cache_limit_changes_nothing(monkeypatch):
    monkeypatch.setattr(T, "CACHE_PIECES", 3)
    coder = T.PieceCoder(PATH)
    texts = ["one two three four", "five six one two", "one"]
    want = [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
    for t, ids in zip(texts, want):
        assert list(map(int, coder.encode([t])[0])) == ids


def test_pieces_asked_for_again_outlive_a_full_cache(monkeypatch):
    monkeypatch.setattr(T, "CACHE_PIECES", 4)
    coder = T.PieceCoder(PATH)
    learned, words = [], coder.words
    monkeypatch.setattr(coder, "words", lambda some: learned.extend(some) or words(some))
    library = Tokenizer.from_file(PATH)
    for i in range(30):
        text = f"always here {'abcdefghijklmnopqrstuvwxyzabcdef'[i:i + 3]} l'été, {chr(97 + i % 26) * 5}"
        assert coder.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids
    assert learned.count("always") == learned.count("here") == 1


def test_white_space_and_runs_as_the_library():
    coder, library = T.PieceCoder(PATH), Tokenizer.from_file(PATH)
    spaces = [c for c in map(chr, range(0x110000)) if c.isspace()]
    texts = [f"ab.{c}cd,{c}{c}9.{c}é." for c in spaces] + ["", "  ", None, "l'été d'ours «élan»—'sûr’s x_y ñ_9ñ 'sé ½a a²b ...'tis 's's"]
    assert [x.tolist() for x in coder.encode(texts)] == [library.encode(t or "", add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("block_ids", [1, 50, 1 << 15])
def test_files_in_id_order(spark, block_ids):
    docs, path = edge_docs(spark).repartition(3), scratch_path(spark, "tokens-test")
    T.write_tokens(docs, path, PATH, end_id=2, block_ids=block_ids)
    rows = sorted(T.read_tokens(spark, path).collect(), key=lambda r: r["start"])
    tokenizer = Tokenizer.from_file(PATH)
    of = {}
    for i, t in TEXTS:
        of.setdefault(i, []).append([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2])
    assert [r["doc_id"] for r in rows] == sorted((i for i, _ in TEXTS), key=lambda i: (i is not None, i))
    start = 0
    for r in rows:
        assert r["start"] == start and list(r["ids"]) in of[r["doc_id"]] and r["n_tokens"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        start += r["n_tokens"]


def test_empty_table(spark):
    path = scratch_path(spark, "tokens-empty")
    T.write_tokens(edge_docs(spark, []), path, PATH, end_id=2)
    assert T.read_tokens(spark, path).collect() == []

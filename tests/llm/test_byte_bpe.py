import base64
import hashlib
import random
import unicodedata
from itertools import chain

import pyarrow as pa
import pytest
import tiktoken

import public_tokenizers
from edge import TEXTS, edge_docs
from vecframe.llm import byte_bpe as B

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(texts):
    merger = B.load_merger(PATH)
    return [list(chain.from_iterable(c)) for c, _ in B.encode_column(pa.array(texts, pa.string()), merger)]


def test_random_texts_as_the_library(library):
    random.seed(5)
    letters = list("ab's t'dre vll m 12\n\t  \xa0é'ñ中😀.,!'’　\x1c\x85́²Ⅷ ")
    texts = ["".join(random.choice(letters) for _ in range(random.randint(0, 30))) for _ in range(5000)]
    texts += [None, "", "a" * 3000, " " * 500, "x'" * 200, "\n\n", "don't we'll I'd you're 's's 're"]
    assert encoded(texts) == [library.encode_ordinary(t or "") for t in texts]


def test_classes_of_all_code_points(library):
    import regex
    table = B.class_table()
    for cp in chain(range(0xD800), range(0xE000, 0x30000, 7)):
        c = chr(cp)
        kind = B.LETTER if regex.match(r"\p{L}", c) else B.NUMBER if regex.match(r"\p{N}", c) else B.SPACE if c == " " else B.WHITE if regex.match(r"\s", c) else B.OTHER
        if kind != table[cp]:
            assert unicodedata.category(c) == "Cn", hex(cp)  # newer than this Python's tables


def test_monoid_is_associative_and_scan_matches_steps():
    m = B.monoid()
    for f in range(m.size):
        for g in range(m.size):
            for h in range(m.size):
                assert m.then[m.then[f, g], h] == m.then[f, m.then[g, h]]
    import numpy as np
    symbols = np.random.default_rng(1).choice([0, 1, 2, 3, 4, 5, 6, 8, 10, 13], 5000)
    states = m.states_before(m.symbol[symbols])
    s = B.OPEN
    for k, state in zip(symbols.tolist(), states.tolist()):
        assert s == state
        s = B.step(B.OPEN if k >= 8 else s, k & 7)


def test_merge_many_is_merge():
    merger = B.load_merger(PATH)
    random.seed(2)
    pieces = list({bytes(random.choice(b"abcdeth s\xc3\xa9") for _ in range(random.randint(1, 40))) for _ in range(3000)})
    assert merger.merge_many(pieces) == [merger.merge(p) for p in pieces]


def test_long_pieces(library):
    texts = ["ab" * 400 + "é" * 100, "=" * 1000, "x" * 65 + " " + "thethe" * 30]
    assert encoded(texts) == [library.encode_ordinary(t) for t in texts]


def test_offsets_give_the_slices():
    text = "don't  stop\n\n'll é中 12"
    merger = B.load_merger(PATH)
    (coded, starts), = B.encode_column(pa.array([text]), merger)
    ends = [*starts[1:].tolist(), len(text)]
    assert [merger.decode(c).decode() for c in coded] == [text[a:b] for a, b in zip(starts.tolist(), ends)]


def test_edge_table(spark, library):
    docs = edge_docs(spark)
    rows = B.round_trip(docs, PATH).collect()
    want = sorted(((i, len(ids := library.encode_ordinary(t or "")), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                    hashlib.sha256((t or "").encode()).hexdigest()) for i, t in TEXTS), key=repr)
    assert sorted(map(tuple, rows), key=repr) == want
    back = B.decode(B.encode(docs, PATH), PATH).collect()
    assert sorted((r[0], bytes(r[1]).decode()) for r in back if r[0]) == sorted((i, t or "") for i, t in TEXTS if i)
    assert B.stage(spark, docs, PATH).count() == len(TEXTS)


def test_empty_table(spark):
    empty = edge_docs(spark, [])
    assert B.round_trip(empty, PATH).collect() == [] and B.encode(empty, PATH).collect() == [] and B.stage(spark, empty, PATH).collect() == []

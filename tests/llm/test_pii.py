import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest

from edge import TEXTS, edge_docs
from vecframe.llm import pii as P
from vecframe.llm.common import read_table
from vecframe.llm.queries import QUERIES

# The base rules as plain backtracking patterns.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            value, number = m.group(), re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in value.split(".")),
                    "card": 13 <= len(number) <= 19 and luhn(number), "phone": 9 <= len(number) <= 15}[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def words(text):
    return [w for w in re.split(r"[\W\d_]+", text.lower()) if 4 <= len(w) <= 40]


def near(text, start, end, others):
    """Text around a mention, as far as the mentions before and after it, without the words that the window cuts."""
    low = max([e for _, e in others if e <= start], default=0)
    high = min([s for s, _ in others if s >= end], default=len(text))
    left, right = text[low:start], text[end:high]
    if len(left) > P.WINDOW:
        left = re.sub(r"^[^\W\d_]+", "", left[-P.WINDOW:])
    if len(right) > P.WINDOW:
        right = re.sub(r"[^\W\d_]+$", "", right[:P.WINDOW])
    return left + " " + right


def disclosing(texts, threshold=P.THRESHOLD, support=P.SUPPORT):
    """Terms and their actions by the definition, without Spark."""
    c_e, c_et, c_eb, seen = Counter(), Counter(), Counter(), defaultdict(set)
    c_t, c_b = Counter(), Counter()
    for text in texts:
        for w in words(text):
            c_t[w] += 1
            c_b[w[:3]] += 1
        for kind, pattern in PLAIN.items():
            others = [m.span() for m in re.finditer(pattern, text)]
            for k, start, end in base(text):
                if k != kind:
                    continue
                value = text[start:end]
                e = (kind, value.lower() if kind == "email" else value if kind == "ip" else re.sub("[^0-9]", "", value))
                around = near(text, start, end, others)
                c_e[e] += 1
                for w in set(words(around)):
                    c_et[e, w] += 1
                    seen[e, w].add(around)
                for b in {w[:3] for w in words(around)}:
                    c_eb[e, b] += 1
    total, out = sum(c_t.values()), {}
    for (e, w), n in c_et.items():
        if len(seen[e, w]) >= support and c_e[e] < total:
            information = math.log2(total / c_e[e])
            share = min(1, 1 + math.log2(n / c_t[w]) / information)
            if share >= threshold - 1e-12:
                of_class = min(1, 1 + math.log2(c_eb[e, w[:3]] / c_b[w[:3]]) / information)
                out.setdefault(w, []).append((share, of_class))
    return {w: (max(s for s, _ in x), P.GENERALISE if max(c for _, c in x) < threshold else P.REMOVE) for w, x in out.items()}


def corpus():
    """Two people whose names stand by their data; one name shares its beginning with other words."""
    r = random.Random(4)
    filler = ["meeting", "budget", "river", "window", "garden", "summer", "market", "number", "letter", "common", "people", "zeta"]
    rows = []
    for i in range(300):
        rows.append(" ".join(r.choice(filler) for _ in range(30)))
    for i in range(6):
        rows.append(f"{r.choice(filler)} {i} Zebulon writes from zeb.{7}@mail.example.com about {r.choice(filler)} {r.choice(filler)} {i}")
        rows.append(f"{r.choice(filler)} call Quixana at +1 (555) 012-3456 or by {r.choice(filler)} {i}, {r.choice(filler)}")
    rows += ["Quixana and zebulon met in the garden", "zebra zebras zebu " * 40, "nothing here", ""]
    rows += [f"they call, he writes from here about {x}" for x in filler] * 10
    return rows


def test_base_spans_of_documents(spark):
    docs = {r.doc_id: r.text for r in read_table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text").collect()}
    rows = QUERIES["op11_pii"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(docs)
    for r in rows:
        own = base(docs[r.doc_id])
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in own)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest() and r.spans.startswith(listed)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in own) for kind in P.KINDS]


def test_base_spans_of_any_text(spark):
    r = random.Random(11)
    pieces = ["a", "b@", "@", ".", "c.d", "1", "22", "255", "256", "0001", "+", "+1", " ", "-", "(", ")", "%", "x@y.z", "1.2.3.4", "4111111111111111",
              "4111 1111-1111 1111", "+1 (555) 012-3456", "é", "😀", "\x01", "\x02", "\n", "$0", "\\", "_", "@a.b.c@d.e%f@g.h"]
    texts = ["".join(r.choice(pieces) for _ in range(r.randrange(1, 40))) for _ in range(3000)]
    texts += ["x" * 20_000, "1" * 20_000, "a@" * 5000, "1." * 5000, "+1" * 5000, "a.b@c.d " * 1500, "a@b" + ".c" * 8000, "+1" + " (" * 9000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    for row in P.scan(df).rows.collect():
        assert [tuple(s) for s in row.spans if s.kind in P.KINDS] == base(texts[row.doc_id]), texts[row.doc_id][:200]


def test_disclosing_terms(spark):
    texts = corpus()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.term: (r.share, r.action) for r in P.disclosing(df).collect()}
    expected = disclosing(texts)
    assert got.keys() == expected.keys() and {"quixana", "zebulon"} <= got.keys()
    assert all(abs(got[w][0] - expected[w][0]) < 1e-9 and got[w][1] == expected[w][1] for w in got)
    assert got["zebulon"][1] == P.GENERALISE and got["quixana"][1] == P.REMOVE
    assert not {"garden", "budget", "call"} & got.keys()
    for threshold, support in ((0.5, 1), (0.0, 6)):
        got = {r.term: r.action for r in P.disclosing(df, threshold=threshold, support=support).collect()}
        assert got == {w: a for w, (_, a) in disclosing(texts, threshold, support).items()}


def test_terms_are_spans_everywhere(spark):
    texts = corpus()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    terms = disclosing(texts)
    for row in P.scan(df).rows.collect():
        text = texts[row.doc_id]
        blank = text
        for kind, a, b in base(text):
            if kind == "email":
                blank = blank[:a] + " " * (b - a) + blank[b:]
        expected = {(terms[w.lower()][1], m.start(), m.end()) for m in re.finditer(r"[^\W\d_]+", blank) if (w := m.group()).lower() in terms}
        assert {tuple(s) for s in row.spans if s.kind not in P.KINDS} == expected
    clean = {r.doc_id: r.text for r in P.sanitise(df).collect()}
    joined = " ".join(clean.values()).lower()
    assert "quixana" not in joined and "zebulon" not in joined and "example.com" not in joined and "012-3456" not in joined
    assert "zeb*" in joined and "[term] and zeb* met in the garden" in joined
    plain = texts.index("nothing here")
    assert clean[plain] == "nothing here"


def test_larger_sides_are_shuffled(spark, monkeypatch):
    texts = corpus()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    before = sorted((r.doc_id, str(r.spans)) for r in P.scan(df).rows.collect())
    monkeypatch.setattr(P, "BROADCAST_ROWS", 0)
    assert sorted((r.doc_id, str(r.spans)) for r in P.scan(df).rows.collect()) == before


def test_no_python_in_the_plan(spark):
    plan = P.scan(spark.createDataFrame(list(enumerate(corpus())), "doc_id long, text string")).rows._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


@pytest.mark.parametrize("threshold", [0.9, 0.1])
def test_edge_table(spark, threshold):
    rows = P.scan(edge_docs(spark), threshold=threshold, support=1).rows.collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in TEXTS)
    for r in rows:
        assert [tuple(s) for s in r.spans if s.kind in P.KINDS] == base(r.text)
    assert P.sanitise(edge_docs(spark), threshold=threshold, support=1).count() == len(TEXTS)


def test_empty_table(spark):
    assert P.scan(edge_docs(spark, [])).rows.collect() == [] and P.sanitise(edge_docs(spark, [])).collect() == []


def test_copies_are_no_support(spark):
    """A thousand copies of one text are one surrounding."""
    texts = ["Quixana wrote to box@mail.example.com in May"] * 200 + ["words that stand for the rest of all texts"] * 50
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert P.disclosing(df).collect() == []
    assert {r.term for r in P.disclosing(df, support=1).collect()} == {"quixana", "wrote"}

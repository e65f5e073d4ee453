"""The toxicity result hangs on its method: misspelled hits are caught, and scores are what plain Python makes of the texts."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from vecframe.llm import toxicity as X
from vecframe.llm.common import held_out, read_table

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def fitted(spark):
    docs, known = (read_table(spark, SF, t) for t in ("documents", "labels"))
    model = X.fit(docs, known)
    rows = docs.join(known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "doc_id").where(held_out(F.col("doc_id")) & F.col("toxic").isNotNull())
    return model, [(r.doc_id, r.text or "", r.toxic) for r in rows.select("doc_id", "text", "toxic").collect()]


def scores(model, texts):
    counts, hits = X.all_counts(texts, model.lexicon)
    return X.score_counts(counts, model.weights), hits


def test_held_out_recall_and_precision(fitted):
    model, rows = fitted
    got, _ = scores(model, [t for _, t, _ in rows])
    toxic = [s for s, r in zip(got, rows) if r[2] == 1]
    clean = [s for s, r in zip(got, rows) if r[2] == 0]
    assert sum(s >= X.THRESHOLD for s in toxic) >= 0.9 * len(toxic)
    assert sum(s >= X.THRESHOLD for s in clean) <= 0.02 * len(clean)


@pytest.mark.parametrize("kind", ["left out", "doubled", "another"])
def test_one_letter_of_every_hit_changed(fitted, kind):
    model, rows = fitted
    toxic = [t for _, t, label in rows if label == 1]
    before, hits = scores(model, toxic)
    r = random.Random(kind)

    def changed(word):
        i = r.randrange(len(word))
        if kind == "left out":
            return word[:i] + word[i + 1:]
        return word[:i + 1] + word[i:] if kind == "doubled" else word[:i] + r.choice([c for c in "abcdefghijklmnopqrstuvwxyz" if c != word[i].lower()]) + word[i + 1:]

    out = []
    for text, own in zip(toxic, hits):
        for _, _, _, a, b, _ in sorted(own, key=lambda h: -h[3]):
            text = text[:a] + changed(text[a:b]) + text[b:]
        out.append(text)
    after, _ = scores(model, out)
    caught = [(x, y) for x, y in zip(before, after) if x >= X.THRESHOLD]
    assert sum(y >= X.THRESHOLD for _, y in caught) >= 0.9 * len(caught)


def test_without_misspelled_hits_texts_are_lost(fitted):
    """Exact look-up alone would not return the same predictions."""
    model, _ = fitted
    texts = [f"{a} {w} {b}" for w in ("you absolute mron", "such a worthles idiiot", "disgustng people", "patheticc and stupd") for a, b in (("well", "today"), ("", ""))]
    got, _ = scores(model, texts)
    assert (got >= X.THRESHOLD).all()
    counts, _ = X.all_counts(texts, model.lexicon)
    counts[:, X.NEAR] = counts[:, X.STRONG] = counts[:, X.DIRECTED] = 0
    assert (X.score_counts(counts, model.weights) < X.THRESHOLD).all()


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row = row, [i + 1]
        for j, y in enumerate(b):
            row.append(min(last[j] + (x != y), last[j + 1] + 1, row[j] + 1))
    return row[-1]


def brute_match(lexicon, word):
    """By the edit distance to every term, without automaton and trie."""
    best = None
    for term in lexicon.terms:
        stem = term.rstrip("*")
        allowed = 0 if len(stem) < 5 else 1 if len(stem) < 8 else 2
        if term.endswith("*"):
            found = min((distance(word[:i], stem), i) for i in range(1, len(word) + 1))
            form = word[:found[1]] + "*"
        else:
            found, form = (distance(word, stem), 0), word
        if found[0] <= allowed and (best is None or (found[0], term) < best[:2]):
            best = (found[0], term, form)
    if best is None or best[0] and (best[1] in lexicon.doubted or best[2] in lexicon.exceptions):
        return None
    return best


def brute_score(model, text):
    """Words, windows, quotations, counts and the logistic score from the definitions."""
    found = [(m.group().lower(), m.start(), m.end()) for m in re.finditer(r"[^\W_]+", text)]
    exact = near = cited = direct = strong = 0
    for j, (word, a, b) in enumerate(found):
        hit = brute_match(model.lexicon, word)
        if hit is None:
            continue
        before = [w for w, _, _ in found[max(0, j - 6):j]]
        around = before + [w for w, _, _ in found[j + 1:j + 7]]
        quote = any(w in X.REPORTS for w in before[-3:])
        for mark, close in zip("\"'“‘«„‹", "\"'”’»“›"):
            start = text.rfind(mark, max(0, a - 80), a)
            end = text.find(close, b, b + 80)
            if start >= 0 and end >= 0 and close not in text[start + 1:a]:
                opens = start == max(0, a - 80) or not text[start - 1].isalnum()
                closes = end + 1 == min(len(text), b + 80) or not text[end + 1].isalnum()
                quote |= opens and closes
        if quote:
            cited += 1
            continue
        exact += hit[0] == 0
        near += hit[0] > 0
        strong += hit[1] not in model.lexicon.weak
        direct += any(w in X.DIRECT for w in around)
    n = exact + near
    x = [1, n + cited > 0, strong > 0, near > 0 and not exact, cited > 0 and not n, direct > 0, math.log1p(min(max(n - 1, 0), 20))]
    z = sum(float(w) * float(v) for w, v in zip(model.weights, x))
    return (exact, near, cited, direct), 1 / (1 + math.exp(-max(-30, min(30, z))))


def test_scores_by_brute_force(spark, fitted):
    model, rows = fitted
    short = [r for r in rows if len(r[1]) < 1500]
    texts = [t for _, t, _ in [r for r in short if r[2] == 1][:25] + [r for r in short if r[2] == 0][:25]]
    texts += ['she said "you are an idiot" to him', "he wrote idiot", "'moron' is a word", "an idiot, a mron and scum", "", "«pathetic»", "x" * 300 + " idiot",
              "Idiotİ İdiot IDIOT", "you idiot you idiott you stupid"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in X.score(df, model).collect()}
    for i, t in enumerate(texts):
        counts, s = brute_score(model, t)
        r = got[i]
        assert (r.n_exact, r.n_misspelled, r.n_quoted, r.n_direct) == counts, t
        assert abs(r.score - s) < 1e-8


def test_forms_and_doubts(spark):
    """Beginnings that clean texts use are exceptions for all words with them; a term with many such rare forms is doubted."""
    rows = [(1, f"ab{i} drimb{x} cd{i}") for i in range(40) for x in ("ole", "ant", "ust")] + [(0, f"ef{i} crimb{x} gh{i}") for i in range(60) for x in ("le", "a")]
    rows += [(0, f"plain {i}") for i in range(400)]
    df = spark.createDataFrame(rows, "label int, text string")
    lexicon = X.learn_lexicon(df)
    assert "drimb*" in lexicon.terms and "crimb*" in lexicon.exceptions
    assert lexicon.match("crimbetter") is None and lexicon.match("trimbetter") == ("drimb*", 1) and lexicon.match("drimbetter") == ("drimb*", 0)
    odd = [(0, f"{c}rimb{c}") for c in "abefghijklmnopqstuvwxyz"]
    lexicon = X.learn_lexicon(df.union(spark.createDataFrame(odd, "label int, text string")))
    assert "drimb*" in lexicon.doubted and lexicon.match("drmbetter") is None and lexicon.match("drimbetter") == ("drimb*", 0)
    assert lexicon.match("idiott") == ("idiot", 1)

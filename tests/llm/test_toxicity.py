import random

import pytest
from pyspark.sql import functions as F

from edge import TEXTS, edge_docs, labels
from vecframe.llm import toxicity as X
from vecframe.llm.common import held_out, read_table


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row = row, [i + 1]
        for j, y in enumerate(b):
            row.append(min(last[j] + (x != y), last[j + 1] + 1, row[j] + 1))
    return row[-1]


def test_automaton_matches_edit_distance():
    random.seed(1)
    for _ in range(20):
        terms = ["".join(random.choice("abcd") for _ in range(random.randint(1, 10))) for _ in range(8)]
        automaton = X.Automaton(terms)
        for _ in range(300):
            word = "".join(random.choice("abcde") for _ in range(random.randint(0, 11)))
            near = sorted((distance(word, t), t) for t in set(terms) if distance(word, t) <= X.edits(t))
            assert automaton.match(word) == ((near[0][1], near[0][0]) if near else None)


def test_stems_accept_what_begins_with_them():
    automaton = X.Automaton(["lowei*", "idiot"])
    assert automaton.match("loweischaft") == ("lowei*", 0) and automaton.match("lowei") == ("lowei*", 0)
    assert automaton.match("lowe") is None and automaton.match("lowxischaft") is None and automaton.match("idoit") is None
    assert automaton.match("idot") == ("idiot", 1)


def test_stems_are_misspelled_like_words():
    """A stem matches by the least distance of any beginning of the word; word and stem at one node each match."""
    lexicon = X.Lexicon(("lowei*", "idiot*", "idiot"))
    assert lexicon.match("lowxischaft") == ("lowei*", 1) and lexicon.match("loweischaft") == ("lowei*", 0)
    assert lexicon.match("idot") == ("idiot", 1) and lexicon.match("idoit") is None and lexicon.match("idixts") == ("idiot*", 1)
    random.seed(3)
    for _ in range(20):
        terms = ["".join(random.choice("abcd") for _ in range(random.randint(1, 9))) + random.choice(["", "*"]) for _ in range(8)]
        automaton = X.Automaton(terms, near_stems=True)
        for _ in range(300):
            word = "".join(random.choice("abcde") for _ in range(random.randint(1, 12)))
            least = {t: min(distance(word[:i], t[:-1]) for i in range(1, len(word) + 1)) if t.endswith("*") else distance(word, t) for t in terms}
            near = min(((n, t) for t, n in least.items() if n <= X.edits(t)), default=None)
            got = automaton.match(word)
            assert (got and got[1]) == (near and near[0])
            assert got is None or least[got[0]] == got[1]


def test_seed_keeps_its_edits_beside_a_learned_stem(spark):
    rows = [(1, f"ab{i} {w} cd{i}") for i in range(40) for w in ("idiot", "idiots", "idiotic")] + [(0, f"ef{i} plain gh{i}") for i in range(200)]
    lexicon = X.learn_lexicon(spark.createDataFrame(rows, "label int, text string"))
    assert {"idiot", "idiot*"} <= set(lexicon.terms)
    assert lexicon.match("idot") == ("idiot", 1) and lexicon.match("idixtic") == ("idiot*", 1)


def test_exceptions_are_words_that_clean_texts_use_more(spark):
    """Clean near words are exceptions by themselves: they do not keep other misspellings of the term from being found."""
    near = ["moran", "moren", "morin", "morons"]
    rows = [(0, f"ab{i} {w} cd{i}") for i in range(3) for w in near] + [(1, f"ef{i} morom gh{i}") for i in range(2)] + [(0, "once morom too")]
    lexicon = X.learn_lexicon(spark.createDataFrame(rows, "label int, text string"))
    assert all(lexicon.match(w) is None for w in near)
    assert lexicon.match("morom") == ("moron", 1) and lexicon.match("mroon") is None and lexicon.match("moronn") == ("moron", 1)


def test_limit_counts_chosen_terms(spark, monkeypatch):
    """The limit holds for terms, not for the stems that they are chosen from."""
    monkeypatch.setattr(X, "MAX_TERMS", 3)
    words = ["blortish", "crunkled", "drimbole"]
    rows = [(1, f"ab{i} {w} cd{i}") for i in range(40) for w in words] + [(0, f"ef{i} plain gh{i}") for i in range(400)]
    assert set(X.learn_lexicon(spark.createDataFrame(rows, "label int, text string")).terms) - set(X.SEED) == set(words)


def test_choose_terms():
    units = {"scum": 50, "scu*": 50, "scum*": 50, "low*": 40, "lowe*": 40, "lowei*": 40, "loweis*": 15, "loweit*": 12, "loweisch": 10, "odd": 9}
    assert X.choose_terms(units) == ["lowei*", "odd", "scum"]
    assert X.choose_terms({}) == []


def test_misspelled_and_quoted():
    lexicon = X.Lexicon(X.SEED)
    counts, hits = X.hit_counts(["you idiott", 'she said "idiot" once', "such worthlss rubbish", "he wrote idiot", "plain text", "a moron's view"], lexicon)
    assert counts.tolist() == [[0, 1, 0, 1], [0, 0, 1, 0], [0, 1, 0, 0], [0, 0, 1, 0], [0, 0, 0, 0], [1, 0, 0, 0]]
    assert hits[0] == [("idiott", "idiot", 1, 4, 10, False)]
    weights = X.PRIOR_MEAN
    score = X.score_counts(counts, weights)
    assert score[0] > score[1] > 0 and score[0] > X.THRESHOLD > score[4]


def test_held_out_accuracy(spark):
    docs, known = (read_table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    scored = X.score(docs, X.fit(docs, known)).join(known, "doc_id").where(held_out(F.col("doc_id"))).select("score", "toxic").collect()
    toxic = [r.score for r in scored if r.toxic == 1]
    clean = [r.score for r in scored if r.toxic == 0]
    assert sum(s >= X.THRESHOLD for s in toxic) / len(toxic) > 0.8
    assert sum(s >= X.THRESHOLD for s in clean) / len(clean) < 0.03


@pytest.mark.parametrize("rows", [[], [(1, 1, 0), (9, 0, 1), (9, 0, 0), (6, None, None), (None, 1, 1), (7, 1, 0)]])
def test_edge_table(spark, rows):
    docs = edge_docs(spark)
    model = X.fit(docs, labels(spark, rows))
    got = X.score(docs, model).collect()
    assert len(got) == len(TEXTS) and all(0 <= r.score <= 1 for r in got)
    of = {r.doc_id: r.score for r in got}
    assert of[9] > X.THRESHOLD > of[1] and of[1] == of[5] and of[2] == of[3]
    assert X.spans(docs, model).where("doc_id = 9").count() == 4  # two hits in each of two equal rows


def test_empty_table(spark):
    empty = edge_docs(spark, [])
    model = X.fit(empty, labels(spark, [(1, 1, 1)]))
    assert X.score(empty, model).collect() == [] and X.spans(empty, model).collect() == []

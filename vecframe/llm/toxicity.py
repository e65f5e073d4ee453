"""Toxicity scores from a lexicon matched with Levenshtein automata (operator 3).

The lexicon's terms form a trie; the nodes of the trie together with the edits spent so far are the states of one
non-deterministic automaton (the Levenshtein automata of all terms, intersected with the trie).  It is made deterministic
lazily, one transition at a time, and run over the distinct words of a batch, so exact and misspelled terms are found
alike.  Each hit is then judged in its context window: within quotation marks, or after a word that reports speech, it is a
quotation; next to a second person or a copula it is direct.  A logistic model over the counts of such hits, with a prior
that has the expected signs, gives the score.

Terms are learned from labelled rows: words, and stems of words, that toxic texts have far more often, counted by distinct
contexts, so that copies of one text teach nothing; a few seed terms are always there.  A stem (written ``stem*``) accepts
every word with a beginning within its edits.

A misspelling counts nearly as much as the exact term, where it is likelier than another word.  Each one is looked at by its
form - the word, or of a stem the beginning that is near it - and forms that clean labelled texts have more often than toxic
ones are exceptions.  How often clean texts will have forms that were never seen is estimated from the forms that were seen
once (Good and Turing); terms are believed in the order of that estimate, until all believed ones together would hit
``FALSE_ALARMS`` of the clean texts.  The misspellings of the other terms are not hits.  The sample is bounded, and with it
what is learned from it.

Defined results: null and empty texts have no hits and get the score of such texts; equal texts get equal scores;
repeated rows and null ids are scored like others; of equally near terms the one that sorts first counts; texts are read
whole, however long (a kernel call holds one text at least); an empty table gives no rows; without labelled rows the prior alone
scores; other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecframe.llm.common import SAMPLE_FILES, held_out, labelled_sample, map_text, text_slices, written

#: Terms that are in the lexicon whatever the labels say.
SEED = ("idiot", "moron", "stupid", "loser", "scum", "trash", "worthless", "pathetic", "disgusting", "imbecile", "dumbass", "bastard")
#: Terms that are learned at most (of those chosen, the ones that tell most); None: all.
MAX_TERMS = None
#: Share of clean texts that misspelled forms may hit of which the labelled texts have none.
FALSE_ALARMS = 0.01
#: Log odds from which one hit of a term is strong evidence.
STRONG_ODDS = 5.0
#: Letters of a stem, and the share of a shorter stem's toxic texts that a longer one keeps if it replaces it.
STEM_LETTERS, STEM_SHARE = range(3, 9), 0.9
#: Least log odds of a learned term, least likelihood ratio (G) of its counts, and least number of its contexts.
MIN_ODDS, MIN_G, MIN_CONTEXTS = 1.7, 20.0, 4
#: Words before and after a hit that are its context window.
CONTEXT = 6

WORD = re.compile(r"[^\W_]+")
OPENING, CLOSING = "\"'“‘«„‹", "\"'”’»“›"
REPORTS = frozenset("said says say wrote writes called calls term word words quote quoted quotes phrase named termed dit sagte dijo".split())
DIRECT = frozenset("you your yours youre u are is was were he she they tu vous du sie usted".split())

#: Cut-off for scores that count as toxic.
THRESHOLD = 0.3


def edits(term: str) -> int:
    """Edits that a misspelling of the term, or of a stem's letters, may have."""
    letters = len(term.rstrip("*"))
    return 0 if letters < 5 else 1 if letters < 8 else 2


class Automaton:
    """Levenshtein automata of all terms over their trie, made deterministic as words are read.

    A state is a set of ``(trie node, edits spent)``, closed under letters of the term that are left out.  A word and a
    stem may end at one node.  Stems accept beginnings within their edits with ``near_stems``, else beginnings that are equal."""

    def __init__(self, terms, near_stems=False):
        self.edits = {t: 0 if t.endswith("*") and not near_stems else edits(t) for t in terms}
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[str]] = [[]]  # word and stem that end at the node
        self.slack: list[int] = [-1]  # most edits that a term below the node may have
        for term in sorted(set(terms)):
            node = 0
            self.slack[0] = max(self.slack[0], self.edits[term])
            for c in term.rstrip("*"):
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.slack.append(-1)
                node = self.children[node][c]
                self.slack[node] = max(self.slack[node], self.edits[term])
            self.ends[node].append(term)
        self.alphabet = {c for kids in self.children for c in kids}
        self.states: list[frozenset] = []
        self.number: dict[frozenset, int] = {}
        self.next: list[dict[str, int]] = []
        self.accepts: list[tuple[int, str] | None] = []
        self.begins: list[tuple[int, str] | None] = []
        self.dead = self.intern(frozenset())
        self.start = self.intern(self.close({(0, 0)} if self.slack[0] >= 0 else set()))

    def close(self, pairs: set) -> frozenset:
        todo = list(pairs)
        while todo:
            node, spent = todo.pop()
            for kid in self.children[node].values():
                pair = (kid, spent + 1)
                if spent + 1 <= self.slack[kid] and pair not in pairs:
                    pairs.add(pair)
                    todo.append(pair)
        best: dict[int, int] = {}
        for node, spent in pairs:
            best[node] = min(spent, best.get(node, 9))
        return frozenset(best.items())

    def intern(self, state: frozenset) -> int:
        if state not in self.number:
            self.number[state] = len(self.states)
            self.states.append(state)
            self.next.append({})
            ends = [(spent, t) for node, spent in state for t in self.ends[node] if spent <= self.edits[t]]
            self.accepts.append(min(ends, default=None))
            self.begins.append(min((e for e in ends if e[1].endswith("*")), default=None))
        return self.number[state]

    def step(self, number: int, letter: str) -> int:
        out = set()
        for node, spent in self.states[number]:
            if spent + 1 <= self.slack[node]:
                out.add((node, spent + 1))  # a letter too many
            for c, kid in self.children[node].items():
                cost = spent + (c != letter)
                if cost <= self.slack[kid]:
                    out.add((kid, cost))
        return self.intern(self.close(out))

    def match(self, word: str) -> tuple[str, int] | None:
        """``(nearest term, edits)`` of a word within a term's edits, or with a beginning within a stem's."""
        state, steps, alphabet, stem = self.start, self.next, self.alphabet, None
        for c in word:
            if c not in alphabet:
                c = ""  # all letters that no term has are alike
            row = steps[state]
            after = row.get(c)
            if after is None:
                after = row[c] = self.step(state, c)
            if after == self.dead:
                return stem and (stem[1], stem[0])
            begun = self.begins[after]
            if begun and (stem is None or begun < stem):
                stem = begun
                if stem[0] == 0:
                    return stem[1], 0
            state = after
        best = min((x for x in (stem, self.accepts[state]) if x), default=None)
        return best and (best[1], best[0])


def beginning(word: str, stem: str, spent: int) -> str:
    """The shortest beginning of ``word`` that is ``spent`` edits from ``stem``."""
    row = list(range(len(stem) + 1))
    for i, x in enumerate(word):
        if row[-1] == spent:
            return word[:i]
        last, row = row, [i + 1]
        for j, y in enumerate(stem):
            row.append(min(last[j] + (x != y), last[j + 1] + 1, row[j] + 1))
    return word


@dataclass
class Lexicon:
    """``exceptions``: forms that are no misspellings; ``doubted``: terms whose misspellings are not believed; ``weak``: terms
    of which one hit says little."""

    terms: tuple[str, ...]
    exceptions: frozenset = field(default_factory=frozenset)
    doubted: frozenset = field(default_factory=frozenset)
    weak: frozenset = field(default_factory=frozenset)

    def __post_init__(self):
        self.automaton = Automaton(self.terms, near_stems=True)

    def __reduce__(self):  # the automaton's states are each process's own
        return Lexicon, (self.terms, self.exceptions, self.doubted, self.weak)

    @staticmethod
    def form(word: str, term: str, spent: int) -> str:
        """What of the word is taken for the term: a beginning, or all of it."""
        return beginning(word, term[:-1], spent) + "*" if term.endswith("*") else word

    def match(self, word: str):
        found = self.automaton.match(word)
        if found and found[1] and (found[0] in self.doubted or self.form(word, *found) in self.exceptions):
            return None
        return found


def quoted(text: str, start: int, end: int, before: list[str]) -> bool:
    """Whether the hit stands in quotation marks that open and close near it, or follows a word that reports speech."""
    if any(w in REPORTS for w in before[-3:]):
        return True
    head, tail = text[max(0, start - 80):start], text[end:end + 80]
    for mark, close in zip(OPENING, CLOSING):
        i = head.rfind(mark)
        if i >= 0 and (i == 0 or not head[i - 1].isalnum()) and close not in head[i + 1:]:
            j = tail.find(close)
            if j >= 0 and (j + 1 == len(tail) or not tail[j + 1].isalnum()):
                return True
    return False


#: Counts by text: exact hits, misspelled hits, quoted hits, direct hits; and of the first two, those of strong terms.
EXACT, NEAR, QUOTED, DIRECTED, STRONG = range(5)


def hit_counts(texts: list[str], lexicon: Lexicon) -> tuple[np.ndarray, list[list[tuple[str, str, int, int, int, bool]]]]:
    """Counts by text (without the strong ones), and the hits ``(word, term, edits, start, end, quoted)`` with code-point offsets."""
    counts, hits = all_counts(texts, lexicon)
    return counts[:, :STRONG], hits


def all_counts(texts: list[str], lexicon: Lexicon) -> tuple[np.ndarray, list[list[tuple[str, str, int, int, int, bool]]]]:
    """:func:`hit_counts` with the strong hits."""
    words = [[w.lower() for w in WORD.findall(t)] for t in texts]
    found = {w: m for w in set().union(*words) if (m := lexicon.match(w))}
    counts = np.zeros((len(texts), 5), np.int64)
    hits: list = [[] for _ in texts]
    for i, own in enumerate(words):
        if found.keys().isdisjoint(own):
            continue
        text = texts[i]
        spans = [(m.group().lower(), m.start(), m.end()) for m in WORD.finditer(text)]
        for j, (w, a, b) in enumerate(spans):
            if w not in found:
                continue
            term, distance = found[w]
            before = [x for x, _, _ in spans[max(0, j - CONTEXT):j]]
            around = before + [x for x, _, _ in spans[j + 1:j + 1 + CONTEXT]]
            cited = quoted(text, a, b, before)
            counts[i, QUOTED if cited else EXACT if distance == 0 else NEAR] += 1
            counts[i, DIRECTED] += not cited and not DIRECT.isdisjoint(around)
            counts[i, STRONG] += not cited and term not in lexicon.weak
            hits[i].append((w, term, distance, a, b, cited))
    return counts, hits


#: Prior mean and precision of the weights: constant; any hit; a strong one; none but misspelled hits; none but quoted hits; a
#: direct one; more hits.  Labelled texts have few misspellings: theirs stays a small correction.
PRIOR_MEAN = np.array([-4.0, 2.5, 2.5, -0.4, -4.0, 0.5, 0.5])
PRIOR_PRECISION = np.array([0.05, 0.5, 0.5, 50.0, 2.0, 2.0, 0.5])


def design(counts: np.ndarray) -> np.ndarray:
    """Without the column of strong hits every hit is one."""
    exact, near, cited, direct = (counts[:, k] > 0 for k in (EXACT, NEAR, QUOTED, DIRECTED))
    open_hits = counts[:, EXACT] + counts[:, NEAR]
    strong = (counts[:, STRONG] if counts.shape[1] > STRONG else open_hits) > 0
    return np.column_stack((np.ones(len(counts)), exact | near | cited, strong, near & ~exact, cited & ~exact & ~near, direct,
                            np.log1p(np.minimum(np.maximum(open_hits - 1, 0), 20))))


def fit_weights(counts: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Logistic regression with a normal prior, by Newton's method."""
    x, w = design(counts), PRIOR_MEAN.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (label - p) - PRIOR_PRECISION * (w - PRIOR_MEAN)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(PRIOR_PRECISION)
        change = np.linalg.solve(hessian, gradient)
        w = w + np.clip(change, -3, 3)
        if np.abs(change).max() < 1e-9:
            break
    return w


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray


def choose_terms(units: dict[str, int]) -> list[str]:
    """Terms from the words and stems (``stem*``) that tell toxic texts apart, with their counts of toxic texts.

    From each shortest stem on, a longer one that keeps most of its texts replaces it; one whose texts have mostly one
    word gives way to the word.  Words that begin with a chosen stem need no term."""
    words = {u for u in units if not u.endswith("*")}
    stems = {u[:-1] for u in units if u.endswith("*")}
    longer: dict[str, list[str]] = {}
    for s in stems:
        longer.setdefault(s[:-1], []).append(s)
    out = set()
    for s in sorted(stems):
        if s[:-1] in stems:
            continue
        while longer.get(s):
            best = max(longer[s], key=lambda x: (units[x + "*"], x))
            if units[best + "*"] < STEM_SHARE * units[s + "*"]:
                break
            s = best
        whole = [w for w in words if w.startswith(s) and units[w] >= STEM_SHARE * units[s + "*"]]
        out.add(max(whole, key=lambda w: (units[w], w)) if whole else s + "*" if len(s) > min(STEM_LETTERS) else "")
    chosen = tuple(x[:-1] for x in out if x.endswith("*"))
    return sorted((out | {w for w in words if not w.startswith(chosen)}) - {""}) if chosen else sorted((out | words) - {""})


def units(words: list[str]):
    """Each distinct word of a text and each of its stems once, with the first place where it stands."""
    seen = set()
    for j, w in enumerate(words):
        if w not in seen:
            for unit in (w, *(w[:k] + "*" for k in STEM_LETTERS if k <= len(w))):
                if unit not in seen:
                    seen.add(unit)
                    yield unit, j


def lowered(text) -> list[str]:
    return [w.lower() for w in WORD.findall(text or "")]


def log_odds(toxic, clean, t: int, c: int):
    return np.log((toxic + 0.5) / (t + 1)) - np.log((clean + 0.5) / (c + 1))


def telling_units(sample: DataFrame, t: int, c: int) -> dict[str, tuple[int, float]]:
    """Words and stems that tell toxic texts apart: ``(toxic texts, G)``.

    All are counted first; contexts are gathered for those only whose counts pass."""
    def count(batches):
        for batch in batches:
            for part in text_slices(batch, 1):
                total: dict[str, list] = {}
                for label, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    for unit, _ in units(lowered(text)):
                        total.setdefault(unit, [0, 0])[label == 1] += 1
                yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array([r[0] for r in total.values()], pa.int64()),
                                                  pa.array([r[1] for r in total.values()], pa.int64())], ["word", "clean", "toxic"])

    tally = sample.mapInArrow(count, "word string, clean long, toxic long").groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = F.log((F.col("toxic") + 0.5) / (t + 1)) - F.log((F.col("clean") + 0.5) / (c + 1))
    passed = {r.word: (r.clean, r.toxic) for r in tally.where((F.col("toxic") >= MIN_CONTEXTS) & (odds >= MIN_ODDS)).collect()}

    def context(batches):
        for batch in batches:
            for part in text_slices(batch, 1):
                rows = set()
                for text in part.column(1).to_pylist():
                    words = lowered(text)
                    # copies share a word's first context
                    rows |= {(unit, " ".join(words[max(0, j - 1):j + 2])) for unit, j in units(words) if unit in passed}
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], ["word", "context"])

    apart = sample.where("label = 1").mapInArrow(context, "word string, context string").groupBy("word").agg(F.countDistinct("context").alias("contexts"))
    out = {}
    for r in apart.where(F.col("contexts") >= MIN_CONTEXTS).collect():
        clean, toxic = passed[r.word]
        backed = min(toxic, r.contexts)
        part = lambda k, share: k * np.log(k / ((backed + clean) * share)) if k else 0.0  # noqa: B023, E731
        g = 2 * (part(backed, max(t, 1) / max(1, t + c)) + part(clean, max(c, 1) / max(1, t + c)))
        if g >= MIN_G:
            out[r.word] = (toxic, float(g))
    return out


def learn_lexicon(sample: DataFrame, max_terms: int | None = None, false_alarms: float = FALSE_ALARMS) -> Lexicon:
    """Terms, and what to think of their hits, from ``(label, text)``."""
    t, c = (sample.where(F.col("label") == x).count() for x in (1, 0))
    found = telling_units(sample, t, c)
    chosen = sorted(choose_terms({u: n for u, (n, _) in found.items()}), key=lambda x: (-found[x][1], x))
    terms = tuple(sorted({*SEED, *chosen[:MAX_TERMS if max_terms is None else max_terms]}))

    def forms(batches):
        lexicon = Lexicon(terms)
        for batch in batches:
            for part in text_slices(batch, 1):
                total: dict[tuple[str, str], list] = {}
                _, hits = all_counts([x or "" for x in part.column(1).to_pylist()], lexicon)
                for label, own in zip(part.column(0).to_pylist(), hits):
                    for key in {(term, lexicon.form(word, term, spent) if spent else term) for word, term, spent, _, _, cited in own if not cited}:
                        total.setdefault(key, [0, 0])[label == 1] += 1
                yield pa.RecordBatch.from_arrays([*(pa.array([k[i] for k in total], pa.string()) for i in (0, 1)),
                                                  *(pa.array([r[i] for r in total.values()], pa.int64()) for i in (0, 1))], ["term", "form", "clean", "toxic"])

    seen = (sample.mapInArrow(forms, "term string, form string, clean long, toxic long").groupBy("term", "form")
            .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).collect())  # words of the sample that are near terms
    exact = {r.term: (r.toxic, r.clean) for r in seen if r.form == r.term}
    weak = frozenset(x for x, (toxic, clean) in exact.items() if clean and log_odds(toxic, clean, t, c) < STRONG_ODDS)
    near = [r for r in seen if r.form != r.term]
    once = {x: 0 for x in terms}
    for r in near:
        once[r.term] += r.clean == 1 and r.toxic == 0
    doubted, rate = set(), 0.0
    for term in sorted(terms, key=lambda x: (once[x], x)):
        rate += once[term] / max(c, 1)
        if rate > false_alarms:
            doubted.add(term)
    return Lexicon(terms, frozenset(r.form for r in near if r.clean > r.toxic), frozenset(doubted), weak)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_terms: int | None = None,
        false_alarms: float = FALSE_ALARMS) -> Model:
    """Lexicon and weights from a bounded sample of labelled rows."""
    sample = written(labelled_sample(docs, labels, "toxic", id_col, text_col, held_out=held_out), "labelled", SAMPLE_FILES, dealt=True)
    lexicon = learn_lexicon(sample, max_terms, false_alarms)
    rows = map_text(sample, ["label", "text"], lambda b: (b.column(0), *all_counts([x or "" for x in b.column(1).to_pylist()], lexicon)[0].T),
                    "label int, a long, b long, c long, d long, e long").collect()
    got = np.array([tuple(r) for r in rows], np.int64).reshape(-1, 6)
    return Model(lexicon, fit_weights(got[:, 1:], (got[:, 0] == 1).astype(float)))


def score_counts(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return np.round(1 / (1 + np.exp(-np.clip(design(counts) @ weights, -30, 30))), 9)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, score double, n_exact, n_misspelled, n_quoted, n_direct)`` of every row."""
    kind = docs.schema[id_col].dataType.simpleString()
    lexicon, weights = model.lexicon, model.weights

    def kernel(batch):
        counts, _ = all_counts([t or "" for t in batch.column(1).to_pylist()], lexicon)
        return batch.column(0), score_counts(counts, weights), *counts[:, :STRONG].T

    return map_text(docs, [id_col, text_col], kernel, f"`{id_col}` {kind}, score double, n_exact long, n_misspelled long, n_quoted long, n_direct long")


def spans(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, word, term, edits, start, end, quoted)`` of every hit, with code-point offsets."""
    kind = docs.schema[id_col].dataType.simpleString()
    lexicon = model.lexicon

    def kernel(batch):
        _, hits = hit_counts([t or "" for t in batch.column(1).to_pylist()], lexicon)
        names = batch.column(0).to_pylist()
        rows = [(name, *h) for name, own in zip(names, hits) for h in own]
        return [list(x) for x in zip(*rows)] if rows else [[]] * 7

    return map_text(docs, [id_col, text_col], kernel, f"`{id_col}` {kind}, word string, term string, edits int, start int, end int, quoted boolean")

"""Secret scans through a trigram inverted index (operator 4).

From every rule's regular expression a Boolean query over trigrams is derived: the literal strings that a match must
contain, as ors of ands.  Each task builds, shard by shard, the inverted index of the trigrams that any query asks for
(posting lists of texts), evaluates the queries by intersecting and uniting posting lists, and runs a rule's expression on
its candidates only.  A rule without mandatory trigrams scans every text.

Trigrams are of UTF-8 bytes with A-Z lower-cased, so an index hit never misses a match in either case.

Defined results: null and empty texts have no spans (``redact`` leaves them as they are); offsets are code points, ends
exclusive; repeated rows are scanned each; null ids are kept; an empty table gives no rows; other columns are not read,
and ``redact`` returns them as they are.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass
from re import _constants as sre
from re import _parser as sre_parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vecframe.llm.common import map_text, text_buffer, text_slices

#: Strings that a part of an expression may stand for while they are still listed.
MAX_STRINGS = 64

ALL = True  # the query that every text fulfils


@dataclass(frozen=True)
class Rule:
    """An expression; a match counts if its ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    ignore_case: bool = False
    group: int = 0
    least: int = 0

    @functools.cached_property
    def regex(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.ignore_case else 0))

    def spans(self, text: str) -> list[tuple[int, int]]:
        return [m.span() for m in self.regex.finditer(text) if m.end(self.group) - m.start(self.group) >= self.least]


# The base rules in the order in which they are listed.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", True, 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", r"[0-9a-f]{16,}"),  # the runs of [0-9a-f]+ that are long enough
)
# A key in PEM form: from its header over base64 and header lines to the END line.  Lines may be indented, quoted, or set
# apart by blanks or written escapes.  Without an END line it goes as far as whole lines of base64, and long runs, do.
GAP = r"""(?:[\s>#*|"',;]|\\[nrt]?)*+"""
BREAK = r"""[\x20\t"',;]*+(?:(?:\r?\n|(?:\\r)?\\n)[\x20\t>#*|"']*+)++"""
LINE_END = r"""(?=[\x20\t"',;]*+(?:[\r\n\\]|\Z))"""
VALUE = r":(?:[^\r\n\\-]|-(?!----))*+"
PEM_KEY = ("-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"
           f"(?:(?:{GAP}(?:[A-Za-z][A-Za-z0-9-]*+{VALUE}|[A-Za-z0-9+/=]++))*+{GAP}-----END [A-Z ]{{0,20}}PRIVATE KEY-----"
           f"|(?:{GAP}[A-Za-z0-9]++(?:-[A-Za-z0-9]++)++{VALUE})*+"
           f"(?:{BREAK}[A-Za-z0-9+/=]++{LINE_END}|{GAP}[A-Za-z0-9+/=]{{32,}}+)*+)")
RULES = BASE + (
    Rule("private_key", PEM_KEY),
    Rule("hub_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
)


def fold(text: str) -> bytes:
    return bytes(c + 32 if 65 <= c <= 90 else c for c in text.encode())


def conjunction(parts):
    parts = [p for p in parts if p is not ALL]
    return ALL if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def disjunction(parts):
    parts = list(dict.fromkeys(parts))
    return ALL if any(p is ALL for p in parts) else parts[0] if len(parts) == 1 else ("or", tuple(parts))


def of_strings(strings: set[bytes]):
    """Texts with one of the strings: an or of ands of their trigrams."""
    return disjunction([conjunction([s[i:i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def characters(items) -> set[bytes] | None:
    """The characters of a class, if they are few."""
    out: set[bytes] = set()
    for op, arg in items:
        if op is sre.LITERAL:
            out.add(fold(chr(arg)))
        elif op is sre.RANGE and arg[1] - arg[0] < MAX_STRINGS:
            out |= {fold(chr(c)) for c in range(arg[0], arg[1] + 1)}
        else:
            return None
    return out if len(out) <= 8 else None


def analyse(parsed) -> tuple[set[bytes] | None, object]:
    """``(the strings that the expression stands for, if few; query that its matches fulfil)``."""
    open_strings: set[bytes] = {b""}  # what a match has just had, word for word
    exact, queries = True, []

    def flush():
        nonlocal open_strings, exact
        queries.append(of_strings(open_strings))
        open_strings, exact = {b""}, False

    for op, arg in parsed:
        strings, query = None, ALL
        if op is sre.LITERAL:
            strings = {fold(chr(arg))}
        elif op is sre.IN:
            strings = characters(arg)
        elif op is sre.SUBPATTERN:
            strings, query = analyse(arg[-1])
        elif op is sre.BRANCH:
            both = [analyse(x) for x in arg[1]]
            if all(s is not None for s, _ in both):
                strings = set().union(*(s for s, _ in both))
            query = disjunction([q for _, q in both])
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
            low, high, body = arg
            inner, inner_query = analyse(body)
            if inner is not None and (low, high) == (0, 1):
                strings = inner | {b""}
            elif inner is not None and low == high and len(inner) ** low <= MAX_STRINGS:
                strings = {b""}
                for _ in range(low):
                    strings = {a + b for a in strings for b in inner}
            elif low:
                query = inner_query
        elif op is sre.AT:
            continue
        if strings is not None and len(strings) * len(open_strings) <= MAX_STRINGS:
            open_strings = {a + b for a in open_strings for b in strings}
            continue
        flush()
        if strings is not None and len(strings) <= MAX_STRINGS:
            open_strings = strings
        else:
            queries.append(query)
    if exact:
        return open_strings, of_strings(open_strings)
    flush()
    return None, conjunction(queries)


def trigram_query(rule: Rule):
    """The Boolean trigram query of a rule: ``ALL``, a trigram, or ``("and" | "or", parts)``."""
    return analyse(sre_parser.parse(rule.pattern, re.ASCII | (re.IGNORECASE if rule.ignore_case else 0)))[1]


def trigrams(query) -> set[bytes]:
    return set() if query is ALL else {query} if isinstance(query, bytes) else set().union(*map(trigrams, query[1]))


class Index:
    """Inverted indexes over shards for the trigrams of some rules."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        self.queries = [trigram_query(r) for r in rules]
        self.terms = sorted(set().union(*map(trigrams, self.queries)))
        self.number = {t: i + 1 for i, t in enumerate(self.terms)}
        self.table = np.zeros(1 << 24, np.uint8 if len(self.terms) < 256 else np.uint16)
        for t, i in self.number.items():
            self.table[t[0] << 16 | t[1] << 8 | t[2]] = i

    def postings(self, column: pa.Array) -> dict[bytes, np.ndarray]:
        """Texts (ascending) by trigram."""
        raw, at = text_buffer(column)
        if len(raw) < 3:
            return {}
        data = np.frombuffer(raw, np.uint8)
        code = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint32)
        term = self.table[code[:-2] << 16 | code[1:-1] << 8 | code[2:]]
        where = np.flatnonzero(term)
        text = np.searchsorted(at, where, "right") - 1
        inside = where + 3 <= at[text + 1]
        pair = np.unique(term[where[inside]].astype(np.int64) * len(column) + text[inside])
        of, text = pair // len(column), pair % len(column)
        cut = np.searchsorted(of, np.arange(1, len(self.terms) + 2))
        return {t: text[cut[i - 1]:cut[i]] for t, i in self.number.items()}

    def candidates(self, query, postings: dict[bytes, np.ndarray], n: int) -> np.ndarray:
        if query is ALL:
            return np.arange(n)
        none = np.zeros(0, np.int64)
        if isinstance(query, bytes):
            return postings.get(query, none)
        parts = [self.candidates(q, postings, n) for q in query[1]]
        if query[0] == "or":
            return np.unique(np.concatenate(parts))
        return functools.reduce(lambda a, b: np.intersect1d(a, b, assume_unique=True), sorted(parts, key=len))

    def scan(self, column: pa.Array) -> list[list[tuple[int, int, int]]]:
        """For each text its spans ``(start, rank of the rule, end)``, in order."""
        texts = column.to_pylist()
        out: list = [[] for _ in texts]
        postings = self.postings(column)
        for rank, (rule, query) in enumerate(zip(self.rules, self.queries)):
            for i in self.candidates(query, postings, len(texts)).tolist():
                if texts[i]:
                    out[i] += [(a, rank, b) for a, b in rule.spans(texts[i])]
        for own in out:
            own.sort()
        return out


@functools.lru_cache(maxsize=4)
def index_of(rules: tuple[Rule, ...]) -> Index:
    return Index(rules)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, spans array<struct<kind, start, end>>)`` of every row, by start and then by the rules' order."""
    kind = docs.schema[id_col].dataType.simpleString()

    def kernel(batch):
        found = index_of(rules).scan(batch.column(1))
        return batch.column(0), [[{"kind": rules[r].kind, "start": a, "end": b} for a, r, b in own] for own in found]

    return map_text(docs, [id_col, text_col], kernel, f"`{id_col}` {kind}, spans array<struct<kind: string, start: int, end: int>>")


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", length_col: str = "n_chars", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced by ``mark`` (overlapping spans by one), and the lengths of changed texts."""
    at = docs.columns.index(text_col)
    length = docs.columns.index(length_col) if length_col in docs.columns else None

    def clean(text: str, spans) -> str:
        parts, done = [], 0
        for a, _, b in spans:
            if a >= done:
                parts += [text[done:a], mark]
            done = max(done, b)
        return "".join([*parts, text[done:]])

    def run(batches):
        index = index_of(rules)
        for batch in batches:
            for part in text_slices(batch, at):
                found = index.scan(part.column(at))
                if not any(found):
                    yield part
                    continue
                texts = part.column(at).to_pylist()
                columns = part.columns
                sizes = columns[length].to_pylist() if length is not None else None
                for i, spans in enumerate(found):
                    if spans:
                        texts[i] = clean(texts[i], spans)
                        if sizes is not None:
                            sizes[i] = len(texts[i])
                columns[at] = pa.array(texts, columns[at].type)
                if sizes is not None:
                    columns[length] = pa.array(sizes, columns[length].type)
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return docs.mapInArrow(run, docs.schema)

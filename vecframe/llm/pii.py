"""Personal data and the terms that give it away (operator 11, DataFrame functions only).

Protected entities are the values that four patterns find (email, ip, card, phone).  The corpus then tells which terms
disclose them: of every mention of an entity the words near it are counted, and so is every such word in the whole corpus.
With ``c(e)`` mentions of entity ``e``, ``c(t)`` occurrences of term ``t``, ``c(e, t)`` mentions of ``e`` with ``t`` near
and ``W`` words in all, the information of ``e`` is ``IC(e) = log2(W / c(e))`` and what ``t`` tells of it is
``PMI(e; t) = log2(c(e, t) W / (c(e) c(t)))``, at most ``IC(e)``.  A term whose share ``PMI / IC`` reaches the disclosure
threshold for any entity, in at least ``support`` different surroundings, is disclosing wherever it stands.  It is
generalised to the words that begin like it if that class discloses less than the threshold, else it is removed.

Matches are marked in the text by one replacement a kind and cut at the marks, so that offsets are running sums of
lengths; the sums are made in chunks, so a text with many matches takes time in proportion.  Patterns are possessive
and begin where a run of their characters begins, so that long runs without a match are read once, with the same matches.

Defined results: a null text counts as empty, an empty text has no spans; equal texts have equal spans; spans of one kind
never overlap, those of different kinds may; a term inside an email is no span of its own; the decision for a term
does not depend on row order, and terms that tie are all kept; null and repeated ids are as any; an empty table gives no
rows; other columns are not read.  Texts are worked on whole; a term has 4 to 40 letters.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecframe.llm.common import lookup_join, written

KINDS = ["email", "ip", "card", "phone"]
#: What a span of a term is called: what happens to it.
GENERALISE, REMOVE = "generalise", "remove"

LOCAL, LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
PATTERNS = {
    # \G: right after a match a new one may begin inside a run
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@{LABEL}++(?:\.{LABEL}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
IP = rf"^{PART}(?:\.{PART}){{3}}$"

#: A text without this has no match.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}

MARK, OTHER = "\x01", "\x02"
#: Lengths that are summed in one go.
CHUNK = 256

#: Characters before and after a mention that are read for terms.
WINDOW = 100
LETTERS = r"[^\p{L}]+"
SHORTEST, LONGEST = 4, 40
#: Share of an entity's information from which a term discloses it.
THRESHOLD = 0.9
#: Different surroundings in which a term stands with an entity at least.
SUPPORT = 3
#: A term is generalised to its first letters.
BEGINNING = 3
#: Tables of up to so many rows, and patterns of up to so many characters in all, are broadcast.
BROADCAST_ROWS, BROADCAST_CHARS = 100_000, 16_000_000


def digits(value: Column, signs: str) -> Column:
    return F.translate(value, signs, "")


def luhn(number: Column) -> Column:
    back = F.reverse(number)
    twice = F.translate(back, "0123456789", "0246813579")
    digit = lambda i: F.when(i % 2 == 0, F.substring(twice, i, F.lit(1))).otherwise(F.substring(back, i, F.lit(1))).cast("int")
    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), lambda total, i: total + digit(i)) % 10 == 0


def passes(kind: str, value: Column) -> Column:
    """Whether a match of the kind's pattern is one of its values."""
    if kind == "ip":
        return value.rlike(IP)
    if kind == "card":
        number = digits(value, " -")
        return F.when(F.length(number).between(13, 19), luhn(number)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits(value, "+ ().-")).between(9, 15)
    return F.lit(True)


def normal(kind: str, value: Column) -> Column:
    """One name for all ways to write a value."""
    plain = {"email": F.lower(value), "ip": value, "card": digits(value, " -"), "phone": digits(value, "+ ().-")}[kind]
    return F.concat(F.lit(f"{kind}:"), plain)


def unmarked(text: Column) -> Column:
    """The text without the sign that marks matches (no pattern has it or its stand-in)."""
    whole = F.coalesce(text, F.lit(""))
    return F.when(F.contains(whole, F.lit(MARK)), F.translate(whole, MARK, OTHER)).otherwise(whole)


def cut(df: DataFrame, name: str, text: str, pattern, when: Column | None = None) -> DataFrame:
    """``df`` with ``<name>_parts``, what lies between matches and the matches in turns, and ``<name>_ends``, where each
    part ends (null where nothing matches)."""
    parts, ends, sizes, starts = (f"{name}_{x}" for x in ("parts", "ends", "sizes", "starts"))
    found = F.split(F.regexp_replace(F.col(text), pattern if isinstance(pattern, Column) else F.lit(pattern), F.lit(f"{MARK}$0{MARK}")), MARK)
    found = F.when(F.lit(True) if when is None else when, found)
    some = F.size(parts) > 1
    df = df.withColumn(parts, found).withColumn(sizes, F.when(some, F.transform(parts, F.length)))
    last = F.floor((F.size(sizes) - 1) / CHUNK).cast("int")
    begin = lambda c: F.slice(sizes, c * CHUNK + 1, F.lit(CHUNK))
    whole = F.transform(F.sequence(F.lit(0), last), lambda c: F.aggregate(begin(c), F.lit(0), lambda a, x: a + x))
    running = lambda values, first: F.aggregate(values, F.array(first), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))
    df = df.withColumn(starts, F.when(F.size(sizes) > 0, running(whole, F.lit(0))))
    sums = F.flatten(F.transform(F.sequence(F.lit(0), last), lambda c: F.slice(running(begin(c), F.get(starts, c)), F.lit(2), F.lit(CHUNK))))
    return df.withColumn(ends, F.when(F.size(sizes) > 0, sums)).drop(sizes, starts)


def matches(name: str, fields) -> Column:
    """Of a cut text one struct a match: ``fields(start, end, value, gap before, gap after)``."""
    parts, ends = f"{name}_parts", f"{name}_ends"
    one = lambda i: F.struct(*fields(F.get(ends, 2 * i), F.get(ends, 2 * i + 1), F.get(parts, 2 * i + 1), F.get(parts, 2 * i), F.get(parts, 2 * i + 2)))
    many = F.transform(F.sequence(F.lit(0), F.floor(F.size(parts) / 2).cast("int") - 1), one)
    return F.when(F.size(ends) > 0, many)


SPANS = "array<struct<kind:string,start:int,end:int>>"


def base_cut(df: DataFrame, text: str) -> DataFrame:
    for kind in KINDS:
        needs = F.contains(F.col(text), F.lit(NEEDS[kind])) if kind in NEEDS else None
        df = cut(df, kind, text, PATTERNS[kind], needs)
    return df


def base_spans(kind: str) -> Column:
    found = matches(kind, lambda start, end, value, before, after: [F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), passes(kind, value).alias("good")])
    return F.coalesce(F.transform(F.filter(found, lambda s: s.good), lambda s: F.struct(s.kind, s.start, s.end)), F.array().cast(SPANS))


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), LETTERS), lambda w: F.length(w).between(SHORTEST, LONGEST))


def beginning(word: Column) -> Column:
    return F.substring(word, 1, BEGINNING)


def surroundings(kind: str) -> Column:
    """Of a cut text the entity and near words of every value; words that the window cuts are left out."""
    def fields(start, end, value, before, after):
        left = F.when(F.length(before) > WINDOW, F.regexp_replace(F.right(before, F.lit(WINDOW)), r"^\p{L}+", "")).otherwise(before)
        right = F.when(F.length(after) > WINDOW, F.regexp_replace(F.left(after, F.lit(WINDOW)), r"\p{L}+$", "")).otherwise(after)
        return [normal(kind, value).alias("entity"), F.concat_ws(" ", left, right).alias("near"), passes(kind, value).alias("good")]

    found = matches(kind, fields)
    return F.coalesce(F.transform(F.filter(found, lambda s: s.good), lambda s: F.struct(s.entity, s.near)), F.array().cast("array<struct<entity:string,near:string>>"))


def mentions(docs: DataFrame, text_col: str) -> DataFrame:
    """``(entity, near array<string>, surrounding)`` of every value of every text."""
    text = base_cut(docs.select(unmarked(F.col(text_col)).alias("text")), "text")
    found = text.select(F.explode(F.concat(*[surroundings(k) for k in KINDS])).alias("m"))
    return found.select("m.entity", F.array_sort(F.array_distinct(words(F.col("m.near")))).alias("near"), F.xxhash64("m.near").alias("surrounding"))


def counts(docs: DataFrame, asked: DataFrame, text_col: str) -> DataFrame:
    """``(beginning, word, n)`` over the words of all texts: ``word`` where it is asked for, ``beginning`` where that of an
    asked word is; null otherwise, so the sum of ``n`` is the number of words."""
    every = docs.select(F.explode(words(F.coalesce(F.col(text_col), F.lit("")))).alias("w"))
    few = asked.count() <= BROADCAST_ROWS
    if few:
        every = every.withColumn("n", F.lit(1).cast("long"))
        side = F.broadcast
    else:  # one row a word is joined then, not one an occurrence
        every = every.groupBy("w").agg(F.count(F.lit(1)).alias("n"))
        side = lambda df: df
    known = side(asked.select(F.col("term").alias("word")))
    firsts = side(asked.select(beginning(F.col("term")).alias("beginning")).distinct())
    found = every.join(firsts, beginning(F.col("w")) == F.col("beginning"), "left").join(known, F.col("w") == F.col("word"), "left")
    return found.groupBy("beginning", "word").agg(F.sum("n").alias("n"))


def disclosing(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD, support: int = SUPPORT) -> DataFrame:
    """``(term, share double, action)``: terms that disclose an entity, the largest share of one's information that they
    tell, and whether their beginning may stay."""
    seen = written(mentions(docs, text_col), "mentions")
    near = seen.select("entity", "surrounding", F.explode("near").alias("term"))
    # different surroundings first: a copied one adds to the mentions, not to the support
    pairs = (near.groupBy("entity", "term", "surrounding").agg(F.count(F.lit(1)).alias("n"))
             .groupBy("entity", "term").agg(F.sum("n").alias("both"), F.count(F.lit(1)).alias("support")).where(F.col("support") >= support))
    pairs = written(pairs.drop("support"), "pairs")
    asked = pairs.select("term").distinct()
    total = written(counts(docs, asked, text_col), "words")
    w = total.agg(F.sum("n")).first()[0] or 0
    entities = seen.groupBy("entity").agg(F.count(F.lit(1)).alias("mentions"))
    first = seen.select("entity", F.explode(F.array_distinct(F.transform("near", beginning))).alias("beginning"))
    class_pairs = first.groupBy("entity", "beginning").agg(F.count(F.lit(1)).alias("class_both"))
    in_class = total.where("beginning is not null").groupBy("beginning").agg(F.sum("n").alias("class_all"))
    terms = total.where("word is not null").select(F.col("word").alias("term"), F.col("n").alias("all"))
    share = lambda both, every: 1 + F.log2(F.col(both) / F.col(every)) / F.log2(F.lit(float(w)) / F.col("mentions"))
    told = (pairs.join(entities, "entity").join(terms, "term").where(F.col("mentions") < w).withColumn("share", F.least(F.lit(1.0), share("both", "all")))
            .where(F.col("share") >= threshold).withColumn("beginning", beginning(F.col("term")))
            .join(class_pairs, ["entity", "beginning"]).join(in_class, "beginning")
            .withColumn("class_share", F.least(F.lit(1.0), share("class_both", "class_all"))))
    action = F.when(F.max("class_share") < threshold, F.lit(GENERALISE)).otherwise(F.lit(REMOVE))
    return told.groupBy("term").agg(F.max("share").alias("share"), action.alias("action"))


def term_hits(docs: DataFrame, terms: DataFrame, text_col: str, few: bool) -> DataFrame:
    """``(digest, pattern, removed array<string>)`` of the texts that hold terms."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    every = docs.select(F.sha2(text, 256).alias("digest"), F.explode(F.array_distinct(words(text))).alias("term"))
    met = every.join(F.broadcast(terms) if few else terms, "term").select("digest", "term", "action")
    found = met.groupBy("digest").agg(F.sort_array(F.collect_set("term")).alias("terms"),
                                      F.collect_set(F.when(F.col("action") == REMOVE, F.col("term"))).alias("removed"))
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join("terms", "|"), F.lit(r")(?!\p{L})"))
    return found.select("digest", pattern.alias("pattern"), "removed")


@dataclass
class Found:
    """The rows with their spans, and the terms that the corpus has given."""

    rows: DataFrame
    terms: DataFrame


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, support: int = SUPPORT) -> Found:
    """``(id, text, spans array<struct<kind, start, end>>)`` of every row: base spans by kind and start, then terms by
    action and start; code points, the end is the first after the span."""
    terms = written(disclosing(docs, text_col, threshold, support), "terms")
    n = terms.count()
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    none = F.array().cast(SPANS)
    if n:
        hits = written(term_hits(docs, terms, text_col, n <= BROADCAST_ROWS), "hits")
        rows = rows.withColumn("digest", F.sha2("text", 256))
        found, chars = hits.agg(F.count(F.lit(1)), F.coalesce(F.sum(2 * F.length("pattern")), F.lit(0))).first()  # the removed terms are part of it
        few = found <= BROADCAST_ROWS and chars <= BROADCAST_CHARS
        rows = rows.join(F.broadcast(hits), "digest", "left") if few else lookup_join(rows, hits, "digest")
    work = base_cut(rows.withColumn("work", unmarked(F.col("text"))), "work")
    if n:
        # an email is one blank of its length, so that no term is found in it
        hidden = F.array_join(F.transform(F.col("email_parts"), lambda p, i: F.when(i % 2 == 1, F.repeat(F.lit(OTHER), F.length(p))).otherwise(p)), "")
        work = work.withColumn("plain", F.coalesce(F.when(F.col("pattern").isNotNull(), hidden), F.col("work")))
        work = cut(work, "term", "plain", F.coalesce(F.col("pattern"), F.lit("")), F.col("pattern").isNotNull())
        kind = lambda value: F.when(F.array_contains("removed", F.lower(value)), F.lit(REMOVE)).otherwise(F.lit(GENERALISE))
        of_terms = F.coalesce(matches("term", lambda start, end, value, before, after: [kind(value).alias("kind"), start.alias("start"), end.alias("end")]), none)
        work = work.withColumn("of_terms", of_terms)
        more = [F.filter("of_terms", lambda s: s.kind == GENERALISE), F.filter("of_terms", lambda s: s.kind == REMOVE)]
    else:
        more = []
    spans = F.concat(*[base_spans(k) for k in KINDS], *more)
    return Found(work.select(id_col, "text", spans.alias("spans")), terms)


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, support: int = SUPPORT) -> DataFrame:
    """``(id, text)`` of every row, without what the spans cover: ``[EMAIL]`` and so on, ``[TERM]`` for removed terms, and the
    first letters with ``*`` for generalised ones; overlapping spans go as one, named by the first."""
    found = scan(docs, id_col, text_col, threshold, support).rows
    order = F.array_sort(F.transform("spans", lambda s: F.struct(s.start, s.end, s.kind)))
    letters = F.split("text", "")
    merged = F.aggregate(order, F.array().cast("array<struct<start:int,end:int,kind:string>>"), lambda out, s: F.when(
        (F.size(out) > 0) & (F.element_at(out, -1).end > s.start),
        F.concat(F.slice(out, F.lit(1), F.size(out) - 1), F.array(F.struct(F.element_at(out, -1).start.alias("start"), F.greatest(F.element_at(out, -1).end, s.end).alias("end"),
                                                                          F.element_at(out, -1).kind.alias("kind"))))).otherwise(F.concat(out, F.array(s))))
    rows = found.withColumn("gone", F.when(F.size("spans") > 0, merged)).withColumn("letters", F.when(F.size("spans") > 0, letters))
    piece = lambda start, end: F.array_join(F.slice("letters", start + 1, F.greatest(end - start, F.lit(0))), "")
    name = lambda s: F.when(s.kind == GENERALISE, F.concat(piece(s.start, s.start + BEGINNING), F.lit("*"))).otherwise(
        F.concat(F.lit("["), F.when(s.kind == REMOVE, F.lit("TERM")).otherwise(F.upper(s.kind)), F.lit("]")))
    ends = F.transform("gone", lambda s, i: F.concat(piece(F.when(i > 0, F.get("gone", i - 1).end).otherwise(F.lit(0)), s.start), name(s)))
    rest = piece(F.element_at("gone", -1).end, F.size("letters"))
    return rows.select(id_col, F.coalesce(F.concat(F.array_join(ends, ""), rest), F.col("text")).alias("text"))

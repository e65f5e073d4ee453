"""Document fingerprints by SimHash (operator 7, DataFrame functions only).

A text's terms are its neighbouring word pairs (the last word stands alone); a term weighs as many votes as it has
characters, 16 at most, for every time that it occurs.  Each of the 64 bits of a term's hash votes for or against the same bit of the fingerprint, and the
weighted majority wins.  The votes of two bits share one 64-bit sum (32 bits each), so a text's votes are 32 sums of one
aggregate with map-side combination; only those sums are shuffled.

``within`` finds fingerprints near to given ones: a table for each choice of agreeing blocks holds the fingerprints with
their bits permuted so that these blocks come first; the leading bits are the join key and the Hamming distance is
verified.  By the pigeonhole principle no pair within the radius is missed.

The next document is found without a global sort in one task: a range shuffle of ids, ``lead`` inside each range, and the
first id of the next range that has any (one row a range).

Defined results: a null text counts as empty; an empty text has fingerprint 0; equal texts have equal fingerprints; null
ids come first, equal ids are ordered by their texts' hash, and equal rows follow each other (they are worked on once, and
counted); a table of one row has itself as the next document; an empty table
gives no rows; other columns are not read.  Texts of up to 2**28 words cannot overflow the votes.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vecframe.llm.common import files_for, written

#: Votes that one occurrence of a term has at most.
MAX_WEIGHT = 16
LANES = 32
PAIR = (1 << 32) | 1  # the lowest bit of either half

KEY = ["kd", "kn", "h"]
#: A row's own text; the edited text of the last of equal rows, and that of one that an equal row follows.
OWN, LAST, FOLLOWED = -1, 0, 1


def terms(text: Column) -> Column:
    """``array<struct<a, b>>``: every word with the one after it (null after the last)."""
    words = F.split(F.translate(text, "\n\r\t", "   "), " ")
    return F.arrays_zip(words.alias("a"), F.slice(words, F.lit(2), F.size(words)).alias("b"))


def votes(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys`` with the 32 packed sums and the total weight of each text; rows with equal keys are one text."""
    pairs = rows.select(*keys, F.explode(terms(F.col(text))).alias("t"))
    weight = F.least(F.lit(MAX_WEIGHT), F.length("t.a") + F.coalesce(F.length("t.b"), F.lit(0))).cast("long")
    hashed = pairs.select(*keys, F.xxhash64("t.a", "t.b").alias("hash"), weight.alias("w"))
    lanes = [F.sum(F.shiftrightunsigned("hash", j).bitwiseAND(F.lit(PAIR)) * F.col("w")).alias(f"v{j}") for j in range(LANES)]
    return hashed.groupBy(*keys).agg(*lanes, F.sum("w").alias("total"))


def majority() -> Column:
    """The fingerprint of packed sums ``v0 .. v31`` and ``total``."""
    bits = []
    for j in range(LANES):
        low, high = F.col(f"v{j}").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned(f"v{j}", 32)
        for bit, ayes in ((j, low), (j + 32, high)):
            one = (1 << bit) - (1 << 64 if bit == 63 else 0)
            bits.append(F.when(ayes * 2 > F.col("total"), F.lit(one).cast("long")).otherwise(F.lit(0).cast("long")))
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fp long)`` of every row."""
    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return votes(rows, ["id", "row"], "text").select(F.col("id").alias(id_col), majority().alias("fp"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("kd"), F.col(id_col).isNotNull().cast("int").alias("kn"),
                       F.xxhash64(text).alias("h"), text.alias("text"))


def successors(rows: DataFrame, files: int) -> DataFrame:
    """Each distinct key with the next one, ascending and round: ``(kd, kn, h, m, n, nd, nn, nh)``; ``m`` rows have the key,
    and texts of ``n`` characters."""
    order = ["kn", "kd", "h"]
    tally = rows.select("kn", "kd", "h", F.length("text").alias("n")).groupBy(*order).agg(F.count(F.lit(1)).alias("m"), F.max("n").alias("n"))
    ranged = tally.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    inside = Window.partitionBy("part").orderBy(*order)
    step = written(ranged.select("*", F.lead(F.struct(*order)).over(inside).alias("next")), "order", files)
    # one row a range: its first key is what follows the range before
    firsts = step.groupBy("part").agg(F.min(F.struct(*order)).alias("first"))
    over = Window.orderBy("part")
    after = firsts.select(F.col("part").alias("of"), F.coalesce(
        F.lead("first").over(over), F.first("first").over(over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("after"))
    follow = F.coalesce("next", "after")
    return step.join(F.broadcast(after), F.col("part") == F.col("of")).select(
        *KEY, "m", "n", follow["kd"].alias("nd"), follow["kn"].alias("nn"), follow["h"].alias("nh"))


def edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every distinct row's text, and that text with its last quarter replaced by the first characters of the next row, which is
    another (``edited``) or, for all but the last of equal rows, an equal one (``same``):
    ``(kd, kn, h, m, nd, nn, nh, n, text, edited, same)``."""
    rows = keyed(docs, id_col, text_col)
    files = files_for(docs.count())
    chain = written(successors(rows, files), "successors", files)
    # equal rows are one before their texts are shuffled; each text is shuffled once, all joins use this partitioning
    texts = rows.groupBy(*KEY).agg(F.first("text").alias("text"))
    quarter = F.floor(F.col("n") / 4).cast("int")
    asked = chain.select(F.col("nd").alias("kd"), F.col("nn").alias("kn"), F.col("nh").alias("h"), F.struct(*KEY).alias("by"), quarter.alias("q"))
    pieces = texts.join(asked, KEY).select("by.kd", "by.kn", "by.h", F.substring("text", F.lit(1), F.col("q")).alias("piece"))
    joined = texts.join(chain, KEY).join(pieces, KEY)
    # floor(n / 4) code points leave, so n - floor(n / 4) stay
    kept = F.substring("text", F.lit(1), F.col("n") - quarter)
    return joined.select(*KEY, "m", "nd", "nn", "nh", "n", "text", F.concat(kept, F.col("piece")).alias("edited"),
                         F.when(F.col("m") > 1, F.concat(kept, F.substring("text", F.lit(1), quarter))).alias("same"))


def compared(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_chars, edited_sha256, fp, edited_fp, near_edited, near_next)`` of every row."""
    rows = edited(docs, id_col, text_col)
    bodies = F.array(*[F.struct(F.lit(which).alias("which"), F.col(c).alias("body")) for which, c in ((OWN, "text"), (LAST, "edited"), (FOLLOWED, "same"))])
    both = rows.select(*KEY, "m", "nd", "nn", "nh", "n", F.explode(F.filter(bodies, lambda v: v.body.isNotNull())).alias("v"))
    carried = [*KEY, "m", "nd", "nn", "nh", "n", "sha", "which"]
    both = both.select(*KEY, "m", "nd", "nn", "nh", "n", F.when(F.col("v.which") != OWN, F.sha2("v.body", 256)).alias("sha"), "v.which", "v.body")
    marks = written(votes(both, carried, "body").select(*carried, majority().alias("fp")), "fingerprints", files_for(2 * docs.count()), dealt=True)
    own = marks.where(F.col("which") == OWN).select(*KEY, F.col("fp").alias("own_fp"))
    follow = own.select(F.col("kd").alias("nd"), F.col("kn").alias("nn"), F.col("h").alias("nh"), F.col("own_fp").alias("next_fp"))
    alike = F.col("which") == FOLLOWED
    after = marks.where(F.col("which") != OWN).select(
        *KEY, "n", F.col("sha").alias("edited_sha256"), F.col("fp").alias("edited_fp"), F.when(alike, F.col("m") - 1).otherwise(F.lit(1)).alias("times"),
        *[F.when(alike, F.col(k)).otherwise(F.col(c)).alias(c) for k, c in zip(KEY, ("nd", "nn", "nh"))])
    found = after.join(own, KEY).join(follow, ["nd", "nn", "nh"])
    kind = docs.schema[id_col].dataType
    found = found.select(F.when(F.col("kn") == 1, F.col("kd")).cast(kind).alias(id_col), F.col("n").cast("long").alias("n_chars"), "edited_sha256",
                         F.col("own_fp").alias("fp"), "edited_fp", likeness(F.col("own_fp"), F.col("edited_fp")).alias("near_edited"),
                         likeness(F.col("own_fp"), F.col("next_fp")).alias("near_next"), "times")
    return found.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times").cast("long")))).drop("times", "row")


def block_tables(radius: int, blocks: int) -> list[list[tuple[int, int]]]:
    """For each table the blocks ``(lowest bit, bits)`` that come first: every choice of ``blocks - radius`` blocks."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [(edges[i], edges[i + 1] - edges[i]) for i in range(blocks)]
    return [list(c) for c in combinations(parts, blocks - radius)]


def leading_bits(fp: Column, table: list[tuple[int, int]]) -> Column:
    """The bits of a table's blocks, packed: what the permuted fingerprint begins with."""
    out, at = F.lit(0).cast("long"), 0
    for low, size in table:
        out = out.bitwiseOR(F.call_function("shiftleft", F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << size) - 1)), F.lit(at)))
        at += size
    return out


def within(queries: DataFrame, stored: DataFrame, radius: int = 3, blocks: int | None = None) -> DataFrame:
    """``(query, fp, bits)``: every distinct fingerprint of ``stored.fp`` within ``radius`` bits of a distinct ``queries.fp``."""
    tables = block_tables(radius, blocks or radius + 2)

    def entries(df, name):
        one = df.select(F.col("fp").alias(name)).where("fp is not null").distinct()
        keys = F.array(*[F.struct(F.lit(i).alias("t"), leading_bits(F.col(name), t).alias("k")) for i, t in enumerate(tables)])
        return one.select(name, F.explode(keys).alias("e")).select(name, "e.t", "e.k")

    met = entries(queries, "query").join(entries(stored, "fp"), ["t", "k"])
    bits = F.bit_count(F.col("query").bitwiseXOR(F.col("fp")))
    return met.where(bits <= radius).select("query", "fp", bits.alias("bits")).distinct()

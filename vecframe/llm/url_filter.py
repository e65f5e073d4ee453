"""URL rules looked up in Bloom filter cascades (operator 1, DataFrame functions only).

A rule is a host and a path prefix, written as one string (``example.net/en/``).  The keys under which a url could be
listed are its host's suffixes (at dots), each followed by the beginnings of its path that are as long as some rule's path.
The key universe is the set of all such keys of the corpus.  A cascade makes membership exact over that universe: level 0
is a Bloom filter of the listed keys, level 1 one of the universe's other keys that level 0 lets pass, level 2 one of the
listed keys that level 1 lets pass, and so on until nothing passes wrongly.  Looking a key up is an expression over
constant bit arrays; urls are not joined with anything.

Level 0 is sized so that about as many other keys pass as there are listed ones, and each further level halves what is
left, so the filters grow with the list, not with the corpus.  Only their bits go through the driver.

Defined results: a null url, or one without ``://``, has an empty host and path and no rule (unless a rule has an empty
host and path); among rules of one length that with the longer host wins, then block; repeated rows are judged each; null ids
are kept; an empty table or an empty list gives no rule; columns that clash with the results are replaced, other columns are kept.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecframe.llm.common import files_for, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """From behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    found = F.when(F.instr(url, "://") > 0, F.regexp_extract(rest_of(url), "^[^/?#]*", 0)).otherwise("")
    return F.translate(F.coalesce(found, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.when(F.instr(url, "://") > 0, F.regexp_extract(rest_of(url), "^[^/?#]*([^?#]*)", 1)).otherwise(""), F.lit(""))


def rest_of(url: Column) -> Column:
    return F.substring(url, F.instr(url, "://") + 3, F.length(url))


def candidate_keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """``array<struct<host, key>>``: every suffix of the host with every beginning of the path of one of ``lengths``."""
    labels = F.split(host, "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    sizes = F.array(*[F.lit(n) for n in lengths]) if lengths else F.array().cast("array<int>")
    return F.flatten(F.transform(suffixes, lambda s: F.transform(
        F.filter(sizes, lambda n: n <= F.length(path)), lambda n: F.struct(s.alias("host"), F.concat(s, F.substring(path, F.lit(1), n)).alias("key")))))


def positions(key: Column, bits: int, hashes: int, level: int) -> Column:
    """The bits of a key in the filter of a level."""
    return F.array(*[F.pmod(F.xxhash64(key, F.lit(level), F.lit(j)), F.lit(bits)) for j in range(hashes)])


def one_bit(p: Column) -> Column:
    """Bit ``p`` mod 64 of a word."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), p.bitwiseAND(F.lit(63)).cast("int"))


@dataclass
class Bloom:
    bits: int
    hashes: int
    level: int
    words: list[int]

    def passes(self, key: Column) -> Column:
        # one string becomes one constant array when the plan is optimized
        words = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")
        at = positions(key, self.bits, self.hashes, self.level)
        return F.forall(at, lambda p: F.get(words, F.shiftright(p, 6).cast("int")).bitwiseAND(one_bit(p)) != 0)


def bloom(keys: DataFrame, n: int, rate: float, level: int) -> Bloom:
    """Filter of the ``n`` keys that lets other keys pass at ``rate``."""
    hashes = max(1, round(-math.log2(rate)))
    bits = max(64, math.ceil(n * -math.log2(rate) / math.log(2)))
    p = F.col("p")
    rows = (keys.select(F.explode(positions(F.col("key"), bits, hashes, level)).alias("p"))
            .groupBy(F.shiftright(p, 6).alias("w"))
            .agg(F.bit_or(one_bit(p)).alias("b")).collect())
    words = [0] * (bits // 64 + 1)
    for w, b in rows:
        words[w] = b
    return Bloom(bits, hashes, level, words)


@dataclass
class Cascade:
    levels: list[Bloom]

    def contains(self, key: Column) -> Column:
        """Exact for listed keys and all keys of the universe."""
        if not self.levels:
            return F.lit(False)
        found = F.lit(len(self.levels) % 2 == 1)  # what passes the last level is what it encodes
        for i in range(len(self.levels) - 1, -1, -1):
            fails = F.lit(i % 2 == 1)
            found = F.when(self.levels[i].passes(key), found).otherwise(fails)
        return found


def cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """Cascade of ``listed.key`` over ``universe.key`` (both distinct)."""
    size = universe.count()
    listed = written(listed.select("key").distinct(), "listed", files_for(size))
    n = listed.count()
    if not n:
        return Cascade([])
    rate = min(0.5, max(2.0 ** -30, n / (math.sqrt(2) * max(1, size))))
    levels = [bloom(listed, n, rate, 0)]
    inside = listed
    outside = written(universe.where(levels[0].passes(F.col("key"))).join(listed, "key", "left_anti"), "passing", files_for(size))
    while (n := outside.count()):
        levels.append(bloom(outside, n, 0.5, len(levels)))
        # what the new level should stop, and does not
        inside, outside = outside, written(inside.where(levels[-1].passes(F.col("key"))), "passing", files_for(size))
    return Cascade(levels)


@dataclass
class UrlFilter:
    block: Cascade
    allow: Cascade
    lengths: list[int]

    def judge(self, pages: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
        """``pages`` with ``host``, ``path``, ``rule`` (null where none fits) and ``verdict``."""
        host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
        keys = candidate_keys(F.col("host"), F.col("path"), self.lengths)
        listed = F.filter(F.transform(keys, lambda k: F.struct(
            F.length(k.key).alias("n"), F.length(k.host).alias("h"),
            F.when(self.block.contains(k.key), "block").when(self.allow.contains(k.key), "allow").alias("verdict"), k.key.alias("key"))),
            lambda k: k.verdict.isNotNull())
        rows = pages.withColumns({"host": host, "path": path})
        best = F.array_max(listed)
        return (rows.withColumn("__vf_best", best).withColumns({"rule": F.col("__vf_best.key"), "verdict": F.coalesce("__vf_best.verdict", F.lit(default))})
                .drop("__vf_best"))


def build(pages: DataFrame, block: DataFrame, allow: DataFrame, url_col: str = "url") -> UrlFilter:
    """Filters for rules ``(host, path)`` over the keys of all urls of ``pages``."""
    def keyed(rules):
        return rules.select(F.concat(F.translate("host", UPPER, LOWER), "path").alias("key"), F.length("path").alias("n"))

    block, allow = keyed(block), keyed(allow)
    lengths = sorted(r[0] for r in block.select("n").union(allow.select("n")).distinct().collect())  # lengths of paths: few
    urls = pages.select(host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    keys = urls.select(F.explode(candidate_keys(F.col("host"), F.col("path"), lengths)).alias("k")).select("k.key").distinct()
    universe = written(keys, "universe", files_for(pages.count()))
    return UrlFilter(cascade(block, universe), cascade(allow, universe), lengths)


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """Rules ``(host, path)`` as a table."""
    rows = F.array(*[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path")) for h, p in rules])
    return spark.range(1).select(F.explode(rows).alias("r")).select("r.host", "r.path")

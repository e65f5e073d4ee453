"""BM25 text ranking over a stored inverted index (A5, A6) and term match (Q7).

Index build: documents are dealt into shards of some thousand ids by a hash of
the id (the text is shuffled once; all rows of one id are one document).  A task
counts a shard's terms and makes one posting block for each term of it: the
ascending ids as gaps, the counts, the document lengths, and with the largest
count and the least length a bound of its largest weight.  Each task writes its
blocks sorted by term, so that a scan skips the pages of other terms; next to
them stands a table of all terms with their document frequency.  ``N`` and
``avgdl`` are aggregates.  A block has no more postings than a shard has
documents, however common its term is.

Query: the query terms (bounded blocks) with their ``idf`` are broadcast; the
scan reads the blocks of these terms only (``term IN (...)`` reaches it), and
they meet by shard.  A task goes through its shards with the k best of every
query so far, leaves out each query whose largest possible score in a shard does
not reach its k-th score, and decodes the blocks of the other queries' terms.
Only its k best of every query are shuffled on.

Match: ``any`` and ``all`` on the index work in the same way; ``all`` begins with a
query's rarest term and cuts what is left term by term.  Without an index
(:func:`scan_match`) every task matches the texts that it reads; they are not shuffled.

Pruning (A6) is done when an index is stored: every document drops the terms in
the lowest share of its weights, shard by shard.

Our definition (the reference leaves it to the server): Lucene-style
``idf = ln(1 + (N - df + 0.5) / (df + 0.5))``, ``k1 = 1.2``, ``b = 0.75``,
query term weight = its count in the query.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecframe.functions.text import tokenize
from vecframe.operators import _kernels as K
from vecframe.operators.search import top_k_per_group
from vecframe.session import bounded_broadcast, scratch_path, ship_package

# Fixed values (our definition of the scoring constants).
K1 = 1.2
B = 0.75
SCORE_SCALE = 100_000_000  # scores summed as exact fixed-point longs (1e-8 units)

# (query, term) pairs that are broadcast at a time, and (document, query) cells of one kernel step.
QUERY_TERMS = 1_000_000
SCORE_CELLS = 1 << 22

# Ids of a shard; a small table has shards of SMALL_SHARD, up to SPREAD_SHARDS of them, so that its work is spread.
SHARD_DOCS = 4096
SMALL_SHARD = 1024
SPREAD_SHARDS = 64
# Shards of one task of a search, about: what it sorts does not grow with the index.
TASK_SHARDS = 4
# Terms that a scan is asked for by value; more are joined.
MAX_IN_TERMS = 20_000
# Tokens that are counted in one step.
COUNT_TOKENS = 1 << 20


@dataclass
class BM25Index:
    blocks: DataFrame     # term, shard, ids (gaps where they are integers), tfs, dls, n, cf, tf_max, dl_min
    terms: DataFrame      # term, df, cf - of the whole index, also where this one is pruned
    n_docs: int
    avgdl: float
    gaps: bool
    shards: int = 1

    @property
    def tasks(self) -> int:
        """Tasks that the shards of a search are dealt to."""
        return max(min(self.shards + 1, _tasks(self.blocks)), self.shards // TASK_SHARDS)

    @property
    def postings(self) -> DataFrame:
        """``(doc_id, dl, term, tf)``."""
        flat = self.blocks.select("term", F.posexplode(F.arrays_zip("ids", "tfs", "dls")).alias("at", "p"), "ids")
        if self.gaps:
            upto = F.aggregate(F.slice("ids", F.lit(1), F.col("at") + 1), F.lit(0).cast("long"), lambda a, x: a + x)
            kind = self.blocks.schema["ids"].dataType.elementType
            flat = flat.withColumn("doc_id", upto.cast(kind))
        else:
            flat = flat.withColumn("doc_id", F.col("p.ids"))
        return flat.select("doc_id", F.col("p.dls").cast("long").alias("dl"), "term", F.col("p.tfs").cast("long").alias("tf"))

    def df(self) -> DataFrame:
        """``(term, df)`` of the whole vocabulary."""
        return self.terms.select("term", "df")


def _tasks(df: DataFrame) -> int:
    """Tasks of a shuffle whose work is more than its bytes say: a number that is given is not made smaller for small data."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _term_in(names: list[str]) -> Column:
    """``term IN (...)`` as one expression; terms are letters and digits."""
    return F.expr("term IN (" + ", ".join(f"'{t}'" for t in names) + ")") if names else F.lit(False)


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt out to all cores where its scan has fewer splits than there are cores (one file of one row group)."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df


def _kept(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_documents(docs: DataFrame, name: str, n_buckets: int, id_col: str = "doc_id",
                    path: str | None = None) -> None:
    """Keep a document collection bucketed by ``doc_id``: one shuffle when it
    is written, none when its terms are counted (``prepartitioned=True``)."""
    w = docs.write.mode("overwrite").bucketBy(n_buckets, id_col).sortBy(id_col)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


# -- counting ----------------------------------------------------------------

def _counted(ids: pa.Array, tokens: pa.ListArray):
    """Distinct (row, term) of a few rows: ``(row, dictionary code, count, dictionary)``, in bounded steps."""
    sizes = tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    block = np.cumsum(sizes) // COUNT_TOKENS
    edges = np.concatenate(([0], np.flatnonzero(np.diff(block)) + 1, [len(sizes)])) if len(sizes) else np.zeros(1, int)
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        flat = tokens.slice(a, b - a).flatten().dictionary_encode()
        code, n_terms = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64), max(1, len(flat.dictionary))
        key, tf = np.unique(np.repeat(np.arange(a, b), sizes[a:b]) * n_terms + code, return_counts=True)
        yield key // n_terms, key % n_terms, tf, flat.dictionary


def term_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A5 statistics without an index: ``(term, df, cf)``; df counts ids.

    The texts stay where they are: each task adds up its own.  Only rows whose id has others are brought together."""
    single, several = _by_repetition(docs, id_col, text_col)

    def run(batches):
        parts = []
        for rb in batches:
            for row, code, tf, words in _counted(rb.column(0), rb.column(1)):
                parts.append(pa.table({"term": words, "df": np.bincount(code, minlength=len(words)),
                                       "cf": np.bincount(code, weights=tf, minlength=len(words)).astype(np.int64)}))
            if len(parts) > 50:
                parts = [_added(parts)]
        if parts:
            yield from _added(parts).to_batches()

    ship_package(docs.sparkSession)
    tokens = spread(single).select("doc_id", tokenize(F.col("_text")).alias("tokens"))
    rows = tokens.mapInArrow(run, "term string, df long, cf long")
    if several is not None:
        more = build_postings(several, "doc_id", "_text").groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))
        rows = rows.unionByName(more)
    return rows.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


def _added(parts: list[pa.Table]) -> pa.Table:
    sums = pa.concat_tables(parts).group_by("term").aggregate([("df", "sum"), ("cf", "sum")])
    return pa.table({"term": sums["term"], "df": sums["df_sum"], "cf": sums["cf_sum"]})


def _by_repetition(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame | None]:
    """``(doc_id, _text)`` rows whose id is theirs alone, and the others (None if there are none)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    again = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.col("doc_id").alias("_again"))
    if again.isEmpty():
        return rows, None
    again = bounded_broadcast(again)
    same = F.col("doc_id").eqNullSafe(F.col("_again"))
    return rows.join(again, same, "left_anti"), rows.join(again, same, "left_semi")


def build_postings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   prepartitioned: bool = False) -> DataFrame:
    """``(doc_id, dl, term, tf)``, hash-partitioned by ``doc_id``: the forward form.

    The raw text is shuffled once by ``doc_id``; counting terms per document then
    needs no second exchange.  ``prepartitioned=True`` is for a table stored
    bucketed by ``doc_id`` (:func:`store_documents`): no shuffle at all."""
    from pyspark.sql import Window
    sel = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    toks = (sel if prepartitioned else sel.repartition("doc_id")).select("doc_id", F.explode(tokenize(F.col("_text"))).alias("term"))
    tf = toks.groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf"))
    return tf.withColumn("dl", F.sum("tf").over(Window.partitionBy("doc_id"))).select("doc_id", "dl", "term", "tf")


# -- index -------------------------------------------------------------------

def _block_schema(kind: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("term", T.StringType()), T.StructField("shard", T.IntegerType()),
                         T.StructField("ids", T.ArrayType(kind)), T.StructField("tfs", T.ArrayType(T.IntegerType())),
                         T.StructField("dls", T.ArrayType(T.IntegerType())), T.StructField("n", T.LongType()), T.StructField("cf", T.LongType()),
                         T.StructField("tf_max", T.IntegerType()), T.StructField("dl_min", T.IntegerType())])


BLOCK = ["term", "shard", "ids", "tfs", "dls", "n", "cf", "tf_max", "dl_min"]


def _block_batch(words: pa.Array, shard: int, ids: pa.Array, tf: np.ndarray, dl: np.ndarray, edges: np.ndarray) -> pa.RecordBatch:
    """Posting blocks with what bounds them; no block is empty."""
    first, n = edges[:-1], np.diff(edges)
    if not len(n):
        sums = most = least = np.zeros(0, np.int64)
    else:
        sums, most, least = np.add.reduceat(tf, first), np.maximum.reduceat(tf, first), np.minimum.reduceat(dl, first)
    return pa.RecordBatch.from_arrays([words, pa.array(np.full(len(n), shard, np.int32)), _lists(ids, edges), _lists(pa.array(tf.astype(np.int32)), edges),
                                       _lists(pa.array(dl.astype(np.int32)), edges), pa.array(n.astype(np.int64)), pa.array(sums.astype(np.int64)),
                                       pa.array(most.astype(np.int32)), pa.array(least.astype(np.int32))], BLOCK)


def _lists(values: pa.Array, edges: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), values)


def _gaps(ids: np.ndarray, edges: np.ndarray) -> np.ndarray:
    out = ids.copy()
    out[1:] -= ids[:-1]
    out[edges[:-1]] = ids[edges[:-1]]
    return out


def _ungapped(gaps: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Running sums inside each list (64-bit sums may wrap round; their differences are right)."""
    total = np.concatenate((np.zeros(1, np.int64), np.cumsum(gaps.astype(np.int64))))
    return total[1:] - np.repeat(total[edges[:-1]], np.diff(edges))


def _shard_blocks(shard: int, parts: list, kind: pa.DataType, gaps: bool):
    """The posting blocks of a shard from its counted rows ``(ids, codes, counts, dictionary)``."""
    ids = pa.concat_arrays([p[0] for p in parts])
    codes = pa.chunked_array([pa.DictionaryArray.from_arrays(pa.array(p[1].astype(np.int32)), p[3]) for p in parts]).unify_dictionaries()
    words = codes.chunk(0).dictionary
    code = np.concatenate([c.indices.to_numpy(zero_copy_only=False) for c in codes.chunks]).astype(np.int64)
    tf = np.concatenate([p[2] for p in parts])
    # documents in the order of their ids; all rows of an id are one
    distinct = ids.dictionary_encode(null_encoding="encode")
    order = pc.sort_indices(distinct.dictionary).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    doc = place[distinct.indices.to_numpy(zero_copy_only=False)]
    names = distinct.dictionary.take(pa.array(order))
    key, at = np.unique(code * len(names) + doc, return_inverse=True)
    tf = np.bincount(at, weights=tf).astype(np.int64)
    doc, code = key % len(names), key // len(names)
    dl = np.bincount(doc, weights=tf, minlength=len(names)).astype(np.int64)
    edges = np.concatenate(([0], np.flatnonzero(np.diff(code)) + 1, [len(code)]))
    held = names.take(pa.array(doc))
    if gaps and not held.null_count:
        held = pa.array(_gaps(held.to_numpy(zero_copy_only=False).astype(np.int64), edges)).cast(kind)
    return _block_batch(words.take(pa.array(code[edges[:-1]])), shard, held, tf, dl[doc], edges)


#: The shard of the document without an id: it has no others, so its block needs no gaps.
NO_ID = -1


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prepartitioned: bool = False,
                path: str | None = None) -> BM25Index:
    """The index stored at ``path`` (or in a folder of its own).  ``N`` counts
    every id (empty documents too); ``avgdl = total tokens / N``.  Shards are made alike of a ``prepartitioned`` table."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "bm25")
    n = docs.select(id_col).distinct().count()
    shards = max(math.ceil(n / SHARD_DOCS), min(SPREAD_SHARDS, math.ceil(n / SMALL_SHARD)), 1)
    kind = docs.schema[id_col].dataType
    gaps = isinstance(kind, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))
    shard = F.when(F.col(id_col).isNull(), F.lit(NO_ID)).otherwise(F.pmod(F.xxhash64(id_col), F.lit(shards)).cast("int"))
    rows = docs.select(shard.alias("shard"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    # a shard's texts follow each other; they are cut into words where they arrive
    sorted_rows = rows.repartition(min(shards, 16 * spark.sparkContext.defaultParallelism) if shards <= SPREAD_SHARDS else shards, "shard").sortWithinPartitions("shard")
    tokens = sorted_rows.select("shard", "doc_id", tokenize(F.col("_text")).alias("tokens"))
    schema = _block_schema(kind)

    def run(batches):
        now, parts = None, []
        for rb in batches:
            numbers = rb.column(0).to_numpy(zero_copy_only=False)
            edges = np.concatenate(([0], np.flatnonzero(np.diff(numbers)) + 1, [len(numbers)])) if len(numbers) else np.zeros(1, int)
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                if parts and int(numbers[a]) != now:
                    yield _shard_blocks(now, parts, parts[0][0].type, gaps)
                    parts = []
                now = int(numbers[a])
                ids = rb.column(1).slice(a, b - a)
                for row, code, tf, words in _counted(ids, rb.column(2).slice(a, b - a)):
                    if len(row):
                        parts.append((ids.take(pa.array(row)), code, tf, words))
        if parts:
            yield _shard_blocks(now, parts, parts[0][0].type, gaps)

    ship_package(spark)
    blocks = _stored_blocks(tokens.mapInArrow(run, schema), f"{path}/blocks")
    terms = _kept(blocks.groupBy("term").agg(F.sum("n").alias("df"), F.sum("cf").alias("cf")).repartition(_tasks(blocks), "term").sortWithinPartitions("term"), f"{path}/terms")
    total = terms.agg(F.sum("cf")).first()[0] or 0
    return BM25Index(blocks, terms, int(n), float(total) / n if n else 0.0, gaps, shards)


def _stored_blocks(blocks: DataFrame, path: str) -> DataFrame:
    """Every task's blocks sorted by term: the pages and row groups of other terms are skipped."""
    return _kept(blocks.sortWithinPartitions("term", "shard"), path)


def pruned(index: BM25Index, drop_ratio: float, path: str | None = None) -> BM25Index:
    """The index without every document's lowest ``drop_ratio`` share of weights, stored; the statistics stay the full index's."""
    spark = index.blocks.sparkSession
    path = path or scratch_path(spark, "bm25-pruned")
    weighed = index.blocks.join(index.terms.select("term", idf(index.n_docs, F.col("df")).alias("idf")), "term")
    dealt = weighed.repartition(index.tasks, "shard").sortWithinPartitions("shard", "term")
    avgdl, gaps = index.avgdl, index.gaps

    def cut(shard, held):
        words = pa.concat_arrays([b.column("term") for b in held])
        ids, edges, tf, dl = _flat(held, gaps and shard != NO_ID)
        doc = ids.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)
        weight = np.concatenate([b.column("idf").to_numpy(zero_copy_only=False) for b in held])
        size = np.diff(edges)
        w = _weights(np.repeat(weight, size), tf, dl, avgdl)
        order = np.lexsort((w, doc))
        d, v = doc[order], w[order]
        first = np.searchsorted(d, d)  # of the document
        step = np.concatenate(([True], (d[1:] != d[:-1]) | (v[1:] != v[:-1])))
        lowest = np.maximum.accumulate(np.where(step, np.arange(len(d)), 0))  # of equal weights
        count = np.bincount(doc)[d]
        keep = np.empty(len(d), bool)
        keep[order] = (lowest - first) / np.maximum(count - 1, 1) >= drop_ratio
        block = np.repeat(np.arange(len(size)), size)[keep]
        left = np.bincount(block, minlength=len(size))
        some = left > 0
        edges = np.concatenate(([0], np.cumsum(left[some])))
        ids = ids.filter(pa.array(keep))
        if gaps and shard != NO_ID:
            ids = pa.array(_gaps(ids.to_numpy(zero_copy_only=False).astype(np.int64), edges)).cast(ids.type)
        return _block_batch(words.filter(pa.array(some)), shard, ids, tf[keep].astype(np.int64), dl[keep].astype(np.int64), edges)

    def run(batches):
        for shard, held in _by_shard(batches):
            yield cut(shard, held)

    ship_package(spark)
    kind = index.blocks.schema["ids"].dataType.elementType
    left = dealt.select("term", "shard", "ids", "tfs", "dls", "idf").mapInArrow(run, _block_schema(kind))
    return BM25Index(_stored_blocks(left, f"{path}/blocks"), index.terms, index.n_docs, index.avgdl, index.gaps, index.shards)


def _by_shard(batches):
    """``(shard, its record batches)`` of rows that are sorted by shard."""
    now, held = None, []
    for rb in batches:
        numbers = rb.column("shard").to_numpy(zero_copy_only=False)
        edges = np.concatenate(([0], np.flatnonzero(np.diff(numbers)) + 1, [len(numbers)])) if len(numbers) else np.zeros(1, int)
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if held and int(numbers[a]) != now:
                yield now, held
                held = []
            now = int(numbers[a])
            held.append(rb.slice(a, b - a))
    if held:
        yield now, held


def _flat(held: list, gaps: bool):
    """The postings of a shard's blocks: ``(ids, block edges, tf, dl)``."""
    def values(name):
        return pa.concat_arrays([b.column(name).flatten() for b in held])

    size = np.concatenate([b.column("ids").value_lengths().to_numpy(zero_copy_only=False) for b in held])
    edges = np.concatenate(([0], np.cumsum(size))).astype(np.int64)
    ids = values("ids")
    if gaps:
        ids = pa.array(_ungapped(ids.to_numpy(zero_copy_only=False), edges)).cast(ids.type)
    return ids, edges, values("tfs").to_numpy(zero_copy_only=False).astype(np.float64), values("dls").to_numpy(zero_copy_only=False).astype(np.float64)


def idf(n_docs: int, df: Column) -> Column:
    return F.log(F.lit(1.0) + (F.lit(float(n_docs)) - df + F.lit(0.5)) / (df + F.lit(0.5)))


def _weights(weight, tf, dl, avgdl: float):
    """BM25 weight of each posting."""
    return weight * (tf * (K1 + 1.0)) / (tf + K1 * ((1.0 - B) + B * dl / avgdl))


# -- queries -----------------------------------------------------------------

def query_terms(queries: DataFrame, qid_col: str = "qid", text_col: str = "text") -> DataFrame:
    q = queries.select(F.col(qid_col).alias("qid"), F.explode(tokenize(F.col(text_col))).alias("term"))
    return q.groupBy("qid", "term").agg(F.count(F.lit(1)).alias("qtf"))


class _Asked:
    """The (query, term) pairs of one block, by term."""

    def __init__(self, rows: list):  # (qid, term, qtf, idf, df)
        self.names = sorted({r[1] for r in rows})
        place = {t: i for i, t in enumerate(self.names)}
        self.qids = sorted({r[0] for r in rows})
        column = {q: i for i, q in enumerate(self.qids)}
        rows = sorted(rows, key=lambda r: (place[r[1]], column[r[0]]))
        of = np.array([place[r[1]] for r in rows], np.int64)
        self.cut = np.searchsorted(of, np.arange(len(self.names) + 1))
        self.term_of = of
        self.query = np.array([column[r[0]] for r in rows], np.int64)
        self.times = np.array([r[2] for r in rows], np.float64)
        self.weight = np.array([r[3] for r in rows], np.float64)[self.cut[:-1]]
        self.df = np.array([r[4] for r in rows], np.int64)[self.cut[:-1]]
        self.vocabulary = pa.array(self.names, pa.string())


def _spans(cut: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all (query, term) pairs of the terms ``of``, and which of ``of`` each belongs to."""
    n = np.diff(cut)[of]
    return np.repeat(cut[of], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n), np.repeat(np.arange(len(of)), n)


def _asked_blocks(index: BM25Index, names: list[str]) -> DataFrame:
    """The blocks of these terms, a shard's together: nothing else is read."""
    if len(names) <= MAX_IN_TERMS:
        found = index.blocks.where(_term_in(names))
    else:
        spark = index.blocks.sparkSession
        wanted = spark.createDataFrame(pa.table({"_term": pa.array(names, pa.string())}))
        found = index.blocks.join(bounded_broadcast(wanted), F.col("term") == F.col("_term"), "left_semi")
    return found.repartition(index.tasks, "shard").sortWithinPartitions("shard")


def _task_topk(index: BM25Index, rows: list, k: int) -> DataFrame:
    """``(qid, doc_id, _fp)``: the best k documents of every query in each task.

    Sums are exact fixed-point integers, as the order of adding must not matter."""
    spark = index.blocks.sparkSession
    asked = _Asked(rows)
    shared = spark.sparkContext.broadcast(asked)
    avgdl, gaps = index.avgdl, index.gaps

    def run(batches):
        asked = shared.value
        nq = len(asked.qids)
        best: list[tuple] = []
        size = 0
        floor = np.full(nq, -1, np.int64)  # k-th best so far

        def reduce(parts):
            q, s = (np.concatenate(x) for x in list(zip(*parts))[:2])
            d = pa.concat_arrays([p[2] for p in parts])
            tie = pc.rank(d, sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy()
            sel = K.select_topk(q, -s, tie, k)
            return q[sel], s[sel], d.take(pa.array(sel))

        for shard, held in _by_shard(batches):
            term = np.concatenate([pc.index_in(b.column("term"), value_set=asked.vocabulary).to_numpy(zero_copy_only=False) for b in held]).astype(np.int64)
            tf, dl = (np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in held]).astype(np.float64) for c in ("tf_max", "dl_min"))
            top = _weights(1.0, tf, dl, avgdl)  # no posting of the block weighs more
            # what each query can reach at most in this shard
            at, block = _spans(asked.cut, term)
            bound = np.bincount(asked.query[at], weights=np.floor(asked.times[at] * asked.weight[term[block]] * top[block] * SCORE_SCALE * (1 + 1e-9)) + 2, minlength=nq)
            live = bound >= floor
            use = live[asked.query[at]]
            if not use.any():
                continue
            needed = np.zeros(len(term), bool)
            needed[block[use]] = True
            sub, start = [], 0
            for b in held:
                sub.append(b.filter(pa.array(needed[start:start + b.num_rows])))
                start += b.num_rows
            term = term[needed]
            ids, edges, tf, dl = _flat(sub, gaps and shard != NO_ID)
            distinct = ids.dictionary_encode(null_encoding="encode")
            doc, names = distinct.indices.to_numpy(zero_copy_only=False).astype(np.int64), distinct.dictionary
            n_docs = len(names)
            owner = np.repeat(np.arange(len(term)), np.diff(edges))
            w = _weights(asked.weight[term[owner]], tf, dl, avgdl)
            pick = np.flatnonzero(live)
            column = np.full(nq, -1)
            column[pick] = np.arange(len(pick))
            at, block = _spans(asked.cut, term)
            keep = live[asked.query[at]]
            at, block = at[keep], block[keep]
            step = max(1, SCORE_CELLS // n_docs)
            for first in range(0, len(pick), step):  # queries of one step
                inside = (column[asked.query[at]] >= first) & (column[asked.query[at]] < first + step)
                a, blk = at[inside], block[inside]
                n = np.diff(edges)[blk]
                place = np.repeat(edges[blk], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                fp = np.floor(np.repeat(asked.times[a], n) * w[place] * float(SCORE_SCALE) + 0.5)
                cell = np.repeat(column[asked.query[a]] - first, n) * n_docs + doc[place]
                m = min(step, len(pick) - first) * n_docs
                total = np.bincount(cell, weights=fp, minlength=m).astype(np.int64)  # exact below 2**53
                there = np.bincount(cell, minlength=m) > 0
                there &= total >= np.repeat(floor[pick[first:first + step]], n_docs)
                found = np.flatnonzero(there)
                q, d, s = pick[first + found // n_docs], found % n_docs, total[found]
                if n_docs > k:
                    tie = pc.rank(names, sort_keys="ascending", null_placement="at_start", tiebreaker="first").to_numpy()
                    sel = K.select_topk(q, -s, tie[d], k)
                    q, d, s = q[sel], d[sel], s[sel]
                best.append((q, s, names.take(pa.array(d))))
                size += len(q)
            if size > 2 * k * nq + 50_000 or len(best) > 8:
                best = [reduce(best)]
                size = len(best[0][0])
                q, s, _ = best[0]
                full = np.bincount(q, minlength=nq) >= k
                low = np.full(nq, np.iinfo(np.int64).max)
                np.minimum.at(low, q, s)
                floor = np.where(full, low, -1)
        if best:
            q, s, d = reduce(best)
            yield pa.RecordBatch.from_arrays([pa.array(np.array(asked.qids)[q]), d, pa.array(s, pa.int64())], ["qid", "doc_id", "_fp"])

    ship_package(spark)
    kind = index.blocks.schema["ids"].dataType.elementType.simpleString()
    return _asked_blocks(index, asked.names).select("term", "shard", "ids", "tfs", "dls", "tf_max", "dl_min").mapInArrow(run, f"qid long, doc_id {kind}, _fp long")


def _query_blocks(index: BM25Index, queries: DataFrame, qid_col: str, text_col: str, outer: bool = False):
    """Rows ``(qid, term, qtf, idf, df)`` in blocks of about QUERY_TERMS pairs; ``outer``: also of terms that no document has."""
    qt = query_terms(queries, qid_col, text_col).withColumn("qid", F.col("qid").cast("long")).where("qid is not null")
    known = index.terms.select("term", "df", idf(index.n_docs, F.col("df")).alias("idf"))

    def weighed(asked):
        names = sorted({r.term for r in asked})
        if len(names) <= MAX_IN_TERMS:
            of = known.where(_term_in(names)).collect()
        else:
            wanted = index.terms.sparkSession.createDataFrame(pa.table({"_term": pa.array(names, pa.string())}))
            of = known.join(bounded_broadcast(wanted), F.col("term") == F.col("_term"), "left_semi").collect()
        found = {r.term: (r.idf, r.df) for r in of}
        return [(r.qid, r.term, r.qtf, *found.get(r.term, (0.0, 0))) for r in asked if outer or r.term in found]

    asked = qt.limit(QUERY_TERMS + 1).collect()
    if len(asked) <= QUERY_TERMS:
        yield weighed(asked)
        return
    blocks = 1 + qt.count() // QUERY_TERMS
    for i in range(blocks):
        yield weighed(qt.where(F.pmod(F.xxhash64("qid"), F.lit(blocks)) == i).collect())


def search(index: BM25Index, queries: DataFrame, k: int = 10, qid_col: str = "qid", text_col: str = "text") -> DataFrame:
    """``(qid, rank, doc_id, score)``, best first, ties by doc_id.

    The query terms are read in blocks of about ``QUERY_TERMS`` (query, term) pairs; each reads its terms' blocks."""
    spark = index.blocks.sparkSession
    out = None
    for rows in _query_blocks(index, queries, qid_col, text_col):
        if rows:
            part = _task_topk(index, rows, k)
            out = part if out is None else out.unionByName(part)
    if out is None:
        kind = index.blocks.schema["ids"].dataType.elementType.simpleString()
        out = spark.createDataFrame([], f"qid long, doc_id {kind}, _fp long")
    return (top_k_per_group(out, ["qid"], [F.desc("_fp"), F.asc("doc_id")], k)
            .select("qid", F.col("rank").cast("long").alias("rank"), "doc_id",
                    (F.col("_fp") / F.lit(float(SCORE_SCALE))).alias("score")))


def term_stats(index: BM25Index) -> DataFrame:
    """``(term, df, cf)``: document and collection frequency of every term."""
    return index.terms.select("term", "df", "cf")


def match(index: BM25Index | DataFrame, queries: DataFrame, mode: str = "any", qid_col: str = "qid", text_col: str = "text") -> DataFrame:
    """Q7: ``(qid, doc_id)`` of documents holding any / all distinct query terms.

    ``all`` takes a query's rarest term first and keeps, term by term, the documents that have the next one too.  Instead of
    an index, postings ``(doc_id, term)`` may be given; they are joined."""
    if mode not in ("any", "all"):
        raise ValueError("mode must be 'any' or 'all'")
    if isinstance(index, DataFrame):
        return _match_postings(index, queries, mode, qid_col, text_col)
    spark = index.blocks.sparkSession
    gaps = index.gaps
    kind = index.blocks.schema["ids"].dataType.elementType.simpleString()
    out = spark.createDataFrame([], f"qid long, doc_id {kind}")
    for rows in _query_blocks(index, queries, qid_col, text_col, outer=True):
        if mode == "all":  # a query with a term that no document has is answered by none
            never = {r[0] for r in rows if not r[4]}
            rows = [r for r in rows if r[0] not in never]
        rows = [r for r in rows if r[4]]
        if not rows:
            continue
        asked = _Asked(rows)
        shared = spark.sparkContext.broadcast(asked)

        def run(batches, shared=shared):
            asked = shared.value
            nq = len(asked.qids)
            by_query = np.lexsort((asked.df[asked.term_of], asked.query))  # rarest term first
            cut = np.searchsorted(asked.query[by_query], np.arange(nq + 1))
            for shard, held in _by_shard(batches):
                term = np.concatenate([pc.index_in(b.column("term"), value_set=asked.vocabulary).to_numpy(zero_copy_only=False) for b in held]).astype(np.int64)
                ids, edges, _, _ = _flat(held, gaps and shard != NO_ID)
                distinct = ids.dictionary_encode(null_encoding="encode")
                doc = distinct.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                block = np.full(len(asked.names), -1)
                block[term] = np.arange(len(term))
                for q in range(nq):
                    mine = block[asked.term_of[by_query[cut[q]:cut[q + 1]]]]
                    left = np.zeros(len(distinct.dictionary), bool)
                    if mode == "any":
                        for b in mine[mine >= 0].tolist():
                            left[doc[edges[b]:edges[b + 1]]] = True
                        found = np.flatnonzero(left)
                    elif (mine < 0).any():
                        continue
                    else:
                        found = doc[edges[mine[0]]:edges[mine[0] + 1]]
                        for b in mine[1:].tolist():
                            if not len(found):
                                break
                            left[:] = False
                            left[doc[edges[b]:edges[b + 1]]] = True
                            found = found[left[found]]
                    if len(found):
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), asked.qids[q], np.int64)), distinct.dictionary.take(pa.array(found))], ["qid", "doc_id"])

        ship_package(spark)
        out = out.unionByName(_asked_blocks(index, asked.names).select("term", "shard", "ids", "tfs", "dls").mapInArrow(run, f"qid long, doc_id {kind}"))
    return out


def _match_postings(postings: DataFrame, queries: DataFrame, mode: str, qid_col: str, text_col: str) -> DataFrame:
    qt = query_terms(queries, qid_col, text_col).select("qid", "term")
    hits = (postings.select("term", "doc_id").join(bounded_broadcast(qt), "term")
            .groupBy("qid", "doc_id").agg(F.count(F.lit(1)).alias("_m")))
    if mode == "any":
        return hits.select("qid", "doc_id")
    asked = qt.groupBy("qid").agg(F.count(F.lit(1)).alias("_nq"))
    return hits.join(asked, "qid").where(F.col("_m") == F.col("_nq")).select("qid", "doc_id")


def scan_match(docs: DataFrame, queries: DataFrame, mode: str = "any", id_col: str = "doc_id", text_col: str = "text",
               qid_col: str = "qid", query_col: str = "text") -> DataFrame:
    """Q7 without an index: :func:`match` of the texts as they are read, which are not shuffled.

    Rows whose id has others are one document: only those are brought together first."""
    if mode not in ("any", "all"):
        raise ValueError("mode must be 'any' or 'all'")
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    single, several = _by_repetition(docs, id_col, text_col)
    rows = spread(single).select("doc_id", tokenize(F.col("_text")).alias("tokens"))
    if several is not None:
        rows = rows.unionByName(several.select("doc_id", F.explode(tokenize(F.col("_text"))).alias("t")).groupBy("doc_id").agg(F.collect_set("t").alias("tokens")))
    qt = query_terms(queries, qid_col, query_col).withColumn("qid", F.col("qid").cast("long")).where("qid is not null")
    blocks = 1 + qt.count() // QUERY_TERMS
    out = spark.createDataFrame([], f"qid long, doc_id {kind}")
    for i in range(blocks):
        mine = qt if blocks == 1 else qt.where(F.pmod(F.xxhash64("qid"), F.lit(blocks)) == i)
        asked = _Asked([(r.qid, r.term, 1, 0.0, 0) for r in mine.collect()])
        if not asked.names:
            continue
        shared = spark.sparkContext.broadcast(asked)

        def run(batches, shared=shared):
            asked = shared.value
            nq = len(asked.qids)
            needed = np.bincount(asked.query, minlength=nq) if mode == "all" else np.ones(nq, np.int64)
            for rb in batches:
                for row, code, _, words in _counted(rb.column(0), rb.column(1)):
                    known = pc.index_in(words, value_set=asked.vocabulary)
                    known = pc.fill_null(known, -1).to_numpy(zero_copy_only=False).astype(np.int64)[code]
                    row, term = row[known >= 0], known[known >= 0]
                    if not len(row):
                        continue
                    low, step = int(row[0]), max(1, SCORE_CELLS // nq)
                    for first in range(low, int(row[-1]) + 1, step):
                        part = slice(*np.searchsorted(row, [first, first + step]))
                        at, own = _spans(asked.cut, term[part])
                        n = min(step, int(row[-1]) + 1 - first)
                        held = np.bincount((row[part][own] - first) * nq + asked.query[at], minlength=n * nq).reshape(n, nq)
                        r, q = np.nonzero(held >= needed[None, :])
                        if len(r):
                            yield pa.RecordBatch.from_arrays([pa.array(np.array(asked.qids)[q]), rb.column(0).take(pa.array(first + r))], ["qid", "doc_id"])

        ship_package(spark)
        out = out.unionByName(rows.mapInArrow(run, f"qid long, doc_id {kind}"))
    return out

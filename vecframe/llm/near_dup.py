"""SimHash near-duplicate groups through pigeonhole blocks (operator 6).

A fingerprint bit is set if it is set in over half of the XXH64 values of a text's word shingles.  Two fingerprints
that differ in ``max_bits`` bits or fewer agree in all but ``max_bits`` of ``BLOCKS`` blocks, so close pairs meet in
one of the tables keyed by the agreeing blocks; the Hamming distance is verified there.  Equal fingerprints are one
node from the start.  A bucket with more than ``HOT_BUCKET`` distinct fingerprints would give too many pairs; its
members are linked without pairs: two fingerprints are within ``max_bits`` (2) bits of each other exactly if some point
lies within one bit of both, so each member goes to its 65 points, and the members at a point (65 at most) form a star.
This covers every link within the bucket; nothing is dropped.  Groups are found by forests within tasks and
alternating large-star and small-star rounds, each written to the shared folder, until few enough links are left for one task.

Defined results: null and empty texts and texts without words have fingerprint zero, linked like any other; texts with
fewer words than a shingle use the whole sequence; repeated rows come back once each; a row with a null id has its
fingerprint, stands for nothing and gets a null component unless it links to rows with ids; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from vecframe.llm.common import files_for, lookup_join, map_text, text_buffer, text_slices, written

#: Blocks that a fingerprint is split into; with two bits allowed there are six tables keyed by two of four blocks.
BLOCKS = 4
#: Distinct fingerprints above which a bucket is linked through points instead of pairs (64 points cost as much).
HOT_BUCKET = 128

UPPER_TO_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint_texts(column: pa.Array, words: int, seed: int = 42) -> np.ndarray:
    """Fingerprints (uint64) of texts."""
    from itertools import repeat
    from xxhash import xxh64_digest
    raw, at = text_buffer(column)
    raw = raw.translate(UPPER_TO_LOWER)
    out = np.zeros(len(column), np.uint64)
    digests, sizes, rows = [], [], []
    at = at.tolist()
    for i in range(len(column)):
        token = raw[at[i]:at[i + 1]].split()
        if not token:
            continue
        if len(token) <= words:
            shingles = [b" ".join(token)]
        else:
            flat = b" ".join(token)
            ends = np.cumsum(np.fromiter(map(len, token), np.int64, len(token)) + 1)
            starts = np.concatenate(([0], ends[:-words])).tolist()
            shingles = [flat[a:b] for a, b in zip(starts, (ends[words - 1:] - 1).tolist())]
        digests.append(b"".join(map(xxh64_digest, shingles, repeat(seed))))
        sizes.append(len(shingles))
        rows.append(i)
    if rows:
        bits = np.unpackbits(np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 8), axis=1)
        starts = np.cumsum([0, *sizes[:-1]])
        votes = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        won = votes * 2 > np.array(sizes, np.int32)[:, None]
        out[rows] = np.packbits(won, axis=1).view(">u8").ravel()
    return out


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fp long)`` of every row; ``fp`` holds the 64 bits."""
    kind = docs.schema[id_col].dataType.simpleString()
    return map_text(docs, [id_col, text_col], lambda b: (b.column(0), fingerprint_texts(b.column(1), words).view(np.int64)),
                    f"`{id_col}` {kind}, fp long")


def block_tables(max_bits: int, blocks: int = BLOCKS) -> list[int]:
    """Bit masks of the tables: every choice of ``blocks - max_bits`` blocks."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    return [sum(c) for c in combinations(masks, blocks - max_bits)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def close_links(nodes: DataFrame, max_bits: int = 2, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints ``nodes.fp`` whose components are those of all pairs within
    ``max_bits`` bits: the pairs themselves, or stars around points in hot buckets (then ``max_bits`` must be 2)."""
    if max_bits == 0:
        return nodes.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    tables = block_tables(max_bits, max(BLOCKS, max_bits + 1))
    keys = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("k")) for t, m in enumerate(tables)])
    entries = nodes.select("fp", F.explode(keys).alias("e")).select("fp", "e.t", "e.k")
    shared = entries.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("low")).where("n > 1")
    files = files_for(nodes.count())
    shared = written(shared, "buckets", 2 * files)
    few = entries.join(shared.where(F.col("n") <= hot_bucket).select("t", "k"), ["t", "k"])
    few = written(few, "members", 2 * files)
    left = few.select("t", "k", F.col("fp").alias("a"))
    right = few.select("t", "k", F.col("fp").alias("b"))
    pairs = (left.join(right, ["t", "k"]).where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))
             .select("a", "b"))
    hot = shared.where(F.col("n") > hot_bucket)
    if hot.isEmpty():
        return pairs
    if max_bits != 2:
        raise ValueError("hot buckets are linked through points for two bits only; raise hot_bucket")
    # the tables of hot buckets are joined on the key again: a bucket's rows are spread over tasks by AQE's skew split
    crowded = entries.join(hot.select("t", "k"), ["t", "k"]).select("fp").distinct()
    points = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(signed(1 << i))) for i in range(64)])
    stars = (crowded.select("fp", F.explode(points).alias("point")).groupBy("point").agg(F.collect_set("fp").alias("around"))
             .where(F.size("around") > 1).select(F.array_min("around").alias("a"), F.explode("around").alias("b")).where("a < b"))
    return pairs.unionByName(stars)


def forest(edges) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same nodes as ``edges`` (two arrays), each from a node to its group's least node."""
    a, b = edges
    names, place = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = place[:len(a)], place[len(a):]
    root = np.arange(len(names))
    while True:
        low = np.minimum(root[x], root[y])
        before = root.copy()
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        while True:
            jump = root[root]
            if (jump == root).all():
                break
            root = jump
        if (root == before).all():
            break
    keep = root != np.arange(len(names))
    return names[keep], names[root[keep]]


#: Links that a task of ``contract`` holds before it reduces them, and at which one task finishes the components.
HELD_LINKS = 1_000_000
FINISH_LINKS = 500_000


def contract(edges: DataFrame) -> DataFrame:
    """Each task replaces its links ``(a, b)`` by a forest over the same nodes."""
    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append((batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)))
            size += batch.num_rows
            if size > HELD_LINKS:
                held = [forest(tuple(map(np.concatenate, zip(*held))))]
                size = len(held[0][0]) // 2  # what is left grows with the nodes
        if held:
            hi, lo = forest(tuple(map(np.concatenate, zip(*held))))
            for i in range(0, len(hi), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(hi[i:i + 100_000], pa.int64()), pa.array(lo[i:i + 100_000], pa.int64())], ["a", "b"])

    return edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).mapInArrow(run, "a long, b long")


def components(edges: DataFrame, nodes: int = 0, finish_links: int = FINISH_LINKS) -> DataFrame:
    """``(node, root)`` for every node of links ``(a, b)``: root is the least node that it reaches.

    Tasks first reduce their links to forests (``nodes``: about how many nodes there are, for their number).  Once
    ``finish_links`` links or fewer are left, one task joins them; until then large-star and small-star rounds go on.
    A node's least neighbour comes from a partial aggregate and meets the links in a join that keeps heavy nodes apart,
    so a hub does not land in one task."""
    links = written(contract(edges.where("a <> b").coalesce(2 * files_for(nodes))), "links")
    while True:
        n = links.count()
        files = files_for(n)
        if n <= finish_links:
            return contract(links.coalesce(1)).select(F.col("a").alias("node"), F.col("b").alias("root"))
        # large star: every larger neighbour of a node moves to the node's least neighbour
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
        tally = written(both.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("m")), "least", files)
        least = tally.select("u", F.least("m", "u").alias("m"))
        large = lookup_join(both, least, "u", counts=tally.select("u", "n")).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        # small star: a node and its smaller neighbours move to the least of them
        large = written(large, "large", files)
        tally = written(large.groupBy("a").agg(F.count(F.lit(1)).alias("n"), F.min("b").alias("m")), "least", files)
        met = lookup_join(large, tally.select("a", "m"), "a", counts=tally.select("a", "n"))
        small = met.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        after = written(small.distinct(), "links", files)
        # every node has one link, to a root that has none: done
        heads = after.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        if heads.where("n > 1").isEmpty() and after.join(after.select(F.col("a").alias("b")), "b", "left_semi").isEmpty():
            return after.select(F.col("a").alias("node"), F.col("b").alias("root"))
        links = after


def groups(docs: DataFrame, words: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text",
           hot_bucket: int = HOT_BUCKET, with_root: bool = False) -> DataFrame:
    """``(id, fp long, component_id)`` of every row: the smallest id reachable over links of ``max_bits`` bits or fewer.

    ``with_root`` adds ``root``, the group's least fingerprint: groups of a repeated id may share a ``component_id``."""
    more = ["root"] if with_root else []
    files = files_for(docs.count())
    rows = written(fingerprints(docs, words, id_col, text_col), "fingerprints", files, dealt=True)
    nodes = written(rows.groupBy("fp").agg(F.min(id_col).alias("low"), F.count(F.lit(1)).alias("n")), "nodes", files)
    linked = components(close_links(nodes.select("fp"), max_bits, hot_bucket), nodes.count())
    # node -> least fingerprint of its group -> least id of its group
    named = nodes.join(linked.select(F.col("node").alias("fp"), "root"), "fp", "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    named = written(named, "roots", files)
    least = named.groupBy("root").agg(F.min("low").alias("component_id"), F.count(F.lit(1)).alias("n"))
    least = written(least, "least_ids", files)
    of = lookup_join(named.select("fp", "root"), least.select("root", "component_id"), "root", counts=least.select("root", "n"))
    found = lookup_join(rows, of.select("fp", "component_id", *more), "fp", counts=nodes.select("fp", "n"))
    return found.select(id_col, "fp", "component_id", *more)


def with_fingerprints(docs: DataFrame, words: int, text_col: str, name: str) -> DataFrame:
    """``docs`` and the fingerprint of every row as the column ``name``."""
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for part in text_slices(batch, at):
                yield part.append_column(name, pa.array(fingerprint_texts(part.column(at), words).view(np.int64), pa.int64()))

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, LongType())]))


def keep_one(docs: DataFrame, words: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text",
             one_per_id: bool = True) -> DataFrame:
    """``docs`` with one row of each group: that with the smallest id (of rows with that id in the group, that with the
    least fingerprint).  Rows without an id stay.

    An id that stands for several groups, its texts being no near copies, keeps one row for each of them, or with
    ``one_per_id`` a single one."""
    files = files_for(docs.count())
    found = written(groups(docs, words, max_bits, id_col, text_col, with_root=True), "groups", files)
    twice = written(found.where(F.col(id_col).isNotNull()).groupBy(id_col).count().where("count > 1").select(id_col), "repeated", files)
    some_twice = not twice.isEmpty()
    # a single row goes by its id; rows of a repeated id go each by its fingerprint
    gone = found.where(F.col(id_col) != F.col("component_id")).select(id_col)
    out = docs.join(gone.unionByName(twice).distinct() if some_twice else gone.distinct(), id_col, "left_anti").select(*docs.columns)
    if some_twice:
        heads = found.where(F.col(id_col) == F.col("component_id")).join(twice, id_col, "left_semi")
        heads = heads.groupBy(id_col, *([] if one_per_id else ["root"])).agg(F.min("fp").alias("__vf_fp")).select(id_col, "__vf_fp")
        rows = with_fingerprints(docs.join(twice, id_col, "left_semi").select(*docs.columns), words, text_col, "__vf_fp")
        rows = rows.dropDuplicates([id_col, "__vf_fp"])  # reduced within tasks, so copies of one row don't meet in one
        out = out.unionByName(rows.join(heads, [id_col, "__vf_fp"], "left_semi").select(*docs.columns))
    return out

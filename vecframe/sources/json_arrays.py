"""A JSON array of objects read by many tasks (S2), wherever its file is cut.

The text source cuts a file into splits and the splits into pieces that end with
``}``, which quotes and nesting know nothing of.  What a piece is depends on where
the text before it leaves off: outside strings, in one, or behind a backslash in
one, and so many brackets deep.  So each task first works out its split's effect as
a function - for each of the three string states, the state after it and how much
deeper it ends.  Composing these functions from the start of each file gives every
split its own state; then each task cuts out the elements (what opens at depth
one and closes there), and elements that reach over the ends of splits are put
together from their pieces.

Defined results: elements come in any order; an element that is no object, and what
follows the array, is not an element; an empty array or file has none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecframe.session import scratch_path, ship_package

#: Outside strings, in a string, behind a backslash in a string.
STATES = ((False, False), (True, False), (True, True))
QUOTE, BACKSLASH = 34, 92
DEEPER = np.zeros(256, np.int64)
DEEPER[[ord("{"), ord("[")]] = 1
DEEPER[[ord("}"), ord("]")]] = -1

#: A whole element; the end, the beginning or the middle of one.
WHOLE, END, BEGINNING, MIDDLE = 0, 1, 2, 3


def steps(data: np.ndarray, in_string: bool, escaped: bool) -> tuple[np.ndarray, tuple[bool, bool]]:
    """By how much each byte deepens the nesting, and the string state after the last, given the one before the first."""
    n = len(data)
    at = np.arange(n)
    other = np.maximum.accumulate(np.where(data != BACKSLASH, at, -1))  # last byte up to here that is no backslash
    before = np.concatenate(([-1], other))  # before each byte, and before the end
    run = np.arange(n + 1) - 1 - before + ((before == -1) & escaped)  # backslashes right before
    behind = run % 2 == 1
    quote = (data == QUOTE) & ~behind[:n]
    inside = (np.cumsum(quote) - quote + in_string) % 2 == 1
    end = bool((int(quote.sum()) + in_string) % 2)
    return np.where(inside, 0, DEEPER[data]), (end, end and bool(behind[n]))


def write_json_array(rows: DataFrame, path: str, text_col: str = "text") -> None:
    """The JSON texts of ``rows`` as files of one array each, a file a task."""
    def run(batches):
        sign = "["
        for rb in batches:
            out = []
            for text in rb.column(0).drop_null().to_pylist():
                out.append(sign + text)
                sign = ","
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["[]" if sign == "[" else "]"], pa.string())], ["value"])

    ship_package(rows.sparkSession)
    rows.select(text_col).mapInArrow(run, "value string").write.mode("overwrite").text(path)


def _pieces(path_df: DataFrame) -> DataFrame:
    return path_df.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value"))


def _bytes(column: pa.Array) -> bytes:
    return b"".join(x + b"}" for x in column.cast(pa.binary()).to_pylist())


def _split_effects(pieces: DataFrame) -> DataFrame:
    """``(file, start, ends array<int>, deeper array<long>)`` of every split: for each string state the one after it."""
    def run(batches):
        states, depth, key = list(range(3)), [0, 0, 0], None
        done = []
        for rb in batches:
            for name, begin, part in _by_split(rb):
                if key != (name, begin):
                    if key is not None:
                        done.append((*key, states, depth))
                    states, depth, key = list(range(3)), [0, 0, 0], (name, begin)
                data = np.frombuffer(_bytes(part), np.uint8)
                effect = {s: steps(data, *STATES[s]) for s in set(states)}
                depth = [d + int(effect[s][0].sum()) for s, d in zip(states, depth)]
                states = [STATES.index(effect[s][1]) for s in states]
        if key is not None:
            done.append((*key, states, depth))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*done), (pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())))],
                                             ["file", "start", "ends", "deeper"])

    return pieces.mapInArrow(run, "file string, start long, ends array<int>, deeper array<long>")


def _by_split(rb: pa.RecordBatch):
    """A task may hold several small files or splits, one after the other."""
    if not rb.num_rows:
        return
    name, start = rb.column(0), rb.column(1).to_numpy(zero_copy_only=False)
    code = name.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    edges = np.concatenate(([0], np.flatnonzero((np.diff(code) != 0) | (np.diff(start) != 0)) + 1, [len(start)]))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        yield name[a].as_py(), int(start[a]), rb.column(2).slice(a, b - a)


def _split_starts(effects: list) -> dict[tuple[str, int], tuple[int, int]]:
    """The string state and depth in which every split begins: the effects composed in the order of each file."""
    found = {}
    now, state, depth = None, 0, 0
    for file, start, ends, deeper in sorted(effects):
        if file != now:
            now, state, depth = file, 0, 0
        found[file, start] = (state, depth)
        state, depth = ends[state], depth + deeper[state]
    return found


def array_elements(spark: SparkSession, path: str) -> DataFrame:
    """``(text)``: every object of the JSON arrays at ``path`` as it is written."""
    ship_package(spark)
    pieces = _pieces(spark.read.option("lineSep", "}").text(path))
    effects = [tuple(r) for r in _split_effects(pieces).collect()]  # a few numbers a split
    shared = spark.sparkContext.broadcast(_split_starts(effects))
    schema = T.StructType([T.StructField("file", T.StringType()), T.StructField("start", T.LongType()),
                           T.StructField("part", T.IntegerType()), T.StructField("text", T.StringType())])
    names = [f.name for f in schema]

    def run(batches):
        starts = shared.value
        key, state, depth, held, here = None, 0, 0, [], False  # held: pieces of the element that is open; here: it began in this split

        def left():
            if depth >= 2:
                return [(*key, BEGINNING if here else MIDDLE, b"".join(held).decode())]
            return []

        for rb in batches:
            rows = []
            for name, begin, part in _by_split(rb):
                if key != (name, begin):
                    if key is not None:
                        rows += left()
                    key, held, here = (name, begin), [], False
                    state, depth = starts[key]
                raw = _bytes(part)
                deeper, end = steps(np.frombuffer(raw, np.uint8), *STATES[state])
                level = depth + np.cumsum(deeper)
                data = np.frombuffer(raw, np.uint8)
                opened = np.flatnonzero((deeper == 1) & (level == 2) & (data == ord("{"))).tolist()
                closed = np.flatnonzero((deeper == -1) & (level == 1) & (data == ord("}"))).tolist()
                first = 0
                if depth >= 2 and closed and (not opened or closed[0] < opened[0]):
                    held.append(raw[:closed[0] + 1])
                    rows.append((*key, WHOLE if here else END, b"".join(held).decode()))
                    held, first = [], 1
                elif depth >= 2:
                    held.append(raw)
                rows += [(*key, WHOLE, raw[a:b + 1].decode()) for a, b in zip(opened, closed[first:])]
                if len(opened) > len(closed) - first:
                    held, here = [raw[opened[-1]:]], True
                state, depth = STATES.index(end), int(level[-1])
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int32(), pa.string()))], names)
        if key is not None and (rows := left()):
            yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int32(), pa.string()))], names)

    rows = pieces.mapInArrow(run, schema)
    whole = rows.where(F.col("part") == WHOLE).select("text")
    if len(effects) <= len({e[0] for e in effects}):  # no file was cut
        return whole
    # two pieces a split at most: the end of one element, and the beginning (or middle) of the next
    edges = scratch_path(spark, "json-edges")
    rows.where(F.col("part") != WHOLE).write.parquet(edges)
    order = Window.partitionBy("file").orderBy("start", "part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = spark.read.schema(schema).parquet(edges).withColumn("n", F.sum((F.col("part") == BEGINNING).cast("int")).over(order))
    joined = numbered.where("n > 0").groupBy("file", "n").agg(F.array_sort(F.collect_list(F.struct("start", "part", "text"))).alias("p"), F.max((F.col("part") == END).cast("int")).alias("closed"))
    return whole.unionByName(joined.where("closed = 1").select(F.array_join(F.transform("p", lambda x: x.text), "").alias("text")))

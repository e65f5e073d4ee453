"""Helpers shared by the operators: tables, batches, written intermediates, joins under skew."""

from __future__ import annotations

import contextlib
import gc

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecframe.session import scratch_path

#: Bytes of text that one kernel call works on at most (a single longer text is one call).
KERNEL_BYTES = 1 << 20

#: A key is heavy if it has more than 1/HEAVY_SHARE of all rows, so there are at most HEAVY_SHARE heavy keys.
HEAVY_SHARE = 1000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Narrow rows that one file of a written table has: small tables are written by few tasks.
ROWS_PER_FILE = 200_000


def files_for(rows: int) -> int:
    return 1 + rows // ROWS_PER_FILE


def written(df: DataFrame, name: str, files: int | None = None, dealt: bool = False) -> DataFrame:
    """``df`` written once into the shared folder and read back: cuts the lineage,
    survives lost executors, and gives the optimizer its real size.

    ``files``: as many tasks write it.  ``dealt``: its rows are dealt out to them by a shuffle, so that what
    makes the rows keeps its own number of tasks; otherwise those tasks also make the rows."""
    path = scratch_path(df.sparkSession, name)
    out = df if files is None else df.repartition(files) if dealt else df.coalesce(files)
    # only this driver reads the table, and not before the job is over: no marker file
    out.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def long_lists():
    """Kernels make long lists without cycles, and walking them again and again takes most of the time: garbage is
    collected at the end of a task, not inside.  Workers are used again, so it must be then."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()
        gc.collect()
        pa.default_memory_pool().release_unused()


def text_slices(batch: pa.RecordBatch, column: int, limit: int = KERNEL_BYTES):
    """Cut a record batch where the text column reaches ``limit`` bytes."""
    n = batch.num_rows
    if n == 0:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    block = np.cumsum(size) // limit
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(block)) + 1, [n]))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        yield batch.slice(a, b - a)


def text_buffer(column: pa.Array) -> tuple[bytes, np.ndarray]:
    """All texts of a column as one UTF-8 buffer and ``n + 1`` byte offsets (null: empty)."""
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    raw = column.buffers()[2]
    if raw is None or total == 0:
        return b"", np.concatenate(([0], ends))
    first = int(np.frombuffer(column.buffers()[1], np.int32)[column.offset])
    if column.null_count:  # bytes under a null slot are not ours to read
        return b"".join(x.encode() for x in column.to_pylist() if x), np.concatenate(([0], ends))
    return raw[first:first + total].to_pybytes(), np.concatenate(([0], ends))


FACTOR = 0x9E3779B97F4A7C15


POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``FACTOR ** i`` and ``FACTOR ** -i`` modulo 2**64 for ``i`` below ``n``; a process keeps the longest it has made."""
    if len(POWERS[0]) < n:
        size = -(-n // (1 << 18)) << 18
        for j, base in enumerate((FACTOR, pow(FACTOR, -1, 1 << 64))):
            POWERS[j] = np.full(size, base, np.uint64)
            POWERS[j][0] = 1
            np.cumprod(POWERS[j], out=POWERS[j])
    return POWERS[0][:n], POWERS[1][:n]


def token_runs(data: np.ndarray, kind: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of texts laid end to end: runs of bytes of one non-zero ``kind``, with a 64-bit hash of their ``data``.

    Returns ``(hash, first byte, end, first token of each text and the end)``; ``at`` has the texts' byte offsets."""
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    change = edge.copy()
    change[1:-1] |= kind[1:] != kind[:-1]
    solid = kind != 0
    first = np.flatnonzero(solid & change[:-1])
    end = np.flatnonzero(solid & change[1:]) + 1
    up, down = powers(max(1, len(data)))
    total = np.zeros(len(data) + 1, np.uint64)
    np.multiply(data, up[:len(data)], out=total[1:])
    np.cumsum(total[1:], out=total[1:])
    return (total[end] - total[first]) * down[first], first, end, np.searchsorted(first, at)


#: Labelled rows that a model is fitted on at most: those whose ids have the smallest hashes.
LABELLED_ROWS = 20_000
#: Files that the sample is written to.
SAMPLE_FILES = 8


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, id_col: str = "doc_id", text_col: str = "text",
                    rows: int = LABELLED_ROWS, held_out=None) -> DataFrame:
    """``(label int, text)`` of at most ``rows`` labelled ids, without those of the condition ``held_out``.

    An id with several labels has the largest; the ids (``rows`` at most) are broadcast, so the texts are not shuffled."""
    known = labels.select(F.col("doc_id").alias("__vf_id"), F.col(label).cast("int").alias("label")).where("__vf_id is not null and label is not null")
    if held_out is not None:
        known = known.where(~held_out(F.col("__vf_id")))
    known = known.groupBy("__vf_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("__vf_id"), "__vf_id").limit(rows)
    texts = docs.select(F.col(id_col).alias("__vf_doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.join(F.broadcast(known), F.col("__vf_doc") == F.col("__vf_id")).select("label", "text")


def held_out(doc_id):
    """Rows that no label is learned from: crc32 of the id as text leaves 2 by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def map_text(df: DataFrame, columns: list[str], kernel, schema: str) -> DataFrame:
    """``kernel(record batch of columns) -> dict of columns`` over bounded slices; the text is the last column."""
    from pyspark.sql.types import StructType, _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema
    fields = _parse_datatype_string(schema)
    assert isinstance(fields, StructType)
    out = to_arrow_schema(fields)
    at = len(columns) - 1

    def run(batches):
        with long_lists():
            for batch in batches:
                for part in text_slices(batch, at):
                    got = kernel(part)
                    yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) and x.type == f.type else pa.array(x, f.type)
                                                      for f, x in zip(out, got)], schema=out)

    return df.select(*columns).mapInArrow(run, fields)


def filter_text(df: DataFrame, text_col: str, decide) -> DataFrame:
    """Rows of ``df`` (all columns as they are) for which ``decide(record batch, index of the text)`` is true."""
    at = df.columns.index(text_col)

    def run(batches):
        with long_lists():
            for batch in batches:
                for part in text_slices(batch, at):
                    yield part.filter(pa.array(decide(part, at), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def lookup_join(left: DataFrame, right: DataFrame, key: str, counts: DataFrame | None = None) -> DataFrame:
    """Left outer join on ``key`` where ``right`` has unique keys and a few keys may hold most of ``left``.

    Keys with more than 1/HEAVY_SHARE of the rows of ``left`` are at most HEAVY_SHARE; their rows of ``right`` are
    broadcast, and their rows of ``left`` are dealt out at random in the shuffle join for the other keys.
    ``counts``: ``(key, n)`` of ``left`` where the caller has them.
    """
    counts = left.groupBy(key).agg(F.count(F.lit(1)).alias("n")) if counts is None else counts
    total = counts.agg(F.sum("n")).first()[0] or 0
    heavy = counts.where((F.col("n") > max(100, total // HEAVY_SHARE)) & F.col(key).isNotNull()).select(key)
    values = [c for c in right.columns if c != key]
    few = right.join(F.broadcast(heavy), key, "left_semi")
    few = few.select(F.col(key).alias("__vf_key"), F.struct(*values).alias("__vf_few"), F.lit(True).alias("__vf_heavy"))
    rest = right.select(F.col(key).alias("__vf_rest_key"), F.struct(*values).alias("__vf_rest"))
    marked = left.join(F.broadcast(few), F.col(key) == F.col("__vf_key"), "left")
    spread = F.when(F.col("__vf_heavy") | F.col(key).isNull(), F.lit(None)).otherwise(F.col(key))
    # rows without a key in the shuffle join (heavy or null) go around it
    apart = marked.withColumn("__vf_spread", spread)
    met = (apart.where(F.col("__vf_spread").isNotNull()).join(rest, F.col("__vf_spread") == F.col("__vf_rest_key"), "left")
           .select(*left.columns, *(F.col(f"__vf_rest.{c}").alias(c) for c in values)))
    past = apart.where(F.col("__vf_spread").isNull()).select(*left.columns, *(F.col(f"__vf_few.{c}").alias(c) for c in values))
    return met.unionByName(past)

"""WARC archives written and read back with boundary-chain verification (operator 2).

Archives are plain text files of Spark's text sink: one record is one line value, and the line separator completes the
blank line that ends a record.  Payloads that an earlier page has word for word become revisit records.

Reading: Spark's text source cuts the files at the record magic, split by split, wherever the magic stands - at records and
inside payloads alike.  Every piece is a candidate record.  Its header names its length, so each task emits, for every
candidate of its splits, the offset of the record that would follow (``candidates``).  Within a split the chain from a
candidate is followed at once to where it leaves the split, so one link a candidate remains; the links that start at a file's
start or where another link ends are joined into paths by pointer jumping (``entries``: each round doubles the length of the
jumps), and only records on the path from a file's start exist.  A second pass over the splits cuts the records out, each
split from its entry on.  A payload that holds the magic comes in several pieces; they are put together again, also across splits.

Offsets are absolute: a split's first offset is the total of the splits before it.

Defined results: a null html has an empty payload; control characters in urls are percent-encoded; rows with equal ids are
written each, and the response among equal payloads is the one with the smallest id (of equal ids, each of them); a row without an id is a response;
pages that share no payload of ``least`` bytes or more are all responses; an empty table writes and reads no records; where a foreign archive
is broken, the records before that place are read; other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vecframe.llm.common import KERNEL_BYTES, files_for, lookup_join, written
from vecframe.session import bounded_broadcast

# Fixed values of the format.
MAGIC = "WARC/1.0\r\n"
NEWLINE = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

LENGTH_FIELD = r"(?im)^Content-Length: *([0-9]{1,9}) *\r?$"

#: Payloads of fewer bytes are always written in full.
LEAST_BYTES = 100


def payload_of(html: str) -> Column:
    return F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")


def record_urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def header_value(text: Column) -> Column:
    """A value that stays on its line."""
    out = F.coalesce(text, F.lit(""))
    for c, code in (("\r", "%0D"), ("\n", "%0A")):
        out = F.replace(out, F.lit(c), F.lit(code))
    return out


def revisits(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", least: int = LEAST_BYTES) -> DataFrame:
    """``(page_id, digest, refers_to)`` of pages whose payload a page with a smaller id has."""
    payload = payload_of(html_col)
    narrow = pages.where(F.col(id_col).isNotNull() & (F.octet_length(payload) >= least)).select(F.col(id_col).alias("page_id"), F.sha2(payload, 256).alias("digest"))
    files = files_for(pages.count())
    narrow = written(narrow, "digests", files, dealt=True)
    shared = written(narrow.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"), "shared", files)
    met = lookup_join(narrow, shared.select("digest", "first"), "digest", counts=shared.select("digest", "n"))
    return met.where(F.col("first") < F.col("page_id")).select("page_id", "digest", F.col("first").alias("refers_to")).distinct()


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST_BYTES) -> None:
    """One record a page; the optimizer may broadcast the revisits if their written table is small, and joins by shuffle otherwise."""
    again = written(revisits(pages, id_col, html_col, least), "revisits", files_for(pages.count()))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), payload_of(html_col).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).join(again, ["page_id", "digest"], "left")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(NEWLINE))
    repeat = F.col("refers_to").isNotNull()
    body = F.when(repeat, F.encode(F.lit(""), "UTF-8")).otherwise(F.col("payload"))
    head = F.concat(
        F.lit(MAGIC), line("WARC-Type", F.when(repeat, "revisit").otherwise("response")), line("WARC-Record-ID", record_urn(F.col("page_id"))),
        line("WARC-Date", F.lit(DATE)), line("WARC-Target-URI", header_value(F.col("url"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))), line("WARC-Payload-Length", F.octet_length("payload").cast("string")),
        F.when(repeat, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", record_urn(F.col("refers_to"))))).otherwise(""),
        line("Content-Type", F.lit("text/html")), line("Content-Length", F.octet_length(body).cast("string")), F.lit(NEWLINE))
    # the payload is valid UTF-8, so a string holds the very bytes; the separator is the second half of the blank line
    rows.select(F.concat(head, body.cast("string"), F.lit(NEWLINE)).alias("value")).write.option("lineSep", NEWLINE).text(path)


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """Every stretch between magics, with its file and split, in the files' order within a split."""
    return (spark.read.option("lineSep", MAGIC).text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value")))


def archive_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the archive's files (a listing)."""
    sc = spark.sparkContext
    folder = sc._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(sc._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()


HEAD = len(MAGIC)


#: Where a chain leads whose next record is broken: nowhere, but the records before it stand.
BROKEN = 1 << 62


def chained(offset: np.ndarray, follow: np.ndarray, region_end: int) -> np.ndarray:
    """For every candidate of a split the first offset at or beyond ``region_end`` that its chain reaches; ``BROKEN`` if
    a later candidate of the chain has no successor; -1 if the candidate itself has none."""
    place = {int(o): i for i, o in enumerate(offset.tolist())}
    out = np.full(len(offset), -1, np.int64)
    for i in range(len(offset) - 1, -1, -1):
        n = int(follow[i])
        if n >= region_end:
            out[i] = n
        elif n >= 0 and n in place:
            out[i] = out[place[n]] if out[place[n]] >= 0 else BROKEN
    return out


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """``(file, split, total, start, offset, leaves)`` of every candidate: offsets count from the split's first piece;
    ``start`` marks the file's first piece; ``total`` is the split's length in bytes, on one row of each split (else null)."""
    head = F.substring_index("value", "\r\n\r\n", 1)
    size = F.octet_length("value")
    has_head = F.octet_length(head) < size
    length = F.regexp_extract(head, LENGTH_FIELD, 1)
    numbers = pieces(spark, path).select("file", "split", size.cast("long").alias("size"),
                                         F.coalesce(F.when(has_head, F.octet_length(head) + 8 + length.try_cast("long")), F.lit(-1)).cast("long").alias("rest"))

    def run(batches):
        key, sizes, rests = None, [], []

        def emit():
            size, rest = np.concatenate(sizes), np.concatenate(rests)
            begin = np.concatenate(([0], np.cumsum(size + HEAD)))
            total = int(begin[-1])
            offset = begin[:-1] - HEAD  # where the piece's magic stands
            follow = np.where(rest >= 0, begin[:-1] + rest, -1)
            first = key[1] == 0  # what stands before a file's first magic is no candidate
            if first:
                offset, follow = offset[1:], follow[1:]
            leaves = chained(offset, follow, total - HEAD)
            n = len(offset) + 1
            names = pa.array([key[0]]).take(pa.array(np.zeros(n, np.int64)))
            return pa.RecordBatch.from_arrays([
                names, pa.array(np.full(n, key[1])), pa.array([total] + [None] * (n - 1), pa.int64()),
                pa.array(np.concatenate(([-HEAD - 1], offset))), pa.array(np.concatenate(([-1], leaves)))], ["file", "split", "total", "offset", "leaves"])

        for batch in batches:
            if not batch.num_rows:
                continue
            files = batch.column(0).dictionary_encode()
            at = batch.column(1).to_numpy()
            code = files.indices.to_numpy()
            cut = [0, *(np.flatnonzero((np.diff(code) != 0) | (np.diff(at) != 0)) + 1).tolist(), len(at)]
            for a, b in zip(cut, cut[1:]):
                now = (files.dictionary[int(code[a])].as_py(), int(at[a]))
                if now != key:
                    if key is not None:
                        yield emit()
                    key, sizes, rests = now, [], []
                sizes.append(batch.column(2).slice(a, b - a).to_numpy())
                rests.append(batch.column(3).slice(a, b - a).to_numpy())
        if key is not None:
            yield emit()

    return numbers.mapInArrow(run, "file string, split long, total long, offset long, leaves long")


def entries(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(splits, entries)``: the splits ``(file, split, base, total)`` and, for every split that the chain from its file's
    start enters, the offset ``(file, split, entry)`` where it does.  ``found``: ``candidates``, written."""
    files = files_for(found.count())
    order = Window.partitionBy("file").orderBy("split")
    splits = found.where("total is not null").select("file", "split", "total")
    splits = written(splits.withColumn("base", F.sum("total").over(order) - F.col("total")), "splits", files)
    # absolute links; a split's region is [base - HEAD, base + total - HEAD)
    links = found.where("total is null and leaves >= 0").join(splits, ["file", "split"]).select(
        "file", "split", (F.col("base") + F.col("offset")).alias("at"), F.when(F.col("leaves") < BROKEN, F.col("base") + F.col("leaves")).otherwise(F.lit(BROKEN)).alias("to"))
    links = written(links, "links", files)
    begins = splits.where("split = 0").select("file", F.lit(0).cast("long").alias("at"))
    # only where a file starts or a link ends can a chain enter a split
    doors = begins.union(links.select("file", F.col("to").alias("at"))).distinct()
    jumps = written(links.join(doors, ["file", "at"]).select("file", "split", "at", "to"), "jumps", files)
    reached = written(begins, "reached", 1)
    places = jumps.select("file", "at", "split")
    jumps = jumps.select("file", "at", "to")
    n = reached.count()
    while True:
        more = reached.join(jumps, ["file", "at"]).select("file", F.col("to").alias("at"))
        reached = written(reached.union(more).distinct(), "reached", files)
        now = reached.count()
        if now == n:
            break
        n = now
        # pointers jump twice as far
        jumps = written(jumps.join(jumps.select("file", F.col("at").alias("to"), F.col("to").alias("far")), ["file", "to"])
                        .select("file", "at", F.col("far").alias("to")), "jumps", files)
    return splits, written(reached.join(places, ["file", "at"]).select("file", "split", F.col("at").alias("entry")), "entries", files)


def cut_records(batches):
    """Records of splits that come piece by piece: whole ones (kind 0); one that goes on in the next split (1); pieces of one
    that began in an earlier split (2).  Kinds 1 and 2 have the offset where their record ends."""
    key, first, at, boundary = None, False, 0, None
    head, begin, parts, size = None, 0, [], 0
    out: list[tuple] = []

    def close(end):
        """``end``: the offset that closes the record; one that should have ended before it is broken."""
        nonlocal parts
        if parts and boundary >= end:
            body = b"".join(parts)
            over = boundary == end
            out.append((0 if over else 1, key[0], begin, head, body[:size] if over else body, boundary))
        parts = []

    def flush():
        batch = pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*out), TYPES)], NAMES)
        out.clear()
        return batch

    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(5)]
        held = 0
        for name, split, base, entry, ends, value in zip(*columns, batch.column(5).cast(pa.binary()).to_pylist()):
            if key != (name, split):
                close(at - HEAD)
                key, first, at, boundary, head = (name, split), split == 0, base, entry, None
            offset, at = at - HEAD, at + len(value) + HEAD
            if first:  # before a file's first magic
                first = False
            elif offset == boundary:
                close(offset)
                top, blank, body = value.partition(b"\r\n\r\n")
                head, begin = top.decode("utf-8", "replace"), offset
                length = re.search(LENGTH_FIELD, head)
                if blank and length:
                    size, parts = int(length[1]), [body]
                    boundary = offset + HEAD + len(top) + 4 + size + 4
                else:  # broken: the chain ends here
                    boundary = None
            elif head is not None:  # the magic inside a payload
                if boundary is not None and offset > boundary:  # the record's end is not a record's start
                    parts, boundary = [], None
                elif parts:
                    parts.append(MAGIC.encode() + value)
            elif ends is not None:
                out.append((2, name, offset, None, MAGIC.encode() + value, ends))
            held += len(value)
            if held > KERNEL_BYTES and out:
                held = 0
                yield flush()
    if key is not None:
        close(at - HEAD)
    if out:
        yield flush()


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """``(file, offset, head string, payload binary)`` of the records on the chain from each file's start."""
    found = written(candidates(spark, path), "candidates", 1 + archive_bytes(spark, path) // (256 << 20), dealt=True)
    splits, entered = entries(found)
    later = Window.partitionBy("file").orderBy("split").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # the first entry at or behind a split: what stands before it belongs to the record that ends there
    plan = splits.join(entered, ["file", "split"], "left").withColumn("ends", F.min("entry").over(later))
    broken = (F.col("split") > 0) & (F.col("total") > 0) & (F.col("entry").isNull() | (F.col("entry") > F.col("base") - HEAD))
    plan = plan.withColumn("broken", F.max(broken).over(Window.partitionBy("file")))
    plan = written(plan.select(F.col("file").alias("f"), F.col("split").alias("s"), "base", "entry", "ends", "broken"), "plan", files_for(found.count()))

    def records(which: DataFrame) -> DataFrame:
        rows = pieces(spark, path).withColumn("nth", F.monotonically_increasing_id())
        small = bounded_broadcast(which)  # one row a split
        joined = rows.join(small, (F.col("file") == F.col("f")) & (F.col("split") == F.col("s")))
        if small is which:  # too many splits to broadcast: the shuffle join's rows are put in order again
            joined = joined.sortWithinPartitions("file", "split", "nth")
        return joined.select("file", "split", "base", "entry", "ends", "value").mapInArrow(
            cut_records, "kind int, file string, offset long, head string, body binary, ends long")

    whole = records(plan).where("kind = 0").select("file", "offset", "head", F.col("body").alias("payload"))
    torn = plan.where("broken")
    if torn.isEmpty():
        return whole
    # records over several splits: their pieces in order
    parts = records(torn).where("kind > 0").groupBy("file", "ends").agg(
        F.min(F.when(F.col("kind") == 1, F.col("offset"))).alias("offset"), F.max("head").alias("head"),
        F.array_sort(F.collect_list(F.struct("offset", "body"))).alias("parts"))
    body = F.aggregate("parts", F.lit(b"").cast("binary"), lambda all_, x: F.concat(all_, x.body))
    size = F.regexp_extract("head", LENGTH_FIELD, 1).cast("int")
    parts = parts.select("file", "offset", "head", body.alias("body"), size.alias("size")).where(F.octet_length("body") >= F.col("size"))  # else cut off
    return whole.unionByName(parts.select("file", "offset", "head", F.substring("body", F.lit(1), F.col("size")).alias("payload")))


TYPES = (pa.int32(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.int64())
NAMES = ["kind", "file", "offset", "head", "body", "ends"]

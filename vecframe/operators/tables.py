"""Collections as day-partitioned Parquet tables.

A collection is a catalog table ``USING parquet PARTITIONED BY (dt)``; its
vector dimension, metric and index kind live in ``TBLPROPERTIES``.  Rows are
appended without de-duplication: ids may repeat (the reference restarts ids
at 0 on every run), so nothing here assumes a unique key.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecframe.functions.dates import day_partition, py_day_name
from vecframe.session import bounded_broadcast, scratch_path

DEFAULT_PARTITION = "_default"


def bench_schema(dim: int) -> T.StructType:
    """``id long, value array<float>(dim), deviceCode varchar(50), createTime long``."""
    return T.StructType([
        T.StructField("id", T.LongType(), False),
        T.StructField("value", T.ArrayType(T.FloatType(), False), False, metadata={"dim": dim}),
        T.StructField("deviceCode", T.StringType(), True, metadata={"maxLength": 50}),
        T.StructField("createTime", T.LongType(), True),
    ])


def partition_list(s: str | None) -> list[str] | None:
    """Comma list of day names; empty means all (None).

    Parts are not trimmed and empty parts are kept; an empty name matches no
    day (our definition).
    """
    if s is None or s == "":
        return None
    return s.split(",")


# -- lifecycle --------------------------------------------------------------

def _ddl_columns(dim: int, text: bool = False) -> str:
    cols = "id BIGINT NOT NULL, value ARRAY<FLOAT> NOT NULL, deviceCode VARCHAR(50), createTime BIGINT"
    if text:
        cols += ", indexText VARCHAR(24576), docId BIGINT"
    return cols


def create_collection(spark: SparkSession, name: str, dim: int, index: str = "HNSW", metric: str = "IP",
                      location: str | None = None, replace: bool = False, text: bool = False, batch_key: bool = False) -> None:
    """L1 (create if absent) or L2 (``replace=True``: drop then create).

    ``batch_key``: days are sub-partitioned by ``batch_id`` (0 for plain
    appends), so that a stream's micro-batch can be written again."""
    if replace:
        drop_collection(spark, name)
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({_ddl_columns(dim, text)}, dt STRING{', batch_id BIGINT' if batch_key else ''}) USING parquet "
        f"PARTITIONED BY (dt{', batch_id' if batch_key else ''}){loc} "
        f"TBLPROPERTIES ('vecframe.dim'='{int(dim)}', 'vecframe.index'='{index.upper()}', "
        f"'vecframe.metric'='{metric.upper()}')")


def collection_exists(spark: SparkSession, name: str) -> bool:
    """L3."""
    return spark.catalog.tableExists(name)


def drop_collection(spark: SparkSession, name: str, if_exists: bool = True) -> None:
    """L4.  ``if_exists=False`` fails on a missing table (the newer drivers' behaviour)."""
    spark.sql(f"DROP TABLE {'IF EXISTS ' if if_exists else ''}{name}")


def drop_all(spark: SparkSession, database: str | None = None, confirm: bool = False) -> list[str]:
    """Drop every table of one database; needs ``confirm=True``."""
    if not confirm:
        raise ValueError("drop_all needs confirm=True")
    names = [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]
    for n in names:
        spark.sql(f"DROP TABLE IF EXISTS {database + '.' if database else ''}{n}")
    return names


def collection_props(spark: SparkSession, name: str) -> dict:
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    return {r["key"]: r["value"] for r in rows}


def partition_specs(spark: SparkSession, name: str, day: str | None = None) -> list[dict[str, str]]:
    """The partitions of a collection (of one day) as ``{column: value}``; a day of a ``batch_key`` table has many."""
    from urllib.parse import unquote
    only = f" PARTITION (dt='{_quoted(day)}')" if day is not None else ""
    return [{k: unquote(v) for k, v in (part.split("=", 1) for part in r[0].split("/"))}
            for r in spark.sql(f"SHOW PARTITIONS {name}{only}").collect()]


def _quoted(value: str) -> str:
    return value.replace("\\", "\\\\").replace("'", "\\'")


def _spec(values: dict[str, str]) -> str:
    return "PARTITION (" + ", ".join(f"{k}='{_quoted(v)}'" for k, v in values.items()) + ")"


def list_partitions(spark: SparkSession, name: str) -> list[str]:
    """Day names that exist (creation is implicit on write)."""
    return sorted({p["dt"] for p in partition_specs(spark, name)})


def partition_exists(spark: SparkSession, name: str, day: str) -> bool:
    return bool(partition_specs(spark, name, day))


def load(df: DataFrame) -> DataFrame:
    """Read a collection into executor memory (what does not fit goes to disk), so that searches read it there."""
    from pyspark import StorageLevel
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    kept.count()
    return kept


def release(df: DataFrame) -> DataFrame:
    """Free the memory; later searches read the files again."""
    return df.unpersist(blocking=True)


# -- writes -----------------------------------------------------------------

def _checked(df: DataFrame, dim: int) -> DataFrame:
    """Reject rows whose vector length differs from the table dimension."""
    return df.withColumn("value", F.when(F.size("value") == dim, F.col("value")).otherwise(
        F.raise_error(F.concat(F.lit("vector dimension must be "), F.lit(str(dim)))).cast("array<float>")))


def append(spark: SparkSession, name: str, rows: DataFrame, day: str | None = None, batch_id: int | None = None) -> None:
    """S6/S7 (``day=None`` = default partition) and P1 (a named day).

    Rows carry their own ``dt`` when ``day`` is omitted and the column exists.
    ``REBALANCE(dt)`` brings a day's rows together (few files) and splits a
    large day over tasks by its size.
    """
    props = collection_props(spark, name)
    dim = int(props.get("vecframe.dim", "0"))
    if day is not None:
        rows = rows.withColumn("dt", F.lit(day))
    elif "dt" not in rows.columns:
        rows = rows.withColumn("dt", F.lit(DEFAULT_PARTITION))
    cols = [c for c in spark.table(name).columns]
    out = _checked(rows, dim) if dim else rows
    if "batch_id" in cols:
        out = out.withColumn("batch_id", F.lit(batch_id or 0).cast("long"))
        if batch_id is not None:  # the batch's own partitions are replaced, all others stay
            session, key = out.sparkSession, "spark.sql.sources.partitionOverwriteMode"
            before = session.conf.get(key)
            session.conf.set(key, "dynamic")
            try:
                out.select(*cols).hint("rebalance", "dt").write.mode("overwrite").insertInto(name)
            finally:
                session.conf.set(key, before)
            return
    out.select(*cols).hint("rebalance", "dt").write.insertInto(name)


def append_today(spark: SparkSession, name: str, rows: DataFrame, ts_col: str = "createTime") -> None:
    """The day partition comes from each row's epoch-ms timestamp."""
    rows = rows.withColumn("dt", day_partition(F.timestamp_millis(F.col(ts_col))))
    append(spark, name, rows)


def _partition_location(spark: SparkSession, name: str, values: dict[str, str]) -> str | None:
    rows = spark.sql(f"DESCRIBE FORMATTED {name} {_spec(values)}").collect()
    return next((r["data_type"] for r in rows if r["col_name"] == "Location"), None)


def _delete(spark: SparkSession, folders) -> None:
    sc = spark.sparkContext
    for folder in folders:
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


# Partitions that one catalog statement drops.
SPECS_PER_DROP = 500


def _drop_partitions(spark: SparkSession, name: str, specs: list[dict[str, str]]) -> None:
    for i in range(0, len(specs), SPECS_PER_DROP):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(_spec(p) for p in specs[i:i + SPECS_PER_DROP])}")


def expire_day(spark: SparkSession, name: str, today: _dt.date, keep_days: int, purge: bool = True) -> str:
    """Drop exactly the day ``today - keep_days`` (older days stay), with all its batches.

    ``purge`` also deletes the partitions' folders: on an external table the
    catalog drop alone keeps the files, which would neither free the storage
    nor stay expired if the location were registered again."""
    day = py_day_name(today, keep_days)
    specs = partition_specs(spark, name, day)
    doomed = [_partition_location(spark, name, p) for p in specs] if purge else []
    _drop_partitions(spark, name, specs)
    ivf_path = collection_props(spark, name).get("vecframe.ivf.path")
    if ivf_path:
        doomed.append(f"{ivf_path}/cells/dt={day}")
    _delete(spark, [x for x in doomed if x])  # the day's files, and its rows in the derived cell table
    return day


def expire_filter(df: DataFrame, today: _dt.date, keep_days: int, partition_col: str = "dt") -> DataFrame:
    """The rows that survive :func:`expire_day`, as a lazy filter."""
    return df.where(F.col(partition_col) != F.lit(py_day_name(today, keep_days)))


# -- counts -----------------------------------------------------------------

def count_rows(df: DataFrame) -> DataFrame:
    """Q1: partial counts per task, one final row."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def count_partitions(df: DataFrame, days: Sequence[str] | None, partition_col: str = "dt") -> DataFrame:
    """Q2: rows per named day (all days when ``days`` is None/empty).

    On a partitioned table the ``isin`` predicate becomes a PartitionFilter,
    so only those directories are listed and read.
    """
    if days:
        df = df.where(F.col(partition_col).isin(list(days)))
    return df.groupBy(partition_col).agg(F.count(F.lit(1)).alias("n"))


def day_counts(spark: SparkSession, name: str) -> DataFrame:
    """Existing rows per day, read once before a backfill."""
    return count_partitions(spark.table(name), None)


# -- many collections (L6) --------------------------------------------------

def numbered_rows(spark: SparkSession, start: int, end: int, rows_per: int, dim: int,
                  prefix: str = "coll_", seed: int = 13) -> DataFrame:
    """Rows for collections ``prefix{start..end}`` made in one job.

    One ``spark.range`` over all rows; the collection number and the row id
    inside it are derived from the running index (no cross product)."""
    n_coll = end - start + 1
    if n_coll <= 0 or rows_per <= 0:
        raise ValueError("empty collection range")
    base = spark.range(n_coll * rows_per).select(
        (F.lit(start) + F.floor(F.col("id") / rows_per)).cast("long").alias("_n"),
        F.pmod(F.col("id"), F.lit(rows_per)).alias("id"))
    return _numbered(base, dim, prefix, seed)


def _numbered(base: DataFrame, dim: int, prefix: str, seed: int) -> DataFrame:
    from vecframe.sources.generate import text_columns
    return base.select(F.concat(F.lit(prefix), F.col("_n").cast("string")).alias("collection"),
                       *text_columns(F.col("id").cast("long"), dim, seed))


def create_numbered(spark: SparkSession, name: str, start: int, end: int, rows_per: int, dim: int,
                    location: str | None = None, prefix: str = "coll_") -> None:
    """Create-and-fill: one table partitioned by ``collection``."""
    rows = numbered_rows(spark, start, end, rows_per, dim, prefix)
    w = rows.hint("rebalance", "collection").write.mode("overwrite").partitionBy("collection")
    if location:
        w = w.option("path", location)
    w.saveAsTable(name)


# -- bounded append (S8) ----------------------------------------------------

def request_rows(requests: DataFrame, dim: int, now_ms, num_col: str = "num", seed: int = 7) -> DataFrame:
    """``now_ms``: epoch ms, or a column of the requests.  Rows for accepted insert requests: ``num`` rows each, ids ``0..num-1``
    per request (ids repeat across requests, as in the reference).  A request
    is at most 50,000 rows, so the explode is bounded per row."""
    from vecframe.sources.generate import bench_rows
    ids = requests.where(F.col(num_col).isNotNull() & (F.col(num_col) > 0)).select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.col(num_col).cast("long") - 1)).alias("id"),
        (now_ms if isinstance(now_ms, Column) else F.lit(int(now_ms)).cast("long")).alias("_now"))
    return bench_rows(ids, dim, F.col("_now"), seed=seed)


def bounded_append(spark: SparkSession, name: str, num_text: str | None, now_ms: int, day: str | None = None) -> int:
    """Validate the request size (integer text, 0..50000, default 1000),
    then append that many generated rows; returns the number appended."""
    from vecframe.functions.text import validate_insert_num
    text = "1000" if num_text is None else num_text
    req = spark.createDataFrame([(text,)], "num_text string")
    num, err = validate_insert_num(F.col("num_text"))
    row = req.select(num.alias("num"), err.alias("error")).first()
    if row["error"] is not None:
        raise ValueError(row["error"])
    dim = int(collection_props(spark, name).get("vecframe.dim", "0"))
    append(spark, name, request_rows(req.select(num.alias("num")), dim, now_ms), day=day)
    return int(row["num"])


# -- small files (streaming appends) ----------------------------------------

# Batch number of a compacted day: no stream writes it.
COMPACTED = -1


def compact_day(spark: SparkSession, name: str, day: str, n_files: int, new_location: str,
                delete_old: bool = True) -> str:
    """Rewrite one closed day into ``n_files`` files at a *new* folder, then
    point the partition there.  The old files stay until the switch, so a
    failed rewrite leaves the table unchanged; after it they are deleted.

    All batches of a ``batch_key`` table's day become the batch ``COMPACTED``; do that only when the stream's
    checkpoint has passed the day, since a batch that is written again would come back beside it."""
    old = partition_specs(spark, name, day)
    places = [_partition_location(spark, name, p) for p in old]
    keys = ["dt", "batch_id"] if any("batch_id" in p for p in old) else ["dt"]
    rows = spark.table(name).where(F.col("dt") == day).drop(*keys)
    rows.repartition(n_files).write.mode("error").parquet(new_location)
    if keys == ["dt"]:
        spark.sql(f"ALTER TABLE {name} PARTITION (dt='{_quoted(day)}') SET LOCATION '{new_location}'")
    else:  # dropping an external partition leaves its files; they go when the new one is there
        one = {"dt": day, "batch_id": str(COMPACTED)}
        _drop_partitions(spark, name, old)
        spark.sql(f"ALTER TABLE {name} ADD {_spec(one)} LOCATION '{new_location}'")
    spark.catalog.refreshTable(name)
    if delete_old:
        _delete(spark, [p for p in places if p and p.rstrip("/") != new_location.rstrip("/")])
    return new_location


# -- index structures and search through the collection's settings ---------

def build_collection_index(spark: SparkSession, name: str, path: str, nlist: int | None = None,
                           method: str = "kmeans", n_files: int | None = None, spill: bool = False) -> str:
    """A1 / A2 for a collection: centroids (and SQ8 ranges) trained and saved
    under ``path``, every row assigned to its cell (with ``spill`` to two) and written day-partitioned
    and cell-sorted, and ``vecframe.ivf.path`` recorded in TBLPROPERTIES.  Trained cells are calibrated: the index says
    how many to probe.  Returns the index kind."""
    from vecframe.operators import ivf, ivf_train
    from vecframe.operators.quantize import sq8_encode, sq8_ranges
    props = collection_props(spark, name)
    kind = ivf.index_request(props.get("vecframe.index", ""))
    if kind not in ("ivf", "ivf_sq8"):
        raise ValueError(f"index {props.get('vecframe.index')!r} keeps no cell structure")
    base = spark.table(name)
    index = ivf.build_index(base, props.get("vecframe.metric", "IP"), nlist, method)
    if kind == "ivf_sq8":
        index.lo, index.hi = sq8_ranges(base, index.dim)
    # the files that the cells are made of; rows of other files are assigned when they are searched
    spark.createDataFrame([(f,) for f in sorted(live_files(spark, name))], "source string").write.mode("overwrite").parquet(f"{path}/files")
    files = spark.read.schema("source string").parquet(f"{path}/files")
    tagged = base.withColumn(SOURCE, source_file())
    cells = ivf.assign_cells(tagged.join(bounded_broadcast(files), tagged[SOURCE] == files["source"], "left_semi"), index, spill=spill)
    if kind == "ivf_sq8":
        cells = sq8_encode(cells, index.lo, index.hi)
    if method == "kmeans" or spill:
        place = scratch_path(spark, "ivf-rows")  # both copies of a spilled row must read the same key
        cells.write.parquet(place)
        cells = spark.read.schema(cells.schema).parquet(place)
    if method == "kmeans":
        index = ivf_train.calibrate(cells, index)
    ivf.save_index(spark, index, f"{path}/centroids")
    ivf.write_assigned(ivf.spilled(cells), f"{path}/cells", n_files)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('vecframe.ivf.path'='{path}', 'vecframe.ivf.spill'='{int(spill and index.nlist > 1)}')")
    return kind


# Column of the cell table with the file that a row comes from.
SOURCE = "_source"


def source_file():
    """A row's file by the last two parts of its path (folder and name: unique, and the same however the path is written)."""
    return F.regexp_extract("_metadata.file_path", "([^/]+/[^/]+)$", 1)


def live_files(spark: SparkSession, name: str) -> dict[str, str]:
    """Files of a collection by their last two parts (a listing, no job)."""
    spark.catalog.refreshTable(name)
    return {"/".join(f.split("/")[-2:]): f for f in spark.table(name).inputFiles()}


def collection_search(spark: SparkSession, name: str, queries, k: int = 10, *, partitions=None,
                      fields=("deviceCode", "createTime", "dt"), metric: str | None = None,
                      ivf_index=None, nprobe: int | None = None, rerank: bool = False, where=None) -> DataFrame:
    """Search a collection the way its ``TBLPROPERTIES`` say.

    The metric is the one stored at creation unless ``metric`` overrides it
    (as the older driver does); a stored cell structure serves its own metric
    only, another is refused.  ``HNSW`` / ``FLAT`` / ``AUTOINDEX`` answer exactly.
    ``IVF_FLAT`` / ``GPU_IVF_FLAT`` / ``IVF_SQ8`` use the structure made by
    :func:`build_collection_index` (or ``ivf_index`` given here): the stored
    cell table for the files that it was made of and that are still there, plus
    the rows of all other files - appended since to whatever day - assigned on
    the fly with the stored centroids; with no structure they answer exactly.  An
    index name that is none of these created no index, so the search returns
    no rows (with the result schema), as in the reference.  ``where``: a predicate on the rows; cells are then chosen by it
    and the vector together.
    """
    from vecframe.operators import ivf
    from vecframe.operators.search import search
    props = collection_props(spark, name)
    kind = ivf.index_request(props.get("vecframe.index", ""))
    m = (metric or props.get("vecframe.metric", "IP")).upper()
    dim = int(props.get("vecframe.dim", "0")) or None  # stored: no probe job
    base = spark.table(name)
    if partitions:
        base = base.where(F.col("dt").isin(list(partitions)))
    tie = ["dt", "createTime"]
    if kind == "none":
        return search(base.limit(0), queries, m, k, fields=list(fields), tie_cols=tie, dim=dim or 1)
    path = props.get("vecframe.ivf.path")
    if kind in ("ivf", "ivf_sq8") and (ivf_index is not None or path):
        index = ivf_index or ivf.load_index(spark, f"{path}/centroids")
        if index.metric != m:
            raise ValueError(f"the index was built for {index.metric}; it can't serve {m}")
        codes = None
        if ivf_index is not None:
            cells = ivf.assign_cells(base, index)
        else:
            codes = "codes" if kind == "ivf_sq8" else None

            def assigned(df):
                out = ivf.assign_cells(df, index)
                if codes:
                    from vecframe.operators.quantize import sq8_encode
                    out = sq8_encode(out, index.lo, index.hi)
                return out

            tagged = base.withColumn(SOURCE, source_file())
            live = live_files(spark, name)
            built = {r[0] for r in spark.read.parquet(f"{path}/files").collect()}  # one short name a file
            fresh = sorted(set(live) - built)
            gone = sorted(built - set(live))
            schema = assigned(tagged.limit(0)).schema  # no inference: the folder may hold no day at all
            keyed = props.get("vecframe.ivf.spill") == "1"
            if keyed:
                schema = schema.add(T.StructField(ivf.ROW, T.LongType()))
            stored = spark.read.schema(schema).option("basePath", f"{path}/cells").parquet(f"{path}/cells")
            if partitions:
                stored = stored.where(F.col("dt").isin(list(partitions)))
            if gone:  # expired or rewritten since
                names = spark.createDataFrame([(f,) for f in gone], "name string")
                stored = stored.join(bounded_broadcast(names), F.col(SOURCE) == F.col("name"), "left_anti")
            cells = stored
            if fresh:
                # a filter on the file name prunes the listing: only new files are read (a join would read all)
                new = assigned(tagged.where(F.col(SOURCE).isin(fresh)))
                if keyed:  # these rows are in one cell: any key of their own will do
                    new = new.withColumn(ivf.ROW, -1 - F.monotonically_increasing_id())
                cells = stored.unionByName(new.select(*stored.columns))
        return ivf.ivf_search(cells, queries, index, k, nprobe, fields=list(fields), tie_cols=tie,
                              codes_col=codes, rerank=rerank and codes is not None, where=where)
    return search(base, queries, m, k, fields=list(fields), tie_cols=tie, dim=dim, where=where)

"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # dt=yyyyMMdd directories must come back as strings, not integers
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "vecframe", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators rely on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    On a cluster ``spark.checkpoint.dir`` must name a shared (distributed)
    folder; it is only filled in here when unset *and* the master is local,
    as in tests.
    """
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not re.match(r"local(\[|$)", sc.master):  # a local cluster is a cluster
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="vecframe-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder.

    Used for written intermediate tables and streaming sinks / checkpoints,
    so that every executor (and a restarted driver) sees the same files.
    """
    base = spark.conf.get("vecframe.scratch.dir", None) or ensure_checkpoint_dir(spark)
    base = base.rstrip("/")
    return f"{base}/vecframe-{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for local filesystem calls in tests."""
    return path[5:] if path.startswith("file:") else path


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint into the shared folder (never a local one)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


__all__ = ["get_spark", "ensure_checkpoint_dir", "scratch_path", "cut_lineage", "local_path"]


# Largest side table (rows) that may be broadcast without further thought.
MAX_BROADCAST_ROWS = 2_000_000


def bounded_broadcast(df, max_rows: int = MAX_BROADCAST_ROWS):
    """``broadcast(df)`` only when a count proves it small; otherwise the plain
    DataFrame, so the join falls back to a shuffle join (AQE may still pick a
    broadcast at run time from real sizes)."""
    from pyspark.sql import functions as F
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df



_SHIPPED: set[str] = set()


def ship_package(spark) -> None:
    """Make ``vecframe`` importable in Python workers (once per application).

    The package is zipped in memory, written into the shared checkpoint
    folder through the Hadoop FileSystem API and added with ``addPyFile`` -
    what ``--py-files`` does - so Arrow / pandas tasks can unpickle functions
    that live in it, whatever the driver's working directory.
    """
    import io
    import zipfile
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for root, dirs, files in os.walk(pkg_dir):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.join("vecframe", os.path.relpath(full, pkg_dir)))
    target = f"{scratch_path(spark, 'pyfiles')}/vecframe.zip"
    jvm = sc._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(target)
    out = jpath.getFileSystem(sc._jsc.hadoopConfiguration()).create(jpath, True)
    out.write(bytearray(buf.getvalue()))
    out.close()
    sc.addPyFile(target)
    _SHIPPED.add(app)

"""Dense row numbers without a global sort (S5 batch split, S14 ids).

``row_no = offset[partition] + index within partition``:

1. tag each row with ``spark_partition_id()`` and its index inside the
   partition (``monotonically_increasing_id() - (pid << 33)``);
2. count rows per partition (one tiny row per partition) and prefix-sum
   that small table with a window - its size is the partition count;
3. join the offsets back (broadcast while a count proves them small).

Both passes must see the same partitions.  The input is first cut with a
reliable ``checkpoint()`` into the shared checkpoint folder; ``stable=True``
saves that where it is a plain file scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vecframe.session import bounded_broadcast, cut_lineage


def with_row_numbers(df: DataFrame, col: str = "row_no", stable: bool = False) -> DataFrame:
    return numbered(df, col, stable)[0]


def numbered(df: DataFrame, col: str = "row_no", stable: bool = False) -> tuple[DataFrame, int]:
    """``(df with dense row numbers, total rows)``.

    The per-partition counts stay in Spark: a small checkpointed table (one row per
    input partition) with a running sum over it, joined back behind a size
    check; only the total comes to the driver."""
    if not stable:
        df = cut_lineage(df)
    tagged = (df.withColumn("_pid", F.spark_partition_id())
              .withColumn("_local", F.monotonically_increasing_id() - F.shiftleft(F.col("_pid").cast("long"), 33)))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    counts = cut_lineage(counts)
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = counts.withColumn("_offset", F.sum("_n").over(w) - F.col("_n")).select("_pid", "_offset")
    total = int(counts.agg(F.sum("_n")).first()[0] or 0)
    out = (tagged.join(bounded_broadcast(offsets), "_pid")
           .withColumn(col, F.col("_offset") + F.col("_local"))
           .drop("_pid", "_local", "_offset"))
    return out, total


def batch_split(df: DataFrame, batch_size: int, col: str = "batch", stable: bool = False) -> DataFrame:
    """``batch = floor(row_no / batch_size)``; ``ceil(n / size)`` batches."""
    return batch_split_counted(df, batch_size, col, stable)[0]


def batch_split_counted(df: DataFrame, batch_size: int, col: str = "batch",
                        stable: bool = False) -> tuple[DataFrame, int]:
    """:func:`batch_split` plus the row total."""
    if batch_size <= 0:
        raise ValueError("batch size must be positive")
    rows, n = numbered(df, "_row_no", stable)
    return rows.withColumn(col, F.floor(F.col("_row_no") / batch_size).cast("long")).drop("_row_no"), n


def batch_counts(df: DataFrame, batch_size: int, stable: bool = False) -> DataFrame:
    """Rows per batch (progress report of a batched load)."""
    return batch_split(df, batch_size, stable=stable).groupBy("batch").agg(F.count(F.lit(1)).alias("n"))


def assign_ids(df: DataFrame, col: str = "id", start: int = 0, stable: bool = False) -> DataFrame:
    """S14, ``auto_id``: dense ids ``start .. start+n-1`` in input order."""
    return with_row_numbers(df, "_rn", stable).withColumn(col, F.col("_rn") + F.lit(start)).drop("_rn")


def hash_ids(df: DataFrame, cols: list[str], col: str = "id", seed: int = 42) -> DataFrame:
    """S14, when re-runs must agree regardless of partitioning: a row hash."""
    return df.withColumn(col, F.xxhash64(F.lit(seed), *[F.col(c) for c in cols]))

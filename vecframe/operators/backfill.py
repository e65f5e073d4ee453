"""Capacity-limited backfill by day (P2) and ingest progress.

The reference loops over batches: a day takes batches until its total
reaches the maximum, then the walk moves one day back.  Closed form: with
existing count ``c_d`` of the d-th day of the walk, batch size ``b`` and
maximum ``M``, day d takes ``cap_d = greatest(1, ceil((M - c_d) / b))``
batches; batch ``n`` belongs to the day whose ``[first, first + cap)``
holds ``n``.  No loop: the calendar is a small table (one row per day
touched).  Past the last day that already holds rows every day takes exactly
``c0 = ceil(M / b)`` batches, so a row's day is a formula of its batch
number; only the batches of that short prefix are looked up, through a
broadcast of ``(batch, dt)`` - the rows themselves are never shuffled.
"""

from __future__ import annotations

import datetime as _dt
import math

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vecframe.session import bounded_broadcast, cut_lineage
from vecframe.sources.batches import batch_split_counted


@dataclass
class DayPlan:
    """Where the batches of a backfill go.

    ``prefix``: one row per day from the start back to the oldest day that
    already holds rows and is reached - ``(day_index, dt, existing, cap,
    first_batch, batches)``; its size is bounded by the age span of the
    existing day partitions, not by the load.  Every later day takes ``c0``
    batches, so it is a formula of the batch number.
    """
    prefix: DataFrame
    prefix_days: int
    prefix_batches: int
    c0: int
    start: _dt.date
    n_batches: int
    partition_col: str = "dt"

    def day_index(self, batch: Column) -> Column:
        """Day index of a tail batch (``batch >= prefix_batches``)."""
        return F.lit(self.prefix_days) + F.floor((batch - F.lit(self.prefix_batches)) / F.lit(self.c0))

    def attach(self, df: DataFrame, batch_col: str = "batch") -> DataFrame:
        """Adds ``day_index`` and the day name to rows that carry a batch
        number: a broadcast lookup for the prefix batches, a formula after it -
        the rows are never shuffled."""
        lookup = bounded_broadcast(batch_days(self.prefix, self.partition_col)
                                   .select(F.col("batch").alias(batch_col), F.col("day_index").alias("_pidx")))
        start_lit = F.lit(self.start.isoformat()).cast("date")
        idx = F.coalesce(F.col("_pidx"), self.day_index(F.col(batch_col))).cast("long")
        return (df.join(lookup, batch_col, "left").withColumn("day_index", idx).drop("_pidx")
                .withColumn(self.partition_col, F.date_format(F.date_sub(start_lit, F.col("day_index").cast("int")),
                                                              "yyyyMMdd")))

    def batches(self, spark: SparkSession) -> DataFrame:
        """``(batch, day_index, dt)`` for every batch, spread over the cluster."""
        return self.attach(spark.range(self.n_batches).withColumnRenamed("id", "batch"))


def plan_days(spark: SparkSession, existing: DataFrame, start: _dt.date, n_batches: int, batch_size: int,
              max_rows: int, partition_col: str = "dt") -> DayPlan:
    """The closed form of the reference's loop.  ``existing``: ``(dt, n)``
    counts read *before* the load (P4); partitions that are no days, such as the
    default one, take no part."""
    c0 = max(1, math.ceil(max_rows / batch_size))
    start_lit = F.lit(start.isoformat()).cast("date")
    ex = (existing.select(F.col(partition_col), F.col("n").cast("long").alias("existing"))
          .withColumn("day_index", F.datediff(start_lit, F.try_to_date(F.col(partition_col), "yyyyMMdd")).cast("long"))
          .where((F.col("day_index") >= 0) & (F.col("day_index") < n_batches) & (F.col("existing") > 0)))
    last = ex.agg(F.max("day_index")).first()[0]  # one row per existing day partition, aggregated
    n_prefix = 0 if last is None else int(last) + 1
    if n_prefix == 0:
        empty = spark.createDataFrame([], f"day_index long, {partition_col} string, existing long, cap long, "
                                          "first_batch long, batches long")
        return DayPlan(empty, 0, 0, c0, start, n_batches, partition_col)
    days = spark.range(n_prefix).select(
        F.col("id").alias("day_index"),
        F.date_format(F.date_sub(start_lit, F.col("id").cast("int")), "yyyyMMdd").alias(partition_col))
    cal = (days.join(bounded_broadcast(ex.select(partition_col, "existing")), partition_col, "left")
           .withColumn("existing", F.coalesce("existing", F.lit(0).cast("long")))
           .withColumn("cap", F.greatest(F.lit(1).cast("long"),
                                         F.ceil((F.lit(max_rows) - F.col("existing")) / F.lit(batch_size)).cast("long"))))
    # running sum over the prefix only (bounded by the existing days' age span)
    w = Window.orderBy("day_index").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cal = cal.withColumn("first_batch", F.sum("cap").over(w) - F.col("cap"))
    cal = (cal.where(F.col("first_batch") < n_batches)
           .withColumn("batches", F.least(F.col("cap"), F.lit(n_batches) - F.col("first_batch"))))
    cal = cut_lineage(cal)
    agg = cal.agg(F.count(F.lit(1)).alias("d"), F.sum("batches").alias("b")).first()
    return DayPlan(cal, int(agg["d"]), int(agg["b"] or 0), c0, start, n_batches, partition_col)


def batch_days(cal: DataFrame, partition_col: str = "dt") -> DataFrame:
    """``(batch, day_index, dt)``: prefix days exploded to one row per batch."""
    return cal.select(
        F.explode(F.sequence(F.col("first_batch"), F.col("first_batch") + F.col("batches") - 1)).alias("batch"),
        "day_index", partition_col)


def assign_days(rows: DataFrame, existing: DataFrame, start: _dt.date, batch_size: int, max_rows: int,
                partition_col: str = "dt", stable: bool = False) -> tuple[DataFrame, DayPlan]:
    """Rows with ``batch``, ``day_index`` and ``dt`` filled in, plus the plan used."""
    spark = rows.sparkSession
    with_batch, n = batch_split_counted(rows.drop(partition_col) if partition_col in rows.columns else rows,
                                        batch_size, stable=stable)
    plan = plan_days(spark, existing, start, max(1, math.ceil(n / batch_size)), batch_size, max_rows, partition_col)
    return plan.attach(with_batch), plan


def _existing_of(plan: DayPlan) -> DataFrame:
    return plan.prefix.select("day_index", "existing")


def plan_summary(assigned: DataFrame, plan: DayPlan, partition_col: str = "dt") -> DataFrame:
    """Per day: existing rows, batches and rows added, new total."""
    per_day = assigned.groupBy("day_index", partition_col).agg(
        F.countDistinct("batch").cast("long").alias("batches"), F.count(F.lit(1)).alias("rows"))
    return (per_day.join(_existing_of(plan), "day_index", "left")
            .withColumn("existing", F.coalesce("existing", F.lit(0).cast("long")))
            .select(partition_col, "existing", "batches", "rows", (F.col("existing") + F.col("rows")).alias("total")))


def progress(assigned: DataFrame, plan: DayPlan, partition_col: str = "dt") -> DataFrame:
    """Per batch, the day's running total after that batch (a window per
    day: its batches, at most ``c0`` or the day's cap)."""
    per_batch = assigned.groupBy("batch", "day_index", partition_col).agg(F.count(F.lit(1)).alias("rows"))
    w = Window.partitionBy("day_index").orderBy("batch").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (per_batch.join(_existing_of(plan), "day_index", "left")
            .withColumn("existing", F.coalesce("existing", F.lit(0).cast("long")))
            .withColumn("day_total", F.col("existing") + F.sum("rows").over(w))
            .select("batch", partition_col, "rows", "day_total"))

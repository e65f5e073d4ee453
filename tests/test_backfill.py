import datetime as dt
import math
import random

from pyspark.sql import functions as F

from vecframe.operators.backfill import assign_days, plan_days


def sequential(existing_by_index, n_batches, b, M):
    """The reference's loop: insert a batch, then roll back a day once full."""
    day, total, out = 0, existing_by_index.get(0, 0), []
    for _ in range(n_batches):
        out.append(day)
        total += b
        if total >= M:
            day += 1
            total = existing_by_index.get(day, 0)
    return out


def plan(spark, existing_by_index, n_batches, b, M):
    start = dt.date(2025, 8, 16)
    rows = [((start - dt.timedelta(days=i)).strftime("%Y%m%d"), n) for i, n in existing_by_index.items()]
    ex = spark.createDataFrame(rows, "dt string, n long")
    plan = plan_days(spark, ex, start, n_batches, b, M)
    return [r["day_index"] for r in plan.batches(spark).orderBy("batch").collect()]


def test_fixture_cases(spark):
    assert plan(spark, {}, 7, 10, 25) == [0, 0, 0, 1, 1, 1, 2]
    assert plan(spark, {0: 30}, 4, 10, 25) == [0, 1, 1, 1]
    assert plan(spark, {}, 5, 10, 20) == [0, 0, 1, 1, 2]


def test_closed_form_equals_loop(spark):
    rnd = random.Random(3)
    for _ in range(12):
        b = rnd.randint(1, 20)
        M = rnd.randint(1, 90)
        n = rnd.randint(1, 40)
        ex = {i: rnd.randint(0, 100) for i in range(rnd.randint(0, 6)) if rnd.random() < 0.7}
        assert plan(spark, ex, n, b, M) == sequential(ex, n, b, M), (ex, n, b, M)


def test_rows_land_in_planned_days(spark):
    rows = spark.range(95).select(F.col("id"), F.array(F.lit(1.0)).alias("value"))
    ex = spark.createDataFrame([("20250816", 10)], "dt string, n long")
    assigned, plan = assign_days(rows, ex, dt.date(2025, 8, 16), 10, 30)
    got = {r["dt"]: r["count"] for r in assigned.groupBy("dt").count().collect()}
    # day 0 holds 10 -> takes 2 batches (20 rows); then 3 batches per day
    assert got == {"20250816": 20, "20250815": 30, "20250814": 30, "20250813": 15}
    assert sum(got.values()) == 95 and plan.prefix_batches == 2 and plan.n_batches == math.ceil(95 / 10)

"""Registry of named queries: ``QUERIES[name](spark, sf_dir) -> DataFrame``.

Each query reads the driver tables (or data Spark derives from them) in
full.  ``ORACLE_SQL[name]`` is the DuckDB statement that must give the same
rows; queries without one are checked by row count and by tests.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vecframe.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)  # Python tasks must import vecframe on the workers
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["topk_ip"](spark, sf_dir)


# importing the modules fills the registry
from vecframe.plans import q_search  # noqa: E402,F401
from vecframe.plans import q_functions  # noqa: E402,F401
from vecframe.plans import q_ingest  # noqa: E402,F401
from vecframe.plans import q_ivf  # noqa: E402,F401
from vecframe.plans import q_text  # noqa: E402,F401
from vecframe.plans import q_stream  # noqa: E402,F401
from vecframe.plans import q_io  # noqa: E402,F401

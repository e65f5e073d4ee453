"""Scalar predicates that run before scoring."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecframe.functions.text import tokenize


def int_filter_threshold(df: DataFrame, rate: float) -> int:
    """``id >= floor(rate * n)`` keeps ``1 - rate`` of a dense id range."""
    n = df.count()
    return int(math.floor(n * rate))


def range_filter(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Q5: inclusive range; Parquet min/max statistics skip row groups."""
    return df.where(F.col(col).between(lo, hi))


def prefix_filter(df: DataFrame, col: str, prefix: str) -> DataFrame:
    """Q6: ``startswith`` is pushed to the scan as ``StringStartsWith``."""
    return df.where(F.col(col).startswith(prefix))


def text_match(df: DataFrame, text_col: str, terms: Sequence[str], mode: str = "any") -> DataFrame:
    """Q7 for a fixed term list: any (overlap) or all (no term missing)."""
    toks = tokenize(F.col(text_col))
    wanted = F.array(*[F.lit(t.lower()) for t in terms])
    if mode == "any":
        return df.where(F.arrays_overlap(toks, wanted))
    if mode == "all":
        return df.where(F.size(F.array_except(wanted, toks)) == 0)
    raise ValueError("mode must be 'any' or 'all'")


def layout_sorted(df: DataFrame, col: str, n_files: int) -> DataFrame:
    """Write layout for Q5: range-partitioned and sorted, so each file covers
    a narrow key range and min/max skipping works."""
    return df.repartitionByRange(n_files, col).sortWithinPartitions(col)

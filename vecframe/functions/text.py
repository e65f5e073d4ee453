"""String helpers (F3, F7, F8) and the tokenizer shared by BM25 and text match."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# token = maximal run of letters or digits, after lower-casing.
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
MAX_INSERT_NUM = 50000


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_by_comma(s) -> Column:
    """Parts are not trimmed and empty parts are kept; ``''`` gives NULL."""
    c = _col(s)
    return F.when(c == "", F.lit(None).cast("array<string>")).otherwise(F.split(c, ",", -1))


def tokenize(text) -> Column:
    """``array<string>`` of lower-cased letter/digit runs, empties removed."""
    return F.array_remove(F.split(F.lower(_col(text)), TOKEN_SPLIT, -1), "")


def device_code(n) -> Column:
    """``device100`` .. ``device199`` from any integer column."""
    return F.concat(F.lit("device"), (F.lit(100) + F.pmod(_col(n), F.lit(100))).cast("string"))


def validate_insert_num(s) -> tuple[Column, Column]:
    """Parse an insert-size argument: ``(num, error)``, exactly one is NULL.

    Accepted: an integer text in ``0 .. 50000``.
    """
    c = _col(s)
    num = F.when(c.rlike(r"^[+-]?[0-9]+$"), c.try_cast("bigint"))
    err = (F.when(num.isNull(), F.lit("not an integer"))
           .when(num > MAX_INSERT_NUM, F.lit("too many rows"))
           .when(num < 0, F.lit("negative")))
    ok_num = F.when(err.isNull(), num)
    return ok_num, err

"""Date helpers (F1, F2, F6).  All times are UTC; "now" is always passed in."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted date layouts, tried in this order.
DATE_LAYOUTS = (
    "yyyy-MM-dd",
    "yyyy/MM/dd",
    "dd-MM-yyyy",
    "dd/MM/yyyy",
    "yyyyMMdd",
    "yyyy-MM-dd H:mm:ss[.SSSSSSSSS]",
)

# The exact digit shape of each layout above, same order (an
# hour may have one digit, and seconds a fraction).
DATE_SHAPES = (
    r"^\d{4}-\d{2}-\d{2}$",
    r"^\d{4}/\d{2}/\d{2}$",
    r"^\d{2}-\d{2}-\d{4}$",
    r"^\d{2}/\d{2}/\d{4}$",
    r"^\d{8}$",
    r"^\d{4}-\d{2}-\d{2} \d{1,2}:\d{2}:\d{2}([.,]\d{1,9})?$",
)

DAY_FORMAT = "yyyyMMdd"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date_string(s) -> Column:
    """First layout that parses the whole string wins; NULL when none does.

    A layout is only tried on a string of its exact shape: a cheap regular
    expression instead of a failed parse per layout and row."""
    c = _col(s)
    c = F.replace(c, F.lit(","), F.lit("."))
    return F.coalesce(*[F.when(c.rlike(shape), F.try_to_timestamp(c, F.lit(fmt)))
                        for fmt, shape in zip(DATE_LAYOUTS, DATE_SHAPES)])


def day_shift(d, days: int | Column) -> Column:
    """``yyyyMMdd`` of the date ``days`` before ``d``."""
    n = days if isinstance(days, Column) else F.lit(int(days))
    return F.date_format(F.date_sub(_col(d).cast("date"), n), DAY_FORMAT)


def day_partition(ts) -> Column:
    """Partition name of a timestamp: ``yyyyMMdd`` in UTC."""
    return F.date_format(_col(ts), DAY_FORMAT)


def epoch_millis(ts) -> Column:
    """epoch milliseconds of an instant (``TIMESTAMP``)."""
    return F.unix_millis(_col(ts).cast("timestamp"))


def epoch_millis_utc(ts) -> Column:
    """F6 for a wall-clock ``TIMESTAMP_NTZ`` read as UTC, whatever the
    session time zone (the reference's "now" is passed in, never read)."""
    t = _col(ts)
    return (F.unix_date(F.to_date(t)).cast("long") * 86400000 + F.hour(t).cast("long") * 3600000
            + F.minute(t).cast("long") * 60000 + F.second(t).cast("long") * 1000
            + F.date_format(t, "SSS").cast("long"))


def py_day_name(day: _dt.date, days_back: int = 0) -> str:
    """Driver-side twin of :func:`day_shift` for small scalar arguments."""
    return (day - _dt.timedelta(days=days_back)).strftime("%Y%m%d")


def py_parse_day(s: str) -> _dt.date:
    """Driver-side parse of a scalar argument with the same layout order."""
    py_layouts = ("%Y-%m-%d", "%Y/%m/%d", "%d-%m-%Y", "%d/%m/%Y", "%Y%m%d", "%Y-%m-%d %H:%M:%S")
    for fmt in py_layouts:
        try:
            if fmt != "%Y%m%d" or (len(s) == 8 and s.isdigit()):
                return _dt.datetime.strptime(s, fmt).date()
        except ValueError:
            continue
    raise ValueError(f"not a date in a known layout: {s!r}")

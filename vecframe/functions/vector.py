"""Vector similarity and formatting expressions.

Scores are summed in double precision from float inputs.  L2 is the
*squared* distance (lower is better); COSINE is NULL when either vector has
zero length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

METRICS = ("IP", "L2", "COSINE")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def check_metric(metric: str) -> str:
    m = metric.upper()
    if m not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; expected one of {METRICS}")
    return m


def higher_is_better(metric: str) -> bool:
    return check_metric(metric) != "L2"


def vector_literal(values: Sequence[float]) -> Column:
    """A query vector as a literal ``array<double>`` (constant-folded by Catalyst)."""
    return F.array(*[F.lit(float(v)) for v in values])


def inner_product(a, b) -> Column:
    return F.aggregate(
        F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0), lambda acc, v: acc + v)


def squared_l2(a, b) -> Column:
    return F.aggregate(
        F.zip_with(_col(a), _col(b), lambda x, y: F.pow(x.cast("double") - y.cast("double"), 2)),
        F.lit(0.0), lambda acc, v: acc + v)


def norm_sq(a) -> Column:
    return F.aggregate(_col(a), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))


def cosine(a, b) -> Column:
    denom = F.sqrt(norm_sq(a) * norm_sq(b))
    return inner_product(a, b) / F.nullif(denom, F.lit(0.0))


def metric_score(metric: str, a, b) -> Column:
    m = check_metric(metric)
    return {"IP": inner_product, "L2": squared_l2, "COSINE": cosine}[m](a, b)


def vector_text(v) -> Column:
    """``[x1,x2,...]`` with 7 decimals, no spaces; ``[]`` for an empty vector."""
    # exact ties (e.g. 0.12890625) round half to even, as Go and C printf do
    parts = F.transform(_col(v), lambda x: F.format_string("%.7f", F.bround(x.cast("double"), 7)))
    return F.concat(F.lit("["), F.array_join(parts, ","), F.lit("]"))


def chunk_array(flat, dim: int) -> Column:
    """Cut a flat array into ``size/dim`` arrays of ``dim`` values.

    A partial tail raises (``raise_error``) instead of being dropped; an
    empty input gives an empty array.
    """
    if dim <= 0:
        raise ValueError("dim must be positive")
    a = _col(flat)
    n = F.size(a)
    chunks = F.transform(F.sequence(F.lit(0), F.greatest(n / dim - 1, F.lit(0)).cast("int")),
                         lambda i: F.slice(a, i * dim + 1, dim))
    empty = F.slice(F.array(a), 1, 0)  # typed empty array<array<T>>
    return (F.when(n == 0, empty)
            .when(n % dim != 0, F.raise_error(F.concat(F.lit("array length "), n.cast("string"),
                                                       F.lit(f" is not a multiple of dim {dim}"))))
            .otherwise(chunks))

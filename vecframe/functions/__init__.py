"""Column-level functions (JVM-side expressions, no Python in the hot path)."""

from vecframe.functions.vector import (
    METRICS, metric_score, inner_product, squared_l2, cosine, norm_sq, vector_text,
    chunk_array, vector_literal, higher_is_better,
)
from vecframe.functions.dates import parse_date_string, day_shift, epoch_millis, epoch_millis_utc, day_partition
from vecframe.functions.text import split_by_comma, tokenize, device_code, validate_insert_num

__all__ = [
    "METRICS", "metric_score", "inner_product", "squared_l2", "cosine", "norm_sq", "vector_text",
    "chunk_array", "vector_literal", "higher_is_better", "parse_date_string", "day_shift",
    "epoch_millis", "epoch_millis_utc", "day_partition", "split_by_comma", "tokenize", "device_code",
    "validate_insert_num",
]

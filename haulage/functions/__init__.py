"""Column-level building blocks (all JVM-side Spark expressions)."""

from haulage.functions.columns import (
    bucketize,
    bucketize_desc,
    content_sums,
    count_where,
    month_label,
    out_of_bounds,
    in_bounds,
    pct,
    thousands,
    parse_timestamp,
    row_hashes,
)

__all__ = [
    "bucketize",
    "bucketize_desc",
    "content_sums",
    "count_where",
    "month_label",
    "out_of_bounds",
    "in_bounds",
    "pct",
    "thousands",
    "parse_timestamp",
    "row_hashes",
]

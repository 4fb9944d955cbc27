"""Source profiles: row/column counts and NULL counts, one aggregation per source."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulage.functions import count_where


def profile(frames: dict[str, DataFrame]) -> DataFrame:
    """(source, rows, cols) per source; one count per source, stacked."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("source"), "rows", F.lit(len(df.columns)).alias("cols")
        )
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def null_profile(df: DataFrame, source: str | None = None, only_positive: bool = True) -> DataFrame:
    """(source, column_name, null_count) for columns with NULLs, one pass."""
    cols = df.columns
    agg = df.agg(*[count_where(F.col(c).isNull()).alias(c) for c in cols])
    rows = agg.unpivot([], cols, "column_name", "null_count")
    if only_positive:
        rows = rows.filter(F.col("null_count") > 0)
    return rows.select(F.lit(source).cast("string").alias("source"), "column_name", "null_count")


def null_profiles(frames: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [null_profile(df, name) for name, df in frames.items()])


def schema_listing(df: DataFrame) -> list[tuple[str, str, bool]]:
    """(column, type, nullable) from metadata; no job."""
    return [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]

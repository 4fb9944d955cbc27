"""Shared helpers of the text operators: table reads, scratch tables, text measures, ordered prefix sums."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from haulage.session import ensure_checkpoint_dir

# White space of the word rule, as a Java character class body.
SPACE = r"\x20\x09-\x0D"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back.

    The table cuts the lineage and is computed once however often it is read;
    a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def first_by_hash(df: DataFrame, id_col: str, value_col: str, limit: int) -> list:
    """The values of about ``limit`` rows, those that come first by the hash of their id; a model's training sample.

    The hashes alone are ordered first, so tasks send a few bytes a row to the
    driver, and then only the chosen rows are read.  Rows that tie at the last
    hash come in the order of their values; no more than ``limit`` come back.
    """
    rows = df.where(F.col(value_col).isNotNull())
    drawn = F.xxhash64(F.col(id_col).cast("string"))
    last = rows.select(drawn.alias("_h")).orderBy("_h").limit(limit).agg(F.max("_h")).first()[0]
    if last is None:
        return []
    chosen = rows.select(drawn.alias("_h"), F.col(value_col).alias("_value")).where(F.col("_h") <= last)
    return [r["_value"] for r in chosen.orderBy("_h", F.md5("_value")).limit(limit).collect()]


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` runs: each run with the space around it becomes one mark, and marks are counted."""
    marks = F.regexp_replace(text, rf"[{SPACE}]*+[^{SPACE}]++[{SPACE}]*+", "x")
    return F.when(text.rlike(rf"[^{SPACE}]"), F.length(marks)).otherwise(F.lit(0)).cast("long")


def unit_interval(hex_text: Column) -> Column:
    """The first 13 hex digits of a digest as a double strictly between 0 and 1."""
    whole = F.conv(F.substring(hex_text, 1, 13), 16, 10).cast("long")
    return (whole.cast("double") + F.lit(0.5)) / F.lit(float(16**13))


def with_prefix(
    df: DataFrame,
    group: str,
    key: str,
    amount: Column,
    out: str,
    digits: int = 3,
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """Add ``out``: the sum of ``amount`` over the rows before this one in its group, ordered by the hex digest ``key``.

    A group may hold any share of the rows, so it is never windowed whole.  The
    first ``digits`` hex digits cut it into 16**digits ranges of the digest;
    range totals are pre-aggregated map-side, a window over those few totals
    gives each range its offset, and rows are only ordered within their range.
    Rows that tie on ``key`` are ordered by the ``extra`` columns.
    """
    ranged = df.withColumn("_range", F.substring(F.col(key), 1, digits)).withColumn("_amount", amount)
    totals = ranged.groupBy(F.col(group).alias("_g"), F.col("_range").alias("_r")).agg(F.sum("_amount").alias("_t"))
    before = Window.partitionBy("_g").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_g", "_r", F.coalesce(F.sum("_t").over(before), F.lit(0)).cast("long").alias("_offset"))
    inside = (
        Window.partitionBy(group, "_range")
        .orderBy(key, *extra)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = ranged.withColumn("_local", F.coalesce(F.sum("_amount").over(inside), F.lit(0)).cast("long"))
    joined = local.join(offsets, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_range") == F.col("_r")))
    return joined.withColumn(out, F.col("_offset") + F.col("_local")).drop(
        "_range", "_amount", "_g", "_r", "_offset", "_local"
    )

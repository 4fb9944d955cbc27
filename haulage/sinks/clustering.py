"""Clustered files: within a month, rows lie along an interleaved (state, purchase day) key.

Silver's folders prune by month; within a hot month a filter on the state or
the day should still skip most of it.  Rows are ordered by a key that takes a
bit of the state's rank and a bit of the day in turn, so that a file, and each
row group in it, covers a small range of both, and Parquet's own column
statistics skip the rest.  The state's rank follows the order of the names,
as the statistics do.

How finely a month is cut follows from its row count: the highest bits of the
key name the file.  Months of few rows stay in one file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from haulage.plans.materialise import materialise
from haulage.sinks.publish import publish, recover, staged_partitions, staging_path, state_path
from haulage.sinks.store import Store

BITS = 10  # of each part of the key
FILE_ROWS = 5_000_000
FILE_BYTES = 256 << 20


def interleaved(parts: Sequence[Column], bits: int = BITS) -> Column:
    """The bits of the parts (each from 0 to 2**bits - 1) in turn, the highest first: a Z-order key."""
    key = F.lit(0).cast("bigint")
    for bit in range(bits):
        for i, part in enumerate(parts):
            value = F.shiftright(part.cast("bigint"), bit).bitwiseAND(F.lit(1).cast("bigint"))
            key = key.bitwiseOR(F.shiftleft(value, bit * len(parts) + len(parts) - 1 - i))
    return key


def name_ranks(df: DataFrame, column: str, bits: int = BITS) -> DataFrame:
    """Each distinct value with its place among the values in order, scaled to ``bits`` bits (``_name``, ``_rank``).

    One row a distinct value, in one window: meant for dimensions such as
    states.  Nulls have rank 0.
    """
    names = df.select(F.col(column).alias("_name")).where(F.col("_name").isNotNull()).distinct()
    place = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("_name")) - 1
    total = F.count(F.lit(1)).over(Window.partitionBy(F.lit(1)))
    return names.select("_name", F.floor(place * F.lit(1 << bits) / total).cast("bigint").alias("_rank"))


def with_cluster_key(
    df: DataFrame, state: str = "customer_state", time: str = "order_purchase_timestamp", bits: int = BITS
) -> DataFrame:
    """``df`` with ``_key``: the state's rank and the second of the month, interleaved."""
    ranks = materialise(name_ranks(df, state, bits), "name-ranks")
    seconds = (F.dayofmonth(time) - 1) * 86400 + F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)
    when = F.floor(seconds * F.lit((1 << bits) / (31.0 * 86400)))
    parts = [F.coalesce(c, F.lit(0)).cast("bigint") for c in (F.col("_rank"), when)]
    joined = df.join(ranks, F.col(state) == F.col("_name"), "left")
    return joined.withColumn("_key", interleaved(parts, bits)).drop("_name", "_rank")


def write_clustered(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("order_year", "order_month"),
    file_rows: int = FILE_ROWS,
    row_group_bytes: int | None = None,
    state: str = "customer_state",
    time: str = "order_purchase_timestamp",
    month_files: int | None = None,
) -> None:
    """Partitioned Parquet at ``path`` with clustered files of about ``file_rows`` rows.

    With ``month_files`` (a power of two) a month is cut into at most about so
    many files, larger ones where it has more rows, so that their number
    depends on the months and not on the rows.

    A slot is the key's highest bits, as many as its month needs.  Slots are
    dealt out with a rebalance, so a slot that is still too large (all orders
    of a month in one state on one day) is split over tasks; where small slots
    are merged into one task, its rows are cut into files in the key's order.
    """
    keys = list(partition_by)
    keyed = with_cluster_key(df, state, time)
    months = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    months = materialise(months.select(*[F.col(k).alias(f"_m{i}") for i, k in enumerate(keys)], "_rows"), "month-rows")
    if month_files is not None:
        largest = months.agg(F.max("_rows")).first()[0] or 0
        file_rows = max(file_rows, -(-largest // month_files))
    cuts = F.greatest(F.lit(0), F.ceil(F.log2(F.col("_rows") / F.lit(float(file_rows))))).cast("int")
    months = months.withColumn("_cuts", cuts).drop("_rows")
    same = [F.col(k).eqNullSafe(F.col(f"_m{i}")) for i, k in enumerate(keys)]
    condition = same[0]
    for c in same[1:]:
        condition = condition & c
    shift = F.greatest(F.lit(0), F.lit(2 * BITS) - F.col("_cuts"))
    slotted = keyed.join(months, condition).withColumn("_slot", F.call_function("shiftright", F.col("_key"), shift))
    dealt = slotted.hint("rebalance", *keys, "_slot").sortWithinPartitions(*keys, "_key")
    writer = dealt.drop("_slot", "_cuts", "_key", *[f"_m{i}" for i in range(len(keys))]).write.mode("overwrite")
    if row_group_bytes is not None:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer = writer.option("maxRecordsPerFile", file_rows)
    writer.option("compression", "snappy").partitionBy(*keys).parquet(path)


def fragmented(spark: SparkSession, path: str, depth: int = 2, file_bytes: int = FILE_BYTES) -> list[str]:
    """Partitions of several files that would fit into at most half as many of ``file_bytes``.

    Spark lists the files and counts them; a row a partition reaches the driver.
    """
    parts = staged_partitions(Store(spark), path, depth)
    if not parts:
        return []
    files = spark.read.format("binaryFile").options(pathGlobFilter="*.parquet", recursiveFileLookup="true").load(path)
    part = F.array_join(F.slice(F.split("path", "/"), -1 - depth, depth), "/").alias("part")
    sizes = {r["part"]: r for r in files.groupBy(part).agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("total")).collect()}
    return [p for p in parts if p in sizes and max(1, -(-sizes[p]["total"] // file_bytes)) * 2 <= sizes[p]["n"]]


def compact(
    spark: SparkSession, path: str, partitions: Sequence[str] | None = None, file_bytes: int = FILE_BYTES, **options
) -> list[str]:
    """Rewrite fragmented partitions (or those named) as clustered files and swap them in; returns them.

    Rows don't change, so the table's state stays as it is.  The other
    partitions keep their files.
    """
    from haulage.plans.incremental import in_months

    recover(spark, path)
    chosen = list(partitions) if partitions is not None else fragmented(spark, path, file_bytes=file_bytes)
    if chosen:
        state = Store(spark).read_json(state_path(path))
        rows = spark.read.parquet(path).where(in_months(chosen))
        write_clustered(rows, staging_path(path), **options)
        publish(spark, path, chosen, state=state)
    return chosen

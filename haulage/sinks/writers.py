"""Writers for the layer tables.

* Bronze and gold tables: Parquet, snappy, overwrite.
* Silver: Parquet partitioned by (order_year, order_month).  ``dynamic``
  partition overwrite replaces only the months present in the new data;
  ``static`` (the default, as originally) replaces the whole table.
* Gold CSV exports go through Spark's writer with one output file; the KPI
  tables are bounded by their group counts (states, months, severities), so a
  single writer task is safe.  Nothing is collected to the driver.
* ``gated_write`` writes staged, judges the table by the counts of that write
  and publishes it only when all checks pass (``QualityGateError`` otherwise).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from haulage.rules import DEFAULT_RULES, Rules
from haulage.sinks.publish import publish_checked


def write_layer(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "snappy") -> None:
    df.write.mode(mode).option("compression", compression).parquet(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by=("order_year", "order_month"),
    overwrite: str = "static",
    compression: str = "snappy",
) -> None:
    """Partitioned Parquet.

    Rows are clustered by the partition keys with a ``rebalance`` hint, so
    each writer task covers few partitions (few files), while adaptive
    execution splits a hot month across several tasks and merges small ones;
    a plain ``repartition(year, month)`` would put a whole month in one task.
    """
    if overwrite not in ("static", "dynamic"):
        raise ValueError("overwrite must be 'static' or 'dynamic'")
    keys = list(partition_by)
    (
        df.hint("rebalance", *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", overwrite)
        .option("compression", compression)
        .partitionBy(*keys)
        .parquet(path)
    )


def write_csv_export(df: DataFrame, path: str, sort_by=()) -> None:
    """One CSV file with header (group-bounded tables only), optionally sorted.

    The single partition is sorted in place, so ordering the file costs no
    range-partitioning exchange.
    """
    one = df.coalesce(1)
    if sort_by:
        one = one.sortWithinPartitions(*sort_by)
    one.write.mode("overwrite").option("header", "true").csv(path)


def write_gold(df: DataFrame, path: str, csv: bool = True, sort_by=()) -> None:
    """Gold table: Parquet at ``path``; CSV export at ``path + '_csv'``."""
    write_layer(df, path)
    if csv:
        write_csv_export(df.sparkSession.read.parquet(path), path + "_csv", sort_by)


def gated_write(
    silver: DataFrame,
    path: str,
    rules: Rules = DEFAULT_RULES,
    strict: bool = True,
    overwrite: str = "static",
) -> list[tuple[str, int, bool]]:
    """Partitioned write behind the quality gate, in one pass (see ``haulage.sinks.publish``).  Returns the check results."""
    if overwrite not in ("static", "dynamic"):
        raise ValueError("overwrite must be 'static' or 'dynamic'")
    return publish_checked(silver, path, rules, strict=strict, whole=overwrite == "static")[0]

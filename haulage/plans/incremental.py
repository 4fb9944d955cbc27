"""Incremental layers: only the months whose orders changed are rebuilt, and the order cube takes signed deltas.

Silver.  Every silver row has two content hashes, and a month's digest is its
row count and the sums of these hashes, so it doesn't depend on the rows'
order.  A refresh compares the digests of the table as it would be built now
with those of the published table, and rewrites the months that differ.  The
digest is of the *result*: whatever changed a row (an order, a customer, a
state mean that fills a coordinate, a rule) changes its month.  Lineage
columns are left out, so an unchanged month keeps its files and its ingestion
time.  The digests (one row a month) are published in the same commit as the
rows; if they are missing they are counted from the published table.

Cube.  ``apply_deltas`` adds the counts of added rows and subtracts those of
removed rows.  The stored cube knows which digests it reflects, so a refresh
that died between silver and cube is made good by the next one: what the cube
holds of a changed month is taken out, what silver holds now is put in.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage.functions import content_sums
from haulage.operators.gold import CUBE_KEYS, order_cube
from haulage.plans.materialise import materialise
from haulage.rules import DEFAULT_RULES, Rules
from haulage.sinks.publish import publish_checked, publish_table, recover, state_path
from haulage.sinks.store import Store

MONTH = ("order_year", "order_month")
LINEAGE = ("ingestion_timestamp",)
# Means are summed in whatever order tasks finish, so the last bits of a coordinate differ between two builds of the
# same rows.  Digests see coordinates on a binary grid of 2**-30 degrees (0.1 mm).
GRID = float(2**30)
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # fixed value: how Hive-style folders name a NULL


@dataclass
class Refresh:
    """What a refresh did: the partitions it replaced or dropped, all there are, and the checks of what it wrote."""

    changed: list[str]
    months: int
    rows: int
    checks: list


def partition_name(values: Sequence, keys: Sequence[str] = MONTH) -> str:
    return "/".join(f"{k}={NULL_PARTITION if v is None else v}" for k, v in zip(keys, values))


def partition_values(name: str) -> tuple:
    found = [p.partition("=")[2] for p in name.split("/")]
    return tuple(None if v == NULL_PARTITION else int(v) for v in found)


def month_digests(silver: DataFrame, ignore: Sequence[str] = LINEAGE) -> dict[str, list]:
    """Digest of every month by partition name (one small row a month reaches the driver)."""
    columns = sorted(c for c in silver.columns if c not in ignore)
    measured = [c for c, kind in silver.dtypes if kind in ("double", "float") and c in columns]
    silver = silver.withColumns({c: F.round(F.col(c) * F.lit(GRID)) + F.lit(0.0) for c in measured})
    rows = silver.groupBy(*MONTH).agg(*content_sums(columns)).collect()
    return {partition_name([r[k] for k in MONTH]): [r["n"], r["a"], r["b"]] for r in rows}


def in_months(names: Sequence[str]):
    """Rows of the named months (prunes the folders of a table that is partitioned by month)."""
    condition = F.lit(False)
    by_year: dict = {}
    for year, month in map(partition_values, names):
        by_year.setdefault(year, []).append(month)
    for year, months in by_year.items():
        known = [m for m in months if m is not None]
        inside = F.col("order_month").isin(known) if known else F.lit(False)
        if None in months:
            inside = inside | F.col("order_month").isNull()
        condition = condition | (F.col("order_year").eqNullSafe(F.lit(year).cast("int")) & inside)
    return condition


def published_digests(spark: SparkSession, path: str) -> dict[str, list]:
    """The digests of the published table: from its state, else counted from its rows; none without a table."""
    store = Store(spark)
    if not store.exists(path):
        return {}
    return store.read_json(state_path(path)) or month_digests(spark.read.parquet(path))


def differing(old: dict[str, list], new: dict[str, list]) -> list[str]:
    return sorted(m for m in old.keys() | new.keys() if old.get(m) != new.get(m))


def refresh_silver(
    silver: DataFrame, path: str, rules: Rules = DEFAULT_RULES, strict: bool = True
) -> Refresh:
    """Bring the published silver table to ``silver`` by rewriting only the months that differ.

    The rows of the changed months pass the quality gate while they are
    written; if they fail, nothing is published.  A month without rows any
    more is dropped.  The first refresh writes the whole table.
    """
    spark = silver.sparkSession
    recover(spark, path)
    old, new = published_digests(spark, path), month_digests(silver)
    changed = differing(old, new)
    rows = sum(d[0] for d in new.values())
    if not changed:
        return Refresh([], len(new), rows, [])
    first = not old
    part = silver if first else silver.where(in_months(changed))
    checks, _ = publish_checked(part, path, rules, strict, only=None if first else changed, state=new)
    return Refresh(changed, len(new), rows, checks)


# --------------------------------------------------------------------- cube
def signed(cube: DataFrame, sign: int) -> DataFrame:
    return cube.select(*CUBE_KEYS, *[(F.col(c) * F.lit(sign)).cast("bigint").alias(c) for c in ("_rows", "_orders")])


def apply_deltas(cube: DataFrame | None, added: DataFrame | None = None, removed: DataFrame | None = None) -> DataFrame:
    """The order cube after silver rows were ``added`` and ``removed`` (rows or their cubes).

    Counts are summed by key with their sign and cells that reach zero go, so
    the result equals the cube of the rows that remain.  Taking out what was
    never in raises when the result is computed: a count below zero is no
    cube.
    """
    parts = [] if cube is None else [signed(cube, 1)]
    for rows, sign in ((added, 1), (removed, -1)):
        if rows is not None:
            parts.append(signed(rows if "_rows" in rows.columns else order_cube(rows), sign))
    if not parts:
        raise ValueError("no cube and no rows")
    total = parts[0]
    for p in parts[1:]:
        total = total.unionByName(p)
    total = total.groupBy(*CUBE_KEYS).agg(F.sum("_rows").alias("_rows"), F.sum("_orders").alias("_orders"))
    below = (F.col("_rows") < 0) | (F.col("_orders") < 0)
    guarded = F.when(below, F.raise_error(F.lit("more rows removed from the cube than it holds"))).otherwise(F.col("_rows"))
    return total.withColumn("_rows", guarded.cast("bigint")).where((F.col("_rows") != 0) | (F.col("_orders") != 0))


def refresh_cube(spark: SparkSession, silver_path: str, cube_path: str) -> list[str]:
    """Bring the stored order cube to the published silver table; returns the months it took up.

    Only the changed months of silver are read.  Deleted orders, and months
    that are gone, leave the cube.
    """
    recover(spark, cube_path)
    store = Store(spark)
    now = published_digests(spark, silver_path)
    known = (store.read_json(state_path(cube_path)) or {}) if store.exists(cube_path) else {}
    changed = differing(known, now)
    if not changed and known:
        return []
    silver = spark.read.parquet(silver_path)
    if not known:
        publish_table(order_cube(silver), cube_path, state=now)
        return changed
    cube = spark.read.parquet(cube_path)
    touched = in_months(changed)
    # Written aside first: the new cube is computed from the published one, which the publish then replaces.
    fresh = materialise(apply_deltas(cube, order_cube(silver.where(touched)), cube.where(touched)), "cube-after-deltas")
    publish_table(fresh, cube_path, state=now)
    return changed

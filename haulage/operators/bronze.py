"""Bronze layer: consolidate geolocation, enrich orders, lineage, coverage.

Scale notes
* ``consolidate_geo`` is two partial aggregations: (zip, state, city) first,
  which collapses a hot zip map-side before any shuffle, then (zip, state)
  over that small intermediate.  Means are carried as (sum, count) so the
  second stage is exact re-aggregation, and the most common city is chosen
  deterministically (largest count, then smallest name) instead of an
  arbitrary ``first``.
* ``enrich`` joins the consolidated geolocation to the customers and the
  result to the orders on customer_id.  How each join runs is Spark's choice by
  byte size; adaptive execution splits a hot customer or zip.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulage.functions import count_where
from haulage.plans.materialise import materialise
from haulage.rules import DEFAULT_RULES, Rules
from haulage.schemas import BRONZE_COLUMNS


def consolidate_geo(
    geo: DataFrame,
    zip_col: str = "geolocation_zip_code_prefix",
    state_col: str = "geolocation_state",
    lat_col: str = "geolocation_lat",
    lng_col: str = "geolocation_lng",
    city_col: str = "geolocation_city",
    with_row_counts: bool = False,
) -> DataFrame:
    """One row per (zip, state): mean lat, mean lng, most common city.

    Output columns: zip_code, geolocation_state, lat, lng, city
    (+ n_rows, the number of raw rows folded in, when ``with_row_counts``).
    """
    per_city = geo.groupBy(zip_col, state_col, city_col).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(lat_col).alias("_s_lat"),
        F.count(lat_col).alias("_c_lat"),
        F.sum(lng_col).alias("_s_lng"),
        F.count(lng_col).alias("_c_lng"),
    )
    city_rank = F.when(F.col(city_col).isNotNull(), F.struct((-F.col("_n")).alias("n"), F.col(city_col)))
    cons = per_city.groupBy(zip_col, state_col).agg(
        F.try_divide(F.sum("_s_lat"), F.sum("_c_lat")).alias("lat"),
        F.try_divide(F.sum("_s_lng"), F.sum("_c_lng")).alias("lng"),
        F.min_by(F.col(city_col), city_rank).alias("city"),
        F.sum("_n").alias("n_rows"),
    )
    cols = [
        F.col(zip_col).alias("zip_code"),
        F.col(state_col).alias("geolocation_state"),
        "lat",
        "lng",
        "city",
    ]
    if with_row_counts:
        cols.append("n_rows")
    return cons.select(*cols)


CITY_BITS = 16


def city_summary(
    geo: DataFrame,
    zip_col: str = "geolocation_zip_code_prefix",
    state_col: str = "geolocation_state",
    city_col: str = "geolocation_city",
    bits: int = CITY_BITS,
) -> DataFrame:
    """Rows per (zip, state) and hash bucket of the city: at most 2**bits rows a group, however many cities it has.

    Summaries of parts of the data are merged by adding their counts.  A
    bucket's count is an upper bound for each of its cities.
    """
    return (
        geo.where(F.col(city_col).isNotNull())
        .groupBy(F.col(zip_col).alias("_zip"), F.col(state_col).alias("_state"), _city_bucket(city_col, bits).alias("_bucket"))
        .agg(F.count(F.lit(1)).alias("_rows"))
    )


def _city_bucket(city_col: str, bits: int):
    return F.pmod(F.xxhash64(city_col), F.lit(1 << bits).cast("bigint"))


def most_common_city(
    geo: DataFrame,
    zip_col: str = "geolocation_zip_code_prefix",
    state_col: str = "geolocation_state",
    city_col: str = "geolocation_city",
    bits: int = CITY_BITS,
) -> DataFrame:
    """``_zip, _state, city``: the most common city of each group (ties: smallest name), from a bounded summary.

    The cities of each group's fullest bucket are counted exactly; the best of
    them is a lower bound for the winner.  Only buckets that hold at least as
    many rows can hold a better or equal city, and their cities are counted in
    a second pass.  Cities of all other buckets are never grouped by name, so
    a zip with a million rare cities and a common one costs its bucket counts.
    Exact for every distribution; where no city stands out, most buckets
    stay candidates and all names are counted.
    """
    keys = ["_zip", "_state", "_bucket"]
    summary = materialise(city_summary(geo, zip_col, state_col, city_col, bits), "city-summary")
    fullest = F.max_by("_bucket", F.struct("_rows", (-F.col("_bucket")).alias("b"))).alias("_bucket")
    top = summary.groupBy("_zip", "_state").agg(fullest)
    named = geo.where(F.col(city_col).isNotNull()).select(
        F.col(zip_col).alias("_zip"), F.col(state_col).alias("_state"), F.col(city_col).alias("city"),
        _city_bucket(city_col, bits).alias("_bucket"),
    )

    def counted(buckets: DataFrame) -> DataFrame:
        wanted = buckets.select(*[F.col(k).alias(f"{k}_w") for k in keys])
        same = [F.col(k).eqNullSafe(F.col(f"{k}_w")) for k in keys]
        rows = named.join(wanted, same[0] & same[1] & same[2], "left_semi")
        return rows.groupBy(*keys, "city").agg(F.count(F.lit(1)).alias("_n"))

    first = materialise(counted(top), "city-first")
    least = first.groupBy(F.col("_zip").alias("_z"), F.col("_state").alias("_s")).agg(
        F.max("_n").alias("_least"), F.first("_bucket").alias("_done")
    )
    group = F.col("_zip").eqNullSafe(F.col("_z")) & F.col("_state").eqNullSafe(F.col("_s"))
    others = summary.join(least, group).where((F.col("_rows") >= F.col("_least")) & (F.col("_bucket") != F.col("_done")))
    second = counted(materialise(others.select(*keys), "city-candidates"))
    best = F.min_by("city", F.struct((-F.col("_n")).alias("n"), F.col("city")))
    return first.unionByName(second).groupBy("_zip", "_state").agg(best.alias("city"))


def consolidate_geo_bounded(
    geo: DataFrame,
    zip_col: str = "geolocation_zip_code_prefix",
    state_col: str = "geolocation_state",
    lat_col: str = "geolocation_lat",
    lng_col: str = "geolocation_lng",
    city_col: str = "geolocation_city",
    bits: int = CITY_BITS,
) -> DataFrame:
    """``consolidate_geo`` for sources with unbounded city names: the same rows, with ``most_common_city``.

    Reads the source four times (means, summary, two passes over candidates)
    and shuffles no row a distinct city.
    """
    means = geo.groupBy(F.col(zip_col).alias("zip_code"), F.col(state_col).alias("geolocation_state")).agg(
        F.avg(lat_col).alias("lat"), F.avg(lng_col).alias("lng")
    )
    cities = most_common_city(geo, zip_col, state_col, city_col, bits)
    group = F.col("zip_code").eqNullSafe(F.col("_zip")) & F.col("geolocation_state").eqNullSafe(F.col("_state"))
    return means.join(cities, group, "left").select("zip_code", "geolocation_state", "lat", "lng", "city")


def geo_dedup_report(geo_with_counts: DataFrame) -> DataFrame:
    """Rows before / after consolidation, rows removed, % removed (one row).

    Takes ``consolidate_geo(..., with_row_counts=True)`` so the raw row count
    comes from the same pass instead of a second scan of the raw table.
    """
    before = F.sum("n_rows")
    after = F.count(F.lit(1))
    return geo_with_counts.agg(
        before.cast("bigint").alias("rows_before"),
        after.alias("rows_after"),
        (before - after).cast("bigint").alias("rows_removed"),
        F.round(F.try_divide((before - after) * F.lit(100.0), before), 1).alias("pct_removed"),
    )


def join_orders_customers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Inner equi-join on customer_id; the customer zip becomes ``zip_code``."""
    cust = customers.withColumnRenamed("customer_zip_code_prefix", "zip_code")
    return orders.join(cust, on="customer_id", how="inner")


def _located(customers: DataFrame, geo_consolidated: DataFrame, mode: str) -> DataFrame:
    """Customers with the consolidated geolocation of their zip (left join)."""
    if mode not in ("strict", "compat"):
        raise ValueError(f"unknown mode {mode!r}")
    cust = customers.withColumnRenamed("customer_zip_code_prefix", "zip_code")
    geo = geo_consolidated.withColumnRenamed("zip_code", "_geo_zip")
    cond = F.col("zip_code") == F.col("_geo_zip")
    if mode == "strict":
        cond = cond & (F.col("customer_state") == F.col("geolocation_state"))
    return cust.join(geo, on=cond, how="left").drop("_geo_zip")


def enrich(
    orders: DataFrame,
    customers: DataFrame,
    geo_consolidated: DataFrame,
    mode: str = "strict",
) -> DataFrame:
    """Bronze rows: orders x customers (inner) + consolidated geo (left).

    ``strict`` matches geolocation on (zip, state), so an order gets at most one
    coordinate row.  ``compat`` matches on zip only, as the original pipeline
    does: a zip present in several states repeats the order once per state.

    The geo condition uses customer columns only, so
    ``(orders JOIN customers) LEFT JOIN geo == orders JOIN (customers LEFT JOIN geo)``.
    Customers are enriched first, and the order rows are shuffled once, by
    customer_id.  Lazy: no job runs here.
    """
    located = _located(customers, geo_consolidated, mode)
    return orders.join(located, on="customer_id", how="inner").select(*BRONZE_COLUMNS)


def coordinate_counts(
    orders: DataFrame, customers: DataFrame, geo_consolidated: DataFrame, mode: str = "strict"
) -> DataFrame:
    """Bronze rows counted by (customer_state, lat, lng), without building them.

    Orders are counted by customer (one narrow column, folded map-side) and
    the counts meet the customers with their coordinates; no order row passes
    through a join.
    """
    per_customer = orders.groupBy("customer_id").agg(F.count(F.lit(1)).alias("_rows"))
    return (
        per_customer.join(_located(customers, geo_consolidated, mode), on="customer_id", how="inner")
        .groupBy("customer_state", "lat", "lng")
        .agg(F.sum("_rows").alias("_rows"))
    )


def add_lineage(df: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Append ``ingestion_timestamp`` (query start time) and ``data_source``."""
    return df.withColumns(
        {"ingestion_timestamp": F.current_timestamp(), "data_source": F.lit(rules.lineage_tag)}
    )


def geo_coverage(bronze: DataFrame) -> DataFrame:
    """Rows, rows with coordinates, rows without (zip not matched)."""
    return bronze.agg(
        F.count(F.lit(1)).alias("bronze_rows"),
        count_where(F.col("lat").isNotNull()).alias("rows_with_geo"),
        count_where(F.col("lat").isNull()).alias("rows_missing_geo"),
    )


def join_fanout(bronze: DataFrame, key: str = "order_id") -> DataFrame:
    """How many rows the geo join added: rows vs distinct orders (one row)."""
    per_key = bronze.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.sum("_n").cast("bigint").alias("bronze_rows"),
        F.count(F.lit(1)).alias("distinct_orders"),
        (F.sum("_n") - F.count(F.lit(1))).cast("bigint").alias("surplus_rows"),
        count_where(F.col("_n") > 1).alias("fanout_orders"),
    )


def build_bronze(
    orders: DataFrame,
    customers: DataFrame,
    geolocation: DataFrame,
    mode: str = "strict",
    rules: Rules = DEFAULT_RULES,
    lineage: bool = True,
    geo_consolidated: DataFrame | None = None,
) -> DataFrame:
    """Sources -> consolidated geo -> enriched bronze (+ lineage columns)."""
    geo = consolidate_geo(geolocation) if geo_consolidated is None else geo_consolidated
    bronze = enrich(orders, customers, geo, mode=mode)
    return add_lineage(bronze, rules) if lineage else bronze

"""Adapter: shape the driver's TPC-H-like tables into the three source schemas.

The raw tables carry no coordinates, NULLs or unmatched keys, so the missing
columns are derived from keys with integer arithmetic.  The same rules are
written once as Spark expressions (``source_frames``) and once as SQL
(``ADAPTER_SQL``) so an independent engine can recompute every query.

Rules (orders o, customer c, nation n, lineitem l):

* orders: id/customer id = text of o_orderkey / o_custkey; status canceled
  when o_orderkey % 40 = 0, shipped when = 1, else delivered; purchase =
  o_orderdate; approved = purchase + 1 hour (NULL when o_orderkey % 600 = 0);
  carrier = purchase + 1 day (NULL unless delivered); delivered = purchase +
  (o_orderkey * 37 % 31 + o_custkey % 12) days (NULL unless delivered or when
  o_orderkey % 500 = 7); estimated = purchase + (24 + o_custkey % 7) days.
  All five are text ``yyyy-MM-dd HH:mm:ss``.
* customers: id = text of c_custkey, unique id = c_name, zip = c_nationkey *
  100 + c_custkey % 20, city = 'city_' || c_custkey % 7, state = n_name.
* geolocation (one row per lineitem): zip = (l_partkey % 25) * 100 +
  l_orderkey % 19; state = n_name of nation (l_partkey + x) % 25 where x = 1
  when l_orderkey % 19 = 5 and (l_partkey % 25) % 6 = 0 and l_linenumber = 1;
  lat = -33 + (l_partkey % 25) * 1.5 + (l_quantity - 25) * 0.01 (+60 when
  l_partkey % 25 = 3 and l_orderkey % 19 = 7); lng = -70 + (l_partkey % 25) *
  1.5 + l_linenumber * 0.01 (+100 when l_partkey % 25 = 4 and l_orderkey % 19
  = 8); city = 'city_' || l_suppkey % 7.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Declared read schemas of the raw tables (only the columns the adapter uses):
# reading with a schema skips footer-based inference and prunes the rest.
RAW_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(RAW_SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def orders_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    k, c, ts = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    not_delivered = (k % 40 == 0) | (k % 40 == 1)

    def text(t):
        # Whole-second timestamp_ntz values cast to 'yyyy-MM-dd HH:mm:ss' text.
        return t.cast("string")

    def plus_days(n):
        return F.timestamp_add("DAY", n.cast("int"), ts)

    return o.select(
        k.cast("string").alias("order_id"),
        c.cast("string").alias("customer_id"),
        F.when(k % 40 == 0, "canceled").when(k % 40 == 1, "shipped").otherwise("delivered").alias(
            "order_status"
        ),
        text(ts).alias("order_purchase_timestamp"),
        F.when(k % 600 != 0, text(F.timestamp_add("HOUR", F.lit(1), ts))).alias("order_approved_at"),
        F.when(~not_delivered, text(plus_days(F.lit(1)))).alias("order_delivered_carrier_date"),
        F.when(~not_delivered & (k % 500 != 7), text(plus_days((k * 37) % 31 + c % 12))).alias(
            "order_delivered_customer_date"
        ),
        text(plus_days(F.lit(24) + c % 7)).alias("order_estimated_delivery_date"),
    )


def customers_frame(spark: SparkSession, sf_dir: str, nation: DataFrame | None = None) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    n = nation if nation is not None else _read(spark, sf_dir, "nation")
    key = F.col("c_custkey")
    return c.join(n, c["c_nationkey"] == n["n_nationkey"], "left").select(
        key.cast("string").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        (F.col("c_nationkey") * 100 + key % 20).cast("int").alias("customer_zip_code_prefix"),
        F.concat(F.lit("city_"), (key % 7).cast("string")).alias("customer_city"),
        F.col("n_name").alias("customer_state"),
    )


def geolocation_frame(spark: SparkSession, sf_dir: str, nation: DataFrame | None = None) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem")
    n = nation if nation is not None else _read(spark, sf_dir, "nation")
    pk25 = F.col("l_partkey") % 25
    ok19 = F.col("l_orderkey") % 19
    shift = F.when((ok19 == 5) & (pk25 % 6 == 0) & (F.col("l_linenumber") == 1), 1).otherwise(0)
    li = li.withColumn("_nk", ((F.col("l_partkey") + shift) % 25).cast("int"))
    lat = (
        F.lit(-33.0)
        + pk25 * F.lit(1.5)
        + (F.col("l_quantity") - F.lit(25)) * F.lit(0.01)
        + F.when((pk25 == 3) & (ok19 == 7), F.lit(60.0)).otherwise(F.lit(0.0))
    )
    lng = (
        F.lit(-70.0)
        + pk25 * F.lit(1.5)
        + F.col("l_linenumber") * F.lit(0.01)
        + F.when((pk25 == 4) & (ok19 == 8), F.lit(100.0)).otherwise(F.lit(0.0))
    )
    return li.join(n, F.col("_nk") == F.col("n_nationkey"), "left").select(
        (pk25 * 100 + ok19).cast("int").alias("geolocation_zip_code_prefix"),
        lat.alias("geolocation_lat"),
        lng.alias("geolocation_lng"),
        F.concat(F.lit("city_"), (F.col("l_suppkey") % 7).cast("string")).alias("geolocation_city"),
        F.col("n_name").alias("geolocation_state"),
    )


def source_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three sources (lazy) keyed like the source registry."""
    nation = _read(spark, sf_dir, "nation")
    return {
        "orders": orders_frame(spark, sf_dir),
        "customers": customers_frame(spark, sf_dir, nation),
        "geolocation": geolocation_frame(spark, sf_dir, nation),
    }


# The same adapter as SQL common-table expressions over the raw tables
# (orders, customer, nation, lineitem).  Decimal literals are cast to double
# so the arithmetic matches the Spark expressions above bit for bit.
ADAPTER_SQL = """
src_orders AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
         CAST(o_custkey AS VARCHAR) AS customer_id,
         CASE WHEN o_orderkey % 40 = 0 THEN 'canceled'
              WHEN o_orderkey % 40 = 1 THEN 'shipped'
              ELSE 'delivered' END AS order_status,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_purchase_timestamp,
         CASE WHEN o_orderkey % 600 <> 0
              THEN strftime(o_orderdate + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') END
              AS order_approved_at,
         CASE WHEN o_orderkey % 40 NOT IN (0, 1)
              THEN strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') END
              AS order_delivered_carrier_date,
         CASE WHEN o_orderkey % 40 NOT IN (0, 1) AND o_orderkey % 500 <> 7
              THEN strftime(o_orderdate + to_days(CAST((o_orderkey * 37) % 31 + o_custkey % 12 AS INTEGER)),
                            '%Y-%m-%d %H:%M:%S') END AS order_delivered_customer_date,
         strftime(o_orderdate + to_days(CAST(24 + o_custkey % 7 AS INTEGER)), '%Y-%m-%d %H:%M:%S')
              AS order_estimated_delivery_date
  FROM orders
),
src_customers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
         c_name AS customer_unique_id,
         CAST(c_nationkey * 100 + c_custkey % 20 AS INTEGER) AS customer_zip_code_prefix,
         'city_' || CAST(c_custkey % 7 AS VARCHAR) AS customer_city,
         n_name AS customer_state
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
),
src_geolocation AS (
  SELECT CAST((l_partkey % 25) * 100 + l_orderkey % 19 AS INTEGER) AS geolocation_zip_code_prefix,
         CAST(-33.0 AS DOUBLE) + (l_partkey % 25) * CAST(1.5 AS DOUBLE)
           + (l_quantity - 25) * CAST(0.01 AS DOUBLE)
           + CASE WHEN l_partkey % 25 = 3 AND l_orderkey % 19 = 7
                  THEN CAST(60.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS geolocation_lat,
         CAST(-70.0 AS DOUBLE) + (l_partkey % 25) * CAST(1.5 AS DOUBLE)
           + l_linenumber * CAST(0.01 AS DOUBLE)
           + CASE WHEN l_partkey % 25 = 4 AND l_orderkey % 19 = 8
                  THEN CAST(100.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS geolocation_lng,
         'city_' || CAST(l_suppkey % 7 AS VARCHAR) AS geolocation_city,
         n_name AS geolocation_state
  FROM lineitem LEFT JOIN nation
    ON n_nationkey = CAST((l_partkey + CASE WHEN l_orderkey % 19 = 5 AND (l_partkey % 25) % 6 = 0
                                             AND l_linenumber = 1 THEN 1 ELSE 0 END) % 25 AS INTEGER)
)"""

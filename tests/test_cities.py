"""The most common city from a bounded summary equals the exact answer."""

import pytest
from pyspark.sql import functions as F

from haulage.operators import bronze as B

GEO = "geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double, geolocation_city string, geolocation_state string"


def both(geo, **options):
    want = {(r["zip_code"], r["geolocation_state"]): r["city"] for r in B.consolidate_geo(geo).collect()}
    got = {(r["zip_code"], r["geolocation_state"]): r["city"] for r in B.consolidate_geo_bounded(geo, **options).collect()}
    return got, want


@pytest.mark.parametrize("bits", [0, 2, 16])
def test_small_groups_ties_and_nulls(spark, bits):
    rows = [(1, 0.0, 0.0, c, "A") for c in ("b", "a", "b", "a", "c")]
    rows += [(1, None, 1.0, None, "A")] * 9 + [(2, 1.0, 1.0, None, "A"), (None, 1.0, 1.0, "z", None), (3, 1.0, None, "q", None)]
    got, want = both(spark.createDataFrame(rows, GEO), bits=bits)
    assert got == want == {(1, "A"): "a", (2, "A"): None, (None, None): "z", (3, None): "q"}
    got, want = both(spark.createDataFrame([], GEO), bits=bits)
    assert got == want == {}


def test_hot_zip_of_a_million_cities(spark):
    n = 1_000_000
    rare = spark.range(n).select(F.lit(7).alias("z"), F.concat(F.lit("city "), F.col("id").cast("string")).alias("c"))
    common = spark.range(900).select(F.lit(7).alias("z"), F.concat(F.lit("town "), (F.col("id") % 3).cast("string")).alias("c"))
    flat = spark.range(30_000).select((F.col("id") % 3).cast("int").alias("z"), F.concat(F.lit("x"), (F.col("id") % 997).cast("string")).alias("c"))
    geo = rare.unionByName(common).unionByName(flat).select(
        F.col("z").alias("geolocation_zip_code_prefix"), F.lit(1.0).alias("geolocation_lat"), F.lit(2.0).alias("geolocation_lng"),
        F.col("c").alias("geolocation_city"), F.lit("S").alias("geolocation_state"),
    )
    geo = B.materialise(geo, "many-cities")
    got, want = both(geo)
    assert got == want and got[(7, "S")] == "town 0"
    # The summary is bounded, and only a few of the hot zip's buckets are candidates.
    summary = B.city_summary(geo)
    buckets = {r["_zip"]: r["n"] for r in summary.groupBy("_zip").agg(F.count("*").alias("n")).collect()}
    assert buckets[7] <= 1 << B.CITY_BITS
    assert summary.where("_zip = 7 and _rows >= 300").count() < 20

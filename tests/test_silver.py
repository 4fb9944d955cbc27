from pyspark.sql import functions as F

from haulage.operators import silver as S
from haulage.rules import DEFAULT_RULES

GEO = "order_id string, customer_state string, lat double, lng double"


def _geo(spark, rows):
    return spark.createDataFrame(rows, GEO)


def _pairs(df):
    return {r["order_id"]: (r["lat"], r["lng"]) for r in df.collect()}


OUTLIER_ROWS = [
    ("1", "A", -23.0, -46.0),
    ("2", "A", 50.0, -46.5),
    ("3", "A", -23.5, 10.0),
    ("4", "A", 50.0, 10.0),
]


def test_outlier_fix_compat_is_sequential(spark):
    out = _pairs(S.fix_geo_outliers(_geo(spark, OUTLIER_ROWS), mode="compat"))
    assert out == {"1": (-23.0, -46.0), "2": (-23.0, -46.5), "3": (-23.0, -46.0), "4": (-23.0, -46.0)}


def test_outlier_fix_strict_replaces_pair(spark):
    df = S.fix_geo_outliers(_geo(spark, OUTLIER_ROWS), mode="strict")
    out = _pairs(df)
    assert out == {"1": (-23.0, -46.0), "2": (-23.0, -46.0), "3": (-23.0, -46.0), "4": (-23.0, -46.0)}
    assert {r["order_id"] for r in df.filter("geo_repaired").collect()} == {"2", "3", "4"}


def test_outlier_fix_without_clean_rows(spark):
    rows = [("1", "B", 50.0, -46.0), ("2", "B", 51.0, 10.0)]
    assert _pairs(S.fix_geo_outliers(_geo(spark, rows), mode="compat")) == {"1": (None, -46.0), "2": (None, None)}
    assert _pairs(S.fix_geo_outliers(_geo(spark, rows), mode="strict")) == {"1": (None, None), "2": (None, None)}


def test_imputed_flag_compat_vs_strict(spark):
    rows = [("1", "C", 7.0, 7.0), ("2", "D", -20.0, -50.0), ("3", "D", None, None), ("4", None, None, None)]
    compat = {r["order_id"]: r["geo_imputed"] for r in S.impute_geo(_geo(spark, rows), mode="compat").collect()}
    strict = {r["order_id"]: r["geo_imputed"] for r in S.impute_geo(_geo(spark, rows), mode="strict").collect()}
    assert compat == {"1": True, "2": True, "3": True, "4": False}
    assert strict == {"1": False, "2": False, "3": True, "4": False}
    filled = _pairs(S.impute_geo(_geo(spark, rows), mode="strict"))
    assert filled["3"] == (-20.0, -50.0) and filled["4"] == (None, None)


def test_clean_geo_strict_uses_in_bounds_mean(spark):
    rows = [("1", "A", -20.0, -50.0), ("2", "A", -22.0, -52.0), ("3", "A", 80.0, -50.0), ("4", "A", None, -51.0)]
    out = S.clean_geo(_geo(spark, rows))
    got = {r["order_id"]: (r["lat"], r["lng"], r["geo_imputed"], r["geo_repaired"]) for r in out.collect()}
    assert got["3"] == (-21.0, -51.0, False, True)
    assert got["4"] == (-21.0, -51.0, True, False)
    assert got["1"] == (-20.0, -50.0, False, False)


def test_geo_outliers_drilldown_bounds_parameter(spark):
    rows = [("1", "A", -34.5, -50.0), ("2", "A", -20.0, -50.0), ("3", "A", None, -80.0)]
    df = _geo(spark, rows).withColumn("city", F.lit("x"))
    assert {r["order_id"] for r in S.geo_outliers(df).collect()} == {"1", "3"}
    wide = DEFAULT_RULES.__class__(lat_min=-35.0)
    assert {r["order_id"] for r in S.geo_outliers(df, wide).collect()} == {"3"}


def test_speed_buckets(spark):
    df = spark.createDataFrame([(d,) for d in (-3, 7, 8, 15, 31, None)], "actual_delivery_days int")
    got = [r[0] for r in df.select(S.speed_category()).collect()]
    assert got == ["FAST", "FAST", "NORMAL", "SLOW", "VERY_SLOW", "UNKNOWN"]


def test_null_reason_labels(spark):
    df = spark.createDataFrame(
        [("1", "delivered", None), ("2", "canceled", None), ("3", None, None), ("4", "delivered", "2017-01-01 00:00:00")],
        "order_id string, order_status string, order_delivered_customer_date string",
    )
    got = {r["order_id"]: r["delivery_null_reason"] for r in S.null_reason(df).collect()}
    assert got == {"1": "DATA_QUALITY_ISSUE", "2": "NOT_YET_DELIVERED", "3": "NOT_YET_DELIVERED", "4": None}


def test_derive_calendar_days(spark):
    df = spark.createDataFrame(
        [("2017-10-02 23:59:00", "2017-10-03 00:01:00", "2017-10-01 00:00:00")],
        "order_purchase_timestamp string, order_delivered_customer_date string, order_estimated_delivery_date string",
    )
    r = S.derive(S.fix_timestamps(df)).collect()[0]
    assert (r["actual_delivery_days"], r["delay_days"], r["order_year"], r["order_month"]) == (1, 2, 2017, 10)
    assert r["delivery_speed_category"] == "FAST"


def test_row_preservation_and_report(spark):
    from haulage.operators.bronze import consolidate_geo, enrich
    from haulage.sources.testdata import source_frames

    src = source_frames(spark, "/root/testdata/sf0.001")
    bronze = enrich(src["orders"], src["customers"], consolidate_geo(src["geolocation"]))
    silver = S.build_silver(bronze)
    r = S.row_preservation(bronze, silver).collect()[0]
    assert r["preserved"] and r["rows_before"] == 1500
    rep = S.cleaning_report(bronze, silver).collect()[0]
    assert rep["rows_after"] == 1500 and rep["geo_outliers_after"] == 0

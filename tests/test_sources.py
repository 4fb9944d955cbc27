import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from haulage.operators.silver import fix_timestamps, timestamp_parse_failures
from haulage.schemas import ORDERS_SPEC, SourceSpec
from haulage.sources import profile as P
from haulage.sources import readers as RD
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

HEADER = (
    "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
    "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\n"
)


def _write(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def test_connect_missing_file(spark):
    with pytest.raises(FileNotFoundError):
        RD.connect(spark, "orders", "/nonexistent/path.csv")


def test_connect_reads_valid_csv(spark, tmp_path):
    p = _write(tmp_path, "orders.csv", HEADER + "abc,cust1,delivered,2017-01-01,2017-01-01,2017-01-08,2017-01-10,2017-01-10\n")
    df = RD.connect(spark, "orders", p)
    assert df.count() == 1
    assert "order_id" in df.columns


def test_connect_wrong_columns_raises_value_error(spark, tmp_path):
    p = _write(tmp_path, "bad.csv", "wrong_col1,wrong_col2\nval1,val2\n")
    with pytest.raises(ValueError):
        RD.connect(spark, "orders", p)


def test_unknown_source_spec(spark):
    with pytest.raises(ValueError):
        RD.read_source(spark, "no_such_source", "/tmp/x.csv")


def test_require_paths(spark, tmp_path):
    p = _write(tmp_path, "a.csv", "x\n1\n")
    RD.require_paths(spark, {"a": p})
    with pytest.raises(FileNotFoundError):
        RD.require_paths(spark, {"a": p, "b": str(tmp_path / "missing.csv")})


GEO_SPEC = SourceSpec(
    "geo_small",
    StructType(
        [
            StructField("id", StringType(), True),
            StructField("z", IntegerType(), True),
            StructField("lat", DoubleType(), True),
        ]
    ),
    ("id", "z", "lat"),
)


def test_quarantine_corrupt_rows(spark, tmp_path):
    text = "id,z,lat\na,1,1.5\nb,2\nc,3,2.5,extra\nd,xx,3.5\ne,5,4.5\n"
    p = _write(tmp_path, "geo.csv", text)
    good, bad = RD.read_source_quarantine(spark, GEO_SPEC, p)
    assert sorted(r["id"] for r in good.collect()) == ["a", "e"]
    # Spark rejects queries that need only the corrupt-record column (a bare
    # count would), so quarantined rows are read whole.
    rows = bad.collect()
    assert len(rows) == 3 and RD.count_quarantined(bad) == 3
    assert all(r["_corrupt_record"] for r in rows)


def test_reordered_header_is_an_error(spark, tmp_path):
    p = _write(tmp_path, "geo.csv", "z,id,lat\n12,a,1.0\n")
    with pytest.raises(Exception):
        RD.read_source(spark, GEO_SPEC, p).collect()


def test_null_value_option(spark, tmp_path):
    p = _write(tmp_path, "geo.csv", "id,z,lat\na,1,NA\n")
    assert RD.read_source(spark, GEO_SPEC, p, null_value="NA").collect()[0]["lat"] is None


def test_timestamps_bad_text_becomes_null(spark):
    vals = ["2017-10-02 10:56:33", "2017-10-02", "garbage", "", None]
    df = spark.createDataFrame([(v,) for v in vals], "order_purchase_timestamp string")
    out = [r[0] for r in fix_timestamps(df).collect()]
    assert out[0].year == 2017 and out[0].second == 33
    assert out[1:] == [None, None, None, None]
    fails = timestamp_parse_failures(df).collect()[0]
    assert fails["parse_failures"] == 3


def test_profiles(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    prof = P.profile({"t": df}).collect()[0]
    assert (prof["rows"], prof["cols"]) == (3, 2)
    nulls = {r["column_name"]: r["null_count"] for r in P.null_profile(df, "t").collect()}
    assert nulls == {"a": 1, "b": 2}
    assert P.schema_listing(df) == [("a", "int", True), ("b", "string", True)]


def test_parquet_layers_roundtrip(spark, tmp_path):
    from haulage.sinks import write_layer, write_partitioned

    df = spark.createDataFrame([(2017, 1, "a"), (2017, 2, "b"), (2018, 1, "c")], "order_year int, order_month int, v string")
    write_layer(df, str(tmp_path / "flat"))
    assert RD.read_layer(spark, str(tmp_path / "flat")).count() == 3
    write_partitioned(df, str(tmp_path / "part"))
    back = RD.read_layer(spark, str(tmp_path / "part"))
    assert back.filter(F.col("order_year") == 2017).count() == 2
    # Dynamic overwrite replaces only the months present in the new data.
    write_partitioned(spark.createDataFrame([(2017, 1, "z")], df.schema), str(tmp_path / "part"), overwrite="dynamic")
    vals = sorted(r["v"] for r in RD.read_layer(spark, str(tmp_path / "part")).collect())
    assert vals == ["b", "c", "z"]


def test_gold_csv_export_readable(spark, tmp_path):
    from haulage.sinks import write_gold

    df = spark.createDataFrame([("SP", 10, 8.7)], "customer_state string, total_orders bigint, avg_delivery_days double")
    write_gold(df, str(tmp_path / "kpi"))
    back = RD.read_gold_csv(spark, str(tmp_path / "kpi_csv"), df.schema)
    assert back.collect()[0]["avg_delivery_days"] == 8.7


def test_lenient_timestamps_in_compat(spark):
    vals = ["2017-1-2 3:04:05", "2017-10-02 10:56:33.000", " 2017-10-02 10:56:33", "2017-10-02", "junk", None]
    df = spark.createDataFrame([(v,) for v in vals], "order_purchase_timestamp string")
    strict = [r[0] for r in fix_timestamps(df).collect()]
    assert strict == [None] * 6
    lenient = [r[0] and r[0].isoformat() for r in fix_timestamps(df, mode="compat").collect()]
    assert lenient == ["2017-01-02T03:04:05", "2017-10-02T10:56:33", "2017-10-02T10:56:33", None, None, None]
    assert timestamp_parse_failures(df, mode="compat").collect()[0]["parse_failures"] == 2


def test_connect_keeps_only_whole_rows(spark, tmp_path):
    p = _write(tmp_path, "geo.csv", "id,z,lat\na,1,1.5\nb,2\nc,3,not_a_float\n")
    c = RD.connect_checked(spark, GEO_SPEC, p)
    assert c.rows.count() == 1 and c.rows.select("id").collect()[0]["id"] == "a"
    assert sorted(r["id"] for r in c.quarantine.collect()) == ["b", "c"]
    assert c.warnings() == ["lat: 1 values are not of type double"]


def test_cluster_needs_a_checkpoint_folder():
    from types import SimpleNamespace

    from haulage.session import ensure_checkpoint_dir

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="yarn")
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: None))
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(session)


def test_sources_without_a_path_are_found_below_the_base_folder(spark, tmp_path):
    from haulage.plans.pipeline import Pipeline
    from haulage.schemas import SOURCE_SPECS
    from haulage.sources.readers import connect, read_source
    from haulage.sources.testdata import source_frames

    base = str(tmp_path / "base")
    assert SOURCE_SPECS["orders"].default_path("/x/") == "/x/data_source/orders.csv"
    assert SOURCE_SPECS["orders"].with_path("/y.csv").default_path("/x") == "/y.csv"
    with pytest.raises(FileNotFoundError):
        connect(spark, "orders", base_dir=base)
    for name, df in source_frames(spark, "/root/testdata/sf0.001").items():
        df.coalesce(1).write.option("header", "true").csv(SOURCE_SPECS[name].default_path(base))
    assert connect(spark, "orders", base_dir=base).count() == read_source(spark, "orders", base_dir=base).count() == 1500
    pipe = Pipeline.from_csv(spark, None, str(tmp_path / "out"), steps="bronze", base_dir=base)
    assert pipe.run("bronze")[0].rows == 1500

import pytest
from pyspark.sql import functions as F

from haulage.operators import contracts as C
from haulage.schemas import JoinContract

ORDER_COLS = [
    "order_id",
    "customer_id",
    "order_status",
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
]


def _orders(spark, ts="2017-10-02 10:56:33"):
    return spark.createDataFrame([("abc123", "cust001", "delivered", ts, ts, ts, ts, ts)], ORDER_COLS)


def test_valid_orders_schema(spark):
    r = C.validate_schema(_orders(spark), "orders")
    assert r.valid is True and r.errors == []


def test_date_only_orders_still_valid_schema(spark):
    assert C.validate_schema(_orders(spark, "2017-01-10"), "orders").valid is True


def test_missing_required_column(spark):
    df = spark.createDataFrame([("abc123", "cust001")], ["order_id", "customer_id"])
    r = C.validate_schema(df, "orders")
    assert r.valid is False and len(r.errors) > 0


def test_customers_valid(spark):
    df = spark.createDataFrame(
        [("cust001", "uniq001", 14409, "franca", "SP")],
        "customer_id string, customer_unique_id string, customer_zip_code_prefix bigint, "
        "customer_city string, customer_state string",
    )
    assert C.validate_schema(df, "customers").valid is True


def test_unknown_source_invalid(spark):
    df = spark.createDataFrame([(1,)], ["col1"])
    assert C.validate_schema(df, "unknown_source").valid is False


def test_empty_frame_invalid(spark):
    df = spark.createDataFrame([], "x int").drop("x")
    assert C.validate_schema(df, "orders").valid is False


def test_wrong_types_warn_but_valid(spark):
    df = spark.createDataFrame(
        [(1000, "not_a_float", "-46.6", "sao paulo", "SP")],
        "geolocation_zip_code_prefix int, geolocation_lat string, geolocation_lng string, "
        "geolocation_city string, geolocation_state string",
    )
    r = C.validate_schema(df, "geolocation")
    assert r.valid is True
    assert len(r.warnings) > 0


def test_schema_findings_statuses(spark):
    df = spark.createDataFrame([("abc123", "cust001", 1)], "order_id string, customer_id string, junk int")
    rows = {r["column_name"]: r["status"] for r in C.schema_findings(df, "orders").collect()}
    assert rows["order_id"] == "OK"
    assert rows["junk"] == "EXTRA"
    assert rows["order_status"] == "MISSING"


def _left_right(spark, left_ids, right_ids):
    left = spark.createDataFrame([(k, f"o{i}") for i, k in enumerate(left_ids)], ["customer_id", "order_id"])
    right = spark.createDataFrame(
        [(k, 1000 * (i + 1)) for i, k in enumerate(right_ids)], ["customer_id", "customer_zip_code_prefix"]
    )
    return left, right


def test_join_full_match(spark):
    left, right = _left_right(spark, ["A", "B", "C"], ["A", "B", "C"])
    r = C.check_contract(left, right, "orders_vs_customers")
    assert r["can_join"] is True
    assert r["matching_keys"] == 3 and r["left_keys_no_match"] == 0
    assert r["match_rate"] == "100.0%"


def test_join_partial_match_does_not_block(spark):
    left, right = _left_right(spark, ["A", "B", "C", "D"], ["A", "B"])
    r = C.check_contract(left, right, "orders_vs_customers")
    assert r["can_join"] is True
    assert r["matching_keys"] == 2 and r["left_keys_no_match"] == 2
    assert r["match_rate"] == "50.0%"


def test_join_nulls_ignored_and_empty_left(spark):
    left = spark.createDataFrame([(None, "o1")], "customer_id string, order_id string")
    right = spark.createDataFrame([("A", 1)], "customer_id string, z int")
    r = C.check_contract(left, right, "orders_vs_customers")
    assert r["left_unique_keys"] == 0 and r["match_rate"] == "0%"


@pytest.mark.parametrize("side", ["left", "right"])
def test_join_key_missing(spark, side):
    left, right = _left_right(spark, ["A", "B"], ["A", "B"])
    if side == "left":
        left = left.withColumnRenamed("customer_id", "wrong_col")
    else:
        right = right.withColumnRenamed("customer_id", "wrong_col")
    r = C.check_contract(left, right, "orders_vs_customers")
    assert r["can_join"] is False
    assert r["left_unique_keys"] is None


def test_join_type_mismatch_blocks(spark):
    left = spark.createDataFrame([(1000,)], "customer_zip_code_prefix string")
    right = spark.createDataFrame([(1000,)], "geolocation_zip_code_prefix int")
    left = left.withColumn("customer_zip_code_prefix", F.col("customer_zip_code_prefix").cast("string"))
    r = C.check_contract(left, right, "customers_vs_geolocation")
    assert r["can_join"] is False and len(r["issues"]) == 2


def test_unknown_contract_raises(spark):
    left, right = _left_right(spark, ["A"], ["A"])
    with pytest.raises(KeyError):
        C.join_report(left, right, "no_such_contract")


def test_require_contracts_raises(spark):
    left, right = _left_right(spark, ["A"], ["A"])
    with pytest.raises(C.ContractError):
        C.require_contracts([(left.withColumnRenamed("customer_id", "x"), right, "orders_vs_customers")])


def test_matched_and_unmatched_keys(spark):
    left, right = _left_right(spark, ["A", "B", "C", "D", "D", None], ["A", "B"])
    m = sorted(r[0] for r in C.matched_keys(left, right, "orders_vs_customers").collect())
    u = sorted(r[0] for r in C.unmatched_keys(left, right, "orders_vs_customers").collect())
    assert m == ["A", "B"] and u == ["C", "D"]


def test_harmonize_text_to_int(spark):
    df = spark.createDataFrame([("1000",), ("2000",), ("3000",)], ["zip"])
    out = C.harmonize(df, "zip", "int64")
    assert out.schema["zip"].dataType.typeName() == "long"
    assert [r[0] for r in out.collect()] == [1000, 2000, 3000]


def test_harmonize_int_to_text(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], ["col"])
    out = C.harmonize(df, "col", "object")
    assert out.schema["col"].dataType.typeName() == "string"


def test_harmonize_null_to_zero_with_fill(spark):
    df = spark.createDataFrame([("1000",), (None,), ("3000",), ("x",), ("12.7",)], "zip string")
    assert [r[0] for r in C.harmonize(df, "zip", "int64", fill=0).collect()] == [1000, 0, 3000, 0, 12]
    assert [r[0] for r in C.harmonize(df, "zip", "int64").collect()] == [1000, None, 3000, None, 12]


def test_harmonize_does_not_mutate_input(spark):
    df = spark.createDataFrame([("1000",), ("2000",)], ["zip"])
    C.harmonize(df, "zip", "int64")
    assert df.schema["zip"].dataType.typeName() == "string"


def test_harmonize_unknown_target_unchanged(spark):
    df = spark.createDataFrame([("1000",)], ["zip"])
    assert C.harmonize(df, "zip", "complex128") is df


def test_harmonize_and_recheck_flow(spark):
    left = spark.createDataFrame([("1000",), ("2000",), ("x",)], "customer_zip_code_prefix string")
    right = spark.createDataFrame([(1000,), (3000,)], "geolocation_zip_code_prefix int")
    l2, r2, report = C.harmonize_and_recheck(left, right, "customers_vs_geolocation")
    assert report["can_join"] is True
    assert report["left_unique_keys"] == 2 and report["matching_keys"] == 1
    assert l2.schema["customer_zip_code_prefix"].dataType.typeName() == "long"


def test_keys_of_different_types_never_match(spark):
    left = spark.createDataFrame([(1000,), (2000,)], "zip int")
    for texts, numeric in ((["1000", "x"], False), (["1000", "2000"], True)):
        right = spark.createDataFrame([(t,) for t in texts], "zip string")
        contract = JoinContract("mixed", "zip", "zip", "int64", "mixed types")
        report = C.check_contract(left, right, contract)
        assert report["can_join"] is False and report["matching_keys"] == 0 and report["left_keys_no_match"] == 2
        assert report["match_rate"] == "0.0%"
        with pytest.raises(C.ContractError):
            C.require_contracts([(left, right, contract)])
        assert C.matched_keys(left, right, contract).count() == 0
        assert C.unmatched_keys(left, right, contract).count() == 2
        assert C.check_contract(left, right, contract, exact=False)["estimated"] is True
        l2, r2, again = C.harmonize_and_recheck(left, right, contract)
        assert again["can_join"] and again["matching_keys"] == (2 if numeric else 1)
    as_double = spark.createDataFrame([(1000.0,)], "zip double")
    assert C.key_overlap(left, as_double, "zip", "zip").first()["matching_keys"] == 1


def test_harmonize_keeps_all_64_bits(spark):
    df = spark.createDataFrame([("9007199254740993",), ("12.7",), ("junk",), (None,)], "v string")
    assert [r[0] for r in C.harmonize(df, "v", "int64").collect()] == [9007199254740993, 12, None, None]
    assert [r[0] for r in C.harmonize(df, "v", "int64", fill=0).collect()] == [9007199254740993, 12, 0, 0]


def test_contracts_checked_together_equal_single_checks(spark):
    """One job for both contracts gives what each gives alone, for numbers, texts, mixed types, NULLs and no rows."""
    from haulage.schemas import JoinContract
    from haulage.sources.testdata import source_frames

    src = source_frames(spark, "/root/testdata/sf0.001")
    a = spark.createDataFrame([(1, "1"), (2, None), (None, "x"), (2, "x")], "n int, t string")
    b = spark.createDataFrame([(1.0, "x"), (2.5, "2.5"), (9.0, None)], "d double, t string")
    number = JoinContract("number", "n", "d", "int64", "")
    text = JoinContract("text", "t", "t", "object", "")
    mixed = JoinContract("mixed", "t", "d", "object", "")
    pairs = [
        (src["orders"], src["customers"], "orders_vs_customers"),
        (src["customers"], src["geolocation"], "customers_vs_geolocation"),
        (a, b, number),
        (a, b, text),
        (a, b, mixed),
        (a.limit(0), b, text),
        (a.limit(0), b.limit(0), number),
    ]
    together = C.check_contracts(pairs)
    for pair, report in zip(pairs, together):
        assert report == C.check_contract(*pair)
    assert C.check_contracts([(a.drop("t"), b, text), pairs[2]]) == [C.check_contract(a.drop("t"), b, text), together[2]]

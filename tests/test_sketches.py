"""Mergeable sketches and the filtered anti join, against exact answers."""

import random

import pytest
from pyspark.sql import functions as F

from haulage.operators import contracts as C
from haulage.operators import sketches as K
from haulage.plans.materialise import materialise
from haulage.schemas import JoinContract
from haulage.sources.testdata import source_frames

KEYS = JoinContract("k", "k", "k", "int64", "")


def test_merged_medians_hold_their_rank_error_on_skewed_data(spark):
    # Days follow a steep power law, one state has two thirds of all rows, and months differ in shape.
    n, k = 300_000, 200
    u = F.rand(5)
    rows = spark.range(n).select(
        F.when(F.rand(6) < 0.667, "big").otherwise(F.concat(F.lit("s"), (F.col("id") % 5).cast("string"))).alias("customer_state"),
        F.lit(2017).alias("order_year"),
        (F.col("id") % 40).cast("int").alias("order_month"),
        F.lit("delivered").alias("order_status"),
        F.least(F.pow(u, F.lit(-1.5)) * (1 + F.col("id") % 40), F.lit(1e6)).cast("int").alias("actual_delivery_days"),
    )
    rows = materialise(rows, "skewed")
    stored = materialise(K.day_sketches(rows, k=k), "sketches")
    assert dict(stored.dtypes)["sketch"] == "binary" and stored.count() == 40 + 5 * 8
    orders = [stored]
    for seed in (1, 2):
        # Merged in two stages, over groups of months drawn at random.
        rng = random.Random(seed)
        group = F.element_at(F.array(*[F.lit(rng.randrange(7)) for _ in range(40)]), F.col("order_month") + 1)
        orders.append(K.merge_days(stored.withColumn("g", group), ("customer_state", "g")))
    for sketches in orders:
        checked = K.rank_check(K.median_by_sketch(sketches), rows, k=k)
        assert checked.count() == 6 and checked.where("not within_bound").isEmpty()
        assert sum(r["known_orders"] for r in checked.collect()) == n


def test_small_groups_are_exact(spark):
    rows = spark.createDataFrame(
        [("a", 2017, m, "delivered", d) for m, d in ((1, 5), (1, 9), (2, 1), (2, 7))]
        + [("b", 2017, 1, "delivered", None), ("b", 2017, 1, "shipped", 3), ("c", 2017, 3, "delivered", 2), (None, 2017, 1, "delivered", 4)],
        "customer_state string, order_year int, order_month int, order_status string, actual_delivery_days int",
    )
    got = {r[0]: (r[1], r[2]) for r in K.median_by_sketch(K.day_sketches(rows)).collect()}
    assert got == {"a": (4, 5), "c": (1, 2), None: (1, 4)}
    assert K.median_by_sketch(K.day_sketches(rows.limit(0))).count() == 0


@pytest.mark.parametrize("common", [0, 1, 40, 4_000, 400_000])
def test_intervals_hold_for_small_and_large_overlaps(spark, common):
    n = 400_000
    left = spark.range(n).select(F.col("id").alias("k"))
    right = spark.range(n - common, 2 * n - common).select(F.col("id").alias("k"))
    for log_entries in (12, 16):
        r = C.approx_key_overlap(left, right, "k", "k", log_entries).first()
        assert r["matching_low"] <= common <= r["matching_high"]
        assert r["no_match_low"] <= n - common <= r["no_match_high"]
        assert r["matching_low"] <= r["matching_keys"] <= r["matching_high"]
        assert abs(r["left_unique_keys"] - n) < n * 0.06
    # At 1 % the interval is narrow, where inclusion-exclusion would be lost in the union's error.
    if common == 4_000:
        assert r["matching_high"] - r["matching_low"] < 2_500


def test_small_sets_are_exact_and_types_never_match(spark):
    left = spark.createDataFrame([(1,), (2,), (2,), (None,), (7,)], "k long")
    right = spark.createDataFrame([(2.0,), (7.5,), (9.0,)], "k double")
    r = C.approx_key_overlap(left, right, "k", "k").first()
    assert tuple(r) == (3, 3, 1, 1, 1, 2, 2, 2)
    r = C.approx_key_overlap(left, right.select(F.col("k").cast("int").cast("string").alias("k")), "k", "k").first()
    assert r["matching_keys"] == r["matching_high"] == 0 and r["left_keys_no_match"] == 3
    r = C.approx_key_overlap(left.limit(0), right, "k", "k").first()
    assert tuple(r)[:3] == (0, 3, 0) and r["no_match_high"] == 0
    one = spark.createDataFrame([(5,)], "k long")
    assert tuple(C.approx_key_overlap(one, one, "k", "k").first())[:4] == (1, 1, 1, 1)


@pytest.mark.parametrize("matched", [0.0, 0.5, 1.0])
def test_filtered_anti_join_gives_the_same_rows(spark, matched):
    n = 50_000
    left = spark.range(2 * n).select((F.col("id") % n).cast("string").alias("k"))
    left = left.unionByName(spark.createDataFrame([(None,)], "k string"))
    shift = int(n * (1 - matched))
    right = spark.range(shift, n + shift).select(F.col("id").cast("string").alias("k"))
    got = {r["k"] for r in C.unmatched_keys_filtered(left, right, KEYS).collect()}
    assert got == {r["k"] for r in C.unmatched_keys(left, right, KEYS).collect()} and len(got) == shift
    undecided, misses = C.split_by_filter(left, right, KEYS)
    # What the exact join sees: the matches and a small share of the others.
    seen, sure = undecided.distinct().count(), misses.distinct().count()
    assert n - shift <= seen <= n - shift + 0.01 * shift + 5 and seen + sure == n
    plan = misses._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_filter_has_a_byte_budget_and_edges(spark):
    src = source_frames(spark, "/root/testdata/sf0.001")
    plain = {r[0] for r in C.unmatched_keys(src["customers"], src["geolocation"], "customers_vs_geolocation").collect()}
    for budget in (C.BLOOM_BYTES, 10):
        got = C.unmatched_keys_filtered(src["customers"], src["geolocation"], "customers_vs_geolocation", budget)
        assert {r[0] for r in got.collect()} == plain
    none = spark.createDataFrame([], "k string")
    some = spark.createDataFrame([("a",), (None,), ("a",)], "k string")
    assert [r["k"] for r in C.unmatched_keys_filtered(some, none, KEYS).collect()] == ["a"]
    assert C.unmatched_keys_filtered(none, some, KEYS).count() == 0
    assert [r["k"] for r in C.unmatched_keys_filtered(some, spark.createDataFrame([(1,)], "k int"), KEYS).collect()] == ["a"]

"""Co-located and clustered layouts: no exchange under the join, row groups skipped, rows as they were."""

import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from haulage.operators import bronze as B
from haulage.sinks import buckets, clustering, publish
from haulage.sinks.store import Store
from haulage.sources.testdata import source_frames

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_exchange_under_the_join(spark, tmp_out, no_broadcast):
    src = source_frames(spark, SF)
    orders, customers = buckets.colocate(src["orders"], src["customers"], tmp_out, 8)
    joined = B.join_orders_customers(orders, customers)
    assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined)
    plain = B.join_orders_customers(src["orders"], src["customers"])
    assert "Exchange" in plan(plain)
    assert sorted(map(str, joined.collect())) == sorted(map(str, plain.collect()))
    # Per-customer counts need none either.
    assert "Exchange" not in plan(orders.groupBy("customer_id").count())
    # Another session's catalog knows nothing of the table; its layout is in its state.
    spark.sql(f"DROP TABLE {buckets.table_name(tmp_out + '/orders')}")
    again = buckets.read_bucketed(spark, f"{tmp_out}/orders")
    assert "Exchange" not in plan(B.join_orders_customers(again, customers)) and again.count() == 1500


def test_colocated_bronze_equals_plain_bronze(spark, tmp_out):
    src = source_frames(spark, SF)
    geo = B.consolidate_geo(src["geolocation"])
    orders, customers = buckets.colocate(src["orders"], src["customers"], tmp_out, 4)
    want = B.enrich(src["orders"], src["customers"], geo, mode="compat")
    got = B.enrich(orders, customers, geo, mode="compat")
    assert sorted(map(str, got.drop("lat", "lng").collect())) == sorted(map(str, want.drop("lat", "lng").collect()))


def test_hot_key_gives_up_its_bucket(spark, tmp_out, no_broadcast):
    keyed = spark.range(200_000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("order_id"),
        F.when(F.col("id") % 3 == 0, "1").otherwise((F.col("id") % 5_000).cast("string")).alias("customer_id"),
    )
    buckets.write_bucketed(keyed, f"{tmp_out}/orders", "customer_id", 16, spread="order_id")
    sizes = buckets.bucket_sizes(spark, f"{tmp_out}/orders", 16)
    assert buckets.is_skewed(sizes, small=0) and not buckets.is_skewed(sizes)
    plainly = buckets.read_bucketed(spark, f"{tmp_out}/orders", small=0)
    assert "Exchange" in plan(plainly.groupBy("customer_id").count()) and plainly.count() == 200_000
    assert "Exchange" not in plan(buckets.read_bucketed(spark, f"{tmp_out}/orders").groupBy("customer_id").count())
    # Four tasks wrote the hot bucket, each about a quarter of it.
    hot = sorted(os.path.getsize(f) for f in glob.glob(f"{tmp_out}/orders/*.parquet"))[-4:]
    assert hot[0] > 0.8 * hot[-1] and sum(hot) > 0.8 * max(sizes)


def test_bucket_counts_divide_each_other():
    counts = [buckets.bucket_count(n << 20) for n in (0, 1, 300, 5_000, 100_000_000)]
    assert counts[:2] == [1, 1] and counts == sorted(counts) and counts[-1] == buckets.MAX_BUCKETS
    assert all(b % a == 0 for a, b in zip(counts, counts[1:]))


def silver_like(spark, n=40_000):
    day = F.expr("timestamp_seconds(1483228800 + cast(rand(3) * 31 * 86400 as bigint))")
    return spark.range(n).select(
        F.col("id").cast("string").alias("order_id"),
        F.concat(F.lit("S"), F.lpad((F.col("id") * 7919 % 27).cast("string"), 2, "0")).alias("customer_state"),
        day.alias("order_purchase_timestamp"),
        F.when(F.col("id") < n * 0.9, 2017).otherwise(2018).cast("int").alias("order_year"),
        F.lit(1).alias("order_month"),
    )


def groups(path, column="customer_state"):
    """(min, max, rows) of a column in every row group of all files below a folder."""
    out = []
    for f in glob.glob(f"{path}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(f).metadata
        at = [meta.schema.column(i).name for i in range(meta.num_columns)].index(column)
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            out.append((s.min, s.max, meta.row_group(g).num_rows))
    return out


def test_state_filter_skips_row_groups_inside_a_month(spark, tmp_out):
    rows = clustering.materialise(silver_like(spark), "rows")
    clustering.write_clustered(rows, f"{tmp_out}/clustered", file_rows=1000)
    rows.hint("rebalance", "order_year", "order_month").write.partitionBy("order_year", "order_month").parquet(f"{tmp_out}/plain")
    month = "order_year=2017/order_month=1"
    hit = [n for lo, hi, n in groups(f"{tmp_out}/clustered/{month}") if lo <= "S05" <= hi]
    total = [n for _, _, n in groups(f"{tmp_out}/clustered/{month}")]
    assert sum(total) == 36_000 and len(total) >= 30
    assert sum(hit) < 0.25 * sum(total)
    plain = [(lo <= "S05" <= hi) for lo, hi, _ in groups(f"{tmp_out}/plain/{month}")]
    assert all(plain)
    # The other half of the key skips as well, and a small month stays in few files.
    first = [n for lo, _, n in groups(f"{tmp_out}/clustered/{month}", "order_id")]
    assert len(first) == len(total) and len(groups(f"{tmp_out}/clustered/order_year=2018")) <= 8
    same = spark.read.parquet(f"{tmp_out}/clustered")
    assert same.exceptAll(rows.select(*same.columns)).isEmpty() and same.count() == 40_000


def test_key_interleaves_bits(spark):
    df = spark.createDataFrame([(a, b) for a in range(8) for b in range(8)], "a long, b long")
    keys = {(r["a"], r["b"]): r["k"] for r in df.select("a", "b", clustering.interleaved([F.col("a"), F.col("b")], 3).alias("k")).collect()}
    assert sorted(keys.values()) == list(range(64))
    assert keys[(0, 1)] == 1 and keys[(1, 0)] == 2 and keys[(1, 1)] == 3 and keys[(4, 0)] == 32 and keys[(7, 7)] == 63


def test_compaction_rewrites_only_fragmented_months(spark, tmp_out):
    path = f"{tmp_out}/silver"
    rows = clustering.materialise(silver_like(spark, 4_000), "rows")
    rows.where("order_year = 2017").repartition(40).write.partitionBy("order_year", "order_month").parquet(path)
    rows.where("order_year = 2018").coalesce(1).write.mode("append").partitionBy("order_year", "order_month").parquet(path)
    Store(spark).write_json(publish.state_path(path), {"kept": 1})
    calm = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/order_year=2018/**/*.parquet", recursive=True)}
    assert clustering.compact(spark, path) == ["order_year=2017/order_month=1"]
    assert len(glob.glob(f"{path}/order_year=2017/**/*.parquet", recursive=True)) == 1
    assert calm == {f: os.stat(f).st_mtime_ns for f in calm}
    after = spark.read.parquet(path)
    assert after.exceptAll(rows.select(*after.columns)).isEmpty() and after.count() == 4_000
    assert clustering.compact(spark, path) == [] and Store(spark).read_json(publish.state_path(path)) == {"kept": 1}


def test_null_states_days_and_months(spark, tmp_out):
    rows = spark.createDataFrame(
        [("a", None, None, None, None), ("b", "S1", None, 2017, 1), ("c", None, "2017-01-31 23:59:59", 2017, 1)],
        "order_id string, customer_state string, t string, order_year int, order_month int",
    ).withColumn("order_purchase_timestamp", F.col("t").cast("timestamp"))
    clustering.write_clustered(rows, f"{tmp_out}/n")
    assert sorted(r["order_id"] for r in spark.read.parquet(f"{tmp_out}/n").collect()) == ["a", "b", "c"]
    clustering.write_clustered(rows.limit(0), f"{tmp_out}/e")


def test_files_of_a_month_do_not_grow_with_its_rows(spark, tmp_out):
    rows = clustering.materialise(silver_like(spark), "rows")
    clustering.write_clustered(rows, f"{tmp_out}/few", file_rows=100, month_files=4)
    month = "order_year=2017/order_month=1"
    counts = [n for _, _, n in groups(f"{tmp_out}/few/{month}")]
    assert sum(counts) == 36_000 and 2 <= len(counts) <= 12
    same = spark.read.parquet(f"{tmp_out}/few")
    assert same.exceptAll(rows.select(*same.columns)).isEmpty() and same.count() == 40_000
    assert month in clustering.fragmented(spark, f"{tmp_out}/few")
    assert clustering.fragmented(spark, f"{tmp_out}/missing") == []

"""Plan-shape checks: pushdown, pruning, no Python UDFs, broadcast lookups."""

import contextlib
import io
import re
import uuid

import pytest
from pyspark.sql import functions as F

from haulage.operators import gold as G
from haulage.operators.bronze import consolidate_geo, enrich
from haulage.operators.silver import build_silver
from haulage.plans.catalog import QUERIES
from haulage.plans.pipeline import Pipeline
from haulage.sources.testdata import source_frames

SF = "/root/testdata/sf0.001"


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("layers"))
    p = Pipeline(spark, source_frames(spark, SF), out, gold_csv=False)
    p.run(["bronze", "silver"])
    return p.paths


def test_filter_pushed_to_parquet_and_columns_pruned(spark, layers):
    silver = spark.read.parquet(layers.silver)
    kpi = G.delivery_by_state(silver)
    plan = _plan(kpi)
    assert "PushedFilters: [IsNotNull(order_status), EqualTo(order_status,delivered)]" in plan
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "lat" not in schema and "order_approved_at" not in schema


def test_partition_pruning_on_silver(spark, layers):
    silver = spark.read.parquet(layers.silver)
    plan = _plan(silver.filter(F.col("order_year") == 1997).groupBy("order_month").count())
    assert re.search(r"PartitionFilters: \[[^\]]*order_year", plan)


def test_no_python_udf_in_any_query(spark):
    for name, fn in QUERIES.items():
        plan = _plan(fn(spark, SF))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_state_means_joined_by_broadcast(spark):
    src = source_frames(spark, SF)
    bronze = enrich(src["orders"], src["customers"], consolidate_geo(src["geolocation"]))
    plan = _plan(build_silver(bronze))
    assert "BroadcastHashJoin" in plan
    # The order rows are never repartitioned by state for the means.
    assert "Window" not in plan


def test_checkpoint_dir_from_session(spark):
    assert spark.sparkContext.getCheckpointDir()


def _jobs(spark, action):
    """Number of Spark jobs that ``action`` starts."""
    group = f"count-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        action()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setJobGroup("", "")


def test_operators_start_no_job(spark):
    from haulage.operators import bronze as B
    from haulage.operators import gold as G
    from haulage.operators import silver as S
    from haulage.sources.testdata import source_frames

    src = source_frames(spark, "/root/testdata/sf0.001")
    geo = B.consolidate_geo(src["geolocation"])
    means = spark.createDataFrame([("NATION_1", 1.0, 2.0)], "customer_state string, _m_lat double, _m_lng double")

    def build():
        bronze = B.enrich(src["orders"], src["customers"], geo)
        S.clean_geo(bronze, means=means)
        S.build_silver(bronze, mode="compat")
        G.delivery_by_state(S.build_silver(bronze, means=means))

    assert _jobs(spark, build) == 0
    assert _jobs(spark, lambda: means.count()) > 0


@pytest.fixture
def scans(spark, tmp_path, monkeypatch):
    """Counts the scans of a table over *all* jobs that a query runs, by the accumulators of its executed plans."""

    def count(name, table):
        seen = []
        writer = type(spark.range(0).write)
        for sink in ("parquet", "save"):
            real = getattr(writer, sink)

            def noted(self, *args, _real=real, **kwargs):
                seen.append(self._df._jdf.queryExecution().optimizedPlan().toString())
                return _real(self, *args, **kwargs)

            monkeypatch.setattr(writer, sink, noted)
        QUERIES[name](spark, SF).write.format("noop").mode("overwrite").save()
        return [len(re.findall(rf"Relation \[[^\]]*{table}[^\]]*\] parquet", plan)) for plan in seen]

    return count


@pytest.mark.parametrize("name", ["delivery_by_state", "monthly_trend", "late_severity", "speed_distribution", "silver_stats"])
def test_kpi_queries_read_the_orders_once_and_no_coordinates(scans, name):
    assert sum(scans(name, "o_orderkey")) == 1
    assert sum(scans(name, "l_orderkey")) == 0


@pytest.mark.parametrize("name,most", [("executive_summary", 1), ("silver_orders", 2), ("cleaning_report", 2), ("row_preservation", 2), ("silver_orders_compat", 2)])
def test_scans_of_the_orders_over_all_jobs(scans, name, most):
    """The wide rows are built once; a second, narrow scan counts the orders by customer for the state means."""
    assert sum(scans(name, "o_orderkey")) == most


def test_large_geolocation_keeps_its_rows(spark):
    """20,000 consolidated zip groups, more than any row tier of a lookup."""
    from pyspark.sql import functions as F

    from haulage.operators import bronze as B
    from haulage.operators import silver as S
    from haulage.sources.testdata import source_frames

    src = source_frames(spark, "/root/testdata/sf0.001")
    zips = spark.range(20_000).withColumnRenamed("id", "z")
    geo = zips.select(
        F.col("z").cast("int").alias("geolocation_zip_code_prefix"),
        (F.lit(-30.0) + F.col("z") / 1000).alias("geolocation_lat"),
        (F.lit(-60.0) + F.col("z") / 1000).alias("geolocation_lng"),
        F.lit("c").alias("geolocation_city"),
        F.lit("S").alias("geolocation_state"),
    )
    bronze = B.enrich(src["orders"], src["customers"], B.consolidate_geo(geo), mode="compat")
    rows = bronze.agg(F.count("*"), F.count("lat"), F.max(F.abs(F.col("lat") + 30 - F.col("zip_code") / 1000))).first()
    assert rows[0] == rows[1] == 1500 and rows[2] < 1e-9
    assert S.build_silver(bronze, mode="compat").where("lat is null").count() == 0


def test_approx_join_report_close_to_exact(spark):
    from haulage.operators import contracts as C
    from haulage.sources.testdata import source_frames

    src = source_frames(spark, "/root/testdata/sf0.01")
    exact = C.join_report(src["customers"], src["geolocation"], "customers_vs_geolocation").collect()[0]
    approx = C.join_report(src["customers"], src["geolocation"], "customers_vs_geolocation", exact=False).collect()[0]
    for col in ("left_unique_keys", "right_unique_keys", "matching_keys"):
        assert abs(approx[col] - exact[col]) <= max(3, 0.05 * exact[col])

"""Incremental silver and cube: equal to a full rebuild, with untouched months left as they are."""

import os

import pytest
from pyspark.sql import functions as F

from haulage.operators import bronze as B
from haulage.operators import gold as G
from haulage.operators import silver as S
from haulage.operators.quality import QualityGateError
from haulage.plans import incremental as I
from haulage.plans.catalog import as_of
from haulage.sinks import publish
from haulage.sources.testdata import source_frames

SF = "/root/testdata/sf0.001"


def tables(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def rows(df):
    names = sorted(c for c in df.columns if c != "ingestion_timestamp")
    shown = [F.round(F.col(c) * 2**20).alias(c) if c in ("lat", "lng") else F.col(c) for c in names]
    return sorted(map(repr, df.select(*shown).collect()))


@pytest.fixture
def world(spark):
    """Silver of any version of the orders, over one set of state means."""
    src = source_frames(spark, SF)
    geo = B.consolidate_geo(src["geolocation"])
    counts = B.coordinate_counts(src["orders"], src["customers"], geo).toPandas()
    fixed = S.state_means(spark.createDataFrame(counts))

    def silver(orders):
        bronze = B.add_lineage(B.enrich(orders, src["customers"], geo))
        return S.build_silver(bronze, means=fixed)

    return src["orders"], silver


def test_refresh_equals_a_rebuild_and_keeps_untouched_months(spark, world, tmp_out):
    orders, silver = world
    path, cube = f"{tmp_out}/silver", f"{tmp_out}/cube"
    first = I.refresh_silver(silver(orders), path)
    assert len(first.changed) == first.months > 12 and first.rows == 1500
    I.refresh_cube(spark, path, cube)
    before = tables(path)
    assert I.refresh_silver(silver(orders), path).changed == [] and tables(path) == before
    assert I.refresh_cube(spark, path, cube) == []

    # An order moves to another month, one changes its status, one goes, one comes twice.
    ids = [r["order_id"] for r in orders.orderBy("order_id").limit(4).collect()]
    month = F.col("order_purchase_timestamp")
    edited = (
        orders.where(F.col("order_id") != ids[2])
        .withColumn("order_purchase_timestamp", F.when(F.col("order_id") == ids[0], F.lit("1997-05-05 00:00:00")).otherwise(month))
        .withColumn("order_status", F.when(F.col("order_id") == ids[1], F.lit("lost")).otherwise(F.col("order_status")))
    )
    edited = edited.unionByName(orders.where(F.col("order_id") == ids[3]))
    done = I.refresh_silver(silver(edited), path)
    assert 2 <= len(done.changed) <= 5 and "order_year=1997/order_month=5" in done.changed
    assert rows(spark.read.parquet(path)) == rows(silver(edited))
    after = tables(path)
    same = {f: t for f, t in before.items() if not any(m in f for m in done.changed)}
    assert same and all(after[f] == t for f, t in same.items())
    assert I.refresh_cube(spark, path, cube) == done.changed
    assert rows(spark.read.parquet(cube)) == rows(G.order_cube(silver(edited)))


def test_months_that_lose_all_rows_are_dropped(spark, world, tmp_out):
    orders, silver = world
    path, cube = f"{tmp_out}/silver", f"{tmp_out}/cube"
    I.refresh_silver(silver(orders), path)
    I.refresh_cube(spark, path, cube)
    fewer = orders.where(~F.col("order_purchase_timestamp").startswith("1998"))
    done = I.refresh_silver(silver(fewer), path)
    assert len(done.changed) == 12 and not os.path.exists(f"{path}/order_year=1998/order_month=1")
    assert rows(spark.read.parquet(path)) == rows(silver(fewer))
    I.refresh_cube(spark, path, cube)
    assert rows(spark.read.parquet(cube)) == rows(G.order_cube(silver(fewer)))


def test_changed_means_reach_the_rows_that_they_fill(spark, world, tmp_out):
    orders, silver = world
    path = f"{tmp_out}/silver"
    table = silver(orders)
    I.refresh_silver(table, path)
    moved = table.withColumn("lat", F.when(F.col("geo_imputed"), F.col("lat") + 0.5).otherwise(F.col("lat")))
    done = I.refresh_silver(moved, path)
    want = {I.partition_name(tuple(r)) for r in table.where("geo_imputed").select(*I.MONTH).distinct().collect()}
    assert set(done.changed) == want and rows(spark.read.parquet(path)) == rows(moved)


def test_failing_months_publish_nothing(spark, world, tmp_out):
    orders, silver = world
    path = f"{tmp_out}/silver"
    I.refresh_silver(silver(as_of(orders, "1998-01-01")), path)
    before = tables(path)
    bad = silver(orders).withColumn("order_id", F.when(F.col("order_year") < 2000, F.col("order_id")))
    with pytest.raises(QualityGateError):
        I.refresh_silver(bad, path)
    assert tables(path) == before


def test_refresh_after_a_full_write_and_after_a_crash(spark, world, tmp_out, monkeypatch):
    orders, silver = world
    path, cube = f"{tmp_out}/silver", f"{tmp_out}/cube"
    publish.publish_checked(silver(as_of(orders, "1998-01-01")), path)  # says nothing of digests
    I.refresh_cube(spark, path, cube)
    with monkeypatch.context() as m:
        m.setattr(publish, "swap", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            I.refresh_silver(silver(orders), path)
    # The journal was written: the next refresh rolls it forward and finds nothing left to do.
    assert I.refresh_silver(silver(orders), path).changed == []
    assert rows(spark.read.parquet(path)) == rows(silver(orders))
    # The cube was not told; it still finds out.
    assert I.refresh_cube(spark, path, cube)
    assert rows(spark.read.parquet(cube)) == rows(G.order_cube(silver(orders)))


def test_null_months(spark, world, tmp_out):
    orders, silver = world
    path = f"{tmp_out}/silver"
    known = as_of(orders, "1996-06-01")
    blank = known.withColumn("order_purchase_timestamp", F.when(F.col("order_status") != "canceled", F.col("order_purchase_timestamp")))
    I.refresh_silver(silver(known), path)
    assert f"order_year={I.NULL_PARTITION}/order_month={I.NULL_PARTITION}" in I.refresh_silver(silver(blank), path).changed
    assert rows(spark.read.parquet(path)) == rows(silver(blank))
    I.refresh_silver(silver(known), path)
    assert rows(spark.read.parquet(path)) == rows(silver(known))


def test_deltas_add_and_remove(spark, world):
    orders, silver = world
    old, new = silver(as_of(orders, "1999-01-01")), silver(orders)
    cube = I.apply_deltas(G.order_cube(old), added=new, removed=old)
    assert rows(cube) == rows(G.order_cube(new))
    assert I.apply_deltas(G.order_cube(old), removed=old).count() == 0
    with pytest.raises(Exception, match="more rows removed"):
        I.apply_deltas(G.order_cube(old), removed=new).collect()


def test_incremental_pipeline_equals_a_full_one(spark, tmp_out):
    from haulage.plans.pipeline import Pipeline

    src = source_frames(spark, SF)
    early = {**src, "orders": as_of(src["orders"], "2000-07-01 00:00:00")}
    for sources in (early, src):
        pipe = Pipeline(spark, sources, f"{tmp_out}/grown", gold_csv=False, incremental=True)
        audit = {a.step: a for a in pipe.run(["bronze", "silver", "gold"])}
    full = Pipeline(spark, src, f"{tmp_out}/full", gold_csv=False)
    full.run(["bronze", "silver", "gold"])
    silver = audit["silver"].detail
    assert 0 < len(silver["changed_months"]) <= silver["months"]
    assert audit["gold"].detail["changed_months"] == silver["changed_months"]
    assert rows(spark.read.parquet(pipe.paths.silver)) == rows(spark.read.parquet(full.paths.silver))
    for table in ("kpi_delivery_by_state", "kpi_monthly_trend", "kpi_late_orders", "executive_summary"):
        assert rows(spark.read.parquet(pipe.paths.gold(table))) == rows(spark.read.parquet(full.paths.gold(table))), table
    # A rebuild of the same orders changes no month, though its means are summed in another order.
    same = Pipeline(spark, src, f"{tmp_out}/grown", gold_csv=False, incremental=True).run(["bronze", "silver"], force=True)
    assert same[1].status == "ran" and same[1].detail["changed_months"] == []
    again = Pipeline(spark, src, f"{tmp_out}/grown", gold_csv=False, incremental=True)
    again.run("all")
    assert {a.step: a.status for a in again.run(["bronze", "silver", "gold"])[5:]} == {
        "bronze": "skipped", "silver": "skipped", "gold": "skipped",
    }


def test_pipeline_leaves_no_scratch_tables(spark, tmp_out):
    from haulage.plans.pipeline import Pipeline
    from haulage.session import ensure_checkpoint_dir

    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    Pipeline(spark, source_frames(spark, SF), tmp_out, mode="compat").run("all")
    assert set(os.listdir(folder)) == before

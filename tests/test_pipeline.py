import json
import os

import pytest
from pyspark.sql import functions as F

from haulage.operators import bronze as B
from haulage.operators.quality import QualityGateError, gate, quality_checks
from haulage.plans.pipeline import Pipeline
from haulage.sinks import gated_write
from haulage.sources.testdata import source_frames

SF = "/root/testdata/sf0.001"


def test_pipeline_end_to_end(spark, tmp_out):
    p = Pipeline(spark, source_frames(spark, SF), tmp_out)
    audit = p.run("all")
    assert [a.step for a in audit] == ["ingest", "validate", "bronze", "silver", "gold"]
    rows = {a.step: a.rows for a in audit}
    assert rows["bronze"] == 1500 and rows["silver"] == 1500
    silver = spark.read.parquet(p.paths.silver)
    assert {"order_year", "order_month"} <= set(silver.columns)
    assert any(d.startswith("order_year=") for d in os.listdir(p.paths.silver))
    kpi = spark.read.parquet(p.paths.gold("kpi_delivery_by_state"))
    assert kpi.count() == 25
    text = spark.read.option("header", "true").csv(p.paths.gold("executive_summary_text") + "_csv")
    assert text.count() == 10 and text.columns == ["metric", "value"]
    assert os.path.isdir(p.paths.gold("kpi_delivery_by_state") + "_csv")
    assert p.audit_frame().count() == 5
    ingest = audit[0].detail["sources"]
    assert ingest["orders"]["rows"] == 1500 and ingest["orders"]["cols"] == 8 and ingest["orders"]["seconds"] >= 0


def test_pipeline_single_step_needs_only_its_inputs(spark, tmp_out):
    Pipeline(spark, source_frames(spark, SF), tmp_out).run(["bronze", "silver"])
    # Gold reads only the silver layer: no sources are required.
    Pipeline(spark, None, tmp_out).run("gold")
    with pytest.raises(FileNotFoundError):
        Pipeline(spark, None, tmp_out).run("bronze")
    with pytest.raises(ValueError):
        Pipeline(spark, None, tmp_out).run("nonsense")


def test_gate_blocks_write(spark, tmp_out):
    bad = spark.createDataFrame(
        [(None, "c", 400, 80.0, -50.0, 2017, 1)],
        "order_id string, customer_id string, actual_delivery_days int, lat double, lng double, "
        "order_year int, order_month int",
    )
    with pytest.raises(QualityGateError) as e:
        gated_write(bad, tmp_out + "/silver")
    failed = dict(e.value.failed)
    assert set(failed) == {"order_id_not_null", "delivery_days_in_range", "lat_in_bounds"}
    assert not os.path.exists(tmp_out + "/silver")


def test_gate_passes_on_clean_silver(spark):
    src = source_frames(spark, SF)
    from haulage.operators.silver import build_silver

    silver = build_silver(B.enrich(src["orders"], src["customers"], B.consolidate_geo(src["geolocation"])))
    results = gate(quality_checks(silver))
    assert all(ok for _, _, ok in results) and len(results) == 5


def test_compat_counts_match_published_fixture_numbers(spark):
    """Compat mode reproduces the reference's counts on the adapter tables (sf0.01)."""
    from haulage.operators.gold import late_severity
    from haulage.operators.marts import speed_distribution
    from haulage.operators.silver import build_silver

    src = source_frames(spark, "/root/testdata/sf0.01")
    bronze = B.enrich(src["orders"], src["customers"], B.consolidate_geo(src["geolocation"]), mode="compat")
    assert bronze.count() == 15144
    assert bronze.filter(F.col("lat").isNull()).count() == 726
    silver = build_silver(bronze, mode="compat")
    speed = {r["delivery_speed_category"]: r["orders"] for r in speed_distribution(silver).collect()}
    assert speed == {"FAST": 1423, "NORMAL": 2993, "SLOW": 7416, "VERY_SLOW": 2523, "UNKNOWN": 789}
    sev = {r["delay_severity"]: r["num_orders"] for r in late_severity(silver).collect()}
    assert sev == {"MINOR": 1276, "MODERATE": 1436, "SEVERE": 1069, "CRITICAL": 62}
    status = {r[0]: r[1] for r in bronze.groupBy("order_status").count().collect()}
    assert status == {"delivered": 14385, "shipped": 378, "canceled": 381}


def test_pipeline_from_csv_sources(spark, tmp_out):
    src = source_frames(spark, SF)
    paths = {}
    for name, df in src.items():
        path = f"{tmp_out}/csv/{name}"
        df.coalesce(1).write.option("header", "true").csv(path)
        paths[name] = path
    # Malformed lines are quarantined, not loaded, even if their customer exists.
    known = src["orders"].first()["customer_id"]
    for name, lines in {
        "customers": ["broken_row_without_enough_fields"],
        "orders": [f"short-order,{known},delivered"],
        "geolocation": ["1,not_a_float,2.0,city,STATE"],
    }.items():
        with open(paths[name] + "/late-delivery.csv", "w") as f:
            f.write("\n".join([",".join(src[name].columns), *lines, ""]))
    p = Pipeline.from_csv(spark, paths, f"{tmp_out}/out")
    audit = {a.step: a for a in p.run("all")}
    assert audit["ingest"].detail["quarantined"] == {"customers": 1, "geolocation": 1, "orders": 1}
    assert any("geolocation_lat" in w for w in audit["ingest"].detail["warnings"]["geolocation"])
    assert audit["bronze"].rows == 1500 and audit["silver"].rows == 1500
    bronze = spark.read.parquet(p.paths.bronze)
    assert bronze.where("order_id = 'short-order'").isEmpty()
    kept = spark.read.parquet(p.paths.quarantine("orders")).collect()
    assert [r["_corrupt_record"] for r in kept] == [f"short-order,{known},delivered"]
    assert set(audit["silver"].detail["timestamp_parse_failures"].values()) == {0}
    # A gold-only run needs no source files at all.
    Pipeline.from_csv(spark, {}, f"{tmp_out}/out", steps="gold").run("gold")
    with pytest.raises(FileNotFoundError):
        Pipeline.from_csv(spark, {"orders": paths["orders"]}, f"{tmp_out}/out2", steps="bronze")


def test_command_line(spark, tmp_out, capsys):
    from haulage.__main__ import main

    src = source_frames(spark, SF)
    args = []
    for name, df in src.items():
        path = f"{tmp_out}/csv/{name}"
        df.coalesce(1).write.option("header", "true").csv(path)
        args += [f"--{name}", path]
    assert main(["--step", "bronze,silver", "--out", f"{tmp_out}/out", *args], spark=spark) == 0
    lines = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert [x["step"] for x in lines] == ["bronze", "silver"] and lines[0]["rows"] == 1500
    assert main(["--step", "gold", "--out", f"{tmp_out}/out"], spark=spark) == 0
    assert main(["--step", "bronze", "--out", f"{tmp_out}/out2", "--orders", "/nonexistent.csv"], spark=spark) == 1


def test_validate_with_sketches(spark, tmp_out):
    audit = Pipeline(spark, source_frames(spark, SF), tmp_out, exact_contracts=False).run("validate")
    reports = {r["contract"]: r for r in audit[0].detail["reports"]}
    assert reports["orders_vs_customers"]["can_join"] is True
    assert abs(reports["orders_vs_customers"]["left_unique_keys"] - 150) <= 3


def test_compat_counts_match_fixture_numbers_sf01(spark):
    """The same published counts at sf0.1 (bronze, coordinates, buckets, statuses)."""
    from haulage.operators.gold import late_severity
    from haulage.operators.marts import speed_distribution
    from haulage.operators.silver import build_silver

    src = source_frames(spark, "/root/testdata/sf0.1")
    bronze = B.enrich(src["orders"], src["customers"], B.consolidate_geo(src["geolocation"]), mode="compat")
    r = bronze.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("lat").isNull()).alias("missing"),
        F.count_if((F.col("lat") < -34) | (F.col("lat") > 6)).alias("lat_out"),
        F.count_if((F.col("lng") < -74) | (F.col("lng") > -28)).alias("lng_out"),
    ).collect()[0]
    assert (r["rows"], r["missing"], r["lat_out"], r["lng_out"]) == (151690, 7477, 429, 248)
    silver = build_silver(bronze, mode="compat")
    speed = {x["delivery_speed_category"]: x["orders"] for x in speed_distribution(silver).collect()}
    assert speed == {"FAST": 14001, "NORMAL": 30089, "SLOW": 74270, "VERY_SLOW": 25434, "UNKNOWN": 7896}
    sev = {x["delay_severity"]: x["num_orders"] for x in late_severity(silver).collect()}
    assert sev == {"MINOR": 13365, "MODERATE": 14388, "SEVERE": 11126, "CRITICAL": 562}


def test_compat_pipeline_passes_four_checks(spark, tmp_out):
    audit = {a.step: a for a in Pipeline(spark, source_frames(spark, SF), tmp_out, mode="compat").run(["bronze", "silver"])}
    checks = audit["silver"].detail["checks"]
    assert [c[0] for c in checks] == ["order_id_not_null", "customer_id_not_null", "delivery_days_in_range", "lat_in_bounds"]
    assert all(c[2] for c in checks) and audit["silver"].rows == 1513


@pytest.mark.parametrize("mode", ["strict", "compat"])
def test_written_layers_match_the_oracle(spark, tmp_out, mode):
    """Bronze, silver and every gold table as written, in Parquet and CSV, against DuckDB over the raw tables."""
    import duckdb

    from haulage.plans.catalog import coord
    from haulage.plans.oracle import oracle_sql
    from haulage.schemas import BRONZE_COLUMNS
    from test_catalog import _rows

    con = duckdb.connect()
    for t in ("orders", "customer", "nation", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    p = Pipeline(spark, source_frames(spark, SF), tmp_out, mode=mode)
    p.run(["bronze", "silver", "gold"])
    tail = "" if mode == "strict" else "_compat"
    sql = oracle_sql()

    def grid(df):
        return df.select(*[coord(c) if c in ("lat", "lng") else F.col(c) for c in df.columns])

    def same(df, name):
        cur = con.execute(sql[name])
        names = [d[0] for d in cur.description]
        assert _rows(names, [tuple(r) for r in df.select(*names).collect()]) == _rows(names, cur.fetchall()), name

    bronze = spark.read.parquet(p.paths.bronze)
    assert bronze.where("data_source is null or ingestion_timestamp is null").isEmpty()
    same(grid(bronze.select(*BRONZE_COLUMNS)), "bronze_enriched_strict" if mode == "strict" else "bronze_enriched")
    lineage = [c for c in bronze.columns if c not in BRONZE_COLUMNS]
    same(grid(spark.read.parquet(p.paths.silver).drop(*lineage)), "silver_orders" + tail)
    for table, name in {
        "kpi_delivery_by_state": "delivery_by_state",
        "kpi_monthly_trend": "monthly_trend",
        "kpi_late_orders": "late_severity",
        "executive_summary": "executive_summary",
    }.items():
        df = spark.read.parquet(p.paths.gold(table))
        same(df, name + tail)
        if table != "executive_summary":
            same(spark.read.schema(df.schema).option("header", "true").csv(p.paths.gold(table) + "_csv"), name + tail)
    if mode == "strict":
        text = spark.read.option("header", "true").csv(p.paths.gold("executive_summary_text") + "_csv")
        same(text, "executive_summary_text")

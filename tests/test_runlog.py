"""Run record: finished steps are skipped, changed inputs and lost outputs are not, and the audit stays."""

import os

import pytest

from haulage.operators.quality import QualityGateError
from haulage.plans.pipeline import Pipeline
from haulage.plans.runlog import content_fingerprint
from haulage.rules import Rules
from haulage.sources.testdata import source_frames

SF = "/root/testdata/sf0.001"


@pytest.fixture
def sources(spark, tmp_path):
    """The three sources as CSV files of their own."""
    paths = {}
    for name, df in source_frames(spark, SF).items():
        paths[name] = f"{tmp_path}/csv/{name}"
        df.coalesce(1).write.option("header", "true").csv(paths[name])
    return paths


def statuses(audit):
    return {a.step: a.status for a in audit}


def pipeline(spark, sources, out, **options):
    return Pipeline.from_csv(spark, sources, out, **options)


def test_second_run_skips_and_changes_do_not(spark, sources, tmp_out):
    out = f"{tmp_out}/out"
    first = pipeline(spark, sources, out).run("all")
    assert set(statuses(first).values()) == {"ran"}
    second = pipeline(spark, sources, out).run("all")
    assert set(statuses(second).values()) == {"skipped"}
    assert [a.rows for a in second] == [a.rows for a in first]
    assert second[3].detail["timestamp_parse_failures"] == first[3].detail["timestamp_parse_failures"]

    # One more order: everything that it reaches runs again.
    with open(f"{sources['orders']}/more.csv", "w") as f:
        cols = source_frames(spark, SF)["orders"].columns
        known = source_frames(spark, SF)["orders"].first()["customer_id"]
        f.write(",".join(cols) + f"\nnew-order,{known},delivered,1999-01-02 00:00:00,,,,\n")
    third = pipeline(spark, sources, out).run("all")
    assert set(statuses(third).values()) == {"ran"} and third[2].rows == first[2].rows + 1

    # Other rules are another result; ``force`` runs what is finished.
    assert statuses(pipeline(spark, sources, out).run(["silver", "gold"])) == {"silver": "skipped", "gold": "skipped"}
    assert statuses(pipeline(spark, sources, out, rules=Rules(max_delivery_days=200)).run("silver")) == {"silver": "ran"}
    assert statuses(pipeline(spark, sources, out).run("bronze", force=True)) == {"bronze": "ran"}

    history = pipeline(spark, sources, out, steps="gold").audit_history().collect()
    assert len(history) == 5 + 5 + 5 + 2 + 1 + 1 and len({r["run_id"] for r in history}) == 6
    assert [r["status"] for r in history[:10]] == ["ran"] * 5 + ["skipped"] * 5
    assert all(r["started_at"] is not None and r["seconds"] >= 0 for r in history)


def test_run_resumes_behind_the_last_complete_step(spark, tmp_out, monkeypatch):
    src = source_frames(spark, SF)
    with monkeypatch.context() as m:
        m.setattr(Pipeline, "gold", lambda self: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            Pipeline(spark, src, tmp_out).run("all")
    again = Pipeline(spark, src, tmp_out)
    assert statuses(again.run("all")) == {
        "ingest": "skipped", "validate": "skipped", "bronze": "skipped", "silver": "skipped", "gold": "ran",
    }
    failed = again.audit_history().where("status = 'failed'").collect()
    assert len(failed) == 1 and failed[0]["step"] == "gold" and "ZeroDivisionError" in failed[0]["detail"]


def test_lost_or_changed_outputs_are_built_again(spark, tmp_out):
    src = source_frames(spark, SF)
    Pipeline(spark, src, tmp_out).run(["bronze", "silver"])
    part = next(os.path.join(d, f) for d, _, fs in os.walk(f"{tmp_out}/silver") for f in fs if f.endswith(".parquet"))
    os.rename(part, f"{tmp_out}/moved.parquet")
    assert statuses(Pipeline(spark, src, tmp_out).run(["bronze", "silver"])) == {"bronze": "skipped", "silver": "ran"}


def test_failed_gate_is_recorded_and_runs_again(spark, tmp_out):
    src = source_frames(spark, SF)
    strict = Rules(max_delivery_days=3)
    Pipeline(spark, src, tmp_out).run("bronze")
    for _ in range(2):
        with pytest.raises(QualityGateError):
            Pipeline(spark, src, tmp_out, rules=strict).run("silver")
    history = Pipeline(spark, src, tmp_out).audit_history()
    assert history.where("status = 'failed' and step = 'silver'").count() == 2


def test_frames_without_files_are_fingerprinted_by_content(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (2, None)], "k long, v string")
    b = spark.createDataFrame([(2, None), (1, "x"), (2, None)], "k long, v string").repartition(3)
    assert content_fingerprint(a) == content_fingerprint(b)
    for other in ([(1, "x"), (2, None)], [(1, "x"), (2, None), (2, "")], [(1, None), (2, "x"), (2, None)], []):
        assert content_fingerprint(spark.createDataFrame(other, "k long, v string")) != content_fingerprint(a)


def test_other_plans_over_the_same_files_are_other_inputs(spark, tmp_out):
    from pyspark.sql import functions as F

    from haulage.plans.runlog import frame_fingerprint
    from haulage.sinks.store import Store

    store = Store(spark)
    orders = source_frames(spark, SF)["orders"]
    known = frame_fingerprint(store, orders)
    assert known == frame_fingerprint(store, source_frames(spark, SF)["orders"])
    for other in (
        orders.where("order_id > '5'"),
        orders.where("order_id > '6'"),
        orders.withColumn("order_status", F.lit("x")),
        orders.withColumn("order_status", F.lit("y")),
        orders.unionByName(spark.createDataFrame([orders.first()], orders.schema)),
    ):
        assert frame_fingerprint(store, other) != known
    some = orders.where("order_id > '5'")
    assert frame_fingerprint(store, some) != frame_fingerprint(store, orders.where("order_id > '6'"))
    # Rows of the session itself are told apart by what they hold.
    added = [orders.unionByName(spark.createDataFrame([(str(i),) + tuple(orders.first())[1:]], orders.schema)) for i in (1, 2)]
    assert frame_fingerprint(store, added[0]) != frame_fingerprint(store, added[1])

"""Staged publish: checked while written, swapped in whole, and recovered after a step that died."""

import os

import pytest
from pyspark.sql import functions as F

from haulage.operators.quality import QualityGateError
from haulage.plans.pipeline import Pipeline
from haulage.sinks import publish
from haulage.sinks.store import Store
from haulage.sources.testdata import source_frames

SF = "/root/testdata/sf0.001"
SILVER = (
    "order_id string, customer_id string, actual_delivery_days int, lat double, lng double, order_year int, order_month int"
)


def rows(spark, *values):
    return spark.createDataFrame([(f"o{i}", "c", d, 0.0, -50.0, y, m) for i, (d, y, m) in enumerate(values)], SILVER)


def read(spark, path):
    return sorted((r["actual_delivery_days"], r["order_year"], r["order_month"]) for r in spark.read.parquet(path).collect())


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs}


def test_counts_come_from_the_write(spark, tmp_out):
    path = f"{tmp_out}/silver"
    checks, seen = publish.publish_checked(
        rows(spark, (1, 2017, 1), (2, 2017, 2)), path, metrics=[F.max("actual_delivery_days").alias("most")]
    )
    assert seen == {"rows": 2, "most": 2} and all(ok for _, _, ok in checks) and len(checks) == 5
    assert read(spark, path) == [(1, 2017, 1), (2, 2017, 2)]
    assert os.listdir(f"{tmp_out}/_staging") == []


def test_failing_gate_leaves_the_old_table(spark, tmp_out):
    path = f"{tmp_out}/silver"
    publish.publish_checked(rows(spark, (1, 2017, 1)), path)
    before = files(path)
    with pytest.raises(QualityGateError) as e:
        publish.publish_checked(rows(spark, (400, 2017, 1), (-1, 2017, 3), (5, 2017, 4)), path)
    assert e.value.failed == [("delivery_days_in_range", 2)]
    assert files(path) == before and not os.path.exists(publish.staging_path(path))


class Killed(BaseException):
    pass


def kill(*args, **kwargs):
    raise Killed


def test_killed_between_write_and_publish(spark, tmp_out, monkeypatch):
    path = f"{tmp_out}/silver"
    publish.publish_checked(rows(spark, (1, 2017, 1)), path)
    before = files(path)
    with monkeypatch.context() as m:
        m.setattr(publish, "publish", kill)
        with pytest.raises(Killed):
            publish.publish_checked(rows(spark, (2, 2017, 1)), path)
    assert files(path) == before and os.path.exists(publish.staging_path(path))
    assert publish.recover(spark, path) == "discarded"
    assert files(path) == before and publish.recover(spark, path) == "clean"


@pytest.mark.parametrize("step", range(4))
def test_killed_within_the_swap_is_rolled_forward(spark, tmp_out, monkeypatch, step):
    """The swap's file operations are delete, move out, move in, delete, delete: one dies, and the table comes out new."""
    path, calls = f"{tmp_out}/silver", [0]
    publish.publish_checked(rows(spark, (1, 2017, 1)), path)

    def counting(name):
        done = getattr(Store, name)

        def call(self, *args):
            if calls[0] == step:
                raise Killed
            calls[0] += 1
            return done(self, *args)

        return call

    with monkeypatch.context() as m:
        swapped = publish.swap

        def dying(*args):
            m.setattr(Store, "delete", counting("delete"))
            m.setattr(Store, "rename", counting("rename"))
            swapped(*args)

        m.setattr(publish, "swap", dying)
        with pytest.raises(Killed):
            publish.publish_checked(rows(spark, (2, 2017, 2)), path)
    assert publish.recover(spark, path) == "rolled forward"
    assert read(spark, path) == [(2, 2017, 2)] and os.listdir(f"{tmp_out}/_staging") == []


def test_partitions_are_replaced_one_by_one(spark, tmp_out, monkeypatch):
    path = f"{tmp_out}/silver"
    publish.publish_checked(rows(spark, (1, 2017, 1), (2, 2017, 2), (3, 2018, 1)), path)
    kept = files(f"{path}/order_year=2018")
    only = ["order_year=2017/order_month=1", "order_year=2017/order_month=2"]
    with monkeypatch.context() as m:
        swap = publish.swap
        m.setattr(publish, "swap", kill)
        with pytest.raises(Killed):
            publish.publish_checked(rows(spark, (9, 2017, 1)), path, only=only)
        m.setattr(publish, "swap", swap)
        assert publish.recover(spark, path) == "rolled forward"
    assert read(spark, path) == [(3, 2018, 1), (9, 2017, 1)]
    assert files(f"{path}/order_year=2018") == kept
    publish.publish_checked(rows(spark, (4, 2019, 5)), path, whole=False)
    assert read(spark, path) == [(3, 2018, 1), (4, 2019, 5), (9, 2017, 1)]


@pytest.mark.parametrize("mode", ["strict", "compat"])
def test_silver_reads_bronze_twice_at_most(spark, tmp_out, mode, monkeypatch):
    pipe = Pipeline(spark, source_frames(spark, SF), tmp_out, mode=mode)
    pipe.run("bronze")
    reads = []
    write = type(spark.range(0).write).parquet

    def counted(self, *args, **kwargs):
        reads.append(any("/bronze/" in f for f in self._df.inputFiles()))
        return write(self, *args, **kwargs)

    monkeypatch.setattr(type(spark.range(0).write), "parquet", counted)
    pipe.run("silver")
    assert sum(reads) == 2

"""Durable run record: an append-only audit table and one manifest a step, both below ``<out>/_runs``.

A manifest says from which inputs (a fingerprint) a step was last completed
and what its outputs looked like then.  A step whose inputs and outputs still
look so has nothing to do.  The fingerprint covers the files that a frame
reads (names, lengths, change times; no data is read), its plan over them, and
the settings that change results.  A frame that reads anything but files is
fingerprinted by its content: row count and order-free sums of row hashes, in
one pass.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage.functions import content_sums
from haulage.sinks.store import Store

AUDIT_SCHEMA = (
    "run_id string, step string, status string, rows bigint, seconds double, "
    "started_at timestamp, fingerprint string, detail string"
)


def digest(*parts) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()


def content_fingerprint(df: DataFrame) -> str:
    """Digest of the rows, whatever their order: their number and two sums of 64-bit row hashes (one pass)."""
    return digest("content", sorted(df.dtypes), *df.agg(*content_sums(sorted(df.columns))).first())


def plan_text(df: DataFrame) -> str:
    """The analysed plan in full, without the numbers that a session gives its columns."""
    conf, limit = df.sparkSession.conf, "spark.sql.debug.maxToStringFields"
    before = conf.get(limit)
    conf.set(limit, "1000000")  # otherwise long lists are cut short
    try:
        plan = df._jdf.queryExecution().analyzed().treeString()
    finally:
        conf.set(limit, before)
    return re.sub(r"#\d+L?", "", plan)


def frame_fingerprint(store: Store, df: DataFrame) -> str:
    """Digest of the files that a frame reads and of what it does with them; of its content if it reads anything else."""
    files, plan = df.inputFiles(), plan_text(df)
    if not files or re.search(r"LocalRelation|LogicalRDD|ExternalRDD|InMemoryRelation|\bRange \(", plan):
        return content_fingerprint(df)
    return digest("files", df.dtypes, plan, store.listed(files))


class RunLog:
    def __init__(self, spark: SparkSession, out_dir: str, run_id: str | None = None):
        self.spark = spark
        self.store = Store(spark)
        self.base = f"{out_dir.rstrip('/')}/_runs"
        self.run_id = run_id or uuid.uuid4().hex

    @property
    def audit_path(self) -> str:
        return f"{self.base}/audit"

    def _manifest(self, step: str) -> str:
        return f"{self.base}/steps/{step}.json"

    def settings(self, rules, **more) -> str:
        from haulage import __version__

        return digest(__version__, asdict(rules), more)

    def completed(self, step: str, fingerprint: str) -> dict | None:
        """The step's manifest, if it was completed from these inputs and its outputs are as it left them."""
        last = self.store.read_json(self._manifest(step))
        if last is None or last["fingerprint"] != fingerprint:
            return None
        paths = last["outputs"]
        return last if not paths or self.store.fingerprint(*paths) == last["written"] else None

    def complete(self, step: str, fingerprint: str, outputs: list[str], rows: int | None, detail: dict) -> None:
        written = self.store.fingerprint(*outputs) if outputs else None
        done = {"fingerprint": fingerprint, "outputs": outputs, "written": written, "rows": rows, "run_id": self.run_id}
        self.store.write_json(self._manifest(step), {**done, "detail": json.loads(json.dumps(detail, default=str))})

    def record(self, step, status, rows, seconds, started, fingerprint, detail) -> None:
        """Append one row to the audit table (one small file; nothing that is there is rewritten)."""
        row = (self.run_id, step, status, rows, float(seconds), int(started * 1e6), fingerprint, json.dumps(detail, default=str))
        values = self.spark.createDataFrame([row], AUDIT_SCHEMA.replace("started_at timestamp", "started_at bigint"))
        values = values.withColumn("started_at", F.timestamp_micros("started_at"))
        values.coalesce(1).write.mode("append").parquet(self.audit_path)

    def history(self) -> DataFrame:
        """All audit rows of all runs, oldest first."""
        if not self.store.exists(self.audit_path):
            return self.spark.createDataFrame([], AUDIT_SCHEMA)
        return self.spark.read.schema(AUDIT_SCHEMA).parquet(self.audit_path).orderBy("started_at", "step")

"""Session helpers: a tuned builder for tests/bench, and checkpoint-dir lookup.

Library operators never create sessions; callers pass one in.  The builder
here only sets what the operators rely on for good plans at scale: adaptive
execution (runtime re-planning, partition coalescing, skew-join splitting).
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SCALE_CONF = {
    # Adaptive execution: re-plan joins from runtime sizes, coalesce small
    # shuffle partitions, split skewed join partitions (hot customer / zip).
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # Parquet split size: 128 MB input partitions keep tasks memory-bounded.
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(
    master: str | None = None,
    app_name: str = "haulage",
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # Spark Connect
        pass
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the shared checkpoint directory the cluster names.

    ``spark.checkpoint.dir`` is read from the session.  Only when it is unset
    under a local master (tests) is a scratch directory created and installed;
    on a cluster an unset directory is an error, because every executor would
    write to its own disk.  On a Spark Connect session the server's
    configuration applies and nothing is set.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no driver-side context
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="haulage-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local

"""Write a derived table once in the shared folder and read it back."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession

from haulage.session import ensure_checkpoint_dir

# Folders written by this process and not yet released.
_written: list[str] = []


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table under ``spark.checkpoint.dir``.

    Computed once however often it is read, without lineage (a lost executor
    costs a re-read) and with a file size that lets Spark choose how to join
    it.  Nothing passes through the driver.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Tables materialised inside the block are deleted at its end; nothing that reads them may outlive it."""
    from haulage.sinks.store import Store

    mark = len(_written)
    try:
        yield
    finally:
        store = Store(spark)
        for path in _written[mark:]:
            store.delete(path)
        del _written[mark:]

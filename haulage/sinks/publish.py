"""Staged publish: a table is written beside its place and swapped in only when it is whole and has passed its checks.

The write goes to ``<parent>/_staging/<name>``.  What the checks need is
observed by the write itself, so a checked table is computed once.  Then a
small journal file is written, which is the commit point, and the swap
follows: renames for a whole table, or delete and rename for single
partitions.  A step that dies

* before the journal leaves the published table as it was; the next publish
  (or ``recover``) discards what was staged;
* after the journal is rolled forward by ``recover``: every part of the swap
  can be repeated.

One writer a table is assumed.  Readers of a whole table may meet a moment
between two renames without it; partitions are replaced one by one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from haulage.operators.quality import check_predicates, require_passed
from haulage.functions import count_where
from haulage.rules import DEFAULT_RULES, Rules
from haulage.sinks.store import Store


def _parts(path: str) -> tuple[str, str]:
    parent, _, name = path.rstrip("/").rpartition("/")
    return parent or ".", name


def staging_path(path: str) -> str:
    parent, name = _parts(path)
    return f"{parent}/_staging/{name}"


def _journal(path: str) -> str:
    parent, name = _parts(path)
    return f"{parent}/_staging/{name}.commit"


def _retired(path: str) -> str:
    parent, name = _parts(path)
    return f"{parent}/_staging/{name}.retired"


def state_path(path: str) -> str:
    """Where a table's state (see ``haulage.plans.incremental``) is kept, published in the same commit as its rows."""
    parent, name = _parts(path)
    return f"{parent}/_state/{name}.json"


def swap(store: Store, path: str, plan: dict) -> None:
    """Carry out a journal; every part is skipped if it has been done."""
    staged = staging_path(path)
    if plan["partitions"] is None:
        if store.exists(staged):
            if store.exists(path):
                store.delete(_retired(path))
                store.rename(path, _retired(path))
            store.rename(staged, path)
        store.delete(_retired(path))
    else:
        for part in plan["removed"]:
            store.delete(f"{path}/{part}")
        for part in plan["partitions"]:
            if store.exists(f"{staged}/{part}"):
                store.delete(f"{path}/{part}")
                store.rename(f"{staged}/{part}", f"{path}/{part}")
        store.delete(staged)
    # What later writers need to know of the table; a publish that says nothing leaves nothing that is out of date.
    if plan.get("state") is not None:
        store.write_json(state_path(path), plan["state"])
    else:
        store.delete(state_path(path))
    store.delete(_journal(path))


def recover(spark: SparkSession, path: str) -> str:
    """Bring a table to a whole state after a step that died: ``rolled forward``, ``discarded`` or ``clean``."""
    store = Store(spark)
    plan = store.read_json(_journal(path))
    if plan is not None:
        swap(store, path, plan)
        return "rolled forward"
    if store.exists(staging_path(path)):
        store.delete(staging_path(path))
        return "discarded"
    return "clean"


def staged_partitions(store: Store, folder: str, depth: int) -> list[str]:
    """``a=1/b=2`` names of the partition folders below ``folder``."""
    found = [""]
    for _ in range(depth):
        found = [f"{head}/{n}".lstrip("/") for head in found for n in store.names(f"{folder}/{head}") if "=" in n]
    return found


def publish(
    spark: SparkSession, path: str, partitions: Sequence[str] | None = None, removed: Sequence[str] = (), state=None
) -> None:
    """Swap what is staged for ``path`` in: the whole table, or only ``partitions`` (and drop those ``removed``)."""
    store = Store(spark)
    plan = {"partitions": None if partitions is None else list(partitions), "removed": list(removed), "state": state}
    store.write_json(_journal(path), plan)
    swap(store, path, plan)


def publish_table(
    df: DataFrame, path: str, compression: str = "snappy", metrics: Sequence = (), state=None
) -> dict:
    """Write an unpartitioned table staged and publish it; returns the observed ``rows`` and ``metrics``."""
    spark = df.sparkSession
    recover(spark, path)
    obs = Observation("publish")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"), *metrics)
    observed.write.mode("overwrite").option("compression", compression).parquet(staging_path(path))
    publish(spark, path, state=state)
    return dict(obs.get)


def publish_checked(
    df: DataFrame,
    path: str,
    rules: Rules = DEFAULT_RULES,
    strict: bool = True,
    partition_by: Sequence[str] = ("order_year", "order_month"),
    only: Sequence[str] | None = None,
    whole: bool = True,
    metrics: Sequence = (),
    drop: Sequence[str] = (),
    compression: str = "snappy",
    state=None,
) -> tuple[list[tuple[str, int, bool]], dict]:
    """Write a partitioned table staged, judge it by the counts of that write, and publish or discard it.

    Returns the check results and the observed ``rows`` and ``metrics``;
    ``drop`` names columns that only the metrics need.  ``whole=False``
    replaces the partitions that the rows fall into and keeps all others;
    ``only`` names the partitions that are replaced, so that one without rows
    any more is dropped.  A failed check raises ``QualityGateError`` and the
    published table stays as it was.

    The counts are observed behind the exchange that clusters the partitions,
    in the tasks that write: each counts once, also when executors are lost
    and map tasks run again.
    """
    spark, keys = df.sparkSession, list(partition_by)
    recover(spark, path)
    staged = staging_path(path)
    obs = Observation("publish")
    predicates = check_predicates(rules, strict)
    counted = [count_where(p).alias(f"check_{n}") for n, p in predicates.items()]
    clustered = df.hint("rebalance", *keys).observe(obs, F.count(F.lit(1)).alias("rows"), *counted, *metrics)
    clustered.drop(*drop).write.mode("overwrite").option("compression", compression).partitionBy(*keys).parquet(staged)
    seen = dict(obs.get)
    results = [(n, int(seen.pop(f"check_{n}")), False) for n in predicates]
    results = [(n, v, v == 0) for n, v, _ in results]
    try:
        require_passed(results)
    except Exception:
        Store(spark).delete(staged)
        raise
    if whole and only is None:
        publish(spark, path, state=state)
    else:
        present = staged_partitions(Store(spark), staged, len(keys))
        publish(spark, path, present, [p for p in (only or ()) if p not in present], state)
    return results, seen

"""Co-located layers: tables bucketed by a join key, so that joining them moves no row.

Both sides of a join are written once into the same number of buckets, by the
hash that Spark's joins use; a join on that key then reads bucket against
bucket without an exchange, in every run that uses the tables.  The layout is
kept in the table's state file (published with its rows) and declared to any
later session, whatever its catalog.

One key's rows are in one bucket, and a bucket is read by one task.  If one
bucket is much larger than the others (a customer with a large share of all
orders), ``read_bucketed`` gives the table without its buckets: the join
shuffles again, and adaptive execution splits the hot key.
"""

from __future__ import annotations

import hashlib
import math
import re
import statistics

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from haulage.sinks.publish import publish, recover, staging_path, state_path
from haulage.sinks.store import Store

BUCKET_BYTES = 256 << 20
MAX_BUCKETS = 1 << 16
MAX_SKEW = 4.0  # the largest bucket against the median one
SMALL_BYTES = 64 << 20  # a bucket up to this is no burden for a task, whatever the others hold


def bucket_count(total_bytes: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    """The power of two that gives buckets of at most ``bucket_bytes`` on average.

    Tables of any two sizes then have counts of which one divides the other.
    """
    return min(MAX_BUCKETS, 1 << max(0, math.ceil(math.log2(max(1.0, total_bytes / bucket_bytes)))))


def table_name(path: str) -> str:
    return "haulage_" + hashlib.md5(path.rstrip("/").encode()).hexdigest()


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int, spread: str | None = None, splits: int = 4) -> None:
    """Write ``df`` in ``buckets`` buckets by ``key`` and publish it (staged).

    A task writes one bucket.  With ``spread``, a second column, a bucket's rows
    are dealt to ``splits`` tasks by that column's hash, so that no single task
    writes all rows of a hot key.
    """
    spark = df.sparkSession
    recover(spark, path)
    staged, name = staging_path(path), table_name(staging_path(path))
    bucket = F.pmod(F.hash(key), F.lit(buckets))
    if spread is None:
        dealt = df.repartition(buckets, key)
    else:
        dealt = df.repartition(buckets * splits, bucket, F.pmod(F.xxhash64(spread), F.lit(splits)))
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    Store(spark).delete(staged)
    writer = dealt.write.bucketBy(buckets, key).sortBy(key).option("path", staged).option("compression", "snappy")
    writer.format("parquet").mode("overwrite").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    publish(spark, path, state={"key": key, "buckets": buckets, "schema": df.schema.jsonValue()})


def bucket_sizes(spark: SparkSession, path: str, buckets: int) -> list[int]:
    """Bytes of every bucket, from the file names and lengths."""
    sizes = [0] * buckets
    for name, length in Store(spark).sizes(path):
        found = re.search(r"_(\d{5})(?:\.c\d+)?[^/]*\.parquet$", name)
        if found:
            sizes[int(found.group(1))] += length
    return sizes


def is_skewed(sizes: list[int], max_skew: float = MAX_SKEW, small: int = SMALL_BYTES) -> bool:
    return max(sizes) > small and max(sizes) > max_skew * max(1.0, statistics.median(sizes))


def read_bucketed(
    spark: SparkSession, path: str, max_skew: float = MAX_SKEW, small: int = SMALL_BYTES
) -> DataFrame:
    """The table with its buckets, or as plain files if one bucket is far larger than the others."""
    recover(spark, path)
    layout = Store(spark).read_json(state_path(path))
    if layout is None:
        raise FileNotFoundError(f"no bucketed table at {path}")
    schema = StructType.fromJson(layout["schema"])
    if is_skewed(bucket_sizes(spark, path, layout["buckets"]), max_skew, small):
        return spark.read.schema(schema).parquet(path)
    name = table_name(path)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{layout['key']}`) "
        f"SORTED BY (`{layout['key']}`) INTO {layout['buckets']} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def colocate(
    orders: DataFrame, customers: DataFrame, base: str, buckets: int, key: str = "customer_id"
) -> tuple[DataFrame, DataFrame]:
    """Both sources as tables of equal buckets below ``base``; joins on ``key`` then move neither."""
    spark = orders.sparkSession
    write_bucketed(orders, f"{base}/orders", key, buckets, spread="order_id")
    write_bucketed(customers, f"{base}/customers", key, buckets)
    return read_bucketed(spark, f"{base}/orders"), read_bucketed(spark, f"{base}/customers")

"""Rendezvous hashing of stable record keys over weighted shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulage.llm.common import text_or_empty, unit_interval, with_prefix

SHARDS = 24


def record_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The stable key of a record: its id; a record without one is keyed by its text."""
    return F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text:"), F.md5(text_or_empty(text_col))))


def rendezvous(key: Column, weights: list[float]) -> Column:
    """The shard whose exponential draw ``-ln(u) / weight`` for this key is the smallest.

    Every (key, shard) pair has its own draw, so a new shard can only win
    records for itself, and a shard of weight w gets a share of w / sum(w).
    """
    if not weights or any(w <= 0 for w in weights):
        raise ValueError("every shard needs a positive weight")
    draws = [
        F.struct(
            (-F.log(unit_interval(F.md5(F.concat_ws("/", key, F.lit(str(i)))))) / F.lit(float(w))).alias("draw"),
            F.lit(i).alias("shard"),
        )
        for i, w in enumerate(weights)
    ]
    return (F.least(*draws) if len(draws) > 1 else draws[0])["shard"]


def grown(key: Column, shard: Column, weights: list[float], extra: float = 1.0) -> Column:
    """The shard after one more shard of weight ``extra`` joins, given the present one."""

    def draw(i: Column, w: Column) -> Column:
        return -F.log(unit_interval(F.md5(F.concat_ws("/", key, i.cast("string"))))) / w

    held = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), shard + 1)
    new = len(weights)
    return F.when(draw(F.lit(new), F.lit(float(extra))) < draw(shard, held), F.lit(new)).otherwise(shard)


def assign_shards(
    docs: DataFrame, weights: list[float], id_col: str = "doc_id", text_col: str = "text", grow_by: float = 1.0
) -> DataFrame:
    """``docs`` with ``shard`` and ``grown_shard`` (the shard if one of weight ``grow_by`` were added).

    A row-by-row rule: no shuffle, no state, the same on every run and for
    every order of the rows.  Repeated ids share a shard; a null id is keyed by
    the text; columns already called ``shard`` or ``grown_shard`` are replaced.
    """
    keyed = docs.withColumn("_record", record_key(id_col, text_col))
    keyed = keyed.withColumn("shard", rendezvous(F.col("_record"), weights))
    return keyed.withColumn("grown_shard", grown(F.col("_record"), F.col("shard"), weights, grow_by)).drop("_record")


def shard_slots(
    docs: DataFrame, weights: list[float], id_col: str = "doc_id", text_col: str = "text", range_digits: int = 3
) -> DataFrame:
    """One narrow row per document with its place: ``doc_id, size, text_crc32, shard, slot, grown_shard``.

    ``size`` is the UTF-8 length of the text (null: 0) plus 8; ``slot`` counts
    a shard's records gapless from 0 in the order of the key's digest, by the
    distributed prefix sum of ``common.with_prefix``, so a shard never passes
    through one task.  Only these narrow columns are shuffled.  The checksum
    of a null text is that of no bytes, 0.
    """
    text = text_or_empty(text_col)
    narrow = assign_shards(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(text_col).alias("text"),
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        ),
        weights,
    )
    placed = narrow.withColumn("_order", F.md5(record_key())).drop("text")
    return with_prefix(
        placed, "shard", "_order", F.lit(1), "slot", range_digits, extra=("text_crc32", "size")
    ).select("doc_id", "size", "text_crc32", "shard", "slot", "grown_shard")

"""Corpus pipeline: language screen, near-duplicate removal, decontamination, source mix, shards.

Each stage gets all that its predecessor kept, and all but the last return the
columns of ``documents``.  ``run`` writes every stage's result as Parquet in the
shared folder and reads it back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage.llm import decontam, language, mixing, neardup, sharding
from haulage.llm.common import read_table, scratch_table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


# Share of a text's places that the language model must know.  Running text of a learned language has over 0.85,
# random letters of a learned alphabet below 0.57, and a script that no labelled document has 0.
MIN_KNOWN = 0.6


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the identifier can't place in a learned language are rejected.

    These are null and empty texts, texts without a letter, and letters that no
    learned language writes so (other scripts, gibberish).  Without any
    labelled document nothing can be placed, and all texts with a letter stay.
    Texts of any length are judged whole; repeated rows share their verdict;
    columns other than those of ``documents`` are dropped.
    """
    model = language.train(docs)
    judged = language.identify(docs.select(*COLUMNS), model, min_known=MIN_KNOWN)
    placed = F.col("lang_pred") != language.UNKNOWN if model.langs else F.col("has_letter")
    return judged.where(placed).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the smallest id."""
    return neardup.drop_near_duplicates(docs.select(*COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold at least half of a benchmark item in tiles are rejected."""
    return decontam.decontaminate(docs.select(*COLUMNS), read_table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source is cut at its target; a document appears once per epoch that reaches it."""
    return mixing.apply_mix(docs.select(*COLUMNS))


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with ``shard`` and ``grown_shard`` (if one more shard joined)."""
    return sharding.assign_shards(docs.select(*COLUMNS), [1.0] * sharding.SHARDS)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("sharding", shards),
]

# A language model, a MinHash search and a tiling have no SQL form; tests/llm holds the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

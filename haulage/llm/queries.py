"""The text operators as registered queries over the given tables, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage.llm import (
    ann,
    codes,
    decontam,
    extract,
    language,
    license,
    lm,
    mixing,
    neardup,
    pii,
    resample,
    sharding,
    tokens,
)
from haulage.llm.common import read_table


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    labeller = extract.train_on(pages)
    return extract.extract_text(pages.select("page_id", "url", "html"), labeller).drop("html")


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    _, groups = neardup.near_duplicates(docs, words=4)
    return groups.select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    placed = sharding.shard_slots(docs, [1.0] * sharding.SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def _id_crc(col: str = "doc_id"):
    return F.crc32(F.col(col).cast("string").cast("binary"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest are of the base spans; ``spans`` also holds what the tagger adds, ``n_added`` counts it."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_personal_data(docs, pii.train_on(docs)).drop("text")

    def joined(col: str):
        place = F.transform(F.col(col), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(place, ",")

    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{kind}')) as long) as n_{kind}") for kind in pii.KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("all").alias("spans"),
        (F.size("all") - F.size("base")).cast("long").alias("n_added"),
    )


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan_licenses(read_table(spark, sf_dir, "documents"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return lm.score_documents(docs, held_out=_id_crc() % 7 == 2)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(_id_crc() % 3 == 1, F.lit(False)))
    model = language.train(docs.where(~F.col("held_out")))
    return language.identify(docs.select("doc_id", "held_out", "text"), model).select(
        "doc_id", "held_out", "lang_pred", "score"
    )


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontam.number_rows(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    pairs = decontam.contaminated_pairs(rows, read_table(spark, sf_dir, "benchmark"))
    return pairs.join(rows.select("_rid", "doc_id"), "_rid").select(
        "doc_id", "item_id", "item_tokens", "covered", "coverage", "longest", "tiles"
    )


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read_table(spark, sf_dir, "embeddings"), is_query=F.col("id") % 20 == 0, k=20)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return mixing.mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    drawn = resample.resample(docs, read_table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(read_table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, codebooks = codes.compress(read_table(spark, sf_dir, "embeddings"))
    return codes.with_label_error(coded).select(
        "vec_id", "code", "error", "label_error", F.lit(codes.digest(codebooks)).alias("codebooks_sha256")
    )


QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_near_dedup": op2_near_dedup,
    "op3_sharding": op3_sharding,
    "op4_personal_data": op4_personal_data,
    "op5_license_scan": op5_license_scan,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_language_id": op7_language_id,
    "op8_decontamination": op8_decontamination,
    "op9_nearest": op9_nearest,
    "op10_mixing": op10_mixing,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_token_counts": op12_token_counts,
    "op13_vector_codes": op13_vector_codes,
}

ORACLES = {
    "op2_near_dedup": neardup.oracle_sql(),
    "op5_license_scan": license.oracle_sql(),
    "op10_mixing": mixing.ORACLE,
    "op11_importance_resampling": resample.oracle_sql(),
    "op13_vector_codes": codes.oracle_sql(),
}

"""Mixing sources to target weights by hash-random order, distributed prefix sums and an exact cut."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulage.llm.common import scratch_table, text_or_empty, word_count

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix"
SALTS = 64


def mix_key(id_col: str = "doc_id", text_col: str = "text", seed: str = SEED):
    """Hash-random key of a row: a digest of seed and id, then of the text, so repeated ids still have an order."""
    return F.concat(
        F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("null")))),
        F.md5(text_or_empty(text_col)),
    )


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per source (``_source``, ``_size``): its target.

    All sources share the total by weight; no target exceeds ``max_epochs``
    times its source, and what a full source leaves is shared again by weight.
    The sources with the least room per weight fill up first, so in that order
    a running sum of what the full ones took gives the share of the rest, with
    no iteration.  One row per source passes through these windows.
    """
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    ranked = sizes.withColumn("_w", F.element_at(cycle, (F.row_number().over(by_name) - 1) % len(weights) + 1))
    room = F.lit(max_epochs) * F.col("_size")
    fill = Window.orderBy((room / F.col("_w")).asc(), F.col("_source").asc_nulls_last())
    earlier = fill.rowsBetween(Window.unboundedPreceding, -1)
    later = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    share = (F.sum("_size").over(everything) - F.coalesce(F.sum(room).over(earlier), F.lit(0))).cast(
        "double"
    ) / F.sum("_w").over(later).cast("double")
    filled = ranked.withColumn("_share", share).withColumn("_full", room <= F.col("_w") * F.col("_share"))
    level = F.max(F.when(~F.col("_full"), F.col("_share"))).over(everything)
    return filled.withColumn("_level", level).select(
        "_source",
        "_size",
        F.when(F.col("_full"), room.cast("double")).otherwise(F.col("_w") * F.col("_level")).alias("_target"),
    )


def sized_rows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED
) -> DataFrame:
    """The narrow rows that mixing works on (id, source, key, words), written once; texts go no further."""
    return scratch_table(
        docs.select(
            F.col(id_col).alias("_id"),
            F.col(source_col).cast("string").alias("_source"),
            mix_key(id_col, text_col, seed).alias("_key"),
            word_count(text_or_empty(text_col)).alias("_words"),
        ),
        "mix-sized",
    )


def source_cuts(
    sized: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, range_digits: int = 3
) -> DataFrame:
    """Per source: size, target, whole epochs, and the key at which the last epoch is cut.

    The keys are uniform digests, so their first digits range-partition a
    source evenly whatever its share of the rows.  Totals per (source, range)
    are pre-aggregated; a prefix sum over them finds the range in which the
    budget ends; only the rows of that range are put in order.
    ``_cut_take`` words are taken from the row at ``_cut_key``, everything
    before it is taken whole, nothing after it.
    """
    ranged = sized.withColumn("_range", F.substring("_key", 1, range_digits))
    totals = ranged.groupBy("_source", "_range").agg(F.sum("_words").alias("_sum"))
    targets = source_targets(totals.groupBy("_source").agg(F.sum("_sum").alias("_size")), weights, max_epochs)
    budget = F.floor(F.col("_target") + F.lit(0.5)).cast("long")
    plans = (
        targets.withColumn("_budget", budget)
        .withColumn("_epochs", F.when(F.col("_size") > 0, F.expr("_budget div _size")).otherwise(F.lit(0)))
        .withColumn("_rest", F.col("_budget") - F.col("_epochs") * F.col("_size"))
        .select(F.col("_source").alias("_s"), "_size", "_target", "_epochs", "_rest")
    )
    before = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    spans = totals.withColumn("_start", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
    edges = (
        spans.join(plans, F.col("_source").eqNullSafe(F.col("_s")))
        .where((F.col("_start") < F.col("_rest")) & (F.col("_rest") <= F.col("_start") + F.col("_sum")))
        .select(F.col("_s").alias("_es"), F.col("_range").alias("_er"), (F.col("_rest") - F.col("_start")).alias("_need"))
    )
    edge_rows = ranged.join(edges, F.col("_source").eqNullSafe(F.col("_es")) & (F.col("_range") == F.col("_er")))
    by_key = edge_rows.groupBy("_source", "_key", "_need").agg(
        F.sum("_words").alias("_sum"), F.count(F.lit(1)).alias("_copies")
    )
    in_order = Window.partitionBy("_source").orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        by_key.withColumn("_start", F.coalesce(F.sum("_sum").over(in_order), F.lit(0)))
        .where((F.col("_start") < F.col("_need")) & (F.col("_need") <= F.col("_start") + F.col("_sum")))
        .select(
            F.col("_source").alias("_cs"),
            F.col("_key").alias("_cut_key"),
            F.expr("(_need - _start) div _copies").alias("_cut_take"),
        )
    )
    return plans.join(cut, F.col("_s").eqNullSafe(F.col("_cs")), "left").drop("_cs")


def join_cuts(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Rows with their source's cut.  The cut table is repeated per salt, so a hot source is spread over ``SALTS`` keys."""
    salted = cuts.withColumn("_cut_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_salt", F.pmod(F.hash("_key"), F.lit(SALTS))).join(
        salted, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_salt") == F.col("_cut_salt"))
    )


def mix_sources(
    docs: DataFrame,
    weights=WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: str = SEED,
) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, taken, copies``.

    Every row gets a hash-random key; within its source the mix reads rows in
    key order, as many whole epochs as the target holds, then up to the exact
    budget.  ``taken`` counts words with repeats; ``copies`` is the number of
    passes that reach the document.  A source's taken words add up to its
    rounded target (rows equal in id, source and text that straddle the cut
    share what is left evenly, rounded down).

    Defined cases: a null or empty text has size 0 and takes 0; a null source
    is a source of its own, last in the weight order; null and repeated ids
    are told apart by their text; an empty table gives no rows; other columns
    are ignored.
    """
    sized = sized_rows(docs, id_col, text_col, source_col, seed)
    cuts = source_cuts(sized, weights, max_epochs)
    last = (
        F.when(F.col("_cut_key").isNull(), F.lit(0))
        .when(F.col("_key") < F.col("_cut_key"), F.col("_words"))
        .when(F.col("_key") == F.col("_cut_key"), F.col("_cut_take"))
        .otherwise(F.lit(0))
    )
    return (
        join_cuts(sized, cuts)
        .withColumn("_last", last)
        .select(
            F.col("_id").alias("doc_id"),
            F.col("_source").alias("source"),
            F.col("_words").alias("size"),
            F.col("_size").alias("source_size"),
            F.col("_target").alias("target"),
            (F.col("_epochs") * F.col("_words") + F.col("_last")).cast("long").alias("taken"),
            (F.col("_epochs") + F.when(F.col("_last") > 0, 1).otherwise(0)).cast("int").alias("copies"),
        )
    )


def apply_mix(
    docs: DataFrame,
    weights=WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: str = SEED,
) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a document appears once per epoch that reaches it.

    Texts stay whole here, so the document at a source's cut is kept in full.
    A document with no words belongs to no budget and is left out.  The cut
    table (one row per source) is joined to the documents; texts are neither
    sorted nor shuffled by this step unless Spark finds the cut table large.
    """
    sized = sized_rows(docs, id_col, text_col, source_col, seed)
    cuts = scratch_table(source_cuts(sized, weights, max_epochs), "mix-cuts")
    keyed = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("_doc"),
        F.col(source_col).cast("string").alias("_source"),
        mix_key(id_col, text_col, seed).alias("_key"),
        text_or_empty(text_col).rlike(r"[^\x20\x09-\x0D]").alias("_has_words"),
    )
    reached = F.coalesce((F.col("_key") <= F.col("_cut_key")), F.lit(False)).cast("int")
    copies = (F.col("_epochs") + reached).cast("int")
    return (
        join_cuts(keyed.where("_has_words"), cuts)
        .withColumn("_copies", copies)
        .where(F.col("_copies") > 0)
        .withColumn("_pass", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .select("_doc.*")
    )


ORACLE = """
WITH d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, 'null')) || md5(coalesce(text, '')) AS k
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS wt FROM s),
f AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (
               ORDER BY 3 * source_size / wt, source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
           / (sum(wt) OVER (ORDER BY 3 * source_size / wt, source NULLS LAST
               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS share
  FROM w),
t AS (
  SELECT source, source_size,
         CASE WHEN 3 * source_size <= wt * share THEN (3 * source_size)::DOUBLE
              ELSE wt * max(share) FILTER (WHERE NOT 3 * source_size <= wt * share) OVER () END AS target
  FROM f),
b AS (
  SELECT *, floor(target + 0.5)::BIGINT AS budget,
         CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT // source_size ELSE 0 END AS epochs
  FROM t),
p AS (
  SELECT d.*, b.source_size, b.target, b.epochs, b.budget - b.epochs * b.source_size AS rest,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY k
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, rest - start)))::BIGINT AS taken
FROM p
"""

"""Mergeable summaries: quantile sketches for medians, theta sketches for key sets.

Both are binary columns made by Spark's own sketch aggregates, so a summary is
computed map-side, stored in a table, and merged later without the rows.

Quantiles.  A sketch per (state, month) is stored; any set of months is merged
into one sketch a state.  The stated rank error (``rank_error``) holds for the
merged sketch whatever the order and grouping of the merges.

Sets.  Intersection and difference are taken on the sketches themselves.
Inclusion-exclusion over distinct counts has an error of the size of the
*union*, so a small overlap drowns in it; a theta intersection counts the
common keys among a hash sample of known rate, and its interval shrinks with
the overlap.  A sketch that has not left exact mode (fewer keys than nominal
entries) gives the exact number and an interval of no width.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulage.rules import DEFAULT_RULES, Rules

QUANTILE_K = 8192
THETA_LOG_ENTRIES = 16
Z = 3.0  # standard deviations of an interval


# ---------------------------------------------------------------- quantiles
def rank_error(k: int = QUANTILE_K) -> float:
    """Normalised rank error of a sketch with parameter ``k``, for all ranks at once with 99 % confidence.

    Published fit for this sketch: 2.446 / k**0.9433.
    """
    return 2.446 / k**0.9433


def day_sketches(
    silver: DataFrame,
    rules: Rules = DEFAULT_RULES,
    by: Sequence[str] = ("customer_state", "order_year", "order_month"),
    value: str = "actual_delivery_days",
    k: int = QUANTILE_K,
) -> DataFrame:
    """Delivered orders' known days per group as ``known`` (their number) and ``sketch`` (binary)."""
    kept = silver.where((F.col("order_status") == F.lit(rules.delivered_status)) & F.col(value).isNotNull())
    days = F.col(value).cast("bigint")
    return kept.groupBy(*by).agg(F.count(F.lit(1)).alias("known"), F.kll_sketch_agg_bigint(days, F.lit(k)).alias("sketch"))


def merge_days(sketches: DataFrame, by: Sequence[str] = ("customer_state",)) -> DataFrame:
    """Sketches of finer groups merged into those of ``by``; merged ones can be merged again."""
    return sketches.groupBy(*by).agg(F.sum("known").alias("known"), F.kll_merge_agg_bigint("sketch").alias("sketch"))


def sketch_quantile(sketch: Column | str = "sketch", rank: float = 0.5) -> Column:
    """The smallest value whose share of values up to it reaches ``rank`` (the lower median for 0.5)."""
    return F.kll_sketch_get_quantile_bigint(sketch, F.lit(rank)).cast("int")


def median_by_sketch(sketches: DataFrame, group: str = "customer_state") -> DataFrame:
    """Per state, from stored month sketches: ``known_orders`` and ``median_delivery_days``."""
    merged = merge_days(sketches, (group,))
    return merged.select(group, F.col("known").alias("known_orders"), sketch_quantile().alias("median_delivery_days"))


def rank_check(
    medians: DataFrame, silver: DataFrame, rules: Rules = DEFAULT_RULES, k: int = QUANTILE_K,
    group: str = "customer_state", value: str = "actual_delivery_days",
) -> DataFrame:
    """``medians`` with ``within_bound``: whether the true ranks around each median reach one half within the rank error.

    The true ranks are counted from the rows (one more pass; for audits).
    """
    kept = silver.where((F.col("order_status") == F.lit(rules.delivered_status)) & F.col(value).isNotNull())
    days = kept.groupBy(F.col(group).alias("_g"), F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    at = F.col("median_delivery_days")
    ranks = (
        medians.join(days, F.col(group).eqNullSafe(F.col("_g")))
        .groupBy(*medians.columns)
        .agg(
            F.sum(F.when(F.col("_v") < at, F.col("_n")).otherwise(0)).alias("_below"),
            F.sum(F.when(F.col("_v") <= at, F.col("_n")).otherwise(0)).alias("_upto"),
            F.sum("_n").alias("_all"),
        )
    )
    slack = F.lit(rank_error(k)) * F.col("_all")
    half = F.col("_all") / 2
    return ranks.select(
        *medians.columns, ((F.col("_below") - slack <= half) & (F.col("_upto") + slack >= half)).alias("within_bound")
    )


# --------------------------------------------------------------------- sets
def key_sketch(df: DataFrame, key: Column, log_entries: int = THETA_LOG_ENTRIES) -> DataFrame:
    """One row with ``sketch``, a theta sketch of the distinct non-NULL keys (a few hundred KB at most)."""
    return df.agg(F.theta_sketch_agg(key, F.lit(log_entries)).alias("sketch"))


def _byte(sketch: Column, at: int) -> Column:
    return F.conv(F.hex(F.substring(sketch, at + 1, 1)), 16, 10).cast("bigint")


def _unsigned(sketch: Column, first: int, size: int, used: Column | None = None) -> Column:
    """Little-endian integer of ``size`` bytes, or of the first ``used`` of them, from byte ``first`` on (0-based)."""
    total = F.lit(0).cast("bigint")
    for i in range(size):
        value = F.shiftleft(F.coalesce(_byte(sketch, first + i), F.lit(0).cast("bigint")), 8 * i)
        total = total + (value if used is None else F.when(used > i, value).otherwise(0))
    return total


def theta_parts(sketch: Column) -> tuple[Column, Column]:
    """(keys retained, sampling rate) of a compact theta sketch.

    Fixed layout of the published binary format.  Byte 0 holds the number of
    8-byte preamble words in its low 6 bits, byte 1 the version and byte 5 the
    flags (4: empty).  Version 4 (delta-coded keys): byte 4 says how many
    bytes the key count has; it starts at byte 8, or at 16 behind the sampling
    threshold (of 2**63) if there are two words.  Version 3: one word is an
    empty sketch or a single key; otherwise the count is the 4 bytes from 8
    on, and the threshold the 8 bytes from 16 on if there are three words.
    """
    words, version = _byte(sketch, 0).bitwiseAND(F.lit(63)), _byte(sketch, 1)
    empty = _byte(sketch, 5).bitwiseAND(F.lit(4)) != 0
    coded, size = version == 4, _byte(sketch, 4)
    kept = (
        F.when(coded & (words > 1), _unsigned(sketch, 16, 4, size))
        .when(coded, _unsigned(sketch, 8, 4, size))
        .when(words > 1, _unsigned(sketch, 8, 4))
        .when(empty, F.lit(0))
        .otherwise(F.lit(1))
    )
    limit = F.when(coded & (words > 1), _unsigned(sketch, 8, 8)).when(~coded & (words > 2), _unsigned(sketch, 16, 8))
    return kept.cast("bigint"), F.coalesce(limit / F.lit(2.0**63), F.lit(1.0))


def theta_interval(sketch: Column, z: float = Z) -> tuple[Column, Column, Column]:
    """(estimate, low, high) of a theta sketch's number of keys.

    Of n keys each was retained with the sampling rate; the interval inverts
    the score test for a Poisson count, which also holds for few or no
    retained keys.  At rate 1 all three are the exact number.
    """
    kept, rate = theta_parts(sketch)
    centre = kept + F.lit(z * z / 2)
    spread = F.lit(z) * F.sqrt(kept + F.lit(z * z / 4))
    exact = rate >= 1.0

    def whole(c: Column, r) -> Column:
        return F.when(exact, kept).otherwise(r(c / rate).cast("bigint"))

    return whole(kept, F.round), whole(centre - spread, F.floor), whole(centre + spread, F.ceil)


def sketched_overlap(left: DataFrame, right: DataFrame, z: float = Z) -> DataFrame:
    """Key overlap of two one-row ``key_sketch`` frames (or merged ones), one row.

    Numbers of keys of each side, common keys and left-only keys, the last two
    with their intervals.  Counts never contradict each other: an estimate is
    held within what the sides allow.
    """
    both = left.select(F.col("sketch").alias("_l")).crossJoin(right.select(F.col("sketch").alias("_r")))  # 1 x 1 row
    n_left, _, _ = theta_interval(F.col("_l"), z)
    n_right, _, _ = theta_interval(F.col("_r"), z)
    sets = both.select(
        n_left.alias("left_unique_keys"),
        n_right.alias("right_unique_keys"),
        F.theta_intersection("_l", "_r").alias("_both"),
        F.theta_difference("_l", "_r").alias("_only"),
    )
    common, common_low, common_high = theta_interval(F.col("_both"), z)
    only, only_low, only_high = theta_interval(F.col("_only"), z)
    return sets.select(
        "left_unique_keys",
        "right_unique_keys",
        F.least(common, F.col("left_unique_keys"), F.col("right_unique_keys")).alias("matching_keys"),
        common_low.alias("matching_low"),
        common_high.alias("matching_high"),
        F.least(only, F.col("left_unique_keys")).alias("left_keys_no_match"),
        only_low.alias("no_match_low"),
        only_high.alias("no_match_high"),
    )

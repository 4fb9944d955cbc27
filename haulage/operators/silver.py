"""Silver layer: typed timestamps, geo imputation and repair, derived measures.

Two modes where the original pipeline's results are questionable:

``strict`` (default)
    A coordinate pair is *bad* when a known value lies outside the bounds.
    One clean per-state mean is computed over rows whose pair is complete and
    in bounds.  A bad pair is replaced as a pair; otherwise each missing
    coordinate is filled from the mean.  ``geo_imputed`` marks rows whose
    original lat was missing and got a mean; ``geo_repaired`` marks bad pairs.

``compat``
    The original order: fill NULLs from the mean over all rows (outliers
    included), flag ``geo_imputed`` as "lat equals the state mean" after the
    fill, then replace out-of-bounds lat and afterwards re-test lng against
    the *new* lat, using a mean over in-bounds rows of the filled data.

Per-state means are grouped aggregates (partial aggregation, so a state
holding a third of all orders is folded map-side), never a
``Window.partitionBy(state)`` that would put a whole state into one task.  The
operators take them as an argument: a caller that has them as a table
(``state_means`` over ``coordinate_counts``, written once) gets a plan that
reads the orders once and starts no job.  Without it they are planned lazily
from the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulage.functions import bucketize, count_where, in_bounds, out_of_bounds, parse_timestamp
from haulage.rules import DEFAULT_RULES, Rules
from haulage.schemas import TIMESTAMP_COLUMNS


def _formats(rules: Rules, mode: str) -> tuple:
    return rules.timestamp_formats + (rules.lenient_timestamp_formats if mode == "compat" else ())


def fix_timestamps(
    df: DataFrame,
    columns: Sequence[str] = TIMESTAMP_COLUMNS,
    rules: Rules = DEFAULT_RULES,
    mode: str = "strict",
) -> DataFrame:
    """Text -> timestamp for each column; unparseable text becomes NULL.

    ``compat`` also reads what the original's lenient parser reads: blanks
    around the text, single digits and fractions of a second (cut off).
    """
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: parse_timestamp(c, _formats(rules, mode), lenient=mode == "compat") for c in present})


def parse_failures(columns: Sequence[str], rules: Rules = DEFAULT_RULES, mode: str = "strict") -> dict:
    """Per column: whether a value is present as text but can't be parsed (over the raw rows)."""
    parsed = {c: parse_timestamp(c, _formats(rules, mode), lenient=mode == "compat") for c in columns}
    return {c: F.col(c).isNotNull() & parsed[c].isNull() for c in columns}


def parse_failure_counts(columns: Sequence[str], rules: Rules = DEFAULT_RULES, mode: str = "strict") -> list:
    """One aggregate per column, for ``agg`` or ``observe`` over the raw rows."""
    return [count_where(failed).alias(c) for c, failed in parse_failures(columns, rules, mode).items()]


def timestamp_parse_failures(
    raw: DataFrame,
    columns: Sequence[str] = TIMESTAMP_COLUMNS,
    rules: Rules = DEFAULT_RULES,
    mode: str = "strict",
) -> DataFrame:
    """Per column: values that were present as text but failed to parse."""
    present = [c for c in columns if c in raw.columns]
    agg = raw.agg(*parse_failure_counts(present, rules, mode))
    return agg.unpivot([], present, "column_name", "parse_failures")


ROWS = "_rows"  # of a counted table: the number of rows that a row stands for


def coordinate_counts(
    df: DataFrame, group: str = "customer_state", lat: str = "lat", lng: str = "lng"
) -> DataFrame:
    """``df`` counted by state and coordinate pair: all that the state means of any mode look at.

    Coordinates come from the consolidated geolocation, so there are at most
    as many pairs as it has rows, however many orders there are.  A table that
    is already counted is folded further.
    """
    rows = F.sum(ROWS) if ROWS in df.columns else F.count(F.lit(1))
    return df.groupBy(group, lat, lng).agg(rows.alias(ROWS))


def state_means(
    df: DataFrame,
    rules: Rules = DEFAULT_RULES,
    group: str = "customer_state",
    in_bounds_only: bool = True,
    lat: str = "lat",
    lng: str = "lng",
) -> DataFrame:
    """Mean coordinates per state, over the rows with a complete pair in bounds or over all rows.

    ``df`` holds rows or counted rows (``coordinate_counts``).
    """
    kept = df.filter(in_bounds(lat, lng, rules)) if in_bounds_only else df

    def mean(c: str):
        if ROWS not in df.columns:
            return F.avg(c)
        return F.try_divide(F.sum(F.col(c) * F.col(ROWS)), F.sum(F.when(F.col(c).isNotNull(), F.col(ROWS))))

    return (
        kept
        .groupBy(group)
        .agg(mean(lat).alias("_m_lat"), mean(lng).alias("_m_lng"))
        .filter(F.col(group).isNotNull())
    )


def _with_means(df, means, rules, group, in_bounds_only, lat, lng) -> DataFrame:
    if means is None:
        means = state_means(df, rules, group, in_bounds_only, lat, lng)
    return df.join(means, on=group, how="left")


def impute_geo(
    df: DataFrame,
    rules: Rules = DEFAULT_RULES,
    group: str = "customer_state",
    mode: str = "strict",
    lat: str = "lat",
    lng: str = "lng",
    means: DataFrame | None = None,
) -> DataFrame:
    """Fill missing coordinates with the per-state mean; add ``geo_imputed``."""
    la, ln = F.col(lat), F.col(lng)
    if mode == "strict":
        j = _with_means(df, means, rules, group, True, lat, lng)
        return j.withColumns(
            {
                "geo_imputed": F.coalesce(la.isNull() & F.col("_m_lat").isNotNull(), F.lit(False)),
                lat: F.coalesce(la, F.col("_m_lat")),
                lng: F.coalesce(ln, F.col("_m_lng")),
            }
        ).drop("_m_lat", "_m_lng")
    if mode == "compat":
        j = _with_means(df, means, rules, group, False, lat, lng)
        filled = j.withColumns(
            {lat: F.coalesce(la, F.col("_m_lat")), lng: F.coalesce(ln, F.col("_m_lng"))}
        )
        flag = F.when(F.col("_m_lat").isNotNull() & (F.col(lat) == F.col("_m_lat")), True).otherwise(False)
        return filled.withColumn("geo_imputed", flag).drop("_m_lat", "_m_lng")
    raise ValueError(f"unknown mode {mode!r}")


def fix_geo_outliers(
    df: DataFrame,
    rules: Rules = DEFAULT_RULES,
    group: str = "customer_state",
    mode: str = "strict",
    lat: str = "lat",
    lng: str = "lng",
    means: DataFrame | None = None,
) -> DataFrame:
    """Replace out-of-bounds coordinates with the clean per-state mean."""
    j = _with_means(df, means, rules, group, True, lat, lng)
    if mode == "strict":
        bad = F.coalesce(out_of_bounds(lat, lng, rules), F.lit(False))
        return (
            j.withColumn("geo_repaired", bad)
            .withColumns(
                {
                    lat: F.when(F.col("geo_repaired"), F.col("_m_lat")).otherwise(F.col(lat)),
                    lng: F.when(F.col("geo_repaired"), F.col("_m_lng")).otherwise(F.col(lng)),
                }
            )
            .drop("_m_lat", "_m_lng")
        )
    if mode == "compat":
        # Sequential, as originally written: lat first, then lng is re-tested
        # with the already replaced lat.
        j = j.withColumn(
            lat, F.when(out_of_bounds(lat, lng, rules), F.col("_m_lat")).otherwise(F.col(lat))
        )
        j = j.withColumn(
            lng, F.when(out_of_bounds(lat, lng, rules), F.col("_m_lng")).otherwise(F.col(lng))
        )
        return j.drop("_m_lat", "_m_lng")
    raise ValueError(f"unknown mode {mode!r}")


def clean_geo(
    df: DataFrame,
    rules: Rules = DEFAULT_RULES,
    group: str = "customer_state",
    lat: str = "lat",
    lng: str = "lng",
    means: DataFrame | None = None,
) -> DataFrame:
    """Strict imputation and repair together, from one clean mean per state."""
    la, ln = F.col(lat), F.col(lng)
    j = _with_means(df, means, rules, group, True, lat, lng)
    bad = F.coalesce(out_of_bounds(lat, lng, rules), F.lit(False))
    return (
        j.withColumns(
            {
                "geo_imputed": F.coalesce(la.isNull() & F.col("_m_lat").isNotNull(), F.lit(False)),
                "geo_repaired": bad,
            }
        )
        .withColumns(
            {
                lat: F.when(F.col("geo_repaired"), F.col("_m_lat")).otherwise(F.coalesce(la, F.col("_m_lat"))),
                lng: F.when(F.col("geo_repaired"), F.col("_m_lng")).otherwise(F.coalesce(ln, F.col("_m_lng"))),
            }
        )
        .drop("_m_lat", "_m_lng")
    )


def geo_outliers(
    df: DataFrame,
    rules: Rules = DEFAULT_RULES,
    columns: Sequence[str] = ("order_id", "customer_state", "lat", "lng", "city"),
) -> DataFrame:
    """Rows whose known coordinates fall outside the bounds (drill-down)."""
    return df.filter(F.coalesce(out_of_bounds("lat", "lng", rules), F.lit(False))).select(*columns)


def null_reason(df: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Why the delivered date is missing: DATA_QUALITY_ISSUE / NOT_YET_DELIVERED."""
    missing = F.col("order_delivered_customer_date").isNull()
    reason = (
        F.when(missing & (F.col("order_status") == F.lit(rules.delivered_status)), F.lit(rules.null_reason_data_quality))
        .when(missing, F.lit(rules.null_reason_not_delivered))
        .otherwise(F.lit(None).cast("string"))
    )
    return df.withColumn("delivery_null_reason", reason)


def speed_category(days_col: str = "actual_delivery_days", rules: Rules = DEFAULT_RULES):
    return bucketize(days_col, rules.speed_steps, rules.speed_over, null_label=rules.speed_unknown)


def derive(df: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Calendar-day measures, partition keys and the speed bucket."""
    delivered = F.col("order_delivered_customer_date")
    purchased = F.col("order_purchase_timestamp")
    df = df.withColumns(
        {
            "actual_delivery_days": F.datediff(delivered, purchased),
            "delay_days": F.datediff(delivered, F.col("order_estimated_delivery_date")),
            "order_year": F.year(purchased),
            "order_month": F.month(purchased),
        }
    )
    return df.withColumn("delivery_speed_category", speed_category("actual_delivery_days", rules))


def repair_means(
    bronze: DataFrame, fill_means: DataFrame, rules: Rules = DEFAULT_RULES, group: str = "customer_state"
) -> DataFrame:
    """The compat repair's means: in-bounds rows (or counted rows) after the fill from ``fill_means``."""
    return state_means(impute_geo(bronze, rules, group, mode="compat", means=fill_means), rules, group)


def build_silver(
    bronze: DataFrame,
    rules: Rules = DEFAULT_RULES,
    mode: str = "strict",
    means: DataFrame | None = None,
    repair: DataFrame | None = None,
) -> DataFrame:
    """Bronze -> silver (not yet gated; see ``haulage.operators.quality``).

    ``means`` (and ``repair`` in compat mode) are the per-state means as
    tables; see the module's notes.
    """
    typed = fix_timestamps(bronze, rules=rules, mode=mode)
    if mode == "strict":
        cleaned = null_reason(clean_geo(typed, rules, means=means), rules)
    elif mode == "compat":
        filled = null_reason(impute_geo(typed, rules, mode="compat", means=means), rules)
        cleaned = fix_geo_outliers(filled, rules, mode="compat", means=repair)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return derive(cleaned, rules)


UNPARSED = "_unparsed"  # purchase text that is present but can't be parsed, carried beside the typed columns


def with_unparsed(bronze: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Raw rows that keep, through ``build_silver``, whether their purchase text could be parsed."""
    return bronze.withColumn(UNPARSED, parse_failures(["order_purchase_timestamp"], rules)["order_purchase_timestamp"])


def _row_weight(df: DataFrame):
    return F.col(ROWS) if ROWS in df.columns else F.lit(1)


def _weighed(df: DataFrame, predicate=None):
    """The rows that ``df`` stands for, or those of them that the predicate holds for."""
    rows = _row_weight(df)
    return F.coalesce(F.sum(rows if predicate is None else F.when(predicate, rows)), F.lit(0)).cast("bigint")


def cleaning_report(
    bronze: DataFrame, silver: DataFrame, rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """Null and outlier accounting across cleaning (one row).

    ``bronze`` is the raw enriched table, or its ``coordinate_counts``: the
    report then evaluates the wide rows once, for ``silver``, which must have
    been built ``with_unparsed``.  The two aggregates are stacked, not joined.
    """
    bad = F.coalesce(out_of_bounds("lat", "lng", rules), F.lit(False))
    before_cols = [
        _weighed(bronze).alias("rows_before"),
        _weighed(bronze, F.col("lat").isNull()).alias("geo_null_before"),
        _weighed(bronze, bad).alias("geo_outliers_before"),
    ]
    counted = ROWS in bronze.columns
    if not counted:
        before_cols += [
            c.alias("purchase_parse_failures") for c in parse_failure_counts(["order_purchase_timestamp"], rules)
        ]
    after_cols = [
        F.count(F.lit(1)).alias("rows_after"),
        count_where(F.col("lat").isNull()).alias("geo_null_after"),
        count_where(bad).alias("geo_outliers_after"),
        count_where(F.col("order_approved_at").isNull()).alias("approved_null_kept"),
    ]
    if counted:
        after_cols.insert(0, count_where(F.col(UNPARSED)).alias("purchase_parse_failures"))
    if "geo_imputed" in silver.columns:
        after_cols.append(count_where(F.col("geo_imputed")).alias("geo_imputed_rows"))
    stacked = bronze.agg(*before_cols).unionByName(silver.agg(*after_cols), allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def row_preservation(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows before vs after a row-preserving step (one row); either side may be counted rows."""
    b = before.agg(_weighed(before).alias("rows_before"))
    a = after.agg(_weighed(after).alias("rows_after"))
    s = b.unionByName(a, allowMissingColumns=True).agg(
        F.max("rows_before").alias("rows_before"), F.max("rows_after").alias("rows_after")
    )
    return s.withColumn("preserved", F.col("rows_before") == F.col("rows_after"))

"""Gold layer: KPI tables over silver.

All KPIs are computed from one count of silver by the columns they look at
(``order_cube``), so silver is read once for all of them.
``delivery_by_state`` works on a histogram keyed by (state, delivery days).  That intermediate has at most
states x distinct-day-values rows, however many orders there are, so the
exact median (the lower median, which is what an approximate-percentile sketch
returns on small groups and what ``quantile_disc`` returns) comes from a
cumulative count over that histogram: no group of orders is ever collected
into one task, and a state holding a third of all orders costs nothing extra.
The ranking window runs after aggregation (one row per state).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulage.functions import bucketize, pct
from haulage.rules import DEFAULT_RULES, Rules

DAYS = "actual_delivery_days"
DELAY = "delay_days"


def _delivered(silver: DataFrame, rules: Rules) -> DataFrame:
    return silver.filter(F.col("order_status") == F.lit(rules.delivered_status))


CUBE_KEYS = ("customer_state", "order_status", "order_year", "order_month", DAYS, DELAY, "delivery_speed_category")


def order_cube(silver: DataFrame) -> DataFrame:
    """Silver counted by all that the KPIs look at: ``CUBE_KEYS``, ``_rows`` and ``_orders`` (non-NULL order ids).

    Every KPI below takes silver or this cube.  One pass over silver (partial
    aggregation, few columns) then serves all of them.
    """
    return silver.groupBy(*CUBE_KEYS).agg(F.count(F.lit(1)).alias("_rows"), F.count("order_id").alias("_orders"))


def _cube(silver: DataFrame) -> DataFrame:
    return silver if "_rows" in silver.columns else order_cube(silver)


def _rows_where(condition):
    return F.coalesce(F.sum(F.when(condition, F.col("_rows"))), F.lit(0))


def _orders():
    return F.coalesce(F.sum("_orders"), F.lit(0))


def _mean(col: str):
    known = F.sum(F.when(F.col(col).isNotNull(), F.col("_rows")))
    return F.try_divide(F.sum(F.col(col) * F.col("_rows")), known)


def delivery_by_state(
    silver: DataFrame,
    rules: Rules = DEFAULT_RULES,
    group: str = "customer_state",
    median: str = "exact",
) -> DataFrame:
    """KPI 1 (delivered orders only), one row per state, ranked slowest first.

    ``median="approx"`` takes ``percentile_approx`` over the silver rows
    instead of the exact lower median over the histogram; all other measures
    are the same.
    """
    if median not in ("exact", "approx"):
        raise ValueError(f"unknown median {median!r}")
    if median == "approx" and "_rows" in silver.columns:
        raise ValueError("the approximate median needs silver rows, not their counts")
    hist = _delivered(_cube(silver), rules).groupBy(group, DAYS).agg(
        F.sum("_orders").alias("_orders"),
        F.sum("_rows").alias("_rows"),
        F.sum(F.col(DELAY) * F.col("_rows")).alias("_s_delay"),
        F.sum(F.when(F.col(DELAY).isNotNull(), F.col("_rows")).otherwise(0)).alias("_c_delay"),
        _rows_where(F.col(DELAY) > 0).alias("_late"),
    )
    known = F.when(F.col(DAYS).isNotNull(), F.col("_rows")).otherwise(F.lit(0))
    by_state = Window.partitionBy(group)
    running = by_state.orderBy(F.col(DAYS).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hist = hist.withColumns(
        {"_known": known, "_cum": F.sum(known).over(running), "_tot": F.sum(known).over(by_state)}
    )
    at_median = F.col(DAYS).isNotNull() & (F.col("_cum") * 2 >= F.col("_tot"))
    kpi = hist.groupBy(group).agg(
        F.sum("_orders").alias("total_orders"),
        F.round(F.try_divide(F.sum(F.col(DAYS) * F.col("_known")), F.sum("_known")), 1).alias("avg_delivery_days"),
        F.round(F.try_divide(F.sum("_s_delay"), F.sum("_c_delay")), 1).alias("avg_delay_days"),
        F.sum("_late").alias("late_orders"),
        pct(F.sum("_late"), F.sum("_orders")).alias("late_rate_pct"),
        F.min(F.when(at_median, F.col(DAYS))).alias("median_delivery_days"),
    )
    if median == "approx":
        approx = _delivered(silver, rules).groupBy(F.col(group).alias("_group")).agg(
            F.percentile_approx(DAYS, 0.5).cast("int").alias("_median")
        )
        kpi = (
            kpi.join(approx, F.col(group).eqNullSafe(F.col("_group")))
            .withColumn("median_delivery_days", F.col("_median"))
            .drop("_group", "_median")
        )
    rank = F.rank().over(Window.orderBy(F.col("avg_delivery_days").desc_nulls_last()))
    return kpi.withColumn("rank_slowest", rank)


def top_states(by_state: DataFrame, n: int = 5, slowest: bool = True, group: str = "customer_state") -> DataFrame:
    """Top-n slowest (or fastest) states; NULL means never rank first; ties by name."""
    avg = F.col("avg_delivery_days")
    order = avg.desc_nulls_last() if slowest else avg.asc_nulls_last()
    return by_state.orderBy(order, F.col(group).asc_nulls_last()).limit(n)


# Sort orders of the KPI tables (used for ordered presentation and CSV exports).
STATE_ORDER = ("rank_slowest", "customer_state")
TREND_ORDER = ("order_year", "order_month")
SEVERITY_ORDER = ("avg_delay_days", "delay_severity")


def monthly_trend(silver: DataFrame, rules: Rules = DEFAULT_RULES, ordered: bool = False) -> DataFrame:
    """KPI 2: per (year, month), all statuses; chronological when ``ordered``.

    Unordered by default: consumers that aggregate it further (peak month,
    summary) then pay no range-partitioning exchange for a sort they discard.
    """
    speed = F.col("delivery_speed_category")
    kpi = _cube(silver).groupBy("order_year", "order_month").agg(
        _orders().alias("total_orders"),
        F.round(_mean(DAYS), 1).alias("avg_delivery_days"),
        pct(_rows_where(F.col(DELAY) > 0), _orders()).alias("late_rate_pct"),
        _rows_where(speed == F.lit(rules.speed_steps[0][0])).alias("fast_orders"),
        _rows_where(speed == F.lit(rules.speed_over)).alias("very_slow_orders"),
    )
    return kpi.orderBy(*TREND_ORDER) if ordered else kpi


def monthly_trend_recent(trend: DataFrame, min_year: int) -> DataFrame:
    """Trend rows from ``min_year`` on, chronological."""
    return trend.filter(F.col("order_year") >= F.lit(min_year)).orderBy("order_year", "order_month")


def late_orders(silver: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Delivered orders that arrived after the estimate, with a severity bucket."""
    late = _delivered(silver, rules).filter(F.col(DELAY) > 0)
    return late.withColumn("delay_severity", bucketize(DELAY, rules.severity_steps, rules.severity_over))


def late_severity(silver: DataFrame, rules: Rules = DEFAULT_RULES, ordered: bool = False) -> DataFrame:
    """KPI 3: late orders per severity; ordered by mean delay when ``ordered``."""
    kpi = late_orders(_cube(silver), rules).groupBy("delay_severity").agg(
        _orders().alias("num_orders"),
        F.round(_mean(DELAY), 1).alias("avg_delay_days"),
        F.max(DELAY).alias("max_delay_days"),
    )
    return kpi.orderBy(*SEVERITY_ORDER) if ordered else kpi


def late_by_state_severity(
    silver: DataFrame, rules: Rules = DEFAULT_RULES, group: str = "customer_state", ordered: bool = False
) -> DataFrame:
    """Late orders per (state, severity); largest first when ``ordered``."""
    kpi = late_orders(_cube(silver), rules).groupBy(group, "delay_severity").agg(_orders().alias("late_orders"))
    return kpi.orderBy(F.col("late_orders").desc(), group, "delay_severity") if ordered else kpi


def top_late_state_severity(by_state_severity: DataFrame, n: int = 10, group: str = "customer_state") -> DataFrame:
    return by_state_severity.orderBy(
        F.col("late_orders").desc(), F.col(group).asc_nulls_last(), "delay_severity"
    ).limit(n)


def summary_totals(silver: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Silver-wide totals of the executive summary (one row, one pass)."""
    total = F.coalesce(F.sum("_rows"), F.lit(0))
    delivered = _rows_where(F.col("order_status") == F.lit(rules.delivered_status))
    late = _rows_where(F.col(DELAY) > 0)
    fast = _rows_where(F.col("delivery_speed_category") == F.lit(rules.speed_steps[0][0]))
    return _cube(silver).agg(
        total.alias("total_orders"),
        delivered.alias("delivered_orders"),
        pct(delivered, total).alias("delivered_pct"),
        F.round(_mean(DAYS), 1).alias("avg_delivery_days"),
        _mean(DAYS).alias("mean_delivery_days"),
        late.alias("late_orders"),
        pct(late, total).alias("late_pct"),
        fast.alias("fast_orders"),
        pct(fast, total).alias("fast_pct"),
    )


def summary_extremes(by_state: DataFrame, group: str = "customer_state") -> DataFrame:
    """Slowest and fastest state by mean days (NULL means never win; ties by name)."""
    avg = F.col("avg_delivery_days")
    known = F.col(group).isNotNull() & avg.isNotNull()
    return by_state.agg(
        F.min_by(F.col(group), F.when(known, F.struct((-avg).alias("a"), F.col(group).alias("s")))).alias(
            "slowest_state"
        ),
        F.min_by(F.col(group), F.when(known, F.struct(avg.alias("a"), F.col(group).alias("s")))).alias(
            "fastest_state"
        ),
    )


def summary_peak(trend: DataFrame) -> DataFrame:
    """Month with the most orders; ties go to the earliest month (one row)."""
    peak_key = F.when(
        F.col("total_orders").isNotNull(),
        F.struct((-F.col("total_orders")).alias("t"), F.col("order_year"), F.col("order_month")),
    )
    return trend.agg(
        F.min_by("order_year", peak_key).alias("peak_year"),
        F.min_by("order_month", peak_key).alias("peak_month"),
        F.min_by("total_orders", peak_key).alias("peak_month_orders"),
    )


def combine_summary(*parts: DataFrame) -> DataFrame:
    """Stack one-row parts and fold them into one row (``max`` per column)."""
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def executive_summary(
    silver: DataFrame,
    by_state: DataFrame,
    trend: DataFrame,
    rules: Rules = DEFAULT_RULES,
    group: str = "customer_state",
) -> DataFrame:
    """KPI 4, typed: one row.

    Three one-row aggregates (silver totals, state extremes, peak month) are
    stacked and folded with ``max`` rather than joined.  "Late" counts any
    status here, as in the original summary.
    """
    return combine_summary(summary_totals(silver, rules), summary_extremes(by_state, group), summary_peak(trend))


SUMMARY_METRICS = (
    "total_orders",
    "delivered_orders",
    "delivered_pct",
    "avg_delivery_days",
    "late_orders",
    "late_pct",
    "fast_orders",
    "slowest_state",
    "fastest_state",
    "peak_month",
)


def format_summary(summary: DataFrame) -> DataFrame:
    """Typed summary -> (metric, value) text rows, ten of them.

    Percentages are recomputed from the counts and the mean is taken
    unrounded, then formatted to one decimal with ``format_number`` (half-even
    on the binary value, as a Python ``.1f`` format does), so a ratio such as
    12.25 % reads 12.2 % exactly as in the original text summary.
    """
    from haulage.functions import month_label, thousands

    c = F.col

    def pct_text(n):
        return F.concat(F.format_number(F.try_divide(c(n), c("total_orders")) * F.lit(100), 1), F.lit("%"))

    texts = summary.select(
        thousands(c("total_orders")).alias("total_orders"),
        thousands(c("delivered_orders")).alias("delivered_orders"),
        pct_text("delivered_orders").alias("delivered_pct"),
        F.concat(F.format_number(c("mean_delivery_days"), 1), F.lit(" days")).alias("avg_delivery_days"),
        thousands(c("late_orders")).alias("late_orders"),
        pct_text("late_orders").alias("late_pct"),
        F.concat(thousands(c("fast_orders")), F.lit(" ("), pct_text("fast_orders"), F.lit(")")).alias("fast_orders"),
        c("slowest_state").alias("slowest_state"),
        c("fastest_state").alias("fastest_state"),
        F.concat(
            month_label(c("peak_year"), c("peak_month")),
            F.lit(" ("),
            thousands(c("peak_month_orders")),
            F.lit(" orders)"),
        ).alias("peak_month"),
    )
    return texts.unpivot([], list(SUMMARY_METRICS), "metric", "value")


def build_gold(silver: DataFrame, rules: Rules = DEFAULT_RULES) -> dict[str, DataFrame]:
    """The three KPI tables over silver or its ``order_cube``."""
    by_state = delivery_by_state(silver, rules)
    trend = monthly_trend(silver, rules)
    severity = late_severity(silver, rules)
    return {
        "kpi_delivery_by_state": by_state,
        "kpi_monthly_trend": trend,
        "kpi_late_orders": severity,
    }

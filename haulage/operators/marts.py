"""Report-feeding datasets derived from silver and the gold KPI tables.

These are the tables a dashboard or chart reads: bounded by the number of
states, months or buckets, so the global windows used here (share of total,
mean over states, peak flag) run on a handful of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulage.functions import bucketize_desc, count_where, month_label, pct
from haulage.rules import DEFAULT_RULES, Rules

GROUP = "customer_state"


def speed_distribution(silver: DataFrame) -> DataFrame:
    """Orders per speed bucket with share of all orders, largest first."""
    counts = silver.groupBy("delivery_speed_category").agg(F.count(F.lit(1)).alias("orders"))
    share = pct(F.col("orders"), F.sum("orders").over(Window.partitionBy()))
    return counts.withColumn("share_pct", share).orderBy(F.col("orders").desc(), "delivery_speed_category")


def silver_stats(silver: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Headline numbers of the cleaned table (one row)."""
    total = F.count(F.lit(1))
    delivered = count_where(F.col("order_status") == F.lit(rules.delivered_status))
    late = count_where(F.col("delay_days") > 0)
    return silver.agg(
        total.alias("total_orders"),
        delivered.alias("delivered_orders"),
        pct(delivered, total).alias("delivered_pct"),
        F.round(F.avg("actual_delivery_days"), 1).alias("avg_delivery_days"),
        late.alias("late_orders"),
        pct(late, total).alias("late_pct"),
    )


def trend_chart_data(trend: DataFrame, years: Sequence[int], min_orders: int = 100) -> DataFrame:
    """Months of the chosen years with more than ``min_orders`` orders, labelled."""
    rows = trend.filter(F.col("order_year").isin(list(years)) & (F.col("total_orders") > F.lit(min_orders)))
    peak = F.col("total_orders") == F.max("total_orders").over(Window.partitionBy())
    return (
        rows.withColumns(
            {"month_label": month_label("order_year", "order_month"), "is_peak": peak}
        )
        .select("month_label", "order_year", "order_month", "total_orders", "late_rate_pct", "is_peak")
        .orderBy("order_year", "order_month")
    )


def late_rate_ranked(by_state: DataFrame, min_orders: int = 100, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """States with at least ``min_orders`` orders, by late rate ascending, banded."""
    rows = by_state.filter(F.col("total_orders") >= F.lit(min_orders))
    return (
        rows.select(
            GROUP,
            "total_orders",
            "late_rate_pct",
            bucketize_desc("late_rate_pct", rules.late_rate_bands, rules.late_rate_band_else).alias("late_rate_band"),
            F.round(F.avg("late_rate_pct").over(Window.partitionBy()), 1).alias("mean_late_rate_pct"),
        )
        .orderBy("late_rate_pct", GROUP)
    )


def state_list(by_state: DataFrame) -> DataFrame:
    """Sorted distinct states (filter options)."""
    return by_state.select(GROUP).where(F.col(GROUP).isNotNull()).distinct().orderBy(GROUP)


def default_state_selection(by_state: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` states by name, the default selection of a state filter."""
    return state_list(by_state).limit(n)


def state_scorecard(by_state: DataFrame, states: Sequence[str] | DataFrame | None = None) -> DataFrame:
    """Selected states' display columns, slowest first.

    ``states`` may be a list (small, user-chosen) or a one-column DataFrame
    (semi-joined, e.g. ``default_state_selection``); with ``None`` or an empty
    list nothing is selected and all states are shown.
    """
    if isinstance(states, DataFrame):
        rows = by_state.join(states.select(GROUP), on=GROUP, how="left_semi")
    elif not states:
        rows = by_state
    else:
        rows = by_state.filter(F.col(GROUP).isin(list(states)))
    return rows.select(
        F.col(GROUP).alias("state"),
        F.col("total_orders").alias("orders"),
        F.col("avg_delivery_days").alias("avg_days"),
        F.col("late_rate_pct").alias("late_pct"),
        F.col("median_delivery_days").alias("median_days"),
    ).orderBy(F.col("avg_days").desc_nulls_last(), "state")


def late_summary(severity: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Total late orders, CRITICAL count and CRITICAL max delay (one row)."""
    critical = F.col("delay_severity") == F.lit(rules.severity_over)
    return severity.agg(
        F.sum("num_orders").cast("bigint").alias("total_late_orders"),
        F.coalesce(F.sum(F.when(critical, F.col("num_orders"))), F.lit(0)).cast("bigint").alias("critical_orders"),
        F.max(F.when(critical, F.col("max_delay_days"))).alias("critical_max_delay_days"),
    )


def peak_month(trend: DataFrame) -> DataFrame:
    """Month with the most orders; ties go to the earliest month (one row)."""
    key = F.when(
        F.col("total_orders").isNotNull(),
        F.struct((-F.col("total_orders")).alias("t"), F.col("order_year"), F.col("order_month")),
    )
    best = trend.agg(
        F.min_by("order_year", key).alias("order_year"),
        F.min_by("order_month", key).alias("order_month"),
        F.min_by("total_orders", key).alias("total_orders"),
    )
    return best.withColumn("month_label", month_label("order_year", "order_month"))


def summary_metric(summary_text: DataFrame, names: Sequence[str]) -> DataFrame:
    """Look up metrics by name; ``N/A`` for names that are absent."""
    spark = summary_text.sparkSession
    wanted = spark.createDataFrame([(n,) for n in names], "metric string")
    found = summary_text.groupBy("metric").agg(F.max("value").alias("value"))
    return wanted.join(found, on="metric", how="left").select(
        "metric", F.coalesce(F.col("value"), F.lit("N/A")).alias("value")
    )

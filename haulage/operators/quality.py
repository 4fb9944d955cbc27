"""Data-quality checks and the gate in front of the silver sink.

All checks of a table run as one aggregation (one pass), then are unpivoted
into (check, violations, passed) rows.  ``gate`` reads only that small result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulage.functions import count_where
from haulage.rules import DEFAULT_RULES, Rules


class QualityGateError(RuntimeError):
    """Raised when a gated table fails any check; nothing is written."""

    def __init__(self, failed: list[tuple[str, int]]):
        self.failed = failed
        super().__init__("quality gate failed: " + ", ".join(f"{n} ({v} violations)" for n, v in failed))


def check_predicates(rules: Rules = DEFAULT_RULES, strict: bool = True) -> dict:
    """What counts as a violation, by check name: one predicate each over silver's columns."""
    days = F.col("actual_delivery_days")
    lat, lng = F.col("lat"), F.col("lng")
    checks = {
        "order_id_not_null": F.col("order_id").isNull(),
        "customer_id_not_null": F.col("customer_id").isNull(),
        "delivery_days_in_range": days.isNotNull() & ((days < 0) | (days > F.lit(rules.max_delivery_days))),
        "lat_in_bounds": lat.isNotNull() & ((lat < F.lit(rules.lat_min)) | (lat > F.lit(rules.lat_max))),
    }
    if strict:
        checks["lng_in_bounds"] = lng.isNotNull() & ((lng < F.lit(rules.lng_min)) | (lng > F.lit(rules.lng_max)))
    return checks


def quality_checks(silver: DataFrame, rules: Rules = DEFAULT_RULES, strict: bool = True) -> DataFrame:
    """Silver checks as rows (check, violations, passed).

    order_id and customer_id present; delivery days NULL or within
    [0, max_delivery_days]; lat NULL or within bounds; in strict mode also
    lng NULL or within bounds.
    """
    checks = check_predicates(rules, strict)
    agg = silver.agg(*[count_where(p).alias(n) for n, p in checks.items()])
    rows = agg.unpivot([], list(checks), "check_name", "violations")
    return rows.withColumn("passed", F.col("violations") == 0)


def require_passed(results: list[tuple[str, int, bool]]) -> list[tuple[str, int, bool]]:
    """The results as they are, or ``QualityGateError`` if any check failed."""
    failed = [(n, v) for n, v, ok in results if not ok]
    if failed:
        raise QualityGateError(failed)
    return results


def gate(checks: DataFrame) -> list[tuple[str, int, bool]]:
    """Collect the (bounded) check rows; raise ``QualityGateError`` on failure."""
    return require_passed([(r["check_name"], int(r["violations"]), bool(r["passed"])) for r in checks.collect()])


def null_rate_check(df: DataFrame, table: str, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Per column: NULL count, rate %, and pass/fail against the limit."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("__rows"), *[count_where(F.col(c).isNull()).alias(c) for c in cols])
    rows = agg.unpivot(["__rows"], cols, "column_name", "null_count")
    rate = F.try_divide(F.col("null_count") * F.lit(100.0), F.col("__rows"))
    return rows.select(
        F.lit(table).alias("table_name"),
        "column_name",
        "null_count",
        F.col("__rows").alias("total_rows"),
        F.round(rate, 2).alias("null_rate_pct"),
        (F.coalesce(rate, F.lit(0.0)) <= F.lit(rules.max_null_rate_pct)).alias("passed"),
    )


def match_rate_check(join_report: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Per contract: key match rate against the minimum (reports from ``join_report``)."""
    return join_report.select(
        "contract",
        "left_unique_keys",
        "matching_keys",
        F.round("match_rate_pct", 2).alias("match_rate_pct"),
        F.lit(rules.min_match_rate_pct).alias("min_match_rate_pct"),
        (F.coalesce(F.col("match_rate_pct"), F.lit(0.0)) >= F.lit(rules.min_match_rate_pct)).alias("passed"),
    )

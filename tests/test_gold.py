import pytest

from haulage.operators import gold as G
from haulage.operators import marts as M

SILVER = (
    "order_id string, customer_state string, order_status string, actual_delivery_days int, "
    "delay_days int, order_year int, order_month int, delivery_speed_category string"
)


def _silver(spark, rows):
    return spark.createDataFrame(rows, SILVER)


@pytest.mark.parametrize("median", ["exact", "approx"])
def test_median_is_lower_median(spark, median):
    rows = [(str(i), "A", "delivered", d, 0, 2017, 1, "FAST") for i, d in enumerate([3, 4, 9, 10])]
    rows += [(f"b{i}", "B", "delivered", d, 0, 2017, 1, "FAST") for i, d in enumerate([5, 1, 9])]
    kpi = {r["customer_state"]: r for r in G.delivery_by_state(_silver(spark, rows), median=median).collect()}
    assert kpi["A"]["median_delivery_days"] == 4
    assert kpi["B"]["median_delivery_days"] == 5


def test_null_mean_ranks_last_and_never_fastest(spark):
    rows = [
        ("1", "A", "delivered", 10, 1, 2017, 1, "NORMAL"),
        ("2", "B", "delivered", 20, -1, 2017, 1, "SLOW"),
        ("3", "C", "delivered", None, None, 2017, 1, "UNKNOWN"),
        ("4", "C", "shipped", 5, 2, 2017, 2, "FAST"),
    ]
    silver = _silver(spark, rows)
    by_state = G.delivery_by_state(silver)
    ranks = {r["customer_state"]: r["rank_slowest"] for r in by_state.collect()}
    assert ranks == {"B": 1, "A": 2, "C": 3}
    assert [r["customer_state"] for r in G.top_states(by_state, 2, slowest=False).collect()] == ["A", "B"]
    s = G.executive_summary(silver, by_state, G.monthly_trend(silver)).collect()[0]
    assert (s["slowest_state"], s["fastest_state"]) == ("B", "A")
    assert s["late_orders"] == 2  # any status counts in the summary
    assert (s["peak_year"], s["peak_month"], s["peak_month_orders"]) == (2017, 1, 3)


def test_rank_ties_share_and_gap(spark):
    rows = [
        ("1", "A", "delivered", 10, 0, 2017, 1, "NORMAL"),
        ("2", "B", "delivered", 10, 0, 2017, 1, "NORMAL"),
        ("3", "C", "delivered", 5, 0, 2017, 1, "FAST"),
    ]
    ranks = {r["customer_state"]: r["rank_slowest"] for r in G.delivery_by_state(_silver(spark, rows)).collect()}
    assert ranks == {"A": 1, "B": 1, "C": 3}


def test_late_severity_buckets(spark):
    delays = [1, 3, 4, 7, 8, 14, 15, 40, 0, -2]
    rows = [(str(i), "A", "delivered", 10, d, 2017, 1, "NORMAL") for i, d in enumerate(delays)]
    rows.append(("x", "A", "shipped", 10, 50, 2017, 1, "NORMAL"))
    sev = {r["delay_severity"]: (r["num_orders"], r["max_delay_days"]) for r in G.late_severity(_silver(spark, rows)).collect()}
    assert sev == {"MINOR": (2, 3), "MODERATE": (2, 7), "SEVERE": (2, 14), "CRITICAL": (2, 40)}
    summ = M.late_summary(G.late_severity(_silver(spark, rows))).collect()[0]
    assert (summ["total_late_orders"], summ["critical_orders"], summ["critical_max_delay_days"]) == (8, 2, 40)


def test_peak_month_tie_goes_to_earliest(spark):
    trend = spark.createDataFrame(
        [(2017, 5, 10), (2017, 3, 10), (2016, 1, 2)], "order_year int, order_month int, total_orders bigint"
    )
    r = M.peak_month(trend).collect()[0]
    assert (r["order_year"], r["order_month"], r["month_label"]) == (2017, 3, "2017-03")


def test_summary_text_and_lookup(spark):
    rows = [(str(i), "A", "delivered", 3, 1 if i < 2 else -1, 2017, 11, "FAST") for i in range(1234)]
    silver = _silver(spark, rows)
    by_state = G.delivery_by_state(silver)
    summary = G.executive_summary(silver, by_state, G.monthly_trend(silver))
    text = {r["metric"]: r["value"] for r in G.format_summary(summary).collect()}
    assert text["total_orders"] == "1,234"
    assert text["delivered_pct"] == "100.0%"
    assert text["avg_delivery_days"] == "3.0 days"
    assert text["peak_month"] == "2017-11 (1,234 orders)"
    assert text["fast_orders"] == "1,234 (100.0%)"
    look = {r["metric"]: r["value"] for r in M.summary_metric(G.format_summary(summary), ["late_orders", "nope"]).collect()}
    assert look == {"late_orders": "2", "nope": "N/A"}


def test_marts(spark):
    by_state = spark.createDataFrame(
        [("A", 150, 10.0, 20.0, 9), ("B", 50, 5.0, 1.0, 5), ("C", 300, 7.0, 9.0, 7)],
        "customer_state string, total_orders bigint, avg_delivery_days double, late_rate_pct double, "
        "median_delivery_days int",
    )
    ranked = M.late_rate_ranked(by_state).collect()
    assert [(r["customer_state"], r["late_rate_band"]) for r in ranked] == [("C", "MEDIUM"), ("A", "HIGH")]
    assert ranked[0]["mean_late_rate_pct"] == 14.5
    card = M.state_scorecard(by_state, ["A", "B"]).collect()
    assert [r["state"] for r in card] == ["A", "B"] and card[0]["median_days"] == 9
    assert [r[0] for r in M.state_list(by_state).collect()] == ["A", "B", "C"]
    trend = spark.createDataFrame(
        [(2017, 1, 150, 3.0), (2017, 2, 90, 1.0), (2018, 1, 200, 2.0), (2016, 1, 500, 0.0)],
        "order_year int, order_month int, total_orders bigint, late_rate_pct double",
    )
    chart = M.trend_chart_data(trend, (2017, 2018)).collect()
    assert [(r["month_label"], r["is_peak"]) for r in chart] == [("2017-01", False), ("2018-01", True)]


def test_summary_text_rounds_like_python_format(spark):
    # 49 of 400 orders late = 12.25 %: a Python ".1f" format gives 12.2 (half-even
    # on the binary value); the typed column keeps SQL rounding (12.3).
    rows = [(str(i), "A", "delivered", 3, 1 if i < 49 else -1, 2017, 1, "FAST") for i in range(400)]
    silver = _silver(spark, rows)
    summary = G.executive_summary(silver, G.delivery_by_state(silver), G.monthly_trend(silver))
    typed = summary.collect()[0]
    text = {r["metric"]: r["value"] for r in G.format_summary(summary).collect()}
    assert typed["late_pct"] == 12.3
    assert text["late_pct"] == f"{49 / 400 * 100:.1f}%" == "12.2%"


def test_scorecard_without_a_selection_shows_all(spark):
    rows = [(f"S{i}", 1, float(i), 0.0, 0, 0.0, i, 1) for i in range(9)]
    by_state = spark.createDataFrame(
        rows,
        "customer_state string, total_orders bigint, avg_delivery_days double, avg_delay_days double, "
        "late_orders bigint, late_rate_pct double, median_delivery_days int, rank_slowest int",
    )
    assert M.state_scorecard(by_state).count() == M.state_scorecard(by_state, []).count() == 9
    assert M.state_scorecard(by_state, M.default_state_selection(by_state)).count() == 5

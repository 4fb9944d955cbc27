"""Query catalogue: every operator exercised end to end on the test tables.

Each entry is ``(spark, sf_dir) -> DataFrame`` and reads the raw tables under
``sf_dir`` through the adapter, so its work grows with the data.  Floating
means are shown on a 2**-20 binary grid in outputs (summation order
differs between engines in the last bits).  Year parameters of the trend views fall inside
the test tables' date range (1995-2001).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage.operators import bronze as B
from haulage.operators import contracts as C
from haulage.operators import gold as G
from haulage.operators import marts as M
from haulage.operators import quality as Q
from haulage.operators import silver as S
from haulage.operators import sketches as K
from haulage.plans import incremental as I
from haulage.plans.materialise import materialise
from haulage.plans.pipeline import Pipeline
from haulage.rules import DEFAULT_RULES as R
from haulage.schemas import BRONZE_COLUMNS, CUSTOMERS_VS_GEOLOCATION, ORDERS_VS_CUSTOMERS, TIMESTAMP_COLUMNS
from haulage.session import ensure_checkpoint_dir
from haulage.sinks.buckets import colocate
from haulage.sinks.clustering import compact, write_clustered
from haulage.sources import profile as P
from haulage.sources.testdata import source_frames

TREND_YEARS = (2000, 2001)
RECENT_FROM_YEAR = 2000
MIN_ORDERS = 100
SCORECARD_STATES = ("NATION_3", "NATION_12", "NATION_20")
COLOCATED_BUCKETS = 8
CLUSTERED_FILE_ROWS = 1000
CLUSTERED_MONTH_FILES = 16
LOOKUP_METRICS = ("total_orders", "on_time_orders")


# Coordinate means are shown on a binary grid of 2**-20 degrees (about 10 cm).
# A mean of two-decimal coordinates is a terminating decimal, so any decimal
# rounding lands exactly on a tie for some group sizes (a factor 32 at 6
# places, 256 at 9 places), and engines break such ties differently.  On a
# binary grid a tie needs 2**19 rows in one group, while the last-bit noise of
# different summation orders stays far below the grid step.
MEAN_GRID = float(2**20)


def coord(c: str):
    return (F.round(F.col(c) * F.lit(MEAN_GRID)) / F.lit(MEAN_GRID)).alias(c)


def _src(spark, sf):
    return source_frames(spark, sf)


# Derived lookups (consolidated geolocation, per-state means) are written once
# and read back, so each query's plan holds the orders x customers join once
# and Spark picks every join from the tables' sizes.  The means come from
# orders counted by customer, not from the enriched rows.
class _Bronze:
    """The enriched rows of one query and, where they are asked for, their per-state means."""

    def __init__(self, spark, sf, mode="strict"):
        self.src, self.mode = _src(spark, sf), mode
        self.geo = materialise(B.consolidate_geo(self.src["geolocation"]), "geo")
        self.rows = B.enrich(self.src["orders"], self.src["customers"], self.geo, mode=mode)
        self._counts = None

    def counts(self):
        if self._counts is None:
            src = self.src
            self._counts = materialise(
                B.coordinate_counts(src["orders"], src["customers"], self.geo, self.mode), "coordinate-counts"
            )
        return self._counts

    def means(self):
        return materialise(S.state_means(self.counts(), R, in_bounds_only=self.mode == "strict"), "state-means")

    def repair(self, means):
        return materialise(S.repair_means(self.counts(), means, R), "repair-means")

    def silver(self):
        means = self.means()
        repair = self.repair(means) if self.mode == "compat" else None
        return S.build_silver(self.rows, R, mode=self.mode, means=means, repair=repair)


def _bronze(spark, sf, mode="strict"):
    return _Bronze(spark, sf, mode).rows


def _silver(spark, sf, mode="strict"):
    return _Bronze(spark, sf, mode).silver()


def _kpi_rows(spark, sf, mode="strict"):
    """Silver without coordinates, for KPIs that show none: no means, and in strict mode no geolocation.

    The strict geo match finds at most one row, so it never changes which rows
    there are; the original's zip-only match repeats orders and stays.
    """
    src = _src(spark, sf)
    if mode == "strict":
        rows = B.join_orders_customers(src["orders"], src["customers"])
    else:
        rows = _Bronze(spark, sf, mode).rows
    return S.derive(S.fix_timestamps(rows, rules=R, mode=mode), R)


def _by_state(spark, sf, mode="strict", median="exact"):
    return G.delivery_by_state(_kpi_rows(spark, sf, mode), R, median=median)


def _trend(spark, sf, mode="strict"):
    return G.monthly_trend(_kpi_rows(spark, sf, mode), R)


def _summary(spark, sf, mode="strict"):
    cube = materialise(G.order_cube(_kpi_rows(spark, sf, mode)), "order-cube")
    return G.executive_summary(cube, G.delivery_by_state(cube, R), G.monthly_trend(cube, R), R)


def as_of(orders, cutoff):
    """The orders as they were known at ``cutoff`` (text): later purchases are absent, later events have not happened."""
    later = {c: F.col(c) > F.lit(cutoff) for c in TIMESTAMP_COLUMNS[1:4]}
    known = {c: F.when(F.coalesce(~later[c], F.lit(False)), F.col(c)) for c in later}
    coming = F.coalesce(later["order_delivered_customer_date"], F.lit(False))
    known["order_status"] = F.when(coming, F.lit("shipped")).otherwise(F.col("order_status"))
    return orders.where(F.col("order_purchase_timestamp") <= F.lit(cutoff)).withColumns(known)


# The orders are published as they were known at this time and then brought up to date.
CUTOFF = "2000-07-01 00:00:00"


class _Grown:
    """Silver published at ``CUTOFF`` and refreshed with all orders since, over one set of state means."""

    def __init__(self, spark, sf, cube=False):
        bronze = _Bronze(spark, sf)
        means, src = bronze.means(), bronze.src
        self.path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/grown-{uuid.uuid4().hex}/silver"
        self.cube = f"{self.path}-cube"
        early = B.enrich(as_of(src["orders"], CUTOFF), src["customers"], bronze.geo)
        self.first = I.refresh_silver(S.build_silver(early, R, means=means), self.path, R)
        if cube:
            I.refresh_cube(spark, self.path, self.cube)
        self.before = I.published_digests(spark, self.path)
        self.second = I.refresh_silver(S.build_silver(bronze.rows, R, means=means), self.path, R)
        if cube:
            I.refresh_cube(spark, self.path, self.cube)


def _typed_orders(spark, sf):
    return S.fix_timestamps(_src(spark, sf)["orders"], rules=R)


def _geo_view(df: DataFrame, extra=()) -> DataFrame:
    return df.select("order_id", "customer_state", *extra, coord("lat"), coord("lng"))


# ---------------------------------------------------------------- sources
def source_profile(spark, sf):
    return P.profile(_src(spark, sf))


def null_profile(spark, sf):
    return P.null_profiles(_src(spark, sf))


def schema_findings(spark, sf):
    src = _src(spark, sf)
    parts = [C.schema_findings(df, name, with_null_counts=True).drop("nullable") for name, df in src.items()]
    return reduce(DataFrame.unionByName, parts)


def schema_findings_failing(spark, sf):
    """The statuses of a source that doesn't fit: a column is missing, one has another type, one is not declared."""
    orders = _src(spark, sf)["orders"].drop("order_approved_at")
    orders = orders.withColumn("order_id", F.col("order_id").cast("bigint"))
    orders = orders.withColumn("status_length", F.length("order_status"))
    return C.schema_findings(orders, "orders", with_null_counts=True).drop("nullable")


def harmonize_and_recheck(spark, sf):
    """Check, harmonise, re-check: customer keys that arrive as numbers meet the contract after conversion."""
    src = _src(spark, sf)
    numbers = src["customers"].withColumn("customer_id", F.col("customer_id").cast("bigint"))
    before = C.join_report(src["orders"], numbers, ORDERS_VS_CUSTOMERS)
    left, right = (C.harmonize(df, "customer_id", ORDERS_VS_CUSTOMERS.expected_type) for df in (src["orders"], numbers))
    after = C.join_report(left, right, ORDERS_VS_CUSTOMERS)
    marked = before.withColumn("stage", F.lit("before")).unionByName(after.withColumn("stage", F.lit("after")))
    return marked.select("stage", "can_join", "issues", "left_unique_keys", "right_unique_keys", "matching_keys")


def harmonize_types(spark, sf):
    c = _src(spark, sf)["customers"].withColumn("unique_id_as_int", F.col("customer_unique_id"))
    c = C.harmonize(c, "customer_id", "int64")
    c = C.harmonize(c, "customer_zip_code_prefix", "object")
    c = C.harmonize(c, "customer_unique_id", "float64")
    c = C.harmonize(c, "unique_id_as_int", "int64", fill=0)
    # Beyond 2**53, where a double would merge neighbours.
    big = F.concat(F.lit("900719925"), F.lpad(F.regexp_replace("customer_id", "[^0-9]", ""), 7, "0"), F.lit("93"))
    c = C.harmonize(c.withColumn("big_number", big), "big_number", "int64")
    return c.select(
        "customer_id", "customer_zip_code_prefix", "customer_unique_id", "unique_id_as_int", "big_number"
    )


# -------------------------------------------------------------- contracts
def join_contract_orders_customers(spark, sf):
    src = _src(spark, sf)
    return C.join_report(src["orders"], src["customers"], ORDERS_VS_CUSTOMERS)


def join_contract_customers_geo(spark, sf):
    src = _src(spark, sf)
    return C.join_report(src["customers"], src["geolocation"], CUSTOMERS_VS_GEOLOCATION)


def join_contract_mismatch(spark, sf):
    """Contracts that cannot be met: keys of different types, and a missing key."""
    src = _src(spark, sf)
    numbers = src["customers"].withColumn("customer_id", F.col("customer_zip_code_prefix").cast("bigint"))
    return C.join_report(src["orders"], numbers, ORDERS_VS_CUSTOMERS).unionByName(
        C.join_report(src["orders"], src["customers"].drop("customer_id"), ORDERS_VS_CUSTOMERS)
    )


def matched_keys(spark, sf):
    src = _src(spark, sf)
    return C.matched_keys(src["customers"], src["geolocation"], CUSTOMERS_VS_GEOLOCATION)


def unmatched_keys(spark, sf):
    src = _src(spark, sf)
    return C.unmatched_keys(src["customers"], src["geolocation"], CUSTOMERS_VS_GEOLOCATION)


def unmatched_keys_filtered(spark, sf):
    """``unmatched_keys`` through a Bloom filter of the right keys and an exact join of what it can't decide."""
    src = _src(spark, sf)
    return C.unmatched_keys_filtered(src["customers"], src["geolocation"], CUSTOMERS_VS_GEOLOCATION)


def key_overlap_sketch(spark, sf):
    """Key overlap of both contracts from stored theta sketches (exact while a key set is below 65,536)."""
    src = _src(spark, sf)
    parts = []
    for left, right, c in (("orders", "customers", ORDERS_VS_CUSTOMERS), ("customers", "geolocation", CUSTOMERS_VS_GEOLOCATION)):
        sketch = [
            materialise(K.key_sketch(src[t], F.col(k).cast("string")), "key-sketch")
            for t, k in ((left, c.left_key), (right, c.right_key))
        ]
        parts.append(K.sketched_overlap(*sketch).select(F.lit(c.name).alias("contract"), "*"))
    return reduce(DataFrame.unionByName, parts)


def match_rate_check(spark, sf):
    reports = join_contract_orders_customers(spark, sf).unionByName(join_contract_customers_geo(spark, sf))
    return Q.match_rate_check(reports, R)


def null_rate_check(spark, sf):
    return Q.null_rate_check(_src(spark, sf)["orders"], "orders", R)


# ----------------------------------------------------------------- bronze
def geo_consolidated(spark, sf):
    cons = B.consolidate_geo(_src(spark, sf)["geolocation"])
    return cons.select("zip_code", "geolocation_state", coord("lat"), coord("lng"), "city")


def geo_consolidated_bounded(spark, sf):
    """Consolidation with the city from a bounded summary and exact passes over its candidates."""
    cons = B.consolidate_geo_bounded(_src(spark, sf)["geolocation"])
    return cons.select("zip_code", "geolocation_state", coord("lat"), coord("lng"), "city")


def geo_dedup_report(spark, sf):
    return B.geo_dedup_report(B.consolidate_geo(_src(spark, sf)["geolocation"], with_row_counts=True))


def orders_customers(spark, sf):
    src = _src(spark, sf)
    return B.join_orders_customers(src["orders"], src["customers"]).select(*BRONZE_COLUMNS[:12])


def _bronze_view(df):
    return df.select(*[coord(c) if c in ("lat", "lng") else c for c in BRONZE_COLUMNS])


def bronze_enriched(spark, sf):
    return _bronze_view(_bronze(spark, sf, "compat"))


def bronze_enriched_strict(spark, sf):
    return _bronze_view(_bronze(spark, sf, "strict"))


def bronze_colocated(spark, sf):
    """Strict bronze over sources that were written bucketed by customer: the order rows are not moved."""
    src = _src(spark, sf)
    geo = materialise(B.consolidate_geo(src["geolocation"]), "geo")
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/colocated-{uuid.uuid4().hex}"
    orders, customers = colocate(src["orders"], src["customers"], base, COLOCATED_BUCKETS)
    return _bronze_view(B.enrich(orders, customers, geo, mode="strict"))


def bronze_lineage(spark, sf):
    b = B.add_lineage(_bronze(spark, sf), R)
    return b.select("order_id", "data_source", F.col("ingestion_timestamp").isNotNull().alias("has_ingestion_time"))


def bronze_sample(spark, sf):
    b = _bronze(spark, sf).select("order_id", "customer_id", "order_status", "customer_state", coord("lat"), coord("lng"))
    return b.orderBy("order_id").limit(20)


def geo_coverage(spark, sf):
    return B.geo_coverage(_bronze(spark, sf))


def join_fanout(spark, sf):
    return B.join_fanout(_bronze(spark, sf, "compat"))


# ----------------------------------------------------------------- silver
def fix_timestamps(spark, sf):
    return _typed_orders(spark, sf).select("order_id", *TIMESTAMP_COLUMNS)


def impute_geo(spark, sf):
    bronze = _Bronze(spark, sf)
    return _geo_view(S.impute_geo(bronze.rows, R, mode="strict", means=bronze.means()), ["geo_imputed"])


def impute_geo_compat(spark, sf):
    bronze = _Bronze(spark, sf, "compat")
    out = S.impute_geo(bronze.rows, R, mode="compat", means=bronze.means())
    return _geo_view(out, ["geolocation_state", "geo_imputed"])


def null_reason(spark, sf):
    return S.null_reason(_typed_orders(spark, sf), R).select("order_id", "order_status", "delivery_null_reason")


def geo_outliers(spark, sf):
    out = S.geo_outliers(_bronze(spark, sf), R)
    return out.select("order_id", "customer_state", coord("lat"), coord("lng"), "city")


def fix_geo_outliers(spark, sf):
    bronze = _Bronze(spark, sf)
    return _geo_view(S.fix_geo_outliers(bronze.rows, R, mode="strict", means=bronze.means()), ["geo_repaired"])


def fix_geo_outliers_compat(spark, sf):
    bronze = _Bronze(spark, sf, "compat")
    means = bronze.means()
    imputed = S.impute_geo(bronze.rows, R, mode="compat", means=means)
    out = S.fix_geo_outliers(imputed, R, mode="compat", means=bronze.repair(means))
    return _geo_view(out, ["geolocation_state", "geo_imputed"])


def derived_columns(spark, sf):
    d = S.derive(_typed_orders(spark, sf), R)
    return d.select("order_id", "actual_delivery_days", "delay_days", "order_year", "order_month")


def speed_bucket(spark, sf):
    d = S.derive(_typed_orders(spark, sf), R)
    return d.select("order_id", "actual_delivery_days", "delivery_speed_category")


def cleaning_report(spark, sf):
    bronze = _Bronze(spark, sf)
    cleaned = S.build_silver(S.with_unparsed(bronze.rows, R), R, means=bronze.means())
    return S.cleaning_report(bronze.counts(), cleaned, R)


def row_preservation(spark, sf):
    bronze = _Bronze(spark, sf)
    return S.row_preservation(bronze.counts(), bronze.silver())


def _silver_view(df):
    return df.select(*[coord(c) if c in ("lat", "lng") else F.col(c) for c in sorted(df.columns)])


def silver_orders(spark, sf):
    return _silver_view(_silver(spark, sf))


def silver_orders_compat(spark, sf):
    return _silver_view(_silver(spark, sf, "compat"))


def quality_checks(spark, sf):
    return Q.quality_checks(_silver(spark, sf), R)


def failing_checks(spark, sf):
    """The checks over rows that fail them: coordinates moved out of bounds, days beyond the limit, statuses lost."""
    silver = _silver(spark, sf)
    broken = silver.withColumns(
        {
            "lat": F.col("lat") + F.lit(100.0),
            "lng": F.col("lng") + F.lit(100.0),
            "actual_delivery_days": F.col("actual_delivery_days") + F.lit(400),
            "order_id": F.when(F.col("order_status") == "delivered", F.col("order_id")),
        }
    )
    return Q.quality_checks(broken, R)


def silver_stats(spark, sf):
    return M.silver_stats(_kpi_rows(spark, sf), R)


def speed_distribution(spark, sf):
    return M.speed_distribution(_kpi_rows(spark, sf))


# ------------------------------------------------------------------- gold
def delivery_by_state(spark, sf):
    return _by_state(spark, sf)


def top_slowest_states(spark, sf):
    return G.top_states(_by_state(spark, sf), 5, slowest=True)


def top_fastest_states(spark, sf):
    return G.top_states(_by_state(spark, sf), 5, slowest=False)


def monthly_trend(spark, sf):
    return G.monthly_trend(_kpi_rows(spark, sf), R, ordered=True)


def monthly_trend_recent(spark, sf):
    return G.monthly_trend_recent(_trend(spark, sf), RECENT_FROM_YEAR)


def late_severity(spark, sf):
    return G.late_severity(_kpi_rows(spark, sf), R, ordered=True)


def late_by_state_severity(spark, sf):
    return G.late_by_state_severity(_kpi_rows(spark, sf), R, ordered=True)


def top_late_state_severity(spark, sf):
    return G.top_late_state_severity(G.late_by_state_severity(_kpi_rows(spark, sf), R), 10)


def executive_summary(spark, sf):
    return _summary(spark, sf)


def executive_summary_text(spark, sf):
    return G.format_summary(_summary(spark, sf))


def summary_metric(spark, sf):
    return M.summary_metric(G.format_summary(_summary(spark, sf)), LOOKUP_METRICS)


def delivery_by_state_compat(spark, sf):
    return _by_state(spark, sf, "compat")


def delivery_by_state_approx(spark, sf):
    """The approximate median: exact here, as every state has fewer distinct values than the sketch's accuracy."""
    return _by_state(spark, sf, median="approx")


def monthly_trend_compat(spark, sf):
    return _trend(spark, sf, "compat")


def late_severity_compat(spark, sf):
    return G.late_severity(_kpi_rows(spark, sf, "compat"), R)


def executive_summary_compat(spark, sf):
    return _summary(spark, sf, "compat")


# ------------------------------------------------- published and incremental
def silver_incremental(spark, sf):
    """Silver after a refresh, as published: equal to a full rebuild."""
    return _silver_view(spark.read.parquet(_Grown(spark, sf).path))


def silver_clustered(spark, sf):
    """Silver in files clustered by state and day, then compacted, as read back."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/clustered-{uuid.uuid4().hex}/silver"
    write_clustered(_silver(spark, sf), path, file_rows=CLUSTERED_FILE_ROWS, month_files=CLUSTERED_MONTH_FILES)
    compact(spark, path)
    return _silver_view(spark.read.parquet(path))


def silver_changed_months(spark, sf):
    """The months that the refresh rebuilt, with their rows before and after."""
    grown = _Grown(spark, sf)
    after = I.published_digests(spark, grown.path)
    rows = [
        (*I.partition_values(m), grown.before.get(m, [0])[0], after.get(m, [0])[0]) for m in grown.second.changed
    ]
    return spark.createDataFrame(rows, "order_year int, order_month int, rows_before bigint, rows_after bigint")


def median_by_sketch(spark, sf):
    """Medians by state merged from stored month sketches, audited against the true ranks."""
    rows = _kpi_rows(spark, sf)
    stored = materialise(K.day_sketches(rows, R), "day-sketches")
    return K.rank_check(K.median_by_sketch(stored), rows, R)


def run_audit(spark, sf):
    """The stored audit of two runs into one folder: the second finds every step completed."""
    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/audited-{uuid.uuid4().hex}"
    for number in (1, 2):
        Pipeline(spark, _src(spark, sf), out, gold_csv=False, run_id=f"run-{number}").run("all")
    return Pipeline(spark, None, out).audit_history().select("run_id", "step", "status", "rows")


def _grown_cube(spark, sf):
    return spark.read.parquet(_Grown(spark, sf, cube=True).cube)


def delivery_by_state_incremental(spark, sf):
    """KPI 1 from the stored cube after signed deltas."""
    return G.delivery_by_state(_grown_cube(spark, sf), R)


def executive_summary_incremental(spark, sf):
    cube = _grown_cube(spark, sf)
    return G.executive_summary(cube, G.delivery_by_state(cube, R), G.monthly_trend(cube, R), R)


# ------------------------------------------------------------------ marts
def peak_month(spark, sf):
    return M.peak_month(_trend(spark, sf))


def trend_chart_data(spark, sf):
    return M.trend_chart_data(_trend(spark, sf), TREND_YEARS, MIN_ORDERS)


def late_rate_ranked(spark, sf):
    return M.late_rate_ranked(_by_state(spark, sf), MIN_ORDERS, R)


def state_scorecard(spark, sf):
    return M.state_scorecard(_by_state(spark, sf))


def state_scorecard_selected(spark, sf):
    return M.state_scorecard(_by_state(spark, sf), SCORECARD_STATES)


def state_list(spark, sf):
    return M.state_list(_by_state(spark, sf))


def late_summary(spark, sf):
    return M.late_summary(G.late_severity(_kpi_rows(spark, sf), R), R)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        source_profile,
        null_profile,
        schema_findings,
        harmonize_types,
        join_contract_orders_customers,
        join_contract_customers_geo,
        matched_keys,
        unmatched_keys,
        match_rate_check,
        null_rate_check,
        geo_consolidated,
        geo_dedup_report,
        orders_customers,
        bronze_enriched,
        bronze_enriched_strict,
        bronze_lineage,
        bronze_sample,
        geo_coverage,
        join_fanout,
        fix_timestamps,
        impute_geo,
        impute_geo_compat,
        null_reason,
        geo_outliers,
        fix_geo_outliers,
        fix_geo_outliers_compat,
        derived_columns,
        speed_bucket,
        cleaning_report,
        row_preservation,
        quality_checks,
        silver_stats,
        speed_distribution,
        delivery_by_state,
        top_slowest_states,
        top_fastest_states,
        monthly_trend,
        monthly_trend_recent,
        late_severity,
        late_by_state_severity,
        top_late_state_severity,
        executive_summary,
        executive_summary_text,
        summary_metric,
        peak_month,
        trend_chart_data,
        late_rate_ranked,
        state_scorecard,
        state_list,
        late_summary,
        silver_orders,
        silver_orders_compat,
        delivery_by_state_compat,
        delivery_by_state_approx,
        monthly_trend_compat,
        late_severity_compat,
        executive_summary_compat,
        state_scorecard_selected,
        join_contract_mismatch,
        failing_checks,
        silver_incremental,
        silver_changed_months,
        delivery_by_state_incremental,
        executive_summary_incremental,
        median_by_sketch,
        key_overlap_sketch,
        unmatched_keys_filtered,
        schema_findings_failing,
        harmonize_and_recheck,
        run_audit,
        bronze_colocated,
        silver_clustered,
        geo_consolidated_bounded,
    )
}

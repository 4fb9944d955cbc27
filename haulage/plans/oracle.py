"""Oracle SQL for the query catalogue (ANSI-style SQL that DuckDB runs).

Each statement starts from the raw tables through the SQL adapter and
recomputes the query independently of Spark: bronze, silver and the KPIs are
layered common-table expressions.  Column names and types match the Spark
outputs (counts BIGINT, days/years/months/ranks INTEGER, rates DOUBLE).
"""

from __future__ import annotations

from types import SimpleNamespace

from haulage.plans.catalog import CUTOFF, LOOKUP_METRICS, MEAN_GRID, MIN_ORDERS, RECENT_FROM_YEAR, SCORECARD_STATES, TREND_YEARS
from haulage.schemas import (
    BRONZE_COLUMNS,
    CUSTOMERS_SCHEMA,
    CUSTOMERS_VS_GEOLOCATION,
    GEOLOCATION_SCHEMA,
    ORDERS_SCHEMA,
    ORDERS_VS_CUSTOMERS,
    TIMESTAMP_COLUMNS,
)
from haulage.sources.testdata import ADAPTER_SQL

# Fixed values, written out here so that a wrong constant in the code under test shows.
R = SimpleNamespace(
    lat_min=-34.0,
    lat_max=6.0,
    lng_min=-74.0,
    lng_max=-28.0,
    speed_steps=(("FAST", 7), ("NORMAL", 14), ("SLOW", 30)),
    speed_over="VERY_SLOW",
    speed_unknown="UNKNOWN",
    severity_steps=(("MINOR", 3), ("MODERATE", 7), ("SEVERE", 14)),
    severity_over="CRITICAL",
    max_null_rate_pct=5.0,
    min_match_rate_pct=95.0,
    max_delivery_days=365,
    late_rate_bands=(("HIGH", 15.0), ("MEDIUM", 8.0)),
    late_rate_band_else="LOW",
    lineage_tag="OLIST_BRONZE_v1",
    delivered_status="delivered",
    null_reason_data_quality="DATA_QUALITY_ISSUE",
    null_reason_not_delivered="NOT_YET_DELIVERED",
)

TS = "%Y-%m-%d %H:%M:%S"
D = "CAST({} AS DOUBLE)".format


def _q(*ctes: str, select: str) -> str:
    parts = [ADAPTER_SQL.strip()] + [c.strip() for c in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + select.strip()


OOB = (
    f"(lat < {D(R.lat_min)} OR lat > {D(R.lat_max)} OR lng < {D(R.lng_min)} OR lng > {D(R.lng_max)})"
)
INB = (
    f"(lat >= {D(R.lat_min)} AND lat <= {D(R.lat_max)} AND lng >= {D(R.lng_min)} AND lng <= {D(R.lng_max)})"
)


def _speed(col: str) -> str:
    whens = " ".join(f"WHEN {col} <= {u} THEN '{lab}'" for lab, u in R.speed_steps)
    return f"CASE WHEN {col} IS NULL THEN '{R.speed_unknown}' {whens} ELSE '{R.speed_over}' END"


def _severity(col: str) -> str:
    whens = " ".join(f"WHEN {col} <= {u} THEN '{lab}'" for lab, u in R.severity_steps)
    return f"CASE {whens} ELSE '{R.severity_over}' END"


GEO_CONS = """
geo_cons AS (
  SELECT a.zip_code, a.geolocation_state, a.lat, a.lng, c.city, a.n_rows
  FROM (SELECT geolocation_zip_code_prefix AS zip_code, geolocation_state,
               avg(geolocation_lat) AS lat, avg(geolocation_lng) AS lng, count(*) AS n_rows
        FROM src_geolocation GROUP BY 1, 2) a
  LEFT JOIN (
    SELECT zip_code, geolocation_state, city FROM (
      SELECT geolocation_zip_code_prefix AS zip_code, geolocation_state, geolocation_city AS city,
             row_number() OVER (PARTITION BY geolocation_zip_code_prefix, geolocation_state
                                ORDER BY count(*) DESC, geolocation_city) AS rn
      FROM src_geolocation WHERE geolocation_city IS NOT NULL GROUP BY 1, 2, 3) t
    WHERE rn = 1) c
  ON a.zip_code IS NOT DISTINCT FROM c.zip_code AND a.geolocation_state IS NOT DISTINCT FROM c.geolocation_state
)"""

OC = """
oc AS (
  SELECT c.customer_zip_code_prefix AS zip_code, o.customer_id, o.order_id, o.order_status,
         o.order_purchase_timestamp, o.order_approved_at, o.order_delivered_carrier_date,
         o.order_delivered_customer_date, o.order_estimated_delivery_date,
         c.customer_unique_id, c.customer_city, c.customer_state
  FROM src_orders o JOIN src_customers c ON o.customer_id = c.customer_id
)"""

BRONZE_C = """
bronze_c AS (
  SELECT oc.*, g.geolocation_state, g.lat, g.lng, g.city
  FROM oc LEFT JOIN geo_cons g ON oc.zip_code = g.zip_code
)"""

BRONZE_S = """
bronze_s AS (
  SELECT oc.*, g.geolocation_state, g.lat, g.lng, g.city
  FROM oc LEFT JOIN geo_cons g ON oc.zip_code = g.zip_code AND oc.customer_state = g.geolocation_state
)"""


def _typed(name: str, src: str) -> str:
    repl = ", ".join(f"try_strptime({c}, '{TS}') AS {c}" for c in TIMESTAMP_COLUMNS)
    return f"{name} AS (SELECT * REPLACE ({repl}) FROM {src})"


TYPED_ORDERS = _typed("typed_orders", "src_orders")
TYPED_S = _typed("typed_s", "bronze_s")

MEAN_S = f"""
mean_s AS (
  SELECT customer_state, avg(lat) AS m_lat, avg(lng) AS m_lng
  FROM bronze_s WHERE {INB} AND customer_state IS NOT NULL GROUP BY 1
)"""

CLEAN_S = f"""
marked_s AS (SELECT *, coalesce({OOB}, false) AS geo_repaired FROM typed_s),
clean_s AS (
  SELECT t.* EXCLUDE (lat, lng),
         CASE WHEN t.geo_repaired THEN m.m_lat ELSE coalesce(t.lat, m.m_lat) END AS lat,
         CASE WHEN t.geo_repaired THEN m.m_lng ELSE coalesce(t.lng, m.m_lng) END AS lng,
         coalesce(t.lat IS NULL AND m.m_lat IS NOT NULL, false) AS geo_imputed
  FROM marked_s t LEFT JOIN mean_s m ON t.customer_state = m.customer_state
)"""


def _derive_select(src: str) -> str:
    return f"""SELECT *,
         CASE WHEN order_delivered_customer_date IS NULL AND order_status = '{R.delivered_status}'
                   THEN '{R.null_reason_data_quality}'
              WHEN order_delivered_customer_date IS NULL THEN '{R.null_reason_not_delivered}' END AS delivery_null_reason,
         CAST(date_diff('day', order_purchase_timestamp, order_delivered_customer_date) AS INTEGER)
              AS actual_delivery_days,
         CAST(date_diff('day', order_estimated_delivery_date, order_delivered_customer_date) AS INTEGER)
              AS delay_days,
         CAST(year(order_purchase_timestamp) AS INTEGER) AS order_year,
         CAST(month(order_purchase_timestamp) AS INTEGER) AS order_month
  FROM {src}"""


SILVER = f"""
silver0 AS ({_derive_select('clean_s')}),
silver AS (SELECT *, {_speed('actual_delivery_days')} AS delivery_speed_category FROM silver0)"""

DERIVED_ORDERS = f"""
derived_orders0 AS ({_derive_select('typed_orders')}),
derived_orders AS (SELECT *, {_speed('actual_delivery_days')} AS delivery_speed_category FROM derived_orders0)"""

SILVER_CTES = (GEO_CONS, OC, BRONZE_S, TYPED_S, MEAN_S, CLEAN_S, SILVER)

KPI_STATE = f"""
kpi_state0 AS (
  SELECT customer_state,
         count(order_id) AS total_orders,
         round(avg(actual_delivery_days), 1) AS avg_delivery_days,
         round(avg(delay_days), 1) AS avg_delay_days,
         count(*) FILTER (WHERE delay_days > 0) AS late_orders,
         round(count(*) FILTER (WHERE delay_days > 0) / count(order_id) * 100, 1) AS late_rate_pct,
         CAST(quantile_disc(actual_delivery_days, 0.5) AS INTEGER) AS median_delivery_days
  FROM silver WHERE order_status = '{R.delivered_status}' GROUP BY customer_state
),
kpi_state AS (
  SELECT *, CAST(rank() OVER (ORDER BY avg_delivery_days DESC NULLS LAST) AS INTEGER) AS rank_slowest
  FROM kpi_state0
)"""

KPI_TREND = f"""
kpi_trend AS (
  SELECT order_year, order_month,
         count(order_id) AS total_orders,
         round(avg(actual_delivery_days), 1) AS avg_delivery_days,
         round(count(*) FILTER (WHERE delay_days > 0) / count(order_id) * 100, 1) AS late_rate_pct,
         count(*) FILTER (WHERE delivery_speed_category = '{R.speed_steps[0][0]}') AS fast_orders,
         count(*) FILTER (WHERE delivery_speed_category = '{R.speed_over}') AS very_slow_orders
  FROM silver GROUP BY order_year, order_month
)"""

LATE = f"""
late AS (
  SELECT *, {_severity('delay_days')} AS delay_severity
  FROM silver WHERE delay_days > 0 AND order_status = '{R.delivered_status}'
),
kpi_late AS (
  SELECT delay_severity, count(order_id) AS num_orders, round(avg(delay_days), 1) AS avg_delay_days,
         max(delay_days) AS max_delay_days
  FROM late GROUP BY delay_severity
),
late_state AS (
  SELECT customer_state, delay_severity, count(order_id) AS late_orders FROM late GROUP BY 1, 2
)"""

SUMMARY = f"""
summary_base AS (
  SELECT count(*) AS total_orders,
         count(*) FILTER (WHERE order_status = '{R.delivered_status}') AS delivered_orders,
         round(count(*) FILTER (WHERE order_status = '{R.delivered_status}') / count(*) * 100, 1) AS delivered_pct,
         round(avg(actual_delivery_days), 1) AS avg_delivery_days,
         avg(actual_delivery_days) AS mean_delivery_days,
         count(*) FILTER (WHERE delay_days > 0) AS late_orders,
         round(count(*) FILTER (WHERE delay_days > 0) / count(*) * 100, 1) AS late_pct,
         count(*) FILTER (WHERE delivery_speed_category = '{R.speed_steps[0][0]}') AS fast_orders,
         round(count(*) FILTER (WHERE delivery_speed_category = '{R.speed_steps[0][0]}') / count(*) * 100, 1) AS fast_pct
  FROM silver
),
summary AS (
  SELECT b.*,
         (SELECT customer_state FROM kpi_state WHERE customer_state IS NOT NULL AND avg_delivery_days IS NOT NULL
          ORDER BY avg_delivery_days DESC, customer_state LIMIT 1) AS slowest_state,
         (SELECT customer_state FROM kpi_state WHERE customer_state IS NOT NULL AND avg_delivery_days IS NOT NULL
          ORDER BY avg_delivery_days ASC, customer_state LIMIT 1) AS fastest_state,
         p.order_year AS peak_year, p.order_month AS peak_month, p.total_orders AS peak_month_orders
  FROM summary_base b,
       (SELECT order_year, order_month, total_orders FROM kpi_trend
        ORDER BY total_orders DESC, order_year, order_month LIMIT 1) p
),
summary_text AS (
  SELECT * FROM (VALUES
    ('total_orders', (SELECT format('{{:,}}', total_orders) FROM summary)),
    ('delivered_orders', (SELECT format('{{:,}}', delivered_orders) FROM summary)),
    ('delivered_pct', (SELECT printf('%.1f%%', delivered_orders / total_orders * 100) FROM summary)),
    ('avg_delivery_days', (SELECT printf('%.1f days', mean_delivery_days) FROM summary)),
    ('late_orders', (SELECT format('{{:,}}', late_orders) FROM summary)),
    ('late_pct', (SELECT printf('%.1f%%', late_orders / total_orders * 100) FROM summary)),
    ('fast_orders', (SELECT format('{{:,}}', fast_orders) || ' (' || printf('%.1f%%', fast_orders / total_orders * 100)
                            || ')' FROM summary)),
    ('slowest_state', (SELECT slowest_state FROM summary)),
    ('fastest_state', (SELECT fastest_state FROM summary)),
    ('peak_month', (SELECT CAST(peak_year AS VARCHAR) || '-' || lpad(CAST(peak_month AS VARCHAR), 2, '0')
                           || ' (' || format('{{:,}}', peak_month_orders) || ' orders)' FROM summary))
  ) AS t(metric, value)
)"""


def _coord(c: str, prefix: str = "") -> str:
    grid = f"CAST({int(MEAN_GRID)} AS DOUBLE)"
    return f"round({prefix}{c} * {grid}) / {grid} AS {c}"


def _bronze_select(src: str) -> str:
    cols = ", ".join(_coord(c) if c in ("lat", "lng") else c for c in BRONZE_COLUMNS)
    return f"SELECT {cols} FROM {src}"


def _silver_select(src: str) -> str:
    return f"SELECT * REPLACE ({_coord('lat')}, {_coord('lng')}) FROM {src}"


def _null_profile_sql() -> str:
    parts = []
    for name, cte, schema in (
        ("orders", "src_orders", ORDERS_SCHEMA),
        ("customers", "src_customers", CUSTOMERS_SCHEMA),
        ("geolocation", "src_geolocation", GEOLOCATION_SCHEMA),
    ):
        for f in schema.fields:
            parts.append(
                f"SELECT '{name}' AS source, '{f.name}' AS column_name, "
                f"count(*) FILTER (WHERE {f.name} IS NULL) AS null_count FROM {cte}"
            )
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") t WHERE null_count > 0"


# Spark type names of DuckDB value types, and coarse type families.
_SPARK_TYPE = "CASE {t} WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' WHEN 'BIGINT' THEN 'bigint' " \
    "WHEN 'DOUBLE' THEN 'double' WHEN 'BOOLEAN' THEN 'boolean' ELSE lower({t}) END"
_FAMILY = "CASE {t} WHEN 'string' THEN 'string' WHEN 'int' THEN 'integer' WHEN 'bigint' THEN 'integer' " \
    "WHEN 'double' THEN 'float' WHEN 'object' THEN 'string' WHEN 'int64' THEN 'integer' " \
    "WHEN 'float64' THEN 'float' ELSE {t} END"


def _schema_findings_sql() -> str:
    from haulage.schemas import SOURCE_SPECS

    parts = []
    for name, cte in (("orders", "src_orders"), ("customers", "src_customers"), ("geolocation", "src_geolocation")):
        spec = SOURCE_SPECS[name]
        for col in spec.required:
            hint = spec.type_hints.get(col)
            hint_sql = f"'{hint}'" if hint else "CAST(NULL AS VARCHAR)"
            parts.append(
                f"SELECT '{name}' AS source, '{col}' AS column_name, "
                f"{_SPARK_TYPE.format(t=f'any_value(typeof({col}))')} AS data_type, true AS required, "
                f"{hint_sql} AS expected_type, count(*) FILTER (WHERE {col} IS NULL) AS null_count FROM {cte}"
            )
    body = " UNION ALL ".join(parts)
    fam_d = _FAMILY.format(t="data_type")
    fam_e = _FAMILY.format(t="expected_type")
    return f"""SELECT source, column_name, data_type, required, expected_type,
       CASE WHEN expected_type IS NOT NULL AND {fam_d} <> {fam_e} THEN 'TYPE_WARNING' ELSE 'OK' END AS status,
       null_count
FROM ({body}) t"""


def _failing_findings_sql() -> str:
    """Orders without the approval time, with a numeric id and a column that nobody declared."""
    from haulage.schemas import SOURCE_SPECS

    spec, parts = SOURCE_SPECS["orders"], []

    def row(col, kind, required, status, nulls):
        hint = spec.type_hints.get(col)
        hint_sql = f"'{hint}'" if hint else "CAST(NULL AS VARCHAR)"
        parts.append(
            f"SELECT 'orders' AS source, '{col}' AS column_name, {kind} AS data_type, {required} AS required, "
            f"{hint_sql} AS expected_type, '{status}' AS status, {nulls} AS null_count FROM src_orders"
        )

    for col in spec.required:
        nulls = f"count(*) FILTER (WHERE {col} IS NULL)"
        if col == "order_approved_at":
            row(col, "CAST(NULL AS VARCHAR)", "true", "MISSING", "CAST(NULL AS BIGINT)")
        elif col == "order_id":
            row(col, "'bigint'", "true", "TYPE_WARNING", nulls)
        else:
            row(col, "'string'", "true", "OK", nulls)
    row("status_length", "'int'", "false", "EXTRA", "count(*) FILTER (WHERE length(order_status) IS NULL)")
    return " UNION ALL ".join(p if "count(*)" in p else p + " LIMIT 1" for p in parts).replace("FROM src_orders LIMIT 1", "")


def _join_report_sql(contract, left_cte: str, right_cte: str) -> tuple[str, str]:
    cte = f"""
keys_l AS (SELECT DISTINCT {contract.left_key} AS k FROM {left_cte} WHERE {contract.left_key} IS NOT NULL),
keys_r AS (SELECT DISTINCT {contract.right_key} AS k FROM {right_cte} WHERE {contract.right_key} IS NOT NULL),
stats AS (
  SELECT (SELECT count(*) FROM keys_l) AS left_unique_keys,
         (SELECT count(*) FROM keys_r) AS right_unique_keys,
         (SELECT count(*) FROM keys_l WHERE k IN (SELECT k FROM keys_r)) AS matching_keys,
         (SELECT count(*) FROM keys_l WHERE k NOT IN (SELECT k FROM keys_r)) AS left_keys_no_match
)"""
    select = f"""SELECT '{contract.name}' AS contract, '{contract.description}' AS description, true AS can_join,
       '' AS issues, left_unique_keys, right_unique_keys, matching_keys, left_keys_no_match,
       CASE WHEN left_unique_keys = 0 THEN '0%'
            ELSE printf('%.1f%%', matching_keys / left_unique_keys * CAST(100.0 AS DOUBLE)) END AS match_rate,
       matching_keys / left_unique_keys * CAST(100.0 AS DOUBLE) AS match_rate_pct
FROM stats"""
    return cte, select


def _keys_sql(anti: bool) -> str:
    c = CUSTOMERS_VS_GEOLOCATION
    op = "NOT IN" if anti else "IN"
    return _q(
        select=f"""SELECT DISTINCT {c.left_key} FROM src_customers
WHERE {c.left_key} IS NOT NULL
  AND {c.left_key} {op} (SELECT {c.right_key} FROM src_geolocation WHERE {c.right_key} IS NOT NULL)"""
    )


def _geo_sql(extra: str, src: str) -> str:
    return f"SELECT order_id, customer_state, {extra}{_coord('lat')}, {_coord('lng')} FROM {src}"


def oracle_sql() -> dict[str, str]:
    oc_cte, oc_sel = _join_report_sql(ORDERS_VS_CUSTOMERS, "src_orders", "src_customers")
    cg_cte, cg_sel = _join_report_sql(CUSTOMERS_VS_GEOLOCATION, "src_customers", "src_geolocation")
    cg_cte2 = cg_cte.replace("keys_l", "keys_l2").replace("keys_r", "keys_r2").replace("stats AS", "stats2 AS")
    cg_sel2 = cg_sel.replace("FROM stats", "FROM stats2")
    ts_cols = ", ".join(TIMESTAMP_COLUMNS)
    years = ", ".join(str(y) for y in TREND_YEARS)
    bands = " ".join(f"WHEN late_rate_pct > {D(lo)} THEN '{lab}'" for lab, lo in R.late_rate_bands)
    metrics = ", ".join(f"('{m}')" for m in LOOKUP_METRICS)
    null_rate_parts = " UNION ALL ".join(
        f"SELECT '{f.name}' AS column_name, count(*) FILTER (WHERE {f.name} IS NULL) AS null_count, "
        f"count(*) AS total_rows FROM src_orders"
        for f in ORDERS_SCHEMA.fields
    )
    compat_impute = f"""
typed_c AS (SELECT * FROM bronze_c),
mean_all_c AS (SELECT customer_state, avg(lat) AS m_lat, avg(lng) AS m_lng FROM bronze_c
               WHERE customer_state IS NOT NULL GROUP BY 1),
imputed_c AS (
  SELECT b.* EXCLUDE (lat, lng), coalesce(b.lat, m.m_lat) AS lat, coalesce(b.lng, m.m_lng) AS lng,
         CASE WHEN m.m_lat IS NOT NULL AND coalesce(b.lat, m.m_lat) = m.m_lat THEN true ELSE false END AS geo_imputed
  FROM bronze_c b LEFT JOIN mean_all_c m ON b.customer_state = m.customer_state
)"""
    compat_fix = f"""
mean_clean_c AS (SELECT customer_state, avg(lat) AS m_lat, avg(lng) AS m_lng FROM imputed_c
                 WHERE {INB} AND customer_state IS NOT NULL GROUP BY 1),
fixed_lat_c AS (
  SELECT i.* EXCLUDE (lat), CASE WHEN {OOB.replace('lat', 'i.lat').replace('lng', 'i.lng')} THEN m.m_lat ELSE i.lat END AS lat,
         m.m_lng
  FROM imputed_c i LEFT JOIN mean_clean_c m ON i.customer_state = m.customer_state
),
fixed_c AS (
  SELECT * EXCLUDE (lng, m_lng), CASE WHEN {OOB} THEN m_lng ELSE lng END AS lng FROM fixed_lat_c
)"""
    compat_silver = (
        GEO_CONS,
        OC,
        BRONZE_C,
        compat_impute,
        compat_fix,
        _typed("typed_fixed_c", "fixed_c"),
        f"""
silver0 AS ({_derive_select("typed_fixed_c")}),
silver AS (SELECT *, {_speed('actual_delivery_days')} AS delivery_speed_category FROM silver0)""",
    )
    scorecard = """SELECT customer_state AS state, total_orders AS orders, avg_delivery_days AS avg_days,
       late_rate_pct AS late_pct, median_delivery_days AS median_days"""
    q = {
        "source_profile": _q(
            select=f"""SELECT 'orders' AS source, count(*) AS rows, CAST({len(ORDERS_SCHEMA.fields)} AS INTEGER) AS cols FROM src_orders
UNION ALL SELECT 'customers', count(*), CAST({len(CUSTOMERS_SCHEMA.fields)} AS INTEGER) FROM src_customers
UNION ALL SELECT 'geolocation', count(*), CAST({len(GEOLOCATION_SCHEMA.fields)} AS INTEGER) FROM src_geolocation"""
        ),
        "null_profile": _q(select=_null_profile_sql()),
        "schema_findings": _q(select=_schema_findings_sql()),
        "harmonize_types": _q(
            select="""SELECT CAST(trunc(TRY_CAST(customer_id AS DOUBLE)) AS BIGINT) AS customer_id,
       CAST(customer_zip_code_prefix AS VARCHAR) AS customer_zip_code_prefix,
       TRY_CAST(customer_unique_id AS DOUBLE) AS customer_unique_id,
       coalesce(CAST(trunc(TRY_CAST(customer_unique_id AS DOUBLE)) AS BIGINT), CAST(0 AS BIGINT)) AS unique_id_as_int,
       CAST('900719925' || lpad(regexp_replace(customer_id, '[^0-9]', '', 'g'), 7, '0') || '93' AS BIGINT) AS big_number
FROM src_customers"""
        ),
        "join_contract_orders_customers": _q(oc_cte, select=oc_sel),
        "join_contract_customers_geo": _q(cg_cte, select=cg_sel),
        "matched_keys": _keys_sql(anti=False),
        "unmatched_keys": _keys_sql(anti=True),
        "match_rate_check": _q(
            oc_cte,
            cg_cte2,
            f"reports AS ({oc_sel} UNION ALL {cg_sel2})",
            select=f"""SELECT contract, left_unique_keys, matching_keys, round(match_rate_pct, 2) AS match_rate_pct,
       {D(R.min_match_rate_pct)} AS min_match_rate_pct,
       coalesce(match_rate_pct, 0.0) >= {D(R.min_match_rate_pct)} AS passed
FROM reports""",
        ),
        "null_rate_check": _q(
            f"nr AS ({null_rate_parts})",
            select=f"""SELECT 'orders' AS table_name, column_name, null_count, total_rows,
       round(null_count * CAST(100.0 AS DOUBLE) / total_rows, 2) AS null_rate_pct,
       coalesce(null_count * CAST(100.0 AS DOUBLE) / total_rows, 0.0) <= {D(R.max_null_rate_pct)} AS passed
FROM nr""",
        ),
        "geo_consolidated": _q(
            GEO_CONS, select=f"SELECT zip_code, geolocation_state, {_coord('lat')}, {_coord('lng')}, city FROM geo_cons"
        ),
        "geo_consolidated_bounded": _q(
            GEO_CONS, select=f"SELECT zip_code, geolocation_state, {_coord('lat')}, {_coord('lng')}, city FROM geo_cons"
        ),
        "geo_dedup_report": _q(
            GEO_CONS,
            select="""SELECT CAST(sum(n_rows) AS BIGINT) AS rows_before, count(*) AS rows_after,
       CAST(sum(n_rows) - count(*) AS BIGINT) AS rows_removed,
       round((sum(n_rows) - count(*)) * CAST(100.0 AS DOUBLE) / sum(n_rows), 1) AS pct_removed
FROM geo_cons""",
        ),
        "orders_customers": _q(OC, select="SELECT * FROM oc"),
        "bronze_enriched": _q(GEO_CONS, OC, BRONZE_C, select=_bronze_select("bronze_c")),
        "bronze_enriched_strict": _q(GEO_CONS, OC, BRONZE_S, select=_bronze_select("bronze_s")),
        "bronze_colocated": _q(GEO_CONS, OC, BRONZE_S, select=_bronze_select("bronze_s")),
        "bronze_lineage": _q(
            GEO_CONS,
            OC,
            BRONZE_S,
            select=f"SELECT order_id, '{R.lineage_tag}' AS data_source, true AS has_ingestion_time FROM bronze_s",
        ),
        "bronze_sample": _q(
            GEO_CONS,
            OC,
            BRONZE_S,
            select=f"""SELECT order_id, customer_id, order_status, customer_state, {_coord('lat')}, {_coord('lng')}
FROM bronze_s ORDER BY order_id LIMIT 20""",
        ),
        "geo_coverage": _q(
            GEO_CONS,
            OC,
            BRONZE_S,
            select="""SELECT count(*) AS bronze_rows, count(*) FILTER (WHERE lat IS NOT NULL) AS rows_with_geo,
       count(*) FILTER (WHERE lat IS NULL) AS rows_missing_geo FROM bronze_s""",
        ),
        "join_fanout": _q(
            GEO_CONS,
            OC,
            BRONZE_C,
            "per_order AS (SELECT order_id, count(*) AS n FROM bronze_c GROUP BY order_id)",
            select="""SELECT CAST(sum(n) AS BIGINT) AS bronze_rows, count(*) AS distinct_orders,
       CAST(sum(n) - count(*) AS BIGINT) AS surplus_rows, count(*) FILTER (WHERE n > 1) AS fanout_orders
FROM per_order""",
        ),
        "fix_timestamps": _q(TYPED_ORDERS, select=f"SELECT order_id, {ts_cols} FROM typed_orders"),
        "impute_geo": _q(
            GEO_CONS,
            OC,
            BRONZE_S,
            MEAN_S,
            f"""imputed_s AS (
  SELECT b.order_id, b.customer_state, coalesce(b.lat, m.m_lat) AS lat, coalesce(b.lng, m.m_lng) AS lng,
         coalesce(b.lat IS NULL AND m.m_lat IS NOT NULL, false) AS geo_imputed
  FROM bronze_s b LEFT JOIN mean_s m ON b.customer_state = m.customer_state)""",
            select=_geo_sql("geo_imputed, ", "imputed_s"),
        ),
        "impute_geo_compat": _q(
            GEO_CONS, OC, BRONZE_C, compat_impute, select=_geo_sql("geolocation_state, geo_imputed, ", "imputed_c")
        ),
        "null_reason": _q(
            TYPED_ORDERS,
            DERIVED_ORDERS,
            select="SELECT order_id, order_status, delivery_null_reason FROM derived_orders",
        ),
        "geo_outliers": _q(
            GEO_CONS,
            OC,
            BRONZE_S,
            select=f"""SELECT order_id, customer_state, {_coord('lat')}, {_coord('lng')}, city
FROM bronze_s WHERE coalesce({OOB}, false)""",
        ),
        "fix_geo_outliers": _q(
            GEO_CONS,
            OC,
            BRONZE_S,
            MEAN_S,
            f"""fixed_s AS (
  SELECT b.order_id, b.customer_state,
         CASE WHEN coalesce({OOB.replace('lat', 'b.lat').replace('lng', 'b.lng')}, false) THEN m.m_lat ELSE b.lat END AS lat,
         CASE WHEN coalesce({OOB.replace('lat', 'b.lat').replace('lng', 'b.lng')}, false) THEN m.m_lng ELSE b.lng END AS lng,
         coalesce({OOB.replace('lat', 'b.lat').replace('lng', 'b.lng')}, false) AS geo_repaired
  FROM bronze_s b LEFT JOIN mean_s m ON b.customer_state = m.customer_state)""",
            select=_geo_sql("geo_repaired, ", "fixed_s"),
        ),
        "fix_geo_outliers_compat": _q(
            GEO_CONS,
            OC,
            BRONZE_C,
            compat_impute,
            compat_fix,
            select=_geo_sql("geolocation_state, geo_imputed, ", "fixed_c"),
        ),
        "derived_columns": _q(
            TYPED_ORDERS,
            DERIVED_ORDERS,
            select="SELECT order_id, actual_delivery_days, delay_days, order_year, order_month FROM derived_orders",
        ),
        "speed_bucket": _q(
            TYPED_ORDERS,
            DERIVED_ORDERS,
            select="SELECT order_id, actual_delivery_days, delivery_speed_category FROM derived_orders",
        ),
        "cleaning_report": _q(
            *SILVER_CTES,
            select=f"""SELECT (SELECT count(*) FROM bronze_s) AS rows_before,
       (SELECT count(*) FILTER (WHERE lat IS NULL) FROM bronze_s) AS geo_null_before,
       (SELECT count(*) FILTER (WHERE coalesce({OOB}, false)) FROM bronze_s) AS geo_outliers_before,
       (SELECT count(*) FILTER (WHERE order_purchase_timestamp IS NOT NULL
                                 AND try_strptime(order_purchase_timestamp, '{TS}') IS NULL) FROM bronze_s)
            AS purchase_parse_failures,
       (SELECT count(*) FROM silver) AS rows_after,
       (SELECT count(*) FILTER (WHERE lat IS NULL) FROM silver) AS geo_null_after,
       (SELECT count(*) FILTER (WHERE coalesce({OOB}, false)) FROM silver) AS geo_outliers_after,
       (SELECT count(*) FILTER (WHERE order_approved_at IS NULL) FROM silver) AS approved_null_kept,
       (SELECT count(*) FILTER (WHERE geo_imputed) FROM silver) AS geo_imputed_rows""",
        ),
        "row_preservation": _q(
            *SILVER_CTES,
            select="""SELECT (SELECT count(*) FROM bronze_s) AS rows_before, (SELECT count(*) FROM silver) AS rows_after,
       (SELECT count(*) FROM bronze_s) = (SELECT count(*) FROM silver) AS preserved""",
        ),
        "quality_checks": _q(
            *SILVER_CTES,
            select=f"""SELECT check_name, violations, violations = 0 AS passed FROM (
  SELECT 'order_id_not_null' AS check_name, count(*) FILTER (WHERE order_id IS NULL) AS violations FROM silver
  UNION ALL SELECT 'customer_id_not_null', count(*) FILTER (WHERE customer_id IS NULL) FROM silver
  UNION ALL SELECT 'delivery_days_in_range', count(*) FILTER (WHERE actual_delivery_days IS NOT NULL
        AND (actual_delivery_days < 0 OR actual_delivery_days > {R.max_delivery_days})) FROM silver
  UNION ALL SELECT 'lat_in_bounds', count(*) FILTER (WHERE lat IS NOT NULL
        AND (lat < {D(R.lat_min)} OR lat > {D(R.lat_max)})) FROM silver
  UNION ALL SELECT 'lng_in_bounds', count(*) FILTER (WHERE lng IS NOT NULL
        AND (lng < {D(R.lng_min)} OR lng > {D(R.lng_max)})) FROM silver) t""",
        ),
        "silver_stats": _q(
            *SILVER_CTES,
            select=f"""SELECT count(*) AS total_orders,
       count(*) FILTER (WHERE order_status = '{R.delivered_status}') AS delivered_orders,
       round(count(*) FILTER (WHERE order_status = '{R.delivered_status}') / count(*) * 100, 1) AS delivered_pct,
       round(avg(actual_delivery_days), 1) AS avg_delivery_days,
       count(*) FILTER (WHERE delay_days > 0) AS late_orders,
       round(count(*) FILTER (WHERE delay_days > 0) / count(*) * 100, 1) AS late_pct
FROM silver""",
        ),
        "speed_distribution": _q(
            *SILVER_CTES,
            "sd AS (SELECT delivery_speed_category, count(*) AS orders FROM silver GROUP BY 1)",
            select="""SELECT delivery_speed_category, orders, round(orders / sum(orders) OVER () * 100, 1) AS share_pct
FROM sd ORDER BY orders DESC, delivery_speed_category""",
        ),
        "delivery_by_state": _q(*SILVER_CTES, KPI_STATE, select="SELECT * FROM kpi_state"),
        "top_slowest_states": _q(
            *SILVER_CTES,
            KPI_STATE,
            select="SELECT * FROM kpi_state ORDER BY avg_delivery_days DESC NULLS LAST, customer_state LIMIT 5",
        ),
        "top_fastest_states": _q(
            *SILVER_CTES,
            KPI_STATE,
            select="SELECT * FROM kpi_state ORDER BY avg_delivery_days ASC NULLS LAST, customer_state LIMIT 5",
        ),
        "monthly_trend": _q(*SILVER_CTES, KPI_TREND, select="SELECT * FROM kpi_trend ORDER BY 1, 2"),
        "monthly_trend_recent": _q(
            *SILVER_CTES,
            KPI_TREND,
            select=f"SELECT * FROM kpi_trend WHERE order_year >= {RECENT_FROM_YEAR} ORDER BY 1, 2",
        ),
        "late_severity": _q(*SILVER_CTES, LATE, select="SELECT * FROM kpi_late ORDER BY avg_delay_days"),
        "late_by_state_severity": _q(*SILVER_CTES, LATE, select="SELECT * FROM late_state"),
        "top_late_state_severity": _q(
            *SILVER_CTES,
            LATE,
            select="""SELECT * FROM late_state
ORDER BY late_orders DESC, customer_state NULLS LAST, delay_severity LIMIT 10""",
        ),
        "executive_summary": _q(*SILVER_CTES, KPI_STATE, KPI_TREND, SUMMARY, select="SELECT * FROM summary"),
        "executive_summary_text": _q(
            *SILVER_CTES, KPI_STATE, KPI_TREND, SUMMARY, select="SELECT metric, value FROM summary_text"
        ),
        "summary_metric": _q(
            *SILVER_CTES,
            KPI_STATE,
            KPI_TREND,
            SUMMARY,
            f"wanted AS (SELECT * FROM (VALUES {metrics}) AS w(metric))",
            select="""SELECT w.metric, coalesce(s.value, 'N/A') AS value
FROM wanted w LEFT JOIN summary_text s ON w.metric = s.metric""",
        ),
        "peak_month": _q(
            *SILVER_CTES,
            KPI_TREND,
            select="""SELECT order_year, order_month, total_orders,
       CAST(order_year AS VARCHAR) || '-' || lpad(CAST(order_month AS VARCHAR), 2, '0') AS month_label
FROM kpi_trend ORDER BY total_orders DESC, order_year, order_month LIMIT 1""",
        ),
        "trend_chart_data": _q(
            *SILVER_CTES,
            KPI_TREND,
            f"tc AS (SELECT * FROM kpi_trend WHERE order_year IN ({years}) AND total_orders > {MIN_ORDERS})",
            select="""SELECT CAST(order_year AS VARCHAR) || '-' || lpad(CAST(order_month AS VARCHAR), 2, '0') AS month_label,
       order_year, order_month, total_orders, late_rate_pct,
       total_orders = max(total_orders) OVER () AS is_peak
FROM tc ORDER BY order_year, order_month""",
        ),
        "late_rate_ranked": _q(
            *SILVER_CTES,
            KPI_STATE,
            f"lr AS (SELECT * FROM kpi_state WHERE total_orders >= {MIN_ORDERS})",
            select=f"""SELECT customer_state, total_orders, late_rate_pct,
       CASE {bands} ELSE '{R.late_rate_band_else}' END AS late_rate_band,
       round(avg(late_rate_pct) OVER (), 1) AS mean_late_rate_pct
FROM lr ORDER BY late_rate_pct, customer_state""",
        ),
        "state_scorecard": _q(
            *SILVER_CTES,
            KPI_STATE,
            select=scorecard + " FROM kpi_state ORDER BY avg_days DESC NULLS LAST, state",
        ),
        "state_scorecard_selected": _q(
            *SILVER_CTES,
            KPI_STATE,
            select=scorecard + f" FROM kpi_state WHERE customer_state IN {SCORECARD_STATES!r} ORDER BY avg_days DESC, state",
        ),
        "silver_orders": _q(*SILVER_CTES, select=_silver_select("silver")),
        "silver_orders_compat": _q(*compat_silver, select=_silver_select("silver")),
        "delivery_by_state_compat": _q(*compat_silver, KPI_STATE, select="SELECT * FROM kpi_state"),
        "delivery_by_state_approx": _q(*SILVER_CTES, KPI_STATE, select="SELECT * FROM kpi_state"),
        "monthly_trend_compat": _q(*compat_silver, KPI_TREND, select="SELECT * FROM kpi_trend"),
        "late_severity_compat": _q(*compat_silver, LATE, select="SELECT * FROM kpi_late"),
        "executive_summary_compat": _q(*compat_silver, KPI_STATE, KPI_TREND, SUMMARY, select="SELECT * FROM summary"),
        "join_contract_mismatch": _q(
            select=f"""SELECT '{ORDERS_VS_CUSTOMERS.name}' AS contract, '{ORDERS_VS_CUSTOMERS.description}' AS description,
       false AS can_join,
       'key type mismatch: left ''customer_id'' is string, right ''customer_id'' is bigint' AS issues,
       (SELECT count(DISTINCT customer_id) FROM src_orders) AS left_unique_keys,
       (SELECT count(DISTINCT customer_zip_code_prefix) FROM src_customers) AS right_unique_keys,
       CAST(0 AS BIGINT) AS matching_keys, (SELECT count(DISTINCT customer_id) FROM src_orders) AS left_keys_no_match,
       '0.0%' AS match_rate, CAST(0 AS DOUBLE) AS match_rate_pct
UNION ALL SELECT '{ORDERS_VS_CUSTOMERS.name}', '{ORDERS_VS_CUSTOMERS.description}', false,
       'right table lacks join key ''customer_id''', NULL, NULL, NULL, NULL, NULL, NULL"""
        ),
        "failing_checks": _q(
            *SILVER_CTES,
            select=f"""SELECT check_name, violations, violations = 0 AS passed FROM (
  SELECT 'order_id_not_null' AS check_name,
         count(*) FILTER (WHERE order_status IS DISTINCT FROM 'delivered' OR order_id IS NULL) AS violations FROM silver
  UNION ALL SELECT 'customer_id_not_null', count(*) FILTER (WHERE customer_id IS NULL) FROM silver
  UNION ALL SELECT 'delivery_days_in_range', count(*) FILTER (WHERE actual_delivery_days IS NOT NULL
        AND (actual_delivery_days + 400 < 0 OR actual_delivery_days + 400 > 365)) FROM silver
  UNION ALL SELECT 'lat_in_bounds', count(*) FILTER (WHERE lat IS NOT NULL AND (lat + 100 < -34 OR lat + 100 > 6)) FROM silver
  UNION ALL SELECT 'lng_in_bounds', count(*) FILTER (WHERE lng IS NOT NULL
        AND (lng + 100 < -74 OR lng + 100 > -28)) FROM silver) t""",
        ),
        "median_by_sketch": _q(
            *SILVER_CTES,
            select=f"""SELECT customer_state, count(*) AS known_orders,
       CAST(quantile_disc(actual_delivery_days, 0.5) AS INTEGER) AS median_delivery_days, true AS within_bound
FROM silver WHERE order_status = '{R.delivered_status}' AND actual_delivery_days IS NOT NULL GROUP BY 1""",
        ),
        "key_overlap_sketch": _q(
            oc_cte,
            cg_cte2,
            select=" UNION ALL ".join(
                f"""SELECT '{c.name}' AS contract, left_unique_keys, right_unique_keys, matching_keys,
       matching_keys AS matching_low, matching_keys AS matching_high, left_keys_no_match,
       left_keys_no_match AS no_match_low, left_keys_no_match AS no_match_high FROM {stats}"""
                for c, stats in ((ORDERS_VS_CUSTOMERS, "stats"), (CUSTOMERS_VS_GEOLOCATION, "stats2"))
            ),
        ),
        "unmatched_keys_filtered": _keys_sql(anti=True),
        "schema_findings_failing": _q(select=_failing_findings_sql()),
        "harmonize_and_recheck": _q(
            oc_cte,
            select="""SELECT 'before' AS stage, false AS can_join,
       'key type mismatch: left ''customer_id'' is string, right ''customer_id'' is bigint' AS issues,
       left_unique_keys, right_unique_keys, CAST(0 AS BIGINT) AS matching_keys FROM stats
UNION ALL SELECT 'after', true, '', left_unique_keys, right_unique_keys, matching_keys FROM stats""",
        ),
        "run_audit": _q(
            GEO_CONS,
            OC,
            BRONZE_S,
            """steps AS (
  SELECT 'ingest' AS step, (SELECT count(*) FROM src_orders) + (SELECT count(*) FROM src_customers)
                           + (SELECT count(*) FROM src_geolocation) AS rows
  UNION ALL SELECT 'validate', NULL
  UNION ALL SELECT 'bronze', (SELECT count(*) FROM bronze_s)
  UNION ALL SELECT 'silver', (SELECT count(*) FROM bronze_s)
  UNION ALL SELECT 'gold', NULL
)""",
            select="""SELECT 'run-1' AS run_id, step, 'ran' AS status, rows FROM steps
UNION ALL SELECT 'run-2', step, 'skipped', rows FROM steps""",
        ),
        "silver_incremental": _q(*SILVER_CTES, select=_silver_select("silver")),
        "silver_clustered": _q(*SILVER_CTES, select=_silver_select("silver")),
        "silver_changed_months": _q(
            *SILVER_CTES,
            select=f"""SELECT order_year, order_month,
       count(*) FILTER (WHERE order_purchase_timestamp <= TIMESTAMP '{CUTOFF}') AS rows_before, count(*) AS rows_after
FROM silver GROUP BY 1, 2
HAVING count(*) FILTER (WHERE order_purchase_timestamp > TIMESTAMP '{CUTOFF}'
                           OR order_approved_at > TIMESTAMP '{CUTOFF}'
                           OR order_delivered_carrier_date > TIMESTAMP '{CUTOFF}'
                           OR order_delivered_customer_date > TIMESTAMP '{CUTOFF}') > 0""",
        ),
        "delivery_by_state_incremental": _q(*SILVER_CTES, KPI_STATE, select="SELECT * FROM kpi_state"),
        "executive_summary_incremental": _q(
            *SILVER_CTES, KPI_STATE, KPI_TREND, SUMMARY, select="SELECT * FROM summary"
        ),
        "state_list": _q(
            *SILVER_CTES,
            KPI_STATE,
            select="SELECT DISTINCT customer_state FROM kpi_state WHERE customer_state IS NOT NULL ORDER BY 1",
        ),
        "late_summary": _q(
            *SILVER_CTES,
            LATE,
            select=f"""SELECT CAST(sum(num_orders) AS BIGINT) AS total_late_orders,
       CAST(coalesce(sum(num_orders) FILTER (WHERE delay_severity = '{R.severity_over}'), 0) AS BIGINT) AS critical_orders,
       max(max_delay_days) FILTER (WHERE delay_severity = '{R.severity_over}') AS critical_max_delay_days
FROM kpi_late""",
        ),
    }
    return q

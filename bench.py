"""Benchmark: the layered pipeline plus headline queries on the adapter tables.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
``value`` is the end-to-end pipeline time (bronze + silver + gold, each layer
written to storage and read back by the next), the span that the published
baseline measures for its bronze, silver and gold steps.  The pipeline runs
BENCH_REPEATS times (default 3) without a warm-up: ``value`` is the median,
and the cold first run, the best run and all step times are listed, with input
and output rows.  Ingest and validate are timed as well; they are not part of
``value``.  Each query is run to completion with the ``noop`` sink, so nothing
is collected to the driver.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))

# over 1,199,045 input rows (run A).
BASELINE_STEPS_SEC = 7.97 + 4.52 + 4.70
BASELINE_INPUT_ROWS = 1_199_045

HEADLINE = (
    "delivery_by_state",
    "monthly_trend",
    "late_severity",
    "executive_summary",
    "geo_consolidated",
    "bronze_enriched_strict",
    "join_contract_orders_customers",
    "quality_checks",
    "fix_geo_outliers_compat",
    "speed_distribution",
)


def _sf_value(path: str):
    m = re.search(r"sf([0-9.]+)$", path)
    return float(m.group(1)) if m else path


def main() -> None:
    t0 = time.perf_counter()
    from haulage.plans.catalog import QUERIES
    from haulage.plans.pipeline import Pipeline
    from haulage.session import build_session
    from haulage.sources.testdata import source_frames

    spark = build_session(f"local[{CPUS}]", app_name="haulage-bench", shuffle_partitions=CPUS)
    session_start = time.perf_counter() - t0

    input_rows = {
        t: spark.read.parquet(f"{SF_DIR}/{t}.parquet").count() for t in ("orders", "customer", "lineitem")
    }

    out = tempfile.mkdtemp(prefix="haulage-bench-", dir=os.environ.get("BENCH_SCRATCH"))
    runs = []
    for i in range(REPEATS):
        pipe = Pipeline(spark, source_frames(spark, SF_DIR), f"{out}/run{i}", gold_csv=True)
        audit = {a.step: a for a in pipe.run("all")}
        seconds = {k: round(a.seconds, 3) for k, a in audit.items()}
        runs.append((round(sum(seconds[k] for k in ("bronze", "silver", "gold")), 3), seconds))
        output_rows = {k: audit[k].rows for k in ("bronze", "silver")}
    totals = [t for t, _ in runs]
    pipeline_total = round(statistics.median_low(totals), 3)
    steps = next(s for t, s in runs if t == pipeline_total)

    queries = {}
    for name in HEADLINE:
        q0 = time.perf_counter()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        queries[name] = round(time.perf_counter() - q0, 3)

    total_in = sum(input_rows.values())
    result = {
        "metric": "pipeline_bronze_silver_gold",
        "value": pipeline_total,
        "unit": "sec",
        "queries": {**{f"step_{k}": v for k, v in steps.items()}, **queries},
        "sf": _sf_value(SF_DIR),
        "cpus": CPUS,
        "input_rows": total_in,
        "rows_per_sec": round(total_in / pipeline_total, 1) if pipeline_total else None,
        "baseline_steps_sec": round(BASELINE_STEPS_SEC, 2),
        "baseline_rows_per_sec": round(BASELINE_INPUT_ROWS / BASELINE_STEPS_SEC, 1),
        "input_rows_by_table": input_rows,
        "output_rows": output_rows,
        "cold_run_sec": totals[0],
        "best_run_sec": min(totals),
        "pipeline_runs_sec": totals,
        "ingest_and_validate_sec": round(steps["ingest"] + steps["validate"], 3),
        "sec_per_million_input_rows": round(pipeline_total / total_in * 1e6, 2),
        "baseline_sec_per_million_input_rows": round(BASELINE_STEPS_SEC / BASELINE_INPUT_ROWS * 1e6, 2),
        "session_start_sec": round(session_start, 3),
        "queries_total_sec": round(sum(queries.values()), 3),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()

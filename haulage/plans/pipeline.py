"""The layered pipeline: ingest -> validate -> bronze -> silver -> gold.

Each layer is written once and the next layer reads the written table, so
every step starts from storage (lineage is cut at each layer; a lost executor
re-runs only the current step).  Row counts for the audit and the counts that
the quality gate judges come from ``Observation`` metrics collected during the
writes, not from extra scans.

Bronze and silver are written staged and published by renames
(``haulage.sinks.publish``), and each step leaves a manifest and an audit row
below ``<out>/_runs`` (``haulage.plans.runlog``): a run skips the steps that an
earlier run, also of another session, completed from the same inputs.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from haulage.operators import bronze as B
from haulage.operators import contracts as C
from haulage.operators import gold as G
from haulage.operators import silver as S
from haulage.rules import DEFAULT_RULES, Rules
from haulage.schemas import CUSTOMERS_VS_GEOLOCATION, ORDERS_VS_CUSTOMERS, SOURCE_SPECS, TIMESTAMP_COLUMNS
from haulage.sinks import publish_checked, publish_table, recover, write_csv_export, write_gold, write_layer
from haulage.sources.profile import profile
from haulage.plans.incremental import refresh_cube, refresh_silver
from haulage.plans.materialise import materialise, scratch
from haulage.plans.runlog import RunLog, digest, frame_fingerprint
from haulage.sources.readers import Connection, connect_checked, require_paths

STEPS = ("ingest", "validate", "bronze", "silver", "gold")
# Which sources each step reads (a step checks only what it needs).
STEP_INPUTS = {
    "ingest": ("orders", "customers", "geolocation"),
    "validate": ("orders", "customers", "geolocation"),
    "bronze": ("orders", "customers", "geolocation"),
    "silver": (),
    "gold": (),
}


@dataclass
class StepAudit:
    step: str
    rows: int | None
    seconds: float
    detail: dict = field(default_factory=dict)
    status: str = "ran"


@dataclass
class LayerPaths:
    base: str

    @property
    def bronze(self) -> str:
        return f"{self.base}/bronze/orders_enriched"

    @property
    def silver(self) -> str:
        return f"{self.base}/silver/orders_cleaned"

    @property
    def cube(self) -> str:
        return f"{self.base}/gold/_order_cube"

    def quarantine(self, source: str) -> str:
        return f"{self.base}/quarantine/{source}"

    def gold(self, name: str) -> str:
        return f"{self.base}/gold/{name}"


class Pipeline:
    """``Pipeline(spark, sources, out_dir).run(["bronze", "silver", "gold"])``.

    ``sources`` maps source names to DataFrames (already read with their
    declared schemas, e.g. by ``haulage.sources.readers.connect``).
    """

    def __init__(
        self,
        spark: SparkSession,
        sources: dict[str, DataFrame] | None,
        out_dir: str,
        rules: Rules = DEFAULT_RULES,
        mode: str = "strict",
        gold_csv: bool = True,
        max_concurrent_jobs: int = 4,
        exact_contracts: bool = True,
        run_id: str | None = None,
        incremental: bool = False,
    ):
        self.spark = spark
        self.sources = sources or {}
        self.paths = LayerPaths(out_dir.rstrip("/"))
        self.rules = rules
        self.mode = mode
        self.gold_csv = gold_csv
        self.max_concurrent_jobs = max_concurrent_jobs
        # False: key statistics from sketches (no key shuffle) for very large sources.
        self.exact_contracts = exact_contracts
        # True: silver rewrites only the months that changed, gold adds their deltas to a stored cube.
        self.incremental = incremental
        # Set by ``from_csv``: the checked connections behind ``sources``.
        self.connections: dict[str, Connection] = {}
        self.audit: list[StepAudit] = []
        self.log = RunLog(spark, self.paths.base, run_id)
        self._prints: dict[str, str] = {}

    @classmethod
    def from_csv(
        cls,
        spark: SparkSession,
        paths: dict[str, str] | None,
        out_dir: str,
        steps=STEPS,
        null_value: str | None = None,
        base_dir: str = ".",
        **kwargs,
    ) -> "Pipeline":
        """Pipeline over CSV sources; one without a path is looked for at its default place below ``base_dir``.

        Pre-flight checks only the files the requested steps read (a gold-only
        run needs none); each source is opened through ``connect`` (declared
        schema, header check, required columns).  Rows that do not fit the
        schema are not loaded; ``ingest`` writes them to the quarantine folder
        and counts them per source.
        """
        steps = list(STEPS) if steps in ("all", None) else [steps] if isinstance(steps, str) else list(steps)
        needed = sorted({n for s in steps for n in STEP_INPUTS.get(s, ())})
        paths = {n: (paths or {}).get(n) or SOURCE_SPECS[n].default_path(base_dir) for n in needed}
        require_paths(spark, {n: paths[n] for n in needed})
        connections = {n: connect_checked(spark, n, paths[n], null_value=null_value) for n in needed}
        pipe = cls(spark, {n: c.rows for n, c in connections.items()}, out_dir, **kwargs)
        pipe.connections = connections
        return pipe

    # ------------------------------------------------------------------ steps
    def ingest(self) -> dict:
        """Rows, columns and elapsed seconds per source (one count each)."""
        sources = {}
        for name, df in self._need("ingest").items():
            t0 = time.perf_counter()
            n = profile({name: df}).collect()[0]
            sources[name] = {"rows": n["rows"], "cols": n["cols"], "seconds": round(time.perf_counter() - t0, 3)}
        detail = {"rows": sum(v["rows"] for v in sources.values()), "sources": sources}
        if self.connections:
            detail["quarantined"], detail["warnings"] = {}, {}
            for name, connection in self.connections.items():
                obs = Observation(f"quarantine {name}")
                write_layer(
                    connection.quarantine.observe(obs, F.count(F.lit(1)).alias("rows")), self.paths.quarantine(name)
                )
                detail["quarantined"][name] = obs.get["rows"]
                detail["warnings"][name] = connection.warnings()
        return detail

    def validate(self) -> dict:
        src = self._need("validate")
        reports = C.require_contracts(
            [
                (src["orders"], src["customers"], ORDERS_VS_CUSTOMERS),
                (src["customers"], src["geolocation"], CUSTOMERS_VS_GEOLOCATION),
            ],
            exact=self.exact_contracts,
        )
        return {"rows": None, "reports": reports}

    def bronze(self) -> dict:
        src = self._need("bronze")
        geo = materialise(B.consolidate_geo(src["geolocation"]), "geo")
        df = B.build_bronze(
            src["orders"], src["customers"], src["geolocation"], self.mode, self.rules, geo_consolidated=geo
        )
        return {"rows": publish_table(df, self.paths.bronze)["rows"]}

    def silver(self) -> dict:
        # Two reads of bronze in either mode: its coordinates counted by state, and the one pass that is checked while it is written.
        bronze = self.spark.read.parquet(self.paths.bronze)
        strict = self.mode == "strict"
        counts = materialise(S.coordinate_counts(bronze), "coordinate-counts")
        means = materialise(S.state_means(counts, self.rules, in_bounds_only=strict), "state-means")
        repair = None if strict else materialise(S.repair_means(counts, means, self.rules), "repair-means")
        if self.incremental:
            done = refresh_silver(
                S.build_silver(bronze, self.rules, self.mode, means, repair), self.paths.silver, self.rules, strict
            )
            return {"rows": done.rows, "checks": done.checks, "changed_months": done.changed, "months": done.months}
        unparsed = {f"_unparsed_{c}": bad for c, bad in S.parse_failures(TIMESTAMP_COLUMNS, self.rules, self.mode).items()}
        checks, seen = publish_checked(
            S.build_silver(bronze.withColumns(unparsed), self.rules, self.mode, means, repair),
            self.paths.silver,
            self.rules,
            strict=strict,
            metrics=[F.count_if(c).alias(c) for c in unparsed],
            drop=list(unparsed),
        )
        failures = {c: seen[f"_unparsed_{c}"] for c in TIMESTAMP_COLUMNS}
        return {"rows": seen["rows"], "checks": checks, "timestamp_parse_failures": failures}

    def gold(self) -> dict:
        # Silver is read once, for the counts that all KPIs are computed from; incrementally, only its changed months are.
        taken = {}
        if self.incremental:
            taken["changed_months"] = refresh_cube(self.spark, self.paths.silver, self.paths.cube)
            cube = self.spark.read.parquet(self.paths.cube)
        else:
            cube = materialise(G.order_cube(self.spark.read.parquet(self.paths.silver)), "order-cube")
        tables = G.build_gold(cube, self.rules)
        orders = {
            "kpi_delivery_by_state": G.STATE_ORDER,
            "kpi_monthly_trend": G.TREND_ORDER,
            "kpi_late_orders": G.SEVERITY_ORDER,
        }
        # The three KPI tables and the summary totals are independent jobs over
        # the cube; they are submitted together so their (often narrow) stages
        # share the cores.  The totals are one row.
        totals_df = G.summary_totals(cube, self.rules)
        totals: list = []
        self._concurrently(
            [
                (lambda n=name, o=sort_by: write_gold(tables[n], self.paths.gold(n), csv=self.gold_csv, sort_by=o))
                for name, sort_by in orders.items()
            ]
            + [lambda: totals.extend(totals_df.collect())]
        )
        # The summary reads KPI 1 and 2 back instead of recomputing them.
        by_state = self.spark.read.parquet(self.paths.gold("kpi_delivery_by_state"))
        trend = self.spark.read.parquet(self.paths.gold("kpi_monthly_trend"))
        summary = G.combine_summary(
            self.spark.createDataFrame(totals, totals_df.schema),
            G.summary_extremes(by_state),
            G.summary_peak(trend),
        )
        write_gold(summary, self.paths.gold("executive_summary"), csv=False)
        text = G.format_summary(self.spark.read.parquet(self.paths.gold("executive_summary")))
        if self.gold_csv:
            write_csv_export(text, self.paths.gold("executive_summary_text") + "_csv")
        else:
            write_layer(text, self.paths.gold("executive_summary_text"))
        return {"rows": None, "tables": [*tables, "executive_summary", "executive_summary_text"], **taken}

    def _concurrently(self, actions) -> None:
        if self.max_concurrent_jobs <= 1:
            for act in actions:
                act()
            return
        # Worker threads inherit the caller's job group, description and
        # scheduler pool, so cancelling or tracing the step covers their jobs.
        wrap = inheritable_thread_target(self.spark)
        if not callable(wrap):  # pinned-thread mode off: nothing to inherit
            wrap = lambda act: act
        with ThreadPoolExecutor(max_workers=self.max_concurrent_jobs) as pool:
            for fut in [pool.submit(wrap(act)) for act in actions]:
                fut.result()

    # ---------------------------------------------------------------- driver
    def _outputs(self, step: str) -> list[str]:
        """The tables that a step leaves behind."""
        if step == "bronze":
            return [self.paths.bronze]
        if step == "silver":
            return [self.paths.silver]
        if step == "ingest":
            return [self.paths.quarantine(n) for n in sorted(self.connections)]
        if step == "gold":
            names = ["kpi_delivery_by_state", "kpi_monthly_trend", "kpi_late_orders"]
            names += [f"{n}_csv" for n in names] if self.gold_csv else []
            text = "executive_summary_text" + ("_csv" if self.gold_csv else "")
            return [self.paths.gold(n) for n in [*names, "executive_summary", text]]
        return []

    def _fingerprint(self, step: str) -> str:
        """What a step's result depends on: its inputs as they are now, the rules and the options."""
        below = {"silver": self.paths.bronze, "gold": self.paths.silver}
        if step in below:
            inputs = self.log.store.fingerprint(below[step])
        else:
            inputs = {n: self._source_print(n) for n in sorted(self._need(step))}
        options = {"mode": self.mode, "gold_csv": self.gold_csv, "exact_contracts": self.exact_contracts}
        return digest(step, inputs, self.log.settings(self.rules, **options))

    def _source_print(self, name: str) -> str:
        """A source's fingerprint, taken once a run."""
        if name not in self._prints:
            self._prints[name] = frame_fingerprint(self.log.store, self.sources[name])
        return self._prints[name]

    def run(self, steps=STEPS, force: bool = False) -> list[StepAudit]:
        """Run the steps in order; those completed before from the same inputs are skipped unless ``force``."""
        steps = list(STEPS) if steps in ("all", None) else [steps] if isinstance(steps, str) else list(steps)
        unknown = [s for s in steps if s not in STEPS]
        if unknown:
            raise ValueError(f"unknown steps {unknown}; choose from {STEPS}")
        self._prints = {}
        for step in steps:
            started, t0 = time.time(), time.perf_counter()
            for table in self._outputs(step) if step in ("bronze", "silver") else ():
                recover(self.spark, table)
            fingerprint = self._fingerprint(step)
            done = None if force else self.log.completed(step, fingerprint)
            if done:
                entry = StepAudit(step, done["rows"], time.perf_counter() - t0, done["detail"], "skipped")
            else:
                try:
                    with scratch(self.spark):
                        detail = getattr(self, step)()
                except Exception as e:
                    failure = {"error": f"{type(e).__name__}: {e}"[:2000]}
                    self.log.record(step, "failed", None, time.perf_counter() - t0, started, fingerprint, failure)
                    raise
                entry = StepAudit(step, detail.pop("rows", None), time.perf_counter() - t0, detail)
                self.log.complete(step, fingerprint, self._outputs(step), entry.rows, detail)
            self.log.record(step, entry.status, entry.rows, entry.seconds, started, fingerprint, entry.detail)
            self.audit.append(entry)
        return self.audit

    def audit_history(self) -> DataFrame:
        """The stored audit: one row for each step of every run into this folder, of any session."""
        return self.log.history()

    def audit_frame(self) -> DataFrame:
        rows = [(a.step, a.rows, float(a.seconds)) for a in self.audit]
        return self.spark.createDataFrame(rows, "step string, rows bigint, seconds double")

    def _need(self, step: str) -> dict[str, DataFrame]:
        missing = [n for n in STEP_INPUTS[step] if n not in self.sources]
        if missing:
            raise FileNotFoundError(f"step {step!r} needs sources {missing}")
        return self.sources

"""Command line: run pipeline steps over CSV sources.

    python -m haulage --step all --orders o.csv --customers c.csv \\
        --geolocation g.csv --out s3a://bucket/logistics

Steps: ingest, validate, bronze, silver, gold, all (or a comma list).  Only
the sources the chosen steps read must be given and must exist.  Steps that an
earlier run completed from the same inputs are skipped (``--force`` runs them
again).  Prints the step audit as JSON lines; exits 1 when a contract or the
quality gate fails or a source is missing.
"""

from __future__ import annotations

import argparse
import json
import sys

from haulage.operators.contracts import ContractError
from haulage.operators.quality import QualityGateError
from haulage.plans.pipeline import STEPS, Pipeline


def parse_args(argv=None) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="haulage", description=__doc__.split("\n\n")[0])
    ap.add_argument("--step", default="all", help="one of %s, 'all', or a comma list" % ", ".join(STEPS))
    ap.add_argument("--orders")
    ap.add_argument("--customers")
    ap.add_argument("--geolocation")
    ap.add_argument("--base", default=".", help="folder below which sources without a path are found (data_source/<name>.csv)")
    ap.add_argument("--out", required=True, help="base directory of the bronze/silver/gold layers")
    ap.add_argument("--mode", choices=("strict", "compat"), default="strict")
    ap.add_argument("--null-value", default=None, help="extra text treated as NULL in CSV sources")
    ap.add_argument("--no-csv", action="store_true", help="write gold as Parquet only")
    ap.add_argument("--incremental", action="store_true", help="rewrite only the silver months that changed; KPIs from deltas")
    ap.add_argument("--force", action="store_true", help="run steps that an earlier run completed as well")
    ap.add_argument("--master", default=None, help="Spark master (default: from the environment)")
    return ap.parse_args(argv)


def main(argv=None, spark=None) -> int:
    args = parse_args(argv)
    steps = list(STEPS) if args.step == "all" else [s.strip() for s in args.step.split(",") if s.strip()]
    if spark is None:
        from haulage.session import build_session

        spark = build_session(args.master, app_name="haulage")
    paths = {n: getattr(args, n) for n in ("orders", "customers", "geolocation") if getattr(args, n)}
    try:
        pipe = Pipeline.from_csv(
            spark, paths, args.out, steps=steps, null_value=args.null_value, base_dir=args.base, mode=args.mode,
            gold_csv=not args.no_csv, incremental=args.incremental,
        )
        for a in pipe.run(steps, force=args.force):
            print(json.dumps({"step": a.step, "status": a.status, "rows": a.rows, "seconds": round(a.seconds, 3)}))
    except (FileNotFoundError, ContractError, QualityGateError, ValueError) as e:
        print(f"haulage: {type(e).__name__}: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())

"""haulage: order-logistics analytics as lazy Spark DataFrame operators.

Layers: sources (read + contract checks) -> bronze (consolidate geo, enrich)
-> silver (typed, cleaned, derived, quality-gated) -> gold (KPI tables)
-> marts (report-feeding datasets).  Every operator is a ``DataFrame ->
DataFrame`` function built from Spark's own functions only.

    from haulage import Pipeline, build_session
    spark = build_session()
    Pipeline.from_csv(spark, {"orders": ..., "customers": ..., "geolocation": ...}, out_dir).run("all")
"""

from haulage.rules import DEFAULT_RULES, Rules

__version__ = "0.1.0"


def __getattr__(name):
    # Lazy re-exports keep ``import haulage`` cheap (no Spark import needed).
    if name == "Pipeline":
        from haulage.plans.pipeline import Pipeline

        return Pipeline
    if name == "build_session":
        from haulage.session import build_session

        return build_session
    if name in ("bronze", "silver", "gold", "marts", "quality", "contracts"):
        import importlib

        return importlib.import_module(f"haulage.operators.{name}")
    raise AttributeError(name)


__all__ = ["Rules", "DEFAULT_RULES", "Pipeline", "build_session", "bronze", "silver", "gold", "marts", "quality", "contracts"]

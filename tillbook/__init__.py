"""tillbook: settlement-to-bank cash reconciliation as Spark DataFrame jobs.

Layers: ``sources`` (landing, adapters, seeds, macro feeds) -> ``operators``
(calendar, settlement, matcher, marts, queue, history, quality, ops) ->
``plans`` (the daily build, its job form and its DuckDB oracle).
``functions`` holds the Column-expression helpers shared by all of them;
``streaming`` the optional incremental landing of bank movements.

    from tillbook import Pipeline, run, daily_build, Policy
"""

from tillbook.policy import Policy

__all__ = ["Policy", "Pipeline", "run", "daily_build", "land_bronze"]


def __getattr__(name):  # keep `import tillbook` light; load the plans on first use
    if name in ("Pipeline", "run"):
        from tillbook.plans import pipeline
        return getattr(pipeline, name)
    if name in ("daily_build", "land_bronze"):
        from tillbook.plans import build
        return getattr(build, name)
    raise AttributeError(name)

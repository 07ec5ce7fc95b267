"""The daily build as one job: write, audit, publish.

Every model is written below the run's own folder, where no reader looks, in
dependency order; what needs a failed model is skipped. The checks then run on
the written rows. Only if no model failed and no error-severity check found
rows is the run published, by one append that switches all readers
(``plans.publish``); otherwise ``BuildFailed`` is raised and readers stay with
the run before. Rows behind failed checks are kept in the run folder for
triage. The queue is merged with the published one, so a run that isn't
published leaves no state in it, and so is the merchant snapshot of a build
from Bronze. One telemetry row per node (model or check) is appended at the
end of the run, stamped with the end-of-run time, which is why run health lags
one run behind.
"""

from __future__ import annotations

import time
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tillbook.operators import audit, history, ops
from tillbook.operators import quality as Q
from tillbook.plans import checks, publish
from tillbook.plans.models import BOUND, MODELS
from tillbook.plans.pipeline import Pipeline
from tillbook.policy import Policy
from tillbook.sources import layout, seeds

SNAPSHOT = ("silver", "dim_merchant_snapshot")


class StaleSourceError(RuntimeError):
    pass


class BuildFailed(RuntimeError):
    """A model failed or an error-severity check found rows; ``results`` holds every node, and nothing was published."""

    def __init__(self, results: list[dict]):
        self.results = results
        self.failed = [r["node_name"] for r in results if r["status"] in ("error", "fail")]
        super().__init__(f"failed nodes: {self.failed}")


def freshness_gate(p: Pipeline) -> list:
    """Before the build: any operational source past its error threshold stops the run."""
    names = ["merchants", "transactions", "settlement_batches", "bank_movements", "reserve_events",
             "returns_adjustments"]
    rows = Q.source_freshness({n: p.bronze(n) for n in names}, p.now).collect()
    stale = [r.source for r in rows if r.status == "error"]
    if stale:
        raise StaleSourceError(f"sources past their freshness error threshold: {stale}")
    return rows


def policy_from(spark: SparkSession, assumptions_path: str | None) -> Policy:
    """The policy with thresholds and rates from the seed file, or as declared without one."""
    if not assumptions_path:
        return Policy()
    return Policy.from_assumptions(seeds.read_seed(spark, assumptions_path, seeds.ASSUMPTIONS_SEED_SCHEMA))


class _Run:
    """One run's folder: writes models, keeps their results, and hands the written rows on."""

    def __init__(self, p: Pipeline, out_dir: str):
        self.p, self.out_dir = p, out_dir
        self.paths: dict[tuple[str, str], str] = {}
        self.results: list[dict] = []
        self.lost: set[str] = set()

    def stage(self, layer: str, name: str, build) -> None:
        t0 = time.perf_counter()
        rows, status, message = None, "success", ""
        try:
            path = publish.staged_path(self.out_dir, self.p.run_id, layer, name)
            layout.write(build(), path, name)
            rows = self.read(path, name).count()
            self.paths[layer, name] = path
        except Exception as exc:  # a failed node is logged, models that don't need it go on
            status, message = "error", str(exc)
            self.lost.add(name)
        self.note(name, "model", status, rows, message, time.perf_counter() - t0)

    def skip(self, name: str, because: list[str]) -> None:
        self.lost.add(name)
        self.note(name, "model", "skipped", None, f"needs {', '.join(because)}", 0.0)

    def note(self, name: str, kind: str, status: str, rows, message: str, seconds: float) -> None:
        self.results.append({"node_name": name, "node_resource_type": kind, "status": status, "execution_time_seconds": seconds,
                             "rows_affected": rows, "message": message})

    def read(self, path: str, name: str) -> DataFrame:
        return layout.read(self.p.spark, path, name)

    def written(self, name: str) -> DataFrame:
        return self.read(next(path for (_, model), path in self.paths.items() if model == name), name)

    def broken(self) -> bool:
        return any(r["status"] in ("error", "fail") for r in self.results)


def _stage_models(run: _Run) -> None:
    for model in MODELS:
        missing = [n for n in model.needs if n in run.lost]
        if missing:
            run.skip(model.name, missing)
            continue
        run.stage(model.layer, model.name, lambda m=model: m.build(run.p))
        if model.name in BOUND and model.name not in run.lost:
            setattr(run.p, BOUND[model.name], run.written(model.name))


def _audit(run: _Run) -> None:
    """All checks on the written models (without the dead-man's switch, which runs on its own clock)."""
    t0 = time.perf_counter()
    bound = checks.audits(run.p, run.written, heartbeat=False)
    rows = audit.report(*bound).collect()                    # a row a check
    for row in rows:
        message = ""
        if row.failures:
            behind = audit.failing_rows(bound[0], row.check_name)
            if behind is not None:
                message = publish.staged_path(run.out_dir, run.p.run_id, "failures", row.check_name)
                Q.store_failures(behind, message)
        run.note(row.check_name, "test", row.status, row.failures, message, (time.perf_counter() - t0) / len(rows))


def daily_build(spark: SparkSession, sf_dir: str, out_dir: str, telemetry_path: str, invocation_id: str | None = None,
                now: datetime | None = None, from_bronze: bool = False, assumptions_path: str | None = None) -> list[dict]:
    """Write, audit and publish one run; return (and log) the node results.

    ``from_bronze``: ``sf_dir`` holds landed Bronze tables (``BronzePipeline``)
    instead of the test tables behind the adapter, which are stamped as landed
    now.  ``now`` (default: the current time) is the run's clock, its day the
    report day.  ``assumptions_path``: CSV seed of thresholds and rates.  Raises
    ``BuildFailed``, with nothing published, after the run is logged.
    """
    from tillbook.plans.pipeline import BronzePipeline

    now = now or datetime.now().replace(microsecond=0)
    invocation_id = invocation_id or str(uuid.uuid4())
    cls = BronzePipeline if from_bronze else Pipeline
    p = cls(spark, sf_dir, policy=policy_from(spark, assumptions_path), run_id=invocation_id, telemetry_path=telemetry_path, now=now,
            as_of=now.date(), ingested_at=now)
    freshness_gate(p)
    run = _Run(p, out_dir)
    p.stored_queue = publish.read(spark, out_dir, "gold", "fct_exception_queue")
    if from_bronze:
        run.stage(*SNAPSHOT, lambda: history.snapshot(publish.read(spark, out_dir, *SNAPSHOT), p.merchants, now))
        if SNAPSHOT in run.paths:
            p.merchant_snapshot = run.written(SNAPSHOT[1])
    _stage_models(run)
    if not run.lost:
        _audit(run)
    if not run.broken():
        publish.publish(spark, out_dir, invocation_id, run.paths, now)
    ops.append_run_telemetry(spark, telemetry_path, invocation_id, datetime.now().replace(microsecond=0), run.results)
    if run.broken():
        raise BuildFailed(run.results)
    return run.results


def land_bronze(p: Pipeline, landing_dir: str, run_id: str | None = None, now: datetime | None = None,
                raise_on_violation: bool = True) -> list:
    """Operational landing: contract check -> lineage stamp -> one full batch of every table + manifest.

    Ground truth is landed beside the Bronze tables but never stamped into
    them (it only feeds the accuracy report). A landing has its own run id and
    is stamped with ``now`` (default: the current time). Returns the manifest rows.
    """
    from tillbook.plans.pipeline import SOURCE_SYSTEM
    from tillbook.sources import bronze
    from tillbook.sources.landing import add_lineage, landed_path, write_manifest

    run_id, now = run_id or str(uuid.uuid4()), now or datetime.now().replace(microsecond=0)
    frames = {"merchants": p.merchants, "transactions": p.transactions, "settlement_batches": p.batches,
              "reserve_events": p.reserve_events, "returns_adjustments": p.returns,
              "bank_movements": p.bank_movements}
    for name, df in frames.items():
        Q.guard(df, name, stop=raise_on_violation)
    landed = {name: add_lineage(df, SOURCE_SYSTEM, run_id, now) for name, df in frames.items()}
    landed["ground_truth_breaks"] = p.ground_truth
    counts = bronze.land(landed, landing_dir, run_id, now)
    return write_manifest(p.spark, [(n, c, landed_path(landing_dir, n)) for n, c in counts.items()], landing_dir).collect()


def land_corrections(corrected: dict[str, DataFrame], landing_dir: str, run_id: str | None = None, now: datetime | None = None,
                     source_system: str = "correction") -> dict[str, int]:
    """Land changed rows, by key, as a batch of their own; the rows they replace stay where they were landed."""
    from tillbook.sources import bronze
    from tillbook.sources.landing import add_lineage

    run_id, now = run_id or str(uuid.uuid4()), now or datetime.now().replace(microsecond=0)
    for name, df in corrected.items():
        Q.guard(df, name)
    stamped = {n: df if n == "ground_truth_breaks" else add_lineage(df, source_system, run_id, now) for n, df in corrected.items()}
    return bronze.land(stamped, landing_dir, run_id, now, bronze.CORRECTION)


def heartbeat_check(spark: SparkSession, telemetry_path: str, now: datetime | None = None) -> list:
    """The independent dead-man's switch: rows when the build never ran, is stale, or last run failed."""
    tel = spark.read.parquet(telemetry_path)
    now = now or datetime.now().replace(microsecond=0)
    return ops.pipeline_silence(ops.pipeline_heartbeat(tel, now, Policy()), now).collect()

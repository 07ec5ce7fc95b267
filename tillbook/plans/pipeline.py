"""The daily build over one input folder, stage by stage.

Stages that several marts read (settlement batches, bank postings, the
matcher's candidate set and its result, the open breaks) are materialised
once with a reliable checkpoint in the cluster's shared checkpoint folder,
so a lost executor re-reads files instead of replaying the whole lineage,
and every mart starts from the same snapshot.
"""

from __future__ import annotations

from datetime import date, datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.policy import Policy
from tillbook.session import materialize
from tillbook.sources import adapter, bronze
from tillbook.operators import breaks as breaks_ops
from tillbook.operators import contracts
from tillbook.operators import duplicates, history, marts, masking, matching, ops, settlement, silver
from tillbook.operators import queue as queue_ops
from tillbook.sources.landing import add_lineage

RUN_ID = "run-00000000-0000-0000-0000-000000000001"
AS_OF = date(2002, 3, 31)
NOW = datetime(2024, 1, 31, 6, 0, 0)  # after the last telemetry event of the test data
RUN1_CUTOFF = date(2001, 7, 1)  # the earlier run of the two-run queue story sees data before this day
INGESTED_AT = datetime(2024, 1, 31, 4, 0, 0)
SNAPSHOT_TIMES = (datetime(1997, 1, 1), datetime(1999, 1, 1))
SOURCE_SYSTEM = "ops_adapter"


class Pipeline:
    def __init__(self, spark: SparkSession, sf_dir: str, policy: Policy = Policy(), checkpoint: bool = True,
                 run_id: str = RUN_ID, as_of: date = AS_OF, now: datetime = NOW, telemetry_path: str | None = None,
                 ingested_at: datetime = INGESTED_AT):
        self.spark, self.sf_dir, self.policy = spark, sf_dir, policy
        self.checkpoint, self.run_id, self.as_of, self.now = checkpoint, run_id, as_of, now
        self.telemetry_path, self.ingested_at = telemetry_path, ingested_at

    def _keep(self, df: DataFrame, name: str = "stage") -> DataFrame:
        return materialize(df, name, "zstd") if self.checkpoint else df

    # ---- reference data -------------------------------------------------
    @cached_property
    def calendar(self) -> DataFrame:
        # a few thousand rows, looked up by most stages: written once, then a tiny scan
        return self._keep(adapter.calendar(self.spark, self.sf_dir), "calendar")

    @cached_property
    def merchants(self) -> DataFrame:
        return self._keep(adapter.merchants(self.spark, self.sf_dir, snapshot=2), "merchants")

    @cached_property
    def merchants_first_snapshot(self) -> DataFrame:
        return self._keep(adapter.merchants(self.spark, self.sf_dir, snapshot=1), "merchants_v1")

    # ---- operational bronze ---------------------------------------------
    @cached_property
    def transactions(self) -> DataFrame:
        return adapter.transactions(self.spark, self.sf_dir)

    @cached_property
    def returns(self) -> DataFrame:
        return self._keep(settlement.returns_adjustments(adapter.drawn_returns(self.spark, self.sf_dir), self.daily_volume), "returns")

    @cached_property
    def daily_volume(self) -> DataFrame:
        return self._keep(settlement.daily_volume(self.transactions), "daily_volume")

    @cached_property
    def batches(self) -> DataFrame:
        return self._keep(settlement.settlement_batches(
            self.daily_volume, self.merchants, self.returns, self.calendar, self.policy), "settlement_batches")

    @cached_property
    def _bank(self) -> tuple[DataFrame, DataFrame]:
        return adapter.bank_movements_and_truth(self.batches, self.calendar)

    @cached_property
    def bank_movements(self) -> DataFrame:
        # the reference is a digest of the id: made where it is read, not stored
        return self._keep(self._bank[0].drop("bank_reference"), "bank_movements").withColumn("bank_reference", adapter.bank_reference())

    @cached_property
    def ground_truth(self) -> DataFrame:
        return self._bank[1]

    @cached_property
    def reserve_events(self) -> DataFrame:
        return settlement.reserve_events(self.batches, self.policy)

    @cached_property
    def telemetry(self) -> DataFrame:
        """The build's own run log when it has one (empty before the first run), else the test stand-in."""
        if self.telemetry_path is None:
            return adapter.run_telemetry(self.spark, self.sf_dir)
        from tillbook.operators.ops import TELEMETRY_SCHEMA
        from tillbook.session import hadoop_fs
        fs, path = hadoop_fs(self.spark, self.telemetry_path)
        if fs.exists(path):
            return self.spark.read.parquet(self.telemetry_path)
        return self.spark.createDataFrame([], TELEMETRY_SCHEMA)

    # ---- matcher ----------------------------------------------------------
    @cached_property
    def recon(self) -> matching.Reconciliation:
        return matching.reconcile(self.batches, self.bank_movements, self.calendar, self.policy,
                                  persist=self._keep)

    @cached_property
    def matches(self) -> DataFrame:
        return self.recon.matches  # a filter of one stored table and another stored one

    @cached_property
    def stored_matches(self) -> DataFrame:
        """The matches as one table, for the checks, which read them with those of other models in one plan."""
        return self._keep(self.matches, "matches")

    # ---- bronze / silver ---------------------------------------------------
    def bronze(self, name: str) -> DataFrame:
        # by name, so that a table doesn't build the others
        stage = {"merchants": "merchants", "transactions": "transactions", "settlement_batches": "batches",
                 "bank_movements": "bank_movements", "reserve_events": "reserve_events", "returns_adjustments": "returns"}[name]
        return add_lineage(getattr(self, stage), SOURCE_SYSTEM, self.run_id, self.ingested_at)

    @cached_property
    def dim_merchant(self) -> DataFrame:
        return silver.dim_merchant(self.bronze("merchants"))

    # ---- history --------------------------------------------------------------
    @cached_property
    def merchant_snapshot(self) -> DataFrame:
        first = self._keep(history.snapshot(None, self.merchants_first_snapshot, SNAPSHOT_TIMES[0]), "snapshot_1")
        return self._keep(history.snapshot(first, self.merchants, SNAPSHOT_TIMES[1]), "snapshot_2")

    @cached_property
    def merchant_history(self) -> DataFrame:
        return history.merchant_history(self.merchant_snapshot)

    # ---- gold -------------------------------------------------------------------
    @cached_property
    def breaks(self) -> DataFrame:
        return self._keep(contracts.enforce(breaks_ops.reconciliation_breaks(
            self.matches, self.calendar, self.merchants, self.merchant_history, self.policy),
            "reconciliation_breaks"), "breaks")

    # ---- an earlier daily run (data up to a cutoff), for the incremental queue
    @cached_property
    def recon_run1(self) -> matching.Reconciliation:
        cut = F.lit(RUN1_CUTOFF)
        b = self.batches.where(F.col("batch_date") < cut)
        p = self.bank_movements.where(F.col("posting_date") < cut)
        # same calendar and windows, subsets of both sides: the earlier run's candidates are a filter
        cands = self.recon.candidates.where((F.col("batch_date") < cut) & (F.col("posting_date") < cut))
        return matching.reconcile(b, p, self.calendar, self.policy, persist=lambda d, n: self._keep(d, n + "_r1"),
                                  candidates=cands)

    @cached_property
    def breaks_run1(self) -> DataFrame:
        return self._keep(breaks_ops.reconciliation_breaks(
            self.recon_run1.matches, self.calendar, self.merchants, self.merchant_history,
            self.policy), "breaks_r1")

    @cached_property
    def exception_queue(self) -> DataFrame:
        return queue_ops.exception_queue(self.breaks, self.merchants, self.policy)

    #: The queue that the last run left, if any; a build sets it from what is published.
    stored_queue: DataFrame | None = None

    @cached_property
    def current_queue(self) -> DataFrame:
        return queue_ops.next_queue(self.stored_queue, self.breaks, self.merchants, self.policy)

    @cached_property
    def exception_queue_second_run(self) -> DataFrame:
        first = queue_ops.exception_queue(self.breaks_run1, self.merchants, self.policy)
        triaged = queue_ops.analyst_update(first, F.col("severity") == "critical", "investigating", "analyst-1")
        return queue_ops.merge_queue(triaged, self.exception_queue)

    @cached_property
    def exception_queue_masked(self) -> DataFrame:
        return masking.exception_queue_masked(self.exception_queue)

    @cached_property
    def heartbeat(self) -> DataFrame:
        return ops.pipeline_heartbeat(self.telemetry, self.now, self.policy)

    @cached_property
    def run_summary(self) -> DataFrame:
        # the queue as it stands after the latest run, resolved rows included
        return ops.run_summary(self.daily_cash_position, self.exception_queue_second_run, self.telemetry, self.policy)

    @cached_property
    def frps(self) -> DataFrame:
        from tillbook.sources import frps_sample, macro
        return self._keep(macro.frps_long(frps_sample.table1_cells(self.spark)), "frps_payment_volumes")

    @cached_property
    def daily_cash_position(self) -> DataFrame:
        return contracts.enforce(marts.daily_cash_position(self.matches), "daily_cash_position")

    @cached_property
    def duplicate_postings(self) -> DataFrame:
        return self._keep(duplicates.duplicate_postings(self.matches, self.bank_movements, self._keep), "duplicate_postings")


_CACHE: dict[tuple, Pipeline] = {}


def pipeline_for(spark: SparkSession, sf_dir: str) -> Pipeline:
    """One Pipeline (and so one set of checkpoints) per session and folder."""
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # remote session
        app = spark.conf.get("spark.app.id", None) or str(id(spark))
    key = (app, sf_dir)
    if key not in _CACHE:
        _CACHE[key] = Pipeline(spark, sf_dir)
    return _CACHE[key]


def run(spark: SparkSession, inputs: str, policy: Policy = Policy(), now: datetime = NOW, run_id: str = RUN_ID,
        as_of: date = AS_OF) -> dict[str, DataFrame]:
    """The daily build as a function: every model, keyed by its name (lazy where not materialised)."""
    from tillbook.plans.queries import QUERIES

    p = Pipeline(spark, inputs, policy, run_id=run_id, as_of=as_of, now=now)
    names = ["dim_date", "silver_merchant", "merchant_history", "settlement_batches", "bank_movements",
             "recon_matches", "duplicate_postings", "reconciliation_breaks", "daily_cash_position",
             "funding_cost_summary", "merchant_exception_trends", "merchant_settlement_sla", "payment_mix_context",
             "exception_queue", "exception_queue_masked", "duplicate_posting_exceptions", "run_summary",
             "run_heartbeat", "quality_report"]
    return {n: QUERIES[n](p) for n in names}


class BronzePipeline(Pipeline):
    """The same build over landed Bronze tables (``<bronze_dir>/<table>``), as production runs it.

    Inputs: merchants, transactions, settlement_batches, bank_movements,
    reserve_events, returns_adjustments, each with the lineage its landing
    stamped (``bronze`` keeps it, the models leave it out), and optionally frps_payment_volumes. The calendar spans the batches' dates
    with a buffer (its size is checked by ``dim_date``); merchant history
    starts with the current merchant table unless a snapshot table is given.
    """

    def __init__(self, spark: SparkSession, bronze_dir: str, snapshot_path: str | None = None,
                 calendar_buffer_days: int = 120, **kw):
        super().__init__(spark, bronze_dir, **kw)
        self.snapshot_path, self.calendar_buffer_days = snapshot_path, calendar_buffer_days

    def _bronze_table(self, name: str) -> DataFrame:
        from tillbook.sources.landing import LINEAGE_COLUMNS
        df = self.bronze(name)
        return df.drop(*[c for c in LINEAGE_COLUMNS if c in df.columns])

    def bronze(self, name: str) -> DataFrame:
        """The landed table as it stands, corrections in place; a folder that was landed without the ledger is read as it is."""
        try:
            return bronze.read_current(self.spark, self.sf_dir, name)
        except FileNotFoundError:
            return self.spark.read.parquet(f"{self.sf_dir.rstrip('/')}/{name}")

    @cached_property
    def calendar(self) -> DataFrame:
        from datetime import timedelta
        from tillbook.operators import calendar as cal_ops
        lo, hi = self._bronze_table("settlement_batches").agg(F.min("batch_date"), F.max("batch_date")).first()
        pad = timedelta(days=self.calendar_buffer_days)
        return self._keep(cal_ops.dim_date(self.spark, lo - pad, hi + pad), "calendar")

    @cached_property
    def merchants(self) -> DataFrame:
        return self._bronze_table("merchants")

    @cached_property
    def merchants_first_snapshot(self) -> DataFrame:
        return self.merchants

    @cached_property
    def merchant_snapshot(self) -> DataFrame:
        if self.snapshot_path:
            return self.spark.read.parquet(self.snapshot_path)
        return self._keep(history.snapshot(None, self.merchants, SNAPSHOT_TIMES[0]), "snapshot_1")

    @cached_property
    def transactions(self) -> DataFrame:
        return self._bronze_table("transactions")

    @cached_property
    def returns(self) -> DataFrame:
        return self._bronze_table("returns_adjustments")

    @cached_property
    def batches(self) -> DataFrame:
        return self._bronze_table("settlement_batches")

    @cached_property
    def bank_movements(self) -> DataFrame:
        return self._bronze_table("bank_movements")

    @cached_property
    def reserve_events(self) -> DataFrame:
        return self._bronze_table("reserve_events")

    @cached_property
    def ground_truth(self) -> DataFrame:
        return self.bronze("ground_truth_breaks")

    @cached_property
    def frps(self) -> DataFrame:
        return self._bronze_table("frps_payment_volumes")

    @cached_property
    def telemetry(self) -> DataFrame:
        if self.telemetry_path is None:
            from tillbook.operators.ops import TELEMETRY_SCHEMA
            return self.spark.createDataFrame([], TELEMETRY_SCHEMA)
        return super().telemetry

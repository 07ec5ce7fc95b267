"""Triage exception queue: first build, merge of a new run, analyst updates.

Merge semantics (keyed on settlement_batch_id), without a MERGE-capable
table format: one full outer join of the stored queue with the new open
breaks, resolved per column, written as a new version directory.

* in both      -> engine-owned columns from the new run; ``merchant_id``,
                  ``triage_status`` and any analyst column kept;
* new only     -> inserted with ``triage_status = 'new'``;
* stored only  -> kept; ``triage_status`` set to 'resolved' unless it already
                  is (a null status stays null, as ``NOT IN`` leaves it).

A break that re-opens keeps its 'resolved' status (the merge never writes
status on update).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.policy import Policy
from tillbook.session import hadoop_fs

KEY = "settlement_batch_id"
OWNED = ["business_name", "industry", "region", "risk_tier", "batch_date", "break_first_identified_date",
         "report_date", "expected_settlement_amount", "actual_cash_received", "break_amount", "age_business_days",
         "aging_bucket", "is_cash_at_risk", "funding_cost_estimate", "root_cause_hint", "suggested_owner_role",
         "severity", "sla_due_date"]

# Fixed values (must equal the reference routing rules): root-cause hint -> owner role.
OWNER_BY_HINT = [
    ("missing_posting", "Treasury Ops"),
    ("delayed", "Treasury Ops"),
    ("unmatched_closest_candidate", "Controller / Accounting"),
]
DEFAULT_OWNER = "Data/Analytics Engineering"


def exception_queue(breaks: DataFrame, merchants: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """Queue rows for the current open breaks (a full build)."""
    hint = F.col("root_cause_hint")
    owner = None
    for h, role in OWNER_BY_HINT:
        owner = F.when(hint == h, role) if owner is None else owner.when(hint == h, role)
    owner = owner.otherwise(DEFAULT_OWNER)
    risk = F.col("is_cash_at_risk")
    severity = (F.when(risk & (F.col("break_amount") >= policy.critical_break_usd), "critical")
                .when(risk, "high").when(F.col("aging_bucket").isin("2-3", "4-7"), "medium").otherwise("low"))
    mer = merchants.select("merchant_id", "business_name")
    return breaks.join(mer, "merchant_id").select(
        KEY, "merchant_id", "business_name", "industry", "region", "risk_tier", "batch_date",
        "break_first_identified_date", "report_date", "expected_settlement_amount", "actual_cash_received",
        "break_amount", "age_business_days", "aging_bucket", "is_cash_at_risk", "funding_cost_estimate",
        "root_cause_hint", owner.alias("suggested_owner_role"), severity.alias("severity"),
        # the threshold is in business days but is added as calendar days, as in the reference
        F.date_add("break_first_identified_date", policy.cash_at_risk_threshold_days).alias("sla_due_date"),
        F.lit("new").alias("triage_status"))


def merge_queue(stored: DataFrame, fresh: DataFrame, owned: list[str] = OWNED, reopen: bool = False) -> DataFrame:
    """Merge a new build into the stored queue (update owned, insert new, close out absent).

    ``reopen=True`` sets a 'resolved' row that is open again back to 'new'; by default its
    status is left alone, as the merge never writes status on update.
    """
    cols = stored.columns + [c for c in fresh.columns if c not in stored.columns]
    o = stored.select(*[F.col(c).alias(f"o__{c}") for c in stored.columns])
    n = fresh.select(*[F.col(c).alias(f"n__{c}") for c in fresh.columns])
    j = o.join(n, o[f"o__{KEY}"] == n[f"n__{KEY}"], "full_outer")
    has_o, has_n = F.col(f"o__{KEY}").isNotNull(), F.col(f"n__{KEY}").isNotNull()

    def pick(c: str):
        oc = F.col(f"o__{c}") if c in stored.columns else F.lit(None)
        nc = F.col(f"n__{c}") if c in fresh.columns else F.lit(None)
        if c == KEY:
            return F.coalesce(oc, nc)
        if c == "triage_status":
            closed = F.when(~has_n & (oc != F.lit("resolved")), F.lit("resolved"))
            if reopen:
                closed = closed.when(has_n & (oc == F.lit("resolved")), F.lit("new"))
            closed = closed.otherwise(oc)
            return F.when(has_o, closed).otherwise(nc)
        if c in owned and c in fresh.columns:
            return F.when(has_n, nc).otherwise(oc)
        return F.when(has_o, oc).otherwise(nc)

    return j.select(*[pick(c).alias(c) for c in cols])


def analyst_update(queue: DataFrame, condition, status: str, owner: str | None = None) -> DataFrame:
    """What an analyst does between runs: set status (and an owner column) on some rows."""
    out = queue.withColumn("triage_status", F.when(condition, F.lit(status)).otherwise(F.col("triage_status")))
    if owner is not None:
        prev = F.col("triage_owner") if "triage_owner" in queue.columns else F.lit(None).cast("string")
        out = out.withColumn("triage_owner", F.when(condition, F.lit(owner)).otherwise(prev))
    return out


# ---- versioned storage: read version n, write n + 1, never overwrite what is read
def versions(spark: SparkSession, base: str, committed_only: bool = True) -> list[int]:
    """Version numbers under ``base``; by default only those whose write committed (``_SUCCESS``)."""
    fs, path = hadoop_fs(spark, base)
    if not fs.exists(path):
        return []
    jvm = spark.sparkContext._jvm
    out = []
    for st in fs.listStatus(path):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v") and name[1:].isdigit():
            if not committed_only or fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append(int(name[1:]))
    return sorted(out)


def read_current(spark: SparkSession, base: str) -> DataFrame | None:
    vs = versions(spark, base)
    return spark.read.parquet(f"{base}/v{vs[-1]:06d}") if vs else None


def write_next(df: DataFrame, base: str) -> int:
    """Write ``df`` as the next version and return its number."""
    vs = versions(df.sparkSession, base, committed_only=False)  # never reuse a number, even of a failed write
    nxt = (vs[-1] + 1) if vs else 1
    df.write.mode("errorifexists").parquet(f"{base}/v{nxt:06d}")
    return nxt


def next_queue(stored: DataFrame | None, breaks: DataFrame, merchants: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """The queue after a run: its open breaks merged into the stored queue, if there is one."""
    fresh = exception_queue(breaks, merchants, policy)
    return fresh if stored is None else merge_queue(stored, fresh)


def run_queue(spark: SparkSession, base: str, breaks: DataFrame, merchants: DataFrame,
              policy: Policy = Policy()) -> int:
    """One run of a queue that is kept as versions of its own: build, merge with current, write next version."""
    return write_next(next_queue(read_current(spark, base), breaks, merchants, policy), base)

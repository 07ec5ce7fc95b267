"""SCD2 snapshot (check strategy) and the point-in-time history view.

One pass per snapshot run: the open versions are full-outer-joined with the
incoming rows on the key (a shuffle on merchant_id, no driver work).
Changed check columns (null-safe compare) close the open version at the run
time and open a new one; unchanged rows, even with a fresh ingestion stamp,
create nothing; keys that vanish from the source stay open.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.sources.landing import ts_ntz

CHECK_COLS = ["risk_tier", "reserve_rate_bps", "processing_fee_bps", "settlement_speed_business_days"]
FROM, TO = "snapshot_valid_from", "snapshot_valid_to"
END_OF_TIME = datetime(9999, 12, 31)


def snapshot(existing: DataFrame | None, source: DataFrame, at: datetime, key: str = "merchant_id",
             check_cols: list[str] = CHECK_COLS) -> DataFrame:
    """Return the next version of the snapshot table."""
    cols = source.columns
    fresh = source.select(*cols, ts_ntz(at).alias(FROM), F.lit(None).cast("timestamp_ntz").alias(TO))
    if existing is None:
        return fresh
    closed = existing.where(F.col(TO).isNotNull())
    current = existing.where(F.col(TO).isNull())
    o = current.select(*[F.col(c).alias(f"o_{c}") for c in current.columns])
    n = source.select(*[F.col(c).alias(f"n_{c}") for c in cols])
    j = o.join(n, o[f"o_{key}"] == n[f"n_{key}"], "full_outer")
    same = reduce(lambda a, b: a & b, [F.col(f"o_{c}").eqNullSafe(F.col(f"n_{c}")) for c in check_cols])
    has_o, has_n = F.col(f"o_{key}").isNotNull(), F.col(f"n_{key}").isNotNull()
    changed = has_o & has_n & ~same

    kept = j.where(has_o & ~changed).select(*[F.col(f"o_{c}").alias(c) for c in current.columns])
    ended = j.where(changed).select(*[F.col(f"o_{c}").alias(c) for c in current.columns if c != TO],
                                    ts_ntz(at).alias(TO))
    opened = j.where(~has_o | changed).select(*[F.col(f"n_{c}").alias(c) for c in cols],
                                               ts_ntz(at).alias(FROM), F.lit(None).cast("timestamp_ntz").alias(TO))
    return closed.unionByName(kept).unionByName(ended).unionByName(opened)


def merchant_history(snap: DataFrame) -> DataFrame:
    """Versions with ``valid_to`` = 9999-12-31 for the open one (half-open intervals)."""
    attrs = ["merchant_id", "business_name", "industry", "mcc", "region", "state", "employer_size_class",
             "risk_tier", "onboarding_date", "reserve_rate_bps", "processing_fee_bps",
             "settlement_speed_business_days", "avg_ticket_usd"]
    return snap.select(*attrs, F.col(FROM).alias("valid_from"),
                       F.coalesce(F.col(TO), ts_ntz(END_OF_TIME)).alias("valid_to"))

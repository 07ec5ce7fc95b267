"""Many checks of a table in one pass.

A ``TableAudit`` holds everything asked of one table: a key that must be
unique, conditions that no row may meet, columns that must (or must not) be
found in another table, and measures for comparisons between tables. All row
conditions are sums of one aggregate; where there is a key, they are first
summed per key, so the rows are grouped once and the key's own check is a
second look at the groups. References are left joins to the distinct parent
keys whose miss is one more row condition.

``report`` stacks the one-row results of all tables and unfolds them to
(check_name, severity, failures, status): about one scan a table, whatever the
number of its checks.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.functions.frames import one_row

ERROR, WARN = "error", "warn"


@dataclass(frozen=True)
class Rule:
    """No row may meet ``bad`` (null counts as not met)."""
    name: str
    bad: Callable[[], Column]
    severity: str = ERROR


@dataclass(frozen=True)
class Reference:
    """Every value of ``column`` that isn't null is among the parent's (or, with ``present=False``, none is)."""
    name: str
    column: str
    parent: Callable[[], DataFrame]
    parent_column: str
    present: bool = True
    severity: str = ERROR


@dataclass(frozen=True)
class Comparison:
    """Number of failures from the measures of several tables, as ``table__measure`` columns."""
    name: str
    failures: Callable[[], Column]
    severity: str = ERROR


@dataclass(frozen=True)
class TableAudit:
    table: str
    frame: Callable[[], DataFrame]
    key: tuple[str, ...] = ()
    key_check: str = ""
    rules: tuple[Rule, ...] = ()
    references: tuple[Reference, ...] = ()
    measures: dict[str, tuple[str, Callable[[], Column]]] = field(default_factory=dict)   # name -> (sum | max | rows, value)
    key_severity: str = ERROR


def _flagged(t: TableAudit) -> tuple[DataFrame, dict[str, Column]]:
    """The table with its references looked up, and the failing condition of every row check."""
    df, bad = t.frame(), {r.name: r.bad() for r in t.rules}
    for i, ref in enumerate(t.references):
        known = ref.parent().select(F.col(ref.parent_column).alias(ref.column)).where(F.col(ref.column).isNotNull()).distinct() \
            .withColumn(f"_found{i}", F.lit(True))
        df = df.join(known, ref.column, "left")
        miss = F.col(f"_found{i}").isNull() if ref.present else F.col(f"_found{i}").isNotNull()
        bad[ref.name] = F.col(ref.column).isNotNull() & miss
    return df, bad


def _one_pass(t: TableAudit) -> DataFrame:
    df, bad = _flagged(t)
    fold = {"sum": F.sum, "max": F.max, "rows": F.sum}
    first = [F.sum(F.when(c, 1).otherwise(0).cast("long")).alias(n) for n, c in bad.items()]
    first += [(F.count(F.lit(1)) if kind == "rows" else fold[kind](value())).alias(f"{t.table}__{m}") for m, (kind, value) in t.measures.items()]
    if not t.key:
        return df.agg(*(first or [F.count(F.lit(1)).alias(f"{t.table}__rows")]))
    groups = df.groupBy(*t.key).agg(F.count(F.lit(1)).alias("_n"), *first)
    second = [F.sum(n).alias(n) for n in bad]
    second += [fold[kind](f"{t.table}__{m}").alias(f"{t.table}__{m}") for m, (kind, _) in t.measures.items()]
    return groups.agg(F.sum((F.col("_n") > 1).cast("long")).alias(t.key_check), *second)


def report(tables: list[TableAudit], comparisons: list[Comparison] = (), extra: list[DataFrame] = ()) -> DataFrame:
    """``check_name, severity, failures, status`` of all checks; ``extra``: one-row frames for the comparisons."""
    names = [(t.key_check, t.key_severity) for t in tables if t.key]
    names += [(c.name, c.severity) for t in tables for c in (*t.rules, *t.references)]
    if len({n for n, _ in names} | {c.name for c in comparisons}) < len(names) + len(comparisons):
        raise ValueError("two checks have one name")
    row = one_row(*[_one_pass(t) for t in tables], *extra)
    failures = [(n, s, F.coalesce(F.col(n), F.lit(0))) for n, s in names] + [(c.name, c.severity, c.failures()) for c in comparisons]
    entries = [F.struct(F.lit(n).alias("check_name"), F.lit(s).alias("severity"), F.coalesce(f, F.lit(0)).cast("long").alias("failures"))
               for n, s, f in failures]
    return row.select(F.inline(F.array(*entries))).withColumn(
        "status", F.when(F.col("failures") == 0, "pass").when(F.col("severity") == WARN, "warn").otherwise("fail"))


def failing_rows(tables: list[TableAudit], check: str) -> DataFrame | None:
    """The rows (or repeated keys) behind a check of one table, for triage; None for a comparison."""
    for t in tables:
        if t.key and check == t.key_check:
            return t.frame().groupBy(*t.key).count().where("count > 1")
        if any(check == c.name for c in (*t.rules, *t.references)):
            df, bad = _flagged(t)
            return df.where(bad[check]).select(t.frame().columns)
    return None


# ---------------------------------------------------------------- rules in common use
def not_null(table: str, column: str, name: str = "") -> Rule:
    return Rule(name or f"not_null_{table}_{column}", lambda: F.col(column).isNull())


def accepted(table: str, column: str, values: list, name: str = "", severity: str = ERROR) -> Rule:
    return Rule(name or f"accepted_values_{table}_{column}", lambda: F.col(column).isNotNull() & ~F.col(column).isin(*values), severity)


def within(name: str, column: str, low, high) -> Rule:
    return Rule(name, lambda: (F.col(column) < low) | (F.col(column) > high))


def stale(latest: Column, now: datetime, warn_hours: float, error_hours: float, severity: str = ERROR) -> Column:
    """1 if the newest row is missing or older than the bound of the severity, else 0."""
    from tillbook.sources.landing import ts_ntz
    age = (F.unix_timestamp(ts_ntz(now).cast("timestamp")) - F.unix_timestamp(latest.cast("timestamp"))) / 3600.0
    return F.when(latest.isNull() | (age > (error_hours if severity == ERROR else warn_hours)), 1).otherwise(0)

"""Settlement batch <-> bank posting matcher (two greedy passes + diagnostics).

Semantics (policy: amount tolerance = greatest(floor, pct * |expected|),
window = payout date .. last calendar day of business seq payout + N):

1. candidates: same merchant, posting date inside the window, any amount.
2. pass 1: in-tolerance pairs; a pair wins only if it is the best posting of
   its batch *and* the best batch of its posting (order: amount diff, date
   diff, id). A batch whose best posting went elsewhere gets no second choice.
3. pass 2: for batches still open, the sum of *all* their candidates not
   claimed in pass 1 (more than one posting, sum within tolerance).
   Conflicts: each posting goes to the earliest batch (batch date, id); a
   batch that loses any posting is dropped entirely (one round).
4. breaks: ``delayed`` if an in-tolerance posting exists after the window
   (first by date, id; also if claimed elsewhere), else
   ``unmatched_closest_candidate`` (nearest amount in window, ties by date,
   id), else ``missing_posting``.

Spark plan notes:
* The window is 3..~7 calendar days, so it meets one or two spans of
  ``SPAN_DAYS`` days: the candidate search is an equi join on (merchant, span)
  and the window's bounds, a key far finer than the merchant, so a hot merchant
  spreads over its history; a span of one merchant that is larger than a
  partition is dealt out in pieces (``functions.spread``).
* "Best per batch" / "best per posting" are ``min(struct(...))``
  aggregates (sort-based, with map-side partial aggregation) rather than two
  full-partition row_number windows. The batch-side
  aggregate also yields the nearest-amount diagnostic, so the candidate set
  is grouped by batch once; the result is one row per batch.
* The late search is open-ended in date and only runs for open batches.
  A batch asks for the one or two aligned decimal cent blocks, as wide as its
  tolerance interval or wider, that hold the interval, and meets the
  postings of those (``first_late``). Where a block holds more than
  ``LATE_CROWD`` postings, the batch is never paired with them: its tolerance
  interval is tiled exactly by aligned blocks, postings are reduced to their
  first id per (merchant, block, day), and each tile is an as-of lookup (see
  ``first_late_tiled``), so a merchant with many same-amount postings costs one
  row per day, not one pair per posting. Only postings that an open batch
  may ask for are laid out at all (``late_postings``).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillbook.functions import sieve, spread
from tillbook.functions.money import MONEY, money
from tillbook.operators import calendar as cal_ops
from tillbook.policy import Policy

ID = "settlement_batch_id"
SPAN_DAYS = 16          # of the candidate search: two or three windows' length
LATE_CROWD = 1000       # postings of a block with which an open batch may be paired
LATE_CELLS = 1 << 20    # of the late search's sieve
OPEN_CELLS = 1 << 20    # of the sieve of batches that pass one leaves open
LATE_MERCHANTS = 1_000_000


def _empty_ids():
    return F.array().cast("array<string>")


@dataclass
class Reconciliation:
    batch_windows: DataFrame
    candidates: DataFrame
    pass_one: DataFrame
    single_matches: DataFrame
    split_matches: DataFrame
    split_lines: DataFrame
    late_candidates: DataFrame
    best_effort: DataFrame
    breaks: DataFrame
    matches: DataFrame
    settled: DataFrame  # matched batch -> date of its last matched posting


def _tolerance(policy: Policy) -> Column:
    tol = F.greatest(F.lit(policy.tolerance_floor_usd),
                     F.lit(policy.tolerance_pct) * F.abs(F.col("expected_settlement_amount")))
    return tol.cast("decimal(20,5)")


def batch_windows(batches: DataFrame, cal: DataFrame, policy: Policy, also: tuple[str, ...] = ()) -> DataFrame:
    """Batches with payout seq, amount tolerance and window end, and the columns ``also``.

    Inner join on the payout date: a batch whose payout falls outside the
    calendar drops out here (the equal-row-count check reports it).
    """
    b = batches.select(ID, "merchant_id", "batch_date", "expected_payout_date", "expected_settlement_amount", *also)
    b = cal_ops.add_seq(b, cal, "expected_payout_date", "payout_business_day_seq", how="inner")
    last = cal_ops.last_day_of_seq(cal)
    b = b.join(last, b.payout_business_day_seq + F.lit(policy.window_business_days) == last["_seq"], "left") \
        .withColumnRenamed("_last_day", "window_end_date").drop("_seq")
    return b.withColumn("amount_tolerance", _tolerance(policy))


def _span(day: str) -> Column:
    return F.floor(F.unix_date(day) / SPAN_DAYS).cast("int")


def candidate_pairs(windows: DataFrame, postings: DataFrame) -> DataFrame:
    """Every (batch, posting) of one merchant with the posting inside the window."""
    return measured(window_pairs(windows, postings), F.col("amount_tolerance"))


def window_pairs(windows: DataFrame, postings: DataFrame) -> DataFrame:
    """The pairs of ``candidate_pairs`` as they meet, before ``measured``; ``amount_tolerance`` if the windows have it."""
    own = [ID, "merchant_id", "batch_date", "expected_settlement_amount", "expected_payout_date", "window_end_date",
           *[c for c in ("amount_tolerance",) if c in windows.columns]]
    spans = windows.select(*own, F.explode(F.sequence(_span("expected_payout_date"), _span("window_end_date"))).alias("_span"))
    p = postings.select("posting_id", "merchant_id", "posting_date", F.col("amount").alias("posting_amount"), _span("posting_date").alias("_span"))
    # a (merchant, span) has a window or two per day and any number of postings: a busy one is dealt out
    c = spread.join(p, spans, ["merchant_id", "_span"], ["posting_id"])
    return c.where(F.col("posting_date").between(F.col("expected_payout_date"), F.col("window_end_date"))).select(
        *own, "posting_id", "posting_date", "posting_amount")


def measured(pairs: DataFrame, tolerance: Column) -> DataFrame:
    """Candidate pairs with their tolerance and distances, which follow from the other columns and needn't be stored."""
    return pairs.select(
        ID, "merchant_id", "batch_date", "expected_settlement_amount", "expected_payout_date", "window_end_date",
        tolerance.alias("amount_tolerance"), "posting_id", "posting_date", "posting_amount",
        money(F.abs(F.col("posting_amount") - F.col("expected_settlement_amount"))).alias("amount_diff"),
        F.abs(F.datediff("posting_date", "expected_payout_date")).alias("date_diff"),
    )


def pass_one(candidates: DataFrame) -> DataFrame:
    """One row per batch with candidates: its pass-1 match (if any) and its closest candidate.

    The batch side is one aggregate over all candidates that yields both the
    in-tolerance first choice and the nearest-amount diagnostic; the posting
    side is one aggregate over the in-tolerance candidates. A pair wins when
    each is the other's first choice: no posting that prefers a batch can be
    nearer to it than the batch's own first choice, so the nearest of those
    that prefer it says whether the first choice is among them, and both
    sides meet as they are grouped, one row per batch.
    """
    in_tol = F.col("amount_diff") <= F.col("amount_tolerance")
    by_batch = candidates.groupBy(ID).agg(
        F.min(F.when(in_tol, F.struct("amount_diff", "date_diff", "posting_id", "posting_amount",
                                      "posting_date"))).alias("bb"),
        F.min(F.struct("amount_diff", "posting_date", "posting_id", "posting_amount")).alias("be"))
    by_posting = candidates.where(in_tol).groupBy(F.col("posting_id").alias("_pid")).agg(
        F.min(F.struct("amount_diff", "date_diff", F.col(ID).alias("batch_id"))).alias("pb"))
    prefer = by_posting.where(F.col("_pid").isNotNull()).groupBy(F.col("pb.batch_id").alias(ID)).agg(
        F.min(F.struct(F.col("pb.amount_diff"), F.col("pb.date_diff"), F.col("_pid"))).alias("w"))
    won = by_batch.join(prefer, ID, "left").withColumn("_pid", F.when(F.col("w._pid") == F.col("bb.posting_id"), F.col("w._pid")))
    return won.select(
        ID,
        F.col("_pid").alias("single_posting_id"),
        F.when(F.col("_pid").isNotNull(), F.col("bb.posting_amount")).alias("single_amount"),
        F.when(F.col("_pid").isNotNull(), F.col("bb.posting_date")).alias("single_posting_date"),
        F.col("be.posting_id").alias("closest_posting_id"),
        F.col("be.posting_amount").alias("closest_posting_amount"),
        F.col("be.amount_diff").alias("closest_amount_diff"))


def split_sums(candidates: DataFrame, first: DataFrame,
               persist: Callable[[DataFrame, str], DataFrame] = lambda d, name: d) -> tuple[DataFrame, DataFrame]:
    """Pass 2 with conflict resolution -> (split matches, their posting lines).

    Few batches are still open: a bit table of them drops most candidates
    before the join shuffles them.
    """
    open_ids = first.where(F.col("single_posting_id").isNull()).select(ID)
    asked = persist(sieve.build(open_ids, [ID], OPEN_CELLS), "open_sieve")
    candidates = sieve.keep(candidates, asked, [ID], OPEN_CELLS)
    claimed = first.where(F.col("single_posting_id").isNotNull()).select(F.col("single_posting_id").alias("posting_id"))
    lines = persist(candidates.join(open_ids, ID, "left_semi").join(claimed, "posting_id", "left_anti")
                    .select(ID, "batch_date", "expected_settlement_amount", "amount_tolerance", "posting_id",
                            "posting_date", "posting_amount"), "split_candidates")
    sums = lines.groupBy(ID).agg(
        F.max("expected_settlement_amount").alias("expected_settlement_amount"),
        F.max("amount_tolerance").alias("amount_tolerance"),
        money(F.sum("posting_amount")).alias("summed_amount"),
        F.count(F.lit(1)).alias("posting_count"))
    raw = sums.where((F.col("posting_count") > 1)
                     & (F.abs(F.col("summed_amount") - F.col("expected_settlement_amount"))
                        <= F.col("amount_tolerance")))
    raw_lines = lines.join(raw.select(ID), ID, "left_semi").select(ID, "batch_date", "posting_id", "posting_date")
    winner = raw_lines.groupBy(F.col("posting_id").alias("_pid")).agg(
        F.min(F.struct("batch_date", F.col(ID).alias("batch_id"))).alias("w"))
    losers = (raw_lines.join(winner, raw_lines.posting_id == winner._pid)
              .where(F.col("w.batch_id") != F.col(ID)).select(ID).distinct())
    matches = raw.join(losers, ID, "left_anti").select(ID, "summed_amount", "posting_count")
    kept_lines = raw_lines.join(losers, ID, "left_anti")
    return matches, kept_lines


BLOCK = ["merchant_id", "k", "block"]
LATE_MAX_LEVEL = 12  # decimal levels of cent blocks: 10^12 cents covers any tolerance interval in use
_POWERS = [10 ** k for k in range(LATE_MAX_LEVEL + 2)]


def _power(k: Column) -> Column:
    return F.get(F.array(*[F.lit(p).cast("long") for p in _POWERS]), k)


def _floor_div(a: Column, p: Column) -> Column:
    return F.call_function("div", a - F.pmod(a, p), p)


def _ceil_div(a: Column, p: Column) -> Column:
    return -_floor_div(-a, p)


def _range_or_empty(lo: Column, hi: Column) -> Column:
    return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<bigint>"))


def tolerance_blocks(lo: Column, hi: Column) -> Column:
    """array<struct<k, block>>: aligned blocks of 10^k cents that exactly tile [lo, hi].

    A cent block b at level k covers [b*10^k, (b+1)*10^k - 1]. Level k keeps the
    blocks fully inside the interval that are not children of a fully-inside
    block of level k+1, so the tiles are disjoint and at most ~18 per level. The
    highest level is that of the interval's width.
    """
    top = F.least(F.lit(LATE_MAX_LEVEL), F.length((hi - lo + 1).cast("string")) - 1)

    def at_level(k):
        p, parent = _power(k), _power(k + 1)
        a, b = _ceil_div(lo, p), _floor_div(hi + 1, p) - 1
        a1, b1 = _ceil_div(lo, parent), _floor_div(hi + 1, parent) - 1
        beside = F.concat(_range_or_empty(a, a1 * 10 - 1), _range_or_empty(b1 * 10 + 10, b))
        used = F.when((k < top) & (a1 <= b1), beside).otherwise(_range_or_empty(a, b))
        return F.transform(used, lambda x: F.struct(k.alias("k"), x.alias("block")))
    return F.flatten(F.transform(F.sequence(F.lit(0), top), lambda k: at_level(k)))


def _interval() -> tuple[Column, Column]:
    """First and last cent within an open batch's tolerance."""
    exp, tol = F.col("expected_settlement_amount"), F.col("amount_tolerance")
    return F.ceil((exp - tol) * 100).cast("long"), F.floor((exp + tol) * 100).cast("long")


def late_asks(open_batches: DataFrame) -> DataFrame:
    """``settlement_batch_id, merchant_id, d, lo, hi, k, block``: the one or two blocks, at least as wide as it, that hold each interval."""
    lo, hi = _interval()
    wide = open_batches.where(F.col("window_end_date").isNotNull()).select(
        ID, "merchant_id", F.col("window_end_date").alias("d"), lo.alias("lo"), hi.alias("hi"))
    wide = wide.where("lo <= hi").withColumn("k", F.least(F.lit(LATE_MAX_LEVEL), F.length((F.col("hi") - F.col("lo")).cast("string"))))
    p = _power(F.col("k"))
    return wide.withColumn("block", F.explode(F.sequence(_floor_div(F.col("lo"), p), _floor_div(F.col("hi"), p))))


def late_probes(open_batches: DataFrame) -> DataFrame:
    """``settlement_batch_id, merchant_id, d, k, block``: the tiles of each open batch's tolerance interval."""
    lo, hi = _interval()
    return open_batches.where(F.col("window_end_date").isNotNull()).select(
        ID, "merchant_id", F.col("window_end_date").alias("d"), F.inline(tolerance_blocks(lo, hi)))


def late_postings(probes: DataFrame, postings: DataFrame,
                  persist: Callable[[DataFrame, str], DataFrame] = lambda d, name: d) -> DataFrame:
    """``merchant_id, k, block, posting_date, posting_id, amount``: postings, once per level, that a probe may ask for.

    The probes are the side information that prunes: a merchant's postings
    are laid out only on the levels its own probes use, only after the first
    window end among them, and only where the sieve of all (merchant, level,
    block) keys has the posting's block. One batch with a wide tolerance adds
    levels to its own merchant alone, and what is never asked for isn't
    shuffled.
    """
    levels = persist(probes.groupBy("merchant_id").agg(F.min("d").alias("_since"), F.collect_set("k").alias("_levels")), "late_levels")
    asked = persist(sieve.build(probes, BLOCK, LATE_CELLS), "late_sieve")
    cents = (F.col("amount") * 100).cast("long")
    laid_out = (spread.lookup(postings.select("merchant_id", "posting_id", "posting_date", "amount"), levels, ["merchant_id"], ["posting_id"],
                              limit=LATE_MERCHANTS)
                .where(F.col("posting_date") > F.col("_since"))
                .select("merchant_id", "posting_id", "posting_date", "amount", cents.alias("_cents"), F.explode("_levels").alias("k"))
                .withColumn("block", _floor_div(F.col("_cents"), _power(F.col("k")))).drop("_cents"))
    return sieve.keep(laid_out, asked, BLOCK, LATE_CELLS)


def first_late(open_batches: DataFrame, postings: DataFrame,
               persist: Callable[[DataFrame, str], DataFrame] = lambda d, name: d, crowd: int = LATE_CROWD) -> DataFrame:
    """First in-tolerance posting after the window (no upper date limit).

    Every open batch asks for one or two blocks and meets the postings in them,
    at most ``crowd`` a block. A batch that asks for a block with more is
    searched by tiles instead, without pairs.
    """
    asks = persist(late_asks(open_batches), "late_asks")
    near = persist(late_postings(asks, postings, persist), "late_near")
    crowds = persist(near.groupBy(*BLOCK).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > crowd).drop("_n"), "late_crowds")
    crowded = not crowds.isEmpty()
    if crowded:
        in_crowds = persist(asks.join(crowds, BLOCK, "left_semi").select(ID).distinct(), "late_in_crowds")
        asks = asks.join(in_crowds, ID, "left_anti")
        near = spread.join(near, crowds, BLOCK, ["posting_id"], "left_anti")
    cents = (F.col("amount") * 100).cast("long")
    found = (asks.join(near, BLOCK).where((F.col("posting_date") > F.col("d")) & cents.between(F.col("lo"), F.col("hi")))
             .groupBy(ID).agg(F.min(F.struct("posting_date", "posting_id", "amount")).alias("lc"))
             .select(ID, F.col("lc.posting_id").alias("late_posting_id"), F.col("lc.posting_date").alias("late_posting_date"),
                     F.col("lc.amount").alias("late_posting_amount")))
    if not crowded:
        return found
    return found.unionByName(first_late_tiled(open_batches.join(in_crowds, ID, "left_semi"), postings, persist))


def first_late_tiled(open_batches: DataFrame, postings: DataFrame,
                     persist: Callable[[DataFrame, str], DataFrame] = lambda d, name: d) -> DataFrame:
    """First in-tolerance posting after the window (no upper date limit), without pairs.

    Every posting inside a tile of the batch's tolerance interval qualifies, so
    per tile the answer is "the earliest posting day after the window end" -
    an as-of lookup. The postings that a probe may ask for are reduced to one
    row per (merchant, level, block, day) with the smallest posting id; each
    lookup is a running ``last(ignorenulls)`` over that key in descending day
    order. A key's partition holds at most one row per day plus that
    merchant's open batches, whatever the posting volume; the minimum over a
    batch's tiles is the result (earliest day, then smallest id).

    The per-day reduction is a separate aggregate (map-side partial
    aggregation) before the window's shuffle on purpose: repartitioning the
    raw postings on the window key would send all postings of a hot
    (merchant, block) through one task.
    """
    probes = persist(late_probes(open_batches), "late_probes")
    firsts = (late_postings(probes, postings, lambda d, name: persist(d, f"{name}_tiles")).groupBy("merchant_id", "k", "block", F.col("posting_date").alias("d"))
              .agg(F.min(F.struct("posting_id", "amount")).alias("p")))
    rows = (firsts.select("merchant_id", "k", "block", "d", F.lit(0).alias("kind"),
                          F.struct(F.col("d").alias("posting_date"), F.col("p.posting_id").alias("posting_id"),
                                   F.col("p.amount").alias("posting_amount")).alias("t"),
                          F.lit(None).cast("string").alias(ID))
            .unionByName(probes.select("merchant_id", "k", "block", "d", F.lit(1).alias("kind"),
                                       F.lit(None).cast("struct<posting_date:date,posting_id:string,"
                                                        "posting_amount:decimal(18,2)>").alias("t"), ID)))
    # descending day; on the same day the probe sorts before the postings, so only later days precede it
    after = Window.partitionBy("merchant_id", "k", "block").orderBy(F.col("d").desc(), F.col("kind").desc()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    found = rows.withColumn("nxt", F.last("t", ignorenulls=True).over(after)) \
        .where((F.col("kind") == 1) & F.col("nxt").isNotNull())
    return found.groupBy(ID).agg(F.min("nxt").alias("lc")).select(
        ID, F.col("lc.posting_id").alias("late_posting_id"), F.col("lc.posting_date").alias("late_posting_date"),
        F.col("lc.posting_amount").alias("late_posting_amount"))


def reconcile(batches: DataFrame, postings: DataFrame, cal: DataFrame, policy: Policy = Policy(),
              persist: Callable[[DataFrame, str], DataFrame] = lambda d, name: d,
              candidates: DataFrame | None = None) -> Reconciliation:
    """Run the matcher.

    ``persist`` materialises what later steps read more than once: the
    candidate set, the per-batch pass-1 table, the pass-2 result and the
    batches still open after both passes (all but the first are batch-level).
    """
    windows = batch_windows(batches, cal, policy)
    # Deliberately not bucketed on the batch id: that would route every candidate of a hot batch
    # through one task, while the batch-side min(struct) below pre-aggregates map-side instead.
    if candidates is None:  # a caller may pass a known-equal subset of an earlier candidate table
        candidates = measured(persist(window_pairs(windows.drop("amount_tolerance"), postings), "candidates"), _tolerance(policy))
    # the batches meet pass one where its sides are grouped by batch, so they are shuffled this once;
    # what follows is a filter of the result, or joins of the few batches that pass one leaves open
    whole = persist(scored_batches(batches, cal, policy, candidates), "pass_one")
    first = _first_of(whole)
    single = first.where(F.col("single_posting_id").isNotNull()).select(
        ID, F.col("single_posting_id").alias("posting_id"), F.col("single_amount").alias("matched_amount"),
        F.col("single_posting_date").alias("posting_date"))
    left_open = whole.where(F.col("single_posting_id").isNull())
    split, split_lines = split_sums(candidates, whole.where("has_candidates"), persist)
    split = persist(split, "split_matches")
    open_batches = persist(left_open.join(split.select(ID), ID, "left_anti").withColumn("amount_tolerance", _tolerance(policy)), "open_batches")
    best = open_batches.where("has_candidates").select(
        ID, "closest_posting_id", "closest_posting_amount", "closest_amount_diff").dropDuplicates([ID])
    late = persist(first_late(open_batches, postings, persist), "late")

    brk = (open_batches.select(ID, "closest_posting_id", "closest_posting_amount").join(late, ID, "left").select(
        ID,
        F.coalesce(F.col("late_posting_amount"), F.col("closest_posting_amount")).alias("matched_amount"),
        F.when(F.col("late_posting_id").isNotNull(), F.array(F.col("late_posting_id")))
         .when(F.col("closest_posting_id").isNotNull(), F.array(F.col("closest_posting_id")))
         .otherwise(_empty_ids()).alias("matched_posting_ids"),
        F.when(F.col("late_posting_id").isNotNull(), "delayed")
         .when(F.col("closest_posting_id").isNotNull(), "unmatched_closest_candidate")
         .otherwise("missing_posting").alias("match_method"),
        F.lit(False).alias("is_matched"), F.lit(None).cast("date").alias("actual_settlement_date")))

    split_ids = split_lines.groupBy(ID).agg(F.array_sort(F.collect_list("posting_id")).alias("matched_posting_ids"),
                                            F.max("posting_date").alias("actual_settlement_date"))
    outcomes = (
        split.join(split_ids, ID).select(
            ID, F.col("summed_amount").alias("matched_amount"), "matched_posting_ids",
            F.lit("split_match").alias("match_method"), F.lit(True).alias("is_matched"), "actual_settlement_date")
        .unionByName(brk))
    agreed = whole.where(F.col("single_posting_id").isNotNull()).select(
        "*", F.col("single_amount").alias("matched_amount"), F.array("single_posting_id").alias("matched_posting_ids"),
        F.lit("single_match").alias("match_method"), F.lit(True).alias("is_matched"),
        F.col("single_posting_date").alias("actual_settlement_date"))
    others = persist(_match_rows(left_open.join(outcomes, ID, "left")), "open_matches")
    matches = _match_rows(agreed).unionByName(others)
    settled = single.select(ID, F.col("posting_date").alias("actual_settlement_date")).unionByName(
        split_lines.groupBy(ID).agg(F.max("posting_date").alias("actual_settlement_date"))
        .join(split.select(ID), ID, "left_semi"))
    return Reconciliation(windows, candidates, first, single.drop("posting_date"), split, split_lines, late, best,
                          brk, matches, settled)


def _match_rows(batches: DataFrame) -> DataFrame:
    return batches.select(
        ID, "merchant_id", "batch_date", "expected_payout_date", "window_end_date",
        "expected_settlement_amount",
        F.col("matched_amount").cast(MONEY).alias("actual_cash_received"),
        F.coalesce(F.col("matched_posting_ids"), _empty_ids()).alias("matched_posting_ids"),
        "match_method",
        F.coalesce("is_matched", F.lit(False)).alias("is_matched"), "actual_settlement_date")


FIRST = ["single_posting_id", "single_amount", "single_posting_date", "closest_posting_id", "closest_posting_amount", "closest_amount_diff"]


def scored_batches(batches: DataFrame, cal: DataFrame, policy: Policy, candidates: DataFrame) -> DataFrame:
    """Every batch of ``batch_windows`` (without its tolerance) with its row of ``pass_one`` and ``has_candidates``.

    A closest candidate that is the match itself isn't stored twice (``_first_of`` gives it back).
    """
    first = pass_one(candidates).withColumn("has_candidates", F.lit(True))
    same = (F.col("closest_posting_id") == F.col("single_posting_id")) & F.col("closest_posting_amount").eqNullSafe(F.col("single_amount"))
    own = batches.select(ID, "merchant_id", "batch_date", "expected_payout_date", "expected_settlement_amount").join(first, ID, "left") \
        .withColumn("closest_is_single", F.coalesce(same, F.lit(False)))
    for c in ("closest_posting_id", "closest_posting_amount"):
        own = own.withColumn(c, F.when(~F.col("closest_is_single"), F.col(c)))
    return batch_windows(own, cal, policy, (*FIRST, "has_candidates", "closest_is_single")).drop("payout_business_day_seq", "amount_tolerance")


def _first_of(whole: DataFrame) -> DataFrame:
    """``pass_one``'s rows, one per batch id, from the stored ``scored_batches``."""
    given = {"closest_posting_id": "single_posting_id", "closest_posting_amount": "single_amount"}
    return whole.where("has_candidates").select(
        ID, *[F.when(F.col("closest_is_single"), F.col(given[c])).otherwise(F.col(c)).alias(c) if c in given else c for c in FIRST]).dropDuplicates([ID])


def posting_claims(matches: DataFrame, matched_only: bool = False) -> DataFrame:
    """(settlement_batch_id, posting_id) for every id listed on a match row."""
    m = matches.where(F.col("is_matched")) if matched_only else matches
    return m.select(ID, F.explode("matched_posting_ids").alias("posting_id"))

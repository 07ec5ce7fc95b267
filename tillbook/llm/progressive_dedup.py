"""Exact de-duplication by progressive refinement, DataFrame operations only.

Three levels, each on what the one before left undecided: rows that share
their length in bytes, of these the rows that share a hash of their first
``PREFIX`` characters, and only of these the SHA-256 of the whole text is
taken and grouped.  A row that stands alone at any level is no copy.

What a level leaves is a sieve: a bit table of ``CELLS`` times 64 bits of the
keys that occur more than once.  Its size is fixed, so it is broadcast and no
text is shuffled; a bit that another key set costs a needless hash and nothing
else.  The text is read twice, once for lengths and prefixes, once for the
hashes of survivors.  A group of copies is one row of a pre-aggregated table;
at most ``HEAVY`` groups can hold a ``HEAVY``-th of all rows each, these meet
their rows by broadcast, and the rest has no key that large to join on.

Defined results: null text counts as empty; of equal texts the row with the
largest id stays; null ids count as smaller than any; of rows that repeat both
id and text one stays; an empty table gives an empty one; extra columns are
ignored (``mark_duplicates``) or pass through (``keep_one``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillbook.session import materialize

PREFIX = 256
CELLS = 1 << 18
HEAVY = 1000
_LEVELS = ("length", "prefix")
_GROUP = ["_length", "_prefix", "_full"]


def mark_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    carry: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, n_bytes`` of every row, and the columns of ``carry``.

    ``carry`` names expressions on ``docs`` to be kept per row; they are
    shuffled with the rows, so they should be short.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    carried = F.struct(*[c.alias(k) for k, c in carry.items()]) if carry else F.lit(None).cast("struct<none:int>")
    scan = docs.select(F.col(id_col).alias("_id"), text.alias("_text"), F.octet_length(text).cast("long").alias("_length"),
                       F.xxhash64(F.substring(text, 1, PREFIX)).alias("_prefix"), carried.alias("_carry"))

    facts = materialize(scan.select("_length", "_prefix"), "facts")
    keys = {"length": ["_length"], "prefix": ["_length", "_prefix"]}
    sieves = {}
    for level in _LEVELS:
        left = _sifted(facts, sieves, keys).where(_passes(sieves))
        again = left.groupBy(*keys[level]).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        sieves[level] = materialize(_sieve(again, keys[level]), f"sieve-{level}")

    full = F.when(_passes(sieves), F.unhex(F.sha2("_text", 256)))
    rows = materialize(_sifted(scan, sieves, keys).select("_id", F.monotonically_increasing_id().alias("_row"), "_length", "_prefix",
                                                          full.alias("_full"), "_carry"), "rows")
    n = rows.count()
    groups = materialize(rows.where("_full IS NOT NULL").groupBy(*_GROUP)
                         .agg(F.max(F.struct("_id", "_row")).alias("_keep"), F.count(F.lit(1)).alias("_size")).where("_size > 1"), "groups")
    heavy = F.broadcast(groups.where(F.col("_size") * HEAVY > n))            # fewer than HEAVY groups
    light = groups.where(F.col("_size") * HEAVY <= n)
    hashed = rows.where("_full IS NOT NULL")
    alone = rows.where("_full IS NULL").withColumns({"_keep": F.lit(None).cast(groups.schema["_keep"].dataType), "_size": F.lit(1).cast("long")})
    order = alone.columns
    marked = (alone.unionByName(hashed.join(heavy, _GROUP).select(order))
              .unionByName(hashed.join(heavy, _GROUP, "left_anti").join(light, _GROUP, "left").select(order)))
    single = F.col("_keep").isNull()
    out = [F.col("_id").alias("doc_id"), F.when(single, F.col("_id")).otherwise(F.col("_keep._id")).alias("keep_id"),
           F.coalesce("_size", F.lit(1).cast("long")).alias("group_size"),
           (single | (F.col("_keep._row") == F.col("_row"))).alias("kept"), F.col("_length").alias("n_bytes")]
    return marked.select(*out, *([F.col(f"_carry.{k}") for k in carry] if carry else []))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the copies: of every group of equal texts the row with the largest id."""
    number = "_number"
    while number in {c.lower() for c in docs.columns}:
        number += "_"
    rows = materialize(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    gone = mark_duplicates(rows, id_col, text_col, {number: F.col(number)}).where("NOT kept").select(number)
    return rows.join(gone, number, "left_anti").drop(number)


def _place(keys: list[str]) -> tuple[Column, Column]:
    """Cell and bit of a key in its level's sieve."""
    h = F.xxhash64(*keys)
    return F.pmod(h, F.lit(CELLS)).cast("int"), F.pmod(F.shiftright(h, 32), F.lit(64)).cast("int")


def _sieve(keys_again: DataFrame, keys: list[str]) -> DataFrame:
    """At most ``CELLS`` rows of 64 bits."""
    cell, bit = _place(keys)
    return keys_again.select(cell.alias("cell"), bit.alias("bit")).groupBy("cell").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))


def _sifted(rows: DataFrame, sieves: dict[str, DataFrame], keys: dict[str, list[str]]) -> DataFrame:
    """Rows with a column ``_on_<level>`` that says whether the row's bit is set."""
    for level, sieve in sieves.items():
        cell, bit = _place(keys[level])
        rows = (rows.withColumns({"cell": cell, "_bit": bit}).join(F.broadcast(sieve), "cell", "left")
                .withColumn(f"_on_{level}", F.expr("coalesce(shiftrightunsigned(bits, _bit) & 1L, 0L) = 1L")).drop("cell", "_bit", "bits"))
    return rows


def _passes(sieves: dict[str, DataFrame]) -> Column:
    on = F.lit(True)
    for level in sieves:
        on = on & F.col(f"_on_{level}")
    return on

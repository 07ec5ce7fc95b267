"""A bit table of a key set, of fixed size, to drop rows before they are shuffled.

``build`` hashes keys to ``CELLS`` times 64 bits: at most ``CELLS`` rows of
one long, whatever the number of keys, so the table may be broadcast at any
scale.  A row whose bit isn't set has none of the keys; a row whose bit is set
may have one (keys share bits), so the exact join still follows.  With far
more keys than bits the sieve lets everything pass and only costs its lookup.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELLS = 1 << 18


def _place(cols: list[str], cells: int) -> tuple[Column, Column]:
    h = F.xxhash64(*cols)
    return F.pmod(h, F.lit(cells)).cast("int"), F.pmod(F.shiftright(h, 32), F.lit(64)).cast("int")


def build(keys: DataFrame, cols: list[str], cells: int = CELLS) -> DataFrame:
    """``_cell, _bits`` of the keys; at most ``cells`` rows."""
    cell, bit = _place(cols, cells)
    return keys.select(cell.alias("_cell"), bit.alias("_bit")).groupBy("_cell").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits"))


def flag(rows: DataFrame, sieve: DataFrame, cols: list[str], name: str, cells: int = CELLS) -> DataFrame:
    """``rows`` with a boolean ``name``: false only where the key is surely not in the set."""
    cell, bit = _place(cols, cells)
    return (rows.withColumns({"_cell": cell, "_bit": bit}).join(F.broadcast(sieve), "_cell", "left")
            .withColumn(name, F.expr("coalesce(shiftrightunsigned(_bits, _bit) & 1L, 0L) = 1L")).drop("_cell", "_bit", "_bits"))


def keep(rows: DataFrame, sieve: DataFrame, cols: list[str], cells: int = CELLS) -> DataFrame:
    """Rows that may have one of the keys; ``cells`` as it was built with."""
    return flag(rows, sieve, cols, "_on", cells).where("_on").drop("_on")

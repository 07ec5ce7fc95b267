"""Row content fingerprints for Bronze lineage."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = 16


def row_hash(*cols: str | Column) -> Column:
    """64-bit content fingerprint of the given columns as 16 lower-case hex digits.

    The first digits of the SHA-256 of all values as text, each marked with its
    length and null as ``N``, so that no two rows share a text ('a','bc' and
    'ab','c', null and ''). Any engine with SHA-256 gives the same digits, and
    it runs inside whole-stage codegen.
    """
    def marked(c: str | Column) -> Column:
        text = (F.col(f"`{c}`") if isinstance(c, str) else c).cast("string")
        return F.coalesce(F.concat(F.char_length(text).cast("string"), F.lit(":"), text), F.lit("N"))
    return F.substring(F.sha2(F.concat(*[marked(c) for c in cols]), 256), 1, DIGITS)


def row_hash_sql(*cols: str) -> str:
    """The same fingerprint in ANSI SQL."""
    marked = " || ".join(f"coalesce(CAST(length(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), 'N')" for c in cols)
    return f"substr(sha256({marked}), 1, {DIGITS})"

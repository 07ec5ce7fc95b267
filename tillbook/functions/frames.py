"""One-row frames put side by side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_row(*frames: DataFrame) -> DataFrame:
    """A single row with the columns of several frames of at most one row each.

    The frames are stacked, each with the others' columns as nulls, and folded
    by ``max`` per column: every frame is computed once, and nothing is joined.
    A frame without rows leaves its columns null. Column names must differ.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(F.col(f"`{c}`")).alias(c) for c in stacked.columns])

"""Size bounds: what may be broadcast.

Literal and file-backed relations need no hint: the planner knows their size and broadcasts them
below its threshold. The check here is for derived relations, whose size it cannot know.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
"""Rows a broadcast side may have; rows here are narrow (keys and a few numbers)."""


def broadcast_if_small(df: DataFrame, sized_by: DataFrame | None = None,
                       limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` only when a count proves it small; otherwise leave the join to shuffle.

    ``sized_by`` is a cheap relation that bounds ``df`` from above (for a per-group aggregate:
    the group dimension), so that the check does not run the aggregate itself. The count stops
    at the limit.
    """
    probe = df if sized_by is None else sized_by
    return F.broadcast(df) if probe.limit(limit + 1).count() <= limit else df


def spread_nulls(key: str, row_id: str) -> Column:
    """Join key whose NULLs become distinct negative numbers, so that they do not share one task.

    For left joins on non-negative whole-number keys: a missing key still matches nothing.
    """
    return F.coalesce(F.col(key), -F.pmod(F.xxhash64(row_id), F.lit(2 ** 62)) - 1)

"""Join with a small side of known size."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Rows of the small side up to which it is sent to every executor. Lookups here are a few hundred bytes a row.
BROADCAST_ROWS = 200_000


def join_bounded(rows: DataFrame, small: DataFrame, on, how: str, rows_bound: int) -> DataFrame:
    """Equi-join with a side that holds at most `rows_bound` rows, a number the caller has counted or derived.

    The planner cannot see that an aggregate or a file listing is small, so the broadcast is asked for here, up to
    BROADCAST_ROWS. Beyond it the planner decides; its sort-merge join splits skewed partitions (AQE). Plain dimension
    tables take no hint anywhere: the planner knows their size."""
    return rows.join(F.broadcast(small) if rows_bound <= BROADCAST_ROWS else small, on, how)

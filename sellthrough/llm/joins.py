"""Join on keys of which a few may hold a large part of all rows."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sellthrough.operators.joins import join_bounded

# Rows from which a key counts as hot. There are at most rows / OFTEN such keys, and a key below it is a small group.
OFTEN = 10_000


def join_split(rows: DataFrame, keys: DataFrame, on: list[str], how: str = "inner", often: int = OFTEN, merge: bool = True) -> DataFrame:
    """rows joined (inner or left) with keys, which has each key once, with n, the rows that have it. The few hot keys go to the rows, so that
    none gathers in one task. The others meet in a merge join at every size, or with merge=False (narrow rows) in the join that the planner chooses."""
    hot = keys.filter(F.col("n") >= often)
    n_hot = hot.count()
    few = keys.filter(F.col("n") < often) if n_hot else keys
    few = few.hint("merge") if merge else few
    if not n_hot:
        return rows.join(few, on, how)
    cold = join_bounded(rows, hot.select(*on), on, "left_anti", n_hot).join(few, on, how)
    return cold.unionByName(join_bounded(rows, hot, on, "inner", n_hot))

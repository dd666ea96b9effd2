"""State along a file that is read in splits: each line or chunk changes it in one of a few ways, and such changes can be joined."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def with_state(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """rows in order, each either setting a state (to_state 0 or 1) or flipping it (flips 1) or leaving it (flips 0), with the state before
    each: `fixed` if an earlier row has set it, else `turned` times flipped from the start's."""
    upto = Window.partitionBy(*keys).orderBy(order)
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("all_flips", F.sum("flips").over(upto.rowsBetween(Window.unboundedPreceding, 0)))
    last = F.last(F.when(F.col("to_state").isNotNull(), F.struct("to_state", "all_flips")), True).over(before)
    rows = rows.withColumn("last", last).withColumn("turned", F.coalesce(F.sum("flips").over(before), F.lit(0)))
    return rows.withColumn("fixed", (F.col("last.to_state") + F.col("turned") - F.col("last.all_flips")) % 2).drop("last")


def counted_before(rows: DataFrame, columns: dict[str, str], keys: list[str], order: str) -> DataFrame:
    """rows with the sum of each column over all rows before, in order; `columns` maps it to the sum's name."""
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumns({name: F.coalesce(F.sum(c).over(before), F.lit(0)) for c, name in columns.items()})

"""Connected components of a graph that no single machine holds."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sellthrough.session import materialise


def _stars(edges: DataFrame, wider: bool) -> DataFrame:
    """One step of the large-star (wider) or small-star algorithm: neighbours of a node are hung on their smallest one."""
    if wider:
        near = edges.select(F.col("a").alias("n"), F.col("b").alias("m")).union(edges.select("b", "a"))
    else:
        near = edges.select(F.greatest("a", "b").alias("n"), F.least("a", "b").alias("m"))
    low = near.groupBy("n").agg(F.min("m").alias("low")).select("n", F.least("n", "low").alias("low"))
    hung = near.join(low, "n")
    if wider:
        return hung.filter("m > n").select(F.col("low").alias("a"), F.col("m").alias("b")).distinct()
    return (hung.select(F.col("low").alias("a"), F.col("m").alias("b"))
            .union(low.select(F.col("low"), F.col("n"))).filter("a < b").distinct())


def _is_done(edges: DataFrame) -> bool:
    """Every node is either a centre or hangs on one centre only."""
    ends = edges.select(F.col("a").alias("n"), F.lit(0).alias("hangs")).union(edges.select("b", F.lit(1)))
    return ends.groupBy("n").agg(F.sum("hangs").alias("times"), F.min("hangs").alias("low")).filter("times > 1 or (times = 1 and low = 0)").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (a, b): component is the smallest node that can be reached.

    Rounds of large-star and small-star, logarithmic in the length of the longest path; each is written to the shared folder. Only
    a yes or no reaches the driver. Loops and repeated edges are allowed; no edges give no rows."""
    now = materialise(edges.filter("a is not null and b is not null and a <> b")
                      .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    while not _is_done(now):
        now = materialise(_stars(_stars(now, True), False), "edges")
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).union(now.select("a", F.col("a")).distinct())

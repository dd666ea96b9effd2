"""Mixing sources to target weights by Efraimidis-Spirakis sampling (operator 10).

Every source gets a share of a budget by its weight, but no more than `most` times its own size; what stands above is dealt again by
weight until none is above. A source's target is filled with complete epochs (every document once more) first. The rest comes from a
weighted sample without replacement: each document draws the key -ln(u) / quality, and the documents of the smallest keys are taken up
to the rest. u is a digest of doc_id, text size and seed, so reruns agree.

The prefix sum is taken in two steps, so no source has to be sorted as one group: keys fall into ranges by their size, sums by range
(partial sums, one row per source and range) show the one range of each source in which the rest ends, and only that is sorted. The number
of ranges follows the number of documents."""
from __future__ import annotations

from dataclasses import dataclass
from itertools import cycle

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from sellthrough.operators.joins import join_bounded
from sellthrough.session import local_rows, materialise


@dataclass(frozen=True)
class Mix:
    """weights: of the sources by code point of their names (null last), repeated as needed. most: epochs at most. seed: of the
    draw. in_range: documents of a source that a range of keys holds on average."""
    weights: tuple[float, ...] = (1, 2, 3)
    most: int = 3
    seed: int = 10
    in_range: int = 2000


def word_count(text: Column) -> Column:
    """Runs of characters other than space and 0x09-0x0D; 0 for null."""
    found = F.size(F.array_remove(F.split(text.cast("string"), r"[\x20\x09-\x0D]+"), ""))
    return F.when(text.isNull(), F.lit(0)).otherwise(found).cast("long")


def targets(sizes: list[tuple[str | None, int]], p: Mix) -> list[tuple[str | None, int, float]]:
    """(source, size, target) from the sources' sizes: one row per source, a list as short as the mix has weights to give."""
    ordered = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    weight = dict(zip((s for s, _ in ordered), cycle(p.weights)))
    size = dict(ordered)
    budget, target, free = float(sum(size.values())), {}, [s for s, _ in ordered]
    while free:
        total = sum(weight[s] for s in free)
        above = [s for s in free if budget * weight[s] / total > p.most * size[s]] if total else free
        if not above:
            target |= {s: budget * weight[s] / total for s in free}
            break
        target |= {s: float(p.most * size[s]) for s in above}
        budget -= sum(p.most * size[s] for s in above)
        free = [s for s in free if s not in set(above)]
    return [(s, size[s], target[s]) for s, _ in ordered]


def _uniform(p: Mix) -> Column:
    """A number in (0, 1) from the digest of document and seed: the 48 first bits, moved off 0."""
    digest = F.md5(F.concat_ws(":", F.lit(str(p.seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("size").cast("string")))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def mix(documents: DataFrame, p: Mix = Mix(), quality: DataFrame | None = None) -> DataFrame:
    """One row per document: doc_id, text_hash (of Spark's xxhash64), source, size, source_size, target, copies and taken (copies * size).

    quality: (doc_id, weight); documents without a positive one weigh 1. Null text has size 0; null sources are a source; rows that repeat
    are documents of their own (with equal keys, told apart by nothing: either may be taken). A source of size 0 has target 0 and takes
    nothing. Empty tables give no rows. Other columns are ignored."""
    rows = documents.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), word_count(F.col("text")).alias("size"),
                            F.xxhash64("text").alias("text_hash"))
    rows = materialise(rows, "sizes")
    # One row per source reaches the driver; sources are the mix's own parameter and as few as its weights.
    found = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    planned = targets([(r.source, r["size"]) for r in found], p)
    schema = T.StructType([T.StructField("of", T.StringType()), T.StructField("source_size", T.LongType()),
                           T.StructField("target", T.DoubleType()), T.StructField("epochs", T.LongType()), T.StructField("rest", T.DoubleType())])
    plan = []
    for source, size, target in planned:
        epochs = min(p.most, int(target // size)) if size else 0
        plan.append((source, size, target, epochs, target - epochs * size))
    plan = local_rows(rows.sparkSession, plan, schema)
    ranges = max(1, max((r.n for r in found), default=1) // p.in_range)

    if quality is not None:
        best = quality.select(F.col("doc_id").cast("long"), F.col("weight").cast("double")).groupBy("doc_id").agg(F.max("weight").alias("weight"))
        rows = rows.join(best, "doc_id", "left").withColumn("weight", F.when(F.col("weight") > 0, F.col("weight")).otherwise(1.0))
    else:
        rows = rows.withColumn("weight", F.lit(1.0))
    key = -F.log(_uniform(p)) / F.col("weight")
    rows = rows.withColumn("key", key).withColumn("range", F.floor((1 - F.exp(-F.col("key"))) * ranges).cast("long"))
    rows = join_bounded(rows, plan, F.col("source").eqNullSafe(F.col("of")), "inner", len(planned)).drop("of")

    sums = rows.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    before = F.coalesce(F.sum("range_size").over(W.partitionBy("source").orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sums = sums.withColumn("before", before).withColumnRenamed("source", "of").withColumnRenamed("range", "of_range")
    rows = rows.join(sums, F.col("source").eqNullSafe(F.col("of")) & (F.col("range") == F.col("of_range")))
    rows = rows.drop("of", "of_range").withColumn("left", F.col("rest") - F.col("before"))
    rows = materialise(rows, "ranged")
    split = (F.col("left") > 0) & (F.col("left") < F.col("range_size"))
    whole = rows.filter(~split).withColumn("more", (F.col("left") > 0).cast("long"))
    # A document that crosses the end is taken if that comes nearer to the target.
    until = F.sum("size").over(W.partitionBy("source", "range").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0))
    part = rows.filter(split).withColumn("until", until)
    part = part.withColumn("more", (F.col("until") - F.col("size") / 2 <= F.col("left")).cast("long")).drop("until")
    return whole.unionByName(part).select(
        "doc_id", "text_hash", "source", "size", "source_size", "target",
        F.when(F.col("size") > 0, F.least(F.col("epochs") + F.col("more"), F.lit(p.most))).otherwise(0).cast("long").alias("copies")).withColumn(
        "taken", F.col("copies") * F.col("size"))

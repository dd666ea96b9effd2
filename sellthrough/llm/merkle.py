"""Merkle manifest of a table: a tree per source and one over the sources, with proofs for every row (operator 11).

Labels. A node carries the interval [lo, hi) of the leaf ranks that it covers, so one node lies below another if its interval lies within
the other's; no pointers are kept. Ranks come from a range-sorted copy of the leaves: a row's place in its partition and the sums of the
partitions before it, so no source is sorted as one group.

Containment joins. `band` levels are made at once: the nodes that share an ancestor `band` levels up form a bucket, which `lo` names. A leaf
joins the bucket that covers it, finds the node of each level that contains it, and takes as siblings what is left of the parent's interval
without that node's. What lies above a bucket is attached to the bucket, not to its leaves: a proof travels to `fan ** band` leaves as one row.

A bucket holds at most `fan ** band` nodes of its lowest level, whatever the size of a source. All levels together have half as many nodes
again as there are leaves (for a fan of 3). One digest, the root, reaches the driver."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from sellthrough.operators.joins import join_bounded
from sellthrough.session import materialise

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


@dataclass(frozen=True)
class Manifest:
    """fan: consecutive nodes that become one. band: levels to a bucket."""
    fan: int = 3
    band: int = 4


def leaf_digest(*values: Column) -> Column:
    """SHA-256 of the values, each `-` if null, else its bytes' count, `:` and itself."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def ranked(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """The rows with lo and hi (rank within tree by `order`, and the next one) and n (rows of the tree). The columns of order must tell all
    rows of a tree apart, so that ties are no hot key of the sort."""
    placed = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    placed = materialise(placed.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")), name)
    parts = placed.groupBy("tree", "part").agg(F.min("place").alias("first"), F.count("*").alias("held"))
    earlier = F.sum("held").over(W.partitionBy("tree").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    parts = materialise(parts.select("tree", "part", (F.coalesce(earlier, F.lit(0)) - F.col("first")).alias("shift"),
                                     F.sum("held").over(W.partitionBy("tree")).alias("n")), f"{name}-parts")
    found = join_bounded(placed, parts, ["tree", "part"], "inner", parts.count())
    lo = F.col("place") + F.col("shift")
    return found.select(*rows.columns, "n", lo.alias("lo"), (lo + 1).alias("hi"))


def _above(below: Column, level: int, p: Manifest) -> Column:
    """The nodes over `below`, the nodes of a level in order; none if the tree ends there."""
    def joined(run: Column) -> Column:
        return F.struct(F.get(run, 0).lo.alias("lo"), F.element_at(run, -1).hi.alias("hi"),
                        F.sha2(F.array_join(F.transform(run, lambda x: x.digest), ""), 256).alias("digest"))

    runs = F.transform(F.sequence(F.lit(0), F.ceil(F.size(below) / p.fan).cast("int") - 1), lambda i: joined(F.slice(below, i * p.fan + 1, p.fan)))
    return F.when(F.col("n") > p.fan ** level, runs).otherwise(F.slice(below, 1, 0))


def _bands(nodes: DataFrame, most: int, name: str, p: Manifest) -> list[DataFrame]:
    """For each band of levels its buckets: tree, n, bucket, the nodes of its levels l0, l1, ... and the digest on top of them."""
    bands, level = [], 0
    while True:
        names = [f"l{k}" for k in range(p.band + 1)]
        rows = nodes.groupBy("tree", "n", F.expr(f"lo div {p.fan ** (level + p.band)}").alias("bucket")).agg(
            F.sort_array(F.collect_list(F.struct("lo", "hi", "digest"))).alias("l0"))
        for k in range(p.band):
            rows = rows.withColumn(names[k + 1], _above(F.col(names[k]), level + k, p))
        top = F.coalesce(*[F.get(F.col(x), 0) for x in reversed(names)])
        bands.append(materialise(rows.withColumn("top", top), name))
        level += p.band
        if most <= p.fan ** level:
            return bands
        nodes = bands[-1].filter(F.col("n") > p.fan ** level).select("tree", "n", "top.*")


def _ends(bands: list[DataFrame], k: int, p: Manifest) -> Column:
    """Whether a tree's topmost node lies in band k."""
    above = F.col("n") > p.fan ** (k * p.band) if k else F.lit(True)
    return above & (F.col("n") <= p.fan ** ((k + 1) * p.band))


def _roots(bands: list[DataFrame], p: Manifest) -> DataFrame:
    found = [rows.filter(_ends(bands, k, p)).select("tree", "n", F.col("top.digest").alias("digest")) for k, rows in enumerate(bands)]
    out = found[0]
    for rows in found[1:]:
        out = out.union(rows)
    return out


def _attached(nodes: DataFrame, buckets: DataFrame, level: int, p: Manifest) -> DataFrame:
    """Nodes of a band's lowest level joined with the bucket that covers them: path gets their siblings to the left and right, a level after
    another, then those above the bucket."""
    size = p.fan ** (level + p.band)
    rows = nodes.withColumn("bucket", F.expr(f"lo div {size}")).join(buckets.drop("n", "top"), ["tree", "bucket"])

    def digests(run: Column, kept) -> Column:
        return F.array_join(F.transform(F.filter(run, kept), lambda x: x.digest), "")

    steps = []
    for k in range(p.band):
        width = p.fan ** (level + k)
        # The parent's interval holds these nodes; without the one that contains lo its siblings are left.
        family = F.slice(F.col(f"l{k}"), (F.expr(f"(lo - bucket * {size}) div {width * p.fan}") * p.fan + 1).cast("int"), p.fan)
        step = F.struct(digests(family, lambda x: x.hi <= F.col("lo")).alias("left"), digests(family, lambda x: x.lo > F.col("lo")).alias("right"))
        steps.append(F.when(F.col("n") > width, step))
    own = F.filter(F.array(*steps), lambda s: s.isNotNull())
    return rows.select(*nodes.columns, F.concat(own, F.col("path")).alias("path"), "subroot")


def _nothing() -> Column:
    return F.array().cast("array<struct<left:string,right:string>>")


def _with_paths(leaves: DataFrame, bands: list[DataFrame], over: DataFrame | None, p: Manifest) -> DataFrame:
    """The leaves with their path. over: (tree, path, subroot) of what lies above each tree; None if nothing does."""
    above = None
    for k in reversed(range(len(bands))):
        level = k * p.band
        # The rows over a bucket: of the node that it is in the band above, or of its tree if that ends here. One row each.
        ended = bands[k].filter(_ends(bands, k, p)).select("tree", "bucket")
        ended = ended.join(over, "tree") if over is not None else ended.select("*", _nothing().alias("path"), F.lit("").alias("subroot"))
        parents = ended if above is None else ended.unionByName(
            above.select("tree", F.expr(f"lo div {p.fan ** (level + p.band)}").alias("bucket"), "path", "subroot"))
        buckets = bands[k].join(parents, ["tree", "bucket"])
        nodes = leaves if k == 0 else bands[k].select("tree", "n", F.explode("l0").alias("x")).select("tree", "n", "x.lo")
        above = _attached(nodes, buckets, level, p)
        if k:
            above = materialise(above, "paths")
    return above


@dataclass(frozen=True)
class Tree:
    """The manifest: leaves (row columns with tree, n, lo, hi), bands of the leaf trees and of the tree over sources, root."""
    leaves: DataFrame
    bands: list[DataFrame]
    sources: DataFrame
    source_bands: list[DataFrame]
    root: str | None

    def nodes(self, p: Manifest = Manifest()) -> DataFrame:
        """(source, level, lo, hi, digest) of all nodes of the leaf trees."""
        out = None
        for k, rows in enumerate(self.bands):
            levels = F.array(*[F.struct(F.lit(k * p.band + i).alias("level"), F.col(f"l{i}").alias("of")) for i in range(1 if k else 0, p.band + 1)])
            rows = rows.select("tree", F.explode(levels).alias("x")).select("tree", "x.level", F.explode("x.of").alias("y"))
            rows = rows.select(_source(F.col("tree")).alias("source"), "level", "y.*")
            out = rows if out is None else out.union(rows)
        return out


def _tree_name(source: Column) -> Column:
    """A name that is never null and sorts as the source, null first."""
    return F.coalesce(F.concat(F.lit(" "), source.cast("string")), F.lit(""))


def _source(tree: Column) -> Column:
    return F.when(tree != "", F.substr(tree, F.lit(2)))


def build(leaves: DataFrame, p: Manifest = Manifest()) -> Tree:
    """The trees over leaves (source, doc_id, leaf and other columns): per source by doc_id (null first; equal ids by leaf), then over sources."""
    rows = leaves.select("*", _tree_name(F.col("source")).alias("tree"), F.monotonically_increasing_id().alias("row"))
    rows = ranked(materialise(rows, "leaves"), ["doc_id", "leaf", "row"], "ranked")
    most = rows.agg(F.max("n")).first()[0] or 0
    bands = _bands(rows.withColumn("digest", F.col("leaf")), most, "band", p)
    roots = _roots(bands, p).select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    sources = ranked(roots, ["name"], "sources")
    source_bands = _bands(sources, sources.agg(F.max("n")).first()[0] or 0, "source-band", p)
    top = _roots(source_bands, p).first()
    return Tree(rows, bands, sources, source_bands, top and top["digest"])


def proofs(documents: DataFrame, now: Column, p: Manifest = Manifest()) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof (structs of the siblings' digests to the left and right, lowest level first),
    proof_sha256, folded_root (from the leaf with `now` as its text, and the proof) and verified (it is the root).

    Nulls in any column are hashed as nulls; rows without source form a tree, rows without doc_id come first in theirs. Rows that repeat are
    leaves of their own, next to each other. A lone leaf is its tree's root. Other columns are ignored; an empty table gives no rows."""
    leaf = leaf_digest(*[F.col(c) for c in FIELDS])
    changed = leaf_digest(*[now if c == "text" else F.col(c) for c in FIELDS])
    tree = build(documents.select(F.col("doc_id"), F.col("source").cast("string"), leaf.alias("leaf"),
                                  F.when(~now.eqNullSafe(F.col("text")), changed).alias("leaf_now")), p)
    over = _with_paths(tree.sources.select("tree", "n", "lo", "name", "digest"), tree.source_bands, None, p)
    over = materialise(over.select(F.col("name").alias("tree"), "path", F.col("digest").alias("subroot")), "over")
    rows = _with_paths(tree.leaves.select("tree", "n", "lo", "doc_id", "leaf", "leaf_now"), tree.bands, over, p)
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s.left, s.right)), "")
    folded = F.aggregate("path", F.coalesce("leaf_now", "leaf"), lambda at, s: F.sha2(F.concat(s.left, at, s.right), 256))
    return rows.select("doc_id", "leaf", "subroot", F.lit(tree.root).cast("string").alias("root"), F.col("path").alias("proof"),
                       F.sha2(siblings, 256).alias("proof_sha256"), folded.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))

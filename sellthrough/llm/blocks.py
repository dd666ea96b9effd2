"""Members that share keys, brought together in tasks of bounded size, so that each pair of a key meets or is linked already.

A key's members are never crossed as they are. First every member meets the smallest one that it shares a key with, which is linear in the
members. What links that finds make parts; keys whose members lie in one part are done. The members of the others form clusters, whose blocks
meet each other unless all their members are of one part: a group of copies stays linear, and only what is left apart is crossed. With
`open_tasks` only large keys make clusters and a small key's members meet in the key, as keys that few members share by chance would chain much
of a table into one cluster."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from sellthrough.llm.graph import connected_components
from sellthrough.llm.joins import OFTEN, join_split
from sellthrough.operators.joins import join_bounded
from sellthrough.session import materialise, release


def shared_keys(rows: DataFrame, often: int = OFTEN, slices: int = 1) -> DataFrame:
    """(key, node, n, low): the members of each key that several nodes share, how many, and the smallest. rows: (node, key), each once. Keys of the
    same members are one. Most keys have one member, so `slices` of them are looked at one after the other, whose shuffle files then don't add up."""
    parts = []
    for i in range(slices):
        of_slice = rows.filter(F.pmod("key", F.lit(slices)) == i) if slices > 1 else rows
        keys = materialise(of_slice.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("low")).filter("n > 1"), "keys")
        parts.append(materialise(join_split(of_slice, keys, ["key"], often=often), "shared"))
        release(keys)
    found = reduce(DataFrame.unionByName, parts)
    alike = found.groupBy("key", "n", "low").agg(F.max("node").alias("high"), F.bit_xor(F.xxhash64("node")).alias("all"))
    alike = materialise(alike.groupBy("n", "low", "high", "all").agg(F.min("key").alias("key")).select("key", "n"), "alike")
    members = materialise(join_split(found.drop("n"), alike, ["key"], often=often), "members")
    release(alike, *parts)
    return members


def smallest_partners(members: DataFrame) -> DataFrame:
    """(node, low): the smallest node that each node shares a key with; none for those that are it themselves."""
    return members.groupBy("node").agg(F.min("low").alias("low")).filter("low < node")


def star_tasks(partners: DataFrame, weights: DataFrame, block: int) -> DataFrame:
    """Tasks (task, node, part, asks, holds) in which each node, held, meets its partner, who asks. weights: (node, weight); a task's nodes weigh
    `block` together, about."""
    chunks = partners.join(weights, "node")
    many = chunks.groupBy("low").agg(F.ceil(F.sum("weight") / block).cast("int").alias("chunks"))
    chunks = materialise(chunks.join(many, "low").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")), "chunks")
    task = F.xxhash64("low", "chunk").alias("task")
    holders = chunks.select(task, "node", F.col("node").alias("part"), F.lit(False).alias("asks"), F.lit(True).alias("holds"))
    askers = chunks.select(task, F.col("low").alias("node"), F.col("low").alias("part"), F.lit(True).alias("asks"), F.lit(False).alias("holds"))
    return holders.union(askers.distinct())


def _labelled(members: DataFrame, partners: DataFrame, parts: DataFrame) -> DataFrame:
    rows = members.join(parts, "node", "left").join(partners.withColumnRenamed("low", "partner"), "node", "left")
    return rows.withColumn("part", F.coalesce("part", "node"))


def _open_keys(labelled: DataFrame) -> DataFrame:
    keys = labelled.groupBy("key", "n", "low").agg(F.min("part").alias("one"), F.max("part").alias("two"), F.max_by("partner", "node").alias("partner"))
    # Two members that are apart though one has met the other need no second meeting.
    return materialise(keys.filter("one < two and not (n = 2 and partner = low)").select("key", "n", "low"), "open")


def _clustered(left: DataFrame) -> DataFrame:
    """(node, part, cluster) of (low, node, part)."""
    clusters = connected_components(left.select(F.col("low").alias("a"), F.col("node").alias("b")))
    return materialise(left.select("node", "part").distinct().join(clusters.withColumnRenamed("component", "cluster"), "node"), "clustered")


def open_members(members: DataFrame, partners: DataFrame, parts: DataFrame) -> DataFrame | None:
    """(node, part, cluster) of the members of keys whose members are of several parts. None if there are none. parts: (node, part), a node that isn't
    listed is its own part."""
    labelled = _labelled(members, partners, parts)
    keys = _open_keys(labelled).select("key")
    if keys.isEmpty():
        return None
    return _clustered(materialise(join_bounded(labelled, keys, "key", "left_semi", keys.count()).select("low", "node", "part"), "left"))


def open_tasks(members: DataFrame, partners: DataFrame, parts: DataFrame, block: int, few: int) -> DataFrame | None:
    """Tasks (task, node, part, asks, holds) in which each two members of a key and different parts meet. None if there are none. A key of up to `few`
    members is a task. Of larger ones, a member comes once for each node that is the smallest of an open key, not for each such key, and clusters
    meet in blocks of `block` members. parts: (node, part), a node that isn't listed is its own part."""
    labelled = materialise(_labelled(members, partners, parts), "labelled")
    keys = _open_keys(labelled)
    n_small, n_large = keys.agg(F.count_if(F.col("n") <= few), F.count_if(F.col("n") > few)).first()
    tasks = []
    if n_small:
        small = join_bounded(labelled.filter(F.col("n") <= few), keys.filter(F.col("n") <= few).select("key"), "key", "left_semi", n_small)
        tasks.append(small.select(F.col("key").alias("task"), "node", "part", F.lit(True).alias("asks"), F.lit(True).alias("holds")))
    if n_large:
        lows = keys.filter(F.col("n") > few).select("low").distinct()
        large = labelled.filter(F.col("n") > few).select("low", "node", "part").distinct()
        large = _clustered(materialise(join_bounded(large, lows, "low", "left_semi", n_large), "left"))
        tasks.append(block_tasks(large.withColumn("weight", F.lit(1)), block))
    return materialise(tasks[0].union(tasks[-1]) if len(tasks) > 1 else tasks[0], "tasks") if tasks else None


def block_tasks(members: DataFrame, block: int) -> DataFrame:
    """Tasks (task, node, part, asks, holds) in which each two members (cluster, node, part, weight) of a cluster and different parts meet."""
    weight = F.sum("weight")
    large = members.groupBy("cluster", "part").agg(weight.alias("weight")).filter(F.col("weight") >= block).select("cluster", "part", F.lit(True).alias("large"))
    rows = members.join(large, ["cluster", "part"], "left").withColumn("side", F.when(F.col("large"), F.col("part")))
    # A side is a large part, which need not meet itself, or all small parts together.
    sides = materialise(rows.groupBy("cluster", "side").agg(F.ceil(weight / block).cast("int").alias("blocks")), "sides")
    one, two = (sides.select("cluster", *[F.col(c).alias(f"{c}_{x}") for c in ("side", "blocks")]) for x in "lr")
    small = F.col("side_l").isNull()
    pairs = one.join(two, "cluster").filter(small | (F.col("side_l") < F.col("side_r")))
    pairs = pairs.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("blocks_l") - 1))).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks_r") - 1)))
    pairs = pairs.filter(~small | F.col("side_r").isNotNull() | (F.col("i") <= F.col("j")))
    pairs = pairs.withColumn("task", F.xxhash64("cluster", "side_l", "side_r", "i", "j"))
    ends = F.explode(F.array(*[F.struct(F.col(f"side_{x}").alias("side"), F.col(k).alias("block"), F.lit(x == "l").alias("asks")) for x, k in ("li", "rj")]))
    ends = pairs.select("cluster", "task", ends.alias("x")).select("cluster", "task", "x.*")
    ends = ends.groupBy("cluster", "task", "side", "block").agg(F.max("asks").alias("asks"), F.min("asks").alias("only_asks"))
    named = F.coalesce(F.col("side").cast("string"), F.lit(""))
    rows = rows.withColumn("side_name", named).join(sides.select("cluster", named.alias("side_name"), "blocks"), ["cluster", "side_name"])
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).drop("side", "blocks", "large", "weight")
    ends = ends.select("cluster", "task", named.alias("side_name"), "block", "asks", (~F.col("only_asks")).alias("holds"))
    return rows.join(ends, ["cluster", "side_name", "block"]).select("task", "node", "part", "asks", "holds")


def document_links(rows: DataFrame, classes: DataFrame, by: list[str]) -> DataFrame:
    """Links (a, b) between the nodes of classes that share a document. rows: (doc_id, *by) of all documents, classes: (*by, node)."""
    known = rows.filter("doc_id is not null").select("doc_id", *by)
    several = known.groupBy("doc_id").agg(F.min(F.struct(*by)).alias("a"), F.max(F.struct(*by)).alias("z")).filter("a < z").select("doc_id")
    several = known.join(several, "doc_id").distinct().join(classes.select(*by, "node"), by).select("doc_id", "node")
    return several.join(several.groupBy("doc_id").agg(F.min("node").alias("a")), "doc_id").select("a", F.col("node").alias("b"))


def component_ids(classes: DataFrame, links: DataFrame, by: list[str]) -> DataFrame:
    """(*by, n, component_id) of classes (*by, node, least_id, n): the smallest document id that links reach."""
    named = classes.select(*by, "node", "least_id", "n").join(connected_components(links), "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    return materialise(named.join(least, "component").select(*by, "n", "component_id"), "named")

"""Near-duplicate documents: MinHash signatures joined by their Hamming distance through several indexes (operator 3).

1. Every text becomes its set of word shingles, a digest of that set and a signature of MinHash symbols of one byte.
2. Texts with equal sets form a class, which one of its texts stands for; only classes go on.
3. Multi-index Hamming join. The first `chunks * symbols` symbols are split into chunks. If two signatures differ there in at most
   `chunks * (errors + 1) - 1` symbols, then by pigeonhole they differ in at most `errors` symbols of some chunk. The allowed errors are
   enumerated by leaving out each choice of `errors` positions: signatures that agree on what is left meet under one key.
4. Members of keys are compared by whole signatures in tasks of bounded size (see `blocks`): each with the smallest class that it shares a key
   with, then what is still apart, in its key if that is small, else in blocks. Tasks return spanning forests of close pairs, never the pairs.
   Their components are clusters: all links lie within one.
5. The same again within clusters, now with texts: the pairs of those forests, then what is still apart in blocks, are confirmed on the full
   sets unless they are linked already. The components of
   confirmed links are the result, so no link between components is lost, and a group of copies makes as many rows as it has members.

With 25 chunks of 5 symbols and one error all pairs with up to 49 differing symbols of 125 meet for certain; a pair of similarity
0.8 differs in 25 on average, and misses all keys with a chance of 3e-15. Of 128 symbols it differs in 26, in more than 64 with one of 7e-15."""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sellthrough.llm.blocks import block_tasks, component_ids, document_links, open_tasks, shared_keys, smallest_partners, star_tasks
from sellthrough.llm.bytewords import mix, shingle_sets, slices
from sellthrough.llm.graph import connected_components
from sellthrough.llm.joins import join_split
from sellthrough.operators.joins import join_bounded
from sellthrough.session import materialise


@dataclass(frozen=True)
class NearDupes:
    """width: words of a shingle. percent: least similarity. chunks, symbols, errors: the join's part of the signature. size: symbols of the
    signature; far: pairs with more differing ones aren't compared. signed: members that are compared at once by signatures (a megabyte holds 8192).
    few: members up to which a key is small. block: shingles of the members that are compared at once with texts (each counts `row` more)."""
    width: int = 5
    percent: int = 80
    chunks: int = 25
    symbols: int = 5
    errors: int = 1
    size: int = 128
    far: int = 64
    signed: int = 4096
    few: int = 64
    block: int = 250_000
    row: int = 500


def _mixers(n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(3)).integers(1, 1 << 63, (2, n), dtype=np.uint64) | np.uint64(1)


def _signature(items: np.ndarray, mixers: np.ndarray) -> bytes:
    """A byte for each mixer: of the smallest mixed item."""
    least = np.full(mixers.shape[1], np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(items), 2048):
        part = (items[at:at + 2048, None] ^ mixers[0]) * mixers[1]
        least = np.minimum(least, part.min(axis=0))
    return (mix(least) >> np.uint64(56)).astype(np.uint8).tobytes()


def _matrix(signatures: pa.Array, p: NearDupes) -> np.ndarray:
    return np.frombuffer(b"".join(signatures.to_pylist()), np.uint8).reshape(-1, p.size)


def _digest(items: np.ndarray) -> tuple[int, int]:
    other = mix(items ^ np.uint64(0x5851F42D4C957F2D))
    return int(items.sum(dtype=np.uint64).astype(np.int64)), int(other.sum(dtype=np.uint64).astype(np.int64))


def signatures(documents: DataFrame, p: NearDupes = NearDupes()) -> DataFrame:
    """doc_id, n_shingles, class (two numbers, a digest of the set) and signature of every document; the last is null for an empty set."""
    schema = "doc_id long, n_shingles long, class_a long, class_b long, signature binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixers = _mixers(p.size)
        for batch in batches:
            for row, end, data, starts in slices(batch.column("text")):
                n, a, b, signs = [], [], [], []
                for items in shingle_sets(data, starts, p.width):
                    n.append(len(items))
                    for numbers, x in zip((a, b), _digest(items)):
                        numbers.append(x)
                    signs.append(_signature(items, mixers) if len(items) else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(row, end - row), pa.array(n, pa.int64()), pa.array(a, pa.int64()),
                     pa.array(b, pa.int64()), pa.array(signs, pa.binary())],
                    names=["doc_id", "n_shingles", "class_a", "class_b", "signature"])

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def _digested(documents: DataFrame, p: NearDupes) -> DataFrame:
    """doc_id, digest of the set, and text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, starts in slices(batch.column("text")):
                found = [_digest(items) for items in shingle_sets(data, starts, p.width)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(row, end - row), pa.array([x for x, _ in found], pa.int64()),
                     pa.array([x for _, x in found], pa.int64()), batch.column("text").slice(row, end - row)],
                    names=["doc_id", "class_a", "class_b", "text"])

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, class_a long, class_b long, text string")


def _keyed(signed: DataFrame, p: NearDupes) -> DataFrame:
    """(node, n_shingles, signature, keys): a key for each chunk and choice of error positions."""
    kept = list(combinations(range(p.symbols), p.symbols - p.errors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signs = _matrix(batch.column("signature"), p)[:, :p.chunks * p.symbols]
            signs = signs.reshape(-1, p.chunks, p.symbols).astype(np.uint64)
            keys = np.empty((batch.num_rows, p.chunks * len(kept)), np.int64)
            for chunk in range(p.chunks):
                for n, places in enumerate(kept):
                    key = np.full(batch.num_rows, chunk * len(kept) + n, np.uint64)
                    for place in places:
                        key = key * np.uint64(0x100000001B3) + signs[:, chunk, place]
                    keys[:, chunk * len(kept) + n] = mix(key).astype(np.int64)
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * keys.shape[1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel()))], names=[*batch.schema.names, "keys"])

    return signed.mapInArrow(run, "node long, n_shingles long, signature binary, keys array<long>")


def _close_pairs(pairs: DataFrame, signed: DataFrame, p: NearDupes) -> DataFrame:
    """The pairs (a, b) whose set sizes and signatures allow the similarity."""
    sides = [signed.select(F.col("node").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("signature").alias(f"s_{x}")) for x in "ab"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = pa.array((_matrix(batch.column("s_a"), p) != _matrix(batch.column("s_b"), p)).sum(axis=1) <= p.far)
            yield pa.RecordBatch.from_arrays([batch.column(x).filter(good) for x in "ab"], names=["a", "b"])

    found = pairs.join(sides[0], "a").join(sides[1], "b")
    return found.filter(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * p.percent).mapInArrow(run, "a long, b long")


def _allowed(signs: np.ndarray, sizes: np.ndarray, row: int, others: np.ndarray, p: NearDupes) -> tuple[np.ndarray, np.ndarray]:
    """Which of the others are close to a row, and how many symbols are apart."""
    apart = (signs[others] != signs[row]).sum(axis=1)
    alike = np.minimum(sizes[others], sizes[row]) * 100 >= np.maximum(sizes[others], sizes[row]) * p.percent
    return (apart <= p.far) & alike, apart


class _Block:
    """The rows of one task's table, and the forest of the new links between those of a task that ask and those that hold. Rows of one part
    are linked already."""

    def __init__(self, table: pa.Table, p: NearDupes) -> None:
        self.p, self.texts = p, table.column("text") if "text" in table.column_names else None
        self.nodes, self.sizes, self.parts = (table.column(c).to_numpy() for c in ("node", "n_shingles", "part"))
        self.signs = _matrix(table.column("signature"), p)

    def _set(self, row: int) -> np.ndarray:
        text = self.texts.slice(row, 1).combine_chunks()
        return next(items for _, _, data, starts in slices(text) for items in shingle_sets(data, starts, self.p.width))

    def forest(self, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[int, int]]:
        """The closest pairs of a row are tried first, linked ones not again. A row at a time, so that memory is that of the rows, not of their pairs."""
        rows = np.union1d(left, right)
        label = np.arange(len(self.nodes))
        _, first, back = np.unique(self.parts[rows], return_index=True, return_inverse=True)
        label[rows] = rows[first][back]
        sets: dict[int, np.ndarray] = {}

        def texts(row: int) -> np.ndarray:
            if row not in sets:
                sets[row] = self._set(row)
            return sets[row]

        def confirmed(one: int, some: np.ndarray) -> np.ndarray:
            if self.texts is None:
                return np.ones(len(some), bool)
            x, ys = texts(one), [texts(other) for other in some.tolist()]
            sizes, items = np.array([len(y) for y in ys]), np.concatenate(ys)
            same = x[np.minimum(np.searchsorted(x, items), len(x) - 1)] == items
            both = np.add.reduceat(same, np.cumsum(sizes) - sizes, dtype=np.int64)
            return 100 * both >= self.p.percent * (len(x) + sizes - both)

        for row in left.tolist():
            others = right[label[right] != label[row]]
            good, apart = _allowed(self.signs, self.sizes, row, others, self.p)
            others, many = others[good][np.argsort(apart[good], kind="stable")], 1
            while len(others):  # more at once the longer none is linked
                some = others[:many]
                for other in some[confirmed(row, some)].tolist():
                    if label[other] != label[row]:
                        yield int(self.nodes[row]), int(self.nodes[other])
                        label[rows[label[rows] == label[other]]] = label[row]
                others, many = others[many:], many * 2
                others = others[label[others] != label[row]]


def _forests(tasks: DataFrame, facts: DataFrame, weight: Column, block: int, p: NearDupes) -> DataFrame:
    """Links (a, b) found by tasks (task, node, part, asks, holds) over facts (node, n_shingles, signature and, if pairs are to be confirmed, text)."""
    heavy = tasks.join(facts.select("node", weight.alias("weight")), "node").agg(F.sum("weight")).first()[0] or 0

    def run(table: pa.Table) -> pa.Table:
        rows, found, start = _Block(table, p), [], 0
        task = table.column("task").to_numpy()
        asks, holds = (np.array(table.column(c).to_pylist(), bool) for c in ("asks", "holds"))
        order = np.lexsort((rows.nodes, task))
        for end in np.flatnonzero(np.append(task[order][1:] != task[order][:-1], True)) + 1:
            some = order[start:end]
            start = end
            found += rows.forest(some[asks[some]], some[holds[some]])
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([x for _, x in found], pa.int64())})

    packed = tasks.join(facts, "node").withColumn("pack", F.pmod(F.xxhash64("task"), F.lit(int(heavy // block) + 1)))
    return materialise(packed.groupBy("pack").applyInArrow(run, "a long, b long"), "links")


def _one_a_part(links: DataFrame, parts: DataFrame) -> DataFrame:
    """One of the links (a, b) between each two parts, as tasks of several keys find the same."""
    for x in "ab":
        links = links.join(parts.select(F.col("node").alias(x), F.col("part").alias(f"part_{x}")), x, "left").withColumn(f"part_{x}", F.coalesce(f"part_{x}", x))
    both = [F.least("part_a", "part_b").alias("x"), F.greatest("part_a", "part_b").alias("y")]
    return materialise(links.groupBy(*both).agg(F.min(F.struct("a", "b")).alias("link")).select("link.*"), "near")


def near_duplicates(documents: DataFrame, p: NearDupes = NearDupes()) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id that links reach) and kept (it is that document).

    Null or empty texts have no shingles and are linked with nothing, nor are rows without doc_id given a component (null, not kept), though they
    carry links on. Repeated rows come back as often as they are given. Rows that share a doc_id but not a text are one document with the links of
    all its texts. Other columns are ignored. An empty table gives no rows."""
    signed_all = materialise(signatures(documents, p), "signatures")
    linked = signed_all.filter("signature is not null")
    by = ["class_a", "class_b", "n_shingles"]
    classes = linked.groupBy(*by).agg(F.min("doc_id").alias("least_id"), F.count("*").alias("n"), F.first("signature").alias("signature"))
    classes = materialise(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    signed = materialise(_keyed(classes.select("node", "n_shingles", "signature"), p), "signed")

    # Clusters, by signatures.
    members = shared_keys(signed.select("node", F.explode("keys").alias("key")))
    signed = signed.drop("keys")
    partners = smallest_partners(members)
    close = materialise(_close_pairs(partners.select(F.col("low").alias("a"), F.col("node").alias("b")), signed, p), "close")
    parts = connected_components(close).withColumnRenamed("component", "part")
    tasks = open_tasks(members, partners, parts, p.signed, p.few)
    near = close
    if tasks is not None:
        near = close.union(_one_a_part(_forests(tasks, signed, F.lit(1), p.signed, p), parts))
    clusters = connected_components(near).withColumnRenamed("component", "cluster")

    # Links, by texts.
    wanted = materialise(classes.select("node", "least_id", "signature", *by).join(clusters, "node"), "wanted")
    some = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ids = wanted.select(F.col("least_id").alias("doc_id")).distinct()
    some = join_bounded(some.filter("doc_id is not null"), ids, "doc_id", "left_semi", wanted.count())
    nameless = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).filter("doc_id is null")
    texts = _digested(some.union(nameless), p).withColumnRenamed("doc_id", "least")
    same = F.col("least").eqNullSafe(F.col("least_id")) & (texts["class_a"] == wanted["class_a"]) & (texts["class_b"] == wanted["class_b"])
    texts = texts.join(wanted, same).select("node", "cluster", "n_shingles", "signature", "text")
    texts = materialise(texts.dropDuplicates(["node"]), "texts")
    weight = F.col("n_shingles") + p.row
    tasks = star_tasks(near.select(F.col("b").alias("node"), F.col("a").alias("low")), texts.select("node", weight.alias("weight")), p.block)
    links = _forests(tasks, texts.drop("cluster"), weight, p.block, p)
    parts = connected_components(links).withColumnRenamed("component", "part")
    labelled = texts.select("node", "cluster", weight.alias("weight")).join(parts, "node", "left").withColumn("part", F.coalesce("part", "node"))
    # Of two members, one has asked for the other, as the link that made them a cluster is a task whichever step found it.
    mixed = labelled.groupBy("cluster").agg(F.min("part").alias("one"), F.max("part").alias("two"), F.count("*").alias("n")).filter("one < two and n > 2")
    labelled = materialise(labelled.join(mixed.select("cluster"), "cluster", "left_semi"), "labelled")
    links = links.union(_forests(block_tasks(labelled, p.block), texts.drop("cluster"), weight, p.block, p))

    links = links.union(document_links(linked, classes, by))
    out = join_split(linked.select("doc_id", *by), component_ids(classes, links, by), by).select("doc_id", "n_shingles", "component_id")
    out = out.union(signed_all.filter("signature is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    out = out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))

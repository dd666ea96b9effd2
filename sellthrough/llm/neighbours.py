"""Approximate nearest neighbours by an inverted multi-index (operator 9).

1. A bounded sample trains one codebook for each half of the vectors; a vector's cell is its pair of nearest centroids.
2. The index is every vector with its cell, dealt into blocks by the first centroid; a block of many vectors is split by vec_id.
3. A query walks the cells in the order of the summed distance of their two centroids, with a heap over two sorted lists, until the cells
   hold `share` of all vectors (at least `least`). The number of vectors in each cell is a table of centroids x centroids numbers.
4. A query goes once to each block that it touches, with the list of second centroids it wants there; the block reranks those entries by
   exact distance and returns its best; the best of all blocks are the answer.

Cost is queries x share x vectors: with vectors spread evenly over all directions no index finds the nearest without looking at a good part
of them, so share is what buys recall; lower it for clustered vectors."""
from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from sellthrough.session import materialise


@dataclass(frozen=True)
class MultiIndex:
    """sample: vectors that train the codebooks. centroids: most in a half. entries, queries: most vectors and queries of one block."""
    k: int = 10
    sample: int = 20_000
    centroids: int = 64
    rounds: int = 12
    share: float = 0.5
    least: int = 2_500
    entries: int = 16_384
    queries: int = 4_096
    seed: int = 9


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that take part: an id, finite components, not all zero, and the most frequent number of components."""
    v = F.col("embedding").cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = embeddings.select(F.col("vec_id").cast("long"), v.alias("v")).filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & good)
    sizes = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").limit(1).collect()
    return rows.filter(F.size("v") == (sizes[0].n if sizes else 0))


def _square(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (points ** 2).sum(1)[:, None] - 2 * points @ centroids.T + (centroids ** 2).sum(1)[None]


def _codebook(points: np.ndarray, n: int, p: MultiIndex) -> np.ndarray:
    """Lloyd's algorithm; an empty centroid moves to the point that is farthest from its own."""
    pick = np.random.Generator(np.random.PCG64(p.seed)).permutation(len(points))[:n]
    centroids = points[pick].copy()
    for _ in range(p.rounds):
        far = _square(points, centroids)
        own = far.argmin(1)
        lost = far[np.arange(len(points)), own]
        for c in range(len(centroids)):
            mine = own == c
            if mine.any():
                centroids[c] = points[mine].mean(0)
            else:
                at = int(lost.argmax())
                centroids[c], lost[at] = points[at], -1
    return centroids


def _vectors(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


def _walk(first: np.ndarray, second: np.ndarray, held: np.ndarray, enough: int) -> dict[int, list[int]]:
    """Cells in the order of summed distance until they hold enough vectors: second centroids by first centroid."""
    one, two = first.argsort(kind="stable"), second.argsort(kind="stable")
    heap, seen, got, cells = [(first[one[0]] + second[two[0]], 0, 0)], {(0, 0)}, 0, {}
    while heap and got < enough:
        _, i, j = heapq.heappop(heap)
        n = int(held[one[i], two[j]])
        if n:
            got += n
            cells.setdefault(int(one[i]), []).append(int(two[j]))
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(one) and b < len(two) and (a, b) not in seen:
                seen.add((a, b))
                heapq.heappush(heap, (first[one[a]] + second[two[b]], a, b))
    return cells


def nearest(vectors: DataFrame, queries: DataFrame, p: MultiIndex = MultiIndex()) -> DataFrame:
    """query_id, rank (from 1), vec_id and score (Euclidean distance) of the k nearest found of each query, ties to the smaller vec_id.

    Both sides are (vec_id, v) as `usable` gives them. A query's own id is no candidate; ids that repeat count once, at their smallest
    distance. Fewer candidates than k are all returned. Empty sides give no rows."""
    spark, schema = vectors.sparkSession, "query_id long, rank int, vec_id long, score double"
    total = vectors.count()
    asked = queries.count()
    trained = vectors.orderBy(F.xxhash64("vec_id", F.lit(p.seed)), "vec_id").limit(p.sample).select("v").toArrow()
    if not total or not asked:
        return spark.createDataFrame([], schema)
    points = _vectors(trained.column("v").combine_chunks())
    half = points.shape[1] // 2
    n = max(1, min(p.centroids, len(points), math.isqrt(total)))
    books = [_codebook(points[:, :half], n, p), _codebook(points[:, half:], n, p)]

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _vectors(batch.column("v"))
            a, b = (_square(x, book).argmin(1).astype(np.int32) for x, book in zip((v[:, :half], v[:, half:]), books))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(a), pa.array(b)], names=["vec_id", "v", "c1", "c2"])

    index = materialise(vectors.mapInArrow(cells, "vec_id long, v array<double>, c1 int, c2 int"), "index")
    held = np.zeros((n, n), np.int64)
    for r in index.groupBy("c1", "c2").agg(F.count("*").alias("n")).collect():  # at most centroids ** 2 numbers
        held[r.c1, r.c2] = r.n
    parts = [max(1, -(-int(x) // p.entries)) for x in held.sum(1)]
    enough = max(p.least, math.ceil(p.share * total))
    groups = max(1, -(-asked // p.queries))

    def walks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _vectors(batch.column("v")) if batch.num_rows else np.zeros((0, 2 * half))
            a, b = _square(v[:, :half], books[0]), _square(v[:, half:], books[1])
            for i in range(batch.num_rows):
                found = _walk(a[i], b[i], held, enough)
                one = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([one.column(0)[0].as_py()] * len(found), pa.int64()), pa.array([v[i]] * len(found), pa.list_(pa.float64())),
                     pa.array(list(found), pa.int32()), pa.array(list(found.values()), pa.list_(pa.int32())),
                     pa.array([parts[c] for c in found], pa.int32())], names=["vec_id", "v", "c1", "wanted", "parts"])

    sent = queries.select("vec_id", "v").mapInArrow(walks, "vec_id long, v array<double>, c1 int, wanted array<int>, parts int")
    sent = sent.select("vec_id", "v", "c1", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                       F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int").alias("g"), "wanted", F.lit(-1).alias("c2"))
    of_part = F.element_at(F.array(*[F.lit(x) for x in parts]), F.col("c1") + 1)
    stored = index.select("vec_id", "v", "c1", F.pmod(F.xxhash64("vec_id"), of_part).cast("int").alias("part"),
                          F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), F.array().cast("array<int>").alias("wanted"), "c2")

    def rerank(block: pa.Table) -> pa.Table:
        c2 = block.column("c2").to_numpy()
        rows = np.flatnonzero(c2 >= 0)
        asks = np.flatnonzero(c2 < 0)
        ids, v, wanted = block.column("vec_id").to_numpy(), _vectors(block.column("v").combine_chunks()), block.column("wanted")
        rows = rows[np.lexsort((ids[rows], c2[rows]))]
        if len(rows):  # ids that repeat in a cell
            rows = rows[np.r_[True, (ids[rows][1:] != ids[rows][:-1]) | (c2[rows][1:] != c2[rows][:-1]) | (v[rows][1:] != v[rows][:-1]).any(1)]]
        own, x, c = ids[rows], v[rows], c2[rows]
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for q in asks:
            take = np.isin(c, np.array(wanted[int(q)].as_py())) & (own != ids[q])
            if not take.any():
                continue
            near = np.sqrt(((x[take] - v[q]) ** 2).sum(1))
            best = np.flatnonzero(near <= np.partition(near, p.k - 1)[p.k - 1]) if len(near) > p.k else np.arange(len(near))
            best = best[np.lexsort((own[take][best], near[best]))][:p.k]
            out.append((np.full(len(best), ids[q]), own[take][best], near[best]))
        columns = [np.concatenate(x) if out else np.zeros(0) for x in (zip(*out) if out else ((), (), ()))]
        return pa.table({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()), "score": pa.array(columns[2], pa.float64())})

    blocks = sent.select("vec_id", "v", "c1", "part", "g", "wanted", "c2").unionByName(stored).groupBy("c1", "part", "g")
    found = blocks.applyInArrow(rerank, "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    ranked = found.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id")))
    return ranked.filter(F.col("rank") <= p.k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")

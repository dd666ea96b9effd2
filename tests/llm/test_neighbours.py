import numpy as np

from sellthrough.llm.neighbours import MultiIndex, nearest, usable
from .helpers import with_clashes

P = MultiIndex(sample=500, centroids=8, least=50, entries=64, queries=8)


def table(spark, rows):
    return with_clashes(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))


def brute(rows, asked, k=10):
    ids, v = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float32).astype(float)
    out = {}
    for q in asked:
        near = np.sqrt(((v - v[ids == q][0]) ** 2).sum(1))
        order = [i for i in np.lexsort((ids, near)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), near[i]) for i in order]
    return out


def run(spark, rows, asked, p=P):
    vectors = usable(table(spark, rows))
    out = {}
    for r in nearest(vectors, vectors.filter(vectors.vec_id.isin(asked)), p).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def clustered(n=600, dim=8, seed=3):
    g = np.random.default_rng(seed)
    centres = g.normal(size=(10, dim))
    return [(i, (centres[i % 10] + g.normal(size=dim) * 0.3).astype(np.float32).tolist(), i % 10) for i in range(n)]


def test_recall_and_exact_scores(spark):
    rows, asked = clustered(), list(range(0, 600, 20))
    got, want = run(spark, rows, asked), brute(rows, asked)
    hits = sum(len({x for x, _ in got[q]} & {x for x, _ in want[q]}) for q in asked)
    assert hits >= 0.9 * 10 * len(asked)
    exact = run(spark, rows, asked, MultiIndex(sample=500, centroids=8, share=1.0, entries=64, queries=8))
    assert all([x for x, _ in exact[q]] == [x for x, _ in want[q]] and np.allclose([s for _, s in exact[q]], [s for _, s in want[q]], atol=1e-12) for q in asked)


def test_equal_vectors_and_rows_that_take_no_part(spark):
    rows = [(i, [1.0, 2.0, 3.0, 4.0], 0) for i in range(300)] + [(500, [9.0, 9.0, 9.0, 9.0], 1)]
    odd = [(600, None, 0), (601, [0.0] * 4, 0), (602, [1.0, None, 1.0, 1.0], 0), (603, [1.0, float("nan"), 0.0, 0.0], 0), (604, [float("inf"), 0.0, 0.0, 0.0], 0),
           (605, [1.0, 2.0], 0), (606, [], 0), (None, [1.0, 2.0, 3.0, 4.0], 0), rows[3]]
    got = run(spark, rows + odd, [0, 100, 500, 600, 601])
    assert [x for x, _ in got[100]] == list(range(10)) and {s for _, s in got[100]} == {0.0}
    assert [x for x, _ in got[0]] == list(range(1, 11)) and sorted(got) == [0, 100, 500]


def test_fewer_candidates_than_k_and_none(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [1.0, 1.0], 0)]
    assert run(spark, rows, [0])[0] == [(2, 1.0), (1, np.sqrt(2))]
    assert run(spark, rows[:1], [0]) == {} == run(spark, [], [0])

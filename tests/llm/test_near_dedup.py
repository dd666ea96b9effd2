from sellthrough.llm.graph import connected_components
from sellthrough.llm.near_dedup import NearDupes, near_duplicates
from .helpers import components, documents, prose, rng

P = NearDupes(width=4, signed=16, block=1500, row=100)


def answer(spark, rows, p=P):
    return sorted((tuple(r) for r in near_duplicates(documents(spark, rows), p).collect()), key=str)


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (100, 102), (102, 100), (7, 7)]
    got = dict(connected_components(spark.createDataFrame(path, "a long, b long")).collect())
    assert got == {i: 1 for i in range(1, 41)} | {100: 100, 101: 100, 102: 100}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_same_as_brute_force_with_groups_larger_than_a_block(spark):
    r = rng(4)
    rows = []
    for base in range(12):
        words = prose(r, 60).split()
        for copy in range(30 if base == 0 else 3):  # edits on both sides of the threshold
            w = list(words)
            for _ in range(r.randrange(0, 5)):
                w[r.randrange(len(w))] = r.choice(["new", "other"])
            rows.append((len(rows) * 3 + 1, " ".join(w).title() if copy == 1 else "\n ".join(w)))
    want = components(rows)
    got = {d: (n, c) for d, n, c, kept in answer(spark, rows)}
    assert got == want
    assert all(kept == (d == c) for d, n, c, kept in answer(spark, rows))


def test_texts_of_one_id_lose_no_link(spark):
    a, b = prose(rng(8), 60), prose(rng(9), 60)
    rows = [(1, a), (1, b), (2, b + " more"), (3, a + " more"), (4, prose(rng(10), 60))]
    assert sorted({(d, c) for d, _, c, _ in answer(spark, rows)}) == [(1, 1), (2, 1), (3, 1), (4, 4)]


def test_two_texts_that_share_keys_with_a_smaller_third_lose_no_link(spark):
    rows = []
    for k in range(8):  # the third holds both of them, but is far longer
        w = prose(rng(k), 200).split()
        rows += [(3 * k + 1, " ".join(w)), (3 * k + 2, " ".join(w[:120] + ["one"])), (3 * k + 3, " ".join(w[:120] + ["two"]))]
    assert {d: (n, c) for d, n, c, _ in answer(spark, rows)} == components(rows)


def test_pairs_at_the_threshold_whose_signatures_differ_most(spark):
    rows = []
    for k in (49677, 650066, 2954197, 6091348):  # found among eight million: 49 or 50 of 128 symbols differ
        rows += [(k, " ".join(map(str, range(k, k + 8)))), (k + 1, " ".join(map(str, range(k, k + 7))))]
    assert {d: (n, c) for d, n, c, _ in answer(spark, rows)} == components(rows)


def test_odd_rows(spark):
    long = prose(rng(2), 120_000)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  two"), (5, "ONE  two"), (None, "one two"), (6, "two one"),
            (7, long), (8, long + " end"), (9, "x" * 300_000)]
    got = answer(spark, rows)
    assert [g for g in got if g[0] in (1, 2, 3)] == [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True)]
    assert [g for g in got if g[0] in (4, 5, 6)] == [(4, 1, 4, True), (5, 1, 4, False), (5, 1, 4, False), (6, 1, 6, True)]
    assert [g for g in got if g[0] is None] == [(None, 1, None, False)]
    assert [(g[2], g[3]) for g in got if g[0] in (7, 8, 9)] == [(7, True), (7, False), (9, True)]


def test_empty_table(spark):
    assert answer(spark, []) == []

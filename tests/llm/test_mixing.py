import math

from sellthrough.llm.mixing import Mix, mix, targets
from .helpers import documents, prose, rng, space_words


def test_targets_reshare_what_small_sources_cannot_take():
    got = targets([("a", 1000), ("b", 10), (None, 5), ("c", 100)], Mix())
    assert [(s, t) for s, _, t in got] == [("a", 1115 - 30 - 300 - 15), ("b", 30.0), ("c", 300.0), (None, 15.0)]
    assert targets([], Mix()) == [] and targets([("a", 0)], Mix()) == [("a", 0, 0.0)]
    assert math.isclose(sum(t for _, _, t in targets([("a", 50), ("b", 60), ("c", 70)], Mix())), 180)


def test_sources_come_near_their_targets_and_reruns_agree(spark):
    r = rng(2)
    rows = [(i, prose(r, r.randrange(1, 40)), None, r.choice("aaaab") if i % 7 else None, 0) for i in range(900)]
    p = Mix(in_range=20)
    runs = [sorted((r.doc_id, r.source or "", r["size"], r.target, r.copies, r.taken) for r in mix(documents(spark, rows), p).collect()) for _ in range(2)]
    assert runs[0] == runs[1] and len(runs[0]) == len(rows)
    for source in ("a", "b", ""):
        own = [x for x in runs[0] if x[1] == source]
        assert abs(sum(x[5] for x in own) - own[0][3]) <= 40
        assert max(x[4] for x in own) - min(x[4] for x in own) <= 1 and all(x[5] == x[4] * x[2] <= 3 * x[2] for x in own)
    assert {x[0]: x[2] for x in runs[0]} == {i: len(space_words(t)) for i, t, *_ in rows}


def test_quality_is_drawn_more_often(spark):
    rows = [(i, prose(rng(i), 10), None, "ab"[i % 2], 0) for i in range(2000)]
    quality = spark.createDataFrame([(i, 4.0 if i % 4 < 2 else 1.0) for i in range(0, 2000)] + [(0, 2.0), (5, None), (7, -1.0)], "doc_id long, weight double")
    got = mix(documents(spark, rows), Mix(weights=(1, 3)), quality).filter("source = 'a'").collect()
    taken = [sum(r.taken for r in got if (r.doc_id % 4 < 2) is good) for good in (True, False)]
    assert taken[0] > 1.8 * taken[1] > 0


def test_odd_rows(spark):
    rows = [(1, None, None, "a", 0), (2, "", None, "a", 0), (None, "one two", None, "a", 0), (3, "one", None, "b", 0), (3, "one", None, "b", 0),
            (4, " " * 9, None, "c", 0), (5, prose(rng(1), 90_000), None, "d", 0)]
    got = sorted((str(r.doc_id), r["size"], r.source_size, r.copies) for r in mix(documents(spark, rows)).collect())
    assert [g[:3] for g in got] == [("1", 0, 2), ("2", 0, 2), ("3", 1, 2), ("3", 1, 2), ("4", 0, 0), ("5", 90_000, 90_000), ("None", 2, 2)]
    assert all(g[3] == 0 for g in got if g[1] == 0)
    assert mix(documents(spark, [])).collect() == []

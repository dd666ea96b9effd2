import glob
from collections import defaultdict
from dataclasses import replace
from itertools import combinations

from sellthrough.llm.blocks import open_tasks, smallest_partners
from sellthrough.llm.near_dedup import NearDupes, near_duplicates
from sellthrough.session import shared_folder
from .helpers import components, documents, prose, rng


def tasks_of(spark, keys, parts, few):
    """Tasks of {key: nodes}, as (nodes that ask, nodes that hold), with their number of rows and that of the rows that led to them."""
    members = spark.createDataFrame([(k, x, len(nodes), min(nodes)) for k, nodes in keys.items() for x in nodes], "key long, node long, n long, low long")
    known = set(glob.glob(f"{shared_folder(spark)}/sellthrough/left-*"))
    rows = open_tasks(members, smallest_partners(members), spark.createDataFrame(list(parts.items()) or [(-1, -1)], "node long, part long"), 8, few).collect()
    left = sum(spark.read.parquet(x).count() for x in set(glob.glob(f"{shared_folder(spark)}/sellthrough/left-*")) - known)
    found = defaultdict(lambda: (set(), set()))
    for r in rows:
        for side, wanted in zip(found[r.task], (r.asks, r.holds)):
            if wanted:
                side.add(r.node)
    met = {frozenset((a, b)) for asks, holds in found.values() for a in asks for b in holds}
    for nodes in keys.values():
        for a, b in combinations(sorted(nodes), 2):
            done = len(nodes) == 2 and a == min(min(x) for x in keys.values() if b in x)  # the first step has compared them
            assert done or parts.get(a, a) == parts.get(b, b) or frozenset((a, b)) in met
    return list(found.values()), len(rows), left


def test_few_that_are_apart_from_a_large_group_bring_its_members_once(spark):
    r, group = rng(3), range(100)
    keys = {k: {0, *r.sample(group, 60), 100 + k % 3} for k in range(40)}
    _, rows, left = tasks_of(spark, keys, {x: 0 for x in group}, 16)
    assert left == 103  # 40 keys of 62 members
    assert rows < 1000


def test_small_keys_that_share_members_are_not_crossed_as_one(spark):
    keys = {k: {k, k + 1, k + 2} for k in range(300)} | {1000: set(range(400, 440)), 1001: {*range(400, 420), 1}}
    tasks, _, left = tasks_of(spark, keys, {x: 400 for x in range(400, 439)}, 16)
    assert sum(len(asks) * len(holds) for asks, holds in tasks) < 300 * 9 + 61 * 61
    assert left <= 61


def test_links_of_small_and_large_keys_are_those_of_brute_force(spark):
    r, rows = rng(6), []
    for base in range(8):
        words = prose(r, 60).split()
        for copy in range((40, 12, 3)[min(base, 2)]):
            w = list(words)
            for _ in range(r.randrange(0, 6)):
                w[r.randrange(len(w))] = r.choice(["new", "other"])
            rows.append((len(rows) + 1, " ".join(w)))
    for few in (1, 5, 64):
        p = replace(NearDupes(width=4, signed=8, block=1500, row=100), few=few)
        assert {d: (n, c) for d, n, c, _ in near_duplicates(documents(spark, rows), p).collect()} == components(rows)

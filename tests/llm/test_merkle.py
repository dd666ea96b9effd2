import hashlib
import zlib
from itertools import groupby

from pyspark.sql import functions as F

from sellthrough.llm.merkle import FIELDS, Manifest, build, leaf_digest, proofs
from .helpers import DOCS, documents, prose, rng, with_clashes


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def grown(level, fan):
    """All levels from the leaves' digests up to the root."""
    levels = [level]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i:i + fan]) for i in range(0, len(levels[-1]), fan)])
    return levels


def path(levels, at, fan):
    out = []
    for level in levels[:-1]:
        first = at - at % fan
        out.append((level[first:at], level[at + 1:first + fan]))
        at //= fan
    return out


def brute(rows, now, fan=3):
    """Sorted (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified); rows: (doc_id, source, lang, n_chars, text)."""
    ordered = sorted(rows, key=lambda r: (r[1] is not None, (r[1] or "").encode(), r[0] is not None, r[0] or 0, leaf(r)))
    trees = [(s, list(g)) for s, g in groupby(ordered, key=lambda r: r[1])]
    grown_trees = [grown([leaf(r) for r in g], fan) for _, g in trees]
    top = grown([t[-1][0] for t in grown_trees], fan)
    out = []
    for k, (_, g) in enumerate(trees):
        for at, row in enumerate(g):
            steps = path(grown_trees[k], at, fan) + path(top, k, fan)
            folded = leaf((*row[:4], now(row)))
            for left, right in steps:
                folded = H(*left, folded, *right)
            out.append((row[0], leaf(row), grown_trees[k][-1][0], top[-1][0], H(*[x for left, right in steps for x in left + right]), folded, folded == top[-1][0]))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def lost_column():
    return F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))


def lost(row):
    return row[4] and row[4].replace("\n", "") if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 else row[4]


def table(spark, rows):
    return documents(spark, [(d, t, lang, s, n) for d, s, lang, n, t in rows])


def answer(spark, rows, p=Manifest()):
    return sorted((tuple(r) for r in proofs(table(spark, rows), lost_column(), p).select(*COLUMNS).collect()), key=str)


def test_same_as_brute_force(spark):
    r, rows = rng(3), []
    for source, n in ((None, 5), ("", 1), ("a", 28), ("ä", 3), ("b" * 40, 100), ("B", 2), ("b", 9), ("z z", 4)):
        rows += [(r.randrange(10_000), source, r.choice(["en", None]), r.choice([None, 5, 2**40]), r.choice([None, "", prose(r, 5) + "\n" + prose(r, 3), "é\n"])) for _ in range(n)]
    assert answer(spark, rows) == brute(rows, lost)
    assert answer(spark, rows, Manifest(band=1)) == brute(rows, lost)
    assert answer(spark, rows, Manifest(fan=2, band=3)) == brute(rows, lost, 2)


def test_odd_rows(spark):
    same = (7, "a", "en", 1, "x\ny")
    rows = [same, same, same, (7, "a", "en", 1, "z"), (None, "a", None, None, None), (None, None, None, None, None), (8, "a", "fr", 2, "w " * 200_000 + "\n")]
    assert answer(spark, rows) == brute(rows, lost)
    assert answer(spark, rows[:1]) == brute(rows[:1], lost) and len(answer(spark, rows[:1])) == 1
    assert answer(spark, []) == []
    more = with_clashes(table(spark, rows)).withColumns({c: F.lit(1) for c in ("tree", "n", "lo", "hi", "bucket", "leaf", "row", "path", "part", "place", "name")})
    assert sorted((tuple(x) for x in proofs(more, lost_column()).select(*COLUMNS).collect()), key=str) == brute(rows, lost)


def test_nodes_cover_their_leaves(spark):
    rows = [(i, "s", None, None, str(i)) for i in range(30)]
    found = table(spark, rows).select("doc_id", "source", leaf_digest(*map(F.col, FIELDS)).alias("leaf"))
    nodes = {(n.level, n.lo): (n.hi, n.digest) for n in build(found).nodes().collect()}
    levels = grown([leaf(x) for x in rows], 3)
    assert nodes == {(k, i * 3 ** k): (min(30, (i + 1) * 3 ** k), d) for k, level in enumerate(levels) for i, d in enumerate(level)}
    assert DOCS.names

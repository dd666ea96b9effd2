import hashlib

from pyspark.sql import functions as F

from sellthrough.llm.decontaminate import Decontamination, clean_documents, contamination
from .helpers import documents, prose, rng, with_clashes, word_words


def brute(docs, items, window=13):
    wanted = {}
    for item, text in items:
        w = word_words(text)
        m = min(len(w), window)
        for i in range(len(w) - m + 1 if m else 0):
            wanted.setdefault(tuple(w[i:i + m]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w, hit, found = word_words(text), set(), set()
        for m in {len(k) for k in wanted}:
            for i in range(len(w) - m + 1):
                if tuple(w[i:i + m]) in wanted:
                    hit |= set(range(i, i + m))
                    found |= wanted[tuple(w[i:i + m])]
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def run(spark, docs, items):
    table = with_clashes(spark.createDataFrame(items, "item_id long, text string"))
    found = contamination(documents(spark, docs), table)
    found = found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256), "contaminated")
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_same_as_brute_force(spark):
    r = rng(7)
    items = [(i, prose(r, r.randrange(10, 60))) for i in range(20)] + [(20, "amber, Birch: frost"), (21, "ocean"), (22, None), (23, "--")]
    items += [(30, items[3][1]), (31, items[3][1].upper())]
    docs = []
    for i in range(60):
        part = items[r.randrange(20)][1].split()
        a = r.randrange(len(part))
        docs.append((i, prose(r, r.randrange(0, 80)) + " " + " ".join(part[a:a + r.randrange(5, 40)]) + "; " + prose(r, 5)))
    docs += [(100, None), (101, ""), (102, "Ocean!"), (103, items[4][1].upper().replace(" ", "--")), (103, items[4][1]), (104, prose(r, 60_000)), (104, None)]
    assert run(spark, docs, items) == brute(docs, items)


def test_only_long_items_and_repeated_rows(spark):
    r = rng(8)
    passage = prose(r, 13, ["é" + w for w in ("un", "deux", "trois", "ÉCOLE")])
    docs = [(1, f"{passage} and 7 more"), (1, f"{passage} and 7 more"), (2, passage[3:]), (None, passage)]
    assert run(spark, docs, [(1, passage)]) == brute(docs, [(1, passage)])


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a b c")]) == []
    assert run(spark, [(1, "a b c")], []) == brute([(1, "a b c")], [])


def test_clean_documents_keeps_every_column_and_the_null_id(spark):
    docs = documents(spark, [(None, "plain words"), (1, "amber birch cedar delta ember"), (2, "plain words")])
    items = spark.createDataFrame([(1, "Amber, birch. Cedar")], "item_id long, text string")
    left = clean_documents(docs, items, Decontamination(window=3, gram=2))
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == ["2", "None"]

import numpy as np

from sellthrough.llm.substring_dedup import Chunking, cuts, repeated_passages, without_passages
from .helpers import documents, prose, rng

VOCABULARY = [a + b + c for a in "bdfgklmnprst" for b in "aeiou" for c in ("n", "rt", "s", "lo", "mi")]


def test_cuts_depend_on_the_last_bytes_only():
    g = np.random.default_rng(1)
    data = g.integers(0, 256, 4000, dtype=np.uint8)
    moved = np.concatenate((g.integers(0, 256, 777, dtype=np.uint8), data))
    own, other = cuts(data, 5), cuts(moved, 5) - 777
    assert set(own[own > 32]) == set(other[other > 32]) and 60 < len(own) < 250


def test_planted_passages_are_found_and_clean_texts_left(spark):
    r = rng(9)
    passages = [prose(r, 80, VOCABULARY) for _ in range(20)]
    rows = [(i, f"{prose(r, r.randrange(40, 90), VOCABULARY)} {passages[i % 20]} {prose(r, 50, VOCABULARY)}") for i in range(60)]
    clean = [(100 + i, prose(r, 150, VOCABULARY)) for i in range(60)]
    docs = documents(spark, rows + clean)
    found = repeated_passages(docs)
    got = {(x.doc_id, x.first_doc_id) for x in found.collect()}
    assert got == {(i, i % 20) for i in range(20, 60)}
    left = {x.doc_id: x.text for x in without_passages(docs, found).collect()}
    assert all(left[i] == t for i, t in rows[:20] + clean)
    assert all(len(left[i]) < len(t) - 150 and left[i].startswith(t[:100]) for i, t in rows[20:])


def test_odd_rows(spark):
    long = prose(rng(3), 60_000, VOCABULARY)
    text = prose(rng(4), 60, ["é" + w for w in VOCABULARY])
    rows = [(1, None), (2, ""), (3, long), (4, long), (5, text), (5, text), (None, text), (6, "a" * 100_000), (7, text + text)]
    docs = documents(spark, rows)
    found = repeated_passages(docs, Chunking())
    assert {(x.doc_id, x.first_doc_id) for x in found.collect()} == {(4, 3), (7, 5)}
    left = [(x.doc_id, x.text) for x in without_passages(docs, found).collect()]
    assert len(left) == len(rows) and all(len(t) < 2000 for i, t in left if i == 4) and (6, "a" * 100_000) in left and (None, text) in left
    assert repeated_passages(documents(spark, [])).collect() == []


def test_passages_whose_chunks_also_occur_alone_before(spark):
    r = rng(12)
    longer = [a + b for a in VOCABULARY[::3] for b in ("ta", "rus", "nol")]
    passages = [prose(r, 51, longer) for _ in range(40)]
    quotes = []
    for passage in passages:  # pieces of it, each in a document of its own
        w = passage.split()
        quotes += [f"{prose(r, r.randrange(20, 40), longer)} {' '.join(w[i:i + 9])} {prose(r, 20, longer)}" for i in range(0, 44, 2)]
    r.shuffle(quotes)
    twice = [(10_000 + i, f"{prose(r, 40, longer)} {passages[i % 40]} {prose(r, 40, longer)}") for i in range(80)]
    found = repeated_passages(documents(spark, list(enumerate(quotes)) + twice)).collect()
    assert {(x.doc_id, x.first_doc_id) for x in found} == {(10_040 + i, 10_000 + i) for i in range(40)}


def test_passages_in_scripts_of_two_and_three_bytes_a_letter(spark):
    r = rng(13)
    cyrillic = [a + b + c for a in ("бра", "вед", "гор", "дом", "зна") for b in ("о", "е", "и", "у") for c in ("ка", "ть", "ст", "ли", "на", "ро")]
    devanagari = [a + b + c for a in "कखगचजटडतदनपबमरलसह" for b in ("ान", "ित", "ूल", "ेर") for c in ("का", "ती", "नम")]
    rows, later = [], {}
    for k, words in enumerate((cyrillic, devanagari)):
        for i in range(100):
            passage, at = prose(r, 51, words), 1000 * k + i
            rows += [(at + 10_000 * n, f"{prose(r, 40, words)} {passage} {prose(r, 40, words)}") for n in (0, 1)]
            later[at + 10_000] = at
    found = repeated_passages(documents(spark, rows)).collect()
    assert {x.doc_id: x.first_doc_id for x in found} == later

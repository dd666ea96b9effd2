import hashlib
import zlib

import numpy as np
import pytest

from sellthrough.llm.periodic import Runs, find_runs, periodic_runs
from .helpers import documents, prose, rng


def brute(words, least=6, times=4):
    """Every lag's matches; of lags with the same stretch the smallest."""
    found = {}
    for lag in range(1, len(words) // times + 1):
        i = lag
        while i < len(words):
            j = i
            while j < len(words) and words[j] == words[j - lag]:
                j += 1
            if j - i + lag >= max(least, times * lag):
                found.setdefault((i - lag, j - i + lag), lag)
            i = max(j, i + 1)
    return sorted((s, m, q) for (s, m), q in found.items())


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def row(doc_id, text, plant=True):
    """The query's row of a document, as its contract says."""
    words = [w.decode() for w in (text or "").encode().split()]
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if plant and doc_id is not None and h % 10 == 0 and n:
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
    runs = brute(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], digest("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
            digest(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_runs_of_random_words(spark):
    r = rng(1)
    for _ in range(3000):
        n, kinds = r.randrange(0, 90), r.choice([1, 2, 2, 3, 5])
        words = [r.randrange(kinds) for _ in range(n)]
        if n and r.random() < 0.7:
            a, q = r.randrange(n), 1 + r.randrange(n)
            words[a:] = [words[a + (i - a) % q] for i in range(a, n)]
            for _ in range(r.randrange(3)):
                words[r.randrange(n)] = r.randrange(kinds)
        assert find_runs(np.array(words, np.int64)) == brute(words)
    assert find_runs(np.zeros(300_000, np.int64)) == [(0, 300_000, 1)]
    square = np.tile(np.arange(50_000), 4)
    assert find_runs(square) == [(0, 200_000, 50_000)] and find_runs(square[:-1]) == []
    with pytest.raises(ValueError):
        Runs(times=3)


def test_rows_as_the_contract_says(spark):
    r, rows = rng(2), []
    for i in range(150):
        rows.append((i * 7, prose(r, r.randrange(0, 400)) + "\n" + "la " * r.randrange(8) + prose(r, 3, ["Ja", "ja"])))
    odd = [(5001, None), (5002, ""), (5003, " \t\n\x0b\x0c\r"), (5004, "a " * 100_000), (5005, "a\xa0a a a " * 5), (None, "x " * 9), (5006, prose(r, 50_000)), rows[0]]
    found = periodic_runs(documents(spark, rows + odd), plant=True)
    got = [tuple(x) for x in found.drop("collapsed").collect()]
    want = [row(d, t) for d, t in rows + odd if d not in (5004, 5006)]
    assert sorted((x for x in got if x[0] not in (5004, 5006)), key=str) == sorted(want, key=str)
    texts = {x.doc_id: x.collapsed for x in periodic_runs(documents(spark, odd)).collect()}
    assert texts[5004] == "a" and texts[5001] == "" and texts[5002] == "" and texts[None] == "x" and texts[5006] == odd[6][1]
    assert periodic_runs(documents(spark, [])).collect() == []

"""Small tables with everything that can go wrong, and brute-force answers."""
import random
import re

from pyspark.sql import types as T

from sellthrough.session import local_rows

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
# Names that operators use for columns of their own.
CLASHES = ("k", "t", "h", "w", "n", "m", "f", "s", "rep", "group", "key", "size", "weight", "range", "copies", "n_lines", "score", "lang_pred",
           "digest", "start", "first", "bad_lines", "text_hash", "spans", "edits", "batch", "bad_id", "bad_t", "mix_id", "mix_hash", "row", "node", "part", "n_dropped")

WORDS = "amber birch cedar delta ember frost grove heron inlet jetty knoll larch maple north ocean pearl quill ridge stone tulip".split()


def documents(spark, rows):
    """Rows of (doc_id, text) or more columns of DOCS, with columns of clashing names beside them."""
    full = [tuple(r) + (None,) * (5 - len(r)) for r in rows]
    return with_clashes(local_rows(spark, full, DOCS))


def with_clashes(rows):
    from pyspark.sql import functions as F
    return rows.withColumns({c: F.lit("clash") for c in CLASHES if c not in rows.columns})


def prose(rng, n, words=WORDS):
    return " ".join(rng.choice(words) for _ in range(n))


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def word_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def shingles(text, width):
    w = space_words(text)
    return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def components(docs, width=4, percent=80):
    """doc_id -> (set size, smallest reachable doc_id), over all pairs."""
    sets = {d: shingles(t, width) for d, t in docs}
    root = {d: d for d in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]) and top(a) != top(b):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {d: (len(s), top(d)) for d, s in sets.items()}


def rng(seed=1):
    return random.Random(seed)

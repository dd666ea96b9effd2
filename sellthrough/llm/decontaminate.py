"""Benchmark decontamination by winnowing (operator 1), with DataFrame functions only.

1. Words are hashed, every `gram` consecutive words make a k-gram hash, and of every window of `window - gram + 1` k-grams the smallest
   hash is kept as a fingerprint, for documents and benchmark items alike. Two equal runs of `window` words hold the same k-grams, so
   they keep the same smallest one: every shared run of that length is found.
2. Fingerprints are joined; only documents that share one with an item go on, with their shared fingerprints.
3. Each place of a shared fingerprint is extended to the windows of words around it, which are compared with the items' windows word for
   word. Items of fewer words than a window are one window: all runs of their length take the fingerprint's part, at lengths that occur.

The benchmark's fingerprints and windows are broadcast below a counted number of rows and joined by shuffle beyond it."""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from sellthrough.operators.joins import join_bounded
from sellthrough.session import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Decontamination:
    """window: words of a shared run that counts. gram: words of a hashed k-gram. A document is contaminated if one of `share` words is hit."""
    window: int = 13
    gram: int = 5
    share: int = 20


def words(text: Column) -> Column:
    """Runs of letters, digits and characters beyond ASCII, with A-Z lower-cased; none for null."""
    found = F.array_remove(F.split(F.translate(text.cast("string"), UPPER, LOWER), BETWEEN_WORDS), "")
    return F.coalesce(found, F.array().cast("array<string>"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once a row. Projections are merged by the optimiser: a lambda that looks into a column made by
    another function would compute that column again for each element."""
    return F.get(F.transform(F.array(value), body), 0)


def _runs(size: Column, n: int) -> Column:
    """0 .. size - n, where runs of n elements start."""
    return F.when(size >= n, F.sequence(F.lit(0), size - n)).otherwise(F.array().cast("array<int>"))


def _grams(found: Column, n: int) -> Column:
    """The hash of each run of n words."""
    hashes = F.transform(found, lambda x: F.xxhash64(x))
    return _let(hashes, lambda h: F.transform(_runs(F.size(h), n), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(n)])))


def _fingerprints(found: Column, p: Decontamination) -> Column:
    """The distinct smallest k-gram hashes of all windows of words."""
    n = p.window - p.gram + 1
    return F.array_distinct(_let(_grams(found, p.gram), lambda g: F.transform(
        _runs(F.size(g), n), lambda i: F.least(*[F.get(g, i + j) for j in range(n)]))))


def _keyed(documents: DataFrame) -> DataFrame:
    """Rows are told apart by doc_id and text, so that repeated or missing ids do no harm."""
    return documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("k"), F.xxhash64("text").alias("t"),
                            F.col("doc_id").cast("long"), words(F.col("text")).alias("w"))


def contamination(documents: DataFrame, benchmark: DataFrame, p: Decontamination = Decontamination()) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit (words inside an occurrence of an item's window), n_items, items (their ids as sorted
    strings) and contaminated.

    Null or empty texts have no words and no hits. Repeated rows come back as often as they are given. Items without words match nothing;
    one without an id hits words but is not listed. Empty tables give no rows, or rows without hits. Other columns are ignored."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    items = items.withColumn("m", F.least(F.size("w"), F.lit(p.window)))
    windows = items.select("item", "m", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("m") + 1)).alias("s"), "w").select(
        "item", "m", F.array_join(F.slice("w", F.col("s"), F.col("m")), " ").alias("window")).distinct()
    windows = materialise(windows, "windows")
    bound = windows.count()
    short = sorted(r.m for r in windows.filter(F.col("m") < p.window).select("m").distinct().collect())  # at most window - 1 numbers

    prints = items.filter(F.col("m") == p.window).select("m", F.explode(_fingerprints(F.col("w"), p)).alias("f"))
    for m in short:
        prints = prints.union(items.filter(F.col("m") == m).select("m", F.explode(_grams(F.col("w"), m)).alias("f")))
    prints = prints.distinct()

    # One row per document without a fingerprint carries the number of words, so that texts are taken apart once.
    def marks(w: Column) -> Column:
        parts = [_labelled(_fingerprints(w, p), "f", p.window), *(_labelled(F.array_distinct(_grams(w, m)), "f", m) for m in short)]
        mark = F.array(F.struct(F.lit(0).alias("m"), F.lit(0).cast("long").alias("f")))
        return F.struct(F.size(w).cast("long").alias("n_words"), F.concat(*parts, mark).alias("marks"))

    read = _keyed(documents).select("k", "t", "doc_id", _let(F.col("w"), marks).alias("x"))
    read = read.select("k", "t", "doc_id", "x.n_words", F.explode("x.marks").alias("y")).select("k", "t", "doc_id", "n_words", "y.*")
    marked = prints.union(documents.sparkSession.range(1).select(F.lit(0).alias("m"), F.lit(0).cast("long").alias("f")))
    shared = materialise(join_bounded(read, marked, ["m", "f"], "left_semi", bound), "shared")
    found = shared.filter("m > 0").distinct().groupBy("k", "t").agg(F.collect_list(F.struct("m", "f")).alias("x"))

    hits = _occurrences(documents, found, windows, bound, [*short, p.window], p)
    covered = F.array_distinct(F.flatten(F.transform("spans", lambda x: F.sequence(x.s, x.s + x.m - 1))))
    hits = hits.groupBy("k", "t").agg(F.collect_set(F.struct("s", "m")).alias("spans"), F.sort_array(F.collect_set("item")).alias("items"))
    hits = hits.select("k", "t", F.size(covered).cast("long").alias("n_hit"), "items")
    out = shared.filter("m = 0").join(hits, ["k", "t"], "left")
    out = out.select("k", "t", "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items",
                      ((F.col("n_hit") > 0) & (p.share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"), "t")


def _labelled(values: Column, name: str, m: int) -> Column:
    return F.transform(values, lambda x: F.struct(F.lit(m).alias("m"), x.alias(name)))


def _starts(w: Column, shared: Column, m: int, gram: int) -> Column:
    """Starts of the windows of m words that hold a shared k-gram."""
    def of(prints: Column, grams: Column) -> Column:
        places = F.filter(F.transform(grams, lambda g, i: F.when(F.array_contains(prints, g), i)), lambda i: i.isNotNull())
        return F.array_distinct(F.flatten(F.transform(
            places, lambda i: F.sequence(F.greatest(i - (m - gram), F.lit(0)), F.least(i, F.size(w) - m)))))

    prints = F.transform(F.filter(shared, lambda y: y.m == m), lambda y: y.f)
    return _let(prints, lambda f: _let(_grams(w, gram), lambda g: of(f, g)))


def _occurrences(documents: DataFrame, found: DataFrame, windows: DataFrame, bound: int, lengths: list[int], p: Decontamination) -> DataFrame:
    """(k, t, s, m, item): the m words from the s-th of a document on are a window of the item."""
    def spans(w: Column, shared: Column) -> Column:
        starts = F.concat(*[_labelled(_starts(w, shared, m, p.gram if m == p.window else m), "s", m) for m in lengths])
        return F.transform(starts, lambda x: F.struct(x.s, x.m, F.array_join(F.slice(w, x.s + 1, x.m), " ").alias("window")))

    rows = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("k"), F.xxhash64("text").alias("t"), "text")
    rows = rows.join(found, ["k", "t"]).dropDuplicates(["k", "t"])
    rows = rows.select("k", "t", F.explode(_let(words(F.col("text")), lambda w: spans(w, F.col("x")))).alias("y")).select("k", "t", "y.*")
    return join_bounded(rows, windows, ["m", "window"], "inner", bound).select("k", "t", "s", "m", "item")


def clean_documents(documents: DataFrame, benchmark: DataFrame, p: Decontamination = Decontamination()) -> DataFrame:
    """The documents that are not contaminated, as they came. A null doc_id is a value like any other."""
    bad = contamination(documents, benchmark, p).filter("contaminated").select("doc_id", "t").distinct()
    rows = documents.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("k"), F.xxhash64("text").alias("t")).alias("d")
    on = F.col("d.k").eqNullSafe(F.col("b.doc_id")) & (F.col("d.t") == F.col("b.t"))
    return rows.join(bad.alias("b"), on, "left_anti").select("row.*")

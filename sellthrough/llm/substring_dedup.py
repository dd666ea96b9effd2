"""Repeated passages by content-defined chunking (operator 6).

A gear hash rolls over the bytes of a text: h = 2 h + G[byte] modulo 2**16, so it depends on the last 16 bytes. Where its `bits` top
bits are zero a chunk ends; cuts depend on content only, so an insertion moves the cuts near it and none after. The first occurrence (smallest
doc_id, then place) of a digest is kept, every other one is a repeat. Two kinds of spans are repeated, and are cut out of their documents:

- windows: neighbouring chunks, of any length, that hold `words` words together. One digest stands for all of a window, so it is found wherever
  it stood before, and it doesn't matter where its chunks occur alone. Bytes a letter don't matter either, as only words are counted.
- runs: chunks of `anchor` words or more that lie as far from each other as their first occurrences do, with `words` words in all. What is
  between them may differ, so a passage with a few changed words is one run.

Spans of a document that meet are one passage.

Only digests are shuffled, counted in partial sums: a passage of a third of all documents is one row per task. The texts of documents with
a repeated passage are joined to their spans once."""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from sellthrough.llm.bytewords import mix, slices
from sellthrough.session import materialise

_GEAR = np.random.Generator(np.random.PCG64(6)).integers(0, 1 << 16, 256, dtype=np.uint16)
_BYTE = np.random.Generator(np.random.PCG64(66)).integers(1, 1 << 63, 256, dtype=np.uint64)
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)
_GAP = np.zeros(256, bool)
_GAP[[0x20, 9, 10, 11, 12, 13]] = True


@dataclass(frozen=True)
class Chunking:
    """bits: chunks have 2 ** bits bytes on average. anchor: words of a chunk that counts in a run. words: of a window or of a run's chunks at
    least. gap: bytes between two chunks of a run at most."""
    bits: int = 5
    anchor: int = 4
    words: int = 10
    gap: int = 96


def cuts(data: np.ndarray, bits: int) -> np.ndarray:
    """The places after which a chunk ends."""
    h = _GEAR[data]
    for step in (1, 2, 4, 8):  # h over 2, 4, .. 16 bytes, from two halves
        more = h.copy()
        more[step:] += h[:-step] << np.uint16(step)
        h = more
    ends = (h >> np.uint16(16 - bits)) == 0
    ends[1:] &= ~ends[:-1]  # a run of one byte value may be all ends
    return np.flatnonzero(ends) + 1


def _chunks(data: np.ndarray, starts: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, first and last byte within the text, and digest of each chunk of some texts. Texts are cut each for itself."""
    text, first, last, digests = [], [], [], []
    for i, (a, b) in enumerate(zip(starts[:-1], starts[1:])):
        if a == b:
            continue
        part = data[a:b]
        edge = cuts(part, bits)
        edge = np.concatenate(([0], edge, [] if len(edge) and edge[-1] == len(part) else [len(part)])).astype(np.int64)
        text.append(np.full(len(edge) - 1, i))
        first.append(edge[:-1])
        last.append(edge[1:])
        digests.append(_digests(part, edge))
    if not text:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    return tuple(np.concatenate(x) for x in (text, first, last, digests))


def _digests(part: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each chunk: bytes weighed by their place in the chunk."""
    place = np.arange(len(part), dtype=np.uint64) - np.repeat(edge[:-1], np.diff(edge)).astype(np.uint64)
    mixed = mix(_BYTE[part] + place * np.uint64(_STEP))
    return mix(np.add.reduceat(mixed, edge[:-1]) + np.diff(edge).astype(np.uint64))


def _windows(text: np.ndarray, before: np.ndarray, after: np.ndarray, digests: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the window that begins with each chunk: whether it counts, its last chunk, and its digest, that of the chunks in their order. It doesn't
    count if its text ends before `words` words, or if the next window ends alike, as that one is part of it and repeats wherever it does; it
    counts nevertheless where chunks would be in no window otherwise.
    before, after: words up to the chunk's first and last byte."""
    last = np.searchsorted(after, before + words)
    heads = np.flatnonzero(np.diff(last, prepend=-1))  # the first and the last window of those that end alike
    tails = np.append(heads[1:], len(last)) - 1
    used = np.zeros(len(last), bool)
    used[tails] = True
    used[heads[1:][tails[1:] > last[heads[1:] - 1] + 1]] = True
    used &= last < len(after)
    last = np.minimum(last, len(after) - 1)
    used &= text[last] == text
    up, down = (np.cumprod(np.full(len(text), x, np.uint64)) for x in (_STEP, _BACK))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(digests * up)))
    return used, last, mix((sums[last + 1] - sums[:-1]) * down)


def chunk_table(documents: DataFrame, p: Chunking = Chunking()) -> DataFrame:
    """One row per chunk, with places in bytes: doc_id, t (the hash that tells rows with one id apart), start, stop, at (words before it), words,
    digest (null if it has less than `anchor` words), and stop, words and digest of the window that begins with it (null if none counts)."""
    columns = "doc_id long, t long, start long, stop long, at long, words long, digest long, window_stop long, window_words long, window long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, starts in slices(batch.column("text")):
                text, first, last, digests = _chunks(data, starts, p.bits)
                if not len(text):
                    continue
                gaps = _GAP[data]
                before = np.ones(len(data) + 1, bool)
                before[1:-1] = gaps[:-1]
                before[starts] = True
                words = np.concatenate(([0], np.cumsum(before[:-1] & ~gaps)))
                at, after = words[starts[text] + first], words[starts[text] + last]
                whole, until, windows = _windows(text, at, after, digests, p.words)
                rare = after - at < p.anchor
                ids, marks = (batch.column(c).slice(row, end - row).take(pa.array(text)) for c in ("doc_id", "t"))
                numbers = [pa.array(x, pa.int64()) for x in (first, last, at - words[starts[text]], after - at)]
                ends = [pa.array(x, pa.int64(), mask=~whole) for x in (last[until], after[until] - at, windows.astype(np.int64))]
                found = [ids, marks, *numbers, pa.array(digests.astype(np.int64), mask=rare), *ends]
                used = pa.array(whole | ~rare)
                yield pa.RecordBatch.from_arrays([x.filter(used) for x in found], names=[c.split()[0] for c in columns.split(", ")])

    rows = documents.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("t"), F.col("text").cast("string"))
    return rows.mapInArrow(run, columns)


def _later(rows: DataFrame, name: str) -> DataFrame:
    """The rows whose digest has occurred before, with first: doc_id, t and start of its first occurrence."""
    often = rows.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").select("digest")
    repeats = materialise(rows.join(often, "digest", "left_semi"), name)
    firsts = repeats.groupBy("digest").agg(F.min(F.struct("doc_id", "t", "start")).alias("first"))
    same = (F.col("first.doc_id") == F.col("doc_id")) & (F.col("first.t") == F.col("t")) & (F.col("first.start") == F.col("start"))
    return repeats.join(firsts, "digest").filter(~same)


def _runs(chunks: DataFrame, p: Chunking) -> DataFrame:
    """Chunks that lie alike in one document and in one before it, as spans."""
    found = _later(chunks.filter("digest is not null").select("doc_id", "t", "start", "stop", "at", "words", "digest"), "repeats").select(
        "doc_id", "t", "start", "stop", "at", "words", F.col("first.doc_id").alias("first_doc_id"), F.col("first.t").alias("first_t"),
        (F.col("start") - F.col("first.start")).alias("apart"))
    # A window holds chunks of one document that lie alike in one other; a run ends where the next chunk is too far.
    line = ["doc_id", "t", "first_doc_id", "first_t", "apart"]
    found = found.groupBy(*line, "start", "stop").agg(F.max("at").alias("at"), F.max("words").alias("words"))
    own = W.partitionBy(*line).orderBy("start")
    found = found.withColumn("fresh", F.coalesce(F.col("start") - F.lag("stop").over(own) > p.gap, F.lit(True)).cast("int"))
    found = found.withColumn("run", F.sum("fresh").over(own.rowsBetween(W.unboundedPreceding, 0)))
    runs = found.groupBy(*line, "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.min("at").alias("at"),
                                           F.max(F.col("at") + F.col("words")).alias("until"), F.sum("words").alias("n"))
    return runs.filter(F.col("n") >= p.words).select("doc_id", "t", "start", "stop", "at", "until", "first_doc_id")


def repeated_passages(documents: DataFrame, p: Chunking = Chunking()) -> DataFrame:
    """One row per repeated passage: doc_id, t, start and stop (bytes), n_words (between them), first_doc_id (the first
    document that keeps a part of it).

    Null or empty texts and rows without doc_id have no chunks. Rows that repeat (one id, one text) count once. An empty table gives no rows.
    Other columns are ignored."""
    chunks = materialise(chunk_table(documents.filter("doc_id is not null"), p), "chunks")
    windows = chunks.filter("window is not null").select("doc_id", "t", "start", F.col("window_stop").alias("stop"), "at",
                                                         (F.col("at") + F.col("window_words")).alias("until"), F.col("window").alias("digest"))
    windows = _later(windows, "windows").select("doc_id", "t", "start", "stop", "at", "until", F.col("first.doc_id").alias("first_doc_id"))
    # A window of one document holds its repeated spans; those that meet are one passage.
    own = W.partitionBy("doc_id", "t").orderBy("start", "stop", "first_doc_id")
    spans = windows.unionByName(_runs(chunks, p)).withColumn("reach", F.max("stop").over(own.rowsBetween(W.unboundedPreceding, -1)))
    spans = spans.withColumn("passage", F.sum(F.coalesce(F.col("start") > F.col("reach"), F.lit(True)).cast("int")).over(
        own.rowsBetween(W.unboundedPreceding, 0)))
    found = spans.groupBy("doc_id", "t", "passage").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), (F.max("until") - F.min("at")).alias("n_words"),
        F.min("first_doc_id").alias("first_doc_id"))
    return found.drop("passage")


def without_passages(documents: DataFrame, passages: DataFrame) -> DataFrame:
    """The documents with the repeated passages cut out of text. Cuts that would split a character are moved to its ends."""
    spans = passages.groupBy("doc_id", "t").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))
    rows = documents.select(F.struct(*documents.columns).alias("row"), F.col("doc_id").cast("long"), F.xxhash64("text").alias("t"))
    rows = rows.join(spans, ["doc_id", "t"], "left")

    @F.pandas_udf("string")
    def cut(texts: pd.Series, places: pd.Series) -> pd.Series:
        return pd.Series([text if text is None or at is None else _cut(text, at) for text, at in zip(texts, places)], dtype=object)

    return rows.select(*[cut("row.text", "spans").alias("text") if c == "text" else F.col(f"row.`{c}`") for c in documents.columns])


def _cut(text: str, spans: list) -> str:
    data, kept, at = text.encode("utf-8", "surrogatepass"), [], 0
    for span in spans:
        start, stop = span["start"], span["stop"]
        while start > 0 and start < len(data) and data[start] & 0xC0 == 0x80:
            start += 1
        while stop < len(data) and data[stop] & 0xC0 == 0x80:
            stop -= 1
        kept.append(data[at:max(at, start)])
        at = max(at, stop)
    return b"".join([*kept, data[at:]]).decode("utf-8", "replace")

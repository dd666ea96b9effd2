"""Language identification, word first with backoff to character n-grams (operator 4).

A word that the model knows scores its smoothed log frequency in each language. A word it doesn't know backs off: to the mean of its known
4-grams of characters, if there are none of its 3-grams, and so on to single characters. A text's language is the one with the largest sum
over all its words, the score that language's share of the likelihood.

Words are runs of letters in lower case. Words and n-grams are 64-bit hashes of code points, handled for many texts at once with numpy; a
long text is taken in pieces, so memory doesn't grow with it. Only the labelled texts that train are sampled, `per_language` of each
language, chosen by a digest of doc_id; every text is predicted as a whole."""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sellthrough.llm.bytewords import mix

PIECE = 1 << 18
UNKNOWN = "und"
_U = np.uint64
_TABLES: dict[str, np.ndarray] = {}


@dataclass(frozen=True)
class LanguageModel:
    """per_language: training texts of each language at most, on average. entries: words and n-grams kept, the most frequent. seen: times a
    word or n-gram has to occur. longest: characters of the longest n-gram. smooth: added to each count."""
    per_language: int = 3000
    entries: int = 300_000
    seen: int = 2
    longest: int = 4
    smooth: float = 0.5


@dataclass
class Trained:
    """Languages, and for words (0) and n-grams (n) the sorted hashes with a row of log frequencies each."""
    languages: list[str]
    tables: dict[int, tuple[np.ndarray, np.ndarray]]


def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point whether it is a letter, and its lower case (itself, if that is longer than one)."""
    if not _TABLES:
        chars = [chr(c) for c in range(0x110000)]
        _TABLES["letter"] = np.array([c.isalpha() for c in chars])
        lower = np.arange(0x110000, dtype=np.uint32)
        for c in np.flatnonzero(_TABLES["letter"]):
            small = chars[c].lower()
            if len(small) == 1:
                lower[c] = ord(small)
        _TABLES["lower"] = lower
        steps = np.full(2 * PIECE + 2, 0x9E3779B97F4A7C15, np.uint64)
        steps[0] = 1
        _TABLES["up"] = np.multiply.accumulate(steps)
        steps[1:] = pow(0x9E3779B97F4A7C15, -1, 1 << 64)
        _TABLES["down"] = np.multiply.accumulate(steps)
    return _TABLES["letter"], _TABLES["lower"]


def _pieces(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(code points, text number of each) of runs of about a PIECE of characters. A longer text is cut at a space where it has one
    in the last quarter of a piece."""
    parts: list[str] = []
    rows: list[int] = []
    size = 0

    def done() -> tuple[np.ndarray, np.ndarray]:
        points = np.frombuffer("\n".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
        return points, np.repeat(np.array(rows), [len(x) + 1 for x in parts])[:len(points)]

    for row, text in enumerate(texts):
        at = 0
        while text is not None and at < len(text):
            end = at + PIECE
            if end < len(text):
                cut = text.rfind(" ", at + PIECE * 3 // 4, end)
                end = cut if cut > 0 else end
            part = text[at:end]
            if size + len(part) > PIECE and parts:
                yield done()
                parts, rows, size = [], [], 0
            parts.append(part)
            rows.append(row)
            size += len(part) + 1
            at = end
    if parts:
        yield done()


def _words(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Mixed lower-case code points, and start, length and hash of each word."""
    letter, lower = _letters()
    inside = letter[points]
    edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    mixed = mix(lower[points].astype(np.uint64) + _U(1))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed * _TABLES["up"][:len(points)], dtype=np.uint64)))
    return mixed, start, end - start, mix((sums[end] - sums[start]) * _TABLES["down"][start])


def _grams(mixed: np.ndarray, start: np.ndarray, length: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every n-gram of the words, and the number of its word."""
    count = np.maximum(length - n + 1, 0)
    word = np.repeat(np.arange(len(start)), count)
    at = np.repeat(start - (np.cumsum(count) - count), count) + np.arange(len(word))
    value = np.full(len(word), n, np.uint64)
    for j in range(n):
        value = value * _U(0xD6E8FEB86659FD93) + mixed[at + j]
    return mix(value), word


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _counts(rows: DataFrame, p: LanguageModel) -> DataFrame:
    """(lang, n, h, c): how often a word (n = 0) or n-gram occurs in texts of a language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            for points, row in _pieces(batch.column("text").to_pylist()):
                mixed, start, length, words = _words(points)
                lang = langs[row[start]]
                for name in set(lang):
                    own = lang == name
                    _, first, times = np.unique(words[own], return_index=True, return_counts=True)
                    found = [(0, words[own][first], times)]
                    for n in range(1, p.longest + 1):
                        grams, word = _grams(mixed, start[own][first], length[own][first], n)
                        kinds, back = np.unique(grams, return_inverse=True)
                        found.append((n, kinds, np.bincount(back, times[word], len(kinds))))
                    for n, h, c in found:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([name] * len(h), pa.string()), pa.array(np.full(len(h), n, np.int32)), pa.array(h.astype(np.int64)),
                             pa.array(np.asarray(c).astype(np.int64))], names=["lang", "n", "h", "c"])

    made = rows.select("lang", "text").mapInArrow(run, "lang string, n int, h long, c long")
    return made.groupBy("lang", "n", "h").agg(F.sum("c").alias("c"))


def train(documents: DataFrame, p: LanguageModel = LanguageModel()) -> Trained:
    """Learns from documents that have an id, a text and a language and are not held out. None of them: a model that knows nothing."""
    rows = documents.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("text").cast("string"))
    rows = rows.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row per language
    languages = sorted(sizes)
    if not languages:
        return Trained([], {})
    part = F.lit(0.0)
    for name in languages:
        part = F.when(F.col("lang") == name, F.lit(p.per_language / sizes[name])).otherwise(part)
    drawn = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < part * (1 << 30))
    wide = _counts(drawn, p).groupBy("n", "h").pivot("lang", languages).agg(F.sum("c"))
    for i, name in enumerate(languages):
        wide = wide.withColumnRenamed(name, f"c{i}")
    columns = [f"c{i}" for i in range(len(languages))]
    total = sum((F.coalesce(c, F.lit(0)) for c in columns), F.lit(0))
    wide = wide.withColumn("total", total).filter(F.col("total") >= p.seen).orderBy(F.desc("total"), "n", "h").limit(p.entries)
    got = wide.select("n", "h", *[F.coalesce(c, F.lit(0)).alias(c) for c in columns]).toArrow()
    n, h = got.column("n").to_numpy(), got.column("h").to_numpy().astype(np.uint64)
    counts = np.stack([got.column(c).to_numpy() for c in columns], 1).astype(float)
    tables = {}
    for kind in range(p.longest + 1):
        own = n == kind
        order = np.argsort(h[own])
        mine = counts[own][order]
        tables[kind] = (h[own][order], np.log((mine + p.smooth) / (mine.sum(0) + p.smooth * (len(mine) + 1))))
    return Trained(languages, tables)


def _look_up(table: tuple[np.ndarray, np.ndarray], hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which hashes the table holds, and where."""
    if not len(table[0]):
        return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64)
    at = np.minimum(np.searchsorted(table[0], hashes), len(table[0]) - 1)
    return table[0][at] == hashes, at


def _added(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(rows, values[:, i], n) for i in range(values.shape[1])], 1)


def _scores(texts: list[str | None], model: Trained, p: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """The log likelihood of each text in each language, and whether the text has a letter."""
    sums, letters = np.zeros((len(texts), len(model.languages))), np.zeros(len(texts), bool)
    for points, row in _pieces(texts):
        mixed, start, length, words = _words(points)
        letters[row[start]] = True
        if not model.languages:
            continue
        row = row[start]
        known, at = _look_up(model.tables[0], words)
        sums += _added(row[known], model.tables[0][1][at[known]], len(texts))
        row, start, length = row[~known], start[~known], length[~known]
        for n in range(p.longest, 0, -1):
            grams, word = _grams(mixed, start, length, n)
            known, at = _look_up(model.tables[n], grams)
            found = np.bincount(word[known], minlength=len(start))
            mean = _added(word[known], model.tables[n][1][at[known]], len(start)) / np.maximum(found, 1)[:, None]
            sums += _added(row, mean, len(texts))
            left = found == 0
            row, start, length = row[left], start[left], length[left]
    return sums, letters


def identify(documents: DataFrame, model: Trained, p: LanguageModel = LanguageModel()) -> DataFrame:
    """The documents with lang_pred and score (0 to 1) added; columns of these names are replaced.

    Null texts and texts without a letter are `und` with score 0, and so is every text if the model knows no language. Ties go to the
    language that sorts first. lang, source and doc_id are no inputs. Rows that repeat come back as often; an empty table gives no rows."""
    rest = [c for c in documents.columns if c not in ("lang_pred", "score")]
    clear = documents.select(*rest)
    schema = clear.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, share = [], []
            for at in range(0, batch.num_rows, 512):
                sums, letters = _scores(batch.column("text").slice(at, 512).to_pylist(), model, p)
                if not model.languages:
                    best += [UNKNOWN] * len(letters)
                    share += [0.0] * len(letters)
                    continue
                odds = np.exp(sums - sums.max(1)[:, None])
                top = sums.argmax(1)
                for i, has in enumerate(letters):
                    best.append(model.languages[top[i]] if has else UNKNOWN)
                    share.append(float(odds[i, top[i]] / odds[i].sum()) if has else 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best, pa.string()), pa.array(share, pa.float64())],
                                             names=[*batch.schema.names, "lang_pred", "score"])

    return clear.mapInArrow(run, schema)

"""Periodic runs of words, and texts with their repetitions taken out (operator 12).

A run is a longest possible stretch of words in which words `period` apart are equal, at least `times` periods and `least` words long.

Online sparse diagonal DP. Cell (i, d) of the DP says that word i equals the word d before it; the cells of one lag d in a row are a match of
growing length, and the match that ends long enough is a run. Words come in order; a cell extends its diagonal if the cell before it did,
otherwise the diagonal has ended and is emitted. The DP is sparse because only cells that can belong to a run are made: a run of period d
matches (times - 1) * d words in a row, so a word's earlier occurrences are looked up together with the words after it. Lags are taken in
classes from P to below 1.5 P, and a class compares 3 P words. Two occurrences of 3 P words within 1.5 P of each other would, by the
theorem of Fine and Wilf, have a common period that divides both lags, so the nearest occurrence is the only one that can be of a smallest
period, and every word makes one cell a class at most. That bounds a text of n words by n log n cells, also one of a single repeated word.

Word and phrase names are exact numbers, no hashes. A text is read whole by one task; memory is some 200 bytes a word of the longest text."""
from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class Runs:
    """least: words of a run. times: least length in periods; the lookup needs four or more."""
    least: int = 6
    times: int = 4

    def __post_init__(self) -> None:
        if self.times < 4:
            raise ValueError("runs of fewer than four periods need more than the nearest occurrence")


def _named(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """A number for each different pair of numbers."""
    return np.unique(high * (int(low.max(initial=0)) + 1) + low, return_inverse=True)[1]


def _cells(words: np.ndarray, p: Runs) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(phrase length, places, lags) of each class of lags: places whose phrase's nearest earlier occurrence is a lag of the class away."""
    n, short = len(words), 1
    names = words                                         # of phrases of `short` words, a power of two
    low = 1
    while p.times * low <= n:
        high = -(-3 * low // 2)                           # lags low..high - 1
        size = max(p.least - 1, 3 * low) if low == 1 else max(p.least - low, 3 * low)
        while 2 * short <= size:
            names = _named(names[:len(names) - short], names[short:])
            short *= 2
        phrases = names if short == size else _named(names[:n - size + 1], names[size - short:])
        order = np.argsort(phrases, kind="stable")
        same = phrases[order[1:]] == phrases[order[:-1]]
        if not same.any():                                # longer phrases don't repeat either
            return
        places, lags = order[1:][same], (order[1:] - order[:-1])[same]
        good = (lags >= low) & (lags < high)
        at = np.argsort(places[good])
        yield size, places[good][at], lags[good][at]
        low = high


def find_runs(words: np.ndarray, p: Runs = Runs()) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a text's words (numbers, equal for equal words), by start and period."""
    runs = []

    def ended(lag: int, first: int, last: int, size: int) -> None:
        length = last - first + size + lag
        if length >= max(p.least, p.times * lag):
            runs.append((first - lag, length, lag))

    for size, places, lags in _cells(words, p):
        active: dict[int, list[int]] = {}                 # lag -> first and last place of its diagonal
        for place, lag in zip(places.tolist(), lags.tolist()):
            diagonal = active.get(lag)
            if diagonal is None:
                active[lag] = [place, place]
            elif diagonal[1] == place - 1:
                diagonal[1] = place
            else:
                ended(lag, *diagonal, size)
                active[lag] = [place, place]
        for lag, diagonal in active.items():
            ended(lag, *diagonal, size)
    return sorted((start, length, lag) for start, length, lag in runs)


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words no run holds after its first period."""
    edges = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return np.cumsum(edges[:n]) == 0


def planted(doc_id: int | None, n: int) -> np.ndarray:
    """Places that the words of a document are taken from: one in ten gets a repetition, by its id's crc32; the others keep theirs."""
    places = np.arange(n)
    if doc_id is None or not n:
        return places
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return places
    g = h // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    places[a:] = a + np.arange(n - a) % period
    return places


def _sha256(text: bytes) -> str:
    return hashlib.sha256(text).hexdigest()


def _judged(words: list[bytes], p: Runs) -> dict:
    numbers: dict[bytes, int] = {}
    runs = find_runs(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words)), p)
    start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    kept = words if not runs else [words[k] for k in np.flatnonzero(kept_words(len(words), runs))]
    return {"n_runs": len(runs), "start": start, "length": length, "period": period,
            "exponent_milli": 1000 * length // period if runs else None,
            "runs_sha256": _sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()), "collapsed": b" ".join(kept)}


def periodic_runs(documents: DataFrame, p: Runs = Runs(), plant: bool = False, texts: bool = True) -> DataFrame:
    """One row per document: doc_id, n_runs; start, length, period and exponent_milli of its longest run (ties: smallest start, then period; null
    without one); runs_sha256, collapsed_sha256 and, with `texts`, collapsed: the words that no run repeats, joined by one space.

    plant: put repetitions into one document of ten first (see `planted`); rows without doc_id get none. Words are runs of characters other
    than space and 0x09-0x0D, as they are written. Null and empty texts have no words and no runs, and collapse to an empty text. Rows that
    repeat come back as often; other columns are ignored; an empty table gives no rows."""
    fields = [("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()), ("exponent_milli", pa.int64()),
              ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())] + [("collapsed", pa.string())] * texts
    schema = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                words = b"" if not text.is_valid else text.as_buffer().to_pybytes()
                words = words.split()                     # bytes split at space and 0x09-0x0D
                if plant:
                    words = [words[k] for k in planted(doc_id, len(words)).tolist()]
                found = _judged(words, p)
                found["collapsed_sha256"] = _sha256(found["collapsed"])
                found["collapsed"] = found["collapsed"].decode("utf-8") if texts else None
                out.append(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array([x[name] for x in out], kind) for name, kind in fields]], names=["doc_id", *[name for name, _ in fields]])

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema + ", collapsed string" * texts)

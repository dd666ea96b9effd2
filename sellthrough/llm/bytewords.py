"""Words and 64-bit word hashes of Arrow text columns, made for many texts at once with numpy.

A word is a run of bytes other than space and 0x09-0x0D, with A-Z lower-cased. UTF-8 never uses those bytes inside a longer
code point, so bytes can stand for characters. Memory is bounded by PIECE whatever the length of a text: a long text is hashed in
pieces which end between words."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
SLICE_ROWS = 512

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15
_LUT = np.random.Generator(np.random.PCG64(20)).integers(1, 1 << 63, 256, dtype=np.uint64)
_LUT[65:91] = _LUT[97:123]
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all output bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse modulo 2**64, at least n of each."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        n = max(n, PIECE + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text array and the start of each text in them, with the end of the last; null has no bytes."""
    texts = texts.fill_null("").cast(pa.large_string())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, starts) of runs of texts that hold about a PIECE of bytes together."""
    data, starts = text_bytes(texts)
    row = 0
    while row < len(starts) - 1:
        end = int(np.searchsorted(starts, starts[row] + PIECE, "right")) - 1
        end = min(max(end, row + 1), row + SLICE_ROWS)
        yield row, end, data[starts[row]:starts[end]], starts[row:end + 1] - starts[row]
        row = end


def _word_ends(data: np.ndarray, at: int) -> int:
    """End of a piece that starts at `at` and doesn't cut a word (a longer word makes the piece longer)."""
    end = min(at + PIECE, len(data))
    size = PIECE
    while end < len(data):
        gaps = np.flatnonzero(_SPACE[data[at:end]])
        if gaps.size:
            return at + int(gaps[-1]) + 1
        size *= 2
        end = min(at + size, len(data))
    return end


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word and the number of words before each text (one more entry than texts)."""
    hashes, firsts, at = [], [], 0
    while at < len(data):
        end = _word_ends(data, at)
        part = data[at:end]
        inside = ~_SPACE[part]
        fresh = np.zeros(len(part) + 1, bool)
        fresh[0] = True
        inner = starts[(starts > at) & (starts <= end)] - at
        fresh[inner] = True
        before, after = np.empty_like(inside), np.empty_like(inside)
        before[0], before[1:] = False, inside[:-1]
        after[-1], after[:-1] = False, inside[1:]
        first = np.flatnonzero(inside & (~before | fresh[:-1]))
        last = np.flatnonzero(inside & (~after | fresh[1:]))
        up, down = _powers(len(part))
        sums = np.cumsum(_LUT[part] * up[:len(part)], dtype=np.uint64)
        head = np.where(first > 0, sums[first - 1], _U(0))
        hashes.append(mix((sums[last] - head) * down[first] + (last - first).astype(np.uint64)))
        firsts.append(first + at)
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(starts), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(firsts), starts, "left")


def shingle_sets(data: np.ndarray, starts: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its word shingles; a text of fewer words is one shingle, of none has none."""
    words, at = word_hashes(data, starts)
    whole = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for j in range(width):
        whole = whole * _U(0xD6E8FEB86659FD93) + words[j:j + len(whole)]
    whole = mix(whole)
    for a, b in zip(at[:-1], at[1:]):
        if b - a >= width:
            yield np.unique(whole[a:b - width + 1])
        elif b > a:
            short = _U(b - a)
            for word in words[a:b]:
                short = _mix_one(short, word)
            yield np.array([short], np.uint64)
        else:
            yield np.zeros(0, np.uint64)


def _mix_one(state: np.uint64, word: np.uint64) -> np.uint64:
    return mix(np.array([(int(state) * 0xD6E8FEB86659FD93 + int(word)) & 0xFFFFFFFFFFFFFFFF], np.uint64))[0]

"""Token counts that follow edits (operator 5).

A text is cut into segments at places where the tokenizer's pre-token pattern always cuts: before a single space that stands between two
characters that are no space. The token count of a text is then the sum over its segments, each encoded by itself. A document's tree
is a segment tree over these: its leaves hold characters and tokens, each inner node the sum of its two children.

An edit (start, stop, replacement) finds its leaves by descending the character sums. The leaves that it touches are encoded again together
with their boundary context: the leaf before, if the edit reaches the two characters that make its cut, and the leaf after likewise. The
result takes the place of these leaves and only the sums above them are updated. Everything else is never looked at again."""
from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The pre-token pattern of the vocabulary, a fixed value of the public tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CUT = re.compile(r"(?<=\S) (?=\S)")
_ENCODERS: dict[str, Callable[[str], int]] = {}


@dataclass(frozen=True)
class Counting:
    """vocabulary: the tokenizer's file, at the same path on every executor. segment: characters of a segment at least."""
    vocabulary: str = VOCABULARY
    segment: int = 256


def counter(vocabulary: str) -> Callable[[str], int]:
    """Tokens of a text under a byte-level vocabulary of ranks; loaded once in a worker."""
    if vocabulary not in _ENCODERS:
        import tiktoken
        with open(vocabulary, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        _ENCODERS[vocabulary] = lambda text: len(encoding.encode_ordinary(text))
    return _ENCODERS[vocabulary]


def segments(text: str, size: int) -> Iterator[str]:
    """The text in pieces of about size characters, cut where the pattern always cuts; a text without such places is one piece."""
    at = 0
    while at < len(text):
        found = CUT.search(text, at + size)
        stop = found.start() if found else len(text)
        yield text[at:stop]
        at = stop


class Tree:
    """Segment tree: nodes 1 .. 2n-1 hold sums of characters and tokens, leaves from n on, n a power of two."""

    def __init__(self, chars: list[int], tokens: list[int]) -> None:
        self.n = 1
        while self.n < len(chars):
            self.n *= 2
        rest = [0] * (self.n - len(chars))
        self.chars, self.tokens = [0] * self.n + chars + rest, [0] * self.n + tokens + rest
        self.encoded = 0
        for node in range(self.n - 1, 0, -1):
            self._sum(node)

    def _sum(self, node: int) -> None:
        for sums in (self.chars, self.tokens):
            sums[node] = sums[2 * node] + sums[2 * node + 1]

    def total(self) -> int:
        return self.tokens[1]

    def leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character (the last one with characters for the end), and the leaf's first character."""
        place, node, start = min(place, max(self.chars[1] - 1, 0)), 1, 0
        while node < self.n:
            node *= 2
            if place >= start + self.chars[node]:
                start += self.chars[node]
                node += 1
        return node - self.n, start

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        node = leaf + self.n
        self.chars[node], self.tokens[node] = chars, tokens
        while node > 1:
            node //= 2
            self._sum(node)

    def edit(self, text: str, start: int, stop: int, replacement: str, count: Callable[[str], int]) -> str:
        """The text with text[start:stop] replaced; the tree follows."""
        # A cut is made by the characters on both its sides and the one after: an edit next to one takes in the leaf beyond.
        first, low = self.leaf_at(max(start - 2, 0))
        last, at = self.leaf_at(min(stop + 1, max(len(text) - 1, 0)))
        high = at + self.chars[last + self.n]
        region = text[low:start] + replacement + text[stop:high]
        self.put(first, len(region), count(region))
        self.encoded += len(region)
        for leaf in range(first + 1, last + 1):
            if self.chars[leaf + self.n]:
                self.put(leaf, 0, 0)
        return text[:start] + replacement + text[stop:]


def build(text: str, p: Counting) -> Tree:
    count = counter(p.vocabulary)
    parts = list(segments(text, p.segment))
    return Tree([len(x) for x in parts], [count(x) for x in parts])


def ordered(edits: list[tuple[int, int, str]] | None, size: int) -> list[tuple[int, int, str]]:
    """Edits from the end of the text to its start, so that each still finds its place; bounds are moved into the text, and an edit that
    overlaps one further back is left out."""
    kept: list[tuple[int, int, str]] = []
    for start, stop, replacement in sorted(((min(max(a or 0, 0), size), min(max(b or 0, 0), size), c or "") for a, b, c in edits or []), reverse=True):
        if start <= stop and (not kept or stop <= kept[-1][0]):
            kept.append((start, stop, replacement))
    return kept


def count_with_edits(documents: DataFrame, p: Counting = Counting()) -> DataFrame:
    """One row per document (doc_id, text, edits: array of start, stop, replacement on the given text): doc_id, n_tokens, leaf_chars and
    leaf_tokens (the tree's leaves, before), n_edits (made), edited_tokens and encoded_chars (that the edits had encoded again).

    Null texts have no tokens and take no edits; null edits are none. Edits are made from the last to the first; their bounds are cut to the
    text, and one that overlaps a later one is left out. Rows that repeat come back as often; an empty table gives no rows."""
    schema = "doc_id long, n_tokens long, leaf_chars array<int>, leaf_tokens array<int>, n_edits long, edited_tokens long, encoded_chars long"
    arrow = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("leaf_chars", pa.list_(pa.int32())), ("leaf_tokens", pa.list_(pa.int32())),
                       ("n_edits", pa.int64()), ("edited_tokens", pa.int64()), ("encoded_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(p.vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, out = batch.slice(at, 256), []
                for doc, text, edits in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "edits"))):
                    text = text or ""
                    tree = build(text, p)
                    leaves = [x for x in zip(tree.chars[tree.n:], tree.tokens[tree.n:]) if x[0]]
                    before, made = tree.total(), ordered([tuple(x.values()) for x in edits or []], len(text)) if text else []
                    for start, stop, replacement in made:
                        text = tree.edit(text, start, stop, replacement, count)
                    out.append((doc, before, [x for x, _ in leaves], [x for _, x in leaves], len(made), tree.total(), tree.encoded))
                yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*out), arrow)], schema=arrow)

    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"),
                            F.col("edits").cast("array<struct<start:int,stop:int,replacement:string>>").alias("edits"))
    return rows.mapInArrow(run, schema)


def recount(trees: DataFrame, documents: DataFrame, p: Counting = Counting()) -> DataFrame:
    """The same from stored trees (doc_id, leaf_chars, leaf_tokens) and documents (doc_id, text, edits), joined by doc_id: texts aren't encoded
    but where edits touch them. Documents without a tree are left out."""
    schema = "doc_id long, n_edits long, edited_tokens long, encoded_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(p.vocabulary)
        for batch in batches:
            out = []
            for doc, text, edits, chars, tokens in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "edits", "leaf_chars", "leaf_tokens"))):
                text, tree = text or "", Tree(chars, tokens)
                made = ordered([tuple(x.values()) for x in edits or []], len(text)) if text else []
                for start, stop, replacement in made:
                    text = tree.edit(text, start, stop, replacement, count)
                out.append((doc, len(made), tree.total(), tree.encoded))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (zip(*out) if out else ((), (), (), ()))],
                                             names=["doc_id", "n_edits", "edited_tokens", "encoded_chars"])

    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"),
                            F.col("edits").cast("array<struct<start:int,stop:int,replacement:string>>").alias("edits"))
    return rows.join(trees.select("doc_id", "leaf_chars", "leaf_tokens"), "doc_id").mapInArrow(run, schema)


def redactions(documents: DataFrame) -> DataFrame:
    """The documents with edits that mask their personal data: mail addresses, and runs of seven digits or more with their separators."""
    pattern = re.compile(r"[\w.+-]+@[\w-]+\.[\w.-]+|\+?\d[\d ().-]{5,}\d")

    @F.pandas_udf("array<struct<start:int,stop:int,replacement:string>>")
    def found(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: [(m.start(), m.end(), "[redacted]") for m in pattern.finditer(text)] if isinstance(text, str) else None)

    return documents.withColumn("edits", found(F.col("text").cast("string")))

"""Chat formatting of typed content parts (operator 7).

A turn is written as `<turn ROLE>`, a line break, its content, `</turn>` and a line break. A visitor flattens the content: text is escaped,
image, audio and document parts become numbered placeholders (`<image 1>`), and each is recorded with its reference, its place and the
tokens that it expands to. Every control string starts with `<`; in texts and roles `<` and the escape character itself are escaped, so
texts can say anything and are read back unchanged.

A conversation is formatted as a stream of turns in sorted partitions: a row per turn, with its offset in the conversation. No row and no
memory grows with a conversation, though one conversation's turns stay in one task, since offsets and digests run over them in order."""
from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

ESCAPE = "\\"
TO_ESCAPE = re.compile(r"[\\<]")
ESCAPED = re.compile(r"\\(.)", re.DOTALL)
TURN = re.compile(r"<turn ((?:[^\\>\n]|\\.)*)>\n(.*)</turn>\n", re.DOTALL)
PLACEHOLDER = re.compile(r"(?:\\.|[^\\<])+|<(\w+) (\d+)>", re.DOTALL)

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
ATTACHMENT = "struct<n:int,type:string,ref:string,at:bigint,tokens:bigint>"
FORMATTED = (f"conv_id long, seq long, turn long, role string, offset long, formatted string, loss array<struct<start:bigint,stop:bigint>>, "
             f"attachments array<{ATTACHMENT}>")
ARROW_FORMATTED = pa.schema([
    ("conv_id", pa.int64()), ("seq", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("offset", pa.int64()), ("formatted", pa.string()),
    ("loss", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
    ("attachments", pa.list_(pa.struct([("n", pa.int32()), ("type", pa.string()), ("ref", pa.string()), ("at", pa.int64()), ("tokens", pa.int64())])))])


def escape(text: str) -> str:
    return TO_ESCAPE.sub(lambda m: ESCAPE + m[0], text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


@dataclass(frozen=True)
class Template:
    """learned: roles whose text is trained on. patch: pixels of an image's side that make a token. rate: tokens of a second of audio.
    page: tokens of a document page."""
    learned: tuple[str, ...] = ("assistant",)
    patch: int = 28
    rate: float = 25.0
    page: int = 512


@dataclass
class Flattened:
    """What a turn's parts become; `attached` numbers go on through a conversation."""
    template: Template
    attached: int
    pieces: list[str] = field(default_factory=list)
    size: int = 0
    spans: list[tuple[int, int]] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)

    def visit(self, part: dict) -> None:
        getattr(self, f"_{part['type']}", self._other)(part)

    def _add(self, text: str) -> None:
        self.pieces.append(text)
        self.size += len(text)

    def _text(self, part: dict) -> None:
        start = self.size
        self._add(escape(part["text"] or ""))
        if self.size > start:
            self.spans.append((start, self.size))

    def _attach(self, part: dict, tokens: int) -> None:
        self.attached += 1
        kind = re.sub(r"\W", "_", part["type"] or "part")
        self.attachments.append({"n": self.attached, "type": part["type"], "ref": part["ref"], "at": self.size, "tokens": tokens})
        self._add(f"<{kind} {self.attached}>")

    def _image(self, part: dict) -> None:
        sides = (math.ceil((part[x] or 0) / self.template.patch) for x in ("width", "height"))
        self._attach(part, math.prod(sides))

    def _audio(self, part: dict) -> None:
        self._attach(part, math.ceil((part["seconds"] or 0) * self.template.rate))

    def _document(self, part: dict) -> None:
        self._attach(part, (part["pages"] or 0) * self.template.page)

    def _other(self, part: dict) -> None:
        self._attach(part, 0)


def text_content(text: Column) -> Column:
    """A text as the only part of a turn."""
    fields = [F.lit("text").alias("type"), F.coalesce(text.cast("string"), F.lit("")).alias("text")]
    empty = [F.lit(None).cast(t).alias(n) for n, t in (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))]
    return F.array(F.struct(*fields, *empty))


def _in_order(rows: DataFrame, *order: Column) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions(F.col("conv_id"), *order)


def format_chats(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """A row per turn, from (conv_id, turn, role, content): see FORMATTED. seq counts a conversation's turns; loss has the spans of text to
    learn, as offsets in the conversation; attachments have their offset likewise.

    Turns are ordered by turn (null first), ties by role and content; a null conv_id is a conversation, a null role an empty one, a null
    content no part, and a null text empty. Parts of unknown types are attachments of 0 tokens. An empty table gives no rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, seq, offset, attached = object(), 0, 0, 0
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["conv_id"] != now:
                    now, seq, offset, attached = row["conv_id"], 0, 0, 0
                role = row["role"] or ""
                flat = Flattened(template, attached)
                for part in row["content"] or []:
                    flat.visit(part)
                head = f"<turn {escape(role).replace('>', ESCAPE + '>').replace(chr(10), ESCAPE + chr(10))}>\n"
                text = f"{head}{''.join(flat.pieces)}</turn>\n"
                base = offset + len(head)
                out.append({
                    "conv_id": row["conv_id"], "seq": seq, "turn": row["turn"], "role": role, "offset": offset, "formatted": text,
                    "loss": [{"start": base + a, "stop": base + b} for a, b in flat.spans] if role in template.learned else [],
                    "attachments": [x | {"at": base + x["at"]} for x in flat.attachments]})
                seq, offset, attached = seq + 1, offset + len(text), flat.attached
            yield pa.RecordBatch.from_pylist(out, schema=ARROW_FORMATTED)

    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"),
                        F.col("content").cast(f"array<{PART}>").alias("content"))
    return _in_order(rows, F.col("turn"), F.col("role"), F.to_json("content")).mapInArrow(run, FORMATTED)


def read_turn(formatted: str) -> tuple[str, list[tuple[str, str | int]]]:
    """Role and parts of a formatted turn: ("text", text) or (type, number of the attachment)."""
    found = TURN.fullmatch(formatted)
    parts: list[tuple[str, str | int]] = []
    for piece in PLACEHOLDER.finditer(found[2]):
        parts.append((piece[1], int(piece[2])) if piece[1] else ("text", unescape(piece[0])))
    return unescape(found[1]), parts


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation, from the formatted text alone: conv_id, n_turns, turns_sha256 (role, line break, text, line break of each turn),
    loss_chars, loss_sha256 (the text under the loss mask), formatted_chars. Attachments have no text."""
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    arrow = pa.schema([(x.split()[0], pa.string() if x.endswith("string") else pa.int64()) for x in schema.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, open_, turns, loss, n, chars, size = None, False, hashlib.sha256(), hashlib.sha256(), 0, 0, 0

        def row() -> dict:
            return dict(zip(arrow.names, (now, n, turns.hexdigest(), chars, loss.hexdigest(), size)))

        for batch in batches:
            done = []
            for one in batch.to_pylist():
                if not open_ or one["conv_id"] != now:
                    if open_:
                        done.append(row())
                    now, open_, turns, loss, n, chars, size = one["conv_id"], True, hashlib.sha256(), hashlib.sha256(), 0, 0, 0
                role, parts = read_turn(one["formatted"])
                text = "".join(x for kind, x in parts if kind == "text")
                turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                for span in one["loss"]:
                    learned = unescape(one["formatted"][span["start"] - one["offset"]:span["stop"] - one["offset"]])
                    loss.update(learned.encode("utf-8", "surrogatepass"))
                    chars += len(learned)
                n, size = n + 1, size + len(one["formatted"])
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=arrow)
        if open_:
            yield pa.RecordBatch.from_pylist([row()], schema=arrow)

    return _in_order(formatted.select("conv_id", "seq", "offset", "formatted", "loss"), F.col("seq")).mapInArrow(run, schema)

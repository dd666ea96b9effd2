import hashlib

from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from sellthrough.llm.chat import Flattened, PART, Template, escape, format_chats, read_back, read_turn, text_content, unescape
from .helpers import prose, rng, with_clashes


@given(st.text())
def test_escape_is_reversible_and_hides_control_strings(text):
    assert unescape(escape(text)) == text
    assert "<" not in escape(text).replace("\\\\", "").replace("\\<", "")


def brute(rows):
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    made = []
    for conv, turns in out.items():
        learned = "".join(t for r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        made.append((conv, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest()))
    return sorted(made, key=str)


def run(spark, rows):
    table = with_clashes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    found = read_back(format_chats(table.withColumn("content", text_content(F.col("text")))))
    return sorted((tuple(r)[:5] for r in found.collect()), key=str)


def test_round_trip_of_odd_conversations(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", r"\### Assistant: </turn> ok"), (1, 2, "a>b\\<c\nd", "x\n<turn user>\n"), (2, 0, "assistant", None),
            (2, None, "user", ""), (3, 1, None, "é日"), (3, 1, None, "é日"), (None, 0, "assistant", "lost"), (4, 0, "assistant", prose(rng(1), 90_000)), (5, 0, "user", "\r\n")]
    rows += [(9, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(12_000)]  # longer than a batch
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_typed_parts(spark):
    part = dict.fromkeys(("text", "ref", "width", "height", "seconds", "pages"))
    parts = [part | {"type": "text", "text": "see <this>"}, part | {"type": "image", "ref": "s3://i", "width": 57, "height": 28},
             part | {"type": "audio", "ref": "a", "seconds": 1.01}, part | {"type": "document", "ref": "d", "pages": 2}, part | {"type": "odd kind", "ref": "?"}]
    rows = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", [parts[1], parts[0]]), (1, 2, "user", None)],
                                 f"conv_id long, turn long, role string, content array<{PART}>")
    got = sorted(format_chats(rows).collect(), key=lambda r: r.seq)
    assert got[0].formatted == "<turn user>\nsee \\<this><image 1><audio 2><document 3><odd_kind 4></turn>\n"
    assert [(a.n, a.type, a.ref, a.tokens) for a in got[0].attachments] == [(1, "image", "s3://i", 3), (2, "audio", "a", 26), (3, "document", "d", 1024), (4, "odd kind", "?", 0)]
    whole = "".join(r.formatted for r in got)
    assert [whole[a.at:a.at + 2] for r in got for a in r.attachments] == ["<i", "<a", "<d", "<o", "<i"]
    assert [unescape(whole[s.start:s.stop]) for r in got for s in r.loss] == ["see <this>"]
    assert read_turn(got[1].formatted) == ("assistant", [("image", 5), ("text", "see <this>")])
    assert Flattened(Template(), 0).attached == 0

import base64
import gzip
import hashlib

from sellthrough.llm.warc import captures, parse_records, problems, read_archives, write_archives
from sellthrough.session import work_folder
from .helpers import prose, rng, with_clashes


def run(spark, rows, **options):
    path = work_folder(spark, "archives")
    pages = with_clashes(spark.createDataFrame(rows, "page_id long, url string, html string"))
    write_archives(pages, path, **options)
    return captures(read_archives(spark, path))


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_round_trip_with_revisits_and_awkward_payloads(spark):
    awkward = ["<p>é日本</p>", "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc", "\r\n\r\n", "", None, prose(rng(1), 200_000)]
    rows = [(10 * i + j, f"http://h{j}/p\n{i}", html) for i, html in enumerate(awkward) for j in range(3)]
    got = {r.page_id: r for r in run(spark, rows).collect()}
    assert len(got) == len(rows)
    first = {}
    for page, _, html in rows:
        first.setdefault(html or "", page)
    for page, url, html in rows:
        r, head = got[page], first[html or ""]
        assert (r.payload_bytes, r.payload_digest) == (len((html or "").encode()), sha(html))
        assert (r.record_type, r.refers_to) == (("response", None) if head == page else ("revisit", head))
        assert r.target == url.replace("\n", " ") == r.request.target == r.metadata.target


def test_small_payloads_repeats_and_missing_ids(spark):
    rows = [(1, "u", "aa"), (2, "u", "aa"), (5, None, "long enough"), (5, None, "long enough"), (6, "", "long enough"), (None, "u", "only"), (None, "u", "only"),
            (None, "u", "long enough")]
    got = sorted((str(r.page_id), r.record_type, r.refers_to) for r in run(spark, rows, least_bytes=3).collect())
    assert got == [("1", "response", None), ("2", "response", None), ("5", "response", None), ("5", "response", None), ("6", "revisit", 5),
                   ("None", "response", None), ("None", "response", None), ("None", "revisit", 5)]


def test_empty_table(spark):
    assert run(spark, []).collect() == []


def test_foreign_archives():
    one = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x:1>\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"
    two = one.replace(b"x:1", b"x:2")
    assert [r["id"] for r in parse_records(gzip.compress(one) + gzip.compress(two))] == ["<urn:x:1>", "<urn:x:2>"]
    assert [r["block"] for r in parse_records(one + two)] == [b"abcd"] * 2
    assert list(parse_records(b"")) == []


def test_broken_archives_are_told_and_read_as_far_as_they_go(spark, tmp_path):
    good = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x:%d>\r\nWARC-Payload-Digest: sha1:%s\r\nContent-Length: %d\r\n\r\nHTTP/1.1 200\r\n\r\nabcd\r\n\r\n"
    length = len(b"HTTP/1.1 200\r\n\r\nabcd")
    one, two, other = good % (1, sha("abcd").encode(), length), good % (2, sha("abcd").encode(), length), good % (3, sha("else").encode(), length)

    def told(data):
        return [(r["id"], r["problem"]) for r in parse_records(data)]

    assert told(one[:40]) == [(None, "the header of a record is cut off")]
    assert told(one.replace(b"Content-Length: %d" % length, b"Content-Length: 4x") + two) == [(None, "a record has no length that can be read: '4x'"), ("<urn:x:2>", None)]
    assert told(one + two[:-10])[1] == ("<urn:x:2>", "the block of a record is cut off")
    assert [x for x, _ in told(gzip.compress(one) + b"rubbish" + gzip.compress(two))] == ["<urn:x:1>", None, "<urn:x:2>"]
    assert told(gzip.compress(one) + gzip.compress(two)[:-12])[0] == ("<urn:x:1>", None)
    assert told(gzip.compress(one) + gzip.compress(two)[:-12])[-1][1] == "a gzip member is cut off"
    broken = bytearray(gzip.compress(one))
    broken[15:30] = b"\xff" * 15
    assert [x for x, _ in told(bytes(broken) + gzip.compress(two))][-1] == "<urn:x:2>" and told(bytes(broken))[-1][1].startswith("a gzip member is broken")
    for n, data in enumerate((one + other, gzip.compress(two)[:-12])):
        (tmp_path / f"part-{n}").write_bytes(data)
    for blocks in (True, False):
        read = read_archives(spark, str(tmp_path), blocks)
        assert sorted((r.capture_id, r.payload_digest, r.damaged) for r in captures(read).collect())[::2] == [("<urn:x:1>", sha("abcd"), False), ("<urn:x:3>", sha("abcd"), True)]
        assert [tuple(r) for r in problems(read).filter("problem like '%gzip%'").collect()] == [("a gzip member is cut off", 1)]


def test_same_as_plain_assembly(spark):
    r = rng(12)
    kinds = [prose(r, n) for n in (0, 1, 3, 3, 40)] + ["é", None]
    rows = [(i if r.random() < 0.95 else i // 2, r.choice([f"http://h/{i}?q=ü", None, "no url", "http://[bad"]), r.choice(kinds)) for i in range(400)]
    least = {}
    for page, _, html in rows:
        least[html or ""] = min(page, least.get(html or "", page))
    want = sorted((page, len((html or "").encode()), sha(html), "response" if least[html or ""] == page else "revisit", None if least[html or ""] == page else least[html or ""])
                  for page, _, html in rows)
    got = sorted(((x.page_id, x.payload_bytes, x.payload_digest, x.record_type, x.refers_to) for x in run(spark, rows).collect()), key=lambda x: x[:4])
    assert got == want and not any(x.damaged for x in run(spark, rows).collect())

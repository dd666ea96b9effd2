"""WARC archives: written from pages, read back, and put together as captures (operator 2).

Writing. Every page becomes three records: request, response (or revisit) and metadata, which name the capture by WARC-Concurrent-To.
Of pages with equal payloads that with the smallest page_id is the response; the others are revisits with the profile of identical payload
digests. Spark's text writer lays the records down, with the two line breaks that end a WARC record as its line separator; so archives
come from the same commit protocol as any table, and a lost executor leaves no half archive.

Reading. Archives are read as binary files of bounded size (what is written here stays near `archive_mb`), plain or gzip, and cut by Content-Length,
since payloads may hold anything. What can't be read becomes a row with its problem, and reading goes on at the next member or record.
Transaction assembly joins request and metadata to the capture that they are concurrent to, finds the response that a revisit refers to by digest,
and emits one nested row per capture; a payload that isn't what its digest says is marked as damaged."""
from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from sellthrough.llm.joins import join_split
from sellthrough.session import materialise

VERSION = "WARC/1.1"
END = "\r\n\r\n"
GZIP = b"\x1f\x8b\x08"
DATE = "2026-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMES = ("id", "type", "target", "concurrent_to", "digest", "problem")
RECORD = ", ".join(f"{n} string" for n in NAMES) + ", headers map<string,string>, block binary"
ARROW_RECORD = pa.schema([(n, pa.string()) for n in NAMES] + [("headers", pa.map_(pa.string(), pa.string())), ("block", pa.binary())])
SUMMARY = ", ".join(f"{n} string" for n in NAMES) + ", payload_bytes long, payload_digest string, page_id long"
ARROW_SUMMARY = pa.schema([(n, pa.string()) for n in NAMES] + [("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("page_id", pa.int64())])


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, block: bytes, **fields: str) -> str:
    """A record without the line breaks that end it; empty fields are left out."""
    names = {"record_id": "WARC-Record-ID", "concurrent_to": "WARC-Concurrent-To", "target": "WARC-Target-URI", "digest": "WARC-Payload-Digest",
             "profile": "WARC-Profile", "refers_to": "WARC-Refers-To-Target-URI", "content": "Content-Type"}
    lines = [VERSION, f"WARC-Type: {kind}", f"WARC-Date: {DATE}", *(f"{names[k]}: {v}" for k, v in fields.items() if v), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines) + END + block.decode("utf-8")


def _header_text(value: str | None) -> str:
    """A value fit for one header line."""
    return (value or "").replace("\r", " ").replace("\n", " ").strip()


def _request(url: str) -> bytes:
    """A GET for the URL, on one line and in ASCII."""
    try:
        parts = urlsplit(url)
    except ValueError:
        parts = urlsplit("")
    path = quote((parts.path or "/") + (f"?{parts.query}" if parts.query else ""), safe="/?&=%+,;:@!$'()*~.-_")
    host = quote(parts.netloc, safe=".:[]-@%")
    return f"GET {path} HTTP/1.1\r\n{f'Host: {host}' if host else 'Host:'}\r\n\r\n".encode()


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, archive_mb: int = 32) -> None:
    """Archives of pages below path. Payloads of fewer than least_bytes are responses, all of them.

    Null ids sort last (a payload that only rows without id have is a response in each). Pages that repeat with the smallest id of
    their payload are responses, each in a capture of its own."""
    sha1 = F.sha1(F.encode(F.coalesce("html", F.lit("")), "utf-8"))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    facts = materialise(rows.select("page_id", "url", sha1.alias("sha1"), F.octet_length(F.coalesce("html", F.lit(""))).cast("long").alias("bytes")), "payloads")
    firsts = facts.groupBy("sha1").agg(F.min("page_id").alias("first_id"), F.min_by("url", F.struct("page_id", "url")).alias("first_url"), F.count("*").alias("n"))
    rows = join_split(rows.withColumn("sha1", sha1), materialise(firsts.filter("n > 1"), "firsts"), ["sha1"], "left")
    rows = rows.withColumn("revisit", (F.octet_length(F.coalesce("html", F.lit(""))) >= least_bytes) & F.col("first_id").isNotNull() & ~F.col("first_id").eqNullSafe(F.col("page_id")))
    head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page_id, url, html, digest, first_url, revisit in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "sha1", "first_url", "revisit"))):
                # Ids need not be the same in a repeated task: it writes its archive anew.
                capture, target, digest = f"<{uuid.uuid4().urn}>", _header_text(url), f"sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}"
                if revisit:
                    body = record("revisit", head.encode(), record_id=capture, target=target, digest=digest, profile=PROFILE,
                                  refers_to=_header_text(first_url), content="application/http; msgtype=response")
                else:
                    body = record("response", (head + (html or "")).encode("utf-8"), record_id=capture, target=target, digest=digest,
                                  content="application/http; msgtype=response")
                asked = record("request", _request(target), record_id=f"<{uuid.uuid4().urn}>", concurrent_to=capture, target=target,
                               content="application/http; msgtype=request")
                known = f"page-id: {'' if page_id is None else page_id}\r\n".encode()
                about = record("metadata", known, record_id=f"<{uuid.uuid4().urn}>", concurrent_to=capture, target=target, content="application/warc-fields")
                out += [asked, body, about]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])

    texts = rows.select("page_id", "url", "html", "sha1", "first_url", "revisit").mapInArrow(run, "value string")
    # A task's records go to one archive after another: each holds so many records of this table's mean size.
    mean = facts.agg(F.avg("bytes")).first()[0] or 0
    per_file = max(3, int(archive_mb * 1e6 / (mean / 3 + 500)))
    (texts.write.option("lineSep", END).option("maxRecordsPerFile", per_file).option("compression", "gzip")
     .option("zlib.compress.level", "BEST_SPEED").text(path))


def _members(data: bytes) -> Iterator[tuple[bytes, str | None]]:
    """The text of an archive, and what is wrong with it. After a broken gzip member comes what can be read from the next one on."""
    if data[:2] != GZIP[:2]:
        yield data, None
        return
    whole = []
    while data:
        member = zlib.decompressobj(31)
        try:
            whole.append(member.decompress(data))
            problem = None if member.eof else "a gzip member is cut off"
        except zlib.error as error:
            problem = f"a gzip member is broken: {error}"
        if problem:
            yield b"".join(whole), problem
            whole = []
        data = member.unused_data if member.eof else data[max(data.find(GZIP, 3), 0) or len(data):]
        if data and data[:2] != GZIP[:2]:
            yield b"".join(whole), "what follows a gzip member is none"
            whole, data = [], data[max(data.find(GZIP), 0) or len(data):]
    yield b"".join(whole), None


def _broken(problem: str) -> dict:
    return dict.fromkeys(NAMES) | {"problem": problem, "headers": [], "block": b""}


def parse_records(data: bytes) -> Iterator[dict]:
    """The records of an archive, in order. What can't be read makes a record that has nothing but a problem; what is no record between two is
    skipped."""
    for text, problem in _members(data):
        yield from _parse(text)
        if problem:
            yield _broken(problem)


def _parse(data: bytes) -> Iterator[dict]:
    at = data.find(b"WARC/")
    while at >= 0:
        stop = data.find(b"\r\n\r\n", at)
        if stop < 0:
            yield _broken("the header of a record is cut off")
            return
        lines = data[at:stop].decode("utf-8", "replace").split("\r\n")[1:]
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        length = headers.get("content-length", "")
        if not (length.isascii() and length.isdigit()):
            yield _broken(f"a record has no length that can be read: {length!r}")
            at = data.find(b"\r\n\r\nWARC/", stop)
            at = at + 4 if at >= 0 else -1
            continue
        size = int(length)
        block = data[stop + 4:stop + 4 + size]
        yield {"id": headers.get("warc-record-id"), "type": headers.get("warc-type"), "target": headers.get("warc-target-uri"),
               "concurrent_to": headers.get("warc-concurrent-to"), "digest": (headers.get("warc-payload-digest") or "").removeprefix("sha1:") or None,
               "problem": None if len(block) == size else "the block of a record is cut off", "headers": list(headers.items()), "block": block}
        at = data.find(b"WARC/", stop + 4 + size)


def _summary(one: dict) -> dict:
    """A record with the payload of an HTTP response measured and hashed, and the page-id of metadata; the block is given up."""
    out = {n: one[n] for n in NAMES} | {"payload_bytes": None, "payload_digest": None, "page_id": None}
    if one["type"] == "response":
        payload = one["block"].partition(b"\r\n\r\n")[2]
        out |= {"payload_bytes": len(payload), "payload_digest": payload_digest(payload)}
    elif one["type"] == "metadata":
        fields = dict(x.partition(": ")[::2] for x in one["block"].decode("utf-8", "replace").splitlines())
        page_id = fields.get("page-id", "").strip()
        out["page_id"] = int(page_id) if page_id.removeprefix("-").isdigit() and page_id.isascii() else None
    return out


def read_archives(spark: SparkSession, path: str, blocks: bool = True) -> DataFrame:
    """The records of the archives below path: see RECORD. Without blocks, what `captures` needs of them: see SUMMARY."""
    schema, made = (ARROW_RECORD, lambda x: x) if blocks else (ARROW_SUMMARY, _summary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("content"):
                held, size = [], 0
                for one in parse_records(data.as_py()):
                    held.append(made(one))
                    size += len(one["block"]) if blocks else 400
                    if size > 4_000_000:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, schema=schema)

    read = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return read.mapInArrow(run, RECORD if blocks else SUMMARY)


def _summaries(records: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pylist([_summary(one) for one in batch.to_pylist()], schema=ARROW_SUMMARY)

    return records.select(*NAMES, "block").mapInArrow(run, SUMMARY) if "block" in records.columns else records


def problems(records: DataFrame) -> DataFrame:
    """(problem, n): what was wrong with the archives, and how often."""
    return records.filter("problem is not null").groupBy("problem").agg(F.count("*").alias("n"))


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, target, record_type, payload_digest, payload_bytes, refers_to (page id of the response), page_id,
    request and metadata (structs of their ids and targets; null where an archive has none).

    payload_digest is that of the payload as it was read; damaged says that the record names another one or that its block is cut off.
    A revisit takes bytes from the response of its digest with the smallest page id; one without response has null. Several requests or
    metadata records of one capture: the smallest id counts. Records that are concurrent to nothing known are left out, and such as could
    not be read (see `problems`)."""
    rows = _summaries(records)
    heads = rows.filter(F.col("type").isin("response", "revisit"))
    with_it = rows.filter(F.col("type").isin("request", "metadata") & F.col("concurrent_to").isNotNull())
    # Both kinds hang on a capture by its id: one shuffle gathers them, a few rows to a capture.
    about = with_it.groupBy(F.col("concurrent_to").alias("capture_id")).agg(
        F.min(F.when(F.col("type") == "request", F.struct("id", "target"))).alias("request"),
        F.min(F.when(F.col("type") == "metadata", F.struct("id", "target", "page_id"))).alias("metadata"))
    joined = heads.select(F.col("id").alias("capture_id"), "target", F.col("type").alias("record_type"), F.coalesce("payload_digest", "digest").alias("payload_digest"),
                          "payload_bytes", (F.col("problem").isNotNull() | F.coalesce(F.col("digest") != F.col("payload_digest"), F.lit(False))).alias("damaged")).join(about, "capture_id", "left").withColumn("page_id", F.col("metadata.page_id"))
    originals = joined.filter("record_type = 'response'").groupBy("payload_digest").agg(
        F.min("page_id").alias("first_id"), F.max("payload_bytes").alias("first_bytes"))
    joined = joined.join(originals, "payload_digest", "left")
    again = F.col("record_type") == "revisit"
    return joined.select("capture_id", "target", "record_type", "payload_digest", F.when(again, F.col("first_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
                         F.when(again, F.col("first_id")).alias("refers_to"), "page_id", "damaged", "request", "metadata")

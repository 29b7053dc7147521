"""WARC archives: writing captures, reading records, and assembling transactions.

A capture is written as a request, a response (or revisit) and a metadata record, each a
gzip member, the first and last naming the second in WARC-Concurrent-To. Archives are
written by Spark's text writer, whose committer and file systems serve any cluster: a
row is a segment of up to ``SEGMENT`` bytes, a file has up to ``SEGMENTS`` of them, and the line
separator is an empty gzip member. Reading streams the members of a file. Assembly
groups the records of a capture by the identifier that they are concurrent to.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEGMENT, SEGMENTS = 8 << 20, 8  # bytes of a segment, and segments of a file
#: A gzip member without content.
EMPTY = bytes([0x1F, 0x8B, 8, 0, 0, 0, 0, 0, 0, 3, 3, 0, 0, 0, 0, 0, 0, 0, 0, 0])
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the name space of URLs
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = (
    "record_id string, record_type string, concurrent_to string, refers_to string, target_uri string, warc_date string, "
    "payload_bytes bigint, payload_digest string, digest_ok boolean, fields map<string,string>, payload binary"
)


def record_id(kind: str, page_id: object, url: str, digest: str, copy: str = "") -> str:
    """``copy`` tells rows apart that agree in all the rest."""
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'{kind} {page_id} {url} {digest}{copy}')}>"


def _uri(url: str | None, page_id: object) -> str:
    return quote(url, safe="%/:=&?~#+!$,;'@()*[]") if url else f"urn:page:{page_id}"


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + f"Content-Length: {len(block)}\r\n\r\n"
    z = zlib.compressobj(3, zlib.DEFLATED, 31)
    return z.compress(head.encode() + block + b"\r\n\r\n") + z.flush()


def members(page_id: object, url: str | None, html: bytes, digest: str, first: tuple[object, str | None] | None, date: str, copy: str = "") -> list[bytes]:
    """The three members of a capture; ``first`` (page_id and url) makes it a revisit of that response.

    Rows that agree in everything have a ``copy`` each, and name in their metadata the identifier by which revisits know them.
    """
    uri = _uri(url, page_id)
    me = record_id("response", page_id, uri, digest, copy)
    common = [("WARC-Date", date), ("WARC-Target-URI", uri)]
    at = urlsplit(uri)
    request = f"GET {at.path or '/'}{'?' + at.query if at.query else ''} HTTP/1.1\r\nHost: {at.netloc}\r\n\r\n".encode()
    answer = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html)}\r\n\r\n".encode()
    own = [("WARC-Type", "revisit" if first else "response"), ("WARC-Record-ID", me), *common, ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if first:
        first_uri = _uri(first[1], first[0])
        own += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id("response", first[0], first_uri, digest)), ("WARC-Refers-To-Target-URI", first_uri)]
    kept = f"page_id: {'' if page_id is None else page_id}\r\n".encode()
    if copy:
        kept += f"copy-of: {record_id('response', page_id, uri, digest)}\r\n".encode()
    return [
        _member([("WARC-Type", "request"), ("WARC-Record-ID", record_id("request", page_id, uri, digest, copy)), ("WARC-Concurrent-To", me), *common, ("Content-Type", "application/http; msgtype=request")], request),
        _member(own, answer if first else answer + html),
        _member([("WARC-Type", "metadata"), ("WARC-Record-ID", record_id("metadata", page_id, uri, digest, copy)), ("WARC-Concurrent-To", me), *common, ("Content-Type", "application/warc-fields")], kept),
    ]


def write_archives(pages: DataFrame, path: str, least: int = 100, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write a capture for every row of ``pages`` (page_id, url, html) to gzip archives under ``path``.

    Of captures with equal payloads of ``least`` bytes or more, that with the smallest
    page_id is the response and the others revisit it; rows that tie for it are all responses, as are
    rows without a page_id, which nothing refers to. Rows that agree in everything make a capture each. A null html is an
    empty payload, a null url a urn of the page; other columns are ignored; no rows make no
    captures. Only payloads that occur again and rows that repeat are looked up, so the
    lookup is as small as they are few, and Spark broadcasts it only when its measured size allows.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", html.cast("binary").alias("payload"), F.sha2(html.cast("binary"), 256).alias("digest"))
    rows = rows.withColumn("row_key", F.sha2(F.concat_ws(" ", "digest", F.to_json(F.struct("page_id", "url"))), 256))
    captures = rows.groupBy("row_key", "digest", "page_id", "url").agg(F.count("*").alias("copies"), F.max(F.octet_length("payload")).alias("size"))
    named = F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))
    groups = captures.where(F.col("size") >= least).groupBy("digest").agg(F.sum("copies").alias("n"), F.min(named).alias("first")).where("n > 1")
    revisited = F.when(F.col("first.page_id") != F.col("page_id"), F.col("first")).alias("first")
    known = captures.join(groups.select(F.col("digest").alias("again"), "first"), F.col("digest") == F.col("again"), "left")
    known = known.select(F.col("row_key").alias("key"), (F.col("copies") > 1).alias("repeated"), revisited).where("repeated or first is not null")
    rows = rows.join(known, rows.row_key == known.key, "left").select("page_id", "url", "payload", "digest", "first", "repeated")

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, task, copies = [], 0, TaskContext.get().partitionId(), 0
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                for r in batch.slice(k, 256).to_pylist():
                    first = (r["first"]["page_id"], r["first"]["url"]) if r["first"] else None
                    copies += bool(r["repeated"])
                    for m in members(r["page_id"], r["url"], r["payload"], r["digest"], first, date, f" {task} {copies}" if r["repeated"] else ""):
                        held.append(m)
                        size += len(m)
                    if size >= SEGMENT:
                        yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["value"])
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["value"])

    body = rows.mapInArrow(segments, "value binary").select(F.col("value").cast("string").alias("value"))
    body.write.option("lineSep", EMPTY.decode("latin-1")).option("encoding", "ISO-8859-1").option("maxRecordsPerFile", SEGMENTS).text(path)


def _members(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(lower-case headers, block) of the records of an archive, a window of it at a time."""
    at, step = 0, 1 << 20
    view = memoryview(data)
    held = b""
    while at < len(view):
        z = zlib.decompressobj(31)
        parts, place = [], at
        while not z.eof and place < len(view):
            piece = view[place : place + step]
            parts.append(z.decompress(piece))
            place += len(piece)
        at = place - len(z.unused_data)
        held = b"".join([held, *parts, z.flush()])
        while (end := held.find(b"\r\n\r\n")) >= 0:
            lines = held[:end].decode("utf-8", "replace").split("\r\n")
            if not lines[0].startswith("WARC/"):
                raise ValueError(f"no WARC record: {lines[0][:40]!r}")
            headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
            stop = end + 4 + int(headers.get("content-length", 0))
            if len(held) < stop + 4:
                break
            yield headers, held[end + 4 : stop]
            held = held[stop + 4 :]
    if held.strip():
        raise ValueError("the archive ends within a record")


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the gzip archives under ``path``: RECORD, with null payloads if not asked for.

    payload_bytes and payload_digest are those of the whole payload: taken from the
    bytes of a response, and from the headers of a revisit, which has none. digest_ok
    tells whether the bytes agree with the header. Records that are there twice are two rows; a path without
    archives gives no rows or Spark's error for a missing path, and a broken or cut archive raises.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("record_id", pa.string()), ("record_type", pa.string()), ("concurrent_to", pa.string()), ("refers_to", pa.string()), ("target_uri", pa.string()), ("warc_date", pa.string()),
            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("digest_ok", pa.bool_()), ("fields", pa.map_(pa.string(), pa.string())), ("payload", pa.binary()),
        ])
        for batch in batches:
            for content in batch.column("content"):
                out, size = [], 0
                for h, block in _members(content.as_py()):
                    kind, body, fields, n, digest, ok = h.get("warc-type"), None, [], None, None, None
                    if kind in ("response", "revisit") and h.get("content-type", "").startswith("application/http"):
                        head, _, body = block.partition(b"\r\n\r\n")
                        said = h.get("warc-payload-digest", "").removeprefix("sha256:")
                        if kind == "revisit":
                            n, digest, body = next((int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")), None), said, None
                        else:
                            n, digest = len(body), hashlib.sha256(body).hexdigest()
                            ok = digest == said
                    elif kind == "metadata":
                        fields = [tuple(x.strip() for x in line.split(":", 1)) for line in block.decode("utf-8", "replace").splitlines() if ":" in line]
                    else:
                        body = block
                    body = body if with_payload else None
                    out.append((h.get("warc-record-id"), kind, h.get("warc-concurrent-to"), h.get("warc-refers-to"), h.get("warc-target-uri"), h.get("warc-date"), n, digest, ok, fields, body))
                    size += len(body or b"")
                    if len(out) >= 2000 or size >= SEGMENT:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("content").mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, response, request and metadata (null where there is none).

    A response or revisit stands under its own identifier, the others under the one they
    are concurrent to. Of several requests or metadata records of a capture, and of
    repeated records, the one with the least identifier stays; records that are
    concurrent to nothing or to a record that is not there make no capture.
    """
    own = F.col("record_type").isin("response", "revisit")
    part = F.struct("record_id", "record_type", "target_uri", "warc_date", "payload_bytes", "payload_digest", "digest_ok", "refers_to", F.map_entries("fields").alias("fields"), "payload")
    of = lambda c: F.min_by(F.when(c, part), F.when(c, F.col("record_id")))
    return (
        records.withColumn("capture_id", F.when(own, F.col("record_id")).otherwise(F.col("concurrent_to"))).where("capture_id is not null")
        .groupBy("capture_id")
        .agg(of(own).alias("response"), of(F.col("record_type") == "request").alias("request"), of(F.col("record_type") == "metadata").alias("metadata"))
        .where("response is not null")
    )

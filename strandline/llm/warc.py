"""WARC archives, index first.

Writing gives an index (file, offset, length, url, digest, ...) of the records written, one gzip member a
record; reading takes rows of such an index, sorts them by file and offset, and joins neighbouring byte
ranges into few reads.  Payloads that occur again are written as revisit records.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import hot_keys, materialize, salted_join, shared_dir, shuffle_parts

MIN_BYTES = 0
DATE = "1970-01-01T00:00:00Z"
FILE_BYTES = 1 << 30
READ_BYTES = 8 << 20
GAP_BYTES = 64 << 10
SEGMENT_BYTES = 64 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "file string, offset long, length long, url string, digest string, page_id long, record_type string"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"
_INDEX = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("url", pa.string()), ("digest", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string())])
_RECORD = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])


def _fs(uri: str):
    """File system and path of a uri; archives go wherever pyarrow can write (local, HDFS, object stores)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'page:{page_id}'.encode()).digest())}>"


def _field(value: str) -> str:
    """A header value: a control character would break the line, so it is escaped as in urls; all else stays as it is."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def encode_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str = DATE) -> bytes:
    """One record, uncompressed: a response with its payload, or a revisit (refers_to given) without."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_record_id(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_field(url)}")
        if _field(url) != url:
            lines.append(f"X-Page-URL: {quote(url, safe='')}")
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to)}", f"X-Refers-To-Page-ID: {refers_to}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def decode_record(raw: bytes) -> tuple:
    """(page_id, url, record_type, refers_to, payload_digest, payload_bytes, payload) of one uncompressed record.

    A response's payload is held against its digest; a revisit has payload null.  The url is the target line's; one with
    control characters, which that line shows as %XX, has another line to come back from as it was.
    """
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    h = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(h["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a WARC record does not end where it says")
    http, _, payload = block.partition(b"\r\n\r\n")
    n = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
    response = h["WARC-Type"] == "response"
    if response and (len(payload) != n or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"payload of page {h.get('X-Page-ID')} does not match its digest")
    number = lambda k: int(h[k]) if k in h else None
    url = unquote(h["X-Page-URL"]) if "X-Page-URL" in h else h.get("WARC-Target-URI")
    return number("X-Page-ID"), url, h["WARC-Type"], number("X-Refers-To-Page-ID"), digest, n, payload if response else None


def with_revisits(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(page_id, url, payload, refers_to): refers_to is the largest page_id with an equal payload, null where
    that is the row's own (then the row is a response), where the payload is below min_bytes, or where no
    row with the payload has an id.  Repeated rows of that page_id are responses each.
    """
    p = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "utf-8").alias("payload")).withColumn("sha", F.unhex(F.sha1("payload")))
    last = materialize(p.groupBy("sha").agg(F.max(F.when(F.length("payload") >= min_bytes, F.col("page_id"))).alias("last"), F.count("*").alias("n")), "warc-last")
    # the payloads move once, to where their digest's largest page_id is; rows of a common payload go to several places
    j = salted_join(p, last.drop("n"), ["sha"], "page_id", hot_keys(last, ["sha"]), "left")
    again = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last")) & (F.length("payload") >= min_bytes)
    return j.select("page_id", "url", "payload", F.when(again, F.col("last")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str | None = None, min_bytes: int = MIN_BYTES, level: int = 1, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record for each row of pages (page_id, url, html) and return the index of all records.

    Each task attempt writes files of its own name; the index rows that Spark commits name only the files of
    the attempts that counted, so a lost executor or a second attempt leaves at most files nobody refers to.
    Null html: empty payload; null url: no target line; null page_id: no id line; an empty table: no
    files and an empty index.  Other columns are ignored.
    """
    spark = pages.sparkSession
    folder = folder or f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"

    def write(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, at, out, part = "", 0, None, 0
        fs, top = _fs(folder)
        stem = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}"
        try:
            for rb in it:
                for a in range(0, rb.num_rows, 256):
                    rows = []
                    for page_id, url, payload, refers_to in zip(*(c.to_pylist() for c in rb.slice(a, 256).columns), strict=True):
                        if out is None or at >= file_bytes:
                            if out is not None:
                                out.close()
                            else:
                                fs.create_dir(top, recursive=True)
                            name = f"{stem}-{part:04d}.warc.gz"
                            where, at, part = f"{folder}/{name}", 0, part + 1
                            out = fs.open_output_stream(f"{top}/{name}", compression=None)
                        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                        z = zlib.compressobj(level, zlib.DEFLATED, 31)
                        member = z.compress(encode_record(page_id, url, payload, digest, refers_to)) + z.flush()
                        out.write(member)
                        rows.append((where, at, len(member), url, digest, page_id, "response" if refers_to is None else "revisit"))
                        at += len(member)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _INDEX.types, strict=True)], schema=_INDEX)
        finally:
            if out is not None:
                out.close()

    return materialize(with_revisits(pages, min_bytes).mapInArrow(write, INDEX), "warc-index")


def coalesced(ranges: list[tuple[int, int]], gap: int = GAP_BYTES, most: int = READ_BYTES) -> Iterator[tuple[int, int, list[int]]]:
    """(start, end, numbers of the ranges inside) of joint reads over (offset, length) sorted by offset.

    Ranges at most `gap` apart share a read of at most `most` bytes; a longer range is read alone.
    """
    start, end, held = 0, 0, []
    for i, (off, n) in enumerate(ranges):
        if held and (off - end > gap or off + n - start > most):
            yield start, end, held
            held = []
        if not held:
            start = end = off
        held.append(i)
        end = max(end, off + n)
    if held:
        yield start, end, held


def read_records(index: DataFrame, payload: bool = True) -> DataFrame:
    """The records of an index's rows (any selection of them), see decode_record(); payload=False leaves it null."""
    n = shuffle_parts(index.sparkSession)
    asked = index.select("file", "offset", "length").where("file is not null and offset is not null and length is not null")
    dealt = asked.repartition(n, "file", F.floor(F.col("offset") / SEGMENT_BYTES)).sortWithinPartitions("file", "offset")

    def read(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            names = rb.column("file")
            a = 0
            files = names.to_pylist()
            offs, lens = rb.column("offset").to_pylist(), rb.column("length").to_pylist()
            while a < len(files):
                b = a
                while b < len(files) and files[b] == files[a]:
                    b += 1
                fs, path = _fs(files[a])
                with fs.open_input_file(path) as f:
                    for start, end, held in coalesced(list(zip(offs[a:b], lens[a:b], strict=True))):
                        data = f.read_at(end - start, start)
                        rows = []
                        for i in held:
                            at = offs[a + i] - start
                            r = decode_record(zlib.decompress(data[at : at + lens[a + i]], 31))
                            rows.append(r if payload else (*r[:-1], None))
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _RECORD.types, strict=True)], schema=_RECORD)
                a = b

    return dealt.mapInArrow(read, RECORD)

"""ARC archives converted to WARC.

ARC files of version 1 and 2 are parsed by the record definition that their version block names:
header lines are split on spaces, and the declared length says where a record ends. Each record
becomes a WARC record with a name-based UUID, an ISO timestamp, a type and SHA-1 digests. Of the
records with equal payloads of LEAST bytes or more, the one with the largest key is a response and
the others are revisits that point to it; a revisit keeps its HTTP headers and no payload.

Each record is a gzip member of its own, so that a reader who knows its offset can fetch it alone.
Archives are written by Spark's text writer and read by its binaryFile reader, so they can lie in
any store that Spark knows. A row of the writer is a file: tasks pack members until `size` bytes or
`records` records are reached, and a larger record has a file to itself; what the writer puts after
a row is an empty member. Files are parsed as streams, a record at a time; only digests and keys
are shuffled, and the files themselves once, compressed.

Defined results: a null payload is empty; a null url is `urn:missing`, and white space in a url is
percent-encoded by its UTF-8 bytes; keys are numbers or strings, null or repeated: of equal payloads,
all rows with the largest key (as a number, then as a string) are responses, and a null key is smaller
than any other; an empty table gives an empty archive.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from datetime import datetime, timezone
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lectern.llm._common import kept, new_path

LEAST, RECORDS, SIZE, KEY = 1000, 10_000, 64 << 20, "X-Page-Id"
LEVEL = 4  # of compression: two thirds of the time of level 6, and 1.4 % more bytes

# The record definitions of the two versions.
FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"),
}
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _plain(url: str | None) -> str:
    return re.sub(r"\s", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url) if url else "urn:missing"


def member(data: bytes) -> bytes:
    """data as a gzip member."""
    z = zlib.compressobj(LEVEL, wbits=31)
    return z.compress(data) + z.flush()


def packed(members: Iterable[bytes], size: int, records: int) -> Iterator[bytes]:
    """Members put together to files: of `size` bytes and `records` members at most, or of a single larger member."""
    some: list[bytes] = []
    total = 0
    for m in members:
        if some and (total + len(m) > size or len(some) == records):
            yield b"".join(some)
            some, total = [], 0
        some.append(m)
        total += len(m)
    if some:
        yield b"".join(some)


def version_block(version: int, name: str, date: str) -> str:
    body = f"{version} 0 lectern\n{' '.join(FIELDS[version])}\n"
    head = {1: f"{date} text/plain", 2: f"{date} text/plain 200 - - 0 {name}"}[version]
    return f"filedesc://{name} 0.0.0.0 {head} {len(body)}\n{body}"


def arc_record(version: int, name: str, url: str | None, date: str, block: str) -> str:
    size = len(block.encode())
    middle = {1: "text/html", 2: f"text/html 200 {zlib.adler32(block.encode()):08x} - 0 {name}"}[version]
    return f"{_plain(url)} 0.0.0.0 {date} {middle} {size}\n{block}"


def _opened(content: bytes) -> io.BufferedIOBase:
    return gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)


def parse_arc(content: bytes) -> Iterator[dict]:
    """Records of one ARC file, in order: the fields that its version has, and the block."""
    f, n = _opened(content), 0
    fields = None
    while line := f.readline():
        if line == b"\n":
            continue
        values = line.decode().rstrip("\n").split(" ")
        if fields is None:
            if not values[0].startswith("filedesc://"):
                raise ValueError("an ARC file starts with its version block")
            body = f.read(int(values[-1])).decode().split("\n")
            version = int(body[0].split(" ")[0])
            fields = tuple(body[1].split(" "))
            if fields != FIELDS.get(version):
                raise ValueError(f"unknown record definition of version {version}: {body[1]}")
            continue
        if len(values) != len(fields):
            raise ValueError(f"a header line has {len(values)} fields, not {len(fields)}: {line[:200]!r}")
        record = dict(zip(fields, values, strict=True))
        size = int(record["Archive-length"])
        record["block"] = f.read(size)
        if len(record["block"]) != size:
            raise ValueError("an ARC file ends within a record")
        yield record | {"ordinal": n}
        n += 1


def split_http(block: bytes) -> tuple[bytes, dict[str, str], bytes]:
    """HTTP head as it is, its fields, and the payload."""
    head, _, payload = block.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:] if ": " in x)
    return head + b"\r\n\r\n", fields, payload


def iso_date(date: str) -> str:
    return datetime.strptime(date[:14].ljust(14, "0"), "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")


def record_id(url: str, date: str, key: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url} {date} {key} {digest}')}>"


def labelled(sha1: bytes) -> str:
    return "sha1:" + base64.b32encode(sha1).decode()


def warc_record(arc: dict, first: dict | None) -> bytes:
    """One WARC record; first: the response that a revisit points to."""
    head, http, payload = split_http(arc["block"])
    sha1, date, key = hashlib.sha1(payload), iso_date(arc["Archive-date"]), http.get(KEY)
    block = head if first else arc["block"]
    fields = {
        "WARC-Type": "revisit" if first else "response",
        "WARC-Record-ID": record_id(arc["URL"], date, key, sha1.hexdigest()),
        "WARC-Date": date,
        "WARC-Target-URI": arc["URL"],
        "WARC-IP-Address": arc["IP-address"],
        "WARC-Payload-Digest": labelled(sha1.digest()),
        "WARC-Block-Digest": labelled(hashlib.sha1(block).digest()),
    }
    if first:
        fields |= {
            "WARC-Profile": REVISIT,
            "WARC-Refers-To": record_id(first["url"], first["date"], str(first["key"]), sha1.hexdigest()),
            "WARC-Refers-To-Target-URI": first["url"],
            "WARC-Refers-To-Date": first["date"],
            "WARC-Refers-To-Key": str(first["key"]),
        }
    fields |= {"Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))}
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n").encode() + block + b"\r\n\r\n"


def parse_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of one WARC file."""
    f = _opened(content)
    while line := f.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record starts with {line[:40]!r}")
        headers = {}
        while (line := f.readline().decode().rstrip("\r\n")):
            k, _, v = line.partition(": ")
            headers[k] = v
        block = f.read(int(headers["Content-Length"]))
        if f.read(4) != b"\r\n\r\n":
            raise ValueError("a WARC record does not end where its length says")
        yield headers, block


def _write(files: DataFrame, path: str) -> None:
    """Each value as a file. The text writer copies its bytes as they are, and ends it by an empty member."""
    lines = files.select(F.col("value").cast("string"))
    lines.write.option("encoding", "ISO-8859-1").option("lineSep", member(b"").decode("latin-1")).option("maxRecordsPerFile", 1).text(path)


def _batch(value: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([value], pa.binary())], ["value"])


def _files(spark: SparkSession, path: str) -> DataFrame:
    schema = StructType.fromDDL("path string, modificationTime timestamp, length long, content binary")
    return spark.read.format("binaryFile").schema(schema).load(path).select("path", "content")


def write_arc(pages: DataFrame, path: str, records: int = RECORDS, size: int = SIZE) -> None:
    """pages(page_id, url, html) as ARC files, of version 1 and 2 in turn by task, each with its version block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        version = 1 + task % 2

        def members() -> Iterator[bytes]:
            for b in batches:
                for key, url, html in zip(*(b.column(i) for i in range(3)), strict=True):
                    key, url, body = key.as_py(), url.as_py(), html.as_py() or ""
                    date = datetime.fromtimestamp(1577836800 + zlib.crc32((url or "").encode()) % 31536000, timezone.utc).strftime("%Y%m%d%H%M%S")
                    known = "" if key is None else f"{KEY}: {quote(str(key))}\r\n"
                    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{known}Content-Length: {len(body.encode())}\r\n\r\n"
                    yield member((arc_record(version, f"task{task}.arc", url, date, http + body) + "\n").encode())

        for n, file in enumerate(packed(members(), size, records)):
            yield _batch(member((version_block(version, f"task{task}-{n}.arc", "20200101000000") + "\n").encode()) + file)

    _write(pages.select("page_id", "url", "html").mapInArrow(run, "value binary"), path)


def arc_to_warc(spark: SparkSession, arc: str, warc: str, least: int = LEAST, records: int = RECORDS, size: int = SIZE) -> None:
    """Convert all ARC files under arc."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                rows = []
                for r in parse_arc(content.as_py()):
                    _, http, payload = split_http(r["block"])
                    rows.append((path, r["ordinal"], http.get(KEY), r["URL"], iso_date(r["Archive-date"]), hashlib.sha1(payload).hexdigest(), len(payload)))
                if rows:
                    kinds = (pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["path", "ordinal", "key", "url", "date", "digest", "bytes"])

    files = _files(spark, arc)
    seen = kept(files.mapInArrow(digests, "path string, ordinal int, key string, url string, date string, digest string, bytes long").filter(F.col("bytes") >= least), "digests")
    firsts = seen.groupBy("digest").agg(F.max(F.struct(F.col("key").try_cast("long").alias("number"), "key", "url", "date")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "first")
    revisits = seen.join(firsts, "digest").filter(F.col("first.key").isNotNull() & ~F.col("key").eqNullSafe(F.col("first.key")))
    by_file = revisits.groupBy("path").agg(F.collect_list(F.struct("ordinal", "first")).alias("revisits"))  # `records` a file at most

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content, revisit in zip(b.column(0), b.column(1), strict=True):
                first = {x["ordinal"]: x["first"] for x in revisit.as_py() or ()}
                members = (member(warc_record(r, first.get(r["ordinal"]))) for r in parse_arc(content.as_py()))
                for file in packed(members, size, records):
                    yield _batch(file)

    _write(files.join(by_file, "path", "left").select("content", "revisits").mapInArrow(convert, "value binary"), warc)


def read_warc(spark: SparkSession, path: str, key_type: str = "long") -> DataFrame:
    """A row per record of the WARC files under path, with keys as long or string; a response's payload is checked against its digest."""
    number = key_type == "long"
    as_key = lambda k: None if k is None else int(k) if number else unquote(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                rows = []
                for h, block in parse_warc(content.as_py()):
                    _, http, payload = split_http(block)
                    digest = base64.b32decode(h["WARC-Payload-Digest"].removeprefix("sha1:"))
                    if h["WARC-Type"] == "response" and hashlib.sha1(payload).digest() != digest:
                        raise ValueError(f"{h['WARC-Record-ID']}: the payload does not have its digest")
                    key, to = http.get(KEY), h.get("WARC-Refers-To-Key")
                    rows.append((as_key(key), int(http["Content-Length"]), digest.hex(), h["WARC-Type"], as_key(to), h["WARC-Record-ID"], h["WARC-Date"], h["WARC-Target-URI"]))
                if rows:
                    of_key = pa.int64() if number else pa.string()
                    kinds = (of_key, pa.int64(), pa.string(), pa.string(), of_key, pa.string(), pa.string(), pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    schema = f"page_id {key_type}, payload_bytes long, payload_digest string, record_type string, refers_to {key_type}, record_id string, warc_date string, target_uri string"
    names = [x.split()[0] for x in schema.split(", ")]
    return _files(spark, path).select("content").mapInArrow(run, schema)


def op2_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    arc, warc = new_path(spark, "arc"), new_path(spark, "warc")
    write_arc(spark.read.parquet(f"{sf_dir}/pages.parquet"), arc)
    arc_to_warc(spark, arc, warc)
    return read_warc(spark, warc).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES = {
    "op2_arc_to_warc": r"""
        WITH p AS (SELECT page_id, url, coalesce(html, '') AS html, octet_length(encode(coalesce(html, '')))::BIGINT AS n, sha1(coalesce(html, '')) AS d FROM pages),
             g AS (SELECT d, max(page_id) AS first FROM p WHERE n >= 1000 GROUP BY d)
        SELECT page_id, n AS payload_bytes, p.d AS payload_digest,
               CASE WHEN n >= 1000 AND page_id < first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 1000 AND page_id < first THEN first END AS refers_to
        FROM p LEFT JOIN g ON p.d = g.d AND n >= 1000""",
}

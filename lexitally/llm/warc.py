"""WARC archives without repeated payloads.

Records with the same payload are resolved by its digest: the one with the largest key stays a
response, the others become revisit records that name it. Archives are files of gzip members, one
for each record, and none grows much beyond ARCHIVE bytes before compression, so that any reader
can hold one. Reading checks the length and the digest of every block and payload.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared

ARCHIVE = 16 << 20
DATE = "2000-01-01T00:00:00Z"  # of records whose table has no date

# Names and forms of the archive format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32, HEX32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789ABCDEFGHIJKLMNOPQRSTUV"
ID = "urn:page:"
END = "\r\n\r\n"

# An empty gzip member: what the text writer puts behind the one value of a file.
_EMPTY_MEMBER = gzip.compress(b"", mtime=0)


def payload_digest(payload: Column) -> Column:
    """Base 32 of SHA-1, upper case, without a prefix: five bytes make eight digits."""
    sha = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(sha, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), HEX32, BASE32)


def _sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data, usedforsecurity=False).digest()).decode()


# --- records ----------------------------------------------------------------------------------

def record(key, url: str | None, payload: bytes, digest: str, refers_to, refers_url: str | None) -> bytes:
    """One record with all its headers made anew; a revisit holds the HTTP header alone."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}{END}".encode()
    block = http if revisit else http + payload
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<{ID}{'' if key is None else key}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": None if url is None else _header_text(url),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Block-Digest": f"sha1:{_sha1(block)}",
        "WARC-Refers-To": f"<{ID}{refers_to}>" if revisit else None,
        "WARC-Refers-To-Target-URI": None if refers_url is None else _header_text(refers_url),
        "WARC-Refers-To-Date": DATE if revisit else None,
        "WARC-Profile": PROFILE if revisit else None,
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": str(len(block)),
    }
    head = "\r\n".join([VERSION, *(f"{k}: {v}" for k, v in fields.items() if v is not None)])
    return (head + END).encode() + block + END.encode()


def _header_text(url: str) -> str:
    """White space and control characters, which would end a header, as percent escapes."""
    return "".join(c if c > " " and c != "\x7f" else quote(c) for c in url)


@dataclass(frozen=True)
class Record:
    fields: dict[str, str]
    http: dict[str, str]
    payload: bytes

    @property
    def payload_bytes(self) -> int:
        """Of the full payload, which the HTTP header states for a revisit as well."""
        return int(self.http["content-length"])


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def records(archive: bytes) -> Iterator[Record]:
    """Records of an archive, compressed or not. Their lengths alone say where they end, so a
    payload may hold anything, archives included."""
    if archive[:2] == b"\x1f\x8b":
        archive = gzip.GzipFile(fileobj=io.BytesIO(archive)).read()
    at, end = 0, END.encode()
    while at < len(archive):
        body = archive.index(end, at) + len(end)
        fields = _fields(archive[at:body - len(end)])
        stop = body + int(fields["content-length"])
        block = archive[body:stop]
        if len(block) != stop - body or archive[stop:stop + len(end)] != end:
            raise ValueError("a record's length is wrong")
        if fields["warc-block-digest"] != f"sha1:{_sha1(block)}":
            raise ValueError("a block's digest is wrong")
        head, _, payload = block.partition(end)
        if fields["warc-type"] == "response" and fields["warc-payload-digest"] != f"sha1:{_sha1(payload)}":
            raise ValueError("a payload's digest is wrong")
        yield Record(fields, _fields(head), payload)
        at = stop + len(end)


# --- tables -----------------------------------------------------------------------------------

def resolve(pages: DataFrame, key: str, url: str, payload: str, min_bytes: int = 0) -> DataFrame:
    """key, url, payload (binary), digest, refers_to, refers_url.

    Payloads are told apart by SHA-256. A null payload is the empty one. Payloads below
    `min_bytes` and rows without a key neither revisit nor are revisited; rows that repeat both key
    and payload of a response are responses as well.
    """
    body = F.coalesce(F.col(payload).cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), body.alias("payload")).withColumn(
        "strong", F.sha2("payload", 256))
    able = (F.octet_length("payload") >= min_bytes) & F.col("key").isNotNull()
    # Of the headers, only payloads that occur again are kept.
    headers = rows.where(able).groupBy("strong").agg(
        F.max(F.struct("key", "url")).alias("first"), F.min("key").alias("least"))
    originals = shared.settle(headers.where("first.key <> least").select(
        "strong", F.col("first.key").alias("original"), F.col("first.url").alias("original_url")), "originals")
    other = able & (F.col("key") != F.col("original"))
    return rows.join(originals, "strong", "left").select(
        "key", "url", "payload", payload_digest(F.col("payload")).alias("digest"),
        F.when(other, F.col("original")).alias("refers_to"), F.when(other, F.col("original_url")).alias("refers_url"))


def write(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html",
          min_bytes: int = 0) -> None:
    """Archives of all rows below `path`; see `resolve`. No rows: no archives. A record is one value,
    however long its payload, and an archive ends with the record that fills it; other columns are
    not read."""
    def step(batches):
        parts, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for row in batch.slice(at, 64).to_pylist():
                    raw = record(**row)
                    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                    parts.append(packer.compress(raw) + packer.flush())
                    size += len(raw)
                    if size >= ARCHIVE:
                        yield pa.RecordBatch.from_arrays([pa.array([b"".join(parts)])], ["value"])
                        parts, size = [], 0
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(parts)])], ["value"])

    made = shared.arrow(resolve(pages, key, url, payload, min_bytes), step, "value binary")
    # One value, one file; the writer adds its separator, a gzip member of nothing.
    made.select(F.col("value").cast("string")).write.option("maxRecordsPerFile", 1).option(
        "encoding", "ISO-8859-1").option("lineSep", _EMPTY_MEMBER.decode("latin-1")).text(path)


def read(spark: SparkSession, path: str, kind: str = "bigint", content: bool = False) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to of every record, and
    with `content` the payload that a response holds. `kind` is the type of the keys; white space
    in an url comes back as percent escapes."""
    def step(batches):
        for batch in batches:
            for archive in batch.column(0):
                found = list(records(archive.as_py()))
                names = [r.fields for r in found]
                ids = [_id(f["warc-record-id"]) for f in names]
                refers = [_id(f["warc-refers-to"]) if "warc-refers-to" in f else None for f in names]
                urls = [f.get("warc-target-uri") for f in names]
                columns = [pa.array(ids, pa.string()), pa.array(urls, pa.string()),
                           pa.array([r.payload_bytes for r in found], pa.int64()),
                           pa.array([f["warc-payload-digest"].removeprefix("sha1:") for f in names], pa.string()),
                           pa.array([f["warc-type"] for f in names], pa.string()), pa.array(refers, pa.string())]
                if content:
                    columns.append(pa.array([r.payload if "warc-refers-to" not in r.fields else None
                                             for r in found], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, columns_[:len(columns)])

    columns_ = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    shape = ("page_id string, url string, payload_bytes bigint, payload_digest string, record_type string, "
             "refers_to string") + ", payload binary" * content
    files = spark.read.format("binaryFile").load(path).select("content")
    return shared.arrow(files, step, shape).withColumn("page_id", F.col("page_id").cast(kind)).withColumn(
        "refers_to", F.col("refers_to").cast(kind))


def _id(field: str) -> str | None:
    return field.strip("<>").removeprefix(ID) or None

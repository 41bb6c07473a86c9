"""WARC archives: a writer, and a sequential reader of one gzip member per record.

The reader decompresses incrementally, takes the block by its
``Content-Length``, checks that record and member end together and verifies
payload and block digests.  It holds one record and two small buffers, never
an archive.  Archives lie in the shared folder; a written manifest names the
files of the attempts that counted, so leftovers of lost executors are not read.

Defined results:

* null html: empty payload; null url: no target header; control characters in
  a url are percent-encoded;
* equal payloads of ``MIN_REVISIT`` bytes or more: the record with the largest
  page id is the response, repeated rows of that page too; if no such record
  has an id, each is a response; shorter ones always are;
* a null page id has an empty record name and comes back null;
* no rows: no archives, no records;
* a record whose digests do not match has ``digest_ok`` false; broken framing
  or a truncated file raises ``ValueError`` with the file's name.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatwise.session import staging_path

MIN_REVISIT = 1000
ARCHIVE_BYTES = 256 << 20
READ_BYTES = 1 << 16
MAX_HEADER = 1 << 16

MANIFEST_TYPE = "path string, records bigint, bytes bigint"
RECORD_TYPE = ("record_type string, record_id string, uri string, refers_to string, payload_bytes bigint, "
               "payload_digest string, digest_ok boolean, payload binary")
_MANIFEST = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
_RECORD = pa.schema([("record_type", pa.string()), ("record_id", pa.string()), ("uri", pa.string()),
                     ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                     ("digest_ok", pa.bool_()), ("payload", pa.binary())])


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def format_record(record_id: str, uri: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One gzip member: a response with its payload, or a revisit that only keeps the HTTP header."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: <{record_id}>", "WARC-Date: 1970-01-01T00:00:00Z",
             "Content-Type: application/http; msgtype=response",
             f"WARC-Payload-Digest: {_sha1(payload)}", f"WARC-Block-Digest: {_sha1(block)}"]
    if uri is not None:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri)
        lines.append(f"WARC-Target-URI: {safe}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{refers_to}>",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode("utf-8", "replace")
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(head + block + b"\r\n\r\n") + squeeze.flush()


class MemberReader:
    """Bytes of one gzip member after the other, decompressed a little at a time."""

    def __init__(self, raw: BinaryIO, name: str):
        self.raw, self.name = raw, name
        self.packed, self.plain, self.inflate = b"", bytearray(), None

    def fail(self, what: str) -> ValueError:
        return ValueError(f"{self.name}: {what}")

    def begin(self) -> bool:
        """Start the next member; False at the file's end."""
        self.packed = self.packed or self.raw.read(READ_BYTES)
        self.inflate = zlib.decompressobj(31) if self.packed else None
        return self.inflate is not None

    def more(self) -> bool:
        """Decompress up to ``READ_BYTES`` more of the member; False at its end."""
        while not self.inflate.eof:
            if not self.packed:
                self.packed = self.raw.read(READ_BYTES)
                if not self.packed:
                    raise self.fail("truncated member")
            try:
                got = self.inflate.decompress(self.packed, READ_BYTES)
            except zlib.error as error:
                raise self.fail(str(error)) from error
            self.packed = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
            if got:
                self.plain += got
                return True
        return False

    def head(self) -> bytes:
        """Up to the empty line."""
        while (at := self.plain.find(b"\r\n\r\n")) < 0:
            if len(self.plain) > MAX_HEADER or not self.more():
                raise self.fail("record without a header's end")
        found = bytes(self.plain[:at])
        del self.plain[:at + 4]
        return found

    def exactly(self, n: int) -> bytes:
        while len(self.plain) < n:
            if not self.more():
                raise self.fail("block shorter than its Content-Length")
        found = bytes(self.plain[:n])
        del self.plain[:n]
        return found

    def end(self) -> None:
        """The record's two line ends, then nothing more in the member."""
        if self.exactly(4) != b"\r\n\r\n":
            raise self.fail("block longer than its Content-Length")
        while self.more():
            pass
        if self.plain:
            raise self.fail("more than one record in a member")


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def read_records(raw: BinaryIO, name: str = "archive") -> Iterator[dict]:
    """Records of one archive in order."""
    reader = MemberReader(raw, name)
    while reader.begin():
        head = reader.head()
        if not head.startswith(b"WARC/"):
            raise reader.fail("not a WARC record")
        fields = _fields(head)
        if not fields.get("content-length", "").isdigit():
            raise reader.fail("record without Content-Length")
        block = reader.exactly(int(fields["content-length"]))
        reader.end()
        http, _, payload = block.partition(b"\r\n\r\n")
        revisit = fields.get("warc-type") == "revisit"
        digest = fields.get("warc-payload-digest", "")
        good = _sha1(block) == fields.get("warc-block-digest", _sha1(block)) and (revisit or _sha1(payload) == digest)
        length = _fields(http).get("content-length", "")
        yield {"record_type": fields.get("warc-type"), "record_id": fields.get("warc-record-id", "").strip("<>"),
               "uri": fields.get("warc-target-uri"),
               "refers_to": fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None,
               "payload_bytes": int(length) if revisit and length.isdigit() else len(payload),
               "payload_digest": base64.b32decode(digest.removeprefix("sha1:")).hex() if digest.startswith("sha1:") else None,
               "digest_ok": good, "payload": None if revisit else payload}


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    if re.match(r"file:/(?!//)", folder):
        folder = "file:///" + folder[5:].lstrip("/")
    return fs.FileSystem.from_uri(folder)


def mark_revisits(pages: DataFrame, id_col: str = "page_id", html: str = "html", url: str = "url") -> DataFrame:
    """``id``, ``uri``, ``payload`` and ``refers_to`` (null: response) of every row.

    Only payloads that occur twice are joined; a payload that a third of all
    rows share is one row of the small side and splits as a skewed join.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url).alias("uri"),
                        F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload")})
    known = rows.filter(F.col("size") >= MIN_REVISIT).groupBy("digest", "size").agg(
        F.max("id").alias("response"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    joined = rows.join(known, ["digest", "size"], "left")
    repeat = F.col("response").isNotNull() & ~F.col("id").eqNullSafe(F.col("response"))
    return joined.select("id", "uri", "payload", F.when(repeat, F.col("response")).alias("refers_to"))


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write rows of ``mark_revisits`` as archives under ``folder``; the manifest of what counted."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _open(folder)
        system.create_dir(base, recursive=True)
        out, path, count, size = None, "", 0, 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    path, count, size = f"{folder}/{name}", 0, 0
                    out = system.open_output_stream(f"{base}/{name}", compression=None)
                names = [None if x is None else f"urn:page:{x}" for x in (row["id"], row["refers_to"])]
                member = format_record(names[0] or "urn:page:", row["uri"], row["payload"], names[1])
                out.write(member)
                count, size = count + 1, size + len(member)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_pylist([{"path": path, "records": count, "bytes": size}], _MANIFEST)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist([{"path": path, "records": count, "bytes": size}], _MANIFEST)

    records.mapInArrow(write, MANIFEST_TYPE).write.parquet(f"{folder}/manifest")
    return records.sparkSession.read.schema(MANIFEST_TYPE).parquet(f"{folder}/manifest")


def read_archives(paths: DataFrame, payload: bool = True) -> DataFrame:
    """Records of the archives named in the column ``path``; ``payload=False`` verifies but does not return payloads."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch["path"].to_pylist():
                system, place = _open(path)
                with system.open_input_stream(place, compression=None) as raw:
                    part, held = [], 0
                    for record in read_records(raw, path):
                        held += len(record["payload"] or b"")
                        part.append(record if payload else record | {"payload": None})
                        if held >= 4 << 20 or len(part) >= 1000:
                            yield pa.RecordBatch.from_pylist(part, _RECORD)
                            part, held = [], 0
                    yield pa.RecordBatch.from_pylist(part, _RECORD)

    n = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return paths.select("path").repartition(n, "path").mapInArrow(read, RECORD_TYPE)


def archive_folder(spark: SparkSession) -> str:
    """A fresh shared folder for archives."""
    return staging_path(spark, "llm-warc")

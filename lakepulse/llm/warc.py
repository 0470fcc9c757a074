"""WARC archives: a writer of one gzip member per record, and a sequential reader.

The reader decompresses members piece by piece, frames each record by its content length and verifies block and payload digests.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_path, save, ship, table
from .files import open_uri, written

#: A task begins another archive after so many bytes of payload.
ARCHIVE_BYTES = 256 << 20
CHUNK = 1 << 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _line(value: str) -> str:
    """A header value on one line."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if "\r" in value or "\n" in value else value


def record(page_id: int | None, url: str | None, payload: bytes | None, n_bytes: int, payload_digest: str, refers_to: int | None, date: str) -> bytes:
    """One record as a gzip member. Without a payload it is a revisit of the record of page refers_to."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    block = http + (payload or b"")
    fields = [
        ("WARC-Type", "revisit" if payload is None else "response"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", date),
        *([("WARC-Target-URI", _line(url))] if url is not None else []),
        *([("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", PROFILE)] if payload is None else []),
        ("WARC-Payload-Digest", payload_digest),
        ("WARC-Block-Digest", _digest(block)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(head.encode() + block + b"\r\n\r\n") + pack.flush()


class Member:
    """One gzip member of a stream, decompressed as it is asked for."""

    def __init__(self, stream, rest: bytes):
        self.stream, self.rest, self.zip, self.out = stream, rest, zlib.decompressobj(31), b""

    def _more(self) -> bool:
        if self.zip.eof:
            return False
        data = self.zip.unconsumed_tail or self.rest or self.stream.read(CHUNK)
        if not self.zip.unconsumed_tail:
            self.rest = b""
        if not data:
            raise EOFError("the archive ends inside a member")
        self.out += self.zip.decompress(data, CHUNK)
        if self.zip.eof:
            self.rest = self.zip.unused_data
        return True

    def until(self, mark: bytes, most: int = 1 << 20) -> bytes:
        while mark not in self.out:
            if len(self.out) > most or not self._more():
                raise ValueError("no end of the header")
        head, self.out = self.out.split(mark, 1)
        return head

    def exactly(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.out and not self._more():
                raise EOFError("the member ends inside its block")
            part, self.out = self.out[:n], self.out[n:]
            n -= len(part)
            yield part

    def end(self) -> bytes:
        """Checks the record's end; returns what follows the member."""
        while self._more():
            if len(self.out) > 4:
                break
        if self.out != b"\r\n\r\n":
            raise ValueError("the record doesn't end after its content length")
        return self.rest


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    return {k.strip().lower(): v.strip() for k, v in (line.split(":", 1) for line in lines[1:] if ":" in line)}


def read_records(stream, keep_payload: bool = False) -> Iterator[dict]:
    """The records of a sequential stream. Raises ValueError where framing or a digest is wrong."""
    rest = stream.read(CHUNK)
    while rest:
        member = Member(stream, rest)
        head = member.until(b"\r\n\r\n")
        if not head.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        fields = _fields(head)
        block, payload, kept, http, size = hashlib.sha1(), hashlib.sha1(), [], b"", 0
        body = False
        for part in member.exactly(int(fields["content-length"])):
            block.update(part)
            if not body:
                http += part
                if b"\r\n\r\n" not in http:
                    continue
                http, part = http.split(b"\r\n\r\n", 1)
                body = True
            payload.update(part)
            size += len(part)
            if keep_payload:
                kept.append(part)
        rest = member.end() or stream.read(CHUNK)
        kind, name = fields["warc-type"], lambda d: "sha1:" + base64.b32encode(d.digest()).decode()
        if fields["warc-block-digest"] != name(block):
            raise ValueError(f"block digest of {fields['warc-record-id']}")
        if kind == "response" and fields["warc-payload-digest"] != name(payload):
            raise ValueError(f"payload digest of {fields['warc-record-id']}")
        yield {
            "record_id": fields["warc-record-id"],
            "record_type": kind,
            "url": fields.get("warc-target-uri"),
            "refers_to": fields.get("warc-refers-to"),
            "payload_bytes": size if kind == "response" else int(_fields(b"\r\n" + http)["content-length"]),
            "payload_digest": base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex(),
            "payload": b"".join(kept) if keep_payload and kind == "response" else None,
        }


def plan_records(pages: DataFrame, least: int = 1000) -> DataFrame:
    """(page_id, url, html, n_bytes, refers_to): html is null for revisits.

    Of pages with equal payloads of `least` bytes or more, that of the largest page_id is the response (all rows of that id), the
    others, nulls included, revisit it. Equality is that of SHA-1 and length. Only narrow rows are grouped; groups of copies of any
    size are pre-aggregated, and a hot one is split by the skew join.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("n_bytes", F.octet_length("html").cast("long")).withColumn("digest", F.sha1("html"))
    copies = rows.where(F.col("n_bytes") >= least).groupBy("digest", "n_bytes").agg(F.max("page_id").alias("kept"), F.count("*").alias("n")).where("n > 1 and kept is not null")
    joined = rows.join(copies.drop("n"), ["digest", "n_bytes"], "left")
    revisit = F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept"))
    return joined.select("page_id", "url", F.when(~revisit, F.col("html")).alias("html"), "n_bytes", "digest", F.when(revisit, F.col("kept")).alias("refers_to"))


def write_warc(planned: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Writes archives into a folder; returns a saved (path, bytes, records), a row for each archive of a task that succeeded."""
    ship(planned.sparkSession)

    def write(batches):
        part, attempt, number, batch, at = TaskContext.get().partitionId(), uuid.uuid4().hex, 0, None, 0
        batch = next(batches, None)
        while batch is not None:
            name, size, count, payload_bytes = f"part-{part:06d}-{number:04d}-{attempt}.warc.gz", 0, 0, 0
            with written(folder, name, attempt) as stream:
                while batch is not None and payload_bytes < ARCHIVE_BYTES:
                    end = min(batch.num_rows, at + 64)
                    for row in batch.slice(at, end - at).to_pylist():
                        payload = None if row["html"] is None else row["html"].encode()
                        digest = "sha1:" + base64.b32encode(bytes.fromhex(row["digest"])).decode()
                        member = record(row["page_id"], row["url"], payload, row["n_bytes"], digest, row["refers_to"], date)
                        stream.write(member)
                        size, count, payload_bytes = size + len(member), count + 1, payload_bytes + len(payload or b"")
                    at = end
                    if at >= batch.num_rows:
                        batch, at = next(batches, None), 0
            number += 1
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([size]), pa.array([count])], names=["path", "bytes", "records"])

    return save(planned.mapInArrow(write, "path string, bytes long, records long"), "archives")


def read_warc(archives: DataFrame, payloads: bool = False) -> DataFrame:
    """(record_id, record_type, url, refers_to, payload_bytes, payload_digest, payload) of all records of the archives (path), a task reading whole archives."""
    ship(archives.sparkSession)

    def read(batches):
        for batch in batches:
            for uri in batch.column("path").to_pylist():
                system, path = open_uri(uri)
                with system.open_input_stream(path, compression=None) as stream:
                    held, size = [], 0
                    for row in read_records(stream, payloads):
                        held.append(row)
                        size += 1000 + len(row["payload"] or b"")
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema=schema)
                            held, size = [], 0
                    yield pa.RecordBatch.from_pylist(held, schema=schema)

    schema = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()), ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])
    paths = archives.select("path").repartition(max(1, archives.count()), "path")
    return paths.mapInArrow(read, "record_id string, record_type string, url string, refers_to string, payload_bytes long, payload_digest string, payload binary")


def round_trip(pages: DataFrame, folder: str) -> DataFrame:
    """Writes pages (page_id, url, html) as archives and reads these back: page_id, payload_bytes, payload_digest, record_type, refers_to, url.

    Null html is an empty payload, a null url is left out, a null page_id has a record id without a number; each row is a record, repeated
    ones too. Payloads shorter than 1000 bytes are all responses. No rows give no archives and an empty result. Extra columns are ignored.
    """
    found = read_warc(write_warc(plan_records(pages), folder))
    number = lambda c: F.try_to_number(F.nullif(F.regexp_extract(c, r"^<urn:page:(-?\d*)>$", 1), F.lit("")), F.lit("S9999999999999999999")).cast("long")
    return found.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"), "url")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"), fresh_path(spark, "warc"))

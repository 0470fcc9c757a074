"""Media columns: payloads kept as lossless images in archives, and a data source that reads archives by byte ranges.

A partition is a byte range of an archive. Its reader finds the first member that begins in the range, reads members until one
begins beyond it, and yields Arrow batches; a member that can't be read or decoded is read again from its own offset.
"""

from __future__ import annotations

import hashlib
import struct
import tarfile
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from . import text as tx
from .common import fresh_path, save, ship, table
from .files import open_uri, written

WIDTH, BLOCK = 64, 512
RANGE_BYTES, BATCH_BYTES, TRIES = 8 << 20, 4 << 20, 3
MAGIC = b"\x89PNG\r\n\x1a\n"


def padded(data: bytes) -> bytes:
    """data with bytes 0 up to a positive multiple of the width."""
    return data + bytes(-len(data) % WIDTH or (0 if data else WIDTH))


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode(data: bytes) -> bytes:
    """An 8-bit grey PNG whose samples are the padded bytes, a row of 64 each; its text chunk has the unpadded length."""
    samples = np.frombuffer(padded(data), np.uint8).reshape(-1, WIDTH)
    rows = np.zeros((len(samples), WIDTH + 1), np.uint8)
    rows[:, 1:] = samples
    head = struct.pack(">IIBBBBB", WIDTH, len(samples), 8, 0, 0, 0, 0)
    return MAGIC + _chunk(b"IHDR", head) + _chunk(b"tEXt", b"n_bytes\0" + str(len(data)).encode()) + _chunk(b"IDAT", zlib.compress(rows.tobytes(), 6)) + _chunk(b"IEND", b"")


def decode(media: bytes) -> tuple[bytes, int]:
    """(padded bytes, unpadded length) of an image of `encode`. Raises ValueError if it is damaged."""
    if not media.startswith(MAGIC):
        raise ValueError("not an image")
    at, found = len(MAGIC), {}
    while at < len(media):
        size, kind = struct.unpack_from(">I4s", media, at)
        data = media[at + 8 : at + 8 + size]
        if struct.unpack_from(">I", media, at + 8 + size)[0] != zlib.crc32(kind + data):
            raise ValueError(f"checksum of {kind.decode()}")
        found[kind] = data
        at += 12 + size
    width, height = struct.unpack_from(">II", found[b"IHDR"])
    rows = np.frombuffer(zlib.decompress(found[b"IDAT"]), np.uint8).reshape(height, width + 1)
    if rows[:, 0].any():
        raise ValueError("filtered rows")
    return rows[:, 1:].tobytes(), int(found[b"tEXt"].split(b"\0")[1])


def feature(samples: bytes) -> str:
    """Sixteen shares of sample values, mean, deviation and mean step between neighbours, in thousandths."""
    x = np.frombuffer(samples, np.uint8)
    shares = np.bincount(x >> 4, minlength=16) * 1000 // len(x)
    step = np.abs(np.diff(x.astype(np.int16))).mean() if len(x) > 1 else 0.0
    return ",".join(map(str, [*shares.tolist(), round(x.mean() * 1000), round(x.std() * 1000), round(step * 1000)]))


def write_archives(docs: DataFrame, folder: str) -> DataFrame:
    """Writes every text as a member <doc_id>.png of tar archives in a folder, an archive for each partition. Returns a saved (path, bytes, members)."""
    ship(docs.sparkSession)

    def write(batches):
        part, size, members = TaskContext.get().partitionId(), 0, 0
        name = f"part-{part:06d}.tar"
        with written(folder, name, uuid.uuid4().hex) as stream:
            for batch in batches:
                for some in tx.slices(batch, "text"):
                    for doc_id, text in zip(some.column("doc_id").to_pylist(), some.column("text").to_pylist()):
                        media = encode((text or "").encode())
                        info = tarfile.TarInfo("null.png" if doc_id is None else f"{doc_id}.png")
                        info.size = len(media)
                        data = info.tobuf(tarfile.USTAR_FORMAT) + media + bytes(-len(media) % BLOCK)
                        stream.write(data)
                        size, members = size + len(data), members + 1
            stream.write(bytes(2 * BLOCK))
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([size + 2 * BLOCK]), pa.array([members])], names=["path", "bytes", "members"])

    return save(docs.select("doc_id", "text").mapInArrow(write, "path string, bytes long, members long"), "archives")


@dataclass
class ByteRange(InputPartition):
    path: str
    start: int
    end: int

    def __init__(self, path: str, start: int, end: int):
        super().__init__((path, start, end))
        self.path, self.start, self.end = path, start, end


class ArchiveReader(DataSourceReader):
    def __init__(self, options):
        self.folder, self.range_bytes, self.suffix = options["path"], int(options.get("rangebytes", RANGE_BYTES)), options.get("suffix", ".tar")

    def partitions(self) -> list[ByteRange]:
        system, path = open_uri(self.folder)
        files = [f for f in system.get_file_info(fs.FileSelector(path, allow_not_found=True)) if f.type == fs.FileType.File and f.path.endswith(self.suffix)]
        return [ByteRange(f.path, s, min(f.size, s + self.range_bytes)) for f in sorted(files, key=lambda f: f.path) for s in range(0, f.size, self.range_bytes)] or [ByteRange("", 0, 0)]

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        system, _ = open_uri(self.folder)
        held, size = [], 0
        for name, offset, length in self._members(system, partition):
            media, payload, n_bytes, tries = self._retried(system, partition.path, offset, length)
            held.append((name, offset, n_bytes, payload, len(media), hashlib.sha256(media).hexdigest(), tries))
            size += len(payload)
            if size > BATCH_BYTES:
                yield self._batch(held)
                held, size = [], 0
        if held:
            yield self._batch(held)

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        types = (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=list(COLUMNS))

    @staticmethod
    def _members(system: fs.FileSystem, p: ByteRange) -> Iterator[tuple[str, int, int]]:
        """(name, offset of its data, length) of the members whose header begins in the range. Until the first header is found every block is tried."""
        with system.open_input_file(p.path) as file:
            at, found, total = -(-p.start // BLOCK) * BLOCK, p.start == 0, file.size()
            while at < min(p.end, total):
                file.seek(at)
                block = file.read(BLOCK)
                if len(block) < BLOCK or (found and block == bytes(BLOCK)):
                    return
                try:
                    info = tarfile.TarInfo.frombuf(block, "utf-8", "strict") if block[257:262] == b"ustar" else None
                except (tarfile.HeaderError, UnicodeDecodeError):
                    info = None
                if info is None:
                    if found:
                        raise ValueError(f"no member at {at} of {p.path}")
                    at += BLOCK
                    continue
                found = True
                yield info.name, at + BLOCK, info.size
                at += BLOCK + -(-info.size // BLOCK) * BLOCK

    @staticmethod
    def _retried(system: fs.FileSystem, path: str, offset: int, length: int) -> tuple[bytes, bytes, int, int]:
        for tries in range(1, TRIES + 1):
            try:
                with system.open_input_file(path) as file:
                    file.seek(offset)
                    media = file.read(length)
                return media, *decode(media), tries
            except (OSError, ValueError, zlib.error, struct.error):
                if tries == TRIES:
                    raise
        raise AssertionError


COLUMNS = {"member": "string", "offset": "long", "n_bytes": "long", "payload": "binary", "media_bytes": "long", "media_sha256": "string", "tries": "int"}


class MediaArchives(DataSource):
    """spark.read.format("media_archives").option("rangeBytes", n).load(folder)"""

    @classmethod
    def name(cls) -> str:
        return "media_archives"

    def schema(self) -> str:
        return ", ".join(f"{k} {v}" for k, v in COLUMNS.items())

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options)


def read_archives(spark: SparkSession, folder: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    ship(spark)
    spark.dataSource.register(MediaArchives)
    return spark.read.format("media_archives").option("rangeBytes", range_bytes).load(folder)


def media_round_trip(docs: DataFrame, folder: str) -> DataFrame:
    """Stores every whole text of docs (doc_id, text) as an image in archives and reads the stored bytes back.

    Returns doc_id, n_bytes (of the text in UTF-8), payload_bytes, payload_sha256, tail_crc32 (of the last 64), media_bytes, media_sha256,
    feature. Null and empty texts are 64 bytes 0. Rows of equal text have equal values; a null doc_id stays null; repeated rows are
    members of their own. An empty table gives an empty result. Extra columns are ignored.
    """
    write_archives(docs, folder)

    def measure(batches):
        for batch in batches:
            data = batch.column("payload").to_pylist()
            columns = [[len(x) for x in data], [hashlib.sha256(x).hexdigest() for x in data], [zlib.crc32(x[-WIDTH:]) for x in data], [feature(x) for x in data]]
            arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.int64(), pa.string()))]
            kept = batch.select(["member", "n_bytes", "media_bytes", "media_sha256"])
            yield pa.RecordBatch.from_arrays([*kept.columns, *arrays], names=[*kept.schema.names, "payload_bytes", "payload_sha256", "tail_crc32", "feature"])

    schema = "member string, n_bytes long, media_bytes long, media_sha256 string, payload_bytes long, payload_sha256 string, tail_crc32 long, feature string"
    found = read_archives(docs.sparkSession, folder).mapInArrow(measure, schema)
    doc_id = F.nullif(F.regexp_replace("member", r"\.png$", ""), F.lit("null")).cast("long").alias("doc_id")
    return found.select(doc_id, "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")


def op6_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_round_trip(table(spark, sf_dir, "documents"), fresh_path(spark, "media"))

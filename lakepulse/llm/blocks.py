"""Blocks of documents: rows of a few MB that later passes read, answer and join by number.

A pass over blocks sends each bucket of the hash space one packed array per block (equal values of a block count once), so a
hot value reaches a bucket as often as there are blocks, not rows. The bucket answers every array with one bit per value.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import text as tx
from .common import n_partitions, save, ship

BLOCK_BYTES = 4 << 20


def make_blocks(docs: DataFrame, ordered: bool = True, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Saves docs as (block, n_words, rows): rows is an array of the input's rows, at most block_bytes of text or one row.

    ordered: blocks are numbered by doc_id (nulls first), and rows lie in a block by doc_id. Columns keep their names inside rows.
    """
    ship(docs.sparkSession)
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("rows", T.ArrayType(docs.schema))])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, at = 0, TaskContext.get().partitionId()
        out = to_arrow_schema(schema)
        held, size = [], 0

        def block():
            nonlocal number
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            number += 1
            cells = pa.ListArray.from_arrays(pa.array([0, rows.num_rows], pa.int32()), rows.to_struct_array().cast(out.field("rows").type.value_type))
            n_words = len(tx.split(rows.column("text")).starts)
            return pa.RecordBatch.from_arrays([pa.array([(at << 32) + number - 1]), pa.array([n_words]), cells.cast(out.field("rows").type)], schema=out)

        for batch in batches:
            for part in tx.slices(batch, "text", block_bytes // 8):
                more = int(tx.utf8(part.column("text"))[1][-1])
                if held and size + more > block_bytes:
                    yield block()
                    held, size = [], 0
                held.append(part)
                size += more
        if held:
            yield block()

    if ordered:
        docs = docs.repartitionByRange(n_partitions(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id", "text")
    return save(docs.mapInArrow(pack, schema), "blocks")


def buckets_for(n_values: int, most: int = 1_500_000) -> int:
    """So many buckets that each gets about `most` values at the most."""
    return max(1, -(-n_values // most))


def bucket_of(h: np.ndarray, n: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


def exchange(sent: DataFrame, answer: Callable[[list[int], list[bytes]], list[bytes]]) -> DataFrame:
    """(bucket, block, data) to (block, answers array of (bucket, data)): each bucket's arrays meet in one task, in the order of their blocks."""

    def meet(part: pa.Table) -> pa.Table:
        part = part.sort_by("block")
        out = answer(part.column("block").to_pylist(), part.column("data").to_pylist())
        return pa.table({"block": part.column("block"), "bucket": part.column("bucket"), "data": pa.array(out, pa.binary())})

    back = sent.groupBy("bucket").applyInArrow(meet, "block long, bucket long, data binary")
    return back.groupBy("block").agg(F.collect_list(F.struct("bucket", "data")).alias("answers"))


def sends(block: int, keys: np.ndarray, n: int, pack: Callable[[slice], bytes]) -> list[tuple[int, int, bytes]]:
    """Rows to exchange for sorted keys: one per bucket that has any, in time that grows with the keys."""
    buckets, first = np.unique(bucket_of(keys, n), return_index=True)
    return [(int(b), block, pack(slice(s, e))) for b, s, e in zip(buckets, first, np.append(first[1:], len(keys)))]


def bits_in_order(answers: list[dict] | None, n_keys: int) -> np.ndarray:
    """The bits of all buckets, in the order of the sorted keys they were sent for. Each answer is its count (4 bytes) and packed bits."""
    parts = [unpack(a["data"]) for a in sorted(answers or [], key=lambda a: a["bucket"])]
    out = np.concatenate(parts) if parts else np.zeros(0, bool)
    assert len(out) == n_keys, (len(out), n_keys)
    return out


def pack_bits(bits: np.ndarray) -> bytes:
    return len(bits).to_bytes(4, "little") + np.packbits(bits).tobytes()


def unpack(data: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8, offset=4), count=int.from_bytes(data[:4], "little")).astype(bool)


def to_batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    bucket, block, data = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int64()), pa.array(block, pa.int64()), pa.array(data, pa.binary())], names=["bucket", "block", "data"])


SENT = "bucket long, block long, data binary"

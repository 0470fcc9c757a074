"""Document fingerprints: one-permutation MinHash with optimal densification and packed low-order bits."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import text as tx
from .common import n_partitions, ship, table

U = np.uint64
SHINGLE, BINS, BITS = 5, 512, 4


def probe(column: np.ndarray, k: int, bins: int) -> np.ndarray:
    """The bin that each bin asks at its k-th try: a hash of (bin, try), so all documents ask alike."""
    return (tx.mix(column.astype(U) * U(1 << 20) + U(k), 41) % U(bins)).astype(np.int64)


def minima(rows: np.ndarray, tokens: np.ndarray, n: int, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """(n, bins) least values of the shingles that fall into each bin, and whether there is one. Each shingle is hashed once."""
    shift = U(64 - (bins.bit_length() - 1))
    cell = rows * bins + (tokens >> shift).astype(np.int64)
    out = np.full(n * bins, np.iinfo(U).max, U)
    np.minimum.at(out, cell, tokens)
    full = np.zeros(n * bins, bool)
    full[cell] = True
    return out.reshape(n, bins), full.reshape(n, bins)


def densify(values: np.ndarray, full: np.ndarray) -> np.ndarray:
    """Each empty bin copies the first full bin of its probe sequence, however long that is. Rows without any full bin stay as they are."""
    out, some = values.copy(), full.sum(axis=1)
    alone = np.flatnonzero(some == 1)  # every sequence ends at the one full bin
    out[alone] = values[alone, full[alone].argmax(axis=1)][:, None]
    row, column = np.nonzero(~full & (some > 1)[:, None])
    k = 0
    while len(row):
        source = probe(column, k, full.shape[1])
        hit = full[row, source]
        out[row[hit], column[hit]] = values[row[hit], source[hit]]
        row, column, k = row[~hit], column[~hit], k + 1
    return out


def fingerprints(texts: pa.Array, shingle: int = SHINGLE, bins: int = BINS, bits: int = BITS) -> np.ndarray:
    """(n, bins*bits/8) bytes: the low-order bits of each bin, packed. A text without words has no row of its own: see `empty`."""
    words = tx.split(texts)
    rows, tokens = tx.shingles(words, tx.hashes(words, 9), shingle, 10)
    values, full = minima(rows, tokens, len(texts), bins)
    low = tx.mix(densify(values, full), 42) & U((1 << bits) - 1)
    spread = (low[:, :, None] >> np.arange(bits, dtype=U)) & U(1)
    return np.packbits(spread.reshape(len(texts), -1).astype(bool), axis=1), words.counts == 0


def likeness(a: np.ndarray, b: np.ndarray, empty_a: np.ndarray, empty_b: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Estimated Jaccard similarity, 0 to 1: the share of equal bins, less what 2^-bits of unequal ones give by chance.

    Two texts without words are alike, one of them is unlike any other.
    """
    x, y = (np.unpackbits(v, axis=1).reshape(len(v), -1, bits) for v in (a, b))
    equal = (x == y).all(axis=2).mean(axis=1)
    chance = 2.0**-bits
    out = np.clip((equal - chance) / (1 - chance), 0, 1)
    return np.where(empty_a & empty_b, 1.0, np.where(empty_a | empty_b, 0.0, out))


def fingerprint_documents(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, fingerprint) of every whole text of docs: lower-case hex; empty for a text without words, null or empty."""

    def work(batches):
        for batch in batches:
            for part in tx.slices(batch, "text", 1 << 20):
                value, empty = fingerprints(part.column("text"), **options)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(_hex(value, empty))], names=["doc_id", "fingerprint"])

    ship(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(work, "doc_id long, fingerprint string")


def _hex(value: np.ndarray, empty: np.ndarray) -> list[str]:
    return ["" if e else v.tobytes().hex() for v, e in zip(value, empty)]


def with_next(docs: DataFrame, per_part: int = 2000) -> DataFrame:
    """docs (doc_id, text) dealt into ranges of descending doc_id, each followed by the first document of the next range.

    Returns (part, own, doc_id, text), sorted within partitions by part and descending doc_id. Ranges end at ids that exist, so the
    document that follows a range is known beforehand; the first document of all follows the last. The number of ranges is bounded,
    only their end ids go to the driver.
    """
    spark = docs.sparkSession
    ship(spark)
    n = docs.count()
    parts = int(min(max(1, n // per_part, n_partitions(spark)), 10_000))
    ends = docs.agg(F.percentile_approx("doc_id", [k / parts for k in range(1, parts + 1)], 100 * parts), F.max("doc_id")).first()
    ends = sorted({*(ends[0] or []), *([ends[1]] if ends[1] is not None else [])})  # the largest id of each part
    known = bool(ends)
    ends = ends or [0]
    # part k holds ids over ends[k-1] up to ends[k]; the id ends[k] also follows part k+1, and the largest follows part 0.
    edges, step = F.array(*[F.lit(int(e)) for e in ends]), math.isqrt(len(ends)) + 1
    # Two short searches: among every step-th end, then among the ends that follow the last one below.
    below = lambda ids: F.size(F.filter(ids, lambda e: F.coalesce(F.col("doc_id"), F.lit(ends[0])) > e))
    coarse = ends[step - 1 :: step]
    before = below(F.array(*[F.lit(int(e)) for e in coarse])) * step if coarse else F.lit(0)
    part = before + below(F.slice(edges, before + 1, F.lit(step)))
    rows = docs.select("doc_id", "text", part.alias("part"))
    ends_part = F.col("doc_id") == F.element_at(edges, F.col("part") + 1) if known else F.lit(True)  # without any id, the first text follows the last
    extra = F.when(ends_part, (F.col("part") + 1) % len(ends))
    rows = rows.withColumn("to", F.explode(F.array_compact(F.array(F.struct(F.col("part"), F.lit(1).alias("own")), F.when(extra.isNotNull(), F.struct(extra.alias("part"), F.lit(0).alias("own")))))))
    rows = rows.select(F.col("to.part").alias("part"), F.col("to.own").alias("own"), "doc_id", "text")
    return rows.repartition(max(n_partitions(spark), parts), "part").sortWithinPartitions("part", F.desc("own"), F.desc_nulls_last("doc_id"), "text")


def edited(text: str, other: str) -> str:
    """text with its last half (rounded down) replaced by as many first code points of other, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints every text and its edited text, which ends with the start of the next document by descending doc_id.

    Null texts count as empty. Rows of equal doc_id follow each other in the order of their texts; null ids come last, in the part of
    the smallest ids. A table of one row is its own next document. An empty table gives an empty result. Extra columns are ignored.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # (doc_id, text, text of the next document)
        last: tuple | None = None
        size = 0

        def out() -> pa.RecordBatch:
            ids, texts, nexts = zip(*held)
            changed = [edited(t, o) for t, o in zip(texts, nexts)]
            own, follow, other = (fingerprints(pa.array(v, pa.string())) for v in (texts, nexts, changed))
            arrays = [
                pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
                pa.array(_hex(*own)), pa.array(_hex(*other)), pa.array(likeness(own[0], other[0], own[1], other[1])), pa.array(likeness(own[0], follow[0], own[1], follow[1])),
            ]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            for part, own, doc_id, text in zip(*[batch.column(c).to_pylist() for c in ("part", "own", "doc_id", "text")]):
                text = text or ""
                if last and last[0] == part:
                    if last[1]:
                        held.append((last[2], last[3], text))
                        size += len(last[3]) + len(text)
                last = (part, own, doc_id, text)
                if size > 1 << 19:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(docs.select("doc_id", "text")).mapInArrow(work, schema)


def op8_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_edits(table(spark, sf_dir, "documents"))

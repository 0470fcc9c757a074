"""Near duplicates by min-max hashing: each permutation of a document's shingles gives its least and its greatest value.

Both agree between two sets with a chance equal to their Jaccard similarity, so half as many permutations give a signature of the same
length, and the share of agreeing values is an unbiased estimate, of lower variance than that of minima alone. Bands of four values
make groups of documents; links of a group are confirmed on whole sets, by the blocks of ngram_join.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import text as tx
from .common import discard, save, ship, table
from .ngram_join import Sets, _chunks, join_groups

U = np.uint64
#: 128 values in 32 bands of 4: a pair of similarity 0.85 shares no band with a chance of 6e-11, one of 0.8 with 5e-8.
PERMUTATIONS, BAND = 64, 4
#: Tokens that a permutation is applied to at once.
AT_ONCE = 1 << 15


def permuted(tokens: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """The k-th permutation of 64-bit numbers: times an odd number, plus another."""
    factor, more = tx.mix(np.array([2 * k + 1, 2 * k + 2], U), 61 + seed)
    return tokens * (factor | U(1)) + more


def min_max(tokens: np.ndarray, first: np.ndarray, permutations: int = PERMUTATIONS) -> np.ndarray:
    """(rows, 2 * permutations): the least value of each row's tokens under each permutation, then the greatest. Rows without tokens are 0.

    tokens of row i are first[i] to first[i + 1]. Every token is hashed once a permutation, for two values of the signature."""
    tokens = tx.mix(tokens.copy(), 60)
    out = np.zeros((len(first) - 1, 2 * permutations), U)
    some = np.flatnonzero(np.diff(first))
    at = 0
    while at < len(some):
        end = max(at + 1, int(np.searchsorted(first[some], first[some[at]] + AT_ONCE)))
        rows = some[at:end]
        own, starts = tokens[first[rows[0]] : first[rows[-1] + 1]], first[rows] - first[rows[0]]
        for k in range(permutations):
            values = permuted(own, k)
            out[rows, k], out[rows, permutations + k] = np.minimum.reduceat(values, starts), np.maximum.reduceat(values, starts)
        at = end
    return out


def bands(signatures: np.ndarray, size: int = BAND) -> np.ndarray:
    """One number per band of so many values; minima and maxima are in different bands. Values that are left over aren't used."""
    half = signatures.shape[1] // 2
    out = []
    for side, values in enumerate((signatures[:, :half], signatures[:, half:])):
        for at in range(0, half - size + 1, size):
            h = np.full(len(values), side * 4096 + at, U)
            for c in range(at, at + size):
                h = tx.mix(h * tx.WORD_BASE + values[:, c], 62)
            out.append(h)
    return np.stack(out, axis=1) if out else np.zeros((len(signatures), 0), U)


def likeness(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of sets by their signatures: the share of equal minima and maxima."""
    return (x == y).mean(axis=-1)


def signatures(docs: DataFrame, n: int = 3, lower: bool = True, permutations: int = PERMUTATIONS) -> DataFrame:
    """(row, n_shingles, signature): the min-max signature of each row of docs (doc_id, text, any others, all in the struct row), as an array of
    longs, minima first; null for texts without words."""
    ship(docs.sparkSession)
    schema = T.StructType([T.StructField("row", docs.schema), *T.StructType.fromDDL("n_shingles long, signature array<long>")])

    def sign(batches):
        out = to_arrow_schema(schema)
        for part in _chunks(batches):
            sets = Sets(part.column("text"), n, lower)
            values = min_max(sets.token, sets.first, permutations).view(np.int64)
            rows = pa.array([v if c else None for v, c in zip(values, sets.count)], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([part.to_struct_array().cast(out.field("row").type), pa.array(sets.count, pa.int64()), rows.cast(out.field("signature").type)], schema=out)

    return docs.mapInArrow(sign, schema)


def _census(docs: DataFrame, n: int, lower: bool, permutations: int, size: int) -> DataFrame:
    """Saves (doc_id, n, a, b, bands): size and digest of each document's set, and its bands as packed 64-bit numbers (null: no set)."""

    def count(batches):
        for part in _chunks(batches):
            sets = Sets(part.column("text"), n, lower)
            a, b = sets.digests()
            found = bands(min_max(sets.token, sets.first, permutations), size)
            packed = pa.array([v.view(np.int64) if c else None for v, c in zip(found, sets.count)], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sets.count, pa.int64()), pa.array(a), pa.array(b), packed], names=["doc_id", "n", "a", "b", "bands"])

    return save(docs.mapInArrow(count, "doc_id long, n long, a long, b long, bands array<long>"), "census")


def _groups(census: DataFrame) -> DataFrame:
    """Saves groups (first, second, doc_id, n) of different sets that share a band. Of equal sets the least doc_id stands for all.

    A group has the name of its leaders, the documents of least and greatest hash, so bands that the same documents share, as near
    copies do, are one group. Leaders come from a partial aggregation; only members of bands with several sets are listed.
    """
    sets = census.where("doc_id is not null and n > 0").groupBy("n", "a", "b").agg(F.min("doc_id").alias("doc_id"), F.any_value("bands").alias("bands"))
    sets = save(sets.select("doc_id", "n", "bands"), "sets")
    entries = sets.select("doc_id", "n", F.explode("bands").alias("band"))
    hashed: Column = F.struct(F.xxhash64("doc_id").alias("h"), "doc_id")
    led = entries.groupBy("band").agg(F.min(hashed).alias("least"), F.max(hashed).alias("most")).where("least.doc_id <> most.doc_id")
    led = led.select("band", F.col("least.doc_id").alias("first"), F.col("most.doc_id").alias("second"))
    groups = save(entries.join(led.hint("merge"), "band").select("first", "second", "doc_id", "n").distinct(), "groups")
    discard(sets)
    return groups


def near_duplicates(docs: DataFrame, n: int = 3, percent: int = 85, lower: bool = True, permutations: int = PERMUTATIONS, band: int = BAND) -> DataFrame:
    """Links documents (doc_id, text) whose sets of word n-grams have a Jaccard similarity of percent/100 at least.

    Returns per input row doc_id, n_shingles, component_id (the least doc_id reachable by links, itself included) and kept (doc_id is
    component_id). Candidates share a band; all links between candidates are confirmed on whole sets. A text with fewer than n words has
    its whole sequence as one n-gram; null and empty texts have none and link with nothing. Rows of equal doc_id are one node; a null
    doc_id links with nothing, its component is null, and it is kept. An empty table gives an empty result.
    """
    ship(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    census = _census(docs, n, lower, permutations, band)
    groups = _groups(census)
    known = save(census.select("doc_id", "n", "a", "b"), "known")
    discard(census)
    found = join_groups(docs, known, groups, n, percent, lower)
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op11_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))

"""Removes word windows that already occurred earlier in the corpus, by level-wise doubling of window lengths.

Windows of half the length come first. A long window that repeats holds equal halves, so of each long window one half-length
window, chosen by content alone (the least hash among those inside it), is looked up over the whole corpus. Half-length windows
that occur once end there; the windows around the others are extended to twice the length and looked up again, which decides what
goes. Further levels double on: runs of repeated windows are kept as word hashes, without their texts, and windows of twice the
length inside them are looked up, until no candidates survive or the last length asked for is reached.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import text as tx
from .blocks import SENT, bits_in_order, buckets_for, exchange, make_blocks, pack_bits, sends, to_batch
from .common import discard, save, table

U = np.uint64


def _anchors(words: tx.Words, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the whole windows of n words; for each the start of its half-length window of least hash; hashes of half-length windows."""
    half = n // 2
    level = tx.mix(tx.windows(h, half), 1)
    starts = np.flatnonzero(tx.whole_windows(words, n))
    if not len(starts):
        return starts, starts, level
    least, width = np.arange(len(level)), 1
    while width < n - half + 1:  # positions of the minimum over the next `width` windows
        step = min(width, n - half + 1 - width)
        a, b = least[: len(least) - step], least[step:]
        least = np.where(level[b] < level[a], b, a)
        width += step
    return starts, least[starts], level


def _keys(words: tx.Words, h: np.ndarray, n: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """96 bits of hash of the windows at `at`."""
    w = tx.windows(h, n)[at]
    return tx.mix(w, 2), (tx.mix(tx.windows(tx.mix(h, 5), n)[at], 3) >> U(32)).astype(np.uint32)


def _sort(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by (a, b), stable, and where a new value begins in that order."""
    order = np.argsort(a, kind="stable")
    same = a[order][1:] == a[order][:-1]
    if same.any() and not np.array_equal(b[order][1:][same], b[order][:-1][same]):
        order = np.lexsort((b, a))
    new = np.ones(len(a), bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    return order, new


class _Pass:
    """What all passes derive from a block, by the same rule each time."""

    def __init__(self, texts: pa.Array, n: int):
        self.words = tx.split(texts)
        self.h = tx.hashes(self.words)
        self.starts, self.anchor, level = _anchors(self.words, self.h, n)
        self.n = n
        used = np.unique(self.anchor)
        value, at, count = np.unique(level[used] | U(1), return_inverse=True, return_counts=True)
        self.half_keys, self.half_count = value, count
        place = np.zeros(len(level) + 1, np.int64)
        place[used] = at
        self.half_of = place[self.anchor]  # of each window: its half-length key

    def extended(self, repeated: np.ndarray):
        """Windows whose half-length window repeats: (starts, order, new, key a, key b)."""
        at = self.starts[repeated[self.half_of]] if len(self.starts) else self.starts
        a, b = _keys(self.words, self.h, self.n, at)
        order, new = _sort(a, b)
        return at, order, new, a, b


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.Array, int]]:
    for i in range(batch.num_rows):
        yield batch.column("block")[i].as_py(), batch.column("texts")[i].values, i


def _repeated(blocks: list[int], data: list[bytes]) -> list[bytes]:
    """Which half-length windows occur twice anywhere. The lowest bit of a key says that its block has it twice."""
    parts = [np.frombuffer(d, U) for d in data]
    every = np.concatenate(parts)
    order = np.argsort(every >> U(1), kind="stable")
    key = every[order] >> U(1)
    same = key[1:] == key[:-1]
    twice = (every[order] & U(1)).astype(bool)
    twice[1:] |= same
    twice[:-1] |= same
    bits = np.zeros(len(every), bool)
    bits[order] = twice
    return [pack_bits(x) for x in np.split(bits, np.cumsum([len(p) for p in parts])[:-1])]


def _seen_before(blocks: list[int], data: list[bytes]) -> list[bytes]:
    """Two bits for each window: whether an earlier block has it, and whether any other block has it. Arrays come in the order of
    their blocks; each has a value once."""
    sizes = [len(d) // 12 for d in data]
    a = np.concatenate([np.frombuffer(d, U, n) for d, n in zip(data, sizes)])
    b = np.concatenate([np.frombuffer(d, np.uint32, n, n * 8) for d, n in zip(data, sizes)])
    order, new = _sort(a, b)
    bits = np.zeros((len(a), 2), bool)
    bits[order, 0] = ~new
    bits[order, 1] = ~new | ~np.append(new[1:], True)
    return [pack_bits(x.ravel()) for x in np.split(bits, np.cumsum(sizes)[:-1])]


class _Runs:
    """Stretches of words of a block in which every window of n words repeats: (document in the block, first word, words, their hashes)."""

    COLUMNS = "block long, n long, at binary, first binary, size binary, h binary"
    SCHEMA = pa.schema([(c, pa.int64()) for c in ("block", "n")] + [(c, pa.binary()) for c in ("at", "first", "size", "h")])

    def __init__(self, block: int, n: int, at: np.ndarray, first: np.ndarray, size: np.ndarray, h: np.ndarray):
        self.block, self.n, self.at, self.first, self.size, self.h = block, n, at, first, size, h

    @classmethod
    def of(cls, batch: pa.RecordBatch, i: int) -> _Runs:
        get = lambda c: batch.column(c)[i].as_py()
        return cls(get("block"), get("n"), *(np.frombuffer(get(c), np.int64) for c in ("at", "first", "size")), np.frombuffer(get("h"), U))

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"block": self.block, "n": self.n, "at": self.at.tobytes(), "first": self.first.tobytes(), "size": self.size.tobytes(), "h": self.h.tobytes()}] if len(self.at) else [], schema=self.SCHEMA)

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Places in h where windows of n words begin that lie in one run, and their hashes."""
        end = np.repeat(np.cumsum(self.size), self.size)
        places = np.flatnonzero(np.arange(len(self.h)) + n <= end)
        return places, tx.mix(tx.windows(self.h, n)[places], 40) if len(places) else self.h[:0]

    def shortened(self, n: int, places: np.ndarray) -> _Runs:
        """The runs of windows of n words that begin at these places."""
        start = np.cumsum(self.size) - self.size
        run = np.searchsorted(start, places, "right") - 1
        new = np.ones(len(places), bool)
        new[1:] = (np.diff(places) != 1) | (np.diff(run) != 0)
        s = np.flatnonzero(new)
        size = np.diff(np.append(s, len(places))) + n - 1
        words = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(places[s], size)
        return _Runs(self.block, n, self.at[run[s]], self.first[run[s]] + places[s] - start[run[s]], size, self.h[words])


def _double(runs: DataFrame, n: int) -> DataFrame:
    """The runs of windows of n words that repeat anywhere, from those of n / 2 words."""

    def keyed(r: _Runs):
        places, h = r.windows(n)
        value, at, count = np.unique(h | U(1), return_inverse=True, return_counts=True)
        return places, (value & ~U(1)) | (count > 1).astype(U), at

    n_keys = runs.agg(F.coalesce(F.sum(F.length("h")), F.lit(0))).first()[0] // 8

    def send(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                r = _Runs.of(batch, i)
                keys = keyed(r)[1]
                yield to_batch(sends(r.block, keys, buckets_for(n_keys), lambda s: keys[s].tobytes()))

    def shorten(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                r = _Runs.of(batch, i)
                places, keys, at = keyed(r)
                yield r.shortened(n, places[bits_in_order(batch.column("answers")[i].as_py(), len(keys))[at]]).batch()

    answered = runs.join(exchange(runs.mapInArrow(send, SENT), _repeated), "block", "left")
    return save(answered.mapInArrow(shorten, _Runs.COLUMNS), "runs")


def repeated_windows(docs: DataFrame, window: int = 20, until: int | None = 20, select: list[Column] | None = None) -> DataFrame:
    """For each document of docs (doc_id, text, any other columns): the words left once windows seen earlier are gone.

    Returns row (struct of the input row), n_words, n_removed, kept (kept words joined by one space), removed (array of
    (start, end) word ranges) and longest. A window is `window` consecutive words of one document; each word covered by a window whose
    word sequence also starts earlier (smaller doc_id, or same document and earlier start) goes. longest is the greatest of the lengths
    window, 2 * window, 4 * window, ... up to `until` (None: until no candidates survive) of which the document has a window that
    occurs again anywhere, earlier or later; 0 if it has none. Null and empty texts have no words and give an empty kept text;
    documents shorter than a window lose nothing. Rows with equal doc_id are ordered by text; an exact repetition of a row counts
    as later than the row. An empty table gives an empty result. `window` must be even. With `select`, these columns of the result
    are saved and all inner tables deleted.
    """
    if window % 2:
        raise ValueError("window must be even")
    blocks = make_blocks(docs)
    texts = F.col("rows.text").alias("texts")
    n_words = blocks.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    n_half, n_full = buckets_for(n_words // 4), buckets_for(n_words)

    def send_halves(batches):
        for batch in batches:
            for block, column, _ in _texts(batch):
                p = _Pass(column, window)
                keys = (p.half_keys & ~U(1)) | (p.half_count > 1).astype(U)
                yield to_batch(sends(block, keys, n_half, lambda s: keys[s].tobytes()))

    halves = save(exchange(blocks.select("block", texts).mapInArrow(send_halves, SENT), _repeated), "halves")

    def send_windows(batches):
        for batch in batches:
            for block, column, i in _texts(batch):
                p = _Pass(column, window)
                _, order, new, a, b = p.extended(bits_in_order(batch.column("answers")[i].as_py(), len(p.half_keys)))
                a, b = a[order[new]], b[order[new]]
                yield to_batch(sends(block, a, n_full, lambda s: a[s].tobytes() + b[s].tobytes()))

    # Joined by merge at every size: a broadcast of the answers while they are small would only move the shuffle of the texts to larger inputs.
    halved = blocks.select("block", texts).join(halves.hint("merge"), "block", "left")
    full = save(exchange(halved.mapInArrow(send_windows, SENT), _seen_before), "windows")

    def late_and_repeated(p: _Pass, batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts of the windows looked up; of each whether it starts earlier, too, and whether it occurs again at all."""
        at, order, new, *_ = p.extended(bits_in_order(batch.column("halves")[i].as_py(), len(p.half_keys)))
        earlier, others = bits_in_order(batch.column("answers")[i].as_py(), 2 * int(new.sum())).reshape(-1, 2).T
        late, again = np.empty(len(at), bool), np.empty(len(at), bool)
        value = np.cumsum(new) - 1
        late[order] = ~new | earlier[value]
        again[order] = others[value] | (np.bincount(value)[value] > 1 if len(value) else others[value])
        return at, late, again

    joined = blocks.join(halves.withColumnRenamed("answers", "halves").hint("merge"), "block", "left").join(full.hint("merge"), "block", "left")
    longest, levels = None, []
    if until is None or until > window:

        def begin(batches):
            for batch in batches:
                for block, column, i in _texts(batch):
                    p = _Pass(column, window)
                    at, _, again = late_and_repeated(p, batch, i)
                    every = _Runs(block, 1, np.arange(len(p.words.counts)), np.zeros(len(p.words.counts), np.int64), p.words.counts, p.h)
                    yield every.shortened(window, at[again]).batch()

        levels, n = [save(joined.select("block", texts, "halves", "answers").mapInArrow(begin, _Runs.COLUMNS), "runs")], 2 * window
        while not levels[-1].isEmpty() and (until is None or n <= until):
            levels.append(_double(levels[-1], n))
            n *= 2

        def reached(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    r = _Runs.of(batch, i)
                    at = np.unique(r.at)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), r.block)), pa.array(at), pa.array(np.full(len(at), r.n))], names=["block", "at", "n"])

        every = levels[0]
        for more in levels[1:]:
            every = every.union(more)
        longest = every.mapInArrow(reached, "block long, at long, n long").groupBy("block", "at").agg(F.max("n").alias("n"))
        longest = save(longest.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("at", "n"))).alias("longest")), "longest")
        discard(*levels)
        joined = joined.join(longest, "block", "left")
    else:
        joined = joined.withColumn("longest", F.lit(None).cast("map<bigint,bigint>"))

    schema = T.StructType(
        [
            T.StructField("row", docs.schema),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("kept", T.StringType()),
            T.StructField("removed", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
            T.StructField("longest", T.LongType()),
        ]
    )

    def remove(batches):
        out = to_arrow_schema(schema)
        for batch in batches:
            for i in range(batch.num_rows):
                rows = batch.column("rows")[i].values
                column = rows.field("text")
                p = _Pass(column, window)
                at, late, again = late_and_repeated(p, batch, i)
                gone = np.zeros(len(p.words.starts) + 1, np.int64)
                np.add.at(gone, at[late], 1)
                np.add.at(gone, at[late] + window, -1)
                gone = np.cumsum(gone)[:-1] > 0
                level = np.zeros(len(column), np.int64)
                level[p.words.row[at[again]]] = window
                for doc, n in batch.column("longest")[i].as_py() or []:
                    level[doc] = n
                yield pa.RecordBatch.from_arrays([*_kept(rows, column, p.words, gone, out), pa.array(level)], schema=out)

    found = joined.select("rows", "halves", "answers", "longest").mapInArrow(remove, schema)
    if select is None:
        return found
    found = save(found.select(*select), "deduped")
    discard(blocks, halves, full, *([longest] if longest is not None else []))
    return found


def _kept(rows: pa.StructArray, column: pa.Array, words: tx.Words, gone: np.ndarray, out: pa.Schema) -> list[pa.Array]:
    kept, removed, n_removed = [], [], np.add.reduceat(np.append(gone, False), np.minimum(words.first[:-1], len(gone)))
    n_removed = np.where(words.counts > 0, n_removed, 0)
    for r, value in enumerate(column):
        parts = (value.as_py() or "").encode().split()
        if n_removed[r]:
            mask = gone[words.first[r] : words.first[r + 1]]
            parts = compress(parts, ~mask)
            edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
            removed.append([{"start": int(s), "end": int(e)} for s, e in zip(edges[::2], edges[1::2])])
        else:
            removed.append([])
        kept.append(b" ".join(parts).decode())
    return [rows.cast(out.field("row").type), pa.array(words.counts, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string()), pa.array(removed, out.field("removed").type)]


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_windows(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        select=[F.col("row.doc_id").alias("doc_id"), F.col("n_words"), F.col("n_removed"), F.sha2("kept", 256).alias("kept_sha256")],
    )

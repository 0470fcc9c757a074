"""Best-fit packing of token pieces into sequences, by bin completion.

Only the number of pieces of each size goes to the driver (as many counts as a sequence has tokens). Bin completion plans on them:
around the largest piece left, undominated fillings of any number of pieces are enumerated and used as often as their sizes last, or
less often; branches that can't take fewer bins than the best plan so far are cut, and the best-fit plan is the first of these. Pieces then take their places by their rank
among pieces of equal size, which is a distributed prefix sum.
"""

from __future__ import annotations

import base64
import json
import zlib
from bisect import bisect_right
from collections import Counter, deque
from collections.abc import Iterator
from functools import cache
from hashlib import blake2b
from itertools import islice
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import text as tx
from .common import save, ship, table

CAPACITY, END = 2048, 0
#: Where the search for a better plan ends: branches taken, steps of the enumeration of fillings.
NODES, STEPS = 20_000, 200_000


@cache
def encoder(vocabulary: str):
    """Byte-level BPE from a rank file, built once per process: the ids of the tokenizers file of the same vocabulary, several times faster.

    encode(text, allowed_special="all") finds the added tokens inside texts, too, as tokenizers does; encode_ordinary does not.
    """
    import public_tokenizers
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added_tokens(vocabulary))


def added_tokens(vocabulary: str) -> dict[str, int]:
    """Ids of the added tokens that the tokenizers file beside a rank file has; none without such a file."""
    file = Path(vocabulary).with_suffix(".json")
    return {t["content"]: t["id"] for t in json.loads(file.read_text("utf-8"))["added_tokens"]} if file.exists() else {}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n tokens: full ones but for the first."""
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, keep_ids: bool = False) -> DataFrame:
    """Saved (doc_id, piece, start, length, ids_crc32, part, place[, ids]): place is the rank among pieces of this length of the partition `part`."""
    ship(docs.sparkSession)
    vocabulary = vocabulary or default_vocabulary()

    def tokenize(batches):
        encode, part, seen = encoder(vocabulary).encode, TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for some in tx.slices(batch, "text", 4 << 20):
                out: list[tuple] = []
                for doc_id, text in zip(some.column("doc_id").to_pylist(), some.column("text").to_pylist()):
                    ids = np.array([*encode(text or "", allowed_special="all"), END], "<u4")
                    for k, (start, length) in enumerate(cut(len(ids), capacity)):
                        own = ids[start : start + length]
                        out.append((doc_id, k, start, length, zlib.crc32(own.tobytes()), part, int(seen[length]), own.tobytes()))
                        seen[length] += 1
                columns = [pa.array(c, t) for c, t in zip(zip(*out), (id_type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()))]
                yield pa.RecordBatch.from_arrays(columns if keep_ids else columns[:-1], names=names)

    id_type = pa.int64()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "place", "ids"][: 7 + keep_ids]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long" + ", ids binary" * keep_ids
    return save(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tokenize, schema), "pieces")


def best_fit(gap: int, counts: np.ndarray, sizes: np.ndarray) -> tuple[int, ...]:
    """The largest size that fits, again and again."""
    out, left = [], Counter()
    for s in sizes:
        while s <= gap and counts[s] > left[s]:
            out.append(int(s))
            left[s] += 1
            gap -= s
    return tuple(out)


def _spread(bits: int, width: int) -> int:
    """The bits and those up to `width` places above each."""
    done = 0
    while done < width:
        step = min(done + 1, width - done)
        bits |= bits << step
        done += step
    return bits


def fillings(gap: int, counts: np.ndarray, spent: list[int] | None = None) -> Iterator[tuple[int, ...]]:
    """All undominated multisets of sizes that fit a gap, least waste first, then those with larger sizes first.

    A filling is dominated if a piece left can take the place of none, one or several of its pieces without being smaller than
    them together: what it gives free fits where that piece was. Partial sums lead only to sums that can be reached, and a part whose
    rest a single piece fills as well or better is not taken further. spent[0] counts the steps of the search.
    """
    spent = [0] if spent is None else spent
    sizes = [int(v) for v in np.flatnonzero(counts[: gap + 1]) if v]
    have = {v: min(int(counts[v]), gap // v + 1) for v in sizes}
    every, within = sum(1 << v for v in sizes), (1 << (gap + 1)) - 1
    reach = [1]  # sums of the first i sizes
    for v in sizes:
        sums, left, k = reach[-1], have[v], 1
        while left:
            k = min(k, left)
            sums |= (sums << (k * v)) & within
            left, k = left - k, 2 * k
        reach.append(sums)

    def undominated(own: tuple[int, ...], waste: int) -> bool:
        left, one, more = every, 0, 0
        for v, k in Counter(own).items():
            if k >= have[v]:
                left &= ~(1 << v)
        for v in own:
            more |= (one | more) << v
            one |= 1 << v
        return not (_spread(1 | more, waste) & left or waste and _spread(one << 1, waste - 1) & left)

    def extend(rest: int, top: int, own: tuple[int, ...], left: int, waste: int):
        """Fillings of exactly `rest` by sizes[:top] after `own`; `left` has the sizes of which pieces are left."""
        spent[0] += 1
        if not rest:
            if undominated(own, waste):
                yield own
            return
        better = left >> rest & ((2 << waste) - 1)
        if better > 1:
            return
        if better:
            if sizes[top - 1] >= rest and undominated((*own, rest), waste):
                yield (*own, rest)
            return
        for i in range(bisect_right(sizes, rest, 0, top) - 1, -1, -1):
            v, k = sizes[i], own.count(sizes[i])
            if not reach[i + 1] >> rest & 1:
                return
            if k < have[v] and reach[i + 1] >> (rest - v) & 1:
                yield from extend(rest - v, i + 1, (*own, v), left & ~(1 << v) if k + 1 == have[v] else left, waste)

    most = min((v for v in sizes if have[v] > gap // v), default=gap + 1) - 1  # a size that no filling uses up fits into more waste
    for waste in range(min(most, gap) + 1):
        if reach[-1] >> (gap - waste) & 1:
            yield from extend(gap - waste, len(sizes), (), every, waste)


def bins(plan: list[tuple[tuple[int, ...], int]]) -> int:
    return sum(times for _, times in plan)


def best_fit_plan(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    counts, out = counts.copy(), []
    while counts.any():
        top = int(np.flatnonzero(counts)[-1])
        counts[top] -= 1
        rest = best_fit(capacity - top, counts, np.flatnonzero(counts[: capacity - top + 1])[::-1])
        counts[top] += 1
        out.append(((top, *rest), _use(counts, (top, *rest))))
    return out


def _use(counts: np.ndarray, pattern: tuple[int, ...]) -> int:
    """Takes a pattern as often as its sizes last."""
    need = Counter(pattern)
    times = min(int(counts[s]) // k for s, k in need.items())
    for s, k in need.items():
        counts[s] -= times * k
    return times


def least_bins(counts: np.ndarray, capacity: int) -> int:
    """A lower bound: pieces over half a bin lie apart, and those of at least a size share what these leave (Martello and Toth)."""
    size = np.arange(len(counts))
    n, total = np.concatenate([[0], np.cumsum(counts)]), np.concatenate([[0], np.cumsum(counts * size)])
    half = capacity // 2
    low = np.arange(half + 1)
    apart = n[-1] - n[half + 1]
    sharing, their = n[capacity - low + 1] - n[half + 1], total[capacity - low + 1] - total[half + 1]
    small = total[half + 1] - total[low]
    return int((apart + np.maximum(0, -(-(small - (sharing * capacity - their)) // capacity))).max())


def plan_bins(counts: np.ndarray, capacity: int = CAPACITY, nodes: int = NODES, steps: int = STEPS) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of sizes and how often to use each, for counts[size] pieces.

    A branch takes an undominated filling around the largest piece left, as often as it lasts or, later, less often. The search ends
    at the lower bound, when no branch is left (the plan then has the fewest bins), or after `nodes` branches or `steps` of enumeration.
    """
    best = best_fit_plan(counts, capacity)
    best_bins, lower, spent, seen = bins(best), least_bins(counts, capacity), [0], {}

    def open_branch(left: np.ndarray, plan, used: int):
        """Counts left, plan so far (a linked list), its bins, fillings to try with how often, how many were listed, whether all."""
        return [left, plan, used, deque(), 0, False]

    def list_more(branch: list) -> None:
        """Lists as many fillings again as there were; enumerating anew takes less memory than what a paused search holds."""
        left, given = branch[0].copy(), branch[4]
        top = int(np.flatnonzero(left)[-1])
        left[top] -= 1
        new = []
        for f in islice(fillings(capacity - top, left, spent), given, 2 * given + 2):
            new.append((top, *f))
            if spent[0] > steps:
                break
        branch[4], branch[5] = given + len(new), len(new) < given + 2
        branch[3].extend((f, min(int(branch[0][v]) // k for v, k in Counter(f).items())) for f in new)

    stack = [open_branch(counts.copy(), None, 0)]
    while stack and nodes and spent[0] <= steps and best_bins > lower:
        branch = stack[-1]
        left, plan, used, todo = branch[:4]
        if not left.any():
            stack.pop()
            if used < best_bins:
                best, best_bins = [], used
                while plan:
                    own, plan = plan
                    best.append(own)
            continue
        if not branch[4]:
            state = left.tobytes()
            if used + least_bins(left, capacity) >= best_bins or seen.get(key := blake2b(state, digest_size=16).digest(), best_bins) <= used:
                stack.pop()
                continue
            seen[key] = used
        if not branch[5] and (not branch[4] or len(todo) < 2):
            list_more(branch)
        if not todo or used + least_bins(left, capacity) >= best_bins:
            stack.pop()
            continue
        pattern, times = todo.popleft()
        if times > 1:
            todo.append((pattern, times - 1))
        nodes -= 1
        rest = left.copy()
        for v, k in Counter(pattern).items():
            rest[v] -= times * k
        stack.append(open_branch(rest, ((pattern, times), plan), used + times))
    return best


class Places:
    """Where the piece of a given length and rank goes."""

    def __init__(self, plan: list[tuple[tuple[int, ...], int]], capacity: int):
        rows, first, used = [], 0, Counter()
        for pattern, times in plan:
            at = 0
            for size, k in Counter(pattern).items():
                rows.append((size, used[size], k, at, first))
                used[size] += k * times
                at += size * k
            first += times
        rows.sort()
        self.size, self.rank, self.k, self.offset, self.first = (np.array(c, np.int64) for c in zip(*rows)) if rows else [np.zeros(0, np.int64)] * 5
        self.bits = max(1, int(self.rank.max(initial=0)).bit_length() + 1)

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence_id, offset)"""
        i = np.searchsorted((self.size << self.bits) + self.rank, (length << self.bits) + np.minimum(rank, (1 << self.bits) - 1), "right") - 1
        inside = rank - self.rank[i]
        return self.first[i] + inside // self.k[i], self.offset[i] + inside % self.k[i] * length


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, keep_ids: bool = False) -> DataFrame:
    """Packs the documents (doc_id, text) into sequences of at most `capacity` tokens.

    A document is its BPE ids and then id 0; only longer ones than `capacity` are cut, the first piece being the shorter. Returns per
    piece doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids, unsigned 32-bit, with keep_ids). Null and empty
    texts are one token. Repeated rows are packed each by itself; a null doc_id stays null. Extra columns are ignored. An empty table gives an empty result.
    """
    found = pieces(docs, capacity, vocabulary, keep_ids)
    per_part = save(found.groupBy("length", "part").agg(F.count("*").alias("n")), "sizes")
    counts = np.zeros(capacity + 1, np.int64)
    for row in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[row.length] = row.n
    places = Places(plan_bins(counts, capacity), capacity)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = found.join(starts, ["length", "part"]).withColumn("rank", F.col("before") + F.col("place"))

    def place(batches):
        for batch in batches:
            sequence, offset = places.of(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            kept = batch.select(names)
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], names=[*names, "sequence_id", "offset"])

    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids + ", sequence_id long, offset long"
    return ranked.select(*names, "rank").mapInArrow(place, schema)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))

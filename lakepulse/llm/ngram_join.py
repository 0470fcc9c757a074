"""Jaccard self-join of documents on word n-grams, by prefixes of token combinations.

Tokens (n-gram hashes) are ordered rare class first, then by hash. A prefix is long enough that a linked partner must share with
it one rare token, or two frequent tokens of one sub-class; rare tokens are indexed alone and frequent ones in pairs. Candidates
are verified on whole sets. Equal sets are one class. Signatures that the same documents share are one group. A group's members
meet in blocks, which compare sketches, then whole sets, and return only links that join two components: fewer than they have
members. Every pair that no link has put into one component is compared, so no link that matters for a component is lost.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import text as tx
from .blocks import SENT, bucket_of, buckets_for, to_batch
from .common import discard, n_partitions, save, ship, table

U = np.uint64
#: Document frequencies are counted in a table of fixed size, by the first bits of a token's hash.
CELL_BITS, SLICE_BITS, TOKEN_BITS = 24, 16, 48
#: Rows to a chunk: their number must fit above a token and its class.
CHUNK_ROWS, CHUNK_BYTES = 1 << 14, 4 << 20
#: Sets smaller than this index every token alone.
PAIRS_FROM = 8
#: So many ids (16 bytes each) are broadcast at the most.
BROADCAST_IDS = 400_000
SKETCH_BITS = 1024
#: Members of one group, and tokens of their sets, that a block has of each side.
BLOCK_ROWS, BLOCK_TOKENS = 1024, 1 << 19
#: Members of a group of several blocks that each of these blocks has.
LEADERS = 32


def _chunks(batches):
    for batch in batches:
        for part in tx.slices(batch, "text", CHUNK_BYTES):
            for at in range(0, part.num_rows, CHUNK_ROWS):
                yield part.slice(at, CHUNK_ROWS)


class Sets:
    """Distinct tokens of each row, ordered by row, then by class if `frequent` says so, then by hash."""

    def __init__(self, texts: pa.Array, n: int, lower: bool, frequent: np.ndarray | None = None):
        words = tx.split(texts, lower)
        row, token = tx.shingles(words, tx.hashes(words, 7), n, 8)
        token = token >> U(64 - TOKEN_BITS)
        kind = np.zeros(len(token), U) if frequent is None else frequent[token >> U(TOKEN_BITS - CELL_BITS)].astype(U)
        key = np.unique((row.astype(U) << U(TOKEN_BITS + 1)) | (kind << U(TOKEN_BITS)) | token)
        self.row = (key >> U(TOKEN_BITS + 1)).astype(np.int64)
        self.frequent = (key >> U(TOKEN_BITS)) & U(1) > 0
        self.token = key & U((1 << TOKEN_BITS) - 1)
        self.count = np.bincount(self.row, minlength=len(texts))
        self.first = np.concatenate([[0], np.cumsum(self.count)])

    def digests(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits for each row's set, whatever its order."""
        out = []
        for seed in (21, 22):
            total = np.concatenate([[U(0)], np.cumsum(tx.mix(self.token, seed), dtype=U)])
            out.append((total[self.first[1:]] - total[self.first[:-1]]).view(np.int64))
        return out[0], out[1]


def _packed(token: np.ndarray) -> bytes:
    return np.ascontiguousarray(token.view(np.uint8).reshape(-1, 8)[:, : TOKEN_BITS // 8]).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) * 8 // TOKEN_BITS, 8), np.uint8)
    out[:, : TOKEN_BITS // 8] = np.frombuffer(data, np.uint8).reshape(-1, TOKEN_BITS // 8)
    return out.view(U).ravel()


def _pairs(tokens: np.ndarray, need: int, level: int) -> np.ndarray:
    """Signatures of pairs of frequent tokens (in hash order), of which `need` can be missing from a partner."""
    groups = max(1, (1 << level) // 32)
    sub = (tokens % U(groups)).astype(np.int64)
    seen = np.zeros(len(sub), bool)
    seen[np.unique(sub, return_index=True)[1]] = True
    cut = int(np.searchsorted(np.cumsum(~seen), need)) + 1
    order = np.argsort(sub[:cut], kind="stable")
    tokens, sub = tokens[:cut][order], sub[:cut][order]
    edges = np.flatnonzero(np.diff(np.concatenate([[-1], sub, [groups]])))
    out = []
    for s, e in zip(edges[:-1], edges[1:]):
        i, j = np.triu_indices(e - s, 1)
        out.append(tx.mix(tokens[s:e][i] * tx.WORD_BASE + tokens[s:e][j], 12 + level))
    return np.concatenate(out) if out else np.zeros(0, U)


def signatures(sets: Sets, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, signature) such that rows that link share one at least."""
    n = sets.count
    need = np.where(n > 0, n - -(-percent * n // 100) + 1, 0)  # a partner lacks fewer tokens than this
    place = np.arange(len(sets.row)) - sets.first[sets.row]
    alone = (place < need[sets.row]) & ~sets.frequent
    rows, found = [sets.row[alone]], [tx.mix(sets.token[alone], 11)]
    rare = np.bincount(sets.row[~sets.frequent], minlength=len(n))
    for r in np.flatnonzero(rare < need):
        first, end = sets.first[r] + rare[r], sets.first[r + 1]
        top = int(n[r]).bit_length() - 1
        for level in {top, max(0, top - 1)} if percent * n[r] < 100 << top else {top}:
            if 1 << level < PAIRS_FROM:
                more = tx.mix(sets.token[first : min(end, sets.first[r] + need[r])], 11)
            else:
                more = _pairs(sets.token[first:end], int(need[r] - rare[r]), level)
            rows.append(np.full(len(more), r))
            found.append(more)
    return np.concatenate(rows), np.concatenate(found)


def _census(docs: DataFrame, n: int, lower: bool) -> DataFrame:
    """Per document its set's size and digest; per task and slice of cells, how many documents have tokens there."""

    def count(batches):
        cells = np.zeros(1 << CELL_BITS, np.int32)
        for part in _chunks(batches):
            sets = Sets(part.column("text"), n, lower)
            np.add.at(cells, (sets.token >> U(TOKEN_BITS - CELL_BITS)).astype(np.int64), 1)
            a, b = sets.digests()
            none = pa.nulls(part.num_rows, pa.int32())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sets.count, pa.int64()), pa.array(a), pa.array(b), none, pa.nulls(part.num_rows, pa.binary())], names=names)
        for s, part in enumerate(cells.reshape(-1, 1 << SLICE_BITS)):
            if part.any():
                none = pa.nulls(1, pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array([s], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)])], names=names)

    names = ["doc_id", "n", "a", "b", "slice", "cells"]
    return save(docs.mapInArrow(count, "doc_id long, n long, a long, b long, slice int, cells binary"), "census")


def _frequent(census: DataFrame, least: float) -> np.ndarray:
    """Which cells hold tokens of more than `least` documents: a table of 2^24 flags, whatever the input's size."""

    def add(part: pa.Table) -> pa.Table:
        total = np.zeros(1 << SLICE_BITS, np.int64)
        for chunk in part.column("cells"):
            total += np.frombuffer(zlib.decompress(chunk.as_py()), np.int32)
        return pa.table({"slice": part.column("slice")[:1], "flags": pa.array([np.packbits(total > least).tobytes()])})

    flags = np.zeros((1 << CELL_BITS - SLICE_BITS, 1 << SLICE_BITS), bool)
    of_slices = census.where("slice is not null").select("slice", "cells").groupBy("slice").applyInArrow(add, "slice int, flags binary")
    for row in of_slices.collect():
        flags[row.slice] = np.unpackbits(np.frombuffer(row.flags, np.uint8)).astype(bool)
    return np.packbits(flags.ravel())


ENTRY = np.dtype([("sig", "<u8"), ("doc", "<i8"), ("set", "<u8"), ("n", "<i8")])


def _bounds(*keys: np.ndarray) -> np.ndarray:
    """Where a new value begins in sorted keys, and the end."""
    n = len(keys[0])
    new = np.ones(n, bool)
    if n:
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.append(np.flatnonzero(new), n)


def _groups(docs: DataFrame, n: int, lower: bool, percent: int, frequent: np.ndarray, n_buckets: int) -> DataFrame:
    """Groups of different sets that share a signature and are of similar size: (first, second, doc_id, n).

    A group has the name of its two leaders, the members of least hash. Signatures that the same documents share, as near copies do,
    are thus one group, and what several groups of the same leaders hold is one group, too. Of equal sets the least doc_id stands for all.
    """

    def sign(batches):
        flags, chunk = np.unpackbits(frequent).astype(bool), TaskContext.get().partitionId() << 32
        for part in _chunks(batches):
            chunk += 1
            sets = Sets(part.column("text"), n, lower, flags)
            doc = part.column("doc_id").to_numpy(zero_copy_only=False)
            a, _ = sets.digests()
            keep = np.zeros(len(doc), bool)
            order = np.lexsort((doc, a))
            keep[order[np.concatenate([[True], a[order][1:] != a[order][:-1]])]] = True  # of equal sets in a chunk the first
            row, sig = signatures(sets, percent)
            row, sig = row[keep[row]], sig[keep[row]]
            entries = np.empty(len(sig), ENTRY)
            entries["sig"], entries["doc"], entries["set"], entries["n"] = sig, doc[row], a.view(U)[row], sets.count[row]
            bucket = bucket_of(sig, n_buckets)
            order = np.argsort(bucket, kind="stable")
            edges = _bounds(bucket[order])
            yield to_batch([(int(bucket[order[s]]), chunk, entries[order[s:e]].tobytes()) for s, e in zip(edges[:-1], edges[1:])])

    def meet(part: pa.Table) -> pa.Table:
        e = np.concatenate([np.frombuffer(x.as_py(), ENTRY) for x in part.column("data")])
        e = e[np.argsort(e["sig"], kind="stable")]
        edges = _bounds(e["sig"])
        e = e[np.repeat(np.diff(edges) > 1, np.diff(edges))]
        e = e[np.lexsort((e["doc"], e["set"], e["sig"]))]
        e = e[_bounds(e["sig"], e["set"])[:-1]]
        e = e[np.lexsort((e["n"], e["sig"]))]
        # Where sizes leap too far, no set before the leap can link with one after it: a signature falls into runs.
        apart = np.ones(len(e), bool)
        apart[1:] = (e["sig"][1:] != e["sig"][:-1]) | (100 * e["n"][:-1] < percent * e["n"][1:])
        run = np.cumsum(apart)
        e, run = (x[np.lexsort((tx.mix(e["doc"].view(U), 31), run))] for x in (e, run))
        edges = _bounds(run)
        size = np.diff(edges)
        first = np.repeat(edges[:-1], size)
        several = np.repeat(size > 1, size)
        second = np.minimum(first + 1, max(0, len(e) - 1))
        out = np.stack([e["doc"][first], e["doc"][second], e["doc"], e["n"]], axis=1)[several] if len(e) else np.zeros((0, 4), np.int64)
        out = np.unique(out, axis=0)
        return pa.table({c: pa.array(out[:, k], pa.int64()) for k, c in enumerate(("first", "second", "doc_id", "n"))})

    met = docs.mapInArrow(sign, SENT).groupBy("bucket").applyInArrow(meet, "first long, second long, doc_id long, n long")
    return save(met.distinct(), "groups")


def sketch(token: np.ndarray) -> np.ndarray:
    """A bit for each cell of tokens: whether their number is odd. Two sets differ in as many tokens at least as their sketches do in
    bits. There are as many cells as tokens or more, up to the next power of two, in rows of SKETCH_BITS."""
    bits = max(SKETCH_BITS, 1 << max(0, len(token) - 1).bit_length())
    odd = np.bincount((tx.mix(token, 50) & U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8))


def fold(sketch_: np.ndarray, rows: int) -> np.ndarray:
    """A sketch of fewer rows: cells that coincide in it are added up."""
    return np.bitwise_xor.reduce(sketch_.reshape(-1, rows, SKETCH_BITS // 64), axis=0)


def _sets(docs: DataFrame, n: int, lower: bool) -> DataFrame:
    """(doc_id, n, tokens, sketch): the whole set of each document."""

    def take(batches):
        for chunk in _chunks(batches):
            sets = Sets(chunk.column("text"), n, lower)
            of_rows = [sets.token[s:e] for s, e in zip(sets.first[:-1], sets.first[1:])]
            columns = [chunk.column("doc_id"), pa.array(sets.count, pa.int64()), pa.array([_packed(t) for t in of_rows], pa.binary()), pa.array([sketch(t).tobytes() for t in of_rows], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "tokens", "sketch"])

    return docs.mapInArrow(take, "doc_id long, n long, tokens binary, sketch binary")


def _only(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """rows of these doc_ids: by broadcast while there are few, else by a shuffle."""
    few = ids.count() <= BROADCAST_IDS
    return rows.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")


def least_common(nx, ny, percent: int):
    """How many tokens linked sets of these sizes have in common at least."""
    return -(-percent * (nx + ny) // (100 + percent))


class _Block:
    """The members of some blocks, ordered by block: arrays over members, and pairs to compare."""

    def __init__(self, table_: pa.Table, percent: int):
        get = lambda c: table_.column(c).to_numpy()
        order = np.lexsort((get("doc_id"), get("block")))
        self.percent = percent
        self.block, self.doc, self.n, self.component, self.query = (get(c)[order] for c in ("block", "doc_id", "n", "component", "query"))
        self.order = order
        sketches = table_.column("sketch").to_pylist()
        self.rows = np.array([len(x) for x in sketches], np.int64)[order] * 8 // SKETCH_BITS
        #: By number of rows: the place of each member, and sketches of the members that have so many or more, folded to that.
        self.folded = {}
        for rows in np.unique(self.rows).tolist():
            some = np.flatnonzero(self.rows >= rows)
            place = np.full(len(order), -1)
            place[some] = np.arange(len(some))
            self.folded[rows] = place, np.stack([fold(np.frombuffer(sketches[order[i]], U), rows).ravel() for i in some])

    def likely(self, x: np.ndarray, y: np.ndarray, component: np.ndarray) -> np.ndarray:
        """Which pairs (x, y) are in different components, have a query, and aren't ruled out by sizes and sketches."""
        can = (component[x] != component[y]) & (self.query[x] | self.query[y])
        nx, ny = self.n[x], self.n[y]
        can &= 100 * np.minimum(nx, ny) >= self.percent * np.maximum(nx, ny)
        rows = np.minimum(self.rows[x], self.rows[y])
        for r in np.unique(rows[can]).tolist():
            at = np.flatnonzero(can & (rows == r))
            place, bits = self.folded[r]
            differ = np.bitwise_count(bits[place[x[at]]] ^ bits[place[y[at]]]).sum(axis=1)
            can[at] = differ <= nx[at] + ny[at] - 2 * least_common(nx[at], ny[at], self.percent)
        return can

    def clusters(self) -> np.ndarray:
        """Members connected by likely pairs have one number, the place of one of them. A pair that is connected already need not be looked at."""
        label, x = np.arange(len(self.doc)), np.arange(len(self.doc))

        def root(i: int) -> int:
            while label[i] != i:
                i = label[i]
            return i

        for step in range(1, len(x)):  # each member with the one `step` after it, in all blocks at once
            x = x[x + step < len(self.doc)]
            x = x[self.block[x] == self.block[x + step]]
            if not len(x):
                break
            own = x[label[x] != label[x + step]]
            own = own[self.likely(own, own + step, self.component)]
            for i in own:
                label[root(i + step)] = root(i)
            while len(own) and (label[label] != label).any():
                label = label[label]
        return label

    def links(self, tokens: list[bytes]) -> list[tuple[int, int]]:
        """Verified links of whole sets, each of which joins two components that nothing before it joined: fewer than there are members."""
        out, edges = [], _bounds(self.block)
        for s, e in zip(edges[:-1], edges[1:]):
            bits, label, x = None, self.component.copy(), np.arange(s, e)
            for step in range(1, e - s):
                x = x[: e - s - step]
                own = x[self.likely(x, x + step, label)]
                if not len(own):
                    continue
                if bits is None:
                    bits = _shared_bits([_unpacked(tokens[self.order[i]]) for i in range(s, e)])
                for part in np.array_split(own, -(-len(own) // 256)):
                    common = np.bitwise_count(bits[part - s] & bits[part + step - s]).sum(axis=1)
                    for i in part[common >= least_common(self.n[part], self.n[part + step], self.percent)]:
                        a, b = label[i], label[i + step]
                        if a != b:
                            label[s:e][label[s:e] == b] = a
                            out.append((int(self.doc[i]), int(self.doc[i + step])))
        return out


def _shared_bits(sets: list[np.ndarray]) -> np.ndarray:
    """A row of bits for each set: which of the tokens that several of the sets have it has."""
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, of, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = np.cumsum(times > 1) - 1
    shared = times[of] > 1
    row, column = row[shared], column[of[shared]]
    bits = np.zeros((len(sets), int(column.max(initial=0)) // 64 + 1), U)
    np.bitwise_or.at(bits, (row, column // 64), U(1) << (column % 64).astype(U))
    return bits


def _shapes(groups: DataFrame) -> DataFrame:
    """Per group (first, second) of several components: members m, tokens t, and its largest component with its members and tokens."""
    of_component = groups.groupBy("first", "second", "component").agg(F.count("*").alias("m"), F.sum("n").alias("t"))
    main = F.max(F.struct("m", "t", "component"))
    return of_component.groupBy("first", "second").agg(F.count("*").alias("components"), F.sum("m").alias("m"), F.sum("t").alias("t"), main.alias("main")).where("components > 1")


def _parts(m: Column, t: Column) -> Column:
    """In how many parts of bounded rows and tokens so many members with so many tokens are cut."""
    return F.ceil(F.greatest(m / BLOCK_ROWS, t / BLOCK_TOKENS)).cast("int")


def _with_leaders(groups: DataFrame) -> DataFrame:
    """Blocks (block, doc_id, n, component, query) that each have one part of a group and its leaders, about LEADERS members chosen by a hash
    of their ids. Their rows grow with the members; a group of one part is a block of its own, in which all pairs meet."""
    shape = _shapes(groups).select("first", "second", "m", _parts(F.col("m"), F.col("t")).alias("parts"))
    rows = groups.join(shape, ["first", "second"]).withColumn("p", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int"))
    leads = (F.col("parts") > 1) & (F.pmod(F.xxhash64("doc_id", F.lit(2)), F.col("m")) < LEADERS)
    elsewhere = rows.where(leads).withColumn("to", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).where("to <> p").withColumn("p", F.col("to"))
    columns = [F.xxhash64("first", "second", "p").alias("block"), "doc_id", "n", "component", F.lit(True).alias("query")]
    return rows.select(columns).union(elsewhere.select(columns))


def _all_pairs(groups: DataFrame) -> DataFrame:
    """Blocks (block, doc_id, n, component, query) in which all members that aren't of their group's largest component meet all others.

    They are the queries: a pair without a query is in one component. Queries and members are cut into parts, each two of which meet
    in a block of its own.
    """
    m, t = F.col("m"), F.col("t")
    shape = _shapes(groups).select("first", "second", F.col("main.component").alias("main"), _parts(m, t).alias("parts"), _parts(m - F.col("main.m"), t - F.col("main.t")).alias("queries"))
    rows = groups.join(shape, ["first", "second"])
    rows = rows.withColumn("query", F.col("component") != F.col("main")).withColumn("whole", (F.col("parts") == 1) & (F.col("queries") == 1))
    part, asked = F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int"), F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("queries")).cast("int")
    members = rows.withColumn("p", part).withColumn("q", F.explode(F.sequence(F.lit(0), F.col("queries") - 1))).withColumn("query", F.col("query") & F.col("whole"))
    asking = rows.where("query and not whole").withColumn("q", asked).withColumn("p", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    columns = [F.xxhash64("first", "second", "p", "q").alias("block"), "doc_id", "n", "component", "query"]
    return members.select(columns).union(asking.select(columns))


def _compare(blocks: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b), verified on whole sets, that join components of all linked members of a block: (block, doc_id, n, component, query).

    A block first finds by sketches which members can link at all; the sets of each cluster of these then meet, and give links that
    join components.
    """
    spark = blocks.sparkSession
    blocks = save(blocks, "blocks")

    def meeting(rows: DataFrame, a_bucket: int, weight: str):
        total = rows.agg(F.coalesce(F.sum(F.expr(weight)), F.lit(0))).first()[0]
        return F.pmod("block", F.lit(max(n_partitions(spark), total // a_bucket))).alias("bucket")

    def find(table_: pa.Table) -> pa.Table:
        b = _Block(table_, percent)
        label = b.clusters()
        known = np.bincount(label, minlength=len(label))[label] > 1
        # A cluster has the name of its members: what several blocks find is verified once.
        name = np.zeros(len(label), U)
        np.add.at(name, label, tx.mix(b.doc.view(U) + tx.mix(b.n.view(U), 35), 36))
        columns = (("block", name[label].view(np.int64)), ("doc_id", b.doc), ("n", b.n), ("component", b.component), ("query", b.query))
        return pa.table({c: pa.array(x[known]) for c, x in columns})

    def verify(table_: pa.Table) -> pa.Table:
        links = _Block(table_, percent).links(table_.column("tokens").to_pylist())
        return pa.table({c: pa.array([pair[k] for pair in links], pa.int64()) for k, c in enumerate(("a", "b"))})

    at = meeting(blocks, 4 * BLOCK_ROWS * 16, "1")
    sketched = blocks.join(sets.select("doc_id", "n", "sketch"), ["doc_id", "n"]).select("*", at)
    likely = sketched.groupBy("bucket").applyInArrow(find, "block long, doc_id long, n long, component long, query boolean")
    likely = save(likely.groupBy("block", "doc_id", "n", "component").agg(F.max("query").alias("query")), "likely")
    discard(blocks)
    at = meeting(likely, 4 * BLOCK_TOKENS, "n")
    whole = likely.join(sets, ["doc_id", "n"]).select("*", at)
    links = save(whole.groupBy("bucket").applyInArrow(verify, "a long, b long").distinct(), "links")
    discard(likely)
    return links


def components(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """(node, component) of all nodes with an edge; component is the least node reachable. Alternates large and small stars.

    After `rounds` of them a component may still be in several parts: nodes of one part are connected, and the parts' edges connect the rest.
    """
    before, done = None, 0
    edges = save(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    while done != rounds and not edges.isEmpty():
        done += 1
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(least.select("u", F.col("m").alias("v")))
        new = save(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
        after = new.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        discard(edges)
        edges = new
        if after == before:
            break
        before = after
    found = save(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select("v", "v").distinct()), "components")
    discard(edges)
    return found


def link_documents(docs: DataFrame, n: int = 4, percent: int = 85, lower: bool = True, frequent_df: int = 32) -> DataFrame:
    """Links documents (doc_id, text) whose sets of word n-grams have a Jaccard similarity of percent/100 at least.

    Returns per input row doc_id, n_shingles, component_id (the least doc_id reachable by links, itself included). A text with
    fewer than n words has its whole sequence as one n-gram; null and empty texts have none and link with nothing. Rows of equal
    doc_id are one node; a null doc_id links with nothing and its component is null. An empty table gives an empty result. Tokens
    in more than frequent_df documents (counted over all of them, in 2^24 cells; four times the mean cell is added) are the frequent class.
    """
    ship(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    census = _census(docs, n, lower)
    known = census.where("slice is null").select("doc_id", "n", "a", "b")
    total = known.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    frequent = _frequent(census, frequent_df + 4 * total / (1 << CELL_BITS))
    linked = docs.where("doc_id is not null")
    groups = _groups(linked, n, lower, percent, frequent, max(n_partitions(docs.sparkSession), buckets_for(total // 4)))
    known = save(known, "known")
    discard(census)
    return join_groups(docs, known, groups, n, percent, lower)


def join_groups(docs: DataFrame, known: DataFrame, groups: DataFrame, n: int, percent: int, lower: bool) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of known (doc_id, n, a, b): the sizes and digests of the sets of docs.

    groups (first, second, doc_id, n) are named by two leaders; each link between different sets must be within one of them, between
    the least doc_ids of each set. Both tables are saved ones; groups is deleted.
    """
    linked = docs.where("doc_id is not null")
    ids = save(groups.select("doc_id").distinct(), "ids")
    # Rows of one doc_id with different sets are joined by its id.
    different = known.where("doc_id is not null and n > 0").distinct()
    repeated = save(different.groupBy("doc_id").agg(F.count("*").alias("sets")).where("sets > 1").select("doc_id"), "repeated")
    sets = _sets(_only(linked, ids), n, lower)
    rows_of_ids = known.join(ids, "doc_id", "left_semi").count()
    if rows_of_ids > ids.count():
        sets = sets.dropDuplicates(["doc_id", "n", "tokens"])
    sets = save(sets, "sets")

    # First each document in its largest group, in parts with leaders, then whatever is still in several components of a group.
    size = groups.groupBy("first", "second").agg(F.count("*").alias("m"))
    largest = groups.join(size, ["first", "second"]).groupBy("doc_id", "n").agg(F.max(F.struct("m", "first", "second")).alias("g"))
    alone = largest.select("g.first", "g.second", "doc_id", "n", F.col("doc_id").alias("component"))
    links = _compare(_with_leaders(alone), sets, percent)
    found = components(links, rounds=4)
    mixed = groups.join(found.groupBy(F.col("node").alias("doc_id")).agg(F.min("component").alias("component")), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    more = _compare(_all_pairs(mixed), sets, percent)
    discard(groups, ids, sets, links)

    classes = known.where("doc_id is not null and n > 0").groupBy("n", "a", "b").agg(F.min("doc_id").alias("node"), F.count("*").alias("m"))
    same_id = different.join(repeated, "doc_id", "left_semi").join(classes, ["n", "a", "b"]).select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    early = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
    found = components(early.union(more).union(same_id))
    classes = save(classes.join(found, "node", "left").select("n", "a", "b", "m", F.coalesce("component", "node").alias("component_id")), "classes")
    discard(more, repeated, found)

    # A class of a thousandth of all rows or more is broadcast, at most 1,000 of them; the others meet their rows by a shuffle.
    rows = known.count()
    hot = F.broadcast(classes.where(F.col("m") * 1000 >= rows).select("n", "a", "b", "component_id"))
    others = classes.where(F.col("m") * 1000 < rows).select("n", "a", "b", "component_id")
    alone = F.col("doc_id").isNull() | (F.col("n") == 0)
    plain = known.where(alone).withColumn("component_id", F.col("doc_id"))
    own = known.where(~alone)
    out = own.join(hot, ["n", "a", "b"]).union(own.join(hot, ["n", "a", "b"], "left_anti").join(others, ["n", "a", "b"]))
    return out.select("doc_id", "n", "component_id").union(plain.select("doc_id", "n", "component_id")).withColumnRenamed("n", "n_shingles")


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_documents(table(spark, sf_dir, "documents"))

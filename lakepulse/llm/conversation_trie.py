"""The trie of conversations, by collapsing whole sequences: identical conversations are one weighted sequence with the list of its members.

A prefix of a conversation is known by 128 bits: the XOR of a hash of each turn with its place. So prefixes add up over ranges of a
conversation, and no task orders or holds a whole one, nor does any step after the first handle texts. Sequences that are proper
prefixes of others are dropped by an anti-join, which leaves the leaves. What a node sums over its subtree is summed over the weighted
sequences through it instead: nodes whose smallest member is c are a stretch of c's own path, so each node of a subtree is counted
with exactly one of the sequences.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, n_partitions, save, ship, table

#: Ids of one sequence are listed in chunks of 2^12 possible ids.
CHUNK_BITS = 12
#: monotonically_increasing_id has the partition above these bits.
PLACE_BITS = 33
KEY = ["a", "b", "depth"]


def ordered_turns(turns: DataFrame) -> DataFrame:
    """Saves (conv_id, seq, a, b, chars) of turns: seq orders all turns by conversation, then turn (null first), role and text; a and b are a
    hash of role and text, chars is the text's code points. The turns of a conversation may lie in many ranges of seq."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text"))
    rows = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role, text)
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    # Equal rows may fall into different ranges, too: they are interchangeable.
    rows = rows.withColumn("spread", F.monotonically_increasing_id()).repartitionByRange(n_partitions(turns.sparkSession), *order, "spread").sortWithinPartitions(*order)
    hashes = F.xxhash64("role", "text").alias("a"), F.xxhash64("text", F.lit(1), "role").alias("b")
    return save(rows.select("conv_id", F.monotonically_increasing_id().alias("seq"), *hashes, F.length("text").cast("long").alias("chars")), "turns")


def _hashed(place: Column) -> list[Column]:
    return [F.xxhash64(place, "a").alias("ta"), F.xxhash64("b", place).alias("tb")]


def _running(window) -> list[Column]:
    return [F.expr("bit_xor(ta)").over(window).alias("xa"), F.expr("bit_xor(tb)").over(window).alias("xb"), F.sum("chars").over(window).alias("sum")]


def _parts(rows: DataFrame) -> DataFrame:
    """(conv_id, range, first, before): per conversation and range of seq the first seq, and how many turns the ranges before have."""
    parts = rows.groupBy("conv_id", F.shiftright("seq", PLACE_BITS).alias("range")).agg(F.min("seq").alias("first"), F.count("*").alias("n"))
    every = Window.partitionBy("conv_id")
    before = F.coalesce(F.sum("n").over(every.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return parts.select("conv_id", "range", "first", before.alias("before"), F.count("*").over(every).alias("ranges"))


def _placed(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """rows with the place (from 1) in their conversation, and the columns of their part. A (conv_id, range) has no more rows than a range."""
    rows = rows.withColumn("range", F.shiftright("seq", PLACE_BITS))
    return rows.join(parts, ["conv_id", "range"]).withColumn("place", F.col("before") + F.col("seq") - F.col("first") + 1)


def rebuilt(turns: DataFrame, base: Column, head: Column, longest: int) -> tuple[DataFrame, DataFrame]:
    """Conversations of the first `head` turns (at most `longest`) of the conversation base, then their own turns after the first `head`.

    Returns two saved tables. Prefixes: (conv_id, range, depth, a, b, ta, tb, sum, chars) per own turn, with the key of the prefix that ends
    there, the part of the key that is this turn's, and code points up to here and of it. Conversations, a row per range of each:
    (conv_id, range, main, depth, a, b, sum, lead): of the whole rebuilt conversation, and the prefixes (alike) that it has from base;
    main is true in one row of each conversation. A conversation without turns of its own after the first is there all the same.
    """
    rows = ordered_turns(turns)
    parts = _parts(rows).withColumn("base", base)
    of_bases = parts.join(parts.select(F.col("base").alias("conv_id")).distinct(), "conv_id", "left_semi")
    heads = _placed(rows, of_bases).where(F.col("place") <= longest).select("conv_id", "place", *_hashed(F.col("place")), "chars")
    heads = heads.select("*", *_running(Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)))
    lead = F.sort_array(F.collect_list(F.struct(F.col("place").alias("depth"), F.col("xa").alias("a"), F.col("xb").alias("b"), "ta", "tb", "sum", "chars")))
    heads = heads.groupBy(F.col("conv_id").alias("base")).agg(lead.alias("lead"))
    plan = parts.join(heads, "base", "left").drop("base").withColumn("head", head.cast("int"))
    plan = plan.withColumn("lead", F.when(F.col("lead").isNull(), F.expr("slice(lead, 1, 0)")).otherwise(F.expr("slice(lead, 1, head)")))
    plan = plan.withColumn("lead", F.coalesce("lead", F.array().cast(plan.schema["lead"].dataType)))
    plan = save(plan, "plan")
    # What the lead comes to: its last prefix.
    of_lead = lambda c: F.coalesce(F.get("lead", F.size("lead") - 1)[c], F.lit(0)).cast("long")

    own = _placed(rows, plan).where("place > head").withColumn("depth", (F.col("place") - F.col("head") + F.size("lead")).cast("long"))
    within = Window.partitionBy("conv_id", "range").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    own = own.select("conv_id", "range", "ranges", "seq", "depth", "chars", *_hashed(F.col("depth")), *[of_lead(c).alias(f"lead_{c}") for c in ("a", "b", "sum")])
    own = own.select("*", *_running(within))
    own = own.select("conv_id", "range", "ranges", "depth", "ta", "tb", "chars", F.col("xa").bitwiseXOR(F.col("lead_a")).alias("a"), F.col("xb").bitwiseXOR(F.col("lead_b")).alias("b"), (F.col("sum") + F.col("lead_sum")).alias("sum"))
    own = save(own, "own")
    discard(rows)

    totals = [F.expr("bit_xor(ta)").alias("ta"), F.expr("bit_xor(tb)").alias("tb"), F.sum("chars").alias("chars")]
    earlier = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = own.where("ranges > 1").groupBy("conv_id", "range").agg(*totals).select("conv_id", "range", *_running(earlier)).where("sum is not null")
    # Two conversations of a range at most have turns in another: there are fewer such rows than twice the ranges.
    prefixes = own.withColumnRenamed("sum", "part").join(F.broadcast(carried), ["conv_id", "range"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    prefixes = prefixes.select("conv_id", "range", "depth", *[F.col(c).bitwiseXOR(zero(F.col(f"x{c}"))).alias(c) for c in ("a", "b")], "ta", "tb", (F.col("part") + zero(F.col("sum"))).alias("sum"), "chars")

    whole = own.groupBy("conv_id").agg(*totals, F.count("*").alias("n"))
    convs = plan.join(whole, "conv_id", "left").select(
        "conv_id", "range", (F.col("before") == 0).alias("main"), (F.size("lead") + zero(F.col("n"))).cast("long").alias("depth"),
        *[of_lead(c).bitwiseXOR(zero(F.col(f"t{c}"))).alias(c) for c in ("a", "b")], (of_lead("sum") + zero(F.col("chars"))).alias("sum"), "lead",
    )
    return prefixes, save(convs, "conversations")


def sequences(convs: DataFrame) -> DataFrame:
    """(a, b, depth, conv_id, weight, ends_sha256): identical conversations (conv_id, a, b, depth) as one, with the smallest of their ids, their
    number, and the SHA-256 of all their ids in order, joined by commas.

    Ids are listed by chunks of bounded length, and a task hashes the chunks of a sequence as they pass: it never holds a whole list.
    """
    ids = F.sort_array(F.collect_list("conv_id"))
    chunks = convs.groupBy(*KEY, F.shiftright("conv_id", CHUNK_BITS).alias("chunk")).agg(ids.alias("ids"))
    text = F.array_join(F.col("ids").cast("array<string>"), ",")
    chunks = chunks.select(*KEY, "chunk", F.get("ids", F.lit(0)).alias("conv_id"), F.size("ids").cast("long").alias("weight"), text.alias("ids"))
    chunks = chunks.repartition(n_partitions(convs.sparkSession), *KEY).sortWithinPartitions(*KEY, "chunk")
    names = [*KEY, "conv_id", "weight", "ends_sha256"]

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = state = None
        for batch in batches:
            done = []
            for *new, conv_id, weight, ids in zip(*[batch.column(c).to_pylist() for c in (*KEY, "conv_id", "weight", "ids")]):
                if new == key:
                    weight_so_far += weight
                    state.update(b"," + ids.encode())
                    continue
                if key:
                    done.append((*key, least, weight_so_far, state.hexdigest()))
                key, least, weight_so_far, state = new, conv_id, weight, hashlib.sha256(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=names)
        if key:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*key, least, weight_so_far, state.hexdigest())], names=names)

    return chunks.mapInArrow(collapse, "a long, b long, depth long, conv_id long, weight long, ends_sha256 string")


def _through(prefixes: DataFrame, found: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes that each sequence of found (conv_id, further columns) passes, from the root to its end, with those columns."""
    node, columns = [*KEY, "ta", "tb", "sum", "chars"], found.columns
    parts = convs.select("conv_id", "range", "main", "lead").join(found, "conv_id")
    own = prefixes.join(parts.select("range", *columns), ["conv_id", "range"]).select(*columns, *node)
    root = F.struct(*[F.lit(0).cast("long").alias(c) for c in ("depth", "a", "b", "ta", "tb", "sum", "chars")])
    shared = parts.where("main").select(*columns, F.explode(F.concat(F.array(root), "lead")).alias("node"))
    return own.union(shared.select(*columns, *[f"node.{c}" for c in node]))


def prefix_trie(prefixes: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes of the trie of conversations, as rebuilt() gives them.

    Per node: conv_id (the smallest member), depth, parent_conv_id (null at the root), n_convs (members), n_children, n_leaves (nodes
    without children in its subtree, itself included), saved_tokens (over its subtree: members but one, times code points of the last
    text), ends_sha256 (of the ids of members that end here), and a, b: the key of the node.
    """
    found = save(sequences(convs.where("main")), "sequences")
    first = _through(prefixes, found.select("conv_id", F.col("depth").alias("length")), convs)
    first = save(first.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.max("length").alias("length"), F.min("chars").alias("chars")), "nodes")
    inner = first.where("length > depth").select(KEY)
    # Sequences that go on in another one are no leaves.
    leaves = found.join(inner, KEY, "left_anti").withColumn("leaf", F.lit(1)).union(found.join(inner, KEY, "left_semi").withColumn("leaf", F.lit(0)))
    charged = first.groupBy("conv_id").agg(F.sum("chars").alias("charged"))
    totals = convs.where("main").select("conv_id", F.col("sum").alias("total"))
    weighted = save(leaves.join(totals, "conv_id").join(charged, "conv_id", "left").fillna(0, ["charged"]), "weighted")

    through = _through(prefixes, weighted.select("conv_id", "weight", "leaf", "total", "charged"), convs)
    nodes = through.groupBy(*KEY).agg(
        F.min(F.struct("conv_id", (F.col("total") - F.col("charged")).alias("uncharged"))).alias("least"), F.sum("weight").alias("n_convs"), F.sum("leaf").alias("n_leaves"),
        F.sum(F.col("weight") * F.col("total")).alias("total"), F.sum("charged").alias("charged"), F.min(F.col("sum") - F.col("chars")).alias("before"), F.min("ta").alias("ta"), F.min("tb").alias("tb"),
    )
    # Of the nodes below, those of the smallest member are on its path from here on; each other sequence through here has the nodes charged to it.
    saved = F.col("total") - F.col("n_convs") * F.col("before") - (F.col("charged") + F.col("least.uncharged") - F.col("before"))
    up = [F.col("a").bitwiseXOR(F.col("ta")).alias("up_a"), F.col("b").bitwiseXOR(F.col("tb")).alias("up_b"), (F.col("depth") - 1).alias("up_depth")]
    nodes = save(nodes.select(*KEY, "least.conv_id", "n_convs", "n_leaves", saved.alias("saved_tokens"), *up).join(found.select(*KEY, "ends_sha256"), KEY, "left"), "trie")
    discard(first, weighted, found)

    UP = ["up_a", "up_b", "up_depth"]
    children = save(nodes.groupBy(*UP).agg(F.count("*").alias("n_children")), "children")
    parents = nodes.select(*[F.col(k).alias(u) for k, u in zip(KEY, UP)], F.col("conv_id").alias("parent_conv_id")).join(children, UP)
    # A node that has a thousandth of all nodes as children is broadcast: there are at most 1,000 of them.
    n = nodes.count()
    hot, others = F.broadcast(parents.where(F.col("n_children") * 1000 >= n).drop("n_children")), parents.where(F.col("n_children") * 1000 < n).drop("n_children")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"), "a", "b"]
    counted = nodes.join(children.toDF(*KEY, "n_children"), KEY, "left")
    return counted.join(hot, UP).select(columns).union(counted.join(hot, UP, "left_anti").join(others, UP, "left").select(columns))


def conversation_trie(turns: DataFrame, every: int = 100, heads: int = 6) -> DataFrame:
    """The trie of turns (conv_id, turn, role, text; other columns are ignored), each conversation c rebuilt with the first h turns of
    conversation c - c % every in place of its own first h; h is the CRC-32 of the decimal id modulo heads. See prefix_trie for the columns.

    Turns are ordered by turn, null first, then by role and text; equal rows each are a turn. Null roles and texts are empty ones. Turns
    of a null conv_id belong to no conversation. An empty table has no conversation, so not even a root.
    """
    ship(turns.sparkSession)
    base = F.col("conv_id") - F.col("conv_id") % every
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    return prefix_trie(*rebuilt(turns, base, head, heads - 1))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations")).drop("a", "b")

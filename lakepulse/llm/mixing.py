"""Mixes sources to target weights, by hash-random keys, distributed prefix sums and exact budgets."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import save, table, words_of


def cyclic_weights(cycle: tuple[float, ...] = (1, 2, 3)) -> Column:
    """Weights by the sources' place in code point order, null last, repeating."""
    return F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), (F.pmod(F.col("place") - 1, F.lit(len(cycle))) + 1).cast("int"))


def targets(sizes: DataFrame, weight: Column, most: float) -> DataFrame:
    """(source, source_size, target) from (source, source_size), a row per source: shares of the total by weight, at most `most` times a
    source's size; the excess goes to the others by weight until none is above.

    Sources fill up in the order of size over weight, so the full ones are a prefix of that order: source k of it is full if its
    limit is below its share of what the ones before it leave.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    by_fill = Window.orderBy("fill", "place")
    before, after = by_fill.rowsBetween(Window.unboundedPreceding, -1), by_fill.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    rows = sizes.withColumn("place", F.row_number().over(order)).withColumn("weight", weight)
    rows = rows.withColumn("limit", F.lit(float(most)) * F.col("source_size")).withColumn("fill", F.col("limit") / F.col("weight"))
    rows = rows.withColumn("left", F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
    rows = rows.withColumn("level", F.col("left") / F.sum("weight").over(after))
    rows = rows.withColumn("full", F.max(F.struct(F.col("fill") >= F.col("level"), -F.col("fill"), -F.col("place"), F.col("level"))).over(every))
    level = F.when(F.col("full.col1"), F.col("full.level"))
    return rows.select("source", "source_size", F.least("limit", F.coalesce(level * F.col("weight"), F.col("limit"))).alias("target"))


def _keyed(docs: DataFrame, row: Column, seed: int) -> DataFrame:
    return docs.select(row.alias("row"), F.col("source"), words_of().alias("size"), F.xxhash64("text", "doc_id", F.lit(seed)).alias("key"))


def mix(docs: DataFrame, cycle: tuple[float, ...] = (1, 2, 3), most: float = 3.0, seed: int = 42, with_text: bool = False) -> DataFrame:
    """(row, size, source_size, target, taken) for each row of docs (doc_id, text, source, any other columns in the struct row).

    size is the number of words (null text: 0). A source's target is taken in whole epochs over all its documents and, for the rest,
    a prefix of their hash-random order, cut within a document so that exactly floor(target) words are taken: no document is taken
    more often than its source's target is times its size, rounded up. Sources without words take none. Null sources are one source.
    Repeated rows each count; their order among themselves doesn't matter, as they are equal. Reruns give the same rows. row has the
    text only with_text, which no step shuffles but for the rows of the one key range per source in which the cut is.
    """
    narrow = save(_keyed(docs, F.struct(*[c for c in docs.columns if c != "text"]), seed), "sizes")
    # As many key ranges as rows in each: both levels of the prefix sum stay short.
    ranges = max(1, math.isqrt(narrow.count()))
    # The key range is the upper part of a uniform key, so ranges are even whatever the source's size.
    range_ = F.floor((F.shiftrightunsigned("key", 33) * F.lit(ranges)) / F.lit(2**31)).cast("int")
    sums = save(narrow.groupBy("source", range_.alias("range")).agg(F.sum("size").alias("range_size")), "ranges")
    goals = targets(sums.groupBy("source").agg(F.sum("range_size").alias("source_size")), cyclic_weights(cycle), most)
    budget = F.floor("target").cast("long")
    goals = goals.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long"))
    goals = goals.withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("start", F.coalesce(F.sum("range_size").over(before), F.lit(0))).withColumnRenamed("source", "of")
    at_cut = (F.col("start") <= F.col("rest")) & (F.col("rest") < F.col("start") + F.col("range_size"))
    cuts = goals.join(starts, F.col("source").eqNullSafe(F.col("of"))).where(at_cut).select("of", F.col("range").alias("cut"), "start")
    # A row per source: its goal, and the key range of the cut. Spark broadcasts it if it is small.
    plan = save(goals.join(cuts, F.col("source").eqNullSafe(F.col("of")), "left").select(F.col("source").alias("of"), "source_size", "target", "epochs", "rest", "cut", "start"), "plan")
    rows = narrow if not with_text else _keyed(docs, F.struct(*docs.columns), seed)
    rows = rows.withColumn("range", range_).join(plan, F.col("source").eqNullSafe(F.col("of")))
    outside = rows.where("cut is null or range <> cut").withColumn("more", F.when(F.col("range") < F.col("cut"), F.col("size")).otherwise(0))
    inside = Window.partitionBy("source").orderBy("key", "row.doc_id").rowsBetween(Window.unboundedPreceding, -1)
    cut = rows.where("range = cut").withColumn("before", F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    cut = cut.withColumn("more", F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before"))))
    columns = ["row", "size", "source_size", "target", (F.col("epochs") * F.col("size") + F.col("more")).cast("long").alias("taken")]
    return outside.select(columns).union(cut.select(columns))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as rows of docs: each document as often as it is taken whole, and once more if half of it or more is taken besides."""
    found = mix(docs, with_text=True, **options)
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0).cast("int")
    copies = found.where(F.col("taken") > 0).withColumn("copy", F.explode(F.array_repeat(F.lit(0), whole)))
    return copies.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return found.select("row.doc_id", "size", "source_size", "target", "taken")

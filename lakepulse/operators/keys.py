"""Versions, joins of two layers, reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def latest_version(rows: DataFrame, key: list[str], version: list[Column]) -> DataFrame:
    """VERS-1: the row of highest version per key; the order must be total for a stable result."""
    w = Window.partitionBy(*key).orderBy(*version)
    return rows.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def repeats(rows: DataFrame, key: list[str], by: list[str]) -> DataFrame:
    """AGG-3, AGG-4, REC-6: rows, distinct keys and rows more than keys, per group. Keys are counted in two steps, so no group holds all."""
    per_key = rows.groupBy(*by, *[k for k in key if k not in by]).agg(F.count("*").alias("_n"))
    return per_key.groupBy(*by).agg(F.sum("_n").alias("n_rows"), F.count("*").alias("n_keys"), F.sum(F.col("_n") - 1).alias("repeated"), F.count_if(F.col("_n") > 1).alias("keys_repeated"))


def same_keys(left: DataFrame, right: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """JOIN-4, REC-3: only left, only right, both, and of those both have how many differ in each column."""
    x, y = left.withColumn("_l", F.lit(True)).alias("x"), right.withColumn("_r", F.lit(True)).alias("y")
    on = [F.col(f"x.{k}").eqNullSafe(F.col(f"y.{k}")) for k in key]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    both = x.join(y, cond, "full")
    here = F.col("_l").isNotNull() & F.col("_r").isNotNull()
    return both.agg(
        F.count_if(F.col("_r").isNull()).alias("only_left"), F.count_if(F.col("_l").isNull()).alias("only_right"), F.count_if(here).alias("both"),
        *[F.count_if(here & ~F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}"))).alias(f"differ_{c}") for c in columns],
    )


def compare_totals(left: DataFrame, right: DataFrame, key: list[str], measures: list[str], absolute: float = 0.01, relative: float = 0.001) -> DataFrame:
    """JOIN-5, REC-4, REC-5: sums of both sides by key, and how many keys differ by more than both tolerances."""
    sums = lambda d, s: d.groupBy(*key).agg(*[F.sum(m).alias(f"{m}_{s}") for m in measures]).alias(s)
    x, y = sums(left, "x"), sums(right, "y")
    cond = F.lit(True)
    for k in key:
        cond = cond & F.col(f"x.{k}").eqNullSafe(F.col(f"y.{k}"))
    both = x.join(y, cond, "full")
    out = [F.count("*").alias("n_keys")]
    for m in measures:
        a, b = F.coalesce(F.col(f"{m}_x"), F.lit(0)), F.coalesce(F.col(f"{m}_y"), F.lit(0))
        gap = F.abs(a - b)
        out += [F.count_if((gap > absolute) & (gap > relative * F.greatest(F.abs(a), F.abs(b)))).alias(f"problems_{m}"), F.sum(a).cast("long").alias(f"{m}_left"), F.sum(b).cast("long").alias(f"{m}_right")]
    return both.agg(*out)


def shifted_keys(left: DataFrame, right: DataFrame, key: list[str], day: str, most: int = 1) -> DataFrame:
    """JOIN-6, REC-7: keys of left missing on the same day of right, and those missing on the days around it too (lost, not shifted)."""
    near = right.select(*key, F.explode(F.sequence(F.date_sub(day, most), F.date_add(day, most), F.expr("interval 1 day"))).alias(day)).distinct()
    missing = left.select(*key, day).distinct().join(right.select(*key, day).distinct(), [*key, day], "left_anti")
    lost = missing.join(near, [*key, day], "left_anti").withColumn("lost", F.lit(1))
    return missing.join(lost, [*key, day], "left").groupBy(day).agg(F.count("*").alias("missing"), F.count("lost").alias("lost"))


def seen_before(rows: DataFrame, key: list[str], day: str) -> DataFrame:
    """JOIN-7, STRM-3: per day, keys that were also there the day before."""
    keys = rows.select(*key, day).distinct()
    before = keys.withColumn(day, F.date_add(day, 1)).withColumn("again", F.lit(1))
    return keys.join(before, [*key, day], "left").groupBy(day).agg(F.count("*").alias("n_keys"), F.count("again").alias("seen_before"))


def offset_holes(rows: DataFrame, partition: list[str], offset: str, step: int = 1, range_: int = 100_000) -> DataFrame:
    """WIN-5, REC-2, META-6: holes between offsets of a partition, by size class. Offsets fall into ranges of `range_` steps: holes inside a
    range are found there, those between ranges from the first and last offset of each, so no task orders a whole partition."""
    rows = rows.select(*partition, F.col(offset).alias("_o")).withColumn("_range", F.floor(F.col("_o") / (step * range_)))
    gap = lambda a, b: (F.floor((a - b) / step).cast("long") - 1).alias("_hole")
    inside = rows.select(*partition, F.lit(1).alias("_m"), gap(F.col("_o"), F.lag("_o").over(Window.partitionBy(*partition, "_range").orderBy("_o"))))
    ends = rows.groupBy(*partition, "_range").agg(F.min("_o").alias("a"), F.max("_o").alias("b"))
    between = ends.select(*partition, F.lit(0).alias("_m"), gap(F.col("a"), F.lag("b").over(Window.partitionBy(*partition).orderBy("_range"))))
    hole = F.col("_hole")
    return inside.unionByName(between).groupBy(*partition).agg(
        F.sum("_m").alias("messages"), F.count_if(hole > 0).alias("holes"), F.coalesce(F.sum(F.when(hole > 0, hole)), F.lit(0)).alias("missing"),
        F.count_if(hole == 1).alias("of_one"), F.count_if(hole.between(2, 1000)).alias("to_1000"), F.count_if(hole > 1000).alias("over_1000"),
    )


def doubles(rows: DataFrame) -> DataFrame:
    """PROJ-3: decimals as doubles, by name and in place."""
    return rows.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name) for f in rows.schema.fields])


def without_personal(rows: DataFrame, personal: set[str]) -> DataFrame:
    """PROJ-5: columns that a contract calls personal are never selected."""
    return rows.select(*[c for c in rows.columns if c not in personal])


def finite(rows: DataFrame) -> DataFrame:
    """FILT-5: infinite values of fractional columns become null."""
    inf = F.lit(float("inf"))
    return rows.select(*[F.when(F.abs(f.name) != inf, F.col(f.name)).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name) for f in rows.schema.fields])


def file_steps(files: DataFrame) -> DataFrame:
    """META-6: files (name topic+partition+firstOffset, n): distance of a file's first offset from the end of the one before."""
    part = lambda i: F.split_part("name", F.lit("+"), F.lit(i))
    rows = files.withColumn("_first", part(3).cast("long"))
    before = F.lag(F.col("_first") + F.col("n")).over(Window.partitionBy(part(1), part(2)).orderBy("_first"))
    return rows.select("name", "n", (F.col("_first") - before).alias("step"))


def as_of(events: DataFrame, features: DataFrame, key: list[str], at: str, ts: str, ttl_days: int) -> DataFrame:
    """JOIN-11: the newest feature row with at - ttl < ts <= at for each event. One union and one window in place of a theta join."""
    names = [c for c in features.columns if c not in (*key, ts)]
    left = events.select(*key, F.col(at).alias("_t"), F.lit(1).alias("_kind"), F.struct(*events.columns).alias("_event"), F.lit(None).alias("_found"))
    right = features.select(*key, F.col(ts).alias("_t"), F.lit(0).alias("_kind"), F.lit(None).alias("_event"), F.struct(F.col(ts), *names).alias("_found"))
    w = Window.partitionBy(*key).orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    found = left.unionByName(right).withColumn("_found", F.last("_found", ignorenulls=True).over(w)).where("_kind = 1")
    fresh = F.datediff(F.col("_t"), F.col(f"_found.{ts}")) < ttl_days
    return found.select("_event.*", *[F.when(fresh, F.col(f"_found.{c}")).alias(c) for c in (ts, *names)])


def interval_join(left: DataFrame, right: DataFrame, key: str, day: str, most: int) -> DataFrame:
    """JOIN-12: rows of left with a row of right 0..most days later: its gap is the smallest. The days a right row serves are dealt out, so the join is on equal days."""
    served = right.select(key, F.explode(F.sequence(F.date_sub(day, most), F.col(day), F.expr("interval 1 day"))).alias("_day"), F.col(day).alias("_later"))
    best = served.groupBy(key, F.col("_day").alias(day)).agg(F.min("_later").alias("later"))
    return left.join(best, [key, day]).withColumn("gap", F.datediff("later", day))

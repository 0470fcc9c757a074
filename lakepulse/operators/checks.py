"""Checks given as data: metric expressions, formulas in hypothesis groups, column status, rules on facts, rank correlations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakepulse.sources.lake import kept

from .ranks import average_rank, running


def metrics(rows: DataFrame, definitions: dict[str, dict[str, str]]) -> DataFrame:
    """UDF-1, FILT-2: per metric its values, how many are impossible and suspicious, and their limits. All metrics take one pass."""
    values = F.array(*[F.struct(F.lit(k).alias("metric"), F.when(F.expr(m["where"]), F.expr(m["expr"]).cast("double")).alias("x")) for k, m in definitions.items()])
    long = rows.select(F.explode(values).alias("p")).select("p.*").where("x is not null")
    of = lambda rule: reduce(lambda a, b: a | b, [(F.col("metric") == k) & F.expr(m[rule]) for k, m in definitions.items()])
    return long.groupBy("metric").agg(F.count("x").alias("n"), F.count_if(of("impossible")).alias("impossible"), F.count_if(of("suspicious")).alias("suspicious"), F.round(F.min("x"), 6).alias("low"), F.round(F.max("x"), 6).alias("high"))


def verdicts(rows: DataFrame, formulas: dict[str, tuple[str, str, str]], atol: float = 1.0, rtol: float = 0.05) -> DataFrame:
    """CHK-1, CHK-6, CHK-7: per (value, expected, group) as text: rows within tolerance, verdict, and whether its group rejects it:
    it fails, or almost passes while another of the group passes. There is a row per check."""
    pair = lambda k, f: F.struct(F.lit(k).alias("check"), F.lit(f[2]).alias("group"), F.expr(f[0]).cast("double").alias("t"), F.expr(f[1]).cast("double").alias("e"))
    long = rows.select(F.explode(F.array(*[pair(k, f) for k, f in formulas.items()])).alias("p")).select("p.*")
    t, e = F.col("t"), F.col("e")
    found = long.groupBy("check", "group").agg(F.count_if(t.isNotNull() & e.isNotNull()).alias("n"), F.count_if(F.abs(t - e) <= atol + rtol * F.abs(e)).alias("ok"))
    share = F.col("ok") / F.when(F.col("n") > 0, F.col("n"))
    found = found.withColumn("verdict", F.when(F.col("n") == 0, "no data").when(share >= 0.99, "passes").when(share >= 0.95, "almost").otherwise("fails"))
    v, sibling = F.col("verdict"), F.bool_or(F.col("verdict") == "passes").over(Window.partitionBy("group"))
    return found.withColumn("decision", F.when((v == "fails") | ((v == "almost") & sibling), "rejected").when(v == "no data", "unchecked").otherwise("kept"))


def column_status(per: DataFrame, needs: DataFrame) -> DataFrame:
    """CHK-8: (column, rejected, kept) and (column, needs), both of a row per column or two, to one status per column."""
    wrong = per.select(F.col("column").alias("needs"), (F.col("rejected") > F.col("kept")).alias("_wrong"))
    hit = needs.join(wrong, "needs", "left").groupBy("column").agg(F.bool_or(F.coalesce("_wrong", F.lit(False))).alias("_hit"))
    r, k = F.col("rejected"), F.col("kept")
    status = F.when((r > 0) & (k == 0), "wrong").when(F.coalesce("_hit", F.lit(False)), "affected").when(r > 0, "unconfirmed").when(k > 0, "correct").otherwise("unchecked")
    return per.join(hit, "column", "left").select("column", status.alias("status"))


def points(facts: DataFrame, rules: dict[str, str]) -> DataFrame:
    """CHK-10, UDF-4: one row of named facts to a row per rule: whether it fails."""
    return facts.select(F.explode(F.array(*[F.struct(F.lit(k).alias("point"), F.expr(e).alias("fails")) for k, e in rules.items()])).alias("p")).select("p.*")


def _mean_ranks(rows: DataFrame, x: str) -> DataFrame:
    """(x, mean rank of its rows) per distinct value."""
    per = rows.groupBy(x).agg(F.count("*").alias("_n"))
    return running(per, [], x, {"_c": F.col("_n")}).select(x, (F.col("_c") + (F.col("_n") + 1) / 2).alias(f"_rank_{x}"))


def rank_correlations(rows: DataFrame, x: str, others: list[str]) -> DataFrame:
    """One row: Spearman's correlation of x with each of the others, ties at their mean rank."""
    for c in [x, *others]:
        rows = rows.join(_mean_ranks(rows, c), c)
    return rows.agg(*[F.corr(f"_rank_{x}", f"_rank_{c}").alias(c) for c in others])


def day_profile(rows: DataFrame, on: DataFrame, columns: list[str]) -> DataFrame:
    """LEAK-4: (cutoff, column, offset, active, correlation): Spearman's correlation of each column of rows (cutoff, player_id, columns) with
    whether a player is in on (cutoff, player_id, offset), per cutoff and offset.

    All columns and offsets take one pass: ranks, ties at their mean, come from counts per value; a flag's correlation needs only how many
    have it and the sum of their ranks. Columns of one value, and days on which all are active, have none."""
    long = rows.unpivot(["cutoff", "player_id"], [F.col(c).cast("double").alias(c) for c in columns], "column", "x").where("x is not null")
    ranked = kept(average_rank(long, ["cutoff", "column"], "x", "r"))
    totals = ranked.groupBy("cutoff", "column").agg(F.count("*").alias("n"), F.sum("r").alias("sr"), F.sum(F.col("r") * F.col("r")).alias("srr"), F.min("x").alias("_a"), F.max("x").alias("_b")).where("_a < _b")
    per = ranked.join(on, ["cutoff", "player_id"]).groupBy("cutoff", "column", "offset").agg(F.count("*").alias("active"), F.sum("r").alias("rm")).join(totals, ["cutoff", "column"])
    n, m, sr = F.col("n").cast("double"), F.col("active").cast("double"), F.col("sr")
    r = (n * F.col("rm") - sr * m) / F.sqrt((n * F.col("srr") - sr * sr) * (n * m - m * m))
    return per.select("cutoff", "column", "offset", "active", F.when(m < n, r).alias("correlation"))


def window_ends(profile: DataFrame, around: int = 7, slack: int = 3) -> DataFrame:
    """LEAK-4, LEAK-5: (column, window_end, fall, holds): the offset after which the mean profile over the cutoffs falls the most, from the mean
    of `around` days to that of the next ones; a column has a row per offset."""
    mean = profile.groupBy("column", "offset").agg(F.avg("correlation").alias("c"))
    w = Window.partitionBy("column").orderBy("offset")
    fall = F.avg("c").over(w.rowsBetween(1 - around, 0)) - F.avg("c").over(w.rowsBetween(1, around))
    enough = (F.count("*").over(w.rowsBetween(1 - around, 0)) == around) & (F.count("*").over(w.rowsBetween(1, around)) == around)
    found = mean.withColumn("fall", F.when(enough, fall)).where("fall is not null").groupBy("column").agg(F.max(F.struct("fall", (-F.col("offset")).alias("early"))).alias("f"))
    return found.select("column", (-F.col("f.early")).alias("window_end"), F.round("f.fall", 6).alias("fall"), (-F.col("f.early") <= slack).alias("holds"))


def recomputation(stored: DataFrame, own: DataFrame, later: DataFrame, columns: list[str], rtol: float = 0.02, atol: float = 0.5) -> DataFrame:
    """LEAK-1: (cutoff, column, players, table_zero, match, table_higher, table_lower, match_ahead) of stored (cutoff, player_id, columns) against
    the same computed again as of its day (own), and some days later (later, null where the data don't reach). What isn't there counts 0;
    rows without a stored value don't count. All columns take one pass."""
    side = lambda d, p: d.select("cutoff", "player_id", *[F.col(c).cast("double").alias(f"{p}{c}") for c in columns])
    rows = side(stored, "t_").join(side(own, "m_"), ["cutoff", "player_id"], "left").join(side(later, "a_").withColumn("_ahead", F.lit(True)), ["cutoff", "player_id"], "left")
    known = rows.groupBy("cutoff").agg(F.coalesce(F.bool_or("_ahead"), F.lit(False)).alias("_ahead_known"))
    measures = []
    for c in columns:
        t, m, a = F.col(f"t_{c}"), F.coalesce(f"m_{c}", F.lit(0.0)), F.coalesce(f"a_{c}", F.lit(0.0))
        close = lambda x, t=t: F.abs(t - x) <= atol + rtol * F.abs(x)
        share = lambda e, t=t: F.avg(F.when(t.isNotNull(), e.cast("int")))
        measures += [share(t == 0).alias(f"z_{c}"), share(close(m)).alias(f"o_{c}"), share((t > m) & ~close(m)).alias(f"h_{c}"), share((t < m) & ~close(m)).alias(f"l_{c}"), share(close(a)).alias(f"p_{c}")]
    wide = rows.groupBy("cutoff").agg(F.count("*").alias("players"), *measures).join(known, "cutoff")
    cell = lambda c: F.struct(F.lit(c).alias("column"), F.col(f"z_{c}").alias("table_zero"), F.col(f"o_{c}").alias("match"), F.col(f"h_{c}").alias("table_higher"), F.col(f"l_{c}").alias("table_lower"), F.when(F.col("_ahead_known"), F.col(f"p_{c}")).alias("match_ahead"))
    return wide.select("cutoff", "players", F.explode(F.array(*[cell(c) for c in columns])).alias("c")).select("cutoff", "players", "c.*")


def leak_verdicts(per: DataFrame, least: float = 0.95, gain: float = 0.05) -> DataFrame:
    """LEAK-1: (column, days, median_match, worst_match, leak_days, verdict, status) from recomputation(): a column leaks if on any day it matches
    the later days better by `gain`; else it is OK, BROKEN or mostly OK by how many days match. status lists runs of days, a day that can't be
    told having that of the day before. A column has a row per snapshot."""
    leaks = F.coalesce(F.col("match_ahead") > F.col("match") + gain, F.lit(False))
    ok = F.col("match") >= least
    w = Window.partitionBy("column").orderBy("cutoff").rowsBetween(Window.unboundedPreceding, 0)
    told = F.when(ok, "OK").when(leaks, "leak").when(F.col("match_ahead").isNotNull(), "mismatch")
    rows = per.withColumn("_told", told).withColumn("status", F.coalesce(F.last("_told", ignorenulls=True).over(w), F.lit("mismatch")))
    changed = F.coalesce((F.col("status") != F.lag("status").over(Window.partitionBy("column").orderBy("cutoff"))).cast("int"), F.lit(1))
    runs = rows.withColumn("_new", changed).withColumn("_run", F.sum("_new").over(w)).groupBy("column", "_run", "status").agg(F.min("cutoff").alias("a"), F.max("cutoff").alias("b"))
    month = lambda c: F.date_format(c, "yyyy-MM")
    text = F.concat("status", F.lit(" "), month("a"), F.when(F.col("b") > F.col("a"), F.concat(F.lit(" to "), month("b"))).otherwise(""))
    listed = runs.groupBy("column").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_run", text.alias("t")))), lambda e: e["t"]), "; ").alias("status"))
    n, good, leak_days = F.count("*"), F.count_if(ok), F.count_if(leaks)
    verdict = F.when(leak_days > 0, "LEAK").when(good == n, "OK").when(good == 0, "BROKEN").otherwise(F.concat(F.lit("MOSTLY OK ("), good, F.lit("/"), n, F.lit(")")))
    return per.groupBy("column").agg(n.alias("days"), F.round(F.median("match"), 6).alias("median_match"), F.round(F.min("match"), 6).alias("worst_match"), leak_days.alias("leak_days"), verdict.alias("verdict")).join(listed, "column")

"""Evaluation of scores: ranks, calibration, survival, lift, replay of campaigns.

Rank sums work on counts per distinct score, not on rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakepulse.sources.lake import kept

from .ranks import attach, bin_of, in_top, inner_edges, placed, quantiles, running, top_ends


def _by_score(rows: DataFrame, score: str, label: str, by: list[str], weight: str | None = None) -> DataFrame:
    w = F.col(weight) if weight else F.lit(1)
    pos, neg = F.sum(F.col(label) * w).cast("long"), F.coalesce(F.sum(F.when(F.col(label) == 0, w)), F.lit(0)).cast("long")
    return rows.where(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(*by, F.col(score).alias("s")).agg(pos.alias("pos"), neg.alias("neg"))


def auc(rows: DataFrame, score: str, label: str, by: list[str], weight: str | None = None) -> DataFrame:
    """EVAL-1: rank-sum AUC, ties count half; null without both classes. weight: a column that says how often a row counts, here and below."""
    found = running(_by_score(rows, score, label, by, weight), by, "s", {"lower": F.col("neg")})
    sums = found.groupBy(*by).agg(F.sum((F.col("pos") * (2 * F.col("lower") + F.col("neg"))).cast("decimal(38,0)")).cast("double").alias("twice"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    pairs = 2.0 * F.col("pos") * F.col("neg")
    return sums.select(*by, "pos", "neg", F.round(F.col("twice") / F.when(pairs > 0, pairs), 6).alias("auc"))


def average_precision(rows: DataFrame, score: str, label: str, by: list[str]) -> DataFrame:
    """EVAL-2"""
    both = F.col("pos") + F.col("neg")
    found = running(_by_score(rows, score, label, by), by, "s", {"tp": F.col("pos"), "above": both}, descending=True)
    precision = (F.col("tp") + F.col("pos")) / (F.col("above") + both)
    return found.groupBy(*by).agg(F.round(F.sum(F.col("pos") * precision) / F.sum("pos"), 6).alias("average_precision"))


def roc(rows: DataFrame, score: str, label: str, by: list[str] | None = None) -> DataFrame:
    """EVAL-17: points of the ROC curve of each group, one for each distinct score."""
    by = by or []
    found = running(_by_score(rows, score, label, by), by, "s", {"tp": F.col("pos"), "fp": F.col("neg")}, descending=True)
    return found.select(*by, "s", F.round((F.col("tp") + F.col("pos")) / F.col("tp_all"), 6).alias("tpr"), F.round((F.col("fp") + F.col("neg")) / F.col("fp_all"), 6).alias("fpr"))


def losses(rows: DataFrame, p: str, label: str, by: list[str], clip: float = 1e-6, weight: str | None = None) -> DataFrame:
    """EVAL-2: log-loss and Brier score."""
    c = F.greatest(F.lit(clip), F.least(F.lit(1 - clip), F.col(p)))
    n, mean = counted(weight)
    return rows.groupBy(*by).agg(n.alias("n"), F.round(-mean(F.when(F.col(label) == 1, F.log(c)).otherwise(F.log(1 - c))), 6).alias("log_loss"), F.round(mean((F.col(p) - F.col(label)) * (F.col(p) - F.col(label))), 6).alias("brier"))


def counted(weight: str | None):
    """The number of rows as an aggregate, and the mean of a column without nulls, where a row counts `weight` times."""
    if weight is None:
        return F.count("*"), F.avg
    return F.sum(weight), lambda x: F.sum(x * F.col(weight)) / F.sum(weight)


def calibration(rows: DataFrame, p: str, label: str, bins: int = 10) -> DataFrame:
    """EVAL-3, EVAL-14: reliability per quantile bin of p; equal edges make one bin. The weighted mean gap is the ECE."""
    edges = quantiles(rows, p, [], [k / bins for k in range(1, bins)]).select(F.array_distinct("q").alias("edges"))
    found = rows.join(F.broadcast(edges)).withColumn("bin", F.size(F.filter("edges", lambda e: e < F.col(p))))
    return found.groupBy("bin").agg(F.count("*").alias("n"), F.round(F.avg(p), 6).alias("mean_p"), F.round(F.avg(label), 6).alias("rate"), F.round(F.abs(F.avg(p) - F.avg(label)), 6).alias("gap"))


def calibration_error(rows: DataFrame, p: str, label: str, by: list[str], bins: int = 10, weight: str | None = None) -> DataFrame:
    """EVAL-3: (by, ece): the mean gap of rate and mean prediction over bins between the distinct quantiles of p in each group."""
    n, mean = counted(weight)
    binned = attach(rows, inner_edges(rows, p, by, bins, weight), by).withColumn("_bin", bin_of(F.col(p)))
    per = binned.groupBy(*by, "_bin").agg(n.alias("_n"), F.abs(mean(F.col(p)) - mean(F.col(label))).alias("_gap"))
    return per.groupBy(*by).agg((F.sum(F.col("_n") * F.col("_gap")) / F.sum("_n")).alias("ece"))


def top_counts(rows: DataFrame, score: str, label: str, key: str, by: list[str], share: float = 0.1) -> DataFrame:
    """(by, k, hits, pos, n): events among the k = max(1, round(n*share)) highest scores, ties by the key, and among all. rows are read three
    times."""
    ranked = attach(rows, F.broadcast(kept(top_ends(rows, by, score, key, share))), by)
    top = in_top(F.col(score), F.col(key))
    return ranked.groupBy(*by).agg(F.count_if(top).alias("k"), F.sum(F.when(top, F.col(label)).otherwise(0)).alias("hits"), F.sum(label).alias("pos"), F.count("*").alias("n"))


def top_share(rows: DataFrame, score: str, label: str, key: str, by: list[str], share: float = 0.1) -> DataFrame:
    """EVAL-4, TOPK-2: precision, recall and lift of the max(1, round(n*share)) highest scores."""
    sums = top_counts(rows, score, label, key, by, share)
    return sums.select(*by, "k", "n", F.round(F.col("hits") / F.col("k"), 6).alias("precision"), F.round(F.col("hits") / F.when(F.col("pos") > 0, F.col("pos")), 6).alias("recall"), F.round(F.col("hits") / F.col("k") / F.when(F.col("pos") > 0, F.col("pos") / F.col("n")), 6).alias("lift"))


def deciles(rows: DataFrame, score: str, key: str, by: list[str]) -> DataFrame:
    """WIN-13: ceil(position / size * 10) with a full tie-break."""
    found = placed(rows, by, score, key)
    return found.withColumn("decile", F.ceil(F.col("place") * 10 / F.col("size")).cast("int")).drop("place", "size")


def kaplan_meier(rows: DataFrame, duration: str, event: str, by: list[str]) -> DataFrame:
    """EVAL-6, EVAL-12: survival after each day with an event, from counts per day."""
    per = rows.groupBy(*by, F.col(duration).alias("t")).agg(F.sum(event).cast("long").alias("d"), F.count("*").alias("n"))
    later = Window.partitionBy(*by).orderBy("t").rowsBetween(0, Window.unboundedFollowing)
    up_to = Window.partitionBy(*by).orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    found = per.withColumn("at_risk", F.sum("n").over(later))
    died = F.max((F.col("d") == F.col("at_risk")).cast("int")).over(up_to) == 1
    step = F.when(F.col("d") < F.col("at_risk"), F.log(1 - F.col("d") / F.col("at_risk"))).otherwise(0.0)
    return found.withColumn("survival", F.round(F.when(died, 0.0).otherwise(F.exp(F.sum(step).over(up_to))), 6)).where("d > 0").select(*by, "t", "d", "at_risk", "survival")


def concordance(rows: DataFrame, duration: str, event: str, risk: str, by: list[str]) -> DataFrame:
    """EVAL-5: Harrell's c of (duration, event, risk) per group: an event is compared with all of its group who last longer.

    Counts per (duration, risk) meet, not rows: durations are days and risks are counts of days, both bounded by the look-backs.
    """
    per = rows.groupBy(*by, F.col(duration).alias("t"), F.col(risk).alias("r")).agg(F.sum(event).cast("long").alias("d"), F.count("*").alias("n"))
    times, risks = per.where("d > 0").select(*by, "t").distinct(), per.select(*by, "r").distinct()
    both = times.join(risks, by).join(per, [*by, "t", "r"], "full").select(*by, "t", "r", F.coalesce("d", F.lit(0)).alias("d"), F.coalesce("n", F.lit(0)).alias("n"))
    longer = Window.partitionBy(*by, "r").orderBy(F.desc("t")).rowsBetween(Window.unboundedPreceding, -1)
    both = both.withColumn("longer", F.coalesce(F.sum("n").over(longer), F.lit(0)))
    lower = Window.partitionBy(*by, "t").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(*by, "t")
    found = both.withColumn("less", F.coalesce(F.sum("longer").over(lower), F.lit(0))).withColumn("all", F.sum("longer").over(every))
    big = lambda c: F.sum(c.cast("decimal(38,0)"))
    sums = found.groupBy(*by).agg(big(F.col("d") * (2 * F.col("less") + F.col("longer"))).alias("good"), big(2 * F.col("d") * F.col("all")).alias("pairs"))
    return sums.select(*by, (F.col("pairs") / 2).cast("long").alias("pairs"), F.round(F.col("good").cast("double") / F.when(F.col("pairs") > 0, F.col("pairs").cast("double")), 6).alias("c_index"))


def lift_table(rows: DataFrame, signal: str, label: str, by: list[str]) -> DataFrame:
    """EVAL-15: risk ratio of a yes/no signal with its 95% limits on the log scale."""
    s = F.col(signal) == 1
    q = rows.groupBy(*by).agg(F.count_if(s & (F.col(label) == 1)).alias("a"), F.count_if(s).alias("n1"), F.count_if(~s & (F.col(label) == 1)).alias("c"), F.count_if(~s).alias("n0"))
    ok = (F.col("a") > 0) & (F.col("c") > 0)
    ratio = (F.col("a") / F.col("n1")) / (F.col("c") / F.col("n0"))
    q = q.withColumn("lift", F.when(ok, ratio)).withColumn("se", F.when(ok, F.sqrt(1 / F.col("a") - 1 / F.col("n1") + 1 / F.col("c") - 1 / F.col("n0"))))
    return q.select(*by, "a", "n1", "c", "n0", F.round("lift", 6).alias("lift"), F.round(F.col("lift") * F.exp(-1.96 * F.col("se")), 6).alias("low"), F.round(F.col("lift") * F.exp(1.96 * F.col("se")), 6).alias("high"))


def first_rows(rows: DataFrame, by: list[str], order: list, n: int, parts: int = 64) -> DataFrame:
    """TOPK-3: the first n rows of each group by a total order: first of each of `parts` parts of it, then of what these leave."""
    part = F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(parts))
    for keys in ([*by, "_part"], by):
        rows = rows.withColumn("_part", part).withColumn("_place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_place") <= n).drop("_part", "_place")
    return rows


def replay(rows: DataFrame, rankings: dict[str, str], key: str, label: str, value: str, n: int, by: list[str]) -> DataFrame:
    """BT-3: of the first n of each group by each ranking, the churn and the value at risk they hold."""
    held = F.sum(F.col(label) * F.greatest(F.col(value), F.lit(0)))
    total = rows.groupBy(*by).agg(F.sum(label).alias("all_events"), held.alias("all_value"))
    parts = [first_rows(rows, by, [F.desc(score), key], n).groupBy(*by).agg(F.lit(name).alias("ranking"), F.count("*").alias("contacts"), F.sum(label).alias("events"), held.alias("value")) for name, score in rankings.items()]
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    share = lambda a, b: F.round(F.col(a) / F.when(F.col(b) > 0, F.col(b)), 6)
    return found.join(total, by).select(*by, "ranking", "contacts", "events", "value", share("events", "all_events").alias("event_share"), share("value", "all_value").alias("value_share"))


def psi(expected: DataFrame, actual: DataFrame, x: str, bins: int = 10) -> DataFrame:
    """ALRT-4: population stability of two samples over quantile bins of the expected one, shares at least 1e-4; see alerts.drift_edges."""
    from .alerts import drift, drift_edges

    long = expected.select(F.lit(0).alias("_g"), F.col(x).cast("double").alias(x), F.lit(True).alias("_ref")).union(actual.select(F.lit(0), F.col(x).cast("double"), F.lit(False))).where(F.col(x).isNotNull())
    return drift(long, ["_g"], x, F.col("_ref"), drift_edges(long.where("_ref"), ["_g"], x, bins)).select("psi")

"""Alerts: bands, null shares, drift, acknowledgement, blocking, reports by severity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakepulse.sources.lake import kept

from .ranks import attach, inner_edges

#: Severities, the worst first.
ORDER = ("critical", "warn", "info", "ok")


def rank_of(severity: str = "severity") -> Column:
    """TOPK-4: place of a severity in a report, the worst first."""
    return F.array_position(F.array(*[F.lit(s) for s in ORDER]), F.col(severity)).cast("int")


def _median(x: Column) -> Column:
    s, n = F.array_sort(x), F.size(x)
    return F.when(n > 0, (F.get(s, F.floor((n - 1) / 2).cast("int")) + F.get(s, F.floor(n / 2).cast("int"))) / 2.0)


def mad_band(daily: DataFrame, by: list[str], x: str, days: int = 28, least: int = 14, warn: float = 3.0, critical: float = 6.0) -> DataFrame:
    """ALRT-3, WIN-11: x against the median of the `days` calendar days before, in scaled median deviations inside that window; any change
    from a constant is critical. Days without a row don't count, and with fewer than `least` of them nothing is said (info). A window
    holds `days` values at the most, whatever the table's size."""
    w = Window.partitionBy(*by).orderBy(F.datediff("day", F.lit("1970-01-01").cast("date"))).rangeBetween(-days, -1)
    rows = daily.withColumn("_before", F.collect_list(F.col(x).cast("double")).over(w)).withColumn("median", _median(F.col("_before")))
    rows = rows.withColumn("mad", 1.4826 * _median(F.transform("_before", lambda v: F.abs(v - F.col("median")))))
    off = F.abs(F.col(x) - F.col("median"))
    known = F.size("_before") >= least
    severity = F.when(~known, "info").when((F.col("mad") == 0) & (off > 0), "critical").when(off > critical * F.col("mad"), "critical").when(off > warn * F.col("mad"), "warn").otherwise("ok")
    return rows.select(*by, "day", x, F.round("median", 6).alias("median"), F.round("mad", 6).alias("mad"), severity.alias("severity"))


def null_shares(per: DataFrame, at: str, n: str, nulls: str, before: int = 6, least: int = 100) -> DataFrame:
    """ALRT-2: rise of a null share over that of the rows of the periods before, in points: 5 warn, 20 critical."""
    w = Window.orderBy(at).rowsBetween(-before, -1)
    rows = per.withColumn("share", F.col(nulls) / F.col(n)).withColumn("expected", F.sum(nulls).over(w) / F.sum(n).over(w))
    rise = 100 * (F.col("share") - F.col("expected"))
    severity = F.when(F.col("expected").isNull() | (F.col(n) < least), "info").when(rise > 20, "critical").when(rise > 5, "warn").otherwise("ok")
    return rows.select(at, n, nulls, F.round("share", 6).alias("share"), F.round("expected", 6).alias("expected"), severity.alias("severity"))


def drift(long: DataFrame, by: list[str], x: str, reference: Column, edges: DataFrame) -> DataFrame:
    """ALRT-5: population stability of x per group between the reference rows and the others, over the bins of the group's edges
    (see drift_edges). A group without reference rows has no stability and is critical, with the reason."""
    bin_ = F.when(F.col("single"), F.col(x)).otherwise(F.size(F.filter("edges", lambda e: e <= F.col(x))).cast("double"))
    edges = kept(edges)
    binned = long.join(F.broadcast(edges), by).withColumn("bin", bin_)
    new = long.select(*by).distinct().join(edges, by, "left_anti").select(*by).distinct().select(*by, F.lit(None).cast("double").alias("psi"), F.lit("critical").alias("severity"), F.lit("not in the reference").alias("reason"))
    per = binned.groupBy(*by, "bin").agg(F.count_if(reference).alias("e"), F.count_if(~reference).alias("a"))
    every = Window.partitionBy(*by)
    share = lambda c: F.greatest(F.lit(1e-4), F.col(c) / F.sum(c).over(every))
    found = per.select(*by, share("e").alias("e"), share("a").alias("a")).groupBy(*by).agg(F.round(F.sum((F.col("a") - F.col("e")) * F.log(F.col("a") / F.col("e"))), 6).alias("psi"))
    found = found.withColumn("severity", F.when(F.col("psi") > 0.25, "critical").when(F.col("psi") > 0.10, "warn").otherwise("ok"))
    return found.withColumn("reason", F.when(F.col("severity") != "ok", "drift")).unionByName(new)


def drift_edges(reference: DataFrame, by: list[str], x: str, bins: int = 10, steady: bool = False) -> DataFrame:
    """ALRT-4: (by, edges, single): what parts the bins of x: quantiles of the reference without the least and greatest one, a value on an
    edge belonging to the bin above; where it has at most `bins` different values, each is a bin of its own (single). steady: see ranks.quantiles."""
    probe = [k / (5 * bins) for k in range(5 * bins + 1)]
    # Approximate quantiles are values of x: where more than `bins` differ, its values need no counting.
    seen = reference.groupBy(*by).agg((F.size(F.array_distinct(F.percentile_approx(x, probe, 1000))) > bins).alias("_many"))
    seen = kept(seen) if steady else seen
    some = attach(reference.select(*by, x), F.broadcast(seen.where("not _many").drop("_many")), by)
    few = some.distinct().groupBy(*by).agg((F.count("*") <= bins).alias("_few"))
    single = attach(seen, few, by, "left").select(*by, (~F.col("_many") & F.coalesce("_few", F.lit(False))).alias("single"))
    return attach(inner_edges(reference, x, by, bins, steady=steady), single, by)


def player_counts(snapshot: DataFrame, reference: DataFrame, by: list[str], at: str, warn: float = 0.2, critical: float = 0.5) -> DataFrame:
    """ALRT-5: rows of each group against its mean number of rows per reference cutoff: relative change, and how bad it is."""
    per = reference.groupBy(*by).agg((F.count("*") / F.count_distinct(at)).alias("expected"))
    found = attach(snapshot.groupBy(*by).agg(F.count("*").alias("n")), per, by, "left").withColumn("change", F.col("n") / F.col("expected") - 1)
    severity = F.when(F.col("expected").isNull(), "critical").when(F.abs("change") > critical, "critical").when(F.abs("change") > warn, "warn").otherwise("ok")
    return found.select(*by, "n", F.round("expected", 6).alias("expected"), F.round("change", 6).alias("change"), severity.alias("severity"))


def acknowledged(alerts: DataFrame, entries: DataFrame, value: str) -> DataFrame:
    """ALRT-6: critical alerts of an entry's check and brand, in its dates and up to its value, are warnings with the entry's reason.

    entries (check, brand or null for all, first, last, most, reason) come from a configuration file; of several the least reason counts.
    """
    e = entries.select(F.col("check").alias("_check"), F.col("brand").alias("_brand"), "first", "last", "most", "reason")
    fits = (F.col("check") == F.col("_check")) & (F.col("_brand").isNull() | F.col("brand").eqNullSafe(F.col("_brand"))) & F.col("day").between(F.col("first"), F.col("last")) & (F.col(value) <= F.col("most"))
    reasons = alerts.where("severity = 'critical'").join(F.broadcast(e), fits).groupBy("check", "brand", "day").agg(F.min("reason").alias("reason"))
    joined = alerts.join(reasons, ["check", "brand", "day"], "left")
    return joined.withColumn("severity", F.when(F.col("reason").isNotNull(), "warn").otherwise(F.col("severity")))


def blocking(alerts: DataFrame, harmless: tuple[str, ...] = ("feature_drift",)) -> DataFrame:
    """ALRT-7: whether critical alerts, other than of harmless checks, stop the run."""
    stop = (F.col("severity") == "critical") & ~F.col("check").isin(*harmless)
    return alerts.agg(F.count("*").alias("alerts"), F.count_if(F.col("severity") == "critical").alias("critical"), F.count_if(stop).alias("stopping"), (F.count_if(stop) > 0).alias("stops"))


def examples(flagged: DataFrame, by: list[str], severity: str, text: Column, most: int = 20) -> DataFrame:
    """TOPK-1: the worst rows of each group as one text. Parts of a group are cut first, so no task orders a whole group."""
    from .evaluate import first_rows

    top = first_rows(flagged.select(*by, severity, text.alias("_text")), by, [F.desc(severity), F.asc("_text")], most)
    listed = F.array_sort(F.collect_list(F.struct((-F.col(severity)).alias("s"), F.col("_text").alias("t"))))
    return top.groupBy(*by).agg(F.count("*").alias("n"), F.array_join(F.transform(listed, lambda e: e["t"]), "; ").alias("examples"))

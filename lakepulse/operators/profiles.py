"""Profiles, histograms, distributions, outliers and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranks import attach, quantiles

NINE = (0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)


def sample_skewness(x: str) -> Column:
    n = F.count(x)
    return F.when(n > 2, F.skewness(x) * F.sqrt(n * (n - 1.0)) / F.when(n > 2, n - 2))


def sample_kurtosis(x: str) -> Column:
    n = F.count(x)
    return F.when(n > 3, (n - 1.0) / (F.when(n > 3, (n - 2.0) * (n - 3.0))) * ((n + 1) * F.kurtosis(x) + 6))


def profile(rows: DataFrame, x: str, by: list[str], low: float | None = None, high: float | None = None, digits: int = 4) -> DataFrame:
    """AGG-7..9: counts and moments of x per group in one aggregation, and nine exact quantiles from counts per value."""
    c, value = F.col(x), F.col(x).cast("double")
    rows = rows.withColumn(x, value)
    found = rows.groupBy(*by).agg(
        F.count("*").alias("n_rows"), F.count(x).alias("n"), F.count_if(c == 0).alias("zeros"), F.count_if(c < 0).alias("negatives"),
        F.count_if(c < low if low is not None else F.lit(False)).alias("below"), F.count_if(c > high if high is not None else F.lit(False)).alias("above"),
        F.min(x).alias("low"), F.max(x).alias("high"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("sd"), sample_skewness(x).alias("skewness"), sample_kurtosis(x).alias("kurtosis"),
    )
    found = attach(found, quantiles(rows, x, by, list(NINE)), by)
    rounded = [F.round(F.col(k), digits).alias(k) for k in ("low", "high", "mean", "sd", "skewness", "kurtosis")]
    return found.select(*by, "n_rows", "n", "zeros", "negatives", "below", "above", *rounded, *[F.round(F.col("q")[i], digits).alias(f"p{round(q * 100):02d}") for i, q in enumerate(NINE)])


def log_histogram(rows: DataFrame, x: str, by: list[str], width: float = 0.25) -> DataFrame:
    """AGG-11, AGG-12: bins of log10 of values over 0."""
    return rows.where(F.col(x) > 0).groupBy(*by, F.floor(F.log10(F.col(x)) / width).cast("int").alias("bin")).agg(F.count("*").alias("n"))


def limits_histogram(rows: DataFrame, x: str, low: float, high: float, bins: int = 50) -> DataFrame:
    """AGG-13: bins between limits, -1 below and `bins` above; the upper limit belongs to the last bin."""
    inside = F.least(F.floor((F.col(x) - low) / ((high - low) / bins)), F.lit(bins - 1))
    return rows.where(F.col(x).isNotNull()).groupBy(F.when(F.col(x) < low, -1).when(F.col(x) > high, bins).otherwise(inside).cast("int").alias("bin")).agg(F.count("*").alias("n"))


def complete_histogram(bins: DataFrame, last: int) -> DataFrame:
    """AGG-16, WIN-23: dense bins 0..last with those beyond folded into the edges, shares and cumulative shares. Bins are few."""
    folded = bins.groupBy(F.greatest(F.lit(0), F.least(F.lit(last), F.col("bin"))).cast("int").alias("bin")).agg(F.sum("n").alias("n"))
    every = bins.sparkSession.range(last + 1).select(F.col("id").cast("int").alias("bin"))
    dense = every.join(folded, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    running = F.sum("n").over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    return dense.select("bin", "n", (F.col("n") / total).alias("share"), (running / total).alias("cumulative"))


def concentration(rows: DataFrame, who: str, value: str, tops: tuple[int, ...] = (1, 10, 100)) -> DataFrame:
    """AGG-28, WIN-16: share of the total of the top 1, 10 and 100. Only the top ones are ranked."""
    per = rows.groupBy(who).agg(F.sum(value).alias("v"))
    total = per.agg(F.sum("v").alias("total"), F.count("*").alias("n"))
    # One row each: they meet by union, not by a join.
    top = per.orderBy(F.desc("v"), who).limit(max(tops)).withColumn("r", F.row_number().over(Window.orderBy(F.desc("v"), who)))
    sums = top.agg(*[F.sum(F.when(F.col("r") <= k, F.col("v"))).alias(f"top_{k}") for k in tops])
    one = total.unionByName(sums, allowMissingColumns=True)
    one = one.agg(*[F.max(c).alias(c) for c in one.columns])
    return one.select("n", *[F.round(F.col(f"top_{k}") / F.col("total"), 6).alias(f"share_top_{k}") for k in tops])


def lift(rows: DataFrame, bad: Column, value: str, most: int = 20) -> DataFrame:
    """AGG-27: share among bad rows over share among all rows, per value."""
    per = rows.groupBy(value).agg(F.count("*").alias("n"), F.count_if(bad).alias("bad"))
    total = rows.agg(F.count("*").alias("_n"), F.count_if(bad).alias("_bad"))
    shares = attach(per, total, []).withColumn("lift", (F.col("bad") / F.col("_bad")) / (F.col("n") / F.col("_n"))).drop("_n", "_bad")
    return shares.where("bad > 0").orderBy(F.desc("bad"), value).limit(most).withColumn("lift", F.round("lift", 6))


def stacked_counts(rows: DataFrame, columns: list[str]) -> DataFrame:
    """AGG-31: category counts of several columns, null kept."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]))
    return rows.select(pairs.alias("p")).groupBy("p.column", "p.value").agg(F.count("*").alias("n"))


def text_format(rows: DataFrame, columns: list[str]) -> DataFrame:
    """AGG-32: distinct values, share of null, upper- and lower-case ones, lengths. Values are counted before they meet."""
    v = F.col("value")
    return stacked_counts(rows, columns).groupBy("column").agg(
        F.count("value").alias("n_distinct"), F.round(F.sum(F.when(v.isNull(), F.col("n")).otherwise(0)) / F.sum("n"), 6).alias("null_share"),
        F.round(F.sum(F.when(v == F.upper(v), F.col("n")).otherwise(0)) / F.sum("n"), 6).alias("upper_share"), F.round(F.sum(F.when(v == F.lower(v), F.col("n")).otherwise(0)) / F.sum("n"), 6).alias("lower_share"),
        F.array_join(F.transform(F.array_sort(F.collect_set(F.length("value"))), lambda n: n.cast("string")), ",").alias("lengths"),
    )


def id_profile(rows: DataFrame, column: str) -> DataFrame:
    """AGG-33"""
    v = F.col(column).cast("string")
    return rows.agg(F.count_if(v.isNull()).alias("nulls"), F.min(F.length(v)).alias("min_length"), F.max(F.length(v)).alias("max_length"), F.count_if(~v.rlike("^[0-9]+$")).alias("non_digits"), F.count_if(v != F.lower(v)).alias("not_lower"))


def kind(stats: DataFrame) -> DataFrame:
    """DIST-2, DIST-4: type of a metric from its statistics, first rule that holds, and whether its extremes are far out."""
    c = F.col
    found = (
        F.when(c("n") == 0, "empty").when(c("distinct") <= 5, "few_values").when(c("zeros") > 0.5 * c("n"), "zero_inflated").when(c("negatives") > 0.01 * c("n"), "signed")
        .when(c("skewness") > 4, "heavy_tail").when(F.abs(c("skewness")) < 0.5, "symmetric").otherwise("skewed")
    )
    return stats.withColumn("kind", found).withColumn("extreme", c("largest") > 100 * c("p99"))


def iqr_outliers(rows: DataFrame, x: str, by: list[str], times: float = 1.5) -> DataFrame:
    """ANOM-1: rows outside the quartiles by `times` their distance, and the caps that WINS-1 would use."""
    q = quantiles(rows, x, by, [0.25, 0.75])
    edge = q.select(*by, (F.col("q")[0] - times * (F.col("q")[1] - F.col("q")[0])).alias("low"), (F.col("q")[1] + times * (F.col("q")[1] - F.col("q")[0])).alias("high"))
    joined = attach(rows, edge, by)
    return joined.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(F.col(x) < F.col("low")).alias("below"), F.count_if(F.col(x) > F.col("high")).alias("above"), F.round(F.first("low"), 4).alias("low"), F.round(F.first("high"), 4).alias("high"))


def robust_outliers(rows: DataFrame, x: str, by: list[str], limit: float = 3.5) -> DataFrame:
    """ANOM-2: 0.6745 * (x - median) / MAD over the limit; not applicable where MAD is 0."""
    middle = quantiles(rows, x, by, [0.5]).select(*by, F.col("q")[0].alias("med"))
    with_dev = attach(rows, middle, by).withColumn("dev", F.abs(F.col(x) - F.col("med")))
    mad = quantiles(with_dev, "dev", by, [0.5]).select(*by, F.col("q")[0].alias("mad"))
    z = 0.6745 * F.col("dev") / F.when(F.col("mad") > 0, F.col("mad"))
    return attach(with_dev, mad, by).groupBy(*by).agg(F.count("*").alias("n"), F.count_if(z > limit).alias("outliers"), F.round(F.first("med"), 4).alias("median"), F.round(F.first("mad"), 4).alias("mad"))


def rolling_outliers(daily: DataFrame, by: list[str], x: str, window: int = 28, least: int = 14, times: float = 3.0) -> DataFrame:
    """ANOM-4, WIN-10: days whose distance from the median of the days before is over `times` the median of such distances before."""
    w = Window.partitionBy(*by).orderBy("day").rowsBetween(-window, -1)
    enough = F.count(F.lit(1)).over(w) >= least
    found = daily.withColumn("median", F.when(enough, F.percentile(x, 0.5).over(w))).withColumn("residual", F.abs(F.col(x) - F.col("median")))
    found = found.withColumn("mad", F.when(F.count("residual").over(w) >= least, F.percentile("residual", 0.5).over(w)))
    return found.withColumn("outlier", F.coalesce((F.col("mad") > 0) & (F.col("residual") > times * F.col("mad")), F.lit(False)))


def caps(rows: DataFrame, x: str, by: list[str], share: float = 0.005) -> DataFrame:
    """WINS-1: caps per group from exact quantiles of the evaluated values."""
    some = rows.where(F.col(x) > 0)
    found = some.groupBy(*by).agg(F.count("*").alias("n"))
    return attach(found, quantiles(some, x, by, [1 - share]), by).select(*by, F.col("q")[0].alias("cap"), "n")


def check_formula(rows: DataFrame, target: Column, expected: Column, by: list[str], atol: float, rtol: float) -> DataFrame:
    """CHK-1, CHK-6: rows that agree with a formula within tolerance, above and below it, and the verdict."""
    tolerance = atol + rtol * F.abs(expected)
    both = target.isNotNull() & expected.isNotNull()
    found = rows.groupBy(*by).agg(
        F.count_if(both).alias("n"), F.count_if(both & (F.abs(target - expected) <= tolerance)).alias("ok"), F.count_if(both & (target - expected > tolerance)).alias("higher"), F.count_if(both & (expected - target > tolerance)).alias("lower")
    )
    share = F.col("ok") / F.when(F.col("n") > 0, F.col("n"))
    return found.withColumn("verdict", F.when(F.col("n") == 0, "no data").when(share >= 0.99, "passes").when(share >= 0.95, "almost").otherwise("fails"))


def contract(rows: DataFrame, grain: list[str], not_null: list[str], ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """DQ-1..3: a row per rule with its problems."""
    keyed = rows.groupBy(*grain).agg(F.count("*").alias("_n")).agg(F.lit("grain").alias("rule"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("problems"))
    rules = [(f"not_null_{c}", F.col(c).isNull()) for c in not_null] + [(f"range_{c}", ~F.col(c).between(*r)) for c, r in ranges.items()]
    counted = rows.agg(*[F.count_if(bad).alias(name) for name, bad in rules])
    long = counted.select(F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("problems")) for n, _ in rules])).alias("r")).select("r.*")
    return keyed.unionByName(long)

"""Shapes of distributions on histograms: moment fits, distances, peaks, bin widths."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def normal_cdf(z: Column) -> Column:
    """Abramowitz and Stegun 26.2.17, within 1e-7. Its coefficients."""
    b = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
    t = 1 / (1 + 0.2316419 * F.abs(z))
    poly = t * (b[0] + t * (b[1] + t * (b[2] + t * (b[3] + t * b[4]))))
    tail = F.exp(-z * z / 2) / math.sqrt(2 * math.pi) * poly
    return F.when(z >= 0, 1 - tail).otherwise(tail)


def normal_quantile(u: Column) -> Column:
    """Abramowitz and Stegun 26.2.23, within 5e-4. Its coefficients."""
    c, d = (2.515517, 0.802853, 0.010328), (1.432788, 0.189269, 0.001308)
    t = F.sqrt(-2 * F.log(F.least(u, 1 - u)))
    z = t - (c[0] + t * (c[1] + t * c[2])) / (1 + t * (d[0] + t * (d[1] + t * d[2])))
    return F.when(u < 0.5, -z).otherwise(z)


def log_normal_fit(bins: DataFrame, by: list[str], moments: DataFrame, width: float) -> DataFrame:
    """SHAPE-1, WIN-23: greatest distance, at bin edges, between the cumulative share of bins of ln x and the normal of its mean and deviation."""
    order = Window.partitionBy(*by).orderBy("bin")
    running = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)) / F.sum("n").over(Window.partitionBy(*by))
    joined = bins.withColumn("_share", running).join(moments, by)
    off = F.abs(F.col("_share") - normal_cdf(((F.col("bin") + 1) * width - F.col("mean_ln")) / F.col("sd_ln")))
    found = joined.groupBy(*by).agg(F.round(F.max(off), 4).alias("ks"))
    return found.withColumn("verdict", F.when(F.col("ks") < 0.03, "close").when(F.col("ks") < 0.08, "acceptable").otherwise("far"))


def peaks(bins: DataFrame, by: list[str], spread: float = 1.5, reach: int = 4, prominence: float = 0.05) -> DataFrame:
    """SHAPE-3: local maxima of a smoothed histogram (by, bin, n; dense bins), higher by a share of the greatest than a valley on either side.

    A bin adds to its neighbours within reach, so the kernel is an equi-join; histograms are of few bins.
    """
    kernel = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(math.exp(-k * k / (2 * spread * spread))).alias("w")) for k in range(-reach, reach + 1)]))
    smooth = bins.select(*by, "bin", "n", kernel.alias("e")).groupBy(*by, (F.col("bin") + F.col("e.k")).alias("bin")).agg(F.sum(F.col("n") * F.col("e.w")).alias("density"))
    smooth = smooth.join(bins.select(*by, "bin"), [*by, "bin"], "left_semi")
    order, every = Window.partitionBy(*by).orderBy("bin"), Window.partitionBy(*by)
    c = F.col("density")
    top = (c > F.coalesce(F.lag("density").over(order), F.lit(-1.0))) & (c >= F.coalesce(F.lead("density").over(order), F.lit(-1.0)))
    rows = smooth.withColumn("_top", top).withColumn("_most", F.max("density").over(every))
    # The lowest point between a peak and the next higher one, to either side: over the rows beyond, kept as an array of the few bins.
    left = F.collect_list(c).over(order.rowsBetween(Window.unboundedPreceding, -1))
    right = F.collect_list(c).over(order.rowsBetween(1, Window.unboundedFollowing))
    rows = rows.withColumn("_l", F.reverse(left)).withColumn("_r", right).where("_top")

    def valley(side: str) -> Column:
        walk = F.aggregate(side, F.struct(c.alias("low"), F.lit(False).alias("over")), lambda acc, v: F.when(acc["over"] | (v > F.col("density")), F.struct(acc["low"].alias("low"), F.lit(True).alias("over"))).otherwise(F.struct(F.least(acc["low"], v).alias("low"), F.lit(False).alias("over"))))
        return F.when(walk["over"], walk["low"]).otherwise(F.least(walk["low"], F.lit(0.0)))

    height = c - F.greatest(valley("_l"), valley("_r"))
    return rows.where(height >= prominence * F.col("_most")).select(*by, "bin", F.round("density", 4).alias("density"))

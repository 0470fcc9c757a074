"""Tables of many metrics at once: scores by group, back-tests, label thresholds, distributions of metrics by segment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakepulse.sources.lake import kept

from . import evaluate as ev
from . import shapes
from .ranks import attach, average_rank, correlation, in_top, quantiles, top_ends

PROBABILITY = ("log_loss", "brier", "ece")
RANKING = ("auc", "top_precision", "top_recall")


def metrics_by(rows: DataFrame, score: str, label: str, key: str, by: list[str], probability: bool = True) -> DataFrame:
    """EVAL-13, BT-2: (by, n, rate, mean_score, auc, top_precision, top_recall, and log_loss, brier, ece of probabilities) per group: a good
    value of all can hide a bad group. key is numeric and unique in a group; a group without both classes has no AUC. All but the top shares comes from
    counts per score and label; rows are read four times, so they should be cheap to read."""
    rows = rows.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    counts = kept(rows.groupBy(*by, score, label).agg(F.count("*").alias("_n")))
    n, mean = ev.counted("_n")
    out = counts.groupBy(*by).agg(n.alias("n"), mean(F.col(label)).alias("rate"), mean(F.col(score)).alias("mean_score"))
    out = attach(out, ev.auc(counts, score, label, by, "_n").select(*by, "auc"), by)
    out = attach(out, ev.top_share(rows, score, label, key, by).select(*by, F.col("precision").alias("top_precision"), F.col("recall").alias("top_recall")), by)
    if probability:
        out = attach(out, ev.losses(counts, score, label, by, weight="_n").drop("n"), by)
        out = attach(out, ev.calibration_error(counts, score, label, by, weight="_n"), by)
    return out


def block_intervals(values: DataFrame, by: list[str], order: str, x: str, block: int = 3, replicas: int = 2000, seed: int = 42) -> DataFrame:
    """EVAL-11, BT-2: (by, mean, low, high, median, least, most) of a short series per group, the interval being that of the mean over
    circular blocks of consecutive values, as many values as there are. Values are one per cutoff, so a group's series is an array."""
    series = values.where(F.col(x).isNotNull()).groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(x).alias("x")))), lambda v: v["x"]).alias("v"))
    n = F.size("v")
    draws = series.withColumn("replica", F.explode(F.sequence(F.lit(1), F.lit(replicas))))
    start = lambda b: F.pmod(F.xxhash64("replica", b, F.lit(seed)), n)
    picked = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0.0), lambda acc, k: acc + F.get("v", F.pmod(start(F.floor(k / block)) + k % block, n).cast("int")))
    means = draws.select(*by, (picked / n).alias("mean")).groupBy(*by).agg(F.percentile("mean", 0.025).alias("low"), F.percentile("mean", 0.975).alias("high"))
    own = values.where(F.col(x).isNotNull()).groupBy(*by).agg(F.avg(x).alias("mean"), F.median(x).alias("median"), F.min(x).alias("least"), F.max(x).alias("most"))
    return attach(own, means, by)


def replay(rows: DataFrame, rankings: dict[str, str], key: str, label: str, value: str, n: int, by: list[str]) -> DataFrame:
    """BT-3: of the first n of each group by each ranking, the share of all churn and of all value at risk that they hold, and that value per
    1,000 contacts; `random` is what a random choice can expect."""
    held = F.col(label) * F.greatest(F.col(value), F.lit(0.0))
    total = rows.groupBy(*by).agg(F.count("*").alias("_n"), F.sum(label).alias("_y"), F.sum(held).alias("_v"))
    cells = F.explode(F.array(*[F.struct(F.lit(k).alias("ranking"), F.col(c).cast("double").alias("score")) for k, c in rankings.items()]))
    long = rows.select(*by, key, label, value, cells.alias("c")).select(*by, key, label, value, "c.*")
    top = ev.first_rows(long, [*by, "ranking"], [F.desc_nulls_last("score"), F.asc(key)], n)
    per = attach(top.groupBy(*by, "ranking").agg(F.count("*").alias("contacts"), F.sum(label).alias("y"), F.sum(held).alias("v")), total, by)
    chance = F.least(F.lit(n), F.col("_n"))
    random = total.select(*by, F.lit("random").alias("ranking"), chance.alias("contacts"), (F.col("_y") * chance / F.col("_n")).alias("y"), (F.col("_v") * chance / F.col("_n")).alias("v"), "_n", "_y", "_v")
    some = lambda c: F.when(F.col(c) > 0, F.col(c))
    return per.unionByName(random).select(*by, "ranking", "contacts", (F.col("y") / some("_y")).alias("churn_captured"), (F.col("v") / some("_v")).alias("value_captured"), (F.col("v") / F.col("contacts") * 1000).alias("value_per_1000"))


def label_matrix(rows: DataFrame, labels: list[str], scores: list[str], key: str, by: list[str]) -> DataFrame:
    """RPT-3: (by, label, score, n, rate, auc, top_precision) of each score against each label, all pairs in one pass."""
    cells = F.explode(F.array(*[F.struct(F.lit(y).alias("label"), F.lit(s).alias("score"), F.col(y).cast("int").alias("y"), F.col(s).cast("double").alias("s")) for y in labels for s in scores]))
    long = rows.select(*by, key, cells.alias("c")).select(*by, key, "c.*")
    return metrics_by(long, "s", "y", key, [*by, "label", "score"], probability=False).drop("mean_score", "top_recall")


def overlaps(rows: DataFrame, a: str, b: str, key: str, by: list[str], share: float = 0.1) -> DataFrame:
    """RPT-3, BT-5: (by, n, spearman, top_overlap) of two scores: their rank correlation, ties at their mean, and how much of the top share
    by one the other has in its own. Rows that lack a score have no rank in either. rows are read five times, so they should be cheap to read."""
    rows = rows.select(*by, key, a, b)
    pairs = kept(rows.groupBy(*by, a, b).agg(F.count("*").alias("_n")))
    both = pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    ranked = average_rank(average_rank(both, by, a, "_ra", "_n"), by, b, "_rb", "_n")
    found = attach(pairs.groupBy(*by).agg(F.sum("_n").alias("n")), ranked.groupBy(*by).agg(correlation("_ra", "_rb", "_n").alias("spearman")), by, "left")
    told = attach(rows, F.broadcast(kept(top_ends(rows, by, a, key, share))), by).withColumn("_in_a", in_top(F.col(a), F.col(key))).drop("size", "k", "edge", "last")
    told = attach(told, F.broadcast(kept(top_ends(rows, by, b, key, share))), by)
    top = told.groupBy(*by).agg((F.count_if(F.col("_in_a") & in_top(F.col(b), F.col(key))) / F.max("k")).alias("top_overlap"))
    return attach(found, top, by)


def bin_expr(x: Column, scale: str, width: float) -> Column:
    """The number of a value's bin: of log10 of positive values, of whole numbers, or of equal widths."""
    if scale == "log":
        return F.when(x > 0, F.floor(F.log10(x) / width)).cast("int")
    return F.floor(x / (1.0 if scale == "int" else width)).cast("int")


def histograms(rows: DataFrame, metrics: dict[str, dict], segment: str) -> DataFrame:
    """SHAPE-4: (metric, segment, x) of all metrics at once, each row for its segment and for `all`. metrics: name to expr, scale, width, range."""
    wide = rows.select(F.explode(F.array(F.lit("all"), F.col(segment).cast("string"))).alias("segment"), *[F.expr(m["expr"]).cast("double").alias(f"_{k}") for k, m in metrics.items()])
    wide = wide.select("*", *[bin_expr(F.col(f"_{k}"), m["scale"], m["width"]).alias(f"_bin_{k}") for k, m in metrics.items()])
    cell = lambda k, m: F.struct(F.lit(k).alias("metric"), F.col(f"_{k}").alias("x"), F.col(f"_bin_{k}").alias("bin"), F.lit(float(m["range"][0])).alias("low"), F.lit(float(m["range"][1])).alias("high"))
    return wide.select("segment", F.explode(F.array(*[cell(k, m) for k, m in metrics.items()])).alias("c")).select("segment", "c.*")


def scorecard(long: DataFrame) -> DataFrame:
    """SHAPE-4: per metric and segment of histograms(), whose rows should be cheap to read: rows, share of nulls, 1%, 50% and 99% points, maximum, share outside the range a value
    can have in life."""
    by = ["metric", "segment"]
    x = F.col("x")
    share = lambda c: c / F.greatest(F.count("x"), F.lit(1))
    found = long.groupBy(*by).agg(F.count("*").alias("n_rows"), (F.count_if(x.isNull()) / F.count("*")).alias("null_share"), F.max("x").alias("most"), share(F.count_if(x < F.col("low"))).alias("below"), share(F.count_if(x > F.col("high"))).alias("above"))
    q = quantiles(long, "x", by, [0.01, 0.5, 0.99], steady=True).select(*by, *[F.col("q")[i].alias(n) for i, n in enumerate(("p1", "median", "p99"))])
    return attach(found, q, by, "left")


def segment_peaks(long: DataFrame) -> DataFrame:
    """SHAPE-4: (metric, segment, peaks, positions) of the smoothed histograms, all at once; positions are bins, in order. A metric's bins
    are few whatever its rows."""
    by = ["metric", "segment"]
    bins = long.where("bin is not null").groupBy(*by, "bin").agg(F.count("*").alias("n"))
    span = bins.groupBy(*by).agg(F.min("bin").alias("a"), F.max("bin").alias("b")).select(*by, F.explode(F.sequence("a", "b")).alias("bin"))
    found = shapes.peaks(span.join(bins, [*by, "bin"], "left").na.fill(0, ["n"]), by)
    return found.groupBy(*by).agg(F.count("*").cast("int").alias("peaks"), F.array_join(F.array_sort(F.collect_list("bin")), ",").alias("positions"))


def point_masses(long: DataFrame, values: tuple[float, ...] = (0, 1, 2, 3, 4, 5, 10), times: float = 3.0) -> DataFrame:
    """SHAPE-4: (metric, segment, value, share, mass): the share of rows at single values, and whether it is more than `times` the mean share of
    the whole numbers beside it."""
    by = ["metric", "segment"]
    near = sorted({v + d for v in values for d in (-1, 0, 1)})
    counted = long.where(F.col("x").isin([float(v) for v in near])).groupBy(*by, F.col("x").alias("value")).agg(F.count("*").alias("_n"))
    total = long.groupBy(*by).agg(F.count("x").alias("_all")).where("_all > 0")
    every = total.select(*by, "_all", F.explode(F.array(*[F.lit(float(v)) for v in near])).alias("value")).join(counted, [*by, "value"], "left").na.fill(0, ["_n"])
    w = Window.partitionBy(*by).orderBy("value").rangeBetween(-1, 1)
    beside = (F.sum("_n").over(w) - F.col("_n")) / 2
    return every.withColumn("_beside", beside).where(F.col("value").isin([float(v) for v in values])).select(*by, "value", (F.col("_n") / F.col("_all")).alias("share"), (F.col("_n") > times * F.col("_beside")).alias("mass")).where("share > 0")

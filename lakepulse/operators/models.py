"""Model operators as Spark ML jobs: baselines, calibration, segments, selection."""

from __future__ import annotations

import json
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, LogisticRegressionModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakepulse.sources.lake import kept

from .evaluate import auc, calibration
from .ranks import attach, placed, quantiles


def _chance(model: LogisticRegressionModel, x: str) -> Column:
    """The probability of class 1 for a column of vectors, from the coefficients. A fitted model keeps its summary, that keeps the session, and a
    session that has observed metrics can't be sent to tasks; so the model itself stays out of the plan."""
    values, cells = vector_to_array(x), model.coefficients.toArray().tolist()
    z = sum((values[i] * F.lit(b) for i, b in enumerate(cells)), F.lit(0.0)) + F.lit(float(model.intercept))
    return 1 / (1 + F.exp(-z))


def logistic(train: DataFrame, rows: DataFrame, features: list[str], label: str, weight: str | None = None) -> DataFrame:
    """ML-4, ML-2: rows with p, from a logistic regression on standardised features; null features count as 0."""
    fill = lambda d: d.na.fill(0, features)
    model = LogisticRegression(featuresCol="_x", labelCol=label, maxIter=50, regParam=1e-4, **({"weightCol": weight} if weight else {}))
    steps = [VectorAssembler(inputCols=features, outputCol="_raw"), StandardScaler(inputCol="_raw", outputCol="_x", withMean=True), model]
    *prepare, model = Pipeline(stages=steps).fit(fill(train)).stages
    return PipelineModel(prepare).transform(fill(rows)).withColumn("p", _chance(model, "_x")).drop("_raw", "_x")


def isotonic(train: DataFrame, rows: DataFrame, p: str, label: str, least: float = 0.005) -> DataFrame:
    """ML-5, ML-19: rows with a calibrated probability, kept within bounds."""
    fitted = IsotonicRegression(featuresCol=p, labelCol=label, predictionCol="_c").fit(train.withColumn(label, F.col(label).cast("double")))
    return fitted.transform(rows).withColumn("calibrated", F.greatest(F.lit(least), F.least(F.lit(1 - least), F.col("_c")))).drop("_c")


def horizon_calibrated(valid: DataFrame, rows: DataFrame, t: str, event: str, horizons: tuple[int, ...], prefix: str = "cox_p", least: float = 0.005) -> DataFrame:
    """ML-19: rows with p<h>, the chance of each horizon by an isotonic fit on the rows of valid whose label at h is known: an event by
    day h, or a duration beyond it. Chances don't fall with the horizon. Fits see counts per chance of three digits, not rows."""
    out, so_far = rows, []
    for h in horizons:
        churned = (F.col(event) == 1) & (F.col(t) <= h)
        known = valid.where(churned | (F.col(t) > h)).groupBy(F.round(f"{prefix}{h}", 3).alias("_p")).agg(F.avg(churned.cast("double")).alias("_y"), F.count("*").cast("double").alias("_w"))
        fitted = IsotonicRegression(featuresCol="_p", labelCol="_y", weightCol="_w", predictionCol="_c").fit(known)
        own = F.greatest(F.lit(least), F.least(F.lit(1 - least), F.col("_c")))
        out = fitted.transform(out.withColumn("_p", F.col(f"{prefix}{h}"))).withColumn(f"p{h}", F.greatest(own, *so_far) if so_far else own).drop("_p", "_c")
        so_far.append(F.col(f"p{h}"))
    return out


def segments(rows: DataFrame, features: list[str], ks: tuple[int, ...] = (3, 4, 5), seed: int = 7) -> DataFrame:
    """ML-10: k-means on standardised features, k by silhouette, segments numbered by size, the largest first."""
    prepared = Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="_raw"), StandardScaler(inputCol="_raw", outputCol="_x", withMean=True)]).fit(rows).transform(rows).drop("_raw")
    prepared = kept(prepared)
    best = None
    for k in ks:
        found = KMeans(k=k, seed=seed, featuresCol="_x", predictionCol="_k").fit(prepared).transform(prepared)
        quality = ClusteringEvaluator(featuresCol="_x", predictionCol="_k").evaluate(found)
        if best is None or quality > best[0]:
            best = (quality, k, found)
    sizes = best[2].groupBy("_k").agg(F.count("*").alias("_n")).withColumn("segment", F.row_number().over(Window.orderBy(F.desc("_n"), "_k")))
    return best[2].join(F.broadcast(sizes), "_k").drop("_k", "_n", "_x")


def screen(rows: DataFrame, features: list[str], missing: float = 0.4, mode: float = 0.95) -> DataFrame:
    """ML-11: a row per feature: share missing, share of the most frequent value, and whether it stays. Values are counted before they meet."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in features]))
    counts = rows.select(pairs.alias("p")).groupBy("p.feature", "p.value").agg(F.count("*").alias("n"))
    found = counts.groupBy("feature").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("nulls"), F.max(F.when(F.col("value").isNotNull(), F.col("n"))).alias("top"))
    return found.select("feature", F.round(F.col("nulls") / F.col("n"), 6).alias("missing"), F.round(F.coalesce("top", F.lit(0)) / F.col("n"), 6).alias("mode_share"), ((F.col("nulls") / F.col("n") <= missing) & (F.coalesce("top", F.lit(0)) / F.col("n") <= mode)).alias("stays"))


def dependent(rows: DataFrame, features: list[str], label: str, most: int = 50) -> dict[str, str]:
    """ML-11: features that are a function of another discrete one (at most `most` values), and of which: each value of the other goes with a
    single value. Of two that carry the same the one of less power alone goes. One pass counts the distinct partners of each value for
    all pairs; what the driver sees is a flag per pair.
    """
    counted = rows.agg(*[F.approx_count_distinct(c).alias(c) for c in features]).first()
    likely = [c for c in features if counted[c] <= 2 * most]
    if not likely:
        return {}
    tuples = kept(rows.groupBy(*likely).agg(F.count("*").alias("_n")))
    exact = tuples.agg(*[F.count_distinct(c).alias(c) for c in likely]).first()
    discrete = [c for c in likely if exact[c] <= most]
    if len(discrete) < 2:
        return {}
    cells = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y")) for a in discrete for b in discrete if a != b]))
    pairs = tuples.select(cells.alias("c")).select("c.*").where("x is not null and y is not null").distinct()
    partners = pairs.groupBy("a", "b", "y").agg(F.count("*").alias("k")).groupBy("a", "b").agg(F.max("k").alias("k"))
    function = {(r["a"], r["b"]) for r in partners.where("k = 1").collect()}
    long = rows.select(label, F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in discrete])).alias("c")).select(label, "c.*")
    power = {r["feature"]: abs((r["auc"] or 0.5) - 0.5) for r in auc(long, "x", label, ["feature"]).collect()}
    gone: dict[str, str] = {}
    for a in discrete:
        for b in discrete:
            if a == b or a in gone or b in gone or (a, b) not in function or ((b, a) in function and power.get(a, 0) > power.get(b, 0)):
                continue
            gone[a] = b
    return gone


def prune(ranked: list[str], score, tolerance: float) -> tuple[list[str], float, list[tuple[int, float]]]:
    """ML-14: the smallest number of first features of a ranking whose score is within `tolerance` of that of all, its score, and what was tried.

    score fits and scores a list of features, as Spark jobs; nested sets are tried from one feature on until one is good enough."""
    full, tried = score(ranked), []
    for k in range(1, len(ranked)):
        own = score(ranked[:k])
        tried.append((k, own))
        if own >= full - tolerance:
            return ranked[:k], own, tried
    return list(ranked), full, tried


def level_shift(rows: DataFrame, p: str, by: list[str], rate: str, steps: int = 40) -> DataFrame:
    """ML-7: the log-odds shift (within 2) that makes the mean probability of each group its rate, by bisection.

    Probabilities are binned to 1/1000 of log-odds once, so each step sums over few bins and the groups' arrays, not over rows.
    """
    logit = F.round(F.log(F.col(p) / (1 - F.col(p))), 3)
    bins = rows.groupBy(*by, rate, logit.alias("z")).agg(F.count("*").alias("n")).groupBy(*by, rate).agg(F.collect_list(F.struct("z", "n")).alias("b"), F.sum("n").alias("n"))
    mean = lambda s: F.aggregate("b", F.lit(0.0), lambda acc, x: acc + x["n"] / (1 + F.exp(-(x["z"] + s)))) / F.col("n")
    start = F.struct(F.lit(-2.0).alias("low"), F.lit(2.0).alias("high"))
    halve = lambda acc, _: F.when(mean((acc["low"] + acc["high"]) / 2) < F.col(rate), F.struct(((acc["low"] + acc["high"]) / 2).alias("low"), acc["high"].alias("high"))).otherwise(F.struct(acc["low"].alias("low"), ((acc["low"] + acc["high"]) / 2).alias("high")))
    return bins.select(*by, F.round(F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve)["low"], 4).alias("shift"))


def boosted(train: DataFrame, rows: DataFrame, features: list[str], label: str, valid: str, trees: int = 20, seed: int = 11) -> DataFrame:
    """ML-3, UDF-7: rows with p, from boosted trees that stop when the loss on the rows marked `valid` no longer falls. Null features are 0."""
    fill = lambda d: VectorAssembler(inputCols=features, outputCol="_x").transform(d.na.fill(0, features))
    model = GBTClassifier(featuresCol="_x", labelCol=label, maxIter=trees, maxDepth=4, stepSize=0.2, validationIndicatorCol=valid, seed=seed).fit(fill(train))
    return model.transform(fill(rows)).withColumn("p", vector_to_array("probability")[1]).drop("_x", "rawPrediction", "probability", "prediction")


def contributions(train: DataFrame, rows: DataFrame, features: list[str], label: str, top: int = 3) -> DataFrame:
    """ML-16: per row the terms beta * (x - mean) of a logistic regression and its strongest drivers as text."""
    fill = lambda d: VectorAssembler(inputCols=features, outputCol="_x").transform(d.na.fill(0, features))
    fitted = LogisticRegression(featuresCol="_x", labelCol=label, maxIter=50, regParam=1e-4).fit(fill(train))
    means = train.na.fill(0, features).agg(*[F.avg(c).alias(f"_mean_{c}") for c in features])
    terms = [(float(b) * (F.col(c) - F.col(f"_mean_{c}"))).alias(f"part_{c}") for b, c in zip(fitted.coefficients.toArray(), features)]
    found = attach(rows.na.fill(0, features), means, []).select(*rows.columns, *terms)
    cells = F.array_sort(F.array(*[F.struct((-F.abs(F.col(f"part_{c}"))).alias("size"), F.lit(c).alias("name"), (F.col(f"part_{c}") > 0).alias("up")) for c in features]))
    text = F.array_join(F.transform(F.slice(cells, 1, top), lambda e: F.concat(e["name"], F.when(e["up"], F.lit(" +")).otherwise(F.lit(" -")))), ", ")
    return found.withColumn("drivers", text)


def contribution_summary(found: DataFrame, features: list[str]) -> DataFrame:
    """RPT-9: per feature the mean size of its part, and whether high values raise it."""
    wide = found.agg(*[f for c in features for f in (F.avg(F.abs(f"part_{c}")).alias(f"{c}__m"), F.corr(F.col(c).cast("double"), F.col(f"part_{c}")).alias(f"{c}__r"))])
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.round(F.col(f"{c}__m"), 6).alias("mean_size"), F.when(F.col(f"{c}__r") > 0, "raises").otherwise("lowers").alias("direction")) for c in features])
    return wide.select(F.explode(cells).alias("p")).select("p.*")


def permuted(rows: DataFrame, feature: str, key: list[str], seed: int = 1) -> DataFrame:
    """rows whose values of a feature come from the next row of a random order, the last one's from the first. Places are found without
    ordering all rows in one task."""
    hashed = rows.withColumn("_h", F.xxhash64(*key, F.lit(seed))).withColumn("_k", F.xxhash64(*key, F.lit(seed + 1)))
    order = placed(hashed, [], "_h", "_k", descending=False)
    moved = order.select((F.col("place") % F.col("size") + 1).alias("place"), F.col(feature).alias("_moved"))
    return order.join(moved, "place").withColumn(feature, F.col("_moved")).select(rows.columns)


def permutation_importance(train: DataFrame, rows: DataFrame, features: list[str], label: str, key: list[str]) -> DataFrame:
    """ML-14: fall of the AUC when a feature's values are permuted, for a logistic model fitted once per call; a row per feature."""
    fill = lambda d: d.na.fill(0, features)
    steps = [VectorAssembler(inputCols=features, outputCol="_raw"), StandardScaler(inputCol="_raw", outputCol="_x", withMean=True), LogisticRegression(featuresCol="_x", labelCol=label, maxIter=50, regParam=1e-4)]
    *prepare, model = Pipeline(stages=steps).fit(fill(train)).stages
    score = lambda d: PipelineModel(prepare).transform(fill(d)).select(F.round(_chance(model, "_x"), 6).alias("p"), label)
    every = score(rows).withColumn("feature", F.lit(""))
    for c in features:
        every = every.unionByName(score(permuted(rows, c, key)).withColumn("feature", F.lit(c)))
    found = auc(every, "p", label, ["feature"]).select("feature", "auc")
    base = found.where("feature = ''").select(F.col("auc").alias("_base"))
    return attach(found.where("feature <> ''"), base, []).select("feature", F.round(F.col("_base") - F.col("auc"), 6).alias("fall"))


def platt(train: DataFrame, rows: DataFrame, p: str, label: str, least: float = 0.005) -> DataFrame:
    """ML-5: rows with a probability calibrated by a logistic regression on the log-odds."""
    logit = F.log(F.greatest(F.lit(1e-6), F.col(p)) / F.greatest(F.lit(1e-6), 1 - F.col(p)))
    prepare = lambda d: VectorAssembler(inputCols=["_z"], outputCol="_x").transform(d.withColumn("_z", logit))
    fitted = LogisticRegression(featuresCol="_x", labelCol=label, maxIter=50).fit(prepare(train))
    found = prepare(rows).withColumn("calibrated", F.greatest(F.lit(least), F.least(F.lit(1 - least), _chance(fitted, "_x"))))
    return found.select(*rows.columns, "calibrated")


def calibrator_choice(rows: DataFrame, p: str, label: str, who: str, folds: int = 3) -> DataFrame:
    """ML-6: the calibration error of isotonic and Platt calibration, fitted on other folds of players; the lesser one is chosen."""
    numbered = rows.withColumn("_fold", F.pmod(F.xxhash64(who), F.lit(folds)))
    parts = []
    for name, method in (("isotonic", isotonic), ("platt", platt)):
        scored = [method(numbered.where(F.col("_fold") != k), numbered.where(F.col("_fold") == k), p, label).select("calibrated", label) for k in range(folds)]
        every = scored[0]
        for more in scored[1:]:
            every = every.unionByName(more)
        parts.append(calibration(every, "calibrated", label).agg(F.lit(name).alias("calibrator"), F.round(F.sum(F.col("n") * F.col("gap")) / F.sum("n"), 6).alias("ece")))
    both = parts[0].unionByName(parts[1])
    return attach(both, both.agg(F.min(F.struct("ece", "calibrator")).alias("_best")), []).select("calibrator", "ece", (F.col("calibrator") == F.col("_best.calibrator")).alias("chosen"))


def calibrated_by(train: DataFrame, rows: DataFrame, p: str, label: str, group: str, least: int = 500) -> DataFrame:
    """ML-5: calibration per group with `least` rows or more of two classes, else over all. Groups are a bounded list (brands)."""
    counts = train.groupBy(group).agg(F.count("*").alias("n"), F.countDistinct(label).alias("k"))
    own = [r[0] for r in counts.where((F.col("n") >= least) & (F.col("k") == 2)).orderBy(group).collect()]
    others = ~F.col(group).isin(own) if own else F.lit(True)
    found = isotonic(train, rows.where(others | F.col(group).isNull()), p, label)
    for g in own:
        found = found.unionByName(isotonic(train.where(F.col(group) == g), rows.where(F.col(group) == g), p, label))
    return found


def correlated(rows: DataFrame, features: list[str], label: str, limit: float = 0.95) -> DataFrame:
    """ML-12: pairs of features with their correlation and, over the limit, the one of lower AUC (distance from a half), which is dropped."""
    cast = rows.select(label, *[F.col(c).cast("double").alias(c) for c in features]).na.drop()
    pairs = [(a, b) for i, a in enumerate(features) for b in features[i + 1 :]]
    wide = cast.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    long = wide.select(F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"{a}__{b}").alias("r")) for a, b in pairs])).alias("p")).select("p.*")
    power = auc(cast.unpivot([label], features, "feature", "x"), "x", label, ["feature"]).select("feature", F.abs(F.col("auc") - 0.5).alias("power"))
    both = attach(attach(long, power.select(F.col("feature").alias("a"), F.col("power").alias("pa")), ["a"]), power.select(F.col("feature").alias("b"), F.col("power").alias("pb")), ["b"])
    return both.select("a", "b", F.round("r", 6).alias("r"), F.when(F.abs("r") > limit, F.when(F.col("pa") < F.col("pb"), F.col("a")).otherwise(F.col("b"))).alias("dropped"))


def _tree(x: np.ndarray, rng: np.random.Generator, depth: int) -> list:
    if depth == 0 or len(x) <= 1 or (np.ptp(x, axis=0) == 0).all():
        return [len(x)]
    wide = np.flatnonzero(np.ptp(x, axis=0) > 0)
    f = int(rng.choice(wide))
    cut = float(rng.uniform(x[:, f].min(), x[:, f].max()))
    left = x[:, f] < cut
    return [f, cut, _tree(x[left], rng, depth - 1), _tree(x[~left], rng, depth - 1)]


def _mean_depth(n: int) -> float:
    """Mean depth of a failed search among n values."""
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def _depths(tree: list, x: np.ndarray, at: float = 0.0) -> np.ndarray:
    if len(tree) == 1:
        return np.full(len(x), at + _mean_depth(tree[0]))
    f, cut, low, high = tree
    out, left = np.empty(len(x)), x[:, f] < cut
    out[left], out[~left] = _depths(low, x[left], at + 1), _depths(high, x[~left], at + 1)
    return out


def isolation_forest(rows: DataFrame, features: list[str], key: list[str], trees: int = 200, sample: int = 256, share: float = 0.005) -> DataFrame:
    """ANOM-3: rows with an anomaly score and whether it is among the highest share, on signed logs of the features.

    A tree learns from about `sample` rows that a hash takes for it, so trees are small groups; their nodes are a bounded list for the
    driver. Null features count as 0.
    """
    signed = [(F.signum(F.coalesce(F.col(c).cast("double"), F.lit(0.0))) * F.log1p(F.abs(F.coalesce(F.col(c).cast("double"), F.lit(0.0))))).alias(f"_{i}") for i, c in enumerate(features)]
    logged = rows.select("*", *signed)
    names = [f"_{i}" for i in range(len(features))]
    n = rows.count()
    if not n:
        return rows.withColumn("score", F.lit(0.0)).withColumn("outlier", F.lit(False))
    rate = min(1.0, sample / n)
    picks = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.pmod(F.xxhash64(*key, t), F.lit(1_000_003)) < F.lit(rate * 1_000_003))
    drawn = logged.select(*key, *names, F.explode(picks).alias("tree"))

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(key)
        t = int(group["tree"].iloc[0])
        return pd.DataFrame({"tree": [t], "nodes": [json.dumps(_tree(group[names].to_numpy(float), np.random.default_rng(t), max(1, math.ceil(math.log2(sample)))))]})

    forest = [json.loads(r.nodes) for r in drawn.groupBy("tree").applyInPandas(grow, "tree int, nodes string").orderBy("tree").collect()]
    usual = _mean_depth(min(sample, n))

    def score(batches):
        for batch in batches:
            x = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names], axis=1)
            depth = np.mean([_depths(t, x) for t in forest], axis=0) if forest else np.zeros(len(x))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in key], pa.array(2.0 ** (-depth / max(usual, 1e-9)))], names=[*key, "score"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name in key)
    scored = rows.join(logged.select(*key, *names).mapInArrow(score, f"{kinds}, score double"), key)
    cut = quantiles(scored, "score", [], [1 - share]).select(F.col("q")[0].alias("_cut"))
    return attach(scored, cut, []).withColumn("outlier", F.col("score") > F.col("_cut")).drop("_cut")

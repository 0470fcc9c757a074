"""Survival checks: censoring weights, time-dependent AUC and Brier score, calibration, bootstraps, Cox regression.

Durations are whole days, so everything works on counts per day and score, not on rows.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranks import attach, average_rank, bin_of, correlation, inner_edges, running
from .shapes import normal_quantile


def curve(rows: DataFrame, t: str, event: str, by: list[str]) -> DataFrame:
    """(by, t, before, after): Kaplan-Meier survival just before and just after each day t that occurs."""
    per = rows.groupBy(*by, F.col(t).alias("t")).agg(F.sum(F.col(event).cast("long")).alias("d"), F.count("*").alias("n"))
    order = Window.partitionBy(*by).orderBy("t")
    per = per.withColumn("at_risk", F.sum("n").over(order.rowsBetween(0, Window.unboundedFollowing)))
    step = F.when(F.col("d") < F.col("at_risk"), F.log(1 - F.col("d") / F.col("at_risk"))).otherwise(-1e9)
    up_to = F.sum(step).over(order.rowsBetween(Window.unboundedPreceding, 0))
    per = per.withColumn("after", F.exp(up_to))
    return per.select(*by, "t", F.coalesce(F.lag("after").over(order), F.lit(1.0)).alias("before"), "after")


def median_lifetime(rows: DataFrame, t: str, event: str, by: list[str]) -> DataFrame:
    """EVAL-12: the first day at which survival is a half or less; null if it never is."""
    return curve(rows, t, event, by).groupBy(*by).agg(F.min(F.when(F.col("after") <= 0.5, F.col("t"))).alias("median_days"), F.round(F.min("after"), 6).alias("last_survival"))


def weighted(rows: DataFrame, t: str, event: str, by: list[str], least: float = 1e-6) -> DataFrame:
    """EVAL-6: rows with g_before and g_after, the chance not to be censored before and after their day (at least `least`)."""
    g = curve(rows.withColumn("_censored", 1 - F.col(event)), t, "_censored", by)
    g = g.select(*by, F.col("t").alias(t), F.greatest("before", F.lit(least)).alias("g_before"), F.greatest("after", F.lit(least)).alias("g_after"))
    return rows.join(g, [*by, t])


def auc_at(rows: DataFrame, t: str, event: str, risk: str, by: list[str], horizons: tuple[int, ...] = (7, 14, 30, 60)) -> DataFrame:
    """EVAL-7: cases (event by the horizon, weighted by 1 / g) against those who last longer; ties count half."""
    w = weighted(rows, t, event, by)
    long = w.withColumn("h", F.explode(F.array(*[F.lit(h) for h in horizons])))
    case = (F.col(t) <= F.col("h")) & (F.col(event) == 1)
    per = long.groupBy(*by, "h", F.col(risk).alias("r")).agg(F.sum(F.when(case, 1 / F.col("g_before")).otherwise(0.0)).alias("w"), F.count_if(F.col(t) > F.col("h")).alias("n"))
    per = running(per, [*by, "h"], "r", {"lower": F.col("n")})
    found = per.groupBy(*by, "h").agg(F.sum(F.col("w") * (F.col("lower") + F.col("n") / 2)).alias("good"), F.sum("w").alias("cases"), F.sum("n").alias("controls"))
    pairs = F.col("cases") * F.col("controls")
    return found.select(*by, F.col("h").alias("horizon"), "controls", F.round(F.col("good") / F.when(pairs > 0, pairs), 6).alias("auc"))


def brier(rows: DataFrame, t: str, event: str, survival, by: list[str], grid: list[int], least: float = 1e-6) -> DataFrame:
    """EVAL-9: weighted Brier score at each day of a grid. survival(day) gives the predicted survival of a row as a column.

    Those with an event by the day count with 1 / G just before their own day, those who last longer with 1 / G at the day of the grid,
    where G is the chance not to be censored."""
    days = F.explode(F.array(*[F.lit(g) for g in grid]))
    g = curve(rows.withColumn("_censored", 1 - F.col(event)), t, "_censored", by).withColumn("day", days)
    # G falls, so its last value by a day is the least one. A grid day before all others has 1.
    at = g.groupBy(*by, "day").agg(F.greatest(F.coalesce(F.min(F.when(F.col("t") <= F.col("day"), F.col("after"))), F.lit(1.0)), F.lit(least)).alias("g_day"))
    w = attach(weighted(rows, t, event, by, least).withColumn("day", days), at, [*by, "day"])
    s = survival(F.col("day"))
    died = (F.col(t) <= F.col("day")) & (F.col(event) == 1)
    score = F.when(died, s * s / F.col("g_before")).when(F.col(t) > F.col("day"), (1 - s) * (1 - s) / F.col("g_day")).otherwise(0.0)
    return w.groupBy(*by, "day").agg(F.avg(score).alias("brier"))


def integrated(scores: DataFrame, by: list[str]) -> DataFrame:
    """EVAL-9: trapezoid mean of the curve over its days; the grid has few."""
    order = Window.partitionBy(*by).orderBy("day")
    width = F.col("day") - F.lag("day").over(order)
    area = scores.withColumn("_w", width).withColumn("_a", width * (F.col("brier") + F.lag("brier").over(order)) / 2)
    return area.groupBy(*by).agg(F.round(F.sum("_a") / F.sum("_w"), 6).alias("integrated_brier"))


def chi2_tail(x: Column, df: Column, terms: int = 400) -> Column:
    """The chance that a chi-square of df degrees of freedom exceeds x, by the series of the incomplete gamma function.

    The series of z = x/2 has what counts within z + 12 sqrt(z) terms or so; beyond x = 400 the tail is 0 to 15 digits for up to 40 degrees."""
    a, z = df / 2.0, F.least(x, F.lit(400.0)) / 2.0
    # Gamma(a + 1) from Gamma(1) = 1 or Gamma(1/2) = sqrt(pi).
    half = (df.cast("int") % 2) == 1
    gamma = F.aggregate(F.sequence(F.lit(0), F.floor(a).cast("int")), F.when(half, F.lit(math.sqrt(math.pi))).otherwise(1.0), lambda g, k: F.when(half, g * (k + 0.5)).when(k > 0, g * k).otherwise(g))
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))
    added = F.aggregate(F.sequence(F.lit(1), F.lit(terms)), start, lambda acc, k: F.struct((acc["term"] * z / (a + k)).alias("term"), (acc["sum"] + acc["term"] * z / (a + k)).alias("sum")))
    lower = F.exp(a * F.log(z) - z) / gamma * added["sum"]
    return F.when(x <= 0, 1.0).when(x > 400, 0.0).otherwise(F.greatest(F.lit(0.0), 1 - lower))


def calibration_groups(rows: DataFrame, t: str, event: str, p: str, horizon: int, by: list[str], groups: int = 10) -> DataFrame:
    """EVAL-8: per group of predicted risk, between its quantiles, the mean prediction against 1 - Kaplan-Meier at the horizon."""
    edges = inner_edges(rows, p, by, groups)
    grouped = attach(rows, edges, by).withColumn("g", bin_of(F.col(p))).drop("edges")
    km = curve(grouped, t, event, [*by, "g"]).where(F.col("t") <= horizon).groupBy(*by, "g").agg(F.min("after").alias("s"))
    means = grouped.groupBy(*by, "g").agg(F.count("*").alias("n"), F.avg(p).alias("predicted"))
    return means.join(km, [*by, "g"], "left").withColumn("observed", 1 - F.coalesce("s", F.lit(1.0))).drop("s")


def one_calibration(rows: DataFrame, t: str, event: str, p: str, horizon: int, by: list[str], groups: int = 10) -> DataFrame:
    """EVAL-8: (by, groups, statistic, p_value, mean_abs_gap) of the D'Agostino-Nam test at a day: n (observed - predicted)^2 over
    predicted (1 - predicted), summed over the groups, against a chi-square of one degree less than there are groups."""
    g = calibration_groups(rows, t, event, p, horizon, by, groups)
    q = F.greatest(F.col("predicted") * (1 - F.col("predicted")), F.lit(1e-12))
    found = g.groupBy(*by).agg(
        F.count("*").alias("groups"), F.sum(F.col("n") * (F.col("observed") - F.col("predicted")) ** 2 / q).alias("statistic"), (F.sum(F.col("n") * F.abs(F.col("observed") - F.col("predicted"))) / F.sum("n")).alias("mean_abs_gap")
    )
    return found.withColumn("p_value", chi2_tail(F.col("statistic"), F.greatest(F.col("groups") - 1, F.lit(1))))


#: Chances that a Poisson count of mean 1 is at most 0, 1, 2, 3, 4, 5.
POISSON = (0.367879441, 0.735758882, 0.919698603, 0.981011843, 0.996340153, 0.999405815)


def bootstrap_mean(rows: DataFrame, x: str, key, replicas: int = 200, prime: int = 10007) -> DataFrame:
    """EVAL-10: the mean of x in each replica, rows counted by Poisson weights that a whole-number key and the replica give."""
    u = F.pmod(F.col("_key") * F.lit(7919) + F.col("replica") * F.lit(104729) + F.pmod(F.col("_key") * F.col("replica"), F.lit(9973)) * 31, F.lit(prime)) / F.lit(float(prime))
    long = rows.select(F.col(x).alias("_x"), key.cast("long").alias("_key"), F.explode(F.sequence(F.lit(1), F.lit(replicas))).alias("replica"))
    weight = sum((F.when(u >= c, 1).otherwise(0) for c in POISSON[1:]), F.when(u >= POISSON[0], 1).otherwise(0))
    return long.withColumn("_w", weight).groupBy("replica").agg(F.sum("_w").alias("n"), (F.sum(F.col("_w") * F.col("_x")) / F.sum("_w")).alias("mean"))


def poisson(mean: Column, u: Column) -> Column:
    """A Poisson count from a uniform number: by its distribution up to a mean of 20, by the normal one beyond."""
    start = F.struct(F.exp(-mean).alias("term"), F.exp(-mean).alias("sum"), (u >= F.exp(-mean)).cast("int").alias("n"))

    def more(acc: Column, k: Column) -> Column:
        term = acc["term"] * mean / k
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"), (acc["n"] + (u >= acc["sum"] + term).cast("int")).alias("n"))

    small = F.aggregate(F.sequence(F.lit(1), F.ceil(mean + 9 * F.sqrt(mean) + 9).cast("int")), start, more)["n"]
    return F.when(mean <= 20, small).otherwise(F.greatest(F.lit(0), F.round(mean + F.sqrt(mean) * normal_quantile(u)).cast("int")))


def bootstrap_ranks(rows: DataFrame, score: str, label: str, by: list[str], replicas: int = 200, share: float = 0.1, seed: int = 42) -> DataFrame:
    """EVAL-10: (by, replica, auc, average_precision, top_precision) of resampled rows; replica 0 is the rows themselves.

    Resampling n rows draws each about Poisson(1) times, so all equal (score, label) together about Poisson(count) times: a replica
    costs as many draws as there are distinct scores, not rows. Rows of the score that the top share ends in count in proportion."""
    counts = rows.where(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(*by, F.col(score).alias("s")).agg(F.sum(F.col(label)).cast("long").alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    long = counts.withColumn("replica", F.explode(F.sequence(F.lit(0), F.lit(replicas))))
    u = lambda k: (F.pmod(F.xxhash64(*by, "s", "replica", F.lit(seed + k)), F.lit(2**31 - 1)) + 0.5) / F.lit(float(2**31 - 1))
    drawn = lambda c, k: F.when((F.col("replica") == 0) | (F.col(c) == 0), F.col(c)).otherwise(poisson(F.col(c).cast("double"), u(k))).cast("long")
    keys = [*by, "replica"]
    long = long.select(*keys, "s", drawn("pos", 1).alias("pos"), drawn("neg", 2).alias("neg")).where("pos + neg > 0")
    # From the highest score down: positives and rows above each score.
    found = running(long, keys, "s", {"tp": F.col("pos"), "above": F.col("pos") + F.col("neg")}, descending=True)
    n, every = F.col("pos") + F.col("neg"), F.col("above_all")
    lower = (F.col("above_all") - F.col("tp_all")) - (F.col("above") - F.col("tp")) - F.col("neg")
    top = F.greatest(F.lit(1), F.floor(every * share + 0.5))
    held = F.greatest(F.lit(0), F.least(n, top - F.col("above"))) / n
    pairs = F.max("tp_all") * (F.max("above_all") - F.max("tp_all"))
    return found.groupBy(*keys).agg(
        (F.sum(F.col("pos") * (lower + F.col("neg") / 2)) / F.when(pairs > 0, pairs)).alias("auc"), (F.sum(F.col("pos") * (F.col("tp") + F.col("pos")) / (F.col("above") + n)) / F.max(F.when(F.col("tp_all") > 0, F.col("tp_all")))).alias("average_precision"),
        (F.sum(F.col("pos") * held) / F.max(top)).alias("top_precision"),
    )


def intervals(found: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """(by, statistic, value, low, high): each column at replica 0, and the 2.5% and 97.5% points of it over the others."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("statistic"), F.col(c).alias("x")) for c in columns]))
    long = found.select(*by, "replica", cells.alias("c")).select(*by, "replica", "c.*")
    q = lambda share: F.percentile(F.when(F.col("replica") > 0, F.col("x")), share)
    return long.groupBy(*by, "statistic").agg(F.max(F.when(F.col("replica") == 0, F.col("x"))).alias("value"), q(0.025).alias("low"), q(0.975).alias("high"))


def block_bootstrap(values: DataFrame, x: str, order: str, block: int = 3, replicas: int = 2000) -> DataFrame:
    """EVAL-11: means of circular blocks of consecutive values (a row per cutoff), as many as there are values, per replica."""
    numbered = values.withColumn("_i", F.row_number().over(Window.orderBy(order)) - 1)
    n = values.agg(F.count("*").alias("_n"))
    draws = values.sparkSession.range(1, replicas + 1).select(F.col("id").alias("replica")).join(F.broadcast(n))
    draws = draws.select("*", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_k"))
    start = F.pmod(F.col("replica") * 7919 + F.floor(F.col("_k") / block) * 104729 + F.pmod(F.col("replica") * F.floor(F.col("_k") / block), F.lit(9973)) * 31, F.col("_n"))
    picked = draws.select("replica", F.pmod(start + F.pmod(F.col("_k"), F.lit(block)), F.col("_n")).cast("int").alias("_i"))
    return picked.join(F.broadcast(numbered), "_i").groupBy("replica").agg(F.avg(x).alias("mean"))


def _risk_sums(rows: DataFrame, t: str, event: str, features: list[str], by: list[str], beta: np.ndarray) -> DataFrame:
    """Per day of each stratum: events, sums of features over events, and over all still at risk the sums of exp(bx), x exp(bx), xx' exp(bx)."""
    k = len(features)
    e = F.exp(sum((float(b) * F.col(c) for b, c in zip(beta, features)), F.lit(0.0)))
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    died = F.col(event) == 1
    sums = [F.count_if(died).alias("d"), F.sum(e).alias("s0")] + [F.sum(F.when(died, F.col(c)).otherwise(0.0)).alias(f"x{i}") for i, c in enumerate(features)]
    sums += [F.sum(F.col(c) * e).alias(f"s1_{i}") for i, c in enumerate(features)] + [F.sum(F.col(features[i]) * F.col(features[j]) * e).alias(f"s2_{i}_{j}") for i, j in pairs]
    per = rows.groupBy(*by, F.col(t).alias("t")).agg(*sums)
    later = Window.partitionBy(*by).orderBy("t").rowsBetween(0, Window.unboundedFollowing)
    at_risk = ["s0", *[f"s1_{i}" for i in range(k)], *[f"s2_{i}_{j}" for i, j in pairs]]
    return per.select(*by, "t", "d", *[f"x{i}" for i in range(k)], *[F.sum(c).over(later).alias(c) for c in at_risk])


def cox(rows: DataFrame, t: str, event: str, features: list[str], by: list[str], penalty: float = 0.0, steps: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """ML-17: coefficients and their covariance of a stratified Cox regression (Breslow ties) by Newton steps. A step is one
    aggregation to sums per day, reverse running sums, and one small row for the driver. Features should be standardised; the
    penalty is half the squared length of the coefficients, times `penalty` and the number of rows."""
    k = len(features)
    beta = np.zeros(k)
    penalty = penalty * rows.count() if penalty else 0.0
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    for _ in range(steps):
        sums = _risk_sums(rows, t, event, features, by, beta).where("d > 0")
        d, s0 = F.col("d"), F.col("s0")
        gradient = [F.sum(F.col(f"x{i}") - d * F.col(f"s1_{i}") / s0) for i in range(k)]
        hessian = [F.sum(d * (F.col(f"s2_{i}_{j}") / s0 - F.col(f"s1_{i}") * F.col(f"s1_{j}") / (s0 * s0))) for i, j in pairs]
        row = sums.agg(*[c.alias(f"c{i}") for i, c in enumerate([*gradient, *hessian])]).first()
        if row[0] is None:
            return beta, np.full((k, k), np.nan)
        g = np.array(row[:k]) - penalty * beta
        h = np.zeros((k, k))
        for (i, j), v in zip(pairs, row[k:]):
            h[i, j] = h[j, i] = v
        h += penalty * np.eye(k)
        step = np.linalg.solve(h, g)
        beta = beta + step
        if np.abs(step).max() < 1e-8:
            break
    return beta, np.linalg.inv(h)


def linear(features: list[str], beta: np.ndarray) -> Column:
    return sum((float(b) * F.col(c) for b, c in zip(beta, features)), F.lit(0.0))


def baseline(rows: DataFrame, t: str, event: str, features: list[str], by: list[str], beta: np.ndarray) -> DataFrame:
    """(by, t, hazard): Breslow's cumulative baseline hazard after each day with events: events over the risk still there, summed up."""
    per = rows.groupBy(*by, F.col(t).alias("t")).agg(F.count_if(F.col(event) == 1).alias("d"), F.sum(F.exp(linear(features, beta))).alias("e"))
    days = Window.partitionBy(*by).orderBy("t")
    per = per.withColumn("s0", F.sum("e").over(days.rowsBetween(0, Window.unboundedFollowing))).where("d > 0")
    return per.select(*by, "t", F.sum(F.col("d") / F.col("s0")).over(days.rowsBetween(Window.unboundedPreceding, 0)).alias("hazard"))


def horizon_risks(rows: DataFrame, hazard: DataFrame, features: list[str], by: list[str], beta: np.ndarray, horizons: tuple[int, ...] = (7, 14, 30, 60)) -> DataFrame:
    """rows with cox_p<h> = 1 - S(h) = 1 - exp(-H(h) exp(bx)) for each horizon, H(h) being the last baseline hazard of the row's stratum by h.

    A stratum without baseline has null; before its first event the hazard is 0."""
    at = hazard.groupBy(*by).agg(*[F.coalesce(F.max(F.when(F.col("t") <= h, F.col("hazard"))), F.lit(0.0)).alias(f"_h{h}") for h in horizons], F.max("hazard").alias("_last"))
    keys = F.exp(linear(features, beta))
    known = attach(rows, at, by, "left") if by else rows.join(F.broadcast(at))
    return known.select(*rows.columns, *[(1 - F.exp(-F.col(f"_h{h}") * keys)).alias(f"cox_p{h}") for h in horizons])


def median_survival(rows: DataFrame, hazard: DataFrame, features: list[str], by: list[str], beta: np.ndarray) -> DataFrame:
    """ML-21: rows with median_days, the first day at which the predicted survival is a half or less; null if none is. A stratum's baseline has a
    value per day, so it is a bounded array."""
    steps = hazard.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("t", "hazard"))).alias("_steps"))
    need = F.log(F.lit(2.0)) / F.exp(linear(features, beta))
    found = attach(rows, steps, by, "left") if by else rows.join(F.broadcast(steps))
    return found.withColumn("median_days", F.get(F.filter("_steps", lambda s: s["hazard"] >= need), F.lit(0))["t"]).drop("_steps")


def penalty_path(train: DataFrame, valid: DataFrame, t: str, event: str, features: list[str], by: list[str], grid: tuple[float, ...]) -> tuple[list[tuple[float, float]], float, np.ndarray]:
    """ML-17: (penalty, c-index on valid) for each penalty of a grid, the best one (of equals the least) and its coefficients."""
    from .evaluate import concordance

    found = []
    for penalty in grid:
        beta, _ = cox(train, t, event, features, by, penalty)
        c = concordance(valid.withColumn("_risk", F.round(linear(features, beta), 2)).withColumn("_all", F.lit(0)), t, event, "_risk", ["_all"]).first()["c_index"]
        found.append((penalty, float(c) if c is not None else float("nan"), beta))
    best = max(found, key=lambda f: (f[1] if f[1] == f[1] else -1.0, -f[0]))
    return [f[:2] for f in found], best[0], best[2]


#: Windows of the event's day: day 0 is an event on the cutoff itself.
PH_WINDOWS = ((-1, 0, "day 0"), (0, 7, "1 to 7"), (7, 30, "8 to 30"), (30, 90, "31 to 90"), (90, 10_000, "over 90"))


def proportional_hazards(rows: DataFrame, t: str, event: str, features: list[str], by: list[str], beta: np.ndarray, cov: np.ndarray, least: float = 0.05, ratio: float = 1.5) -> DataFrame:
    """ML-20: per feature beta, beta(t) in each window of days, the Spearman correlation of its residuals with the day, and a verdict.

    The residual of an event is its features less their mean over all at risk that day in its stratum; scaled, it is that times the
    covariance and the number of events, and its mean in a window is what beta lacks there. The verdict is negligible if all |beta(t)|
    are below `least`, sign changes if some are above it on both sides, changes size if the largest is over `ratio` times the smallest
    of those above it, stable else. Ranks come from counts per value; windows without events are null and don't count.
    """
    k = len(features)
    sums = _risk_sums(rows, t, event, features, by, beta).where("d > 0")
    means = sums.select(*by, F.col("t").alias(t), *[(F.col(f"s1_{i}") / F.col("s0")).alias(f"_m{i}") for i in range(k)])
    died = attach(rows.where(F.col(event) == 1), means, [*by, t])
    n = int(sums.agg(F.sum("d")).first()[0] or 0)
    off = [F.col(c) - F.col(f"_m{i}") for i, c in enumerate(features)]
    scaled = [sum((float(n * cov[i, j]) * off[i] for i in range(k)), F.lit(0.0)) for j in range(k)]
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.lit(float(b)).alias("beta"), F.round(r, 9).alias("residual")) for c, b, r in zip(features, beta, scaled)]))
    long = died.select(F.col(t).cast("double").alias("day"), cells.alias("c")).select("day", "c.*")
    within = lambda low, high: (F.col("day") > low) & (F.col("day") <= high)
    windows = long.groupBy("feature", "beta").agg(F.count("*").alias("events"), *[(F.avg(F.when(within(a, b), F.col("residual"))) + F.first("beta")).alias(name) for a, b, name in PH_WINDOWS])
    ranked = average_rank(average_rank(long, ["feature"], "residual", "rank_r"), ["feature"], "day", "rank_t")
    rho = ranked.groupBy("feature").agg(correlation("rank_r", "rank_t").alias("rho"))
    values = F.array_compact(F.array(*[F.col(name) for _, _, name in PH_WINDOWS]))
    big = F.transform(F.filter(values, lambda b: F.abs(b) >= least), lambda b: F.abs(b))
    verdict = F.when(F.forall(values, lambda b: F.abs(b) < least), "negligible").when(F.exists(values, lambda b: b > least) & F.exists(values, lambda b: b < -least), "sign changes")
    verdict = verdict.when(F.array_max(big) / F.array_min(big) > ratio, "changes size").otherwise("stable")
    return windows.join(rho, "feature").withColumn("verdict", verdict)


def schoenfeld(rows: DataFrame, t: str, event: str, features: list[str], by: list[str], beta: np.ndarray, width: int = 30) -> DataFrame:
    """ML-20: per feature and window of days, events and the mean residual of events: the feature less its mean over those at risk."""
    sums = _risk_sums(rows, t, event, features, by, beta).where("d > 0")
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), (F.col(f"x{i}") - F.col("d") * F.col(f"s1_{i}") / F.col("s0")).alias("r")) for i, c in enumerate(features)]))
    return sums.select(F.floor(F.col("t") / width).cast("int").alias("window"), "d", cells.alias("c")).groupBy("c.feature", "window").agg(F.sum("d").alias("events"), F.round(F.sum("c.r") / F.sum("d"), 6).alias("mean_residual"))

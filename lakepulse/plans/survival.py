"""Queries on survival checks, spells, replays and comparisons of rankings."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from lakepulse.operators import activity as act
from lakepulse.operators import evaluate as ev
from lakepulse.operators import labels, survival
from lakepulse.operators.ranks import quantiles
from lakepulse.sources import lens
from lakepulse.sources.lake import kept
from lakepulse.sources.lens import with_

from . import players as pl
from .registry import query


def _km(name: str, source: str, t: str, e: str, by: str) -> str:
    """Kaplan-Meier before and after each day as DuckDB expressions."""
    return f"""{name}_c AS (SELECT {by}, {t} AS t, sum({e}) AS d, count(*) AS n FROM {source} GROUP BY ALL), {name}_r AS (SELECT *, sum(n) OVER (PARTITION BY {by} ORDER BY t DESC) AS at_risk FROM {name}_c),
{name}_a AS (SELECT *, exp(sum(CASE WHEN d < at_risk THEN ln(1 - d / at_risk) ELSE -1e9 END) OVER (PARTITION BY {by} ORDER BY t)) AS after FROM {name}_r), {name} AS (SELECT {by}, t, coalesce(lag(after) OVER (PARTITION BY {by} ORDER BY t), 1.0) AS before, after FROM {name}_a)"""


SURVIVAL = f"{pl.SCORED}, sv AS (SELECT *, 1 - event_observed AS censored FROM sc), {_km('km', 'sv', 'duration_days', 'event_observed', 'brand')}, {_km('cg', 'sv', 'duration_days', 'censored', 'brand')}, wt AS (SELECT sv.*, greatest(before, 1e-6) AS g_before FROM sv JOIN cg ON cg.brand = sv.brand AND cg.t = sv.duration_days)"


@query("eval_12_median_lifetime", with_("activity") + f", {SURVIVAL} SELECT brand, CAST(min(t) FILTER (after <= 0.5) AS INT) AS median_days, round(min(after), 6) AS last_survival FROM km GROUP BY brand")
def eval_12(spark, d):
    """EVAL-12"""
    return survival.median_lifetime(pl.scored(spark, d), "duration_days", "event_observed", ["brand"])


@query("eval_6_weights", with_("activity") + f", {SURVIVAL} SELECT brand, cutoff, count(*) AS n, round(sum(event_observed / g_before), 4) AS weighted_events, round(max(1 / g_before), 6) AS max_weight FROM wt GROUP BY ALL")
def eval_6_weights(spark, d):
    """EVAL-6: censoring weights 1 / G(T-)."""
    w = survival.weighted(pl.scored(spark, d), "duration_days", "event_observed", ["brand"])
    return w.groupBy("brand", "cutoff").agg(F.count("*").alias("n"), F.round(F.sum(F.col("event_observed") / F.col("g_before")), 4).alias("weighted_events"), F.round(F.max(1 / F.col("g_before")), 6).alias("max_weight"))


@query("eval_7_time_auc", with_("activity") + f""", {SURVIVAL}, l AS (SELECT brand, s, duration_days, event_observed, g_before, unnest([7, 14, 30, 60]) AS h FROM wt), p AS (SELECT brand, h, s, sum(CASE WHEN duration_days <= h AND event_observed = 1 THEN 1 / g_before ELSE 0 END) AS w, count(*) FILTER (duration_days > h) AS n FROM l GROUP BY ALL),
q AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY brand, h ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lower_ FROM p)
SELECT brand, h AS horizon, CAST(sum(n) AS BIGINT) AS controls, round(sum(w * (lower_ + n / 2)) / nullif(sum(w) * sum(n), 0), 6) AS auc FROM q GROUP BY ALL""")
def eval_7(spark, d):
    """EVAL-7"""
    return survival.auc_at(pl.scored(spark, d), "duration_days", "event_observed", "s", ["brand"])


GRID = [30, 60, 90, 120, 150, 180]
BRIER = f"b AS (SELECT brand, p, duration_days, event_observed, g_before, unnest({GRID}) AS day FROM wt), gd AS (SELECT k.brand, d.day, greatest(coalesce(min(after) FILTER (t <= d.day), 1), 1e-6) AS g_day FROM cg k, (SELECT unnest({GRID}) AS day) d GROUP BY ALL), bs AS (SELECT *, power(1 - greatest(0.01, least(0.99, p)), day / 60.0::DOUBLE) AS sp FROM b), bc AS (SELECT brand, day, avg(CASE WHEN duration_days <= day AND event_observed = 1 THEN sp * sp / g_before WHEN duration_days > day THEN (1 - sp) * (1 - sp) / g_day ELSE 0 END) AS brier FROM bs JOIN gd USING (brand, day) GROUP BY ALL)"


def _brier(spark, d):
    p = F.greatest(F.lit(0.01), F.least(F.lit(0.99), F.col("p")))
    return survival.brier(pl.scored(spark, d), "duration_days", "event_observed", lambda day: F.pow(1 - p, day / F.lit(60.0)), ["brand"], GRID)


@query("eval_9_brier_curve", with_("activity") + f", {SURVIVAL}, {BRIER} SELECT brand, day, round(brier, 6) AS brier FROM bc")
def eval_9(spark, d):
    """EVAL-9"""
    return _brier(spark, d).withColumn("brier", F.round("brier", 6))


@query("eval_9_integrated_brier", with_("activity") + f", {SURVIVAL}, {BRIER}, x AS (SELECT brand, day - lag(day) OVER w AS w_, (day - lag(day) OVER w) * (brier + lag(brier) OVER w) / 2 AS a FROM bc WINDOW w AS (PARTITION BY brand ORDER BY day)) SELECT brand, round(sum(a) / sum(w_), 6) AS integrated_brier FROM x GROUP BY brand")
def eval_9_integrated(spark, d):
    return survival.integrated(_brier(spark, d), ["brand"])


#: Groups of p between its distinct quantiles, the least and greatest of which are no edges.
GROUPS = "eg AS (SELECT brand, list_distinct(quantile_cont(p, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1])) AS q FROM sc GROUP BY brand), gr AS (SELECT sc.*, len(list_filter(list_sort(q)[2:len(q) - 1], lambda x: x < p)) AS g FROM sc JOIN eg USING (brand))"


@query("eval_8_one_calibration", with_("activity") + f""", {pl.SCORED}, {GROUPS}, {_km('km', 'gr', 'duration_days', 'event_observed', 'brand, g')}, k AS (SELECT brand, g, min(after) AS s FROM km WHERE t <= 60 GROUP BY ALL), m AS (SELECT brand, g, count(*) AS n, avg(p) AS e FROM gr GROUP BY ALL),
j AS (SELECT brand, n, e, 1 - coalesce(s, 1) AS o FROM m LEFT JOIN k USING (brand, g)), t AS (SELECT brand, count(*) AS groups, sum(n * (o - e) * (o - e) / greatest(e * (1 - e), 1e-12)) AS statistic, sum(n * abs(o - e)) / sum(n) AS gap FROM j GROUP BY brand),
z AS (SELECT *, greatest(groups - 1, 1) / 2.0::DOUBLE AS a, least(statistic, 400) / 2 AS z FROM t)
SELECT brand, groups, round(statistic, 4) AS statistic, round(CASE WHEN statistic > 400 THEN 0 ELSE greatest(0, 1 - list_sum(list_transform(range(0, 600), lambda k: exp((a + k) * ln(z) - z - lgamma(a + 1 + k))))) END, 6) AS p_value, round(gap, 6) AS mean_abs_gap FROM z""")
def eval_8(spark, d):
    """EVAL-8: predicted risk in ten groups against Kaplan-Meier at 60 days: statistic, p-value and mean gap per brand."""
    found = survival.one_calibration(pl.scored(spark, d), "duration_days", "event_observed", "p", 60, ["brand"])
    return found.select("brand", "groups", F.round("statistic", 4).alias("statistic"), F.round("p_value", 6).alias("p_value"), F.round("mean_abs_gap", 6).alias("mean_abs_gap"))


POISSON = " + ".join(f"CAST(u >= {c} AS INT)" for c in survival.POISSON)


@query("eval_10_bootstrap", with_("activity") + f""", {pl.SCORED}, k AS (SELECT y, player_id * 131 + (cutoff - DATE '1995-01-01') AS k FROM sc), l AS (SELECT y, k, unnest(range(1, 201)) AS replica FROM k),
u AS (SELECT *, ((k * 7919 + replica * 104729 + (k * replica) % 9973 * 31) % 10007) / 10007.0::DOUBLE AS u FROM l), w AS (SELECT *, {POISSON} AS w FROM u)
SELECT CAST(replica AS INT) AS replica, CAST(sum(w) AS BIGINT) AS n, round(sum(w * y) / sum(w), 6) AS mean FROM w GROUP BY replica""")
def eval_10(spark, d):
    """EVAL-10: 200 replicas of the churn rate; their quantiles are the interval."""
    rows = pl.scored(spark, d)
    key = F.col("player_id") * 131 + F.datediff("cutoff", F.lit("1995-01-01").cast("date"))
    return survival.bootstrap_mean(rows, "y", key, 200).select("replica", F.col("n").cast("long").alias("n"), F.round("mean", 6).alias("mean"))


STATISTICS = ["auc", "average_precision", "top_precision"]


@query("eval_10_rank_intervals")
def eval_10_ranks(spark, d):
    """EVAL-10: AUC, average precision and top-decile precision of recency per brand, with the 95% interval of 200 resamples of its rows."""
    found = survival.bootstrap_ranks(pl.scored(spark, d), "s", "y", ["brand"], 200)
    return survival.intervals(found, ["brand"], STATISTICS).select("brand", "statistic", *[F.round(c, 6).alias(c) for c in ("value", "low", "high")])


@query("eval_11_block_bootstrap", with_("activity") + f""", {pl.SCORED}, v AS (SELECT cutoff, avg(y) AS x, row_number() OVER (ORDER BY cutoff) - 1 AS i FROM sc GROUP BY cutoff), n AS (SELECT count(*) AS n FROM v), l AS (SELECT replica, k, n FROM n, range(1, 2001) a(replica), range(0, 200) b(k) WHERE k < n),
s AS (SELECT replica, (replica * 7919 + k // 3 * 104729 + (replica * (k // 3)) % 9973 * 31) % n AS s, k, n FROM l), m AS (SELECT replica, avg(x) AS mean FROM s JOIN v ON i = (s + k % 3) % n GROUP BY replica)
SELECT round(avg(mean), 6) AS mean, round(quantile_cont(mean, 0.025), 6) AS low, round(quantile_cont(mean, 0.975), 6) AS high, count(*) AS replicas FROM m""")
def eval_11(spark, d):
    """EVAL-11: the interval of the mean churn rate over cutoffs, by blocks of three."""
    per = pl.scored(spark, d).groupBy("cutoff").agg(F.avg("y").alias("x"))
    m = survival.block_bootstrap(per, "x", "cutoff", 3, 2000)
    return m.agg(F.round(F.avg("mean"), 6).alias("mean"), F.round(F.percentile("mean", 0.025), 6).alias("low"), F.round(F.percentile("mean", 0.975), 6).alias("high"), F.count("*").alias("replicas"))


SIGNALS = ("days_since_last_bet", "active_days_l90d", "bets_l180d", "ggr_c_l90d")


def standardised(spark, d):
    """Rows of labels and features with signals of mean 0 and deviation 1, by one aggregate. Newton steps read them many times, so they are
    written once. Durations of 0, churn that starts on the cutoff itself, stay in."""
    rows = kept(pl.slice_(spark, d).where("days_since_last_bet is not null"))
    moments = rows.agg(*[f(c).alias(f"{c}_{k}") for c in SIGNALS for k, f in (("m", F.avg), ("s", F.stddev_samp))])
    z = [((F.col(c) - F.col(f"{c}_m")) / F.when(F.col(f"{c}_s") > 0, F.col(f"{c}_s"))).alias(c) for c in SIGNALS]
    return rows.join(F.broadcast(moments)).select("brand", "cutoff", "player_id", "duration_days", "event_observed", *[F.coalesce(c, F.lit(0.0)).alias(n) for c, n in zip(z, SIGNALS)])


#: Penalties that the validation cutoffs choose from.
PENALTIES = (0.0, 0.001, 0.01, 0.1)
HORIZONS = (7, 14, 30, 60)


def with_part(rows):
    """rows with part, by the order of the cutoffs that there are: the first 70% train, then 15% valid, the rest test. There is a row per cutoff."""
    from pyspark.sql import Window

    order = rows.select("cutoff").distinct().withColumn("_at", F.row_number().over(Window.orderBy("cutoff"))).withColumn("_n", F.count("*").over(Window.partitionBy()))
    part = F.when(F.col("_at") <= F.ceil(F.col("_n") * 0.7), "train").when(F.col("_at") <= F.ceil(F.col("_n") * 0.85), "valid").otherwise("test")
    return rows.join(F.broadcast(order.select("cutoff", part.alias("part"))), "cutoff")


def split_by_time(rows):
    """(train, valid, test) of rows, which are written once; see with_part."""
    marked = kept(with_part(rows))
    return tuple(marked.where(F.col("part") == p).drop("part") for p in ("train", "valid", "test"))


def fitted_cox(spark, d):
    """(train, valid, test, path, penalty, beta, baseline) of the stratified Cox model whose penalty does best on the validation cutoffs."""
    train, valid, test = split_by_time(standardised(spark, d))
    path, penalty, beta = survival.penalty_path(train, valid, "duration_days", "event_observed", list(SIGNALS), ["brand"], PENALTIES)
    return train, valid, test, path, penalty, beta, survival.baseline(train, "duration_days", "event_observed", list(SIGNALS), ["brand"], beta)


@query("ml_17_cox")
def ml_17(spark, d):
    """ML-17: coefficients of a Cox regression stratified by brand, on all cutoffs, with hazard ratios."""
    rows = standardised(spark, d)
    beta, cov = survival.cox(rows, "duration_days", "event_observed", list(SIGNALS), ["brand"])
    found = [(c, float(b), float(math.sqrt(v)), float(math.exp(b))) for c, b, v in zip(SIGNALS, beta, cov.diagonal())]
    return spark.createDataFrame(found, "signal string, beta double, se double, hazard_ratio double")


@query("ml_17_penalties")
def ml_17_penalties(spark, d):
    """ML-17: the c-index on the validation cutoffs of each penalty, and which one is chosen. A row per penalty."""
    _, _, _, path, best, _, _ = fitted_cox(spark, d)
    return spark.createDataFrame([(float(p), float(c), p == best) for p, c in path], "penalty double, valid_c_index double, chosen boolean")


@query("ml_17_survival")
def ml_17_survival(spark, d):
    """ML-17: survival of the test rows at 7, 14, 30 and 60 days by the fitted model and its baseline, and their median survival."""
    *_, test, _, _, beta, hazard = fitted_cox(spark, d)
    rows = survival.horizon_risks(test, hazard, list(SIGNALS), ["brand"], beta, HORIZONS)
    rows = survival.median_survival(rows, hazard, list(SIGNALS), ["brand"], beta)
    return rows.select("cutoff", "brand", "player_id", *[F.round(1 - F.col(f"cox_p{h}"), 6).alias(f"survival_{h}") for h in HORIZONS], "median_days")


@query("ml_18_hazard_ratios")
def ml_18(spark, d):
    """ML-18: hazard ratio per deviation of each signal alone, with its 95% interval."""
    rows, found = standardised(spark, d), []
    for c in SIGNALS:
        beta, cov = survival.cox(rows, "duration_days", "event_observed", [c], ["brand"])
        b, se = float(beta[0]), float(math.sqrt(cov[0, 0]))
        found.append((c, math.exp(b), math.exp(b - 1.96 * se), math.exp(b + 1.96 * se)))
    return spark.createDataFrame(found, "signal string, hazard_ratio double, low double, high double")


@query("ml_20_proportional_hazards")
def ml_20(spark, d):
    """ML-20: beta(t) by window of days from scaled residuals, their rank correlation with the day, and a verdict per signal."""
    rows = standardised(spark, d)
    beta, cov = survival.cox(rows, "duration_days", "event_observed", list(SIGNALS), ["brand"])
    return survival.proportional_hazards(rows, "duration_days", "event_observed", list(SIGNALS), ["brand"], beta, cov)


@query("spell_3_return_rates", with_("activity") + f", {pl.SPELL}, k AS (SELECT unnest([14, 30, 60]) AS k) SELECT k, count(*) AS spells, round(count(*) FILTER (closed) / count(*), 6) AS raw, count(*) FILTER (follow >= k + 60) AS followed, round(count(*) FILTER (closed AND length <= k + 60 AND follow >= k + 60) / nullif(count(*) FILTER (follow >= k + 60), 0), 6) AS fair FROM sp, k WHERE length >= k GROUP BY k")
def spell_3(spark, d):
    """SPELL-3: of spells silent for k days, the share that returns: of all, and within 60 days of those followed so long."""
    k = F.explode(F.array(F.lit(14), F.lit(30), F.lit(60)))
    rows = pl.spell_1(spark, d).withColumn("k", k).where("length >= k")
    followed = F.col("follow") >= F.col("k") + 60
    back = F.col("closed") & (F.col("length") <= F.col("k") + 60) & followed
    n = F.count_if(followed)
    return rows.groupBy("k").agg(F.count("*").alias("spells"), F.round(F.count_if(F.col("closed")) / F.count("*"), 6).alias("raw"), n.alias("followed"), F.round(F.count_if(back) / F.when(n > 0, n), 6).alias("fair"))


LIFE = """lf AS (SELECT brand, player_id, min(day) AS a, max(day) AS b FROM activity WHERE active GROUP BY ALL), ln_ AS (SELECT brand, CAST(b - a AS INT) AS days, CAST((SELECT max(day) FROM activity) - b >= 180 AS INT) AS gone FROM lf WHERE a >= (SELECT min(day) FROM activity) + 90)"""


@query("spell_4_lifetime", with_("activity") + f", {LIFE}, {_km('km', 'ln_', 'days', 'gone', 'brand')} SELECT brand, CAST(min(t) FILTER (after <= 0.5) AS INT) AS median_days, round(min(after), 6) AS last_survival FROM km GROUP BY brand")
def spell_4(spark, d):
    """SPELL-4: lifetimes of players first seen 90 days or more after the data's start; 180 silent days confirm churn."""
    days = lens.activity(spark, d)
    ends = days.agg(F.min("day").alias("start"), F.max("day").alias("end"))
    life = days.where("active").groupBy("brand", "player_id").agg(F.min("day").alias("a"), F.max("day").alias("b")).join(F.broadcast(ends)).where(F.col("a") >= F.date_add("start", 90))
    return survival.median_lifetime(life.select("brand", F.datediff("b", "a").alias("days"), (F.datediff("end", "b") >= 180).cast("int").alias("gone")), "days", "gone", ["brand"])


@query("spell_5_monthly_churn", with_("activity") + f""", {pl.CUT}, a AS (SELECT DISTINCT player_id, brand, day FROM activity WHERE active), pop AS (SELECT DISTINCT cutoff, player_id, brand FROM cut JOIN a ON day > cutoff - 30 AND day <= cutoff),
n AS (SELECT cutoff, pop.player_id, pop.brand, min(day - cutoff) AS nx FROM pop LEFT JOIN a ON a.player_id = pop.player_id AND day > cutoff AND day <= cutoff + 60 GROUP BY ALL), e AS (SELECT max(day) AS e FROM activity)
SELECT cutoff, brand, count(*) AS players, CASE WHEN any_value(e) >= cutoff + 30 THEN round(avg(CAST(nx IS NULL OR nx > 30 AS INT)), 6) END AS churn_30, CASE WHEN any_value(e) >= cutoff + 60 THEN round(avg(CAST(nx IS NULL AS INT)), 6) END AS churn_60 FROM n, e GROUP BY cutoff, brand""")
def spell_5(spark, d):
    """SPELL-5: monthly churn in 30 and 60 days of players active in the 30 before; null where the data end earlier."""
    days = lens.activity(spark, d)
    cuts = pl.cut(spark, d)
    pop = act.population(days, cuts, 30)
    later = labels._windowed(days.where("active").select("player_id", "day"), cuts, 0, 60).groupBy("cutoff", "player_id").agg(F.min(F.datediff("day", "cutoff")).alias("nx"))
    rows = pop.join(later, ["cutoff", "player_id"], "left").join(F.broadcast(days.agg(F.max("day").alias("end"))))
    known = lambda k: F.max("end") >= F.date_add("cutoff", k)
    silent = lambda k: F.round(F.avg((F.col("nx").isNull() | (F.col("nx") > k)).cast("int")), 6)
    return rows.groupBy("cutoff", "brand").agg(F.count("*").alias("players"), F.when(known(30), silent(30)).alias("churn_30"), F.when(known(60), silent(60)).alias("churn_60"))


POLICIES = {"recency": "s", "inactivity": "-ad", "probability": "p", "value": "v"}
POLICY_SQL = " UNION ALL ".join(f"SELECT cutoff, '{name}{suffix}' AS ranking, row_number() OVER (PARTITION BY cutoff ORDER BY ({e}){times} DESC, player_id) AS r, y, y * greatest(v, 0) AS yv FROM sc" for name, e in POLICIES.items() for suffix, times in (("", ""), ("_by_value", " * greatest(v, 0)")))


@query("bt_4_policies", with_("activity") + f", {pl.SCORED}, q AS ({POLICY_SQL}) SELECT ranking, count(*) AS contacts, CAST(sum(y) AS BIGINT) AS events, CAST(sum(yv) AS BIGINT) AS value FROM q WHERE r <= 50 GROUP BY ranking")
def bt_4(spark, d):
    """BT-4: four scores, blind to value and weighted by it, over the first 50 contacts of each cutoff."""
    rows = pl.scored(spark, d)
    rankings = {}
    for name, e in POLICIES.items():
        for suffix, times in (("", ""), ("_by_value", " * greatest(v, 0)")):
            rows = rows.withColumn(f"_{name}{suffix}", F.expr(f"({e}){times}"))
            rankings[f"{name}{suffix}"] = f"_{name}{suffix}"
    found = ev.replay(rows, rankings, "player_id", "y", "v", 50, ["cutoff"])
    return found.groupBy("ranking").agg(F.sum("contacts").alias("contacts"), F.sum("events").alias("events"), F.sum("value").alias("value"))


MONTHLY = """ra AS (SELECT cutoff, y, rank() OVER (PARTITION BY cutoff ORDER BY s) + (count(*) OVER (PARTITION BY cutoff, s) - 1) / 2.0::DOUBLE AS rs, rank() OVER (PARTITION BY cutoff ORDER BY -ad) + (count(*) OVER (PARTITION BY cutoff, ad) - 1) / 2.0::DOUBLE AS ri FROM sc),
au AS (SELECT cutoff, sum(y) AS pos, count(*) - sum(y) AS neg, sum(rs) FILTER (y = 1) AS rs, sum(ri) FILTER (y = 1) AS ri FROM ra GROUP BY cutoff), am AS (SELECT cutoff, round((rs - pos * (pos + 1) / 2) / (pos * neg), 6) AS recency, round((ri - pos * (pos + 1) / 2) / (pos * neg), 6) AS inactivity FROM au WHERE pos > 0 AND neg > 0)"""


def _monthly(spark, d):
    rows = pl.scored(spark, d).withColumn("i", -F.col("ad"))
    a, b = (ev.auc(rows, c, "y", ["cutoff"]).select("cutoff", F.col("auc").alias(name)) for c, name in (("s", "recency"), ("i", "inactivity")))
    return a.join(b, "cutoff").where("recency is not null")


@query("bt_8_months_against_recency", with_("activity") + f", {pl.SCORED}, {MONTHLY} SELECT count(*) AS months, round(median(recency), 6) AS recency, round(median(inactivity), 6) AS inactivity, min(inactivity) AS worst, CAST(arg_min(cutoff, inactivity) AS DATE) AS worst_month, count(*) FILTER (inactivity > recency) AS wins FROM am")
def bt_8(spark, d):
    """BT-8: a score against recency over the months (a row each): medians, the worst month, months won."""
    m = _monthly(spark, d)
    return m.agg(F.count("*").alias("months"), F.round(F.median("recency"), 6).alias("recency"), F.round(F.median("inactivity"), 6).alias("inactivity"), F.min("inactivity").alias("worst"), F.min_by("cutoff", "inactivity").alias("worst_month"), F.count_if(F.col("inactivity") > F.col("recency")).alias("wins"))


ECE = "eq AS (SELECT cutoff, list_distinct(quantile_cont(p, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1])) AS q FROM sc GROUP BY cutoff), eb AS (SELECT sc.*, len(list_filter(list_sort(q)[2:len(q) - 1], lambda x: x < p)) AS g FROM sc JOIN eq USING (cutoff)), ee AS (SELECT cutoff, sum(n * abs(y - p)) / sum(n) AS ece FROM (SELECT cutoff, g, count(*) AS n, avg(y) AS y, avg(p) AS p FROM eb GROUP BY ALL) GROUP BY cutoff)"
TOPS = "tp AS (SELECT cutoff, y, row_number() OVER (PARTITION BY cutoff ORDER BY -ad DESC, player_id) AS ri, row_number() OVER (PARTITION BY cutoff ORDER BY s DESC, player_id) AS rs, greatest(1, floor(count(*) OVER (PARTITION BY cutoff) * 0.1::DOUBLE + 0.5)) AS k FROM sc), tt AS (SELECT cutoff, round(sum(y) FILTER (ri <= k) / count(*) FILTER (ri <= k), 6) AS model, round(sum(y) FILTER (rs <= k) / count(*) FILTER (rs <= k), 6) AS recency FROM tp GROUP BY cutoff)"


@query("bt_9_conditions", with_("activity") + f""", {pl.SCORED}, {MONTHLY}, {ECE}, {TOPS}, j AS (SELECT (SELECT avg(tt.model) / avg(tt.recency) FROM tt JOIN am USING (cutoff)) AS ratio, (SELECT min(inactivity) FROM am) AS auc, (SELECT max(ece) FROM ee JOIN am USING (cutoff)) AS ece)
SELECT round(ratio, 6) AS top_decile_ratio, auc AS least_auc, round(ece, 6) AS greatest_ece, ratio >= 1.10::DOUBLE AS beats_recency, auc >= 0.70::DOUBLE AS ranks, ece <= 0.08::DOUBLE AS calibrated, ratio >= 1.10::DOUBLE AND auc >= 0.70::DOUBLE AND ece <= 0.08::DOUBLE AS passes FROM j""")
def bt_9(spark, d):
    """BT-9: the score's mean top-decile precision over that of recency (1.10), its least AUC (0.70) and its greatest ECE (0.08) over the
    cutoffs with both classes. Months are a row each."""
    rows = kept(pl.scored(spark, d).withColumn("i", -F.col("ad")))
    tops = [ev.top_share(rows, c, "y", "player_id", ["cutoff"]).select("cutoff", F.col("precision").alias(name)) for c, name in (("i", "model"), ("s", "recency_top"))]
    months = ev.auc(rows, "i", "y", ["cutoff"]).where("auc is not null").join(tops[0], "cutoff").join(tops[1], "cutoff").join(ev.calibration_error(rows, "p", "y", ["cutoff"]), "cutoff")
    one = months.agg((F.avg("model") / F.avg("recency_top")).alias("ratio"), F.min("auc").alias("auc"), F.max("ece").alias("ece"))
    beats, ranks, fits = F.col("ratio") >= 1.10, F.col("auc") >= 0.70, F.col("ece") <= 0.08
    return one.select(F.round("ratio", 6).alias("top_decile_ratio"), F.col("auc").alias("least_auc"), F.round("ece", 6).alias("greatest_ece"), beats.alias("beats_recency"), ranks.alias("ranks"), fits.alias("calibrated"), (beats & ranks & fits).alias("passes"))


@query("bt_6_nowcast", with_("activity") + f""", {pl.CUT}, {pl.ACTIVE}, {pl.POP}, n AS (SELECT cutoff, pop.brand, pop.player_id, min(day - cutoff) AS nx FROM pop LEFT JOIN (SELECT DISTINCT player_id, day FROM a) x ON x.player_id = pop.player_id AND day > cutoff AND day <= cutoff + 60 GROUP BY ALL),
k AS (SELECT brand, cutoff, k, count(*) AS n, avg(CAST(nx IS NULL OR nx > k AS INT)) AS silent, avg(CAST(nx IS NULL AS INT)) AS realised, count(*) FILTER (nx IS NULL) / greatest(count(*) FILTER (nx IS NULL OR nx > k), 1) AS stays FROM n, (SELECT unnest([14, 21, 30, 45]) AS k) WHERE cutoff + 60 <= {pl.END_DAY} GROUP BY ALL),
m AS (SELECT k.brand, k.cutoff, k.k, max(r.cutoff) AS ref FROM k JOIN k r ON r.brand = k.brand AND r.k = k.k AND r.cutoff + 60 <= k.cutoff + k.k GROUP BY ALL)
SELECT k.brand, k.cutoff, k.k, k.n, round(k.silent * r.stays, 6) AS nowcast, round(k.realised, 6) AS realised, round(r.realised, 6) AS last_complete FROM m JOIN k ON k.brand = m.brand AND k.cutoff = m.cutoff AND k.k = m.k JOIN k r ON r.brand = m.brand AND r.cutoff = m.ref AND r.k = m.k""")
def bt_6(spark, d):
    """BT-6: churn estimated k days after a cutoff: the share silent so far, times how often those of the last cohort complete on that day
    (60 days after its cutoff by then) who were silent after k days stayed so. A brand has a row per cutoff and k."""
    days, cuts = lens.activity(spark, d), pl.cut(spark, d)
    later = labels._windowed(days.where("active").select("player_id", "day"), cuts, 0, 60).groupBy("cutoff", "player_id").agg(F.min(F.datediff("day", "cutoff")).alias("nx"))
    rows = act.population(days, cuts, 180).join(later, ["cutoff", "player_id"], "left").join(F.broadcast(days.agg(F.max("day").alias("end")))).where(F.date_add("cutoff", 60) <= F.col("end"))
    never = F.col("nx").isNull()
    silent = never | (F.col("nx") > F.col("k"))
    per = rows.withColumn("k", F.explode(F.array(*[F.lit(k) for k in (14, 21, 30, 45)]))).groupBy("brand", "cutoff", "k").agg(
        F.count("*").alias("n"), F.avg(silent.cast("int")).alias("silent"), F.avg(never.cast("int")).alias("realised"), (F.count_if(never) / F.greatest(F.count_if(silent), F.lit(1))).alias("stays")
    )
    per = kept(per)
    ref = per.select("brand", "k", F.col("cutoff").alias("_ref"), F.col("stays").alias("_stays"), F.col("realised").alias("_realised"))
    last = per.join(ref, ["brand", "k"]).where(F.date_add("_ref", 60) <= F.date_add("cutoff", F.col("k"))).groupBy("brand", "cutoff", "k").agg(F.max(F.struct("_ref", "_stays", "_realised")).alias("r"))
    return per.join(last, ["brand", "cutoff", "k"]).select("brand", "cutoff", "k", "n", F.round(F.col("silent") * F.col("r._stays"), 6).alias("nowcast"), F.round("realised", 6).alias("realised"), F.round("r._realised", 6).alias("last_complete"))


@query("eval_16_decisions", with_("activity") + f""", {pl.SCORED}, q AS (SELECT 'long silence' AS signal, s > 90 AS x, y FROM sc UNION ALL SELECT 'few days', ad < 2, y FROM sc UNION ALL SELECT 'loss', v < 0, y FROM sc),
t AS (SELECT signal, count(*) FILTER (x AND y = 1) AS a, count(*) FILTER (x) AS n1, count(*) FILTER (NOT x AND y = 1) AS c, count(*) FILTER (NOT x) AS n0 FROM q GROUP BY signal), l AS (SELECT *, (a / n1) / (c / n0) AS lift, sqrt(1 / a - 1 / n1 + 1 / c - 1 / n0) AS se FROM t WHERE a > 0 AND c > 0),
r AS (SELECT signal, lift, list_filter([CASE WHEN n1 < 100 THEN 'few rows' END, CASE WHEN lift * exp(-1.96::DOUBLE * se) <= 1.2 THEN 'low lift' END, CASE WHEN n1 / (n1 + n0) > 0.9 THEN 'nearly all rows' END], lambda z: z IS NOT NULL) AS why FROM l)
SELECT signal, round(lift, 6) AS lift, CASE WHEN len(why) = 0 THEN 'PROMOTED' ELSE 'REJECTED' END AS decision, array_to_string(why, ', ') AS reasons FROM r""")
def eval_16(spark, d):
    """EVAL-16, UDF-6: registered signals, promoted or rejected with reasons."""
    registry = {"long silence": "s > 90", "few days": "ad < 2", "loss": "v < 0"}
    rows = pl.scored(spark, d).select("y", F.explode(F.array(*[F.struct(F.lit(k).alias("signal"), F.expr(e).cast("int").alias("x")) for k, e in registry.items()])).alias("p")).select("y", "p.*")
    found = rows.groupBy("signal").agg(F.count_if((F.col("x") == 1) & (F.col("y") == 1)).alias("a"), F.count_if(F.col("x") == 1).alias("n1"), F.count_if((F.col("x") == 0) & (F.col("y") == 1)).alias("c"), F.count_if(F.col("x") == 0).alias("n0")).where("a > 0 and c > 0")
    found = found.withColumn("lift", (F.col("a") / F.col("n1")) / (F.col("c") / F.col("n0"))).withColumn("se", F.sqrt(1 / F.col("a") - 1 / F.col("n1") + 1 / F.col("c") - 1 / F.col("n0")))
    why = F.array_compact(F.array(F.when(F.col("n1") < 100, "few rows"), F.when(F.col("lift") * F.exp(-1.96 * F.col("se")) <= 1.2, "low lift"), F.when(F.col("n1") / (F.col("n1") + F.col("n0")) > 0.9, "nearly all rows")))
    return found.select("signal", F.round("lift", 6).alias("lift"), F.when(F.size(why) == 0, "PROMOTED").otherwise("REJECTED").alias("decision"), F.array_join(why, ", ").alias("reasons"))


@query("rpt_3_thresholds", with_("activity") + f""", {pl.SPELL} SELECT count(*) FILTER (length > 60 AND follow >= 90) AS silent_60, count(*) FILTER (length > 60 AND length <= 90 AND closed AND follow >= 90) AS return_61_90, round(count(*) FILTER (length > 60 AND length <= 90 AND closed AND follow >= 90) / nullif(count(*) FILTER (length > 60 AND follow >= 90), 0), 6) AS share, count(*) FILTER (length > 90 AND follow >= 90) AS silent_90 FROM sp""")
def rpt_3(spark, d):
    """RPT-3: of those churned by 60 silent days, who returns before 90."""
    n, back = F.count_if((F.col("length") > 60) & (F.col("follow") >= 90)), F.count_if((F.col("length") > 60) & (F.col("length") <= 90) & F.col("closed") & (F.col("follow") >= 90))
    return pl.spell_1(spark, d).agg(n.alias("silent_60"), back.alias("return_61_90"), F.round(back / F.when(n > 0, n), 6).alias("share"), F.count_if((F.col("length") > 90) & (F.col("follow") >= 90)).alias("silent_90"))


@query("rpt_1_dataset_summary", with_("activity") + f", {pl.SCORED}, b AS (SELECT avg(y) AS by_, count(*) / count(DISTINCT cutoff) AS bn FROM sc) SELECT cutoff, count(*) AS n, round(avg(y), 6) AS rate, round(avg(s), 6) AS recency, CASE WHEN abs(avg(y) - any_value(by_)) > 0.2 THEN 'critical' WHEN abs(avg(y) - any_value(by_)) > 0.1 THEN 'warn' ELSE 'ok' END AS rate_status, CASE WHEN abs(count(*) / any_value(bn) - 1) > 0.5 THEN 'critical' WHEN abs(count(*) / any_value(bn) - 1) > 0.2 THEN 'warn' ELSE 'ok' END AS rows_status FROM sc, b GROUP BY cutoff")
def rpt_1(spark, d):
    """RPT-1, LAB-7: rows, label rate and recency per cutoff against all cutoffs."""
    per = pl.scored(spark, d).groupBy("cutoff").agg(F.count("*").alias("n"), F.sum("y").alias("pos"), F.sum("s").alias("sum_s"))
    all_ = per.agg((F.sum("pos") / F.sum("n")).alias("rate_all"), (F.sum("n") / F.count("*")).alias("n_all"))
    rate = F.col("pos") / F.col("n")
    level = lambda x, a, b: F.when(x > b, "critical").when(x > a, "warn").otherwise("ok")
    return per.join(F.broadcast(all_)).select("cutoff", "n", F.round(rate, 6).alias("rate"), F.round(F.col("sum_s") / F.col("n"), 6).alias("recency"), level(F.abs(rate - F.col("rate_all")), 0.1, 0.2).alias("rate_status"), level(F.abs(F.col("n") / F.col("n_all") - 1), 0.2, 0.5).alias("rows_status"))


@query("rpt_7_threshold_scan", with_("activity") + f", {pl.SCORED}, k AS (SELECT unnest(generate_series(10, 180, 10)) AS k) SELECT CAST(k AS INT) AS k, count(*) FILTER (s >= k) AS flagged, round(avg(y) FILTER (s >= k), 6) AS rate, round(avg(y) FILTER (s >= k) / avg(y), 6) AS ratio FROM sc, k GROUP BY k")
def rpt_7(spark, d):
    """RPT-7: churn of those silent for k days or more against all, over thresholds."""
    ks = list(range(10, 181, 10))
    one = pl.scored(spark, d).agg(F.avg("y").alias("all"), *[F.count_if(F.col("s") >= k).alias(f"n{k}") for k in ks], *[F.avg(F.when(F.col("s") >= k, F.col("y"))).alias(f"r{k}") for k in ks])
    return one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"n{k}").alias("flagged"), F.round(F.col(f"r{k}"), 6).alias("rate"), F.round(F.col(f"r{k}") / F.col("all"), 6).alias("ratio")) for k in ks])).alias("p")).select("p.*")


@query("rpt_6_seasonal_level", with_("activity") + f", {pl.SCORED}, m AS (SELECT cutoff, avg(y) AS rate, count(*) AS n FROM sc GROUP BY cutoff) SELECT a.cutoff, round(a.rate, 6) AS rate, round(b.rate, 6) AS same_month_before, round(sum(a.rate * a.n) OVER w / sum(a.n) OVER w, 6) AS pooled FROM m a LEFT JOIN m b ON b.cutoff = CAST(a.cutoff - INTERVAL 12 MONTH AS DATE) WINDOW w AS (ORDER BY a.cutoff ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)")
def rpt_6(spark, d):
    """RPT-6: a month's level against that of the year before, and against the pooled months before. There is a row per month."""
    from pyspark.sql import Window

    m = pl.scored(spark, d).groupBy("cutoff").agg(F.avg("y").alias("rate"), F.count("*").alias("n"))
    before = m.select(F.add_months("cutoff", 12).alias("cutoff"), F.round("rate", 6).alias("same_month_before"))
    w = Window.orderBy("cutoff").rowsBetween(-12, -1)
    pooled = F.sum(F.col("rate") * F.col("n")).over(w) / F.sum("n").over(w)
    return m.join(before, "cutoff", "left").select("cutoff", F.round("rate", 6).alias("rate"), "same_month_before", F.round(pooled, 6).alias("pooled"))


@query("ml_21_scores")
def ml_21(spark, d):
    """ML-21, WIN-22: scores of the latest test cutoff: calibrated chances of churn within 7, 14, 30 and 60 days, which don't fall with the
    horizon, median survival, expected value, value at risk and risk band. Calibrators are fitted per horizon on the validation cutoffs."""
    from lakepulse.operators.models import horizon_calibrated

    train, valid, test, _, _, beta, hazard = fitted_cox(spark, d)
    risks = lambda rows: survival.horizon_risks(rows, hazard, list(SIGNALS), ["brand"], beta, HORIZONS)
    last = test.agg(F.max("cutoff").alias("cutoff"))
    rows = survival.median_survival(risks(test.join(F.broadcast(last), "cutoff", "left_semi")), hazard, list(SIGNALS), ["brand"], beta)
    rows = horizon_calibrated(risks(valid), rows, "duration_days", "event_observed", HORIZONS)
    value = pl.feat(spark, d).select("cutoff", "player_id", "brand", F.col("ggr_c_l90d").alias("v"))
    p = F.col("p60")
    band = F.when(p < 0.25, "low").when(p < 0.5, "medium").when(p < 0.75, "high").otherwise("critical")
    return rows.join(value, ["cutoff", "player_id", "brand"]).select(
        "cutoff", "brand", "player_id", F.round(F.col("v") / F.lit(90.0) * 30, 4).alias("expected_ggr_30d"), F.round(F.greatest("v", F.lit(0)) * p, 4).alias("value_at_risk"),
        *[F.round(f"p{h}", 6).alias(f"p{h}") for h in HORIZONS], "median_days", band.alias("band"),
    )


@query("rpt_10_player_lookup", with_("activity") + f", {pl.SCORED} SELECT player_id, max(cutoff) AS run_date, arg_max(p, cutoff) AS p, arg_max(v, cutoff) AS v FROM sc GROUP BY player_id")
def rpt_10(spark, d):
    """RPT-10: a player's scores of the latest run."""
    return pl.scored(spark, d).groupBy("player_id").agg(F.max("cutoff").alias("run_date"), F.max_by("p", "cutoff").alias("p"), F.max_by("v", "cutoff").alias("v"))


@query("lab_9_horizon_labels", with_("activity") + f", {pl.CUT}, {pl.ACTIVE}, {pl.POP}, {pl.LABELS}, hh AS (SELECT unnest([7, 14, 30, 60]) AS h) SELECT cutoff, h, count(*) FILTER (event_observed = 1 AND duration_days <= h) AS events, count(*) FILTER (duration_days > h) AS survivors, count(*) FILTER (event_observed = 0 AND duration_days <= h) AS unknown FROM labels, hh GROUP BY ALL")
def lab_9(spark, d):
    """LAB-9, LAB-6: of a horizon, labels known as event or survival, and those that censoring leaves unknown."""
    rows = pl.lab(spark, d).withColumn("h", F.explode(F.array(*[F.lit(h) for h in (7, 14, 30, 60)])))
    e, t = F.col("event_observed") == 1, F.col("duration_days") <= F.col("h")
    return rows.groupBy("cutoff", "h").agg(F.count_if(e & t).alias("events"), F.count_if(~t).alias("survivors"), F.count_if(~e & t).alias("unknown"))


@query("ml_9_matured_cutoffs", with_("activity") + f", {pl.CUT} SELECT cutoff, cutoff + 60 <= {pl.END_DAY} AS matured, cutoff + 30 <= {pl.END_DAY} AND cutoff + 60 > {pl.END_DAY} AS early FROM cut")
def ml_9(spark, d):
    """ML-9, LAB-8: cutoffs whose labels are closed, and those that only an early estimate covers."""
    end = lens.stakes(spark, d).agg(F.max("day").alias("end"))
    rows = pl.cut(spark, d).join(F.broadcast(end))
    known = lambda k: F.date_add("cutoff", k) <= F.col("end")
    return rows.select("cutoff", known(60).alias("matured"), (known(30) & ~known(60)).alias("early"))


@query("feat_final", with_("activity") + f""", {pl.CUT}, {pl.FEATURES}, c AS (SELECT brand, quantile_cont(wagered_c_l90d, 0.995) AS cap FROM features WHERE wagered_c_l90d > 0 GROUP BY brand), g AS (SELECT brand, quantile_cont(ggr_c_l90d, 0.995) AS hi, quantile_cont(ggr_c_l90d, 0.005) AS lo FROM features WHERE ggr_c_l90d <> 0 GROUP BY brand)
SELECT cutoff, player_id, brand, round(ln(1 + least(wagered_c_l90d, cap)), 6) AS wagered_c_l90d, round(sign(greatest(lo, least(hi, ggr_c_l90d))) * ln(1 + abs(greatest(lo, least(hi, ggr_c_l90d)))), 6) AS ggr_c_l90d, CASE WHEN cutoff - 179 >= (SELECT min(day) FROM activity) THEN bets_l180d END AS bets_l180d FROM features JOIN c USING (brand) JOIN g USING (brand)""")
def feat_final(spark, d):
    """FEAT-FIN, FILT-3, FILT-4, WINS-1, WINS-2: caps of both sides for signed columns, signed log, and null where a window begins before the data."""
    f = pl.feat(spark, d)
    one = quantiles(f.where("wagered_c_l90d > 0"), "wagered_c_l90d", ["brand"], [0.995]).select("brand", F.col("q")[0].alias("cap"))
    two = quantiles(f.where("ggr_c_l90d <> 0"), "ggr_c_l90d", ["brand"], [0.005, 0.995]).select("brand", F.col("q")[0].alias("lo"), F.col("q")[1].alias("hi"))
    start = lens.activity(spark, d).agg(F.min("day").alias("start"))
    rows = f.join(one, "brand").join(two, "brand").join(F.broadcast(start))
    g = F.greatest("lo", F.least("hi", F.col("ggr_c_l90d").cast("double")))
    return rows.select(
        "cutoff", "player_id", "brand", F.round(F.log1p(F.least(F.col("wagered_c_l90d").cast("double"), F.col("cap"))), 6).alias("wagered_c_l90d"), F.round(F.signum(g) * F.log1p(F.abs(g)), 6).alias("ggr_c_l90d"),
        F.when(F.date_sub("cutoff", 179) >= F.col("start"), F.col("bets_l180d")).alias("bets_l180d"),
    )

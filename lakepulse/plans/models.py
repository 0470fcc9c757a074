"""Model queries; what depends on a fitted model has no SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakepulse.operators import evaluate as ev
from lakepulse.operators import models, survival
from lakepulse.operators.ranks import attach, quantiles
from lakepulse.sources.lake import kept
from lakepulse.sources.lens import with_

from . import players as pl
from .registry import query
from .survival import with_part

#: The first 70% of the cutoffs learn, the others test; see survival.with_part.
EARLY, LATER = "part = 'train'", "part <> 'train'"
FOUR = ["days_since_last_bet", "active_days_l30d", "active_days_l90d", "bets_l180d"]


def rows_(spark, d):
    return pl.slice_(spark, d).where("event_60d is not null").select("cutoff", "player_id", "brand", F.col("event_60d").alias("y"), *FOUR, "ggr_c_l90d").transform(with_part)


@query("ml_4_logistic_auc")
def ml_4(spark, d):
    """ML-4, EVAL-1: a logistic baseline on four features, trained on the first 70% of the cutoffs, its AUC per later cutoff."""
    rows = rows_(spark, d)
    scored = models.logistic(rows.where(EARLY), rows.where(LATER), FOUR, "y")
    return ev.auc(scored, "p", "y", ["cutoff"])


@query("ml_5_isotonic")
def ml_5(spark, d):
    """ML-5, EVAL-3: calibrated probabilities in ten groups."""
    rows = rows_(spark, d)
    train = rows.where(EARLY)
    scored = models.logistic(train, rows, FOUR, "y")
    later = models.isotonic(scored.where(EARLY), scored.where(LATER), "p", "y")
    return ev.calibration(later, "calibrated", "y")


@query("ml_10_segments")
def ml_10(spark, d):
    """ML-10, RPT-8: segments of players with their size, share, churn and median per split. There are few segments."""
    rows = rows_(spark, d).withColumn("part", F.when(F.expr(EARLY), "train").otherwise("test"))
    found = models.segments(rows, ["days_since_last_bet", "active_days_l90d", "bets_l180d"])
    per = found.groupBy("segment", "part").agg(F.count("*").alias("n"), F.round(F.avg("y"), 4).alias("churn"))
    middle = quantiles(found, "bets_l180d", ["segment", "part"], [0.5]).select("segment", "part", F.col("q")[0].alias("bets"))
    return attach(per, middle, ["segment", "part"]).withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("part")), 6))


@query("ml_11_screen", with_("activity") + f", {pl.CUT}, {pl.FEATURES}, l AS (SELECT 'bets_l30d' AS feature, CAST(bets_l30d AS DOUBLE) AS v FROM features UNION ALL SELECT 'heavy_loss_multiple', heavy_loss_multiple FROM features UNION ALL SELECT 'days_since_last_bet', days_since_last_bet FROM features), c AS (SELECT feature, v, count(*) AS n FROM l GROUP BY ALL), s AS (SELECT feature, sum(n) AS n, coalesce(sum(n) FILTER (v IS NULL), 0) AS nulls, coalesce(max(n) FILTER (v IS NOT NULL), 0) AS top FROM c GROUP BY feature) SELECT feature, round(nulls / n, 6) AS missing, round(top / n, 6) AS mode_share, nulls / n <= 0.4::DOUBLE AND top / n <= 0.95::DOUBLE AS stays FROM s")
def ml_11(spark, d):
    return models.screen(pl.feat(spark, d), ["bets_l30d", "heavy_loss_multiple", "days_since_last_bet"])


@query("ml_11_dependence")
def ml_11_dependence(spark, d):
    """ML-11: features that are a function of another one, of frequencies, flags and parts of the date: the month gives the quarter, and a
    recency in weeks comes from none of them. A row per feature that goes."""
    f = pl.slice_(spark, d).where("event_60d is not null").withColumn("month", F.month("cutoff")).withColumn("quarter", F.quarter("cutoff")).withColumn("weeks", F.expr("days_since_last_bet div 7"))
    names = ["month", "quarter", "weeks", "active_days_l30d", "active_days_l90d", "heavy_loss_flag"]
    return spark.createDataFrame(sorted(models.dependent(f, names, "event_60d").items()), "feature string, function_of string")


@query("ml_14_pruning")
def ml_14_pruning(spark, d):
    """ML-14: features by permutation importance, and the smallest number of first ones whose logistic model is within 0.005 of the AUC of all."""
    train, test = split_(spark, d)
    ranked = models.permutation_importance(train, test, FOUR, "y", ["cutoff", "player_id"]).orderBy(F.desc("fall"), "feature").collect()
    names = [r["feature"] for r in ranked]
    score = lambda own: ev.auc(models.logistic(train, test, own, "y").withColumn("p", F.round("p", 6)).withColumn("all", F.lit(1)), "p", "y", ["all"]).first()["auc"]
    kept_, auc, _ = models.prune(names, score, 0.005)
    return spark.createDataFrame([(i, r["feature"], float(r["fall"]), r["feature"] in kept_, float(auc)) for i, r in enumerate(ranked, 1)], "place int, feature string, fall double, kept boolean, auc double")


@query("ml_7_level_shift")
def ml_7(spark, d):
    """ML-7: per brand, the shift that brings mean recency scores to the observed churn rate: the median of the shifts that its last six months
    need, and the least and greatest of them. There is a row per cutoff."""
    rows = pl.scored(spark, d).withColumn("p", F.greatest(F.lit(0.01), F.least(F.lit(0.99), F.col("p"))))
    last = rows.select("cutoff").distinct().withColumn("_place", F.row_number().over(Window.orderBy(F.desc("cutoff")))).where("_place <= 6").select("cutoff")
    rows = kept(rows.join(F.broadcast(last), "cutoff", "left_semi").select("brand", "cutoff", "p", "y"))
    rates = rows.groupBy("brand", "cutoff").agg(F.avg("y").alias("rate"))
    shifts = models.level_shift(rows.join(rates, ["brand", "cutoff"]), "p", ["brand", "cutoff"], "rate")
    return shifts.groupBy("brand").agg(F.count("*").alias("months"), F.round(F.median("shift"), 4).alias("shift"), F.min("shift").alias("least"), F.max("shift").alias("most"))


def split_(spark, d):
    """Rows that learn and rows that test, features as doubles; fits read them many times, so they are written once."""
    rows = kept(rows_(spark, d).select("cutoff", "player_id", "brand", "y", "part", *[F.col(c).cast("double").alias(c) for c in (*FOUR, "ggr_c_l90d")]))
    return rows.where(EARLY), rows.where(LATER)


@query("ml_3_boosted_trees")
def ml_3(spark, d):
    """ML-3, BT-2: boosted trees stopped early on the validation cutoffs; AUC per test cutoff."""
    train, later = split_(spark, d)
    learn = train.unionByName(later.where("part = 'valid'")).withColumn("late", F.col("part") == "valid")
    scored = models.boosted(learn, later.where("part = 'test'"), FOUR, "y", "late")
    return ev.auc(scored.withColumn("p", F.round("p", 6)), "p", "y", ["cutoff"])


@query("ml_6_calibrator_choice")
def ml_6(spark, d):
    """ML-6: isotonic or Platt, by the calibration error on folds of players."""
    train, test = split_(spark, d)
    return models.calibrator_choice(models.logistic(train, test, FOUR, "y").select("player_id", "y", "p"), "p", "y", "player_id")


@query("ml_5_by_brand")
def ml_5_brand(spark, d):
    """ML-5: calibration per brand where it has rows enough, in ten groups."""
    train, test = split_(spark, d)
    scored = models.logistic(train, train.unionByName(test), FOUR, "y").select("cutoff", "part", "brand", "y", "p")
    return ev.calibration(models.calibrated_by(scored.where(EARLY), scored.where(LATER), "p", "y", "brand"), "calibrated", "y")


@query("ml_19_horizons")
def ml_19(spark, d):
    """ML-19: a calibrator for each of 7, 14 and 30 days: mean calibrated probability and rate of the test cutoffs."""
    rows = with_part(pl.slice_(spark, d).where("churn_within_30d is not null").select("cutoff", "days_since_last_bet", "churn_within_7d", "churn_within_14d", "churn_within_30d"))
    rows = rows.withColumn("p", F.least(F.lit(1.0), F.coalesce("days_since_last_bet", F.lit(180)) / F.lit(180.0)))
    parts = []
    for h in (7, 14, 30):
        own = rows.select("cutoff", "part", "p", F.col(f"churn_within_{h}d").alias("y"))
        found = models.isotonic(own.where(EARLY), own.where(LATER), "p", "y")
        parts.append(found.agg(F.lit(h).alias("horizon"), F.count("*").alias("n"), F.round(F.avg("calibrated"), 6).alias("mean_p"), F.round(F.avg("y"), 6).alias("rate")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("ml_12_correlated", with_("activity") + f""", {pl.CUT}, {pl.ACTIVE}, {pl.POP}, {pl.LABELS}, {pl.FEATURES}, t AS (SELECT event_60d AS y, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in FOUR)} FROM labels JOIN features USING (cutoff, player_id, brand) WHERE event_60d IS NOT NULL AND days_since_last_bet IS NOT NULL),
c AS ({" UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM t" for i, a in enumerate(FOUR) for b in FOUR[i + 1 :])}), l AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS x, y FROM t" for c in FOUR)}),
k AS (SELECT *, rank() OVER (PARTITION BY feature ORDER BY x) + (count(*) OVER (PARTITION BY feature, x) - 1) / 2.0::DOUBLE AS r FROM l), w AS (SELECT feature, abs(round((sum(r) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * (count(*) - sum(y))), 6) - 0.5) AS power FROM k GROUP BY feature)
SELECT a, b, round(r, 6) AS r, CASE WHEN abs(r) > 0.95 THEN CASE WHEN x.power < z.power THEN a ELSE b END END AS dropped FROM c JOIN w x ON x.feature = a JOIN w z ON z.feature = b""")
def ml_12(spark, d):
    return models.correlated(rows_(spark, d), FOUR, "y")


@query("ml_13_adversarial")
def ml_13(spark, d):
    """ML-13: how well the features tell learning from test cutoffs: an AUC near a half says that they are alike."""
    rows = rows_(spark, d).withColumn("late", F.expr(f"cast({LATER} as int)"))
    even = F.pmod(F.xxhash64("player_id"), F.lit(2)) == 0
    scored = models.logistic(rows.where(even), rows.where(~even), FOUR, "late")
    return ev.auc(scored.withColumn("p", F.round("p", 6)), "p", "late", [])


@query("ml_14_importance")
def ml_14(spark, d):
    """ML-14: fall of the test AUC when a feature is permuted."""
    return models.permutation_importance(*split_(spark, d), FOUR, "y", ["cutoff", "player_id"])


FAMILIES = {"recency": ["days_since_last_bet"], "frequency": ["active_days_l30d", "active_days_l90d"], "volume": ["bets_l180d"]}


@query("ml_15_ablation")
def ml_15(spark, d):
    """ML-15: the test AUC of a model without each family of features."""
    train, test = split_(spark, d)
    parts = []
    for name in ("none", *FAMILIES):
        own = [c for c in FOUR if c not in FAMILIES.get(name, [])]
        scored = models.logistic(train, test, own, "y").select(F.round("p", 6).alias("p"), "y", F.lit(name).alias("without"))
        parts.append(scored)
    every = parts[0]
    for more in parts[1:]:
        every = every.unionByName(more)
    return ev.auc(every, "p", "y", ["without"])


@query("rpt_9_contributions")
def rpt_9(spark, d):
    """ML-16, RPT-9: mean size and direction of each feature's part in a linear model."""
    train, test = split_(spark, d)
    return models.contribution_summary(models.contributions(train, test, FOUR, "y"), FOUR)


@query("ml_16_drivers")
def ml_16(spark, d):
    """ML-16: how often each text of three drivers occurs."""
    train, test = split_(spark, d)
    return models.contributions(train, test, FOUR, "y").groupBy("drivers").agg(F.count("*").alias("n"))


@query("anom_3_isolation_forest")
def anom_3(spark, d):
    """ANOM-3: outlying rows of a snapshot by an isolation forest."""
    f = pl.feat(spark, d).select("cutoff", "player_id", "bets_l30d", "wagered_c_l90d", "ggr_c_l90d", "active_days_l180d")
    return models.isolation_forest(f, ["bets_l30d", "wagered_c_l90d", "ggr_c_l90d", "active_days_l180d"], ["cutoff", "player_id"], trees=60).where("outlier").select("cutoff", "player_id", F.round("score", 6).alias("score"))


@query("bt_7_cox_horizons")
def bt_7(spark, d):
    """BT-7: AUC, Brier score, log-loss and ECE of the calibrated chances of a Cox model at 7, 14, 30 and 60 days, against labels known at the
    horizon, on the test cutoffs. Horizons without both classes have no AUC."""
    from .survival import HORIZONS, SIGNALS, fitted_cox

    _, valid, test, _, _, beta, hazard = fitted_cox(spark, d)
    risks = lambda rows: survival.horizon_risks(rows, hazard, list(SIGNALS), ["brand"], beta, HORIZONS)
    rows = kept(models.horizon_calibrated(risks(valid), risks(test), "duration_days", "event_observed", HORIZONS))
    cells = F.explode(F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(f"p{h}").alias("p")) for h in HORIZONS]))
    long = rows.select("duration_days", "event_observed", cells.alias("c")).select("duration_days", "event_observed", "c.*")
    churned = (F.col("event_observed") == 1) & (F.col("duration_days") <= F.col("horizon"))
    known = kept(long.where(churned | (F.col("duration_days") > F.col("horizon"))).select("horizon", F.round("p", 6).alias("p"), churned.cast("int").alias("y")))
    found = ev.auc(known, "p", "y", ["horizon"]).join(ev.losses(known, "p", "y", ["horizon"]), "horizon").join(ev.calibration_error(known, "p", "y", ["horizon"]), "horizon")
    return found.select("horizon", "n", F.round(F.col("pos") / F.col("n"), 6).alias("rate"), "auc", "brier", "log_loss", F.round("ece", 6).alias("ece"))


@query("rpt_5_robustness")
def rpt_5(spark, d):
    """RPT-5: the test AUC over learning windows and seeds."""
    train, test = split_(spark, d)
    parts = []
    train = kept(train.join(F.broadcast(pl.middle(train.select("cutoff").distinct()))))
    for first, window in (("all", F.lit(True)), ("later half", F.col("cutoff") >= F.col("middle"))):
        for seed in (1, 2):
            own = train.where(window).where(F.pmod(F.xxhash64("cutoff", "player_id", F.lit(seed)), F.lit(10)) < 8)
            parts.append(models.logistic(own, test, FOUR, "y").select(F.round("p", 6).alias("p"), "y", F.lit(first).alias("first"), F.lit(seed).alias("seed")))
    every = parts[0]
    for more in parts[1:]:
        every = every.unionByName(more)
    return ev.auc(every, "p", "y", ["first", "seed"])


DAYS = "cut AS (SELECT CAST(c AS DATE) + CAST(k AS INT) AS cutoff FROM (SELECT unnest(generate_series(date_trunc('month', min(day)) + INTERVAL 1 MONTH, date_trunc('month', max(day)), INTERVAL 1 MONTH)) AS c FROM activity), (SELECT unnest([0, 7, 14, 21]) AS k))"


@query("rpt_4_scoring_days", with_("activity") + f""", {DAYS}, {pl.ACTIVE}, {pl.POP}, {pl.LABELS}, x AS (SELECT cutoff, player_id, cutoff - max(day) AS s FROM cut JOIN a ON day > cutoff - 180 AND day <= cutoff GROUP BY cutoff, player_id),
j AS (SELECT day(cutoff) AS day, event_60d AS y, s FROM labels JOIN x USING (cutoff, player_id) WHERE event_60d IS NOT NULL), r AS (SELECT *, rank() OVER (PARTITION BY day ORDER BY s) + (count(*) OVER (PARTITION BY day, s) - 1) / 2.0::DOUBLE AS r FROM j)
SELECT CAST(day AS INT) AS day, CAST(sum(y) AS BIGINT) AS pos, count(*) FILTER (y = 0) AS neg, round((sum(r) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * count(*) FILTER (y = 0)), 6) AS auc FROM r GROUP BY day""")
def rpt_4(spark, d):
    """RPT-4: the AUC of recency by the day of the month on which players are scored."""
    from lakepulse.operators import labels
    from lakepulse.sources import lens

    days = lens.activity(spark, d)
    cuts = pl.cut(spark, d).withColumn("cutoff", F.explode(F.array(*[F.date_add("cutoff", k) for k in (0, 7, 14, 21)])))
    recency = labels._windowed(days.where("active"), cuts, 180).groupBy("cutoff", "player_id").agg(F.min(F.datediff("cutoff", "day")).alias("s"))
    rows = labels.churn_labels(days, cuts, None, 60, 180).where("event_60d is not null").join(recency, ["cutoff", "player_id"])
    return ev.auc(rows.withColumn("day", F.dayofmonth("cutoff")), "s", "event_60d", ["day"])

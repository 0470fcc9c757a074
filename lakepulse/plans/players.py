"""Queries on player activity, labels, features, signals."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakepulse.operators import activity as act
from lakepulse.operators import evaluate as ev
from lakepulse.operators import labels, sessions, signals
from lakepulse.operators.ranks import attach, quantiles
from lakepulse.sources import lens
from lakepulse.sources.lake import kept
from lakepulse.sources.lens import with_

from .registry import query

#: Month starts over all days that there are, and the last day.
CUT = "cut AS (SELECT CAST(unnest(generate_series(date_trunc('month', min(day)) + INTERVAL 1 MONTH, date_trunc('month', max(day)), INTERVAL 1 MONTH)) AS DATE) AS cutoff FROM activity)"
END_DAY = "(SELECT max(day) FROM activity)"
WINDOWS = (7, 30, 90, 180)
ACTIVE = "a AS (SELECT DISTINCT player_id, brand, day FROM activity WHERE active)"
POP = "pop AS (SELECT DISTINCT cutoff, player_id, brand FROM cut JOIN a ON day > cutoff - 180 AND day <= cutoff)"


def cut(spark, d):
    return act.cutoffs_of(lens.stakes(spark, d))


@query("cache_1_activity", with_("activity") + " SELECT * FROM activity")
def cache_1(spark, d):
    return lens.activity(spark, d)


@query("cache_2_financial", with_("players", "payments") + " SELECT p.* FROM payments p WHERE (deposit_c <> 0 OR withdraw_c <> 0 OR failed <> 0) AND player_id IN (SELECT player_id FROM players WHERE brand = 'BUILDING')")
def cache_2(spark, d):
    return act.non_zero_days(lens.payments(spark, d), lens.players(spark, d).where("brand = 'BUILDING'"), ["deposit_c", "withdraw_c", "failed"])


@query("cache_3_payments", with_("payments") + " SELECT * FROM payments")
def cache_3(spark, d):
    return lens.payments(spark, d)


@query("scan_1_day_range", with_("activity") + " SELECT player_id, day, turnover_c FROM activity WHERE day BETWEEN DATE '1998-01-01' AND DATE '1998-06-30' AND brand = 'MACHINERY' AND active")
def scan_1(spark, d):
    return act.scan(lens.activity(spark, d), "1998-01-01", "1998-06-30", ["player_id", "day", "turnover_c"], "MACHINERY", True)


@query("scan_2_union_by_name", "SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice FROM orders WHERE o_orderkey % 2 = 0 UNION ALL BY NAME SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 2 = 1")
def scan_2(spark, d):
    """SCAN-2, SETS-1: two landing sources by name; absent columns are null."""
    orders = lens.table(spark, d, "orders")
    even, odd = orders.where("o_orderkey % 2 = 0"), orders.where("o_orderkey % 2 = 1")
    return even.select("o_orderkey", "o_custkey", "o_totalprice").unionByName(odd.select("o_orderkey", "o_orderstatus"), allowMissingColumns=True)


@query("scan_5_days", "SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders WHERE CAST(o_orderdate AS DATE) IN (DATE '1996-02-01', DATE '1997-03-05', DATE '1999-12-24') GROUP BY ALL")
def scan_5(spark, d):
    return lens.stakes(spark, d).where(F.col("day").isin("1996-02-01", "1997-03-05", "1999-12-24")).groupBy("day").agg(F.count("*").alias("n"))


@query("filt_1_population", with_("activity") + f", {CUT}, {ACTIVE}, {POP} SELECT * FROM pop")
def filt_1(spark, d):
    return act.population(lens.activity(spark, d), cut(spark, d), 180)


LABELS = f"""off AS (SELECT cutoff, player_id, brand, 0 AS t FROM pop UNION ALL SELECT cutoff, pop.player_id, pop.brand, day - cutoff FROM pop JOIN (SELECT DISTINCT player_id, day FROM a) USING (player_id) WHERE day > cutoff AND day <= {END_DAY}),
g AS (SELECT *, lead(t) OVER (PARTITION BY cutoff, player_id, brand ORDER BY t) AS nx, {END_DAY} - cutoff AS known FROM off),
h AS (SELECT cutoff, player_id, brand, min(t) FILTER (t > 0) AS first_day, min(t) FILTER (coalesce(nx, 1000000) > t + 60 AND t + 60 <= known) AS churn_day, max(t) AS last_active, max(known) AS known FROM g GROUP BY ALL),
labels AS (SELECT cutoff, player_id, brand, CASE WHEN known >= 60 THEN CAST(first_day IS NULL OR first_day > 60 AS INT) END AS event_60d, CAST(coalesce(churn_day, last_active) AS INT) AS duration_days, CAST(churn_day IS NOT NULL AS INT) AS event_observed,
{", ".join(f"CASE WHEN known >= {h} + 60 THEN CAST(coalesce(churn_day <= {h}, false) AS INT) END AS churn_within_{h}d" for h in (7, 14, 30))} FROM h)"""


@query("lab_2_5_churn_labels", with_("activity") + f", {CUT}, {ACTIVE}, {POP}, {LABELS} SELECT * FROM labels")
def lab(spark, d):
    return labels.churn_labels(lens.activity(spark, d), cut(spark, d), None, 60, 180)


def _features_sql() -> str:
    parts = []
    for n in WINDOWS:
        near, far = f"age < {n}", f"age >= {n} AND age < {2 * n}"
        parts += [f"count(*) FILTER (active AND {near}) AS active_days_l{n}d", f"count(*) FILTER (active AND {far}) AS prior_active_days_l{n}d"]
        for name, e, w in ((f"bets_l{n}d", "bets", near), (f"wagered_c_l{n}d", "turnover_c", near), (f"prior_wagered_c_l{n}d", "turnover_c", far), (f"ggr_c_l{n}d", "ggr_c", near), (f"prior_ggr_c_l{n}d", "ggr_c", far), (f"bonus_c_l{n}d", "bonus_c", near)):
            parts.append(f"CAST(coalesce(sum({e}) FILTER ({w}), 0) AS BIGINT) AS {name}")
    return f"""rows_ AS (SELECT cutoff, activity.*, cutoff - day AS age FROM cut JOIN activity ON day > cutoff - 360 AND day <= cutoff),
    f AS (SELECT cutoff, player_id, brand, CAST(min(age) FILTER (active) AS INT) AS days_since_last_bet, CAST(least(max(age) FILTER (active), 150) AS INT) AS days_since_first_bet, {", ".join(parts)} FROM rows_ GROUP BY ALL),
    features AS (SELECT *, ggr_c_l7d AS net_loss_7d, (wagered_c_l7d + 1) / (prior_wagered_c_l7d + 1) AS wagered_trend_7, (active_days_l7d + 1) / (prior_active_days_l7d + 1) AS active_days_7_vs_prior7,
    CASE WHEN ggr_c_l90d / 90.0::DOUBLE * 7 > 0 THEN ggr_c_l7d / (ggr_c_l90d / 90.0::DOUBLE * 7) END AS heavy_loss_multiple, CAST(coalesce(ggr_c_l7d > 0 AND ggr_c_l90d > 0 AND ggr_c_l7d / (ggr_c_l90d / 90.0::DOUBLE * 7) > 2, false) AS INT) AS heavy_loss_flag,
    CASE WHEN bets_l30d > 0 THEN wagered_c_l30d / bets_l30d END AS avg_bet_c_l30d, CASE WHEN bets_l90d > 0 THEN wagered_c_l90d / bets_l90d END AS avg_bet_c, CASE WHEN wagered_c_l30d > 0 THEN bonus_c_l30d / wagered_c_l30d END AS bonus_stake_share_30d FROM f)"""


FEATURES = _features_sql()


@query("feat_rfm", with_("activity") + f", {CUT}, {FEATURES} SELECT * FROM features")
def feat(spark, d):
    return labels.rfm_features(lens.activity(spark, d), cut(spark, d), WINDOWS)


@query("slice_churn_rfm", with_("activity") + f", {CUT}, {ACTIVE}, {POP}, {LABELS}, {FEATURES} SELECT * FROM labels JOIN features USING (cutoff, player_id, brand)")
def slice_(spark, d):
    """The flagship: churn labels and recency, frequency and value features at monthly cutoffs. Player-days are built once for both."""
    days, cuts = kept(lens.activity(spark, d)), cut(spark, d)
    return labels.churn_labels(days, cuts, None, 60, 180).join(labels.rfm_features(days, cuts, WINDOWS), ["cutoff", "player_id", "brand"])


def _dormancy_sql(k: int) -> str:
    back = f"gap > {k}"
    return f"count(*) FILTER ({back}) AS prior_dormancy_spells_{k}d, CAST(coalesce(min(cutoff - day) FILTER ({back}), 181) AS INT) AS days_since_last_return_{k}d"


@query("feat_dormancy", with_("activity") + f""", {CUT}, a AS (SELECT player_id, brand, day, day - lag(day) OVER (PARTITION BY player_id ORDER BY day) AS gap FROM (SELECT DISTINCT player_id, brand, day FROM activity WHERE active))
SELECT cutoff, player_id, {_dormancy_sql(14)}, {_dormancy_sql(30)} FROM cut JOIN a ON day > cutoff - 180 AND day <= cutoff GROUP BY ALL""")
def feat_dormancy(spark, d):
    """F26, F27, F44"""
    return labels.dormancy(lens.activity(spark, d), cut(spark, d))


SPELL = f"""sp AS (SELECT player_id, day, coalesce(nx, {END_DAY}) - day AS length, nx IS NOT NULL AS closed, {END_DAY} - day AS follow
FROM (SELECT player_id, day, lead(day) OVER (PARTITION BY player_id ORDER BY day) AS nx FROM (SELECT DISTINCT player_id, day FROM activity WHERE active)))"""


@query("spell_1_silent_spells", with_("activity") + f", {SPELL} SELECT player_id, day, CAST(length AS INT) AS length, closed, CAST(follow AS INT) AS follow FROM sp")
def spell_1(spark, d):
    return labels.spells(lens.activity(spark, d))


@query("spell_2_return_curve", with_("activity") + f""", {SPELL} SELECT CAST(d AS INT) AS d, count(*) AS spells, count(*) FILTER (closed AND length <= d + 60) AS returned, count(*) FILTER (closed AND length <= d + 60) / count(*) AS return_rate
FROM sp JOIN range(1, 121) t(d) ON length >= d AND follow >= d + 60 GROUP BY ALL""")
def spell_2(spark, d):
    return labels.return_curve(spell_1(spark, d))


@query("spell_6_gaps", with_("activity") + ", g AS (SELECT brand, day - lag(day) OVER (PARTITION BY player_id ORDER BY day) AS gap FROM activity WHERE active) SELECT brand, count(gap) AS n, "
       + ", ".join(f"round(count(*) FILTER (gap >= {k}) / count(gap), 6) AS share_{k}" for k in (7, 30, 60, 180)) + " FROM g GROUP BY ALL")
def spell_6(spark, d):
    from pyspark.sql import Window

    g = lens.activity(spark, d).where("active").withColumn("gap", F.datediff("day", F.lag("day").over(Window.partitionBy("player_id").orderBy("day"))))
    return g.groupBy("brand").agg(F.count("gap").alias("n"), *[F.round(F.count_if(F.col("gap") >= k) / F.count("gap"), 6).alias(f"share_{k}") for k in (7, 30, 60, 180)])


@query("win_7_losing_streak", with_("activity") + " SELECT player_id, count(*) FILTER (other = 0) AS streak, count(*) AS days FROM (SELECT player_id, sum(CAST(ggr_c <= 0 AS INT)) OVER (PARTITION BY player_id ORDER BY day DESC) AS other FROM activity) GROUP BY ALL")
def win_7(spark, d):
    return sessions.losing_streak(lens.activity(spark, d), "player_id", "ggr_c")


@query("win_8_active_runs", """WITH e AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events), r AS (SELECT user_id, day, day - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INT) AS run FROM e)
SELECT user_id, min(day) AS first_day, max(day) AS last_day, count(*) AS days FROM r GROUP BY user_id, run""")
def win_8(spark, d):
    return sessions.islands(lens.table(spark, d, "events").select("user_id", F.to_date("ts").alias("day")), "user_id")


SESSIONS = """g AS (SELECT user_id, ts, event_id, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS gap FROM events),
e AS (SELECT *, unnest([15, 30, 60]) AS minutes FROM g),
s AS (SELECT *, sum(CAST(gap IS NULL OR gap > minutes * 60000000::BIGINT AS BIGINT)) OVER (PARTITION BY user_id, minutes ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session FROM e),
x AS (SELECT user_id, minutes, CAST(session AS BIGINT) AS session, CAST(min(ts) AS DATE) AS day, count(*) AS events, CAST(floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000) AS BIGINT) AS seconds FROM s GROUP BY ALL)"""


@query("sess_1_sessions", f"WITH {SESSIONS} SELECT * FROM x")
def sess_1(spark, d):
    return sessions.sessions(lens.table(spark, d, "events"), "user_id", "ts")


@query("sess_1_player_days", f"WITH {SESSIONS} SELECT user_id, minutes, day, count(*) AS sessions, count(*) FILTER (events = 1) AS single, CAST(sum(seconds) AS BIGINT) AS seconds, max(seconds) AS longest FROM x GROUP BY ALL")
def sess_days(spark, d):
    return sessions.session_days(sess_1(spark, d), "user_id")


@query("agg_54_timeout_sensitivity", f"WITH {SESSIONS} SELECT minutes, count(*) AS sessions, round(quantile_cont(seconds, 0.5), 4) AS median, round(quantile_cont(seconds, 0.99), 4) AS p99, round(count(*) FILTER (seconds > 14400) / count(*), 6) AS over_4h FROM x GROUP BY ALL")
def agg_54(spark, d):
    rows = sess_1(spark, d)
    found = rows.groupBy("minutes").agg(F.count("*").alias("sessions"), F.round(F.count_if(F.col("seconds") > 14400) / F.count("*"), 6).alias("over_4h"))
    found = attach(found, quantiles(rows, "seconds", ["minutes"], [0.5, 0.99]), ["minutes"])
    return found.select("minutes", "sessions", F.round(F.col("q")[0], 4).alias("median"), F.round(F.col("q")[1], 4).alias("p99"), "over_4h")


@query("agg_43_time_of_play", """WITH l AS (SELECT user_id, timezone('Europe/Madrid', timezone('UTC', ts)) AS t FROM events), h AS (SELECT user_id, hour(t) AS hour, count(*) AS n, sum(CAST(isodow(t) >= 6 AS INT)) AS weekend FROM l GROUP BY ALL),
s AS (SELECT *, n / sum(n) OVER (PARTITION BY user_id) AS share FROM h)
SELECT user_id, CAST(sum(n) AS BIGINT) AS events, round(sum(CASE WHEN hour < 6 THEN n ELSE 0 END) / sum(n), 6) AS night_share, round(sum(weekend) / sum(n), 6) AS weekend_share, round(-sum(share * ln(share)) / ln(24), 6) AS entropy FROM s GROUP BY ALL""")
def agg_43(spark, d):
    return sessions.time_of_play(lens.table(spark, d, "events"), "user_id", "ts", "Europe/Madrid")


@query("sig_catalogue", with_("activity") + f""", {CUT}, {FEATURES},
z AS (SELECT *, avg(CASE WHEN avg_bet_c > 0 THEN avg_bet_c END) OVER (PARTITION BY cutoff, brand) AS m, stddev_pop(CASE WHEN avg_bet_c > 0 THEN avg_bet_c END) OVER (PARTITION BY cutoff, brand) AS sd FROM features),
s AS (SELECT *, CASE WHEN avg_bet_c > 0 AND sd > 0 THEN (avg_bet_c - m) / sd ELSE 0 END AS z,
 CASE WHEN bets_l7d > 0 AND bets_l30d > 0 THEN (wagered_c_l7d / bets_l7d - avg_bet_c_l30d) / avg_bet_c_l30d ELSE 0 END AS rise,
 CASE WHEN days_since_last_bet = 0 THEN 100 ELSE 100 * (1 - least(1.0, days_since_last_bet / 30.0::DOUBLE)) END AS recency,
 CASE WHEN active_days_l30d > 0 THEN 100 * greatest(0, 1 - (active_days_l7d / 7.0::DOUBLE) / (active_days_l30d / 30.0::DOUBLE)) ELSE 0 END AS frequency,
 CASE WHEN ggr_c_l90d > 0 THEN 100 * greatest(0, 1 - (ggr_c_l7d / 7.0::DOUBLE) / (ggr_c_l90d / 90.0::DOUBLE)) ELSE 0 END AS value FROM z),
c AS (SELECT *, greatest(0, least(100, 0.5::DOUBLE * (100 - recency) + 0.3::DOUBLE * frequency + 0.2::DOUBLE * value)) AS churn FROM s)
SELECT cutoff, player_id, brand, round(z, 4) AS bet_z, round(rise, 4) AS escalation, round(greatest(0, least(100, 50 + 50 * greatest(-1, least(1, z)))), 4) AS risk_appetite,
 round(greatest(0, least(100, 50 + 25 * greatest(-2, least(2, z)) + 25 * greatest(-1, least(1, rise)))), 4) AS aggression, round(recency, 4) AS recency, round(frequency, 4) AS frequency_decline, round(value, 4) AS value_decline,
 round(churn, 4) AS churn_score, CASE WHEN churn < 25 THEN 'low' WHEN churn < 50 THEN 'medium' WHEN churn < 75 THEN 'high' ELSE 'critical' END AS churn_band,
 round(least(1.0, days_since_last_bet / 90.0::DOUBLE), 4) AS propensity, round(CASE WHEN ggr_c_l30d < 0 AND wagered_c_l30d > 0 THEN least(1.0, -ggr_c_l30d / wagered_c_l30d) ELSE 0 END, 4) AS loss_chasing,
 round(greatest(0.0, ggr_c_l7d + 0.7::DOUBLE * (ggr_c_l30d - ggr_c_l7d) + 0.4::DOUBLE * (ggr_c_l90d - ggr_c_l30d) + 0.2::DOUBLE * (ggr_c_l180d - ggr_c_l90d)), 2) AS value_score
FROM c""")
def sig(spark, d):
    """SIG-02, 03, 04, 06, 07, 09, 10, 15, 16, 17, 18, 19 on look-backs of 7/30/90/180 days."""
    f = signals.with_z_score(feat(spark, d), "avg_bet_c", ["cutoff", "brand"], "z")
    recent = F.try_divide(F.col("wagered_c_l7d").cast("double"), F.col("bets_l7d"))
    f = f.withColumn("rise", F.coalesce(signals.escalation(recent, F.col("avg_bet_c_l30d")), F.lit(0.0)))
    f = f.withColumn("recency_", signals.recency_score(F.col("days_since_last_bet"), F.col("days_since_last_bet") == 0))
    f = f.withColumn("frequency", signals.value_decline("active_days_l7d", "active_days_l30d", 7.0, 30.0)).withColumn("value", signals.value_decline("ggr_c_l7d", "ggr_c_l90d", 7.0, 90.0))
    f = f.withColumn("churn", signals.churn_score(100 - F.col("recency_"), F.col("frequency"), F.col("value")))
    r = lambda c: F.round(c, 4)
    return f.select(
        "cutoff", "player_id", "brand", r("z").alias("bet_z"), r("rise").alias("escalation"), r(signals.risk_appetite(F.col("z"))).alias("risk_appetite"), r(signals.betting_aggression(F.col("z"), F.col("rise"))).alias("aggression"),
        r("recency_").alias("recency"), r("frequency").alias("frequency_decline"), r("value").alias("value_decline"), r("churn").alias("churn_score"), signals.band(F.col("churn")).alias("churn_band"),
        r(signals.propensity(F.col("days_since_last_bet"))).alias("propensity"), r(signals.loss_chasing("ggr_c_l30d", "wagered_c_l30d")).alias("loss_chasing"),
        F.round(signals.value_score("ggr_c_l7d", "ggr_c_l30d", "ggr_c_l90d", "ggr_c_l180d"), 2).alias("value_score"),
    )


SCORED = f"{CUT}, {ACTIVE}, {POP}, {LABELS}, {FEATURES}, sc AS (SELECT cutoff, player_id, brand, event_60d AS y, days_since_last_bet AS s, greatest(0, least(1, days_since_last_bet / 180.0::DOUBLE)) AS p, ggr_c_l90d AS v, duration_days, event_observed, active_days_l180d AS ad FROM labels JOIN features USING (cutoff, player_id, brand) WHERE event_60d IS NOT NULL)"


def scored(spark, d):
    p = signals.clamp(F.col("days_since_last_bet") / F.lit(180.0), 0.0, 1.0)
    return slice_(spark, d).where("event_60d is not null").select("cutoff", "player_id", "brand", F.col("event_60d").alias("y"), F.col("days_since_last_bet").alias("s"), p.alias("p"), F.col("ggr_c_l90d").alias("v"), "duration_days", "event_observed", F.col("active_days_l180d").alias("ad"))


@query("eval_1_auc", with_("activity") + f""", {SCORED}, r AS (SELECT *, rank() OVER w AS r, count(*) OVER (PARTITION BY brand, s) AS ties FROM sc WINDOW w AS (PARTITION BY brand ORDER BY s))
SELECT brand, CAST(sum(y) AS BIGINT) AS pos, count(*) FILTER (y = 0) AS neg, round((sum(CASE WHEN y = 1 THEN r + (ties - 1) / 2.0::DOUBLE END) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * count(*) FILTER (y = 0)), 6) AS auc FROM r GROUP BY brand""")
def eval_1(spark, d):
    return ev.auc(scored(spark, d), "s", "y", ["brand"])


@query("eval_2_losses", with_("activity") + f", {SCORED}, q AS (SELECT *, greatest(1e-6, least(1 - 1e-6, p)) AS c FROM sc) SELECT brand, count(*) AS n, round(-avg(CASE WHEN y = 1 THEN ln(c) ELSE ln(1 - c) END), 6) AS log_loss, round(avg((p - y) * (p - y)), 6) AS brier FROM q GROUP BY brand")
def eval_2(spark, d):
    return ev.losses(scored(spark, d), "p", "y", ["brand"])


@query("eval_2_average_precision", with_("activity") + f""", {SCORED}, b AS (SELECT brand, s, sum(y) AS pos, count(*) AS n FROM sc GROUP BY ALL), w AS (SELECT *, sum(pos) OVER x AS tp, sum(n) OVER x AS al FROM b WINDOW x AS (PARTITION BY brand ORDER BY s DESC))
SELECT brand, round(sum(pos * (tp / al)) / sum(pos), 6) AS average_precision FROM w GROUP BY brand""")
def eval_ap(spark, d):
    return ev.average_precision(scored(spark, d), "s", "y", ["brand"])


@query("eval_3_calibration", with_("activity") + f""", {SCORED}, e AS (SELECT list_distinct(quantile_cont(p, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9])) AS edges FROM sc), b AS (SELECT *, CAST(len(list_filter(edges, lambda x: x < p)) AS INT) AS bin FROM sc, e)
SELECT bin, count(*) AS n, round(avg(p), 6) AS mean_p, round(avg(y), 6) AS rate, round(abs(avg(p) - avg(y)), 6) AS gap FROM b GROUP BY bin""")
def eval_3(spark, d):
    return ev.calibration(scored(spark, d), "p", "y")


@query("eval_4_top_decile", with_("activity") + f""", {SCORED}, r AS (SELECT *, row_number() OVER (PARTITION BY cutoff ORDER BY s DESC, player_id) AS r, count(*) OVER (PARTITION BY cutoff) AS n FROM sc),
t AS (SELECT cutoff, count(*) FILTER (top) AS k, count(*) AS n, sum(y) FILTER (top) AS hits, sum(y) AS pos FROM (SELECT *, r <= greatest(1, floor(n * 0.1::DOUBLE + 0.5)) AS top FROM r) GROUP BY ALL)
SELECT cutoff, k, n, round(hits / k, 6) AS precision, round(hits / nullif(pos, 0), 6) AS recall, round(hits / k / nullif(pos / n, 0), 6) AS lift FROM t""")
def eval_4(spark, d):
    return ev.top_share(scored(spark, d), "s", "y", "player_id", ["cutoff"])


@query("eval_5_concordance", with_("activity") + f""", {SCORED}, c AS (SELECT cutoff, duration_days AS t, ad AS r, sum(event_observed) AS d, count(*) AS n FROM sc GROUP BY ALL)
SELECT a.cutoff, CAST(sum(a.d * b.n) AS BIGINT) AS pairs, round(sum(a.d * b.n * CASE WHEN b.r < a.r THEN 1.0::DOUBLE WHEN b.r = a.r THEN 0.5 ELSE 0 END) / sum(a.d * b.n), 6) AS c_index FROM c a JOIN c b ON b.t > a.t AND b.cutoff = a.cutoff WHERE a.d > 0 GROUP BY a.cutoff""")
def eval_5(spark, d):
    return ev.concordance(scored(spark, d), "duration_days", "event_observed", "ad", ["cutoff"]).where("pairs > 0")


@query("eval_6_kaplan_meier", with_("activity") + f""", {SCORED}, c AS (SELECT brand, duration_days AS t, CAST(sum(event_observed) AS BIGINT) AS d, count(*) AS n FROM sc GROUP BY ALL),
r AS (SELECT *, CAST(sum(n) OVER (PARTITION BY brand ORDER BY t DESC) AS BIGINT) AS at_risk FROM c)
SELECT * FROM (SELECT brand, t, d, at_risk, round(CASE WHEN max(CAST(d = at_risk AS INT)) OVER w = 1 THEN 0 ELSE exp(sum(CASE WHEN d < at_risk THEN ln(1 - d / at_risk) ELSE 0 END) OVER w) END, 6) AS survival FROM r WINDOW w AS (PARTITION BY brand ORDER BY t)) WHERE d > 0""")
def eval_6(spark, d):
    return ev.kaplan_meier(scored(spark, d), "duration_days", "event_observed", ["brand"])


@query("eval_15_lift", with_("activity") + f""", {SCORED}, q AS (SELECT cutoff, count(*) FILTER (s > 90 AND y = 1) AS a, count(*) FILTER (s > 90) AS n1, count(*) FILTER (s <= 90 AND y = 1) AS c, count(*) FILTER (s <= 90) AS n0 FROM sc GROUP BY ALL),
l AS (SELECT *, CASE WHEN a > 0 AND c > 0 THEN (a / n1) / (c / n0) END AS l, CASE WHEN a > 0 AND c > 0 THEN sqrt(1 / a - 1 / n1 + 1 / c - 1 / n0) END AS se FROM q)
SELECT cutoff, a, n1, c, n0, round(l, 6) AS lift, round(l * exp(-1.96::DOUBLE * se), 6) AS low, round(l * exp(1.96::DOUBLE * se), 6) AS high FROM l""")
def eval_15(spark, d):
    return ev.lift_table(scored(spark, d).withColumn("signal", (F.col("s") > 90).cast("int")), "signal", "y", ["cutoff"])


@query("win_13_deciles", with_("activity") + f", {SCORED} SELECT cutoff, brand, player_id, CAST(ceil(row_number() OVER (PARTITION BY cutoff, brand ORDER BY p DESC, player_id) * 10 / count(*) OVER (PARTITION BY cutoff, brand)) AS INT) AS decile FROM sc")
def win_13(spark, d):
    return ev.deciles(scored(spark, d), "p", "player_id", ["cutoff", "brand"]).select("cutoff", "brand", "player_id", "decile")


#: Cutoffs before the middle of those there are make the reference.
MIDDLE = "mid AS (SELECT min(cutoff) + CAST((max(cutoff) - min(cutoff)) // 2 AS INT) AS m FROM cut)"


def middle(rows):
    ends = rows.agg(F.min("cutoff").alias("_a"), F.max("cutoff").alias("_b"))
    return ends.select(F.date_add("_a", F.floor(F.datediff("_b", "_a") / 2).cast("int")).alias("middle"))


@query("alrt_4_psi", with_("activity") + f""", {SCORED}, {MIDDLE}, e AS (SELECT list_distinct(quantile_cont(ad, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1])) AS q, count(DISTINCT ad) <= 10 AS single FROM sc, mid WHERE cutoff < m),
b AS (SELECT CASE WHEN single THEN ad ELSE len(list_filter(list_sort(q)[2:len(q) - 1], lambda x: x <= ad)) END AS bin, count(*) FILTER (cutoff < m) AS e, count(*) FILTER (cutoff >= m) AS a FROM sc, e, mid GROUP BY bin),
s AS (SELECT greatest(1e-4, e / sum(e) OVER ()) AS e, greatest(1e-4, a / sum(a) OVER ()) AS a FROM b) SELECT round(sum((a - e) * ln(a / e)), 6) AS psi FROM s""")
def alrt_4(spark, d):
    """ALRT-4: stability of the active days of the later cutoffs against the earlier ones."""
    rows = scored(spark, d).join(F.broadcast(middle(cut(spark, d))))
    return ev.psi(rows.where("cutoff < middle"), rows.where("cutoff >= middle"), "ad")

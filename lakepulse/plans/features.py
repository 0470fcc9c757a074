"""Queries on payment, session and play features at weekly cutoffs over the days of events, and the signals made from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakepulse.operators import labels, payments, sessions, signals
from lakepulse.sources import lens
from lakepulse.sources.lens import with_

from . import players as pl
from .registry import query

WEEKS = "c AS (SELECT CAST(unnest(generate_series(min(day) + 7, max(day), INTERVAL 7 DAY)) AS DATE) AS cutoff FROM payments)"


def weeks(spark, d):
    return payments.weekly_cutoffs(lens.payments(spark, d))


def _sums(windows: dict[str, tuple[int, int]]) -> str:
    out = []
    for name, (near, far) in windows.items():
        w = f"cutoff - day >= {near} AND cutoff - day < {far}"
        out += [f"count(*) FILTER (deposits > 0 AND {w}) AS days_{name}", f"CAST(coalesce(sum(deposits) FILTER ({w}), 0) AS BIGINT) AS n_{name}", f"CAST(coalesce(sum(deposit_c) FILTER ({w}), 0) AS BIGINT) AS sum_{name}", f"avg(deposit_c / deposits) FILTER (deposits > 0 AND {w}) AS mean_{name}"]
    return ", ".join(out)


PAID = f"""s AS (SELECT cutoff, player_id, {_sums(payments.SPANS)}, max(day) FILTER (deposits > 0) AS last_deposit, max(day) FILTER (withdrawals > 0 AND cutoff - day < 14) AS last_withdrawal, CAST(coalesce(sum(failed) FILTER (cutoff - day < 14), 0) AS BIGINT) AS failed_deposits_14d,
CAST(coalesce(sum(withdraw_c) FILTER (cutoff - day < 30), 0) AS BIGINT) AS withdraw_30 FROM c JOIN payments ON day > cutoff - 180 AND day <= cutoff GROUP BY cutoff, player_id),
paid AS (SELECT cutoff, player_id, CAST(least(coalesce(cutoff - last_deposit, 31), 31) AS INT) AS days_since_last_deposit, days_7 AS n_deposit_days_7d, days_30 AS n_deposit_days_30d, sum_30 AS deposits_c_l30d, CASE WHEN sum_30 > 0 THEN withdraw_30 / sum_30 END AS withdrawals_30d_share,
CASE WHEN sum_prior30 > 0 THEN sum_30 / sum_prior30 END AS deposits_30_vs_prior30, CAST(coalesce(cutoff - last_deposit < 3, false) AS INT) AS deposited_within_3d, CAST(coalesce(cutoff - last_deposit < 7, false) AS INT) AS deposited_within_7d, CAST(coalesce(cutoff - last_deposit < 14, false) AS INT) AS deposited_within_14d,
CASE WHEN n_30 = 0 THEN 0 ELSE greatest(0, least(100, 50 + 50 * greatest(-1, least(1, (n_7 / 7.0::DOUBLE) / (n_30 / 30.0::DOUBLE) - 1)))) END AS deposit_frequency_score, failed_deposits_14d, (days_30 + 1) / (days_prior30 + 1) AS deposit_days_ratio_30_vs_prior30,
CASE WHEN mean_30_120 > 0 THEN round(mean_30 / mean_30_120, 6) END AS deposit_size_trend, CAST(coalesce(last_withdrawal >= coalesce(last_deposit, DATE '1900-01-01'), false) AS INT) AS withdrawal_no_redeposit,
CASE WHEN sum_30 > 0 THEN sum_7 / (sum_30 / 30.0::DOUBLE * 7) ELSE 0 END AS deposit_velocity FROM s)"""


@query("feat_payments", with_("payments") + f", {WEEKS}, {PAID} SELECT * FROM paid")
def feat_payments(spark, d):
    """F02, F10, F11, F17, F18, F24, F35..F41, F43, SIG-08, SIG-11."""
    return payments.deposit_features(lens.payments(spark, d), weeks(spark, d))


PLAYED = f"""{pl.SESSIONS}, v AS (SELECT user_id AS player_id, day, count(*) AS sessions, CAST(sum(seconds) AS BIGINT) AS seconds FROM x WHERE minutes = 30 GROUP BY ALL),
w AS (SELECT cutoff, player_id, CAST(coalesce(sum(sessions) FILTER (cutoff - day < 7), 0) AS BIGINT) AS sessions_l7d, CAST(sum(sessions) AS BIGINT) AS sessions_l30d, CAST(coalesce(sum(seconds) FILTER (cutoff - day < 7), 0) AS BIGINT) AS seconds_l7d, CAST(sum(seconds) AS BIGINT) AS seconds_l30d, count(*) AS played_days_l30d,
CAST(coalesce(sum(sessions) FILTER (cutoff - day >= 7 AND cutoff - day < 14), 0) AS BIGINT) AS s_p7, CAST(coalesce(sum(seconds) FILTER (cutoff - day >= 7 AND cutoff - day < 14), 0) AS BIGINT) AS t_p7, CAST(coalesce(sum(seconds) FILTER (day = cutoff), 0) AS BIGINT) AS today FROM c JOIN v ON day > cutoff - 30 AND day <= cutoff GROUP BY ALL),
played AS (SELECT cutoff, player_id, sessions_l7d, sessions_l30d, (sessions_l7d + 1) / (s_p7 + 1) AS session_ratio_7_vs_prior7, CASE WHEN sessions_l7d > 0 AND s_p7 > 0 AND t_p7 > 0 THEN (seconds_l7d / sessions_l7d) / (t_p7 / s_p7) END AS session_length_ratio,
round(greatest(0, least(100, 0.4::DOUBLE * played_days_l30d / 30 * 100 + 0.3::DOUBLE * least(1, sessions_l30d / 60.0::DOUBLE) * 100 + 0.3::DOUBLE * least(1, seconds_l30d / 108000.0::DOUBLE) * 100)), 6) AS engagement_score,
round(least(100, 100 * today / (seconds_l30d / played_days_l30d + 1)), 6) AS session_intensity, CASE WHEN sessions_l30d > 0 THEN seconds_l30d / sessions_l30d END AS session_seconds FROM w)"""
PLAYED = PLAYED.replace("g AS (SELECT user_id, ts", "gg AS (SELECT user_id, ts").replace("FROM g)", "FROM gg)").replace("e AS (SELECT *, unnest", "ee AS (SELECT *, unnest").replace("FROM e)", "FROM ee)").replace("s AS (SELECT *, sum(CAST(gap", "ss AS (SELECT *, sum(CAST(gap").replace("FROM s GROUP BY ALL), v AS", "FROM ss GROUP BY ALL), v AS").replace("FROM s GROUP BY ALL),\nv AS", "FROM ss GROUP BY ALL),\nv AS").replace("FROM s GROUP BY ALL)", "FROM ss GROUP BY ALL)")


def _session_days(spark, d):
    return sessions.session_days(sessions.sessions(lens.table(spark, d, "events"), "user_id", "ts", (30,)), "user_id").withColumnRenamed("user_id", "player_id")


@query("feat_sessions", with_("payments") + f", {WEEKS}, {PLAYED} SELECT * FROM played")
def feat_sessions(spark, d):
    """F08, F09, F28, F46, F47, SIG-01, SIG-13."""
    return payments.session_features(_session_days(spark, d), weeks(spark, d))


@query("feat_night_index", "WITH p AS (SELECT CAST(ts AS DATE) AS day FROM events), c AS (SELECT CAST(unnest(generate_series(min(day) + 7, max(day), INTERVAL 7 DAY)) AS DATE) AS cutoff FROM p), "
       "l AS (SELECT user_id AS player_id, timezone('Europe/Madrid', timezone('UTC', ts)) AS t FROM events) SELECT cutoff, player_id, count(*) AS events, round(count(*) FILTER (hour(t) < 6) / count(*), 6) AS night_play_index FROM c JOIN l ON CAST(t AS DATE) > cutoff - 30 AND CAST(t AS DATE) <= cutoff GROUP BY ALL")  # fmt: skip
def feat_night(spark, d):
    """share of plays between midnight and six, local time, at cutoffs."""
    local = F.from_utc_timestamp(F.col("ts").cast("timestamp"), "Europe/Madrid")
    rows = lens.table(spark, d, "events").groupBy(F.col("user_id").alias("player_id"), F.to_date(local).alias("day")).agg(F.count("*").alias("n"), F.count_if(F.hour(local) < 6).alias("night"))
    dealt = payments.dealt(rows, weeks(spark, d), 30)
    return dealt.groupBy("cutoff", "player_id").agg(F.sum("n").alias("events"), F.round(F.sum("night") / F.sum("n"), 6).alias("night_play_index"))


@query("sig_session_z", with_("payments", "players") + f", {WEEKS}, {PLAYED}, q AS (SELECT cutoff, p.player_id, coalesce(brand, 'none') AS brand, session_seconds FROM played p LEFT JOIN players USING (player_id)), m AS (SELECT cutoff, brand, avg(session_seconds) FILTER (session_seconds > 0) AS m, stddev_pop(session_seconds) FILTER (session_seconds > 0) AS sd FROM q GROUP BY ALL) "
       "SELECT cutoff, player_id, brand, round(CASE WHEN session_seconds > 0 AND sd > 0 THEN (session_seconds - m) / sd ELSE 0 END, 6) AS session_length_z FROM q JOIN m USING (cutoff, brand)")  # fmt: skip
def sig_session_z(spark, d):
    """SIG-05"""
    rows = feat_sessions(spark, d).join(lens.players(spark, d).select("player_id", "brand"), "player_id", "left").withColumn("brand", F.coalesce("brand", F.lit("none")))
    return signals.with_z_score(rows, "session_seconds", ["cutoff", "brand"], "z").select("cutoff", "player_id", "brand", F.round("z", 6).alias("session_length_z"))


@query("feat_losing_streak", with_("activity") + f", {pl.CUT}, r AS (SELECT cutoff, player_id, ggr_c, sum(CAST(ggr_c <= 0 AS INT)) OVER (PARTITION BY cutoff, player_id ORDER BY day DESC) AS other FROM cut JOIN activity ON day > cutoff - 90 AND day <= cutoff WHERE turnover_c > 0) SELECT cutoff, player_id, count(*) FILTER (other = 0) AS losing_streak FROM r GROUP BY ALL")
def feat_losing_streak(spark, d):
    """F32: at cutoffs, over 90 days."""
    rows = labels._windowed(lens.activity(spark, d).where("turnover_c > 0"), pl.cut(spark, d), 90)
    return sessions.losing_streak(rows, ["cutoff", "player_id"], "ggr_c").select("cutoff", "player_id", F.col("streak").alias("losing_streak"))


PLAYS = """pd AS (SELECT user_id AS player_id, CAST(ts AS DATE) AS day, CAST(sum(c) FILTER (event_type = 'view') AS BIGINT) AS stake_c, CAST(sum(CASE WHEN event_id % 20 = 0 THEN 12 * c ELSE 0 END) FILTER (event_type = 'view') AS BIGINT) AS payout_c, count(*) FILTER (event_type = 'click') AS withdrawals
FROM (SELECT *, CAST(floor(value * 100 + 0.5) AS BIGINT) AS c FROM events) GROUP BY ALL)"""


@query("feat_big_win", with_("payments") + f""", {WEEKS}, {PLAYS}, m AS (SELECT cutoff, player_id, median(stake_c) AS med FROM c JOIN pd ON day > cutoff - 90 AND day <= cutoff GROUP BY ALL),
k AS (SELECT DISTINCT cutoff, a.player_id FROM c JOIN pd a ON a.day > cutoff - 30 AND a.day <= cutoff JOIN m USING (cutoff, player_id) JOIN pd b ON b.player_id = a.player_id AND b.withdrawals > 0 AND b.day BETWEEN a.day AND a.day + 3 AND b.day <= cutoff WHERE a.payout_c - a.stake_c > 5 * med)
SELECT m.cutoff, m.player_id, CAST(k.player_id IS NOT NULL AS INT) AS big_win_then_withdrawal FROM m LEFT JOIN k USING (cutoff, player_id)""")
def feat_big_win(spark, d):
    """F42, JOIN-12: a day of a win over five median stakes, and a withdrawal up to three days later."""
    c = lens.cents("value")
    view = F.col("event_type") == "view"
    plays = lens.table(spark, d, "events").groupBy(F.col("user_id").alias("player_id"), F.to_date("ts").alias("day")).agg(
        F.sum(F.when(view, c)).alias("stake_c"), F.sum(F.when(view, F.when(F.col("event_id") % 20 == 0, 12 * c).otherwise(0))).alias("payout_c"), F.count_if(F.col("event_type") == "click").alias("withdrawals")
    )
    return payments.big_wins(plays, weeks(spark, d))


@query("sig_risk", with_("payments") + f""", {WEEKS}, {PLAYS}, np AS (SELECT user_id AS player_id, CAST(ts AS DATE) AS day, count(*) FILTER (event_type = 'view') AS plays, count(*) AS n, count(*) FILTER (hour(ts) < 6) AS night FROM events GROUP BY ALL),
r AS (SELECT cutoff, player_id, CAST(coalesce(sum(stake_c - payout_c) FILTER (day = cutoff), 0) AS BIGINT) AS today, CAST(coalesce(sum(stake_c - payout_c), 0) AS BIGINT) AS g30, CAST(coalesce(sum(stake_c), 0) AS BIGINT) AS w30, CAST(coalesce(sum(stake_c) FILTER (cutoff - day < 7), 0) AS BIGINT) AS w7,
CAST(sum(plays) AS BIGINT) AS p30, CAST(coalesce(sum(plays) FILTER (cutoff - day < 7), 0) AS BIGINT) AS p7, sum(night) / sum(n) AS night, CAST(sum(deposit_c) AS BIGINT) AS d30, CAST(coalesce(sum(deposit_c) FILTER (cutoff - day < 7), 0) AS BIGINT) AS d7 FROM c JOIN pd ON day > cutoff - 30 AND day <= cutoff JOIN np USING (player_id, day) JOIN payments USING (player_id, day) GROUP BY cutoff, player_id),
s AS (SELECT cutoff, player_id, CASE WHEN g30 < 0 AND w30 > 0 THEN least(1.0, -g30 / w30) ELSE 0 END AS chasing, CASE WHEN d30 > 0 THEN d7 / (d30 / 30.0::DOUBLE * 7) ELSE 0 END AS velocity, night, CASE WHEN p30 > 0 AND p7 > 0 AND w30 > 0 THEN (w7 / p7 - w30 / p30) / (w30 / p30) ELSE 0 END AS rise, greatest(0, -today) / (d30 / 30.0::DOUBLE + 1) AS loss FROM r)
SELECT cutoff, player_id, round(loss, 6) AS net_loss_velocity, round(greatest(0, least(100, 100 * (0.25::DOUBLE * chasing + 0.2::DOUBLE * least(1, velocity / 3) + 0.2::DOUBLE * night + 0.2::DOUBLE * greatest(0, least(1, rise)) + 0.15::DOUBLE * least(1, loss)))), 4) AS risk_score FROM s""")
def sig_risk(spark, d):
    """SIG-12, SIG-14: net-loss velocity, and the weighted risk score with its band limits of 0 and 100."""
    c, view = lens.cents("value"), F.col("event_type") == "view"
    days = lens.table(spark, d, "events").groupBy(F.col("user_id").alias("player_id"), F.to_date("ts").alias("day")).agg(
        F.sum(F.when(view, c)).alias("stake_c"), F.sum(F.when(view, F.when(F.col("event_id") % 20 == 0, 12 * c).otherwise(0))).alias("payout_c"), F.count_if(view).alias("plays"), F.count("*").alias("n"), F.count_if(F.hour("ts") < 6).alias("night")
    )
    both = days.join(lens.payments(spark, d).select("player_id", "day", "deposit_c"), ["player_id", "day"])
    return signals.risk(payments.dealt(both, weeks(spark, d), 30))

"""Queries on monitoring, snapshots, leakage, dataset reports and model inputs."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakepulse.operators import evaluate as ev
from lakepulse.operators import activity as act
from lakepulse.operators import labels, monitor, profiles
from lakepulse.operators.ranks import attach, correlation, placed, quantiles
from lakepulse.sources import lens
from lakepulse.sources.lens import with_

from . import players as pl
from .registry import query

DAY = "dd AS (SELECT 'all' AS g, day, count(*) AS n, CAST(sum(turnover_c) AS BIGINT) AS turnover_c FROM activity GROUP BY day)"


def by_day(spark, d):
    return lens.activity(spark, d).groupBy(F.lit("all").alias("g"), "day").agg(F.count("*").alias("n"), F.sum("turnover_c").alias("turnover_c"))


@query("agg_47_rolling", with_("activity") + f", {DAY} SELECT g, day, n, CAST(sum(n) OVER w AS BIGINT) AS rolling_sum, median(n) OVER w AS rolling_median FROM dd WINDOW w AS (ORDER BY day ROWS 27 PRECEDING)")
def agg_47(spark, d):
    return monitor.rolling(by_day(spark, d), ["g"], "n")


@query("win_17_frozen_days", with_("activity") + f", {DAY} SELECT g, day, n, turnover_c, coalesce(n = lag(n) OVER (ORDER BY day) AND turnover_c <> lag(turnover_c) OVER (ORDER BY day), false) AS frozen FROM dd")
def win_17(spark, d):
    return monitor.frozen_days(by_day(spark, d), ["g"], "n", "turnover_c")


MONTHS = "mm AS (SELECT brand, CAST(date_trunc('month', day) AS DATE) AS month, CASE WHEN sum(ggr_c) >= 0 THEN 'gain' ELSE 'loss' END AS status FROM activity GROUP BY ALL)"


@query("win_18_status_runs", with_("activity") + f""", {MONTHS}, c AS (SELECT *, coalesce(CAST(status <> lag(status) OVER (PARTITION BY brand ORDER BY month) AS INT), 1) AS ch FROM mm),
r AS (SELECT *, CAST(sum(ch) OVER (PARTITION BY brand ORDER BY month) AS BIGINT) AS run FROM c) SELECT brand, run, status, min(month) AS first, max(month) AS last, count(*) AS n FROM r GROUP BY brand, run, status""")
def win_18(spark, d):
    months = lens.activity(spark, d).groupBy("brand", F.trunc("day", "month").alias("month")).agg(F.when(F.sum("ggr_c") >= 0, "gain").otherwise("loss").alias("status"))
    return monitor.status_runs(months, ["brand"], "month", "status")


@query("win_20_biggest_drop", with_("activity") + """, b AS (SELECT brand, day, count(*) AS n FROM activity GROUP BY ALL), x AS (SELECT brand, day, avg(n) OVER p - avg(n) OVER q AS drop_, count(n) OVER p AS a, count(n) OVER q AS c FROM b
WINDOW p AS (PARTITION BY brand ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), q AS (PARTITION BY brand ORDER BY day ROWS BETWEEN 1 FOLLOWING AND 7 FOLLOWING))
SELECT brand, day, round(drop_, 6) AS "drop" FROM (SELECT *, row_number() OVER (PARTITION BY brand ORDER BY drop_ DESC, day) AS r FROM x WHERE a = 7 AND c = 7) WHERE r = 1""")
def win_20(spark, d):
    return monitor.biggest_drop(lens.activity(spark, d).groupBy("brand", "day").agg(F.count("*").alias("n")), ["brand"], "n")


@query("win_6_next_active_day", with_("activity") + " SELECT player_id, day, lead(day) OVER (PARTITION BY player_id ORDER BY day) AS next_day FROM activity WHERE active")
def win_6(spark, d):
    return lens.activity(spark, d).where("active").select("player_id", "day", F.lead("day").over(Window.partitionBy("player_id").orderBy("day")).alias("next_day"))


@query("chk_3_window", with_("activity") + f""", {pl.CUT}, {pl.FEATURES}, s AS (SELECT cutoff, player_id, bets_l90d + CASE WHEN player_id % 50 = 0 THEN 1 ELSE 0 END AS stored FROM features),
e AS (SELECT cutoff, player_id, sum(bets) AS expected FROM cut JOIN activity ON day > cutoff - 90 AND day <= cutoff GROUP BY ALL)
SELECT cutoff, count(*) AS n, count(*) FILTER (stored = coalesce(expected, 0)) AS equal, count(*) FILTER (stored > coalesce(expected, 0)) AS higher, count(*) FILTER (stored < coalesce(expected, 0)) AS lower FROM s LEFT JOIN e USING (cutoff, player_id) GROUP BY cutoff""")
def chk_3(spark, d):
    """CHK-3 on a look-back with planted errors."""
    stored = pl.feat(spark, d).select("cutoff", "player_id", (F.col("bets_l90d") + (F.col("player_id") % 50 == 0).cast("int")).alias("stored"))
    return monitor.window_check(stored, lens.activity(spark, d), "player_id", "bets", "stored", 90)


@query("leak_2_shift_sweep", with_("activity") + f""", {pl.CUT}, a AS (SELECT DISTINCT player_id, day FROM activity WHERE active), st AS (SELECT player_id, cutoff, CAST(cutoff + 7 - max(day) AS INT) AS stored FROM cut JOIN a ON day <= cutoff + 7 AND day > cutoff - 180 GROUP BY player_id, cutoff),
x AS (SELECT player_id, cutoff, stored, s, max(day) AS last FROM st JOIN range(-3, 11) t(s) ON true LEFT JOIN a USING (player_id) WHERE day <= cutoff + CAST(s AS INT) OR day IS NULL GROUP BY ALL),
f AS (SELECT st.player_id, st.cutoff, st.stored, CAST(s AS INT) AS shift, last FROM st JOIN range(-3, 11) t(s) ON true LEFT JOIN x USING (player_id, cutoff, stored, s))
SELECT shift, count(last) AS n, count(*) FILTER (cutoff + shift - last = stored) AS matches, round(count(*) FILTER (cutoff + shift - last = stored) / count(*), 6) AS share FROM f GROUP BY shift""")
def leak_2(spark, d):
    """LEAK-2: a recency built seven days ahead is found out by the shift that matches best."""
    active = lens.activity(spark, d).where("active").select("player_id", "day").distinct()
    rows = labels._windowed(active, pl.cut(spark, d), 180, 7)
    stored = rows.groupBy("player_id", "cutoff").agg(F.datediff(F.date_add("cutoff", 7), F.max("day")).alias("stored"))
    return monitor.shift_sweep(stored, active, "player_id", "cutoff", "stored", (-3, 10))


@query("anom_7_monotone", with_("activity") + f", {pl.CUT}, {pl.FEATURES} SELECT brand, count(*) AS n, count(*) FILTER (NOT (wagered_c_l30d <= wagered_c_l90d AND wagered_c_l90d <= wagered_c_l180d)) AS broken, count(*) FILTER (NOT (ggr_c_l30d <= ggr_c_l90d AND ggr_c_l90d <= ggr_c_l180d)) AS broken_signed FROM features GROUP BY brand")
def anom_7(spark, d):
    f = pl.feat(spark, d)
    of = lambda x: F.count_if(~monitor.monotone([f"{x}_l{n}d" for n in (30, 90, 180)]))
    return f.groupBy("brand").agg(F.count("*").alias("n"), of("wagered_c").alias("broken"), of("ggr_c").alias("broken_signed"))


@query("join_13_growth", with_("activity") + f""", {pl.CUT}, {pl.FEATURES}, p AS (SELECT player_id, cutoff, days_since_first_bet AS t, lag(days_since_first_bet) OVER w AS before, lag(cutoff) OVER w AS last FROM features WINDOW w AS (PARTITION BY player_id ORDER BY cutoff))
SELECT cutoff, count(*) AS n, count(*) FILTER (t < 150 AND before < 150 AND t - before > cutoff - last) AS jumps, count(*) FILTER (t < before) AS falls FROM p WHERE last IS NOT NULL GROUP BY cutoff""")
def join_13(spark, d):
    """JOIN-13, LEAK-6: tenure between consecutive snapshots."""
    w = Window.partitionBy("player_id").orderBy("cutoff")
    t = F.col("days_since_first_bet")
    p = pl.feat(spark, d).select("player_id", "cutoff", t, F.lag(t).over(w).alias("before"), F.lag("cutoff").over(w).alias("last")).where("last is not null")
    jump = (t < 150) & (F.col("before") < 150) & (t - F.col("before") > F.datediff("cutoff", "last"))
    return p.groupBy("cutoff").agg(F.count("*").alias("n"), F.count_if(jump).alias("jumps"), F.count_if(t < F.col("before")).alias("falls"))


@query("agg_36_hour_by_shift", "SELECT CAST(hour(ts) AS INT) AS hour, CAST(CAST(ts + INTERVAL 90 MINUTE AS DATE) - CAST(ts AS DATE) AS INT) AS shift, count(*) AS n FROM events GROUP BY ALL")
def agg_36(spark, d):
    later = F.to_date(F.col("ts") + F.expr("interval 90 minutes"))
    return lens.table(spark, d, "events").groupBy(F.hour("ts").alias("hour"), F.datediff(later, F.to_date("ts")).alias("shift")).agg(F.count("*").alias("n"))


@query("agg_38_two_products", with_("stakes") + ", k AS (SELECT player_id, day, count(DISTINCT product) AS n FROM stakes GROUP BY ALL) SELECT count(*) AS player_days, count(*) FILTER (n > 1) AS with_two FROM k")
def agg_38(spark, d):
    per = lens.stakes(spark, d).groupBy("player_id", "day").agg(F.countDistinct("product").alias("n"))
    return per.agg(F.count("*").alias("player_days"), F.count_if(F.col("n") > 1).alias("with_two"))


@query("agg_39_deposit_completeness", """WITH m AS (SELECT CAST(date_trunc('week', ts) AS DATE) AS week, count(DISTINCT user_id) FILTER (event_type = 'purchase') AS depositors, count(DISTINCT user_id) AS bettors FROM events GROUP BY ALL),
q AS (SELECT quantile_cont(depositors / bettors, 0.75) AS p75 FROM m) SELECT week, depositors, bettors, round(depositors / bettors, 6) AS share, CASE WHEN depositors / bettors < 0.5::DOUBLE * p75 THEN 'INCOMPLETE' ELSE 'ok' END AS status FROM m, q""")
def agg_39(spark, d):
    e = lens.table(spark, d, "events")
    m = e.groupBy(F.to_date(F.date_trunc("week", "ts")).alias("week")).agg(F.countDistinct(F.when(F.col("event_type") == "purchase", F.col("user_id"))).alias("depositors"), F.countDistinct("user_id").alias("bettors"))
    share = F.col("depositors") / F.col("bettors")
    p75 = F.percentile(share, 0.75).over(Window.partitionBy())
    return m.select("week", "depositors", "bettors", F.round(share, 6).alias("share"), F.when(share < 0.5 * p75, "INCOMPLETE").otherwise("ok").alias("status"))


@query("agg_40_player_month", with_("activity") + " SELECT player_id, brand, CAST(date_trunc('month', day) AS DATE) AS month, count(*) FILTER (active) AS active_days, count(*) AS bet_days, CAST(sum(ggr_c) AS BIGINT) AS ggr_c, CAST(sum(turnover_c) AS BIGINT) AS turnover_c FROM activity GROUP BY ALL")
def agg_40(spark, d):
    return lens.activity(spark, d).groupBy("player_id", "brand", F.trunc("day", "month").alias("month")).agg(F.count_if("active").alias("active_days"), F.count("*").alias("bet_days"), F.sum("ggr_c").alias("ggr_c"), F.sum("turnover_c").alias("turnover_c"))


@query("agg_41_player_day_base", with_("gaming") + " SELECT player_id, day, count(DISTINCT game_id) AS games, count(DISTINCT provider) AS providers, CAST(sum(stake_c) AS BIGINT) AS stake_c, CAST(sum(stake_c - payout_c) AS BIGINT) AS ggr_c FROM gaming GROUP BY ALL")
def agg_41(spark, d):
    return lens.gaming(spark, d).groupBy("player_id", "day").agg(F.countDistinct("game_id").alias("games"), F.countDistinct("provider").alias("providers"), F.sum("stake_c").alias("stake_c"), F.sum(F.col("stake_c") - F.col("payout_c")).alias("ggr_c"))


@query("agg_45_days_per_week", "WITH w AS (SELECT user_id, CAST(date_trunc('week', ts) AS DATE) AS week, count(DISTINCT CAST(ts AS DATE)) AS days FROM events GROUP BY ALL) SELECT days, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM w GROUP BY days")
def agg_45(spark, d):
    w = lens.table(spark, d, "events").groupBy("user_id", F.date_trunc("week", "ts").alias("week")).agg(F.countDistinct(F.to_date("ts")).alias("days"))
    per = w.groupBy("days").agg(F.count("*").alias("n"))
    return per.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6))


@query("agg_52_sign_rule", with_("activity") + " SELECT CAST(-sum(ggr_c) AS BIGINT) AS negated, CAST(sum(abs(ggr_c)) AS BIGINT) AS absolute, CAST(sum(ggr_c) AS BIGINT) AS plain FROM activity")
def agg_52(spark, d):
    return lens.activity(spark, d).agg((-F.sum("ggr_c")).alias("negated"), F.sum(F.abs("ggr_c")).alias("absolute"), F.sum("ggr_c").alias("plain"))


@query("act_1_agreement", with_("stakes") + """, x AS (SELECT player_id, CAST(date_trunc('month', day) AS DATE) AS month, count(DISTINCT day) FILTER (real) AS official, count(DISTINCT day) AS any_wallet FROM stakes GROUP BY ALL)
SELECT month, count(*) AS n, count(*) FILTER (official = any_wallet) AS equal, count(*) FILTER (any_wallet > official) AS above, CAST(sum(any_wallet - official) AS BIGINT) AS false_active_days FROM x GROUP BY month""")
def act_1(spark, d):
    x = lens.stakes(spark, d).groupBy("player_id", F.trunc("day", "month").alias("month")).agg(F.countDistinct(F.when(F.col("real"), F.col("day"))).alias("official"), F.countDistinct("day").alias("any_wallet"))
    return x.groupBy("month").agg(F.count("*").alias("n"), F.count_if(F.col("official") == F.col("any_wallet")).alias("equal"), F.count_if(F.col("any_wallet") > F.col("official")).alias("above"), F.sum(F.col("any_wallet") - F.col("official")).alias("false_active_days"))


@query("dist_2_kind", """WITH s AS (SELECT event_type, count(value) AS n, count(DISTINCT value) AS distinct_, count(*) FILTER (value = 0) AS zeros, count(*) FILTER (value < 0) AS negatives, skewness(value) AS sk, max(abs(value)) AS largest, quantile_cont(abs(value), 0.99) FILTER (value <> 0) AS p99 FROM events GROUP BY ALL)
SELECT event_type, n, CASE WHEN n = 0 THEN 'empty' WHEN distinct_ <= 5 THEN 'few_values' WHEN zeros > 0.5 * n THEN 'zero_inflated' WHEN negatives > 0.01 * n THEN 'signed' WHEN sk > 4 THEN 'heavy_tail' WHEN abs(sk) < 0.5 THEN 'symmetric' ELSE 'skewed' END AS kind, largest > 100 * p99 AS extreme FROM s""")
def dist_2(spark, d):
    """DIST-1, DIST-2, DIST-4"""
    v = F.col("value")
    stats = lens.table(spark, d, "events").groupBy("event_type").agg(
        F.count(v).alias("n"), F.countDistinct(v).alias("distinct"), F.count_if(v == 0).alias("zeros"), F.count_if(v < 0).alias("negatives"), profiles.sample_skewness("value").alias("skewness"), F.max(F.abs(v)).alias("largest")
    )
    sizes = lens.table(spark, d, "events").where(v != 0).select("event_type", F.abs(v).alias("size"))
    stats = attach(stats, quantiles(sizes, "size", ["event_type"], [0.99]).select("event_type", F.col("q")[0].alias("p99")), ["event_type"], "left")
    return profiles.kind(stats).select("event_type", "n", "kind", "extreme")


@query("bt_1_rolling_origin", with_("activity") + f", {pl.CUT}, {pl.ACTIVE}, {pl.POP}, pc AS (SELECT DISTINCT cutoff FROM pop) SELECT b.cutoff AS test, count(*) AS n_train, min(a.cutoff) AS first_train, max(a.cutoff) AS last_train FROM pc a JOIN pc b ON a.cutoff + 60 <= b.cutoff GROUP BY b.cutoff HAVING count(*) >= 4")
def bt_1(spark, d):
    """BT-1, LAB-8: each cutoff with the earlier ones whose labels are closed by then; cutoffs are few."""
    cut = pl.filt_1(spark, d).select("cutoff").distinct()
    a, b = cut.select(F.col("cutoff").alias("train")), cut.select(F.col("cutoff").alias("test"))
    pairs = b.join(F.broadcast(a), F.date_add("train", 60) <= F.col("test"))
    return pairs.groupBy("test").agg(F.count("*").alias("n_train"), F.min("train").alias("first_train"), F.max("train").alias("last_train")).where("n_train >= 4")


@query("ml_1_temporal_split", with_("activity") + f", {pl.SCORED}, k AS (SELECT *, dense_rank() OVER (ORDER BY cutoff DESC) AS r FROM sc), s AS (SELECT CASE WHEN r <= 2 THEN 'test' WHEN r = 3 THEN 'valid' ELSE 'train' END AS split, y FROM k) SELECT split, count(*) AS n, CAST(sum(y) AS BIGINT) AS pos, round((count(*) - sum(y)) / sum(y), 6) AS weight FROM s GROUP BY split")
def ml_1(spark, d):
    """ML-1, ML-2: splits by cutoff, and the weight of the positive class. Ranks are of the few cutoffs, not of rows."""
    rows = pl.scored(spark, d)
    ranks = rows.select("cutoff").distinct().withColumn("r", F.dense_rank().over(Window.orderBy(F.desc("cutoff"))))
    split = F.when(F.col("r") <= 2, "test").when(F.col("r") == 3, "valid").otherwise("train")
    return rows.join(F.broadcast(ranks), "cutoff").groupBy(split.alias("split")).agg(F.count("*").alias("n"), F.sum("y").alias("pos"), F.round((F.count("*") - F.sum("y")) / F.sum("y"), 6).alias("weight"))


@query("ml_8_early_rate", with_("activity") + f""", {pl.CUT}, {pl.ACTIVE}, {pl.POP}, n AS (SELECT cutoff, player_id, min(day) - cutoff AS t FROM pop LEFT JOIN (SELECT DISTINCT player_id, day FROM a) USING (player_id) WHERE day > cutoff GROUP BY cutoff, player_id),
x AS (SELECT pop.cutoff, t FROM pop LEFT JOIN n USING (cutoff, player_id)) SELECT cutoff, CAST(k AS INT) AS k, count(*) AS n, count(*) FILTER (coalesce(t, 99999) > k) AS silent_k, count(*) FILTER (coalesce(t, 99999) > 60) AS silent_60 FROM x, (VALUES (14), (21), (30), (45)) v(k) GROUP BY ALL""")
def ml_8(spark, d):
    """ML-8, BT-6: players silent k days after a cutoff and after 60."""
    days, cuts = lens.activity(spark, d), pl.cut(spark, d)
    later = labels._windowed(days.where("active").select("player_id", "day"), cuts, 0, 60).groupBy("cutoff", "player_id").agg(F.min(F.datediff("day", "cutoff")).alias("t"))
    t = F.coalesce("t", F.lit(99999))
    rows = act.population(days, cuts, 180).select("cutoff", "player_id").join(later, ["cutoff", "player_id"], "left").withColumn("k", F.explode(F.array(*[F.lit(k) for k in (14, 21, 30, 45)])))
    return rows.groupBy("cutoff", "k").agg(F.count("*").alias("n"), F.count_if(t > F.col("k")).alias("silent_k"), F.count_if(t > 60).alias("silent_60"))


@query("rpt_2_survival_card", with_("activity") + f", {pl.SCORED} SELECT cutoff, count(*) AS n, round(1 - avg(event_observed), 6) AS censored, round(avg(CAST(duration_days = 0 AS INT)), 6) AS day_0, round(quantile_cont(duration_days, 0.5), 4) AS median_days, round(avg(CAST(y = event_observed AS INT)), 6) AS consistent FROM sc GROUP BY cutoff")
def rpt_2(spark, d):
    return pl.scored(spark, d).groupBy("cutoff").agg(
        F.count("*").alias("n"), F.round(1 - F.avg("event_observed"), 6).alias("censored"), F.round(F.avg((F.col("duration_days") == 0).cast("int")), 6).alias("day_0"), F.round(F.percentile("duration_days", 0.5), 4).alias("median_days"), F.round(F.avg((F.col("y") == F.col("event_observed")).cast("int")), 6).alias("consistent")
    )


@query("bt_2_auc_by_cutoff", with_("activity") + f""", {pl.SCORED}, r AS (SELECT *, rank() OVER w AS r, count(*) OVER (PARTITION BY cutoff, s) AS ties FROM sc WINDOW w AS (PARTITION BY cutoff ORDER BY s))
SELECT cutoff, CAST(sum(y) AS BIGINT) AS pos, count(*) FILTER (y = 0) AS neg, round((sum(CASE WHEN y = 1 THEN r + (ties - 1) / 2.0::DOUBLE END) - sum(y) * (sum(y) + 1) / 2) / nullif(sum(y) * count(*) FILTER (y = 0), 0), 6) AS auc FROM r GROUP BY cutoff""")
def bt_2(spark, d):
    """BT-2, EVAL-13"""
    return ev.auc(pl.scored(spark, d), "s", "y", ["cutoff"])


@query("sets_4_overlap", with_("activity") + f""", {pl.SCORED}, ra AS (SELECT cutoff, player_id, row_number() OVER (PARTITION BY cutoff ORDER BY s DESC, player_id) AS r FROM sc), rb AS (SELECT cutoff, player_id, row_number() OVER (PARTITION BY cutoff ORDER BY v DESC, player_id) AS r FROM sc)
SELECT ra.cutoff, count(*) FILTER (ra.r <= 100 AND rb.r <= 100) AS shared, round(corr(ra.r, rb.r), 6) AS spearman FROM ra JOIN rb USING (cutoff, player_id) GROUP BY ra.cutoff""")
def sets_4(spark, d):
    """SETS-4, BT-5"""
    rows = placed(pl.scored(spark, d).select("cutoff", "player_id", "s", "v"), ["cutoff"], "s", "player_id").withColumnRenamed("place", "a").drop("size")
    rows = placed(rows, ["cutoff"], "v", "player_id").withColumnRenamed("place", "b")
    return rows.groupBy("cutoff").agg(F.count_if((F.col("a") <= 100) & (F.col("b") <= 100)).alias("shared"), F.round(correlation("a", "b"), 6).alias("spearman"))


@query("strm_2_late_events", "SELECT CAST(ts AS DATE) AS day, CAST(ts + INTERVAL 2 HOUR AS DATE) AS folder, count(*) AS n FROM events GROUP BY ALL")
def strm_2(spark, d):
    """STRM-2, SCAN-7: event day against the day of a folder that closes two hours later."""
    return lens.table(spark, d, "events").groupBy(F.to_date("ts").alias("day"), F.to_date(F.col("ts") + F.expr("interval 2 hours")).alias("folder")).agg(F.count("*").alias("n"))

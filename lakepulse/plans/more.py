"""More queries: joins of snapshots and facts, limits, shares, alerts, payments features."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakepulse.operators import activity as act
from lakepulse.operators import evaluate as ev
from lakepulse.operators import frame
from lakepulse.operators.ranks import attach, quantiles
from lakepulse.sources import lens
from lakepulse.sources.lake import kept
from lakepulse.sources.lens import with_

from . import players as pl
from .registry import query


@query("join_1_semi", with_("activity") + " SELECT player_id, day, bets FROM activity WHERE player_id IN (SELECT player_id FROM players WHERE brand = 'BUILDING')")
def join_1(spark, d):
    return lens.activity(spark, d).select("player_id", "day", "bets").join(lens.players(spark, d).where("brand = 'BUILDING'").select("player_id"), "player_id", "left_semi")


@query("join_2_range_semi", with_("activity") + f", {pl.CUT} SELECT DISTINCT cutoff, player_id FROM cut JOIN activity ON active AND day > cutoff - 30 AND day <= cutoff + 30")
def join_2(spark, d):
    """JOIN-2, CACHE-6: players active around a snapshot."""
    from lakepulse.operators import labels

    return labels._windowed(lens.activity(spark, d).where("active"), pl.cut(spark, d), 30, 30).select("cutoff", "player_id").distinct()


#: Daily snapshots at each cutoff, and 7 and 30 days before it, of those active in the 30 days before the cutoff.
SNAPSHOTS = f"""ask AS MATERIALIZED (SELECT DISTINCT CAST(cutoff - lag AS DATE) AS d, player_id FROM (SELECT cutoff, a.player_id FROM cut JOIN a ON day > cutoff - 30 AND day <= cutoff), (SELECT unnest([0, 7, 30]) AS lag)),
s1 AS (SELECT d, player_id, CAST(sum(sessions) AS BIGINT) AS s7, CAST(sum(seconds) AS BIGINT) AS t7 FROM ask JOIN play_days USING (player_id) WHERE day > d - 7 AND day <= d GROUP BY ALL), s2 AS (SELECT d, player_id, count(DISTINCT game_id) AS g30 FROM ask JOIN lines USING (player_id) WHERE day > d - 30 AND day <= d GROUP BY ALL),
s3 AS (SELECT d, player_id, count(*) FILTER (day > d - 30) AS a30, count(*) FILTER (day <= d - 30) AS p30 FROM ask JOIN a USING (player_id) WHERE day > d - 60 AND day <= d GROUP BY ALL),
snap AS MATERIALIZED (SELECT d, player_id, coalesce(s7, 0) AS s7, coalesce(t7, 0) AS t7, coalesce(g30, 0) AS g30, coalesce(a30, 0) AS a30, coalesce(p30, 0) AS p30 FROM ask LEFT JOIN s1 USING (d, player_id) LEFT JOIN s2 USING (d, player_id) LEFT JOIN s3 USING (d, player_id))"""


def daily_snapshots(spark, d):
    days, cuts = lens.activity(spark, d), pl.cut(spark, d)
    people = act.population(days, cuts, 30)
    lags = F.explode(F.array(F.lit(0), F.lit(7), F.lit(30))).alias("lag")
    asked = people.select("cutoff", "player_id", "brand", lags).select(F.date_sub("cutoff", F.col("lag")).alias("cutoff"), "player_id", "brand").distinct()
    return kept(frame.snapshots(days, lens.cash(spark, d), lens.play_days(spark, d), lens.game_days(spark, d), asked)), people.select("cutoff", "player_id")


@query("join_8_star", with_("activity", "play_days") + f""", {pl.CUT}, {pl.ACTIVE}, {SNAPSHOTS}, now AS (SELECT DISTINCT cutoff, a.player_id FROM cut JOIN a ON day > cutoff - 30 AND day <= cutoff)
SELECT cutoff, player_id, n.s7 AS sessions_l7d, (n.s7 + 1) / (coalesce(p.s7, 0) + 1) AS session_ratio_7_vs_prior7, CASE WHEN n.s7 > 0 AND p.s7 > 0 AND p.t7 > 0 THEN (n.t7 / n.s7) / (p.t7 / p.s7) END AS session_length_ratio, n.g30 AS games_breadth_30d, (n.g30 + 1) / (coalesce(q.g30, 0) + 1) AS games_breadth_ratio
FROM now JOIN snap n ON n.d = cutoff AND n.player_id = now.player_id LEFT JOIN snap p ON p.d = cutoff - 7 AND p.player_id = now.player_id LEFT JOIN snap q ON q.d = cutoff - 30 AND q.player_id = now.player_id""".replace("SELECT cutoff, player_id, n.s7", "SELECT cutoff, now.player_id, n.s7"))
def join_8(spark, d):
    """JOIN-8, F30, F46, F47: the snapshot of a cutoff with those of 7 and 30 days before; none counts 0."""
    snaps, people = daily_snapshots(spark, d)
    rows = frame.star(snaps, (7, 30), ["sessions_l7d", "play_secs_l7d", "games_breadth_l30d"]).join(people, ["cutoff", "player_id"], "left_semi")
    c, zero = F.col, lambda x: F.coalesce(x, F.lit(0))
    per = lambda t, n: F.when((c(n) > 0) & (c(t) > 0), c(t) / F.when(c(n) > 0, c(n)))
    now = F.when(c("sessions_l7d") > 0, c("play_secs_l7d") / F.when(c("sessions_l7d") > 0, c("sessions_l7d")))
    return rows.select(
        "cutoff", "player_id", "sessions_l7d", ((c("sessions_l7d") + 1) / (zero(c("sessions_l7d_p7")) + 1)).alias("session_ratio_7_vs_prior7"), (now / per("play_secs_l7d_p7", "sessions_l7d_p7")).alias("session_length_ratio"),
        c("games_breadth_l30d").alias("games_breadth_30d"), ((c("games_breadth_l30d") + 1) / (zero(c("games_breadth_l30d_p30")) + 1)).alias("games_breadth_ratio"),
    )


@query("join_9_outer_merge", "WITH a AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS views FROM events WHERE event_type = 'view' GROUP BY ALL), b AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS clicks FROM events WHERE event_type = 'click' GROUP BY ALL) SELECT user_id, day, coalesce(views, 0) AS views, coalesce(clicks, 0) AS clicks FROM a FULL JOIN b USING (user_id, day)")
def join_9(spark, d):
    per = lambda kind, name: lens.table(spark, d, "events").where(F.col("event_type") == kind).groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count("*").alias(name))
    return per("view", "views").join(per("click", "clicks"), ["user_id", "day"], "full").na.fill(0, ["views", "clicks"])


@query("join_14_lag", with_("activity", "play_days") + f""", {pl.CUT}, {pl.ACTIVE}, {SNAPSHOTS}, now AS (SELECT DISTINCT cutoff, a.player_id FROM cut JOIN a ON day > cutoff - 30 AND day <= cutoff)
SELECT cutoff, count(*) AS n, count(*) FILTER (n.p30 = q.a30) AS equal, count(*) FILTER (n.p30 > q.a30) AS higher FROM now JOIN snap n ON n.d = cutoff AND n.player_id = now.player_id JOIN snap q ON q.d = cutoff - 30 AND q.player_id = now.player_id GROUP BY cutoff""")
def join_14(spark, d):
    """JOIN-14, CHK-4: the prior window of a snapshot against the window of the daily snapshot exactly 30 days before: all are equal."""
    snaps, people = daily_snapshots(spark, d)
    rows = frame.star(snaps, (30,), ["active_days_l30d"]).join(people, ["cutoff", "player_id"], "left_semi").where("active_days_l30d_p30 is not null")
    prior, was = F.col("prior_active_days_l30d"), F.col("active_days_l30d_p30")
    return rows.groupBy("cutoff").agg(F.count("*").alias("n"), F.count_if(prior == was).alias("equal"), F.count_if(prior > was).alias("higher"))


@query("join_16_brand_fill", with_("players") + ", e AS (SELECT user_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'STATED' END AS stated FROM events) SELECT coalesce(stated, brand, 'none') AS brand, stated IS NULL AS brand_filled, count(*) AS n FROM e LEFT JOIN players ON player_id = user_id GROUP BY ALL")
def join_16(spark, d):
    """JOIN-16, PROJ-4"""
    e = lens.table(spark, d, "events").select("user_id", F.when(F.col("event_id") % 3 != 0, "STATED").alias("stated"))
    both = e.join(lens.players(spark, d), F.col("player_id") == F.col("user_id"), "left")
    return both.groupBy(F.coalesce("stated", "brand", F.lit("none")).alias("brand"), F.col("stated").isNull().alias("brand_filled")).agg(F.count("*").alias("n"))


@query("join_20_fact_vs_signal", with_("gaming", "stakes") + ", g AS (SELECT player_id, sum(stake_c) AS fact FROM gaming GROUP BY ALL), s AS (SELECT player_id, CAST(sum(stake_c) AS BIGINT) AS signal FROM stakes GROUP BY ALL) SELECT player_id, signal, CAST(coalesce(fact, 0) AS BIGINT) AS fact, CAST(signal - coalesce(fact, 0) AS BIGINT) AS gap FROM s LEFT JOIN g USING (player_id)")
def join_20(spark, d):
    fact = lens.gaming(spark, d).groupBy("player_id").agg(F.sum("stake_c").alias("fact"))
    both = lens.stakes(spark, d).groupBy("player_id").agg(F.sum("stake_c").alias("signal")).join(fact, "player_id", "left").withColumn("fact", F.coalesce("fact", F.lit(0)))
    return both.withColumn("gap", F.col("signal") - F.col("fact"))


@query("agg_10_wide_profile", "WITH l AS (SELECT 'l_quantity' AS metric, l_quantity AS x FROM lineitem UNION ALL SELECT 'l_discount', l_discount FROM lineitem UNION ALL SELECT 'l_tax', l_tax FROM lineitem) SELECT metric, count(*) AS n_rows, count(*) FILTER (x = 0) AS zeros, min(x) AS low, max(x) AS high, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS sd FROM l GROUP BY metric")
def agg_10(spark, d):
    rows = lens.table(spark, d, "lineitem").select("l_quantity", "l_discount", "l_tax")
    wide = rows.agg(*[f(c).alias(f"{c}__{k}") for c in rows.columns for k, f in (("n_rows", lambda c: F.count(F.lit(1))), ("zeros", lambda c: F.count_if(F.col(c) == 0)), ("low", F.min), ("high", F.max), ("mean", lambda c: F.round(F.avg(c), 6)), ("sd", lambda c: F.round(F.stddev_samp(c), 6)))])
    return wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), *[F.col(f"{c}__{k}").alias(k) for k in ("n_rows", "zeros", "low", "high", "mean", "sd")]) for c in rows.columns])).alias("m")).select("m.*")


@query("agg_15_two_dimensions", "SELECT CAST(least(greatest(floor(l_discount * 500), 0), 49) AS INT) AS x, CAST(least(greatest(floor(l_tax * 500), 0), 49) AS INT) AS y, count(*) AS n FROM lineitem GROUP BY ALL")
def agg_15(spark, d):
    cell = lambda c: F.least(F.greatest(F.floor(F.col(c) * 500), F.lit(0)), F.lit(49)).cast("int")
    return lens.table(spark, d, "lineitem").groupBy(cell("l_discount").alias("x"), cell("l_tax").alias("y")).agg(F.count("*").alias("n"))


@query("agg_20_limits", with_("players", "stakes") + """ SELECT coalesce(brand, 'all') AS brand, count(*) AS n, round(count(*) FILTER (stake_c < 1000000) / count(*), 6) AS below, round(count(*) FILTER (stake_c > 40000000) / count(*), 6) AS above, round(quantile_cont(stake_c, 0.5), 4) AS median, round(quantile_cont(stake_c, 0.99), 4) AS p99
FROM stakes JOIN players USING (player_id) GROUP BY GROUPING SETS ((brand), ())""")
def agg_20(spark, d):
    rows = lens.stakes(spark, d).join(lens.players(spark, d), "player_id")
    c = F.col("stake_c")
    rows = kept(rows.select("stake_c", F.explode(F.array("brand", F.lit("all"))).alias("brand")))
    found = rows.groupBy("brand").agg(F.count("*").alias("n"), F.round(F.count_if(c < 1000000) / F.count("*"), 6).alias("below"), F.round(F.count_if(c > 40000000) / F.count("*"), 6).alias("above"))
    q = quantiles(rows, "stake_c", ["brand"], [0.5, 0.99]).select("brand", F.round(F.col("q")[0], 4).alias("median"), F.round(F.col("q")[1], 4).alias("p99"))
    return attach(found, q, ["brand"])


@query("agg_21_session_checks", f"WITH {pl.SESSIONS} SELECT minutes, count(*) AS n, count(*) FILTER (seconds > 86400) AS over_a_day, count(*) FILTER (events = 1 AND seconds > 0) AS single_with_length, count(*) FILTER (events > 1 AND seconds = 0) AS many_without_length, round(count(*) FILTER (events = 1) / count(*), 6) AS single_share FROM x GROUP BY minutes")
def agg_21(spark, d):
    s, e = F.col("seconds"), F.col("events")
    return pl.sess_1(spark, d).groupBy("minutes").agg(F.count("*").alias("n"), F.count_if(s > 86400).alias("over_a_day"), F.count_if((e == 1) & (s > 0)).alias("single_with_length"), F.count_if((e > 1) & (s == 0)).alias("many_without_length"), F.round(F.count_if(e == 1) / F.count("*"), 6).alias("single_share"))


@query("agg_23_value_frequency", "SELECT l_quantity AS value, count(*) AS n FROM lineitem GROUP BY ALL")
def agg_23(spark, d):
    return lens.table(spark, d, "lineitem").groupBy(F.col("l_quantity").alias("value")).agg(F.count("*").alias("n"))


@query("agg_26_most_frequent_flagged", "SELECT l_quantity AS value, count(*) AS n, CAST(min(l_shipdate) AS DATE) AS first_day, CAST(max(l_shipdate) AS DATE) AS last_day FROM lineitem WHERE l_discount > 0.09 GROUP BY l_quantity ORDER BY n DESC, value LIMIT 10")
def agg_26(spark, d):
    return lens.table(spark, d, "lineitem").where("l_discount > 0.09").groupBy(F.col("l_quantity").alias("value")).agg(F.count("*").alias("n"), F.to_date(F.min("l_shipdate")).alias("first_day"), F.to_date(F.max("l_shipdate")).alias("last_day")).orderBy(F.desc("n"), "value").limit(10)


@query("agg_35_delays", """WITH d AS (SELECT l_returnflag, CAST(CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) AS DOUBLE) AS days FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
SELECT l_returnflag, count(*) AS n, count(*) FILTER (days < 0) AS before_order, round(quantile_cont(days, 0.5), 4) AS p50, round(quantile_cont(days, 0.99), 4) AS p99, max(days) AS longest FROM d GROUP BY l_returnflag""")
def agg_35(spark, d):
    """AGG-35, STRM-4"""
    o = lens.table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    rows = lens.table(spark, d, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey")).withColumn("days", F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate")).cast("double"))
    return rows.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.count_if(F.col("days") < 0).alias("before_order"), F.round(F.percentile("days", 0.5), 4).alias("p50"), F.round(F.percentile("days", 0.99), 4).alias("p99"), F.max("days").alias("longest"))


@query("agg_44_value_concentration", with_("activity") + """, m AS (SELECT player_id, date_trunc('month', day) AS month, sum(ggr_c) AS g FROM activity GROUP BY ALL), r AS (SELECT *, row_number() OVER (ORDER BY g DESC, player_id, month) AS r, count(*) OVER () AS n FROM m WHERE g > 0)
SELECT any_value(n) AS positive, round(sum(g) FILTER (r <= ceil(n * 0.1::DOUBLE)) / sum(g), 6) AS top_10_percent, round(sum(g) FILTER (r <= ceil(n * 0.01::DOUBLE)) / sum(g), 6) AS top_1_percent, (SELECT round(count(*) FILTER (g <= 0) / count(*), 6) FROM m) AS not_positive FROM r""")
def agg_44(spark, d):
    """AGG-44: ranks are by groups of equal value, so no partition holds all player-months."""
    m = lens.activity(spark, d).groupBy("player_id", F.trunc("day", "month").alias("month")).agg(F.sum("ggr_c").alias("g"))
    total = m.agg(F.count_if(F.col("g") > 0).alias("n"), F.sum(F.greatest("g", F.lit(0))).alias("all"), F.round(F.count_if(F.col("g") <= 0) / F.count("*"), 6).alias("not_positive"))
    per = m.where("g > 0").groupBy("g").agg(F.count("*").alias("k")).withColumn("part", F.floor(F.log2("g")).cast("int"))
    parts = per.groupBy("part").agg(F.sum("k").alias("pk")).withColumn("above", F.coalesce(F.sum("pk").over(Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inside = F.coalesce(F.sum("k").over(Window.partitionBy("part").orderBy(F.desc("g")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = per.join(F.broadcast(parts), "part").withColumn("before", F.col("above") + inside).join(F.broadcast(total))
    top = lambda share: F.round(F.sum(F.col("g") * F.greatest(F.lit(0), F.least(F.col("k"), F.ceil(F.col("n") * share) - F.col("before")))) / F.first("all"), 6)
    return ranked.agg(F.first("n").alias("positive"), top(0.1).alias("top_10_percent"), top(0.01).alias("top_1_percent"), F.first("not_positive").alias("not_positive"))


@query("agg_46_crosstab", with_("players", "stakes") + ", x AS (SELECT brand, product, count(*) AS n FROM stakes JOIN players USING (player_id) GROUP BY ALL) SELECT brand, product, round(n / sum(n) OVER (PARTITION BY brand), 6) AS share FROM x")
def agg_46(spark, d):
    x = lens.stakes(spark, d).join(lens.players(spark, d), "player_id").groupBy("brand", "product").agg(F.count("*").alias("n"))
    return x.select("brand", "product", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("brand")), 6).alias("share"))


@query("agg_49_bonus_only", with_("activity") + " SELECT brand, CAST(date_trunc('month', day) AS DATE) AS month, count(*) AS player_days, round(avg(CAST(NOT active AS INT)), 6) AS bonus_only FROM activity GROUP BY ALL")
def agg_49(spark, d):
    return lens.activity(spark, d).groupBy("brand", F.trunc("day", "month").alias("month")).agg(F.count("*").alias("player_days"), F.round(F.avg((~F.col("active")).cast("int")), 6).alias("bonus_only"))


@query("agg_55_share_within_rule", "WITH r AS (SELECT 'large' AS rule, l_shipdate, l_returnflag FROM lineitem WHERE l_quantity > 45 UNION ALL SELECT 'cheap', l_shipdate, l_returnflag FROM lineitem WHERE l_discount > 0.09) SELECT rule, l_returnflag, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY rule), 6) AS share FROM r GROUP BY rule, l_returnflag")
def agg_55(spark, d):
    rows = lens.table(spark, d, "lineitem")
    rules = F.array_compact(F.array(F.when(F.col("l_quantity") > 45, "large"), F.when(F.col("l_discount") > 0.09, "cheap")))
    per = rows.select(F.explode(rules).alias("rule"), "l_returnflag").groupBy("rule", "l_returnflag").agg(F.count("*").alias("n"))
    return per.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("rule")), 6))


@query("alrt_1_row_counts", with_("activity") + """, m AS (SELECT CAST(date_trunc('month', day) AS DATE) AS month, count(*) AS n FROM activity GROUP BY ALL), b AS (SELECT *, avg(n) OVER (ORDER BY month ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS benchmark FROM m)
SELECT month, n, round(benchmark, 6) AS benchmark, CASE WHEN benchmark IS NULL THEN 'info' WHEN n = 0 OR abs(n / benchmark - 1) > 0.5 THEN 'critical' WHEN abs(n / benchmark - 1) > 0.2 THEN 'warn' ELSE 'ok' END AS severity FROM b""")
def alrt_1(spark, d):
    m = lens.activity(spark, d).groupBy(F.trunc("day", "month").alias("month")).agg(F.count("*").alias("n"))
    b = m.withColumn("benchmark", F.avg("n").over(Window.orderBy("month").rowsBetween(-6, -1)))
    off = F.abs(F.col("n") / F.col("benchmark") - 1)
    return b.select("month", "n", F.round("benchmark", 6).alias("benchmark"), F.when(F.col("benchmark").isNull(), "info").when((F.col("n") == 0) | (off > 0.5), "critical").when(off > 0.2, "warn").otherwise("ok").alias("severity"))


@query("feat_games", with_("gaming", "activity") + f""", {pl.CUT} SELECT cutoff, player_id, count(DISTINCT game_id) FILTER (cutoff - day < 30) AS games_breadth_30d, count(DISTINCT game_id) FILTER (cutoff - day >= 30) AS games_breadth_before, (count(DISTINCT game_id) FILTER (cutoff - day < 30) + 1) / (count(DISTINCT game_id) FILTER (cutoff - day >= 30) + 1) AS games_breadth_ratio
FROM cut JOIN gaming ON day > cutoff - 60 AND day <= cutoff GROUP BY cutoff, player_id""")
def feat_games(spark, d):
    """F29, F30"""
    from lakepulse.operators import labels

    rows = labels._windowed(lens.gaming(spark, d), pl.cut(spark, d), 60)
    now = F.datediff("cutoff", "day") < 30
    found = rows.groupBy("cutoff", "player_id").agg(F.countDistinct(F.when(now, F.col("game_id"))).alias("games_breadth_30d"), F.countDistinct(F.when(~now, F.col("game_id"))).alias("games_breadth_before"))
    return found.withColumn("games_breadth_ratio", (F.col("games_breadth_30d") + 1) / (F.col("games_breadth_before") + 1))


@query("eval_17_roc", with_("activity") + f""", {pl.SCORED}, b AS (SELECT s, sum(y) AS pos, count(*) - sum(y) AS neg FROM sc GROUP BY s), w AS (SELECT s, sum(pos) OVER x AS tp, sum(neg) OVER x AS fp FROM b WINDOW x AS (ORDER BY s DESC))
SELECT s, round(tp / (SELECT sum(pos) FROM b), 6) AS tpr, round(fp / (SELECT sum(neg) FROM b), 6) AS fpr FROM w""")
def eval_17(spark, d):
    """EVAL-17"""
    return ev.roc(pl.scored(spark, d), "s", "y")


@query("shape_2_dispersion", with_("activity") + ", m AS (SELECT brand, player_id, count(*) AS n FROM activity GROUP BY ALL) SELECT brand, count(*) AS players, round(avg(n), 6) AS mean, round(var_samp(n), 6) AS variance, round(var_samp(n) / avg(n), 6) AS dispersion FROM m GROUP BY brand")
def shape_2(spark, d):
    """SHAPE-2: counts against Poisson, by moments."""
    m = lens.activity(spark, d).groupBy("brand", "player_id").agg(F.count("*").alias("n"))
    return m.groupBy("brand").agg(F.count("*").alias("players"), F.round(F.avg("n"), 6).alias("mean"), F.round(F.var_samp("n"), 6).alias("variance"), F.round(F.var_samp("n") / F.avg("n"), 6).alias("dispersion"))

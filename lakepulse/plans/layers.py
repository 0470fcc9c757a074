"""Queries on the layers of the lake: joins, reconciliation, contracts, profiles, distributions, outliers, checks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakepulse.operators import keys, profiles, sessions
from lakepulse.operators.ranks import attach, quantiles
from lakepulse.sources import lens
from lakepulse.sources.lens import with_

from .registry import query

VERSION = "ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax"


def order_of():
    return [F.desc("l_shipdate"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_extendedprice"), F.col("l_quantity"), F.col("l_discount"), F.col("l_tax")]


@query("vers_1_latest", f"SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber {VERSION}) AS r FROM lineitem) WHERE r = 1")
def vers_1(spark, d):
    return keys.latest_version(lens.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], order_of()).select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query("agg_3_repeats", """WITH k AS (SELECT l_returnflag, l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT l_returnflag, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys, CAST(sum(n - 1) AS BIGINT) AS repeated, count(*) FILTER (n > 1) AS keys_repeated FROM k GROUP BY ALL""")
def agg_3(spark, d):
    return keys.repeats(lens.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_returnflag"])


@query("agg_1_having", with_("gaming") + " SELECT player_id, CAST(sum(stake_c) AS BIGINT) AS stake_c, count(*) AS n FROM gaming GROUP BY player_id HAVING sum(stake_c) > 100000000")
def agg_1(spark, d):
    return lens.gaming(spark, d).groupBy("player_id").agg(F.sum("stake_c").alias("stake_c"), F.count("*").alias("n")).where("stake_c > 100000000")


@query("agg_2_filtered", "SELECT l_returnflag, count(*) FILTER (l_quantity > 30) AS large, CAST(coalesce(sum(l_linenumber) FILTER (l_tax > 0.04), 0) AS BIGINT) AS lines, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY ALL")
def agg_2(spark, d):
    rows = lens.table(spark, d, "lineitem")
    return rows.groupBy("l_returnflag").agg(F.count_if(F.col("l_quantity") > 30).alias("large"), F.coalesce(F.sum(F.when(F.col("l_tax") > 0.04, F.col("l_linenumber"))), F.lit(0)).cast("long").alias("lines"), F.countDistinct("l_partkey").alias("parts"))


def _profile(x: str, table: str, by: str, low: float, high: float) -> str:
    q = ", ".join(str(v) for v in profiles.NINE)
    names = ", ".join(f"round(q[{i + 1}], 4) AS p{round(v * 100):02d}" for i, v in enumerate(profiles.NINE))
    return f"""WITH p AS (SELECT {by}, count(*) AS n_rows, count({x}) AS n, count(*) FILTER ({x} = 0) AS zeros, count(*) FILTER ({x} < 0) AS negatives, count(*) FILTER ({x} < {low}) AS below, count(*) FILTER ({x} > {high}) AS above,
    min({x}) AS low, max({x}) AS high, avg({x}) AS mean, stddev_samp({x}) AS sd, skewness({x}) AS sk, kurtosis({x}) AS ku, quantile_cont({x}, [{q}]) AS q FROM {table} GROUP BY ALL)
    SELECT {by}, n_rows, n, zeros, negatives, below, above, round(low, 4) AS low, round(high, 4) AS high, round(mean, 4) AS mean, round(sd, 4) AS sd, round(sk, 4) AS skewness, round(ku, 4) AS kurtosis, {names} FROM p"""


@query("agg_9_profile", _profile("value", "events", "event_type", 1, 100))
def agg_9(spark, d):
    return profiles.profile(lens.table(spark, d, "events"), "value", ["event_type"], 1, 100)


@query("agg_11_log_histogram", "SELECT event_type, CAST(floor(log10(value) / 0.25::DOUBLE) AS INT) AS bin, count(*) AS n FROM events WHERE value > 0 GROUP BY ALL")
def agg_11(spark, d):
    return profiles.log_histogram(lens.table(spark, d, "events"), "value", ["event_type"])


@query("agg_13_limits_histogram", "SELECT CAST(CASE WHEN l_quantity < 5 THEN -1 WHEN l_quantity > 45 THEN 50 ELSE least(floor((l_quantity - 5) / 0.8::DOUBLE), 49) END AS INT) AS bin, count(*) AS n FROM lineitem GROUP BY ALL")
def agg_13(spark, d):
    return profiles.limits_histogram(lens.table(spark, d, "lineitem"), "l_quantity", 5.0, 45.0)


@query("agg_16_complete_histogram", """WITH b AS (SELECT CAST(floor(value / 10) AS INT) AS bin, count(*) AS n FROM events GROUP BY ALL), f AS (SELECT greatest(0, least(30, bin)) AS bin, sum(n) AS n FROM b GROUP BY ALL),
x AS (SELECT CAST(i AS INT) AS bin, CAST(coalesce(n, 0) AS BIGINT) AS n FROM range(31) t(i) LEFT JOIN f ON f.bin = i)
SELECT bin, n, n / sum(n) OVER () AS share, sum(n) OVER (ORDER BY bin) / sum(n) OVER () AS cumulative FROM x""")
def agg_16(spark, d):
    bins = lens.table(spark, d, "events").groupBy(F.floor(F.col("value") / 10).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    return profiles.complete_histogram(bins, 30)


@query("agg_17_grouping_sets", with_("players") + " SELECT coalesce(brand, 'all') AS brand, count(*) AS n, count(DISTINCT tenant) AS tenants FROM players GROUP BY GROUPING SETS ((brand), ())")
def agg_17(spark, d):
    return lens.players(spark, d).rollup("brand").agg(F.count("*").alias("n"), F.countDistinct("tenant").alias("tenants")).withColumn("brand", F.coalesce("brand", F.lit("all")))


@query("agg_18_cube", with_("players", "stakes") + """, x AS (SELECT brand, CAST(floor(log10(stake_c)) AS INT) AS bucket FROM stakes JOIN players USING (player_id))
SELECT coalesce(brand, 'all') AS brand, coalesce(bucket, -1) AS bucket, count(*) AS n FROM x GROUP BY CUBE (brand, bucket)""")
def agg_18(spark, d):
    rows = lens.stakes(spark, d).join(lens.players(spark, d), "player_id").withColumn("bucket", F.floor(F.log10("stake_c")).cast("int"))
    return rows.cube("brand", "bucket").agg(F.count("*").alias("n")).select(F.coalesce("brand", F.lit("all")).alias("brand"), F.coalesce("bucket", F.lit(-1)).alias("bucket"), "n")


@query("agg_24_flags", """SELECT day, metric, sum(bad) AS bad, count(*) AS n FROM (
  SELECT CAST(o_orderdate AS DATE) AS day, 'impossible' AS metric, CAST(o_totalprice < 1000 AS BIGINT) AS bad FROM orders UNION ALL SELECT CAST(o_orderdate AS DATE), 'suspicious', CAST(o_totalprice > 400000 AS BIGINT) FROM orders) GROUP BY day, metric""".replace("sum(bad)", "CAST(sum(bad) AS BIGINT)"))
def agg_24(spark, d):
    rows = lens.table(spark, d, "orders").withColumn("day", F.to_date("o_orderdate"))
    wide = rows.groupBy("day").agg(F.count_if(F.col("o_totalprice") < 1000).alias("impossible"), F.count_if(F.col("o_totalprice") > 400000).alias("suspicious"), F.count("*").alias("n"))
    return wide.unpivot(["day", "n"], ["impossible", "suspicious"], "metric", "bad")


@query("agg_25_flags_summary", """WITH f AS (SELECT c_mktsegment AS brand, CAST(o_orderdate AS DATE) AS day, count(*) FILTER (o_totalprice > 400000) AS bad, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL)
SELECT brand, CAST(sum(bad) AS BIGINT) AS bad, round(100 * sum(bad) / sum(n), 6) AS percent, count(*) FILTER (bad > 0) AS days_hit, min(day) FILTER (bad > 0) AS first_day, max(day) FILTER (bad > 0) AS last_day, max(bad) AS worst FROM f GROUP BY brand""")
def agg_25(spark, d):
    rows = lens.table(spark, d, "orders").join(lens.players(spark, d), F.col("o_custkey") == F.col("player_id"))
    daily = rows.groupBy("brand", F.to_date("o_orderdate").alias("day")).agg(F.count_if(F.col("o_totalprice") > 400000).alias("bad"), F.count("*").alias("n"))
    hit = F.when(F.col("bad") > 0, F.col("day"))
    return daily.groupBy("brand").agg(F.sum("bad").alias("bad"), F.round(100 * F.sum("bad") / F.sum("n"), 6).alias("percent"), F.count(hit).alias("days_hit"), F.min(hit).alias("first_day"), F.max(hit).alias("last_day"), F.max("bad").alias("worst"))


@query("agg_27_lift", """WITH p AS (SELECT o_orderpriority, count(*) AS n, count(*) FILTER (o_totalprice > 400000) AS bad FROM orders GROUP BY ALL)
SELECT o_orderpriority, n, bad, round((bad / sum(bad) OVER ()) / (n / sum(n) OVER ()), 6) AS lift FROM p""")
def agg_27(spark, d):
    return profiles.lift(lens.table(spark, d, "orders"), F.col("o_totalprice") > 400000, "o_orderpriority")


@query("agg_28_concentration", with_("gaming") + """, p AS (SELECT player_id, sum(stake_c) AS v FROM gaming GROUP BY player_id), r AS (SELECT *, row_number() OVER (ORDER BY v DESC, player_id) AS r FROM p)
SELECT count(*) AS n, round(sum(v) FILTER (r <= 1) / sum(v), 6) AS share_top_1, round(sum(v) FILTER (r <= 10) / sum(v), 6) AS share_top_10, round(sum(v) FILTER (r <= 100) / sum(v), 6) AS share_top_100 FROM r""")
def agg_28(spark, d):
    return profiles.concentration(lens.gaming(spark, d), "player_id", "stake_c")


@query("agg_30_quantiles_bad_normal", "SELECT l_discount > 0.08 AS bad, count(*) AS n, round(quantile_cont(l_extendedprice, 0.25), 4) AS p25, round(quantile_cont(l_extendedprice, 0.5), 4) AS p50, round(quantile_cont(l_extendedprice, 0.75), 4) AS p75 FROM lineitem GROUP BY ALL")
def agg_30(spark, d):
    rows = lens.table(spark, d, "lineitem").withColumn("bad", F.col("l_discount") > 0.08)
    found = attach(rows.groupBy("bad").agg(F.count("*").alias("n")), quantiles(rows, "l_extendedprice", ["bad"], [0.25, 0.5, 0.75]), ["bad"])
    return found.select("bad", "n", *[F.round(F.col("q")[i], 4).alias(p) for i, p in enumerate(("p25", "p50", "p75"))])


STACK = "s AS (SELECT 'o_orderstatus' AS \"column\", o_orderstatus AS value, count(*) AS n FROM orders GROUP BY ALL UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY ALL)"


@query("agg_31_categories", f"WITH {STACK} SELECT * FROM s")
def agg_31(spark, d):
    return profiles.stacked_counts(lens.table(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"])


@query("agg_32_text_format", f"""WITH {STACK} SELECT "column", count(value) AS n_distinct, round(coalesce(sum(n) FILTER (value IS NULL), 0) / sum(n), 6) AS null_share, round(coalesce(sum(n) FILTER (value = upper(value)), 0) / sum(n), 6) AS upper_share,
round(coalesce(sum(n) FILTER (value = lower(value)), 0) / sum(n), 6) AS lower_share, array_to_string(list_sort(list(DISTINCT length(value))), ',') AS lengths FROM s GROUP BY ALL""")
def agg_32(spark, d):
    return profiles.text_format(lens.table(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"])


@query("agg_33_id_profile", "SELECT count(*) FILTER (o_custkey IS NULL) AS nulls, CAST(min(length(CAST(o_custkey AS VARCHAR))) AS INT) AS min_length, CAST(max(length(CAST(o_custkey AS VARCHAR))) AS INT) AS max_length, 0::BIGINT AS non_digits, 0::BIGINT AS not_lower FROM orders")
def agg_33(spark, d):
    return profiles.id_profile(lens.table(spark, d, "orders"), "o_custkey")


@query("join_3_orphans", with_("gaming") + " SELECT DISTINCT player_id, day FROM gaming g WHERE NOT EXISTS (SELECT 1 FROM stakes s WHERE s.player_id = g.player_id AND s.day = g.day)".replace("stakes", "(SELECT o_custkey AS player_id, CAST(o_orderdate AS DATE) AS day FROM orders)"))
def join_3(spark, d):
    return lens.gaming(spark, d).select("player_id", "day").distinct().join(lens.stakes(spark, d).select("player_id", "day"), ["player_id", "day"], "left_anti")


TWO = """l AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS s FROM orders WHERE o_orderkey % 10 <> 0), r AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS c, o_orderstatus AS s FROM orders WHERE o_orderkey % 11 <> 0)"""


def two(spark, d):
    o = lens.table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), F.col("o_orderstatus").alias("s"))
    return o.where("k % 10 <> 0"), o.where("k % 11 <> 0").withColumn("c", F.when(F.col("k") % 7 != 0, F.col("c")))


@query("join_4_same_keys", f"""WITH {TWO} SELECT count(*) FILTER (r.k IS NULL) AS only_left, count(*) FILTER (l.k IS NULL) AS only_right, count(*) FILTER (l.k IS NOT NULL AND r.k IS NOT NULL) AS "both",
count(*) FILTER (l.k IS NOT NULL AND r.k IS NOT NULL AND l.c IS DISTINCT FROM r.c) AS differ_c, count(*) FILTER (l.k IS NOT NULL AND r.k IS NOT NULL AND l.s IS DISTINCT FROM r.s) AS differ_s FROM l FULL JOIN r ON l.k = r.k""")
def join_4(spark, d):
    """JOIN-4, REC-3"""
    return keys.same_keys(*two(spark, d), ["k"], ["c", "s"])


@query("rec_4_totals", with_("gaming", "stakes") + """, x AS (SELECT order_id, sum(stake_c) AS a FROM gaming GROUP BY ALL), y AS (SELECT order_id, sum(stake_c) AS a FROM stakes GROUP BY ALL),
b AS (SELECT coalesce(x.a, 0) AS a, coalesce(y.a, 0) AS b FROM x FULL JOIN y ON x.order_id = y.order_id)
SELECT count(*) AS n_keys, count(*) FILTER (abs(a - b) > 0.01 AND abs(a - b) > 0.001 * greatest(abs(a), abs(b))) AS problems_stake_c, CAST(sum(a) AS BIGINT) AS stake_c_left, CAST(sum(b) AS BIGINT) AS stake_c_right FROM b""")
def rec_4(spark, d):
    """JOIN-5, REC-4: atomic rows against the daily table."""
    return keys.compare_totals(lens.gaming(spark, d), lens.stakes(spark, d), ["order_id"], ["stake_c"])


SHIFT = "l AS (SELECT user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'purchase'), r AS (SELECT user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'click')"


@query("rec_7_shifted_keys", f"""WITH {SHIFT}, m AS (SELECT DISTINCT user_id, day FROM l EXCEPT SELECT user_id, day FROM r)
SELECT day, count(*) AS missing, count(*) FILTER (NOT EXISTS (SELECT 1 FROM r WHERE r.user_id = m.user_id AND r.day BETWEEN m.day - 1 AND m.day + 1)) AS lost FROM m GROUP BY day""")
def rec_7(spark, d):
    e = lens.table(spark, d, "events").select("user_id", F.to_date("ts").alias("day"), "event_type")
    return keys.shifted_keys(e.where("event_type = 'purchase'"), e.where("event_type = 'click'"), ["user_id"], "day")


@query("rec_1_seen_before", "WITH k AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events) SELECT a.day, count(*) AS n_keys, count(b.day) AS seen_before FROM k a LEFT JOIN k b ON a.user_id = b.user_id AND b.day = a.day - 1 GROUP BY ALL")
def rec_1(spark, d):
    """JOIN-7, REC-1, STRM-3"""
    return keys.seen_before(lens.table(spark, d, "events").select("user_id", F.to_date("ts").alias("day")), ["user_id"], "day")


@query("rec_2_offset_holes", """WITH m AS (SELECT event_id % 4 AS partition, event_id AS o FROM events WHERE event_id % 97 <> 0), h AS (SELECT partition, (o - lag(o) OVER (PARTITION BY partition ORDER BY o)) // 4 - 1 AS hole FROM m)
SELECT partition, count(*) AS messages, count(*) FILTER (hole > 0) AS holes, CAST(coalesce(sum(hole) FILTER (hole > 0), 0) AS BIGINT) AS missing, count(*) FILTER (hole = 1) AS of_one, count(*) FILTER (hole BETWEEN 2 AND 1000) AS to_1000, count(*) FILTER (hole > 1000) AS over_1000 FROM h GROUP BY ALL""")
def rec_2(spark, d):
    """WIN-5, REC-2"""
    m = lens.table(spark, d, "events").where("event_id % 97 <> 0").select((F.col("event_id") % 4).alias("partition"), "event_id")
    return keys.offset_holes(m, ["partition"], "event_id", 4)


@query("join_11_as_of", """WITH e AS (SELECT event_id, user_id, CAST(ts AS DATE) AS asked FROM events WHERE event_type = 'purchase'), f AS (SELECT user_id, CAST(ts AS DATE) AS day, max(value) AS top FROM events WHERE event_type = 'view' GROUP BY ALL)
SELECT event_id, e.user_id, asked, CASE WHEN asked - f.day < 3 THEN f.day END AS day, CASE WHEN asked - f.day < 3 THEN top END AS top FROM e ASOF LEFT JOIN f ON e.user_id = f.user_id AND e.asked >= f.day""")
def join_11(spark, d):
    """JOIN-11: point-in-time look-up with a time to live of three days."""
    e = lens.table(spark, d, "events")
    f = e.where("event_type = 'view'").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.max("value").alias("top"))
    return keys.as_of(e.where("event_type = 'purchase'").select("event_id", "user_id", F.to_date("ts").alias("asked")), f, ["user_id"], "asked", "day", 3)


@query("join_12_interval", with_("payments") + """ SELECT a.player_id, a.day, min(b.day) AS later, CAST(min(b.day) - a.day AS INT) AS gap FROM payments a JOIN payments b ON a.player_id = b.player_id AND b.day BETWEEN a.day AND a.day + 3 WHERE a.deposits > 0 AND b.withdrawals > 0 GROUP BY a.player_id, a.day""")
def join_12(spark, d):
    p = lens.payments(spark, d)
    return keys.interval_join(p.where("deposits > 0").select("player_id", "day"), p.where("withdrawals > 0").select("player_id", "day"), "player_id", "day", 3)


@query("join_15_ambiguous_lookup", "WITH k AS (SELECT l_partkey, min(l_returnflag) AS flag, count(DISTINCT l_returnflag) AS n FROM lineitem GROUP BY ALL) SELECT p_brand, count(*) AS parts, count(*) FILTER (n > 1) AS ambiguous, count(k.l_partkey) AS found FROM part LEFT JOIN k ON p_partkey = l_partkey GROUP BY ALL")
def join_15(spark, d):
    looked = lens.table(spark, d, "lineitem").groupBy("l_partkey").agg(F.min("l_returnflag").alias("flag"), F.countDistinct("l_returnflag").alias("n"))
    return lens.table(spark, d, "part").join(looked, F.col("p_partkey") == F.col("l_partkey"), "left").groupBy("p_brand").agg(F.count("*").alias("parts"), F.count_if(F.col("n") > 1).alias("ambiguous"), F.count("l_partkey").alias("found"))


@query("join_17_key_overlap", with_("players") + ", e AS (SELECT DISTINCT user_id FROM events) SELECT coalesce(brand, 'none') AS brand, count(player_id) AS players, count(user_id) AS users, count(*) FILTER (player_id IS NOT NULL AND user_id IS NOT NULL) AS shared FROM players FULL JOIN e ON player_id = user_id GROUP BY ALL")
def join_17(spark, d):
    users = lens.table(spark, d, "events").select("user_id").distinct()
    both = lens.players(spark, d).join(users, F.col("player_id") == F.col("user_id"), "full")
    return both.groupBy(F.coalesce("brand", F.lit("none")).alias("brand")).agg(F.count("player_id").alias("players"), F.count("user_id").alias("users"), F.count_if(F.col("player_id").isNotNull() & F.col("user_id").isNotNull()).alias("shared"))


@query("dq_contract", """SELECT 'grain' AS rule, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS problems FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
UNION ALL SELECT 'not_null_l_partkey', count(*) FILTER (l_partkey IS NULL) FROM lineitem UNION ALL SELECT 'range_l_discount', count(*) FILTER (NOT l_discount BETWEEN 0 AND 0.05) FROM lineitem UNION ALL SELECT 'range_l_quantity', count(*) FILTER (NOT l_quantity BETWEEN 2 AND 50) FROM lineitem""")
def dq(spark, d):
    """DQ-1..3"""
    return profiles.contract(lens.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_partkey"], {"l_discount": (0.0, 0.05), "l_quantity": (2.0, 50.0)})


@query("anom_1_iqr", """WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM events GROUP BY ALL), e AS (SELECT event_type, a - 1.5::DOUBLE * (b - a) AS low, b + 1.5::DOUBLE * (b - a) AS high FROM q)
SELECT event_type, count(*) AS n, count(*) FILTER (value < low) AS below, count(*) FILTER (value > high) AS above, round(any_value(low), 4) AS low, round(any_value(high), 4) AS high FROM events JOIN e USING (event_type) GROUP BY ALL""")
def anom_1(spark, d):
    return profiles.iqr_outliers(lens.table(spark, d, "events"), "value", ["event_type"])


@query("anom_2_robust_z", """WITH m AS (SELECT event_type, median(value) AS med FROM events GROUP BY ALL), x AS (SELECT event_type, med, abs(value - med) AS dev FROM events JOIN m USING (event_type)), d AS (SELECT event_type, median(dev) AS mad FROM x GROUP BY ALL)
SELECT event_type, count(*) AS n, count(*) FILTER (0.6745::DOUBLE * dev / nullif(mad, 0) > 3.5) AS outliers, round(any_value(med), 4) AS median, round(any_value(mad), 4) AS mad FROM x JOIN d USING (event_type) GROUP BY ALL""")
def anom_2(spark, d):
    return profiles.robust_outliers(lens.table(spark, d, "events"), "value", ["event_type"])


DAILY = "daily AS (SELECT CAST(i AS DATE) AS day, coalesce(n, 0) AS n FROM (SELECT unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS i FROM orders) LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY ALL) ON d = i)"


def daily(spark, d):
    rows = lens.stakes(spark, d).groupBy(F.lit("all").alias("g"), "day").agg(F.count("*").alias("n"))
    return sessions.dense_days(rows, ["g"], ["n"])


@query("win_21_dense_days", f"WITH {DAILY} SELECT 'all' AS g, day, n FROM daily")
def win_21(spark, d):
    return daily(spark, d)


@query("anom_4_rolling", f"""WITH {DAILY}, m AS (SELECT day, n, CASE WHEN count(*) OVER w >= 14 THEN median(n) OVER w END AS median FROM daily WINDOW w AS (ORDER BY day ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)),
r AS (SELECT *, abs(n - median) AS residual FROM m), x AS (SELECT *, CASE WHEN count(residual) OVER w >= 14 THEN median(residual) OVER w END AS mad FROM r WINDOW w AS (ORDER BY day ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING))
SELECT 'all' AS g, day, n, median, residual, mad, coalesce(mad > 0 AND residual > 3.0 * mad, false) AS outlier FROM x""")
def anom_4(spark, d):
    """ANOM-4, WIN-10"""
    return profiles.rolling_outliers(daily(spark, d), ["g"], "n")


@query("wins_1_caps", with_("players", "stakes") + " SELECT brand, round(quantile_cont(stake_c, 0.995), 4) AS cap, count(*) AS n FROM stakes JOIN players USING (player_id) WHERE stake_c > 0 GROUP BY ALL")
def wins_1(spark, d):
    found = profiles.caps(lens.stakes(spark, d).join(lens.players(spark, d), "player_id"), "stake_c", ["brand"])
    return found.select("brand", F.round("cap", 4).alias("cap"), "n")


@query("wins_2_clip", with_("players", "stakes") + ", c AS (SELECT brand, quantile_cont(stake_c, 0.995) AS cap FROM stakes JOIN players USING (player_id) WHERE stake_c > 0 GROUP BY ALL) SELECT order_id, CAST(floor(least(stake_c, cap)) AS BIGINT) AS stake_c FROM stakes JOIN players USING (player_id) JOIN c USING (brand)")
def wins_2(spark, d):
    rows = lens.stakes(spark, d).join(lens.players(spark, d), "player_id")
    return attach(rows, profiles.caps(rows, "stake_c", ["brand"]).select("brand", "cap"), ["brand"]).select("order_id", F.floor(F.least("stake_c", "cap")).cast("long").alias("stake_c"))


@query("chk_1_formula", with_("gaming") + """, e AS (SELECT provider, payout_c AS t, stake_c * 0.95::DOUBLE AS e FROM gaming), q AS (SELECT provider, count(*) AS n, count(*) FILTER (abs(t - e) <= 1 + 0.02::DOUBLE * abs(e)) AS ok, count(*) FILTER (t - e > 1 + 0.02::DOUBLE * abs(e)) AS higher, count(*) FILTER (e - t > 1 + 0.02::DOUBLE * abs(e)) AS lower FROM e GROUP BY ALL)
SELECT *, CASE WHEN n = 0 THEN 'no data' WHEN ok / n >= 0.99::DOUBLE THEN 'passes' WHEN ok / n >= 0.95::DOUBLE THEN 'almost' ELSE 'fails' END AS verdict FROM q""")
def chk_1(spark, d):
    """CHK-1, CHK-6, SIG-21"""
    return profiles.check_formula(lens.gaming(spark, d), F.col("payout_c"), F.col("stake_c") * 0.95, ["provider"], 1.0, 0.02)


@query("win_15_share_of_total", "SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY o_orderstatus), 6) AS share FROM orders GROUP BY o_orderstatus, o_orderpriority")
def win_15(spark, d):
    per = lens.table(spark, d, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))
    return per.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("o_orderstatus")), 6))


@query("topk_5_largest", with_("players", "stakes") + " SELECT * FROM (SELECT brand, tenant, count(*) AS n, CAST(row_number() OVER (PARTITION BY brand ORDER BY count(*) DESC, tenant) AS INT) AS place FROM stakes JOIN players USING (player_id) GROUP BY brand, tenant) WHERE place <= 3")
def topk_5(spark, d):
    per = lens.stakes(spark, d).join(lens.players(spark, d), "player_id").groupBy("brand", "tenant").agg(F.count("*").alias("n"))
    return per.withColumn("place", F.row_number().over(Window.partitionBy("brand").orderBy(F.desc("n"), "tenant"))).where("place <= 3")


@query("sets_3_missing_days", "SELECT CAST(i AS DATE) AS day FROM (SELECT unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS i FROM orders) WHERE CAST(i AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderstatus = 'P')")
def sets_3(spark, d):
    orders = lens.table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day"), "o_orderstatus")
    days = orders.agg(F.min("day").alias("a"), F.max("day").alias("b")).select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("day"))
    return days.join(orders.where("o_orderstatus = 'P'").select("day"), "day", "left_anti")


@query("proj_6_pivot", "SELECT CAST(ts AS DATE) AS day, " + ", ".join(f"count(*) FILTER (event_type = '{k}') AS {k}" for k in ("click", "error", "purchase", "signup", "view")) + " FROM events GROUP BY ALL")
def proj_6(spark, d):
    names = ["click", "error", "purchase", "signup", "view"]
    return lens.table(spark, d, "events").groupBy(F.to_date("ts").alias("day")).pivot("event_type", names).agg(F.count(F.lit(1))).na.fill(0, names)


@query("strm_5_hours", "SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n, round(sum(value), 2) AS value FROM events GROUP BY ALL")
def strm_5(spark, d):
    return lens.table(spark, d, "events").groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("value")).select(F.col("w.start").alias("hour"), "event_type", "n", "value")


@query("meta_4_column_profile", "SELECT 'o_orderkey' AS \"column\", count(*) AS n_rows, count(*) - count(o_orderkey) AS nulls, CAST(min(o_orderkey) AS VARCHAR) AS low, CAST(max(o_orderkey) AS VARCHAR) AS high FROM orders UNION ALL SELECT 'o_orderstatus', count(*), count(*) - count(o_orderstatus), min(o_orderstatus), max(o_orderstatus) FROM orders UNION ALL SELECT 'o_custkey', count(*), count(*) - count(o_custkey), CAST(min(o_custkey) AS VARCHAR), CAST(max(o_custkey) AS VARCHAR) FROM orders")
def meta_4(spark, d):
    rows, names = lens.table(spark, d, "orders"), ["o_orderkey", "o_orderstatus", "o_custkey"]
    wide = rows.agg(F.count("*").alias("n_rows"), *[f(c).alias(f"{k}_{c}") for c in names for k, f in (("n", F.count), ("low", F.min), ("high", F.max))])
    long = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col("n_rows"), (F.col("n_rows") - F.col(f"n_{c}")).alias("nulls"), F.col(f"low_{c}").cast("string").alias("low"), F.col(f"high_{c}").cast("string").alias("high")) for c in names]))
    return wide.select(long.alias("x")).select("x.*")

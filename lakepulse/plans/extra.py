"""Queries on projections, profiles, coverage, shapes and sets."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakepulse.operators import keys, profiles, sessions, shapes
from lakepulse.operators.ranks import placed, quantiles
from lakepulse.sources import lens
from lakepulse.sources.lake import kept
from lakepulse.sources.lens import with_

from . import players as pl
from .registry import query


@query("agg_4_versions", "WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS n, count(DISTINCT l_shipdate) AS v FROM lineitem GROUP BY ALL) SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys, CAST(sum(v) AS BIGINT) AS n_key_versions, CAST(sum(n) - count(*) AS BIGINT) AS repeated, CAST(sum(n) - sum(v) AS BIGINT) AS unexplained, count(*) AS rows_left FROM k")
def agg_4(spark, d):
    """AGG-4: repeats of the key explained by versions, and the rows that the latest version leaves."""
    per = lens.table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber", "l_shipdate").agg(F.count("*").alias("n"))
    per = per.groupBy("l_orderkey", "l_linenumber").agg(F.sum("n").alias("n"), F.count("*").alias("v"))
    return per.agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_keys"), F.sum("v").alias("n_key_versions"), (F.sum("n") - F.count("*")).alias("repeated"), (F.sum("n") - F.sum("v")).alias("unexplained"), F.count("*").alias("rows_left"))


#: How far an approximate count may be off, and by how much of the ranks an approximate quantile.
COUNT_OFF, RANK_OFF = 0.05, 0.01
SHARES = [0.1, 0.5, 0.9]


@query("agg_5_approximate", f"""WITH e AS (SELECT l_returnflag, count(DISTINCT l_partkey) AS k, quantile_cont(l_extendedprice, {[round(s + e, 2) for s in SHARES for e in (-RANK_OFF, RANK_OFF)]}) AS b FROM lineitem GROUP BY l_returnflag)
SELECT l_returnflag, k AS distinct_exact, 0 AS distinct_off, unnest([0.1, 0.5, 0.9]) AS share, round(unnest([b[1], b[3], b[5]]), 4) AS low, round(unnest([b[2], b[4], b[6]]), 4) AS high, 'within' AS place FROM e""")
def agg_5(spark, d):
    """AGG-5, AGG-6: approximate distinct counts and quantile lists against exact ones: how many times 5% the count is off, and whether each
    quantile is below, within or above the exact values 1% of the ranks to either side."""
    rows = lens.table(spark, d, "lineitem")
    exact = rows.select("l_returnflag", "l_partkey").distinct().groupBy("l_returnflag").agg(F.count("*").alias("k"))
    bounds = quantiles(rows, "l_extendedprice", ["l_returnflag"], [s + e for s in SHARES for e in (-RANK_OFF, RANK_OFF)]).withColumnRenamed("q", "b")
    found = rows.groupBy("l_returnflag").agg(F.approx_count_distinct("l_partkey", 0.015).alias("a"), F.percentile_approx("l_extendedprice", SHARES, 10000).alias("p"))
    cells = F.explode(F.array(*[F.struct(F.lit(s).alias("share"), F.col("p")[i].alias("value"), F.col("b")[2 * i].alias("low"), F.col("b")[2 * i + 1].alias("high")) for i, s in enumerate(SHARES)]))
    long = found.join(exact, "l_returnflag").join(bounds, "l_returnflag").select("l_returnflag", "k", F.floor(F.abs(F.col("a") / F.col("k") - 1) / COUNT_OFF).cast("int").alias("off"), cells.alias("c")).select("l_returnflag", "k", "off", "c.*")
    place = F.when(F.col("value") < F.col("low"), "below").when(F.col("value") > F.col("high"), "above").otherwise("within")
    return long.select("l_returnflag", F.col("k").alias("distinct_exact"), F.col("off").alias("distinct_off"), "share", F.round("low", 4).alias("low"), F.round("high", 4).alias("high"), place.alias("place"))


@query("agg_8_log_moments", with_("stakes", "players") + " SELECT brand, count(*) AS n, round(avg(ln(stake_c)), 6) AS mean_ln, round(stddev_samp(ln(stake_c)), 6) AS sd_ln, round(skewness(ln(stake_c)), 4) AS skewness_ln FROM stakes JOIN players USING (player_id) WHERE stake_c > 0 GROUP BY brand")
def agg_8(spark, d):
    """AGG-8: moments of ln x of the values over 0."""
    rows = lens.stakes(spark, d).join(lens.players(spark, d), "player_id").where("stake_c > 0").withColumn("x", F.log("stake_c"))
    return rows.groupBy("brand").agg(F.count("*").alias("n"), F.round(F.avg("x"), 6).alias("mean_ln"), F.round(F.stddev_samp("x"), 6).alias("sd_ln"), F.round(profiles.sample_skewness("x"), 4).alias("skewness_ln"))


@query("agg_14_aligned_histogram", "SELECT CAST(CASE WHEN l_quantity <= 5 THEN floor((l_quantity - 3) / 2.0::DOUBLE) - (CASE WHEN l_quantity = 5 THEN 1 ELSE 0 END) WHEN l_quantity > 45 THEN 20 + ceil((l_quantity - 45) / 2.0::DOUBLE) ELSE ceil((l_quantity - 5) / 2.0::DOUBLE) END AS INT) AS bin, count(*) AS n FROM lineitem GROUP BY ALL")
def agg_14(spark, d):
    """AGG-14: bins whose edges are the limits 5 and 45; a value on an edge of the upper side belongs below it, and bins go on beyond the limits."""
    x = F.col("l_quantity")
    low = F.floor((x - 3) / F.lit(2.0)) - F.when(x == 5, 1).otherwise(0)
    bin_ = F.when(x <= 5, low).when(x > 45, 20 + F.ceil((x - 45) / F.lit(2.0))).otherwise(F.ceil((x - 5) / F.lit(2.0)))
    return lens.table(spark, d, "lineitem").groupBy(bin_.cast("int").alias("bin")).agg(F.count("*").alias("n"))


@query("agg_19_clamped", with_("gaming") + " SELECT l.line, CAST(greatest(floor((payout_c - stake_c) / 1000.0::DOUBLE), -301) AS INT) AS bucket, count(*) AS n FROM gaming l GROUP BY ALL")
def agg_19(spark, d):
    """AGG-19: a histogram by bucket whose lowest bin holds all below."""
    return lens.gaming(spark, d).groupBy("line", F.greatest(F.floor((F.col("payout_c") - F.col("stake_c")) / F.lit(1000.0)), F.lit(-301)).cast("int").alias("bucket")).agg(F.count("*").alias("n"))


SEVEN = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]


@query("agg_22_ratio_quantiles", with_("gaming", "players") + ", r AS (SELECT brand, payout_c / stake_c AS a, stake_c / quantity AS b FROM gaming JOIN players USING (player_id) WHERE stake_c > 0 AND quantity > 0) SELECT brand, " + ", ".join(f"round(quantile_cont({x}, {q}), 6) AS {x}_p{round(q * 100):02d}" for x in "ab" for q in SEVEN) + " FROM r GROUP BY brand")
def agg_22(spark, d):
    """AGG-22: seven exact quantiles of two ratios per brand, from the values near the approximate ones."""
    rows = lens.gaming(spark, d).join(lens.players(spark, d), "player_id").where("stake_c > 0 and quantity > 0")
    rows = kept(rows.select("brand", (F.col("payout_c") / F.col("stake_c")).alias("a"), (F.col("stake_c") / F.col("quantity")).alias("b")))
    parts = [quantiles(rows, x, ["brand"], SEVEN, steady=True).select("brand", *[F.round(F.col("q")[i], 6).alias(f"{x}_p{round(q * 100):02d}") for i, q in enumerate(SEVEN)]) for x in "ab"]
    return parts[0].join(parts[1], "brand")


@query("agg_29_top_values", "SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS value, count(*) AS n FROM lineitem WHERE l_discount > 0.09 GROUP BY ALL ORDER BY n DESC, value LIMIT 10")
def agg_29(spark, d):
    """AGG-29: most frequent values of an expression among the bad rows."""
    return lens.table(spark, d, "lineitem").where("l_discount > 0.09").groupBy(F.trunc(F.to_date("l_shipdate"), "month").alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(10)


@query("agg_34_tax_profile", "SELECT l_returnflag, count(*) AS n, count(*) FILTER (l_tax IS NULL) AS nulls, count(*) FILTER (l_tax = 0) AS zeros, count(*) FILTER (l_tax < 0) AS negatives, count(*) FILTER (l_tax * l_extendedprice > l_extendedprice * l_discount) AS above_base, round(quantile_cont(l_tax, 0.5), 6) AS tax_p50, round(quantile_cont(l_tax, 0.95), 6) AS tax_p95 FROM lineitem GROUP BY l_returnflag")
def agg_34(spark, d):
    """AGG-34, CHK-9: null, zero, negative and too large taxes, and quantiles of their rate."""
    rows, x = lens.table(spark, d, "lineitem"), F.col("l_tax")
    counts = rows.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.count_if(x.isNull()).alias("nulls"), F.count_if(x == 0).alias("zeros"), F.count_if(x < 0).alias("negatives"), F.count_if(x * F.col("l_extendedprice") > F.col("l_extendedprice") * F.col("l_discount")).alias("above_base"))
    q = quantiles(rows, "l_tax", ["l_returnflag"], [0.5, 0.95])
    return counts.join(q, "l_returnflag").select(*counts.columns, F.round(F.col("q")[0], 6).alias("tax_p50"), F.round(F.col("q")[1], 6).alias("tax_p95"))


ALL_DAYS = "days_ AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM activity)"


@query("agg_37_daily_profile", with_("activity") + f", {ALL_DAYS}, p AS (SELECT day, count(*) AS n, count(nullif(active, false)) AS active, CAST(sum(turnover_c) AS BIGINT) AS turnover_c FROM activity GROUP BY day) SELECT day, coalesce(n, 0) AS n, coalesce(active, 0) AS active, coalesce(turnover_c, 0) AS turnover_c FROM days_ LEFT JOIN p USING (day)")
def agg_37(spark, d):
    """AGG-37: rows, non-null counts and totals of every day there can be; missing days have 0 rows."""
    a = lens.activity(spark, d)
    per = a.groupBy("day").agg(F.count("*").alias("n"), F.count(F.when(F.col("active"), 1)).alias("active"), F.sum("turnover_c").alias("turnover_c"))
    days = a.agg(F.min("day").alias("a"), F.max("day").alias("b")).select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("day"))
    return days.join(per, "day", "left").na.fill(0)


@query("agg_42_session_month", f"WITH {pl.SESSIONS} SELECT user_id, minutes, CAST(date_trunc('month', day) AS DATE) AS month, count(*) AS sessions, count(*) FILTER (events = 1) AS single, CAST(sum(seconds) AS BIGINT) AS seconds, median(seconds) AS median_seconds FROM x GROUP BY ALL")
def agg_42(spark, d):
    """AGG-42: a player's month of sessions."""
    return pl.sess_1(spark, d).groupBy("user_id", "minutes", F.trunc("day", "month").alias("month")).agg(F.count("*").alias("sessions"), F.count_if(F.col("events") == 1).alias("single"), F.sum("seconds").alias("seconds"), F.median("seconds").alias("median_seconds"))


@query("agg_48_hourly_ratio", """WITH a AS (SELECT event_type AS brand, date_trunc('hour', ts) AS hour, count(*) AS n, count(*) FILTER (event_id % 9 <> 0) AS m FROM events GROUP BY ALL), r AS (SELECT *, n / m AS ratio FROM a WHERE m > 0), k AS (SELECT brand, median(ratio) AS med FROM r GROUP BY brand)
SELECT hour, count(*) AS brands, count(*) FILTER (ratio / med > 1.02) AS above FROM r JOIN k USING (brand) GROUP BY hour""")
def agg_48(spark, d):
    """AGG-48: hourly ratio of two layers over its brand's median, and how many brands are above."""
    a = lens.table(spark, d, "events").groupBy(F.col("event_type").alias("brand"), F.date_trunc("hour", "ts").alias("hour")).agg(F.count("*").alias("n"), F.count_if(F.col("event_id") % 9 != 0).alias("m"))
    r = a.where("m > 0").withColumn("ratio", F.col("n") / F.col("m"))
    med = quantiles(r, "ratio", ["brand"], [0.5]).select("brand", F.col("q")[0].alias("med"))
    return r.join(med, "brand").groupBy("hour").agg(F.count("*").alias("brands"), F.count_if(F.col("ratio") / F.col("med") > 1.02).alias("above"))


FILLED = ("bets_l7d", "wagered_c_l7d", "prior_wagered_c_l180d")


@query("agg_50_filled", with_("activity") + f", {pl.CUT}, {pl.FEATURES} SELECT cutoff, {', '.join(f'bool_or({c} <> 0) AS {c}' for c in FILLED)} FROM features GROUP BY cutoff")
def agg_50(spark, d):
    """AGG-50: whether a column is filled for anyone of a snapshot."""
    return pl.feat(spark, d).groupBy("cutoff").agg(*[F.bool_or(F.col(c) != 0).alias(c) for c in FILLED])


@query("agg_51_coverage", with_("activity") + " SELECT day, brand, count(*) AS n, round(avg(CAST(active AS INT)), 6) AS active_share FROM activity GROUP BY ALL")
def agg_51(spark, d):
    """AGG-51"""
    return lens.activity(spark, d).groupBy("day", "brand").agg(F.count("*").alias("n"), F.round(F.avg(F.col("active").cast("int")), 6).alias("active_share"))


@query("win_1_one_row", "SELECT l_orderkey, l_linenumber, min(l_extendedprice) AS price FROM lineitem GROUP BY ALL")
def win_1(spark, d):
    """WIN-1: one row per key, that of the least price."""
    return lens.table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_extendedprice").alias("price"))


@query("win_4_session_gap", f"WITH {pl.SESSIONS}, q AS (SELECT user_id, minutes, min(ts) AS start, max(ts) AS stop FROM s GROUP BY user_id, minutes, session), h AS (SELECT minutes, (epoch_us(start) - epoch_us(lag(stop) OVER (PARTITION BY user_id, minutes ORDER BY start))) / 3600000000.0::DOUBLE AS hours FROM q) SELECT minutes, count(hours) AS n, round(min(hours), 6) AS least, round(avg(hours), 4) AS mean, round(max(hours), 4) AS longest FROM h GROUP BY minutes")
def win_4(spark, d):
    """WIN-4: hours from the end of a session to the start of the next."""
    e = sessions.numbered(lens.table(spark, d, "events"), "user_id", "ts")
    q = e.groupBy("user_id", "minutes", "session").agg(F.min("_ts").alias("start"), F.max("_ts").alias("stop"))
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    hours = (micros(F.col("start")) - micros(F.lag("stop").over(Window.partitionBy("user_id", "minutes").orderBy("start")))) / 3_600_000_000
    return q.withColumn("h", hours).groupBy("minutes").agg(F.count("h").alias("n"), F.round(F.min("h"), 6).alias("least"), F.round(F.avg("h"), 4).alias("mean"), F.round(F.max("h"), 4).alias("longest"))


@query("win_14_quartiles", with_("players", "stakes") + ", p AS (SELECT brand, player_id, CAST(sum(stake_c) AS BIGINT) // 10000000 AS v FROM stakes JOIN players USING (player_id) GROUP BY ALL) SELECT brand, player_id, 'Q' || CAST(ceil(row_number() OVER (PARTITION BY brand ORDER BY v, (player_id * 7919 + 17) % 10007, player_id) * 4 / count(*) OVER (PARTITION BY brand)) AS INT) AS quartile FROM p")
def win_14(spark, d):
    """WIN-14: quartiles with a seeded random order of equal values. Places come from ranges of values, so no task orders a brand."""
    p = lens.stakes(spark, d).join(lens.players(spark, d), "player_id").groupBy("brand", "player_id").agg(F.expr("sum(stake_c) div 10000000").alias("v"))
    found = placed(p.withColumn("k", F.expr("(player_id * 7919 + 17) % 10007 * 1000000000000 + player_id")), ["brand"], "v", "k", descending=False)
    return found.select("brand", "player_id", F.concat(F.lit("Q"), F.ceil(F.col("place") * 4 / F.col("size")).cast("int")).alias("quartile"))


@query("join_10_one_to_one", with_("activity") + f", {pl.CUT}, {pl.ACTIVE}, {pl.POP}, {pl.LABELS}, {pl.FEATURES} SELECT count(*) AS n_rows, count(DISTINCT (f.cutoff, f.player_id)) AS n_keys, count(*) FILTER (l.player_id IS NULL) AS without_label, count(*) FILTER (l.event_60d IS NULL AND l.player_id IS NOT NULL) AS unconfirmed FROM (SELECT * FROM features WHERE active_days_l180d > 0) f LEFT JOIN labels l USING (cutoff, player_id, brand)")
def join_10(spark, d):
    """JOIN-10, LAB-7: features and labels one to one: repeats, rows without a label, labels that are not closed."""
    f = pl.feat(spark, d).where("active_days_l180d > 0").select("cutoff", "player_id", "brand")
    both = f.join(pl.lab(spark, d).select("cutoff", "player_id", "brand", "event_60d", F.lit(1).alias("has")), ["cutoff", "player_id", "brand"], "left")
    per = both.groupBy("cutoff", "player_id").agg(F.count("*").alias("n"), F.count_if(F.col("has").isNull()).alias("without"), F.count_if(F.col("has").isNotNull() & F.col("event_60d").isNull()).alias("open"))
    return per.agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_keys"), F.sum("without").alias("without_label"), F.sum("open").alias("unconfirmed"))


@query("join_19_product_mix", with_("stakes", "activity") + ", m AS (SELECT player_id, day, bool_or(product = '1-URGENT') AS urgent, bool_or(product <> '1-URGENT') AS other FROM stakes GROUP BY ALL), d AS (SELECT player_id, day, CASE WHEN urgent AND other THEN 'mixed' WHEN urgent THEN 'urgent' ELSE 'other' END AS mix FROM m), p AS (SELECT player_id, CASE WHEN bool_or(urgent) AND bool_or(other) THEN 'mixed' WHEN bool_or(urgent) THEN 'urgent' ELSE 'other' END AS mix FROM m GROUP BY player_id), "
       "s AS (SELECT 'day' AS level, mix, bets, ggr_c FROM activity JOIN d USING (player_id, day) UNION ALL SELECT 'player', mix, bets, ggr_c FROM activity JOIN p USING (player_id)) SELECT level, mix, count(*) AS n, CAST(sum(bets) AS BIGINT) AS bets, CAST(sum(ggr_c) AS BIGINT) AS ggr_c FROM s GROUP BY ALL")  # fmt: skip
def join_19(spark, d):
    """JOIN-19: product mix of a day and of a player, joined to activity."""
    m = lens.stakes(spark, d).groupBy("player_id", "day").agg(F.bool_or(F.col("product") == "1-URGENT").alias("u"), F.bool_or(F.col("product") != "1-URGENT").alias("o"))
    mix = F.when(F.col("u") & F.col("o"), "mixed").when(F.col("u"), "urgent").otherwise("other")
    a = lens.activity(spark, d).select("player_id", "day", "bets", "ggr_c")
    by_day = a.join(m, ["player_id", "day"]).select(F.lit("day").alias("level"), mix.alias("mix"), "bets", "ggr_c")
    by_player = a.join(m.groupBy("player_id").agg(F.bool_or("u").alias("u"), F.bool_or("o").alias("o")), "player_id").select(F.lit("player").alias("level"), mix.alias("mix"), "bets", "ggr_c")
    return by_day.unionByName(by_player).groupBy("level", "mix").agg(F.count("*").alias("n"), F.sum("bets").alias("bets"), F.sum("ggr_c").alias("ggr_c"))


@query("proj_3_doubles", "SELECT l_returnflag, CAST(sum(CAST(CAST(l_discount AS DECIMAL(10, 4)) AS DOUBLE) * 10000) AS BIGINT) AS discount, 'double' AS type FROM lineitem GROUP BY l_returnflag")
def proj_3(spark, d):
    """PROJ-3, PROJ-5: decimals become doubles, and columns that a contract calls personal are not read."""
    rows = lens.table(spark, d, "lineitem").withColumn("l_discount", F.col("l_discount").cast("decimal(10,4)"))
    rows = keys.doubles(keys.without_personal(rows, {"l_comment", "l_shipinstruct"}))
    return rows.groupBy("l_returnflag").agg(F.sum(F.col("l_discount") * 10000).cast("decimal(20,2)").cast("long").alias("discount"), F.typeof(F.first("l_discount")).alias("type"))


@query("proj_7_batch_day", "SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS batch_day, count(*) AS n FROM events GROUP BY ALL")
def proj_7(spark, d):
    """PROJ-7, DQ-5: the batch day as text."""
    return lens.table(spark, d, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("batch_day")).agg(F.count("*").alias("n"))


@query("filt_5_infinite", "SELECT event_type, count(*) AS n, count(*) FILTER (event_id % 10 <> 0) AS finite FROM events GROUP BY event_type")
def filt_5(spark, d):
    """FILT-5: infinite values are null."""
    x = F.when(F.col("event_id") % 10 == 0, F.lit(float("inf"))).otherwise(F.col("value"))
    rows = lens.table(spark, d, "events").withColumn("x", x)
    return keys.finite(rows).groupBy("event_type").agg(F.count("*").alias("n"), F.count("x").alias("finite"))


@query("scan_10_needed_days", with_("activity") + f", {pl.CUT} SELECT DISTINCT day FROM (SELECT cutoff AS day FROM cut UNION ALL SELECT cutoff - CAST(k AS INT) FROM cut, range(1, 4) t(k) UNION ALL SELECT DATE '1996-02-10' + CAST(k AS INT) FROM range(0, 5) t(k))")
def scan_10(spark, d):
    """SCAN-10: days a run needs: snapshots, days before them, a period."""
    cut = pl.cut(spark, d)
    period = spark.sql("SELECT explode(sequence(date'1996-02-10', date'1996-02-14', interval 1 day)) AS day")
    return cut.select(F.explode(F.sequence(F.date_sub("cutoff", 3), F.col("cutoff"), F.expr("interval 1 day"))).alias("day")).union(period).distinct()


@query("scan_6_landing", """WITH e AS (SELECT event_id, ts, CAST(ts + INTERVAL 3 HOUR AS DATE) AS folder FROM events), g AS (SELECT DISTINCT folder AS d FROM e)
SELECT d AS day, count(*) AS n, count(*) FILTER (folder <> d) AS other_folder FROM g JOIN e ON folder BETWEEN d - 1 AND d + 1 AND ts >= CAST(d AS TIMESTAMP) - INTERVAL 2 HOUR AND ts < CAST(d AS TIMESTAMP) + INTERVAL 36 HOUR GROUP BY d""")
def scan_6(spark, d):
    """SCAN-6: a day from its folder and those beside it, by event time from two hours before to twelve after. Folders are dealt to the days they serve."""
    e = lens.table(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), F.to_date(F.col("ts") + F.expr("interval 3 hours")).alias("folder"))
    days = e.select(F.col("folder").alias("day")).distinct()
    rows = e.withColumn("day", F.explode(F.sequence(F.date_sub("folder", 1), F.date_add("folder", 1), F.expr("interval 1 day"))))
    midnight = F.col("day").cast("timestamp")
    rows = rows.where((F.col("ts") >= midnight - F.expr("interval 2 hours")) & (F.col("ts") < midnight + F.expr("interval 36 hours")))
    return rows.join(days, "day", "left_semi").groupBy("day").agg(F.count("*").alias("n"), F.count_if(F.col("folder") != F.col("day")).alias("other_folder"))


@query("cache_7_changed_days", "WITH a AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n, sum(event_id) AS s FROM events GROUP BY ALL), b AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n, sum(event_id) AS s FROM events WHERE event_id % 397 <> 0 GROUP BY ALL) SELECT a.day FROM a LEFT JOIN b ON a.day = b.day AND a.n = b.n AND a.s = b.s WHERE b.day IS NULL")
def cache_7(spark, d):
    """CACHE-7: days whose signature has changed since a result was kept; only these are computed again."""
    sign = lambda rows: rows.groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"), F.sum("event_id").alias("s"))
    e = lens.table(spark, d, "events")
    return sign(e).join(sign(e.where("event_id % 397 <> 0")), ["day", "n", "s"], "left_anti").select("day")


@query("cache_4_days_to_build", "WITH s AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events), b AS (SELECT day FROM s WHERE day(day) % 5 <> 0) SELECT DISTINCT day FROM s WHERE day NOT IN (SELECT day FROM b) OR day >= (SELECT max(day) FROM s) - 6")
def cache_4(spark, d):
    """CACHE-4, CACHE-5: missing days, and the last seven, which sources restate."""
    from lakepulse.sources.lake import days_to_build

    s = lens.table(spark, d, "events").select(F.to_date("ts").alias("day")).distinct()
    return days_to_build(s, s.where("day(day) % 5 <> 0"))


@query("meta_5_null_history", "SELECT CAST(ts AS DATE) AS day, round(avg(CAST(nullif(event_type, 'error') IS NULL AS INT)), 6) AS event_type, round(avg(CAST(CASE WHEN value > 50 THEN value END IS NULL AS INT)), 6) AS value, round(min(value), 6) AS low, round(max(value), 6) AS high FROM events GROUP BY ALL")
def meta_5(spark, d):
    """META-5: null share of columns per day, and the daily limits of one."""
    e = lens.table(spark, d, "events").select(F.to_date("ts").alias("day"), F.expr("nullif(event_type, 'error')").alias("event_type"), F.when(F.col("value") > 50, F.col("value")).alias("high_value"), "value")
    null = lambda c: F.round(F.avg(F.col(c).isNull().cast("int")), 6)
    return e.groupBy("day").agg(null("event_type").alias("event_type"), null("high_value").alias("value_"), F.round(F.min("value"), 6).alias("low"), F.round(F.max("value"), 6).alias("high")).withColumnRenamed("value_", "value")


@query("meta_6_file_names", """WITH f AS (SELECT event_id % 4 AS p, event_id // 400 AS block, min(event_id // 4) AS first, count(*) AS n FROM events WHERE event_id // 400 % 7 <> 3 GROUP BY ALL), n AS (SELECT 'events+' || p || '+' || lpad(CAST(first AS VARCHAR), 10, '0') AS name, first, p, n FROM f)
SELECT name, n, CAST(first - lag(first + n) OVER (PARTITION BY p ORDER BY first) AS BIGINT) AS step FROM n""")
def meta_6(spark, d):
    """META-6: continuity of files by their names topic+partition+firstOffset: over 0 a gap, under 0 an overlap."""
    e = lens.table(spark, d, "events").where("(event_id div 400) % 7 <> 3")
    files = e.groupBy((F.col("event_id") % 4).alias("p"), F.expr("event_id div 400").alias("block")).agg(F.min(F.expr("event_id div 4")).alias("first"), F.count("*").alias("n"))
    names = files.select(F.concat_ws("+", F.lit("events"), F.col("p").cast("string"), F.lpad(F.col("first").cast("string"), 10, "0")).alias("name"), "n")
    return keys.file_steps(names)


@query("dist_3_bins", "WITH q AS (SELECT event_type, count(*) AS n, quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b, min(value) AS lo, max(value) AS hi FROM events GROUP BY ALL), w AS (SELECT *, 2 * (b - a) * power(n, -1 / 3.0::DOUBLE) AS width FROM q) SELECT event_type, round(width, 4) AS width, CAST(CASE WHEN width > 0 THEN least(50, ceil((hi - lo) / width)) ELSE 1 END AS INT) AS bins FROM w")
def dist_3(spark, d):
    """DIST-3: bin width by the quartile distance, at most 50 bins."""
    e = lens.table(spark, d, "events")
    stats = e.groupBy("event_type").agg(F.count("value").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")).join(quantiles(e, "value", ["event_type"], [0.25, 0.75]), "event_type")
    width = 2 * (F.col("q")[1] - F.col("q")[0]) * F.pow(F.col("n"), F.lit(-1 / 3))
    bins = F.when(width > 0, F.least(F.lit(50), F.ceil((F.col("hi") - F.col("lo")) / width))).otherwise(1)
    return stats.select("event_type", F.round(width, 4).alias("width"), bins.cast("int").alias("bins"))


@query("shape_1_log_normal")
def shape_1(spark, d):
    """SHAPE-1: log-normal fits of stakes per brand, their distance and verdict."""
    rows = lens.stakes(spark, d).join(lens.players(spark, d), "player_id").where("stake_c > 0").withColumn("x", F.log("stake_c"))
    moments = rows.groupBy("brand").agg(F.avg("x").alias("mean_ln"), F.stddev_samp("x").alias("sd_ln"))
    bins = rows.groupBy("brand", F.floor(F.col("x") / 0.1).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    return shapes.log_normal_fit(bins, ["brand"], moments, 0.1)


@query("shape_3_peaks")
def shape_3(spark, d):
    """SHAPE-3, SHAPE-4: peaks of the smoothed histogram of values per type."""
    bins = lens.table(spark, d, "events").groupBy("event_type", F.floor(F.log1p("value") * 5).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    span = bins.groupBy("event_type").agg(F.min("bin").alias("a"), F.max("bin").alias("b")).select("event_type", F.explode(F.sequence("a", "b")).alias("bin"))
    return shapes.peaks(span.join(bins, ["event_type", "bin"], "left").na.fill(0, ["n"]), ["event_type"])


@query("shape_5_densities", with_("gaming") + ", a AS (SELECT CAST(floor(log10(stake_c) / 0.1::DOUBLE) AS INT) AS bin, count(*) AS n FROM gaming WHERE stake_c > 0 GROUP BY ALL), b AS (SELECT CAST(floor(log10(payout_c) / 0.1::DOUBLE) AS INT) AS bin, count(*) AS n FROM gaming WHERE payout_c > 0 GROUP BY ALL), t AS (SELECT (SELECT sum(n) FROM a) AS x, (SELECT sum(n) FROM b) AS y) "
       "SELECT coalesce(a.bin, b.bin) AS bin, round(coalesce(a.n, 0) / x / 0.1::DOUBLE, 6) AS stored, round(coalesce(b.n, 0) / y / 0.1::DOUBLE, 6) AS recomputed FROM a FULL JOIN b ON a.bin = b.bin, t")  # fmt: skip
def shape_5(spark, d):
    """SHAPE-5: densities of a stored and a recomputed metric over the same bins."""
    g = lens.gaming(spark, d)
    a, b = (profiles.log_histogram(g, c, [], 0.1).withColumnRenamed("n", c) for c in ("stake_c", "payout_c"))
    both = a.join(b, "bin", "full").na.fill(0)
    total = both.agg(F.sum("stake_c").alias("x"), F.sum("payout_c").alias("y"))
    return both.join(F.broadcast(total)).select("bin", F.round(F.col("stake_c") / F.col("x") / 0.1, 6).alias("stored"), F.round(F.col("payout_c") / F.col("y") / 0.1, 6).alias("recomputed"))

"""Queries on alerts, data quality, reconciliation status."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lakepulse.operators import alerts, quality
from lakepulse.sources import lens
from lakepulse.sources.lake import kept
from lakepulse.sources.lens import with_

from . import players as pl
from .registry import query

BANDS = """day_ AS (SELECT brand, day, count(*) AS n FROM activity GROUP BY ALL), w_ AS (SELECT *, list(n::DOUBLE) OVER (PARTITION BY brand ORDER BY day RANGE BETWEEN INTERVAL 28 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING) AS b FROM day_),
m_ AS (SELECT *, list_aggregate(b, 'median') AS med FROM w_), d_ AS (SELECT *, 1.4826::DOUBLE * list_aggregate(list_transform(b, lambda x: abs(x - med)), 'median') AS mad FROM m_),
band AS (SELECT 'daily_total' AS "check", brand, day, n, med, mad, CASE WHEN coalesce(len(b), 0) < 14 THEN 'info' WHEN mad = 0 AND n <> med THEN 'critical' WHEN abs(n - med) > 6 * mad THEN 'critical' WHEN abs(n - med) > 3 * mad THEN 'warn' ELSE 'ok' END AS severity FROM d_)"""


@query("alrt_3_mad_band", with_("activity") + f", {BANDS} SELECT brand, day, n, round(med, 6) AS median, round(mad, 6) AS mad, severity FROM band")
def alrt_3(spark, d):
    """ALRT-3, WIN-11"""
    return alerts.mad_band(lens.activity(spark, d).groupBy("brand", "day").agg(F.count("*").alias("n")), ["brand"], "n")


@query("alrt_2_null_share", with_("activity") + f""", {pl.CUT}, {pl.FEATURES}, p AS (SELECT cutoff, count(*) AS n, count(*) FILTER (heavy_loss_multiple IS NULL) AS nulls FROM features GROUP BY cutoff),
s AS (SELECT *, nulls / n AS share, sum(nulls) OVER w / sum(n) OVER w AS expected FROM p WINDOW w AS (ORDER BY cutoff ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING))
SELECT cutoff, n, nulls, round(share, 6) AS share, round(expected, 6) AS expected, CASE WHEN expected IS NULL OR n < 100 THEN 'info' WHEN 100 * (share - expected) > 20 THEN 'critical' WHEN 100 * (share - expected) > 5 THEN 'warn' ELSE 'ok' END AS severity FROM s""")
def alrt_2(spark, d):
    per = pl.feat(spark, d).groupBy("cutoff").agg(F.count("*").alias("n"), F.count_if(F.col("heavy_loss_multiple").isNull()).alias("nulls"))
    return alerts.null_shares(per, "cutoff", "n", "nulls")


DRIFTING = ("days_since_last_bet", "active_days_l90d", "bets_l180d", "wagered_c_l90d", "ggr_c_l180d", "days_since_first_bet")
DRIFT = f"""{pl.MIDDLE}, l_ AS ({" UNION ALL ".join(f"SELECT brand, cutoff, '{c}' AS feature, CAST({c} AS DOUBLE) AS x FROM features" for c in DRIFTING)}), v_ AS (SELECT * FROM l_ WHERE x IS NOT NULL),
e_ AS (SELECT brand, feature, list_distinct(quantile_cont(x, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1])) AS q, count(DISTINCT x) <= 10 AS single FROM v_, mid WHERE cutoff < m GROUP BY ALL),
b_ AS (SELECT brand, feature, CASE WHEN single THEN x ELSE len(list_filter(list_sort(q)[2:len(q) - 1], lambda z: z <= x)) END AS bin, count(*) FILTER (cutoff < m) AS e, count(*) FILTER (cutoff >= m) AS a FROM v_ JOIN e_ USING (brand, feature), mid GROUP BY ALL),
s_ AS (SELECT brand, feature, greatest(1e-4, e / sum(e) OVER w) AS e, greatest(1e-4, a / sum(a) OVER w) AS a FROM b_ WINDOW w AS (PARTITION BY brand, feature)),
drift AS (SELECT *, CASE WHEN severity <> 'ok' THEN 'drift' END AS reason FROM (SELECT *, CASE WHEN psi > 0.25 THEN 'critical' WHEN psi > 0.10 THEN 'warn' ELSE 'ok' END AS severity FROM (SELECT brand, feature, round(sum((a - e) * ln(a / e)), 6) AS psi FROM s_ GROUP BY ALL))
  UNION ALL SELECT DISTINCT brand, feature, NULL, 'critical', 'not in the reference' FROM v_ WHERE (brand, feature) NOT IN (SELECT (brand, feature) FROM e_))"""


@query("alrt_5_feature_drift", with_("activity") + f", {pl.CUT}, {pl.FEATURES}, {DRIFT} SELECT * FROM drift")
def alrt_5(spark, d):
    """ALRT-5: features of the later cutoffs against the earlier ones, per brand; a brand that these lack is critical."""
    return _drift(_drifting(spark, d))


def _drifting(spark, d):
    """(brand, cutoff, middle) and the features that can drift."""
    return kept(pl.feat(spark, d).select("brand", "cutoff", *DRIFTING)).join(F.broadcast(kept(pl.middle(pl.cut(spark, d)))))


def _drift(rows):
    long = rows.unpivot(["brand", "cutoff", "middle"], [F.col(c).cast("double").alias(c) for c in DRIFTING], "feature", "x").where("x is not null")
    edges = alerts.drift_edges(long.where("cutoff < middle"), ["brand", "feature"], "x", steady=True)
    return alerts.drift(long, ["brand", "feature"], "x", F.col("cutoff") < F.col("middle"), edges)


@query("alrt_5_brands", with_("activity") + f""", {pl.CUT}, {pl.FEATURES}, {DRIFT}, f_ AS (SELECT brand, count(*) FILTER (severity <> 'ok') AS drifting FROM drift GROUP BY brand), n_ AS (SELECT brand, count(*) FILTER (cutoff = (SELECT max(cutoff) FROM features)) AS n, count(*) FILTER (cutoff < m) / nullif(count(DISTINCT cutoff) FILTER (cutoff < m), 0) AS expected FROM features, mid GROUP BY brand)
SELECT brand, drifting, n, round(expected, 6) AS expected, CASE WHEN drifting >= 5 OR expected IS NULL OR abs(n / expected - 1) > 0.5 THEN 'critical' WHEN drifting > 0 OR abs(n / expected - 1) > 0.2 THEN 'warn' ELSE 'ok' END AS severity FROM f_ JOIN n_ USING (brand) WHERE n > 0""")
def alrt_5_brands(spark, d):
    """ALRT-5: five drifting features or more are critical for a brand, and so are players of the latest cutoff far from their usual number."""
    f = _drifting(spark, d)
    last = f.agg(F.max("cutoff").alias("cutoff"))
    counts = alerts.player_counts(f.join(F.broadcast(last), "cutoff", "left_semi"), f.where("cutoff < middle"), ["brand"], "cutoff").withColumnRenamed("severity", "of_count")
    drifting = _drift(f).groupBy("brand").agg(F.count_if(F.col("severity") != "ok").alias("drifting"))
    of_drift = F.when(F.col("drifting") >= 5, "critical").when(F.col("drifting") > 0, "warn").otherwise("ok")
    worst = F.when(of_drift.eqNullSafe("critical") | F.col("of_count").eqNullSafe("critical"), "critical").when((of_drift == "warn") | (F.col("of_count") == "warn"), "warn").otherwise("ok")
    return drifting.join(counts, "brand").select("brand", "drifting", "n", "expected", worst.alias("severity"))


ENTRIES = "entry AS (SELECT * FROM (VALUES ('daily_total', 'BUILDING', DATE '1996-01-01', DATE '1998-12-31', 1000000, 'known campaign'), ('daily_total', NULL, DATE '2000-01-01', DATE '2001-12-31', 1000000, 'end of data')) t(c, b, first, last, most, reason))"
ALERTS = f"""{BANDS}, {ENTRIES}, r_ AS (SELECT "check", brand, day, min(reason) AS reason FROM band JOIN entry ON "check" = c AND (b IS NULL OR b = brand) AND day BETWEEN first AND last AND n <= most WHERE severity = 'critical' GROUP BY ALL),
ack AS (SELECT "check", brand, day, n, CASE WHEN reason IS NOT NULL THEN 'warn' ELSE severity END AS severity, reason FROM band LEFT JOIN r_ USING ("check", brand, day))"""


@query("alrt_6_acknowledged", with_("activity") + f", {ALERTS} SELECT *, CASE severity WHEN 'critical' THEN 1 WHEN 'warn' THEN 2 WHEN 'info' THEN 3 ELSE 4 END AS place FROM ack WHERE severity <> 'ok'")
def alrt_6(spark, d):
    """ALRT-6, TOPK-4: the report of daily totals, with what is acknowledged, ordered by severity."""
    return acknowledged_totals(spark, d).where("severity <> 'ok'").withColumn("place", alerts.rank_of()).orderBy("place", "brand", "day")


def acknowledged_totals(spark, d):
    rows = alrt_3(spark, d).select(F.lit("daily_total").alias("check"), "brand", "day", "n", "severity")
    entries = spark.sql("SELECT * FROM VALUES ('daily_total', 'BUILDING', date'1996-01-01', date'1998-12-31', 1000000, 'known campaign'), ('daily_total', NULL, date'2000-01-01', date'2001-12-31', 1000000, 'end of data') AS t(check, brand, first, last, most, reason)")
    return alerts.acknowledged(rows, entries, "n")


@query("alrt_7_blocking", with_("activity") + f""", {pl.CUT}, {pl.FEATURES}, {ALERTS}, {DRIFT}, u AS (SELECT "check", severity FROM ack UNION ALL SELECT 'feature_drift', severity FROM drift)
SELECT count(*) AS alerts, count(*) FILTER (severity = 'critical') AS critical, count(*) FILTER (severity = 'critical' AND "check" <> 'feature_drift') AS stopping, count(*) FILTER (severity = 'critical' AND "check" <> 'feature_drift') > 0 AS stops FROM u""")
def alrt_7(spark, d):
    every = acknowledged_totals(spark, d).select("check", "severity").union(alrt_5(spark, d).select(F.lit("feature_drift"), "severity"))
    return alerts.blocking(every)


@query("topk_1_examples", with_("stakes", "players") + """, f AS (SELECT brand, stake_c, order_id, player_id FROM stakes JOIN players USING (player_id) WHERE stake_c > 40000000),
r AS (SELECT *, row_number() OVER (PARTITION BY brand ORDER BY stake_c DESC, 'order=' || order_id || ', player=' || player_id || ', stake=' || stake_c) AS r FROM f)
SELECT brand, count(*) AS n, string_agg('order=' || order_id || ', player=' || player_id || ', stake=' || stake_c, '; ' ORDER BY r) AS examples FROM r WHERE r <= 20 GROUP BY brand""")
def topk_1(spark, d):
    """TOPK-1: the 20 worst flagged stakes of each brand, as text."""
    rows = lens.stakes(spark, d).join(lens.players(spark, d), "player_id").where("stake_c > 40000000")
    return alerts.examples(rows, ["brand"], "stake_c", F.concat(F.lit("order="), "order_id", F.lit(", player="), "player_id", F.lit(", stake="), "stake_c"))


NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


@query("dq_4_non_negative", " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} < 0) AS problems, CAST(min({c}) AS DOUBLE) AS low, CAST(max({c}) AS DOUBLE) AS high FROM lineitem" for c in ("l_extendedprice", "l_quantity", "l_tax")))
def dq_4(spark, d):
    """DQ-4, FILT-6: columns that are non-negative by their names; a failed check keeps the observed limits (DQ-7)."""
    rows = lens.table(spark, d, "lineitem")
    return quality.non_negative(rows, quality.by_name(rows, "price|quantity|tax", "net_|ggr"))


@query("dq_7_failed_checks", """WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT 'range_l_quantity' AS rule, count(*) FILTER (l_quantity NOT BETWEEN 2 AND 45) AS problems, CAST(min(l_quantity) AS DOUBLE) AS low, CAST(max(l_quantity) AS DOUBLE) AS high, CAST(NULL AS BIGINT) AS rows_left FROM lineitem
UNION ALL SELECT 'grain', CAST(sum(n - 1) AS BIGINT), NULL, NULL, count(*) FROM k""")
def dq_7(spark, d):
    """DQ-7: value checks keep the observed limits, grain checks the rows left after the latest version."""
    return quality.failed_checks(lens.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], {"l_quantity": (2, 45)})


CHECKS = """c AS (SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS n, count(*) FILTER (l_quantity > 49) AS quantity, count(*) FILTER (l_discount > 0.099) AS discount FROM lineitem GROUP BY ALL),
f AS (SELECT day, n, 'quantity' AS "check", quantity AS problems FROM c UNION ALL SELECT day, n, 'discount', discount FROM c)"""


@query("rec_9_summary", f"""WITH {CHECKS}, s AS (SELECT *, problems / n AS share, CASE WHEN problems / n > 0.001 THEN 'critical' WHEN problems > 0 THEN 'warn' ELSE 'ok' END AS status FROM f)
SELECT "check", count(*) AS days, count(*) FILTER (problems > 0) AS days_hit, CAST(sum(problems) AS BIGINT) AS problems, round(max(share), 6) AS max_share, CASE min(CASE status WHEN 'critical' THEN 1 WHEN 'warn' THEN 2 ELSE 3 END) WHEN 1 THEN 'critical' WHEN 2 THEN 'warn' ELSE 'ok' END AS worst FROM s GROUP BY "check\"""")
def rec_9(spark, d):
    """REC-8, REC-9, DQ-8: status of each day and check, and their summary over days."""
    return quality.summary(_daily_checks(spark, d), ["check"])


def _daily_checks(spark, d):
    rows = lens.table(spark, d, "lineitem").groupBy(F.to_date("l_shipdate").alias("day")).agg(F.count("*").alias("n"), F.count_if(F.col("l_quantity") > 49).alias("quantity"), F.count_if(F.col("l_discount") > 0.099).alias("discount"))
    return rows.unpivot(["day", "n"], ["quantity", "discount"], "check", "problems")


@query("rec_8_status", f"""WITH {CHECKS} SELECT day, "check", n, problems, CASE WHEN problems / n > 0.001 THEN 'critical' WHEN problems > 0 THEN 'warn' ELSE 'ok' END AS status,
CASE WHEN problems / n > 0.001 THEN 'warn' WHEN problems > 0 THEN 'info' ELSE 'ok' END AS as_delay FROM f""")
def rec_8(spark, d):
    """REC-8: a share's status; that of delays is one level lower."""
    share = F.col("problems") / F.col("n")
    return _daily_checks(spark, d).select("day", "check", "n", "problems", quality.status(share).alias("status"), quality.status(share, delay=True).alias("as_delay"))


@query("agg_53_monthly_problems", f"""WITH {CHECKS} SELECT "check", CAST(date_trunc('month', day) AS DATE) AS month, round(sum(problems) / sum(n), 6) AS share, round(max(problems) / nullif(sum(problems), 0), 6) AS worst_day FROM f GROUP BY ALL""")
def agg_53(spark, d):
    """AGG-53: problems per row and month, and the share of its worst day."""
    p = F.col("problems")
    return _daily_checks(spark, d).groupBy("check", F.trunc("day", "month").alias("month")).agg(F.round(F.sum(p) / F.sum("n"), 6).alias("share"), F.round(F.max(p) / F.when(F.sum(p) > 0, F.sum(p)), 6).alias("worst_day"))


@query("rec_1_messages", """WITH m AS (SELECT CAST(ts + INTERVAL 90 MINUTE AS DATE) AS folder, CAST(ts AS DATE) AS day, user_id, event_type, epoch_us(ts) AS t, nullif(event_id % 50, 0) AS k FROM events),
g AS (SELECT folder, user_id, event_type, k, count(*) AS n FROM m GROUP BY ALL), r AS (SELECT folder, CAST(sum(n - 1) AS BIGINT) AS repeated FROM g GROUP BY folder)
SELECT folder, count(*) AS messages, repeated, count(*) FILTER (k IS NULL) AS empty_keys, count(*) FILTER (day <> folder) AS other_day FROM m JOIN r USING (folder) GROUP BY folder, repeated""")
def rec_1(spark, d):
    """REC-1: messages per folder day: repeats of the business key, empty keys, events of another day."""
    m = lens.table(spark, d, "events").select(F.to_date(F.col("ts") + F.expr("interval 90 minutes")).alias("folder"), F.to_date("ts").alias("day"), "user_id", "event_type", F.expr("nullif(event_id % 50, 0)").alias("k"))
    return quality.messages(m, "folder", "day", ["user_id", "event_type", "k"], "k")


@query("rec_5_period_totals", with_("gaming", "stakes") + """, e AS (SELECT min(day) + CAST((max(day) - min(day)) // 4 AS INT) AS a, min(day) + CAST((max(day) - min(day)) * 3 // 4 AS INT) AS b FROM stakes), x AS (SELECT player_id, sum(stake_c) AS a FROM gaming, e WHERE day BETWEEN e.a AND e.b GROUP BY ALL), y AS (SELECT player_id, sum(stake_c) AS b FROM stakes, e WHERE day BETWEEN e.a - 30 AND e.b GROUP BY ALL),
j AS (SELECT coalesce(a, 0) AS a, coalesce(b, 0) AS b FROM x FULL JOIN y USING (player_id))
SELECT count(*) AS n_keys, count(*) FILTER (abs(a - b) > 0.01 AND abs(a - b) > 0.001::DOUBLE * greatest(abs(a), abs(b))) AS problems_stake_c, CAST(sum(a) AS BIGINT) AS stake_c_left, CAST(sum(b) AS BIGINT) AS stake_c_right FROM j""")
def rec_5(spark, d):
    """REC-5: totals of the middle half of the data's days by either side's own dating, the second with 30 days of late folders. The first is
    read from day folders of the lake, of which only those of the period are listed and read."""
    from lakepulse.operators.keys import compare_totals
    from lakepulse.sources import lake

    stakes = lens.stakes(spark, d)
    ends = stakes.agg(F.min("day").alias("lo"), F.datediff(F.max("day"), F.min("day")).alias("span")).first()
    at = lambda share: ends["lo"] + dt.timedelta(days=ends["span"] * share // 4)
    path = lake.work_folder(spark, "lines")
    months = lens.gaming(spark, d).select("player_id", "stake_c", "day").withColumn("folder", F.trunc("day", "month"))
    months.repartition("folder").write.partitionBy("folder").parquet(path)
    first_folder = at(1).replace(day=1)
    left = lake.read_days(spark, path, str(first_folder), str(at(3))).where(F.col("day").between(F.lit(at(1)), F.lit(at(3))))
    right = stakes.where(F.col("day").between(F.date_sub(F.lit(at(1)), 30), F.lit(at(3))))
    return compare_totals(left.select("player_id", "stake_c"), right.select("player_id", "stake_c"), ["player_id"], ["stake_c"])


CONTRACT = {"o_orderkey": "bigint", "o_custkey": "int", "o_orderstatus": "string", "o_totalprice": "double", "o_orderdate": "timestamp_ntz", "o_brand": "string"}


@query("dq_12_semantic", with_("activity") + f""", {pl.CUT}, {pl.FEATURES}, s AS (SELECT cutoff, player_id, bets_l90d AS stored, wagered_c_l90d AS stored2 FROM features),
r AS (SELECT cutoff, player_id, CAST(sum(bets) AS BIGINT) AS again, CAST(sum(turnover_c) AS BIGINT) AS again2 FROM cut JOIN activity ON day > cutoff - 90 AND day <= cutoff - 1 GROUP BY ALL),
l AS (SELECT cutoff, 'bets_l90d' AS "column", stored, coalesce(again, 0) AS again FROM s LEFT JOIN r USING (cutoff, player_id) UNION ALL SELECT cutoff, 'wagered_c_l90d', stored2, coalesce(again2, 0) FROM s LEFT JOIN r USING (cutoff, player_id))
SELECT cutoff, "column", count(*) AS n, round(avg(CAST(abs(stored - again) <= greatest(0.5, 0.02::DOUBLE * abs(again)) AS INT)), 6) AS match_share, CAST(sum(stored) AS BIGINT) AS stored, CAST(sum(again) AS BIGINT) AS recomputed,
avg(CAST(abs(stored - again) <= greatest(0.5, 0.02::DOUBLE * abs(again)) AS INT)) >= 0.95 AS ok FROM l GROUP BY ALL""")
def dq_12(spark, d):
    """DQ-12: stored look-backs against sums recomputed without the day of the cutoff."""
    from lakepulse.operators import labels

    stored = pl.feat(spark, d).select("cutoff", "player_id", "bets_l90d", "wagered_c_l90d")
    rows = labels._windowed(lens.activity(spark, d), pl.cut(spark, d), 90).where("day < cutoff")
    again = rows.groupBy("cutoff", "player_id").agg(F.sum("bets").alias("bets"), F.sum("turnover_c").alias("wagered"))
    both = stored.join(again, ["cutoff", "player_id"], "left").na.fill(0, ["bets", "wagered"])
    pairs = F.explode(F.array(F.struct(F.lit("bets_l90d").alias("column"), F.col("bets_l90d").alias("stored"), F.col("bets").alias("again")), F.struct(F.lit("wagered_c_l90d").alias("column"), F.col("wagered_c_l90d").alias("stored"), F.col("wagered").alias("again"))))
    return quality.semantic(both.select("cutoff", pairs.alias("p")).select("cutoff", "p.*"), ["cutoff", "column"], "stored", "again")


@query("dq_9_table_profile", """WITH r AS (SELECT min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) AS b, count(DISTINCT CAST(o_orderdate AS DATE)) AS days, count(*) AS n, count(DISTINCT o_orderkey) AS k, count(*) FILTER (o_totalprice < 0) AS neg, count(*) - count(o_clerk_) AS nulls FROM (SELECT *, nullif(o_orderstatus, 'P') AS o_clerk_ FROM orders)),
o AS (SELECT count(*) AS orphans FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)))
SELECT a AS first_day, b AS last_day, CAST(b - a + 1 - days AS BIGINT) AS missing_days, n AS n_rows, n - k AS repeated, neg AS negatives, round(100.0 * nulls / n, 6) AS null_percent, orphans FROM r, o""")
def dq_9(spark, d):
    """DQ-9, META-4: range and gaps of days, repeats of the key, negatives, nulls, players that no table has."""
    orders = lens.table(spark, d, "orders").withColumn("settled", F.expr("nullif(o_orderstatus, 'P')"))
    return quality.table_profile(orders, F.to_date("o_orderdate"), "o_orderkey", "o_totalprice", "settled", "o_custkey", lens.table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey")))


@query("dq_6_schema", "SELECT * FROM (VALUES ('o_brand', 'missing'), ('o_custkey', 'changed'), ('o_orderpriority', 'extra')) t(\"column\", problem)")
def dq_6(spark, d):
    """DQ-6, DQ-10, META-3, SETS-2: a table's columns against a contract; problems by name."""
    from lakepulse.operators.monitor import schema_diff

    rows = lens.table(spark, d, "orders")
    return schema_diff(rows, CONTRACT | {f.name: f.dataType.simpleString() for f in rows.schema.fields if f.name not in (*CONTRACT, "o_orderpriority")}).select("column", "problem").where("column <> 'o_orderdate'")

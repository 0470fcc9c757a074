"""Queries on formulas and verdicts, activity definitions, look-backs in the wrong day, metric expressions as text."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakepulse.operators import activity as act
from lakepulse.operators import checks, frame, labels
from lakepulse.operators.ranks import quantiles
from lakepulse.sources import lens
from lakepulse.sources.lake import kept
from lakepulse.sources.lens import with_

from . import players as pl
from .registry import query

#: Metric definitions as data: an expression over columns, which rows it is for, and what is impossible or suspicious of its value x.
METRICS = {
    "hold": {"expr": "(stake_c - payout_c) / stake_c", "where": "stake_c > 0", "impossible": "x > 1", "suspicious": "x < -0.4"},
    "mean_stake": {"expr": "stake_c / quantity", "where": "quantity > 0", "impossible": "x < 0", "suspicious": "x > 200000"},
    "payout": {"expr": "payout_c", "where": "line <= 3", "impossible": "x < 0", "suspicious": "x > 9000000"},
}


def _metric_sql(name: str, m: dict) -> str:
    return f"SELECT '{name}' AS metric, count(x) AS n, count(*) FILTER ({m['impossible']}) AS impossible, count(*) FILTER ({m['suspicious']}) AS suspicious, round(min(x), 6) AS low, round(max(x), 6) AS high FROM (SELECT CAST({m['expr']} AS DOUBLE) AS x FROM gaming WHERE {m['where']})"


@query("udf_1_metrics", with_("gaming") + " " + " UNION ALL ".join(_metric_sql(k, m) for k, m in METRICS.items()))
def udf_1(spark, d):
    """UDF-1, FILT-2, PROJ-2: metrics given as text."""
    return checks.metrics(lens.gaming(spark, d), METRICS)


FORMULAS = {
    "trend of the stake": ("wagered_trend_7", "(wagered_c_l7d + 1) / (prior_wagered_c_l7d + 1)", "wagered_trend_7"),
    "trend without the one": ("wagered_trend_7", "wagered_c_l7d / nullif(prior_wagered_c_l7d, 0)", "wagered_trend_7"),
    "trend of days": ("active_days_7_vs_prior7", "(active_days_l7d + 1) / (prior_active_days_l7d + 1)", "active_days_7_vs_prior7"),
    "mean bet of 30 days": ("avg_bet_c_l30d", "wagered_c_l30d / nullif(bets_l30d, 0)", "avg_bet_c_l30d"),
    "mean bet of 90 days": ("avg_bet_c_l30d", "wagered_c_l90d / nullif(bets_l90d, 0)", "avg_bet_c_l30d"),
    "loss is won money": ("net_loss_7d", "ggr_c_l7d", "net_loss_7d"),
    "loss is lost money": ("net_loss_7d", "-ggr_c_l7d", "net_loss_7d"),
    "multiple of the month": ("heavy_loss_multiple", "ggr_c_l7d / nullif(ggr_c_l30d / 30 * 7, 0)", "heavy_loss_multiple"),
    "flag of multiples over 2": ("heavy_loss_flag", "CASE WHEN net_loss_7d > 0 AND heavy_loss_multiple > 2 THEN 1 ELSE 0 END", "heavy_loss_flag"),
    "share of bonus": ("bonus_stake_share_30d", "bonus_c_l30d / nullif(wagered_c_l30d, 0)", "bonus_stake_share_30d"),
    "tenure covers recency": ("greatest(days_since_first_bet, least(days_since_last_bet, 150))", "days_since_first_bet", "days_since_first_bet"),
    "half of the days": ("prior_active_days_l30d", "active_days_l30d", "prior_active_days_l30d"),
    "nothing to compare": ("nullif(bets_l7d, bets_l7d)", "bets_l7d", "bets_l7d"),
}
#: Columns that a column is made of, if these are columns of the table.
NEEDS = (("heavy_loss_flag", "heavy_loss_multiple"), ("heavy_loss_flag", "net_loss_7d"), ("wagered_trend_7", "net_loss_7d"), ("active_days_7_vs_prior7", "prior_active_days_l7d"))
ATOL, RTOL = 1e-6, 1e-3


def _formula_sql(name: str, f: tuple[str, str, str]) -> str:
    return f"SELECT '{name}' AS \"check\", '{f[2]}' AS \"group\", count(*) FILTER (t IS NOT NULL AND e IS NOT NULL) AS n, count(*) FILTER (abs(t - e) <= {ATOL}::DOUBLE + {RTOL}::DOUBLE * abs(e)) AS ok FROM (SELECT CAST({f[0]} AS DOUBLE) AS t, CAST({f[1]} AS DOUBLE) AS e FROM features)"


VERDICTS = f"""r AS ({" UNION ALL ".join(_formula_sql(k, f) for k, f in FORMULAS.items())}), v AS (SELECT *, CASE WHEN n = 0 THEN 'no data' WHEN ok / n >= 0.99 THEN 'passes' WHEN ok / n >= 0.95 THEN 'almost' ELSE 'fails' END AS verdict FROM r),
g AS (SELECT *, CASE WHEN verdict = 'fails' OR verdict = 'almost' AND bool_or(verdict = 'passes') OVER (PARTITION BY "group") THEN 'rejected' WHEN verdict = 'no data' THEN 'unchecked' ELSE 'kept' END AS decision FROM v)"""


@query("chk_7_groups", with_("activity") + f", {pl.CUT}, {pl.FEATURES}, {VERDICTS} SELECT * FROM g")
def chk_7(spark, d):
    """CHK-1, CHK-2, CHK-6, CHK-7, UDF-2: formulas of stored features, given as text: verdicts, and what is rejected in each group of hypotheses."""
    return checks.verdicts(pl.feat(spark, d), FORMULAS, ATOL, RTOL)


@query("chk_8_column_status", with_("activity") + f""", {pl.CUT}, {pl.FEATURES}, {VERDICTS}, c AS (SELECT "group" AS "column", count(*) FILTER (decision = 'rejected') AS rejected, count(*) FILTER (decision = 'kept') AS kept FROM g GROUP BY ALL),
n_ AS (SELECT * FROM (VALUES {", ".join(map(str, NEEDS))}) t("column", needs))
SELECT c."column", CASE WHEN rejected > 0 AND kept = 0 THEN 'wrong' WHEN bool_or(coalesce(w, false)) THEN 'affected' WHEN rejected > 0 THEN 'unconfirmed' WHEN kept > 0 THEN 'correct' ELSE 'unchecked' END AS status
FROM c LEFT JOIN n_ ON n_."column" = c."column" LEFT JOIN (SELECT "column" AS needs, rejected > kept AS w FROM c) x USING (needs) GROUP BY c."column", rejected, kept""")
def chk_8(spark, d):
    """CHK-8: wrong, affected by an input that is wrong, unconfirmed, correct or unchecked."""
    per = chk_7(spark, d).groupBy(F.col("group").alias("column")).agg(F.count_if(F.col("decision") == "rejected").alias("rejected"), F.count_if(F.col("decision") == "kept").alias("kept"))
    return checks.column_status(per, spark.createDataFrame(list(NEEDS), "column string, needs string"))


#: Rules on facts of two tables, g and s, by name; text that both engines read.
POINTS = {
    "rows": "n_g < n_s", "totals": "abs(sum_g - sum_s) > 0.001 * sum_s", "no_rows": "n_g = 0 OR n_s = 0", "players_lost": "players_g < 0.99 * players_s", "first_day": "first_g > first_s", "last_day": "last_g < last_s",
    "days_missing": "days_g < 0.95 * days_s", "negative": "low_g < 0 OR low_s < 0", "orders_lost": "orders_g < orders_s",
}
FACTS = {"n": "count(*)", "sum": "sum(stake_c)", "players": "count(DISTINCT player_id)", "orders": "count(DISTINCT order_id)", "first": "min(day)", "last": "max(day)", "days": "count(DISTINCT day)", "low": "min(stake_c)"}


def _facts(table: str, side: str) -> str:
    return f"SELECT {', '.join(f'{e} AS {k}_{side}' for k, e in FACTS.items())} FROM {table}"


@query("chk_10_verdict_points", with_("gaming", "stakes") + f", f AS (SELECT * FROM ({_facts('gaming', 'g')}), ({_facts('stakes', 's')})) " + " UNION ALL ".join(f"SELECT '{k}' AS point, {e} AS fails FROM f" for k, e in POINTS.items()))
def chk_10(spark, d):
    """CHK-10, UDF-4: rules on named facts of two sources, each one row."""
    side = lambda rows, s: rows.agg(*[F.expr(e).alias(f"{k}_{s}") for k, e in FACTS.items()])
    facts = side(lens.gaming(spark, d), "g").join(F.broadcast(side(lens.stakes(spark, d), "s")))
    return checks.points(facts, POINTS)


@query("chk_11_plausible", with_("activity") + f", {pl.CUT}, {pl.FEATURES} SELECT cutoff, count(*) AS n, round(avg(CAST(bets_l30d >= active_days_l30d AS INT)), 6) AS bets_cover_days, round(avg(CAST(active_days_l7d BETWEEN 0 AND 7 AS INT)), 6) AS days_in_range, round(avg(CAST(days_since_first_bet >= days_since_last_bet AS INT)), 6) AS tenure_covers_recency, round(avg(CAST(wagered_c_l90d >= wagered_c_l30d AS INT)), 6) AS windows_grow FROM features GROUP BY cutoff")
def chk_11(spark, d):
    """CHK-11: the share of a snapshot's rows for which each rule holds."""
    rules = {"bets_cover_days": "bets_l30d >= active_days_l30d", "days_in_range": "active_days_l7d BETWEEN 0 AND 7", "tenure_covers_recency": "days_since_first_bet >= days_since_last_bet", "windows_grow": "wagered_c_l90d >= wagered_c_l30d"}
    return pl.feat(spark, d).groupBy("cutoff").agg(F.count("*").alias("n"), *[F.round(F.avg(F.expr(e).cast("int")), 6).alias(k) for k, e in rules.items()])


@query("chk_5_bands", with_("activity") + f", {pl.CUT}, {pl.FEATURES}, s AS (SELECT least(100, days_since_last_bet / 1.8::DOUBLE) AS score FROM features WHERE days_since_last_bet IS NOT NULL), b AS (SELECT score, CASE WHEN score < 25 THEN 'low' WHEN score < 50 THEN 'medium' WHEN score < 75 THEN 'high' ELSE 'critical' END AS band FROM s) SELECT band, CAST(floor(score / 25) AS INT) AS bucket, count(*) AS n, round(min(score), 6) AS low, round(max(score), 6) AS high FROM b GROUP BY ALL")
def chk_5(spark, d):
    """CHK-5: limits of the score in each band and bucket of cutoffs."""
    from lakepulse.operators import signals

    score = F.least(F.lit(100.0), F.col("days_since_last_bet") / F.lit(1.8))
    rows = pl.feat(spark, d).where("days_since_last_bet is not null").select(score.alias("score")).withColumn("band", signals.band(F.col("score")))
    return rows.groupBy("band", F.floor(F.col("score") / 25).cast("int").alias("bucket")).agg(F.count("*").alias("n"), F.round(F.min("score"), 6).alias("low"), F.round(F.max("score"), 6).alias("high"))


@query("act_2_definitions", with_("stakes", "activity") + f""", {pl.CUT}, {pl.FEATURES}, dd AS (SELECT player_id, day, bool_or(real) AS official FROM stakes GROUP BY ALL),
r AS (SELECT cutoff, player_id, count(*) FILTER (official AND cutoff - day < 30) AS o30, count(*) FILTER (cutoff - day < 30) AS a30, count(*) FILTER (official) AS o90, count(*) AS a90 FROM cut JOIN dd ON day > cutoff - 90 AND day <= cutoff GROUP BY ALL),
j AS (SELECT cutoff, active_days_l30d, active_days_l90d, coalesce(o30, 0) AS o30, coalesce(a30, 0) AS a30, coalesce(o90, 0) AS o90, coalesce(a90, 0) AS a90 FROM features LEFT JOIN r USING (cutoff, player_id)),
s AS (SELECT cutoff, 'active_days_l30d' AS "column", 'official' AS definition, avg(CAST(active_days_l30d = o30 AS INT)) AS m FROM j GROUP BY cutoff UNION ALL SELECT cutoff, 'active_days_l30d', 'any', avg(CAST(active_days_l30d = a30 AS INT)) FROM j GROUP BY cutoff
UNION ALL SELECT cutoff, 'active_days_l90d', 'official', avg(CAST(active_days_l90d = o90 AS INT)) FROM j GROUP BY cutoff UNION ALL SELECT cutoff, 'active_days_l90d', 'any', avg(CAST(active_days_l90d = a90 AS INT)) FROM j GROUP BY cutoff)
SELECT "column", definition, count(*) AS snapshots, round(min(m), 6) AS worst, round(median(m), 6) AS median FROM s GROUP BY ALL""")
def act_2(spark, d):
    """ACT-2: stored active days recounted under two definitions: match share per snapshot, its worst and median."""
    days = lens.stakes(spark, d).groupBy("player_id", "day").agg(F.bool_or("real").alias("official"))
    rows = labels._windowed(days, pl.cut(spark, d), 90)
    near, o = F.datediff("cutoff", "day") < 30, F.col("official")
    again = rows.groupBy("cutoff", "player_id").agg(F.count_if(o & near).alias("o30"), F.count_if(near).alias("a30"), F.count_if(o).alias("o90"), F.count("*").alias("a90"))
    both = pl.feat(spark, d).select("cutoff", "player_id", "active_days_l30d", "active_days_l90d").join(again, ["cutoff", "player_id"], "left").na.fill(0, ["o30", "a30", "o90", "a90"])
    pairs = [(c, name, x) for c, n in (("active_days_l30d", "30"), ("active_days_l90d", "90")) for name, x in (("official", f"o{n}"), ("any", f"a{n}"))]
    shares = both.groupBy("cutoff").agg(*[F.avg((F.col(c) == F.col(x)).cast("int")).alias(x) for c, _, x in pairs])
    long = shares.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(name).alias("definition"), F.col(x).alias("m")) for c, name, x in pairs])).alias("p")).select("p.*")
    return long.groupBy("column", "definition").agg(F.count("*").alias("snapshots"), F.round(F.min("m"), 6).alias("worst"), F.round(F.median("m"), 6).alias("median"))


@query("leak_1_recompute", with_("activity") + f""", {pl.CUT}, {pl.FEATURES}, o AS (SELECT cutoff, player_id, count(*) FILTER (day <= cutoff AND day > cutoff - 30) AS own, count(*) FILTER (day > cutoff - 23) AS later FROM cut JOIN activity ON active AND day > cutoff - 30 AND day <= cutoff + 7 GROUP BY ALL),
j AS (SELECT cutoff, active_days_l30d AS v, coalesce(own, 0) AS own, coalesce(later, 0) AS later FROM features LEFT JOIN o USING (cutoff, player_id))
SELECT cutoff, count(*) AS n, round(avg(CAST(v = own AS INT)), 6) AS own_match, round(avg(CAST(v = later AS INT)), 6) AS later_match, count(*) FILTER (v > own) AS higher, count(*) FILTER (v < own) AS lower, avg(CAST(v = later AS INT)) > avg(CAST(v = own AS INT)) + 0.05::DOUBLE AS leaks FROM j GROUP BY cutoff""")
def leak_1(spark, d):
    """LEAK-1: a stored look-back against the same as of its day, and as of seven days later."""
    rows = labels._windowed(lens.activity(spark, d).where("active"), pl.cut(spark, d), 30, 7)
    age = F.datediff("cutoff", "day")
    again = rows.groupBy("cutoff", "player_id").agg(F.count_if((age >= 0) & (age < 30)).alias("own"), F.count_if(age < 23).alias("later"))
    both = pl.feat(spark, d).select("cutoff", "player_id", F.col("active_days_l30d").alias("v")).join(again, ["cutoff", "player_id"], "left").na.fill(0, ["own", "later"])
    v, own, later = F.col("v"), F.avg((F.col("v") == F.col("own")).cast("int")), F.avg((F.col("v") == F.col("later")).cast("int"))
    return both.groupBy("cutoff").agg(F.count("*").alias("n"), F.round(own, 6).alias("own_match"), F.round(later, 6).alias("later_match"), F.count_if(v > F.col("own")).alias("higher"), F.count_if(v < F.col("own")).alias("lower"), (later > own + 0.05).alias("leaks"))


#: Columns of short and long look-backs whose daily profile is drawn, by their days.
PROFILED = {"bets_l7d": 7, "wagered_c_l7d": 7, "bets_l30d": 30, "active_days_l90d": 90}
PROFILE = f"""p_ AS (SELECT DISTINCT cutoff, player_id FROM cut JOIN a ON day > cutoff - 30 AND day <= cutoff WHERE cutoff + 14 <= {pl.END_DAY}), l_ AS ({" UNION ALL ".join(f"SELECT cutoff, player_id, '{c}' AS \"column\", {c} AS x FROM features" for c in PROFILED)}), q_ AS (SELECT l_.* FROM l_ SEMI JOIN p_ USING (cutoff, player_id)),
r_ AS (SELECT *, rank() OVER (PARTITION BY cutoff, "column" ORDER BY x) + (count(*) OVER (PARTITION BY cutoff, "column", x) - 1) / 2.0::DOUBLE AS r FROM q_), t_ AS (SELECT cutoff, "column", count(*) AS n, sum(r) AS sr, sum(r * r) AS srr, count(DISTINCT x) AS k FROM r_ GROUP BY ALL),
o_ AS (SELECT DISTINCT cutoff, player_id, CAST(day - cutoff AS INT) AS k FROM cut JOIN a ON day >= cutoff - 29 AND day <= cutoff + 14), y_ AS (SELECT cutoff, "column", o_.k, count(*) AS m, sum(r) AS rm FROM r_ JOIN o_ USING (cutoff, player_id) GROUP BY ALL),
profile AS (SELECT cutoff, "column", y_.k AS "offset", m AS active, CASE WHEN m < n AND n * srr > sr * sr THEN (n * rm - sr * m) / sqrt((n * srr - sr * sr) * (CAST(n AS DOUBLE) * m - CAST(m AS DOUBLE) * m)) END AS correlation FROM y_ JOIN t_ USING (cutoff, "column") WHERE t_.k > 1)"""


def profile_rows(spark, d):
    """(cutoff, player_id, columns), and (cutoff, player_id, offset) of their active days from 29 before to 14 after, of the cutoffs that have 14 days after them."""
    days, cuts = lens.activity(spark, d).where("active"), pl.cut(spark, d)
    end = days.agg(F.max("day").alias("_end"))
    people = act.population(lens.activity(spark, d), cuts, 30).join(F.broadcast(end)).where(F.date_add("cutoff", 14) <= F.col("_end"))
    rows = pl.feat(spark, d).select("cutoff", "player_id", *PROFILED).join(people.select("cutoff", "player_id"), ["cutoff", "player_id"], "left_semi")
    on = labels._windowed(days, cuts, 30, 14).select("cutoff", "player_id", F.datediff("day", "cutoff").alias("offset")).distinct()
    return rows, on


RECHECKED = ["days_since_last_bet", "avg_bet_c_l30d", *frame.RECOMPUTED]
#: One column of the stored table is as of seven days later from the middle of the cutoffs on, another is always one too high, as a test of the checks.
AHEAD, HIGH = "ggr_c_l7d", "prior_bets_l30d"


def _again(name: str, k: int) -> str:
    age = f"(cutoff + {k} - day)"
    of = {"active": "CAST(active AS INT)", "bets": "bets", "turnover_c": "turnover_c", "ggr_c": "ggr_c"}
    sums = ", ".join(f"CAST(coalesce(sum({of[x]}) FILTER ({age} >= {a} AND {age} < {b}), 0) AS DOUBLE) AS {c}" for c, (x, a, b) in frame.RECOMPUTED.items())
    return f"{name} AS (SELECT pp.cutoff, pp.player_id, CAST(min({age}) FILTER (active) AS DOUBLE) AS days_since_last_bet, sum(turnover_c) FILTER ({age} < 30) / nullif(sum(bets) FILTER ({age} < 30), 0) AS avg_bet_c_l30d, {sums} FROM pp JOIN activity USING (player_id) WHERE day <= cutoff + {k} GROUP BY ALL)"


RECHECK = f"""pp AS (SELECT DISTINCT cutoff, player_id FROM cut JOIN a ON day > cutoff - 30 AND day <= cutoff), {pl.MIDDLE}, {_again("own_", 0)}, {_again("later_", 7)},
stored_ AS (SELECT own_.* REPLACE (CASE WHEN own_.cutoff >= m THEN later_.{AHEAD} ELSE own_.{AHEAD} END AS {AHEAD}, own_.{HIGH} + 1 AS {HIGH}) FROM own_ JOIN later_ USING (cutoff, player_id), mid),
x_ AS ({" UNION ALL ".join(f"SELECT o.cutoff, '{c}' AS \"column\", s.{c} AS t, coalesce(o.{c}, 0) AS m, CASE WHEN o.cutoff + 7 <= {pl.END_DAY} THEN coalesce(l.{c}, 0) END AS a FROM stored_ s JOIN own_ o USING (cutoff, player_id) JOIN later_ l USING (cutoff, player_id)" for c in RECHECKED)}),
per_ AS (SELECT cutoff, "column", count(*) AS players, avg(CAST(t = 0 AS INT)) FILTER (t IS NOT NULL) AS table_zero, avg(CAST(abs(t - m) <= 0.5 + 0.02 * abs(m) AS INT)) FILTER (t IS NOT NULL) AS "match", avg(CAST(t > m AND abs(t - m) > 0.5 + 0.02 * abs(m) AS INT)) FILTER (t IS NOT NULL) AS table_higher,
 avg(CAST(t < m AND abs(t - m) > 0.5 + 0.02 * abs(m) AS INT)) FILTER (t IS NOT NULL) AS table_lower, avg(CAST(abs(t - a) <= 0.5 + 0.02 * abs(a) AS INT)) FILTER (t IS NOT NULL) AS match_ahead FROM x_ GROUP BY ALL)"""


def rechecked(spark, d):
    days, cuts = kept(lens.activity(spark, d)), pl.cut(spark, d)
    asked = act.population(days, cuts, 30)
    own, later = (kept(frame.recomputed(days, asked, k)) for k in (0, 7))
    mid, end = pl.middle(cuts), days.agg(F.max("day").alias("_end"))
    ahead = later.select("cutoff", "player_id", F.col(AHEAD).alias("_ahead"))
    stored = own.join(ahead, ["cutoff", "player_id"]).join(F.broadcast(mid)).withColumn(AHEAD, F.when(F.col("cutoff") >= F.col("middle"), F.col("_ahead")).otherwise(F.col(AHEAD))).withColumn(HIGH, F.col(HIGH) + 1)
    known = later.join(F.broadcast(end)).where(F.date_add("cutoff", 7) <= F.col("_end"))
    return checks.recomputation(stored, own, known, RECHECKED)


@query("leak_1_columns", with_("activity") + f", {pl.CUT}, {pl.ACTIVE}, {RECHECK} SELECT cutoff, \"column\", players, round(table_zero, 6) AS table_zero, round(\"match\", 6) AS \"match\", round(table_higher, 6) AS table_higher, round(table_lower, 6) AS table_lower, round(match_ahead, 6) AS match_ahead FROM per_")
def leak_1_columns(spark, d):
    """LEAK-1: each stored look-back against the same computed again as of its day and of seven days later, per snapshot."""
    found = rechecked(spark, d)
    return found.select("cutoff", "column", "players", *[F.round(c, 6).alias(c) for c in ("table_zero", "match", "table_higher", "table_lower", "match_ahead")])


@query("leak_1_verdicts", with_("activity") + f""", {pl.CUT}, {pl.ACTIVE}, {RECHECK}, st_ AS (SELECT *, "match" >= 0.95::DOUBLE AS ok, coalesce(match_ahead > "match" + 0.05::DOUBLE, false) AS leaks FROM per_), sv_ AS (SELECT *, coalesce(last_value(CASE WHEN ok THEN 'OK' WHEN leaks THEN 'leak' WHEN match_ahead IS NOT NULL THEN 'mismatch' END IGNORE NULLS) OVER (PARTITION BY "column" ORDER BY cutoff), 'mismatch') AS s FROM st_),
sr_ AS (SELECT *, sum(CAST(s IS DISTINCT FROM p AS INT)) OVER (PARTITION BY "column" ORDER BY cutoff) AS run FROM (SELECT *, lag(s) OVER (PARTITION BY "column" ORDER BY cutoff) AS p FROM sv_)), su_ AS (SELECT "column", run, s || ' ' || strftime(min(cutoff), '%Y-%m') || CASE WHEN max(cutoff) > min(cutoff) THEN ' to ' || strftime(max(cutoff), '%Y-%m') ELSE '' END AS t FROM sr_ GROUP BY "column", run, s),
sl_ AS (SELECT "column", string_agg(t, '; ' ORDER BY run) AS status FROM su_ GROUP BY "column")
SELECT "column", count(*) AS days, round(median("match"), 6) AS median_match, round(min("match"), 6) AS worst_match, count(*) FILTER (leaks) AS leak_days, CASE WHEN count(*) FILTER (leaks) > 0 THEN 'LEAK' WHEN count(*) FILTER (ok) = count(*) THEN 'OK' WHEN count(*) FILTER (ok) = 0 THEN 'BROKEN' ELSE 'MOSTLY OK (' || count(*) FILTER (ok) || '/' || count(*) || ')' END AS verdict, any_value(status) AS status FROM st_ JOIN sl_ USING ("column") GROUP BY "column" """)
def leak_1_verdicts(spark, d):
    """LEAK-1: a verdict per column, and from when to when it holds: one column leaks from the middle on, one is broken, the others are right."""
    return checks.leak_verdicts(kept(rechecked(spark, d)))


@query("leak_4_day_profile", with_("activity") + f', {pl.CUT}, {pl.ACTIVE}, {pl.FEATURES}, {PROFILE} SELECT cutoff, "column", "offset", active, round(correlation, 6) AS correlation FROM profile')
def leak_4(spark, d):
    """LEAK-4: per snapshot and column, the rank correlation with activity on each day around the snapshot: it drops where the window ends."""
    rows, on = profile_rows(spark, d)
    return checks.day_profile(rows, on, list(PROFILED)).withColumn("correlation", F.round("correlation", 6))


@query("leak_4_window_ends", with_("activity") + f""", {pl.CUT}, {pl.ACTIVE}, {pl.FEATURES}, {PROFILE}, m_ AS (SELECT "column", "offset", avg(correlation) AS c FROM profile GROUP BY ALL),
d_ AS (SELECT "column", "offset", avg(c) OVER (PARTITION BY "column" ORDER BY "offset" ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) - avg(c) OVER (PARTITION BY "column" ORDER BY "offset" ROWS BETWEEN 1 FOLLOWING AND 7 FOLLOWING) AS fall FROM m_)
SELECT "column", arg_max("offset", fall) AS window_end, round(max(fall), 6) AS fall, arg_max("offset", fall) <= 3 AS holds FROM d_ WHERE "offset" BETWEEN -23 AND 7 GROUP BY "column" """)
def leak_4_ends(spark, d):
    """LEAK-4, LEAK-5: the day after which a column's mean profile falls the most; a window must not end more than three days after the snapshot."""
    rows, on = profile_rows(spark, d)
    return checks.window_ends(checks.day_profile(rows, on, list(PROFILED)))


@query("leak_5_windows", with_("activity") + f""", {pl.CUT}, {pl.FEATURES}, o AS (SELECT cutoff, player_id, count(*) FILTER (day <= cutoff) AS own, count(*) FILTER (day > cutoff - 23) AS later FROM cut JOIN activity ON active AND day > cutoff - 30 AND day <= cutoff + 7 GROUP BY ALL),
j AS (SELECT bets_l30d AS v, coalesce(own, 0) AS own, coalesce(later, 0) AS later FROM features LEFT JOIN o USING (cutoff, player_id)),
r AS (SELECT rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0::DOUBLE AS v, rank() OVER (ORDER BY own) + (count(*) OVER (PARTITION BY own) - 1) / 2.0::DOUBLE AS own, rank() OVER (ORDER BY later) + (count(*) OVER (PARTITION BY later) - 1) / 2.0::DOUBLE AS later FROM j)
SELECT round(corr(v, own), 6) AS own, round(corr(v, later), 6) AS later, corr(v, own) >= corr(v, later) AS holds FROM r""")
def leak_5(spark, d):
    """LEAK-5: the rank correlation with the window's own days is no less than with the days a week later. Ranks come from counts per value."""
    rows = labels._windowed(lens.activity(spark, d).where("active"), pl.cut(spark, d), 30, 7)
    age = F.datediff("cutoff", "day")
    again = rows.groupBy("cutoff", "player_id").agg(F.count_if(age >= 0).alias("own"), F.count_if(age < 23).alias("later"))
    both = pl.feat(spark, d).select("cutoff", "player_id", F.col("bets_l30d").alias("v")).join(again, ["cutoff", "player_id"], "left").na.fill(0, ["own", "later"])
    return checks.rank_correlations(both, "v", ["own", "later"]).withColumn("holds", F.col("own") >= F.col("later")).select(F.round("own", 6).alias("own"), F.round("later", 6).alias("later"), "holds")


@query("leak_3_rule_variants", with_("stakes", "activity") + f""", {pl.CUT}, {pl.FEATURES}, dd AS (SELECT DISTINCT player_id, day, 'official' AS definition FROM stakes WHERE real UNION ALL SELECT DISTINCT player_id, day, 'any' FROM stakes),
g AS (SELECT unnest(generate_series(0, 10)) AS shift), o AS (SELECT definition, shift, cutoff, player_id, CAST(cutoff + CAST(shift AS INT) - max(day) AS INT) AS again FROM cut, g JOIN dd ON day > cutoff - 180 AND day <= cutoff + CAST(shift AS INT) GROUP BY definition, shift, cutoff, player_id)
SELECT definition, CAST(shift AS INT) AS shift, count(*) AS n, round(avg(CAST(days_since_last_bet = again AS INT)), 6) AS match FROM features JOIN o USING (cutoff, player_id) WHERE days_since_last_bet IS NOT NULL AND days_since_last_bet < 180 GROUP BY ALL""")
def leak_3(spark, d):
    """LEAK-3, UDF-3: a recency rule under two definitions of activity and shifts of 0..10 days; the best variant has the greatest match."""
    s = lens.stakes(spark, d).groupBy("player_id", "day").agg(F.bool_or("real").alias("real"))
    rows = labels._windowed(s, pl.cut(spark, d), 180, 10)
    shifts = range(11)
    last = rows.groupBy("cutoff", "player_id").agg(*[F.max(F.when((F.col("day") <= F.date_add("cutoff", k)) & own, F.col("day"))).alias(f"{name}{k}") for name, own in (("official", F.col("real")), ("any", F.lit(True))) for k in shifts])
    f = pl.feat(spark, d).where("days_since_last_bet < 180").select("cutoff", "player_id", F.col("days_since_last_bet").alias("v"))
    variants = F.array(*[F.struct(F.lit(name).alias("definition"), F.lit(k).alias("shift"), F.datediff(F.date_add("cutoff", k), F.col(f"{name}{k}")).alias("again")) for name in ("official", "any") for k in shifts])
    long = f.join(last, ["cutoff", "player_id"]).select("v", F.explode(variants).alias("p")).select("v", "p.*").where("again is not null")
    return long.groupBy("definition", "shift").agg(F.count("*").alias("n"), F.round(F.avg((F.col("v") == F.col("again")).cast("int")), 6).alias("match"))


@query("sig_20_identities", with_("activity", "payments") + """, m AS (SELECT player_id, sum(turnover_c) AS wagered, sum(ggr_c) AS ggr, sum(bonus_c) AS bonus FROM activity GROUP BY player_id), p AS (SELECT player_id, sum(deposit_c) AS dep, sum(withdraw_c) AS wd FROM payments GROUP BY player_id)
SELECT m.player_id, CAST(wagered - ggr AS BIGINT) AS won, CAST(ggr - bonus AS BIGINT) AS real_ggr, CAST(coalesce(dep, 0) - coalesce(wd, 0) AS BIGINT) AS net_cash, round(100.0 * ggr / nullif(wagered, 0), 6) AS hold FROM m LEFT JOIN p USING (player_id)""")
def sig_20(spark, d):
    """SIG-20, SIG-21: accounting identities of money columns."""
    m = lens.activity(spark, d).groupBy("player_id").agg(F.sum("turnover_c").alias("wagered"), F.sum("ggr_c").alias("ggr"), F.sum("bonus_c").alias("bonus"))
    p = lens.payments(spark, d).groupBy("player_id").agg(F.sum("deposit_c").alias("dep"), F.sum("withdraw_c").alias("wd"))
    both = m.join(p, "player_id", "left").na.fill(0, ["dep", "wd"])
    return both.select("player_id", (F.col("wagered") - F.col("ggr")).alias("won"), (F.col("ggr") - F.col("bonus")).alias("real_ggr"), (F.col("dep") - F.col("wd")).alias("net_cash"), F.round(F.try_divide(100.0 * F.col("ggr"), F.col("wagered")), 6).alias("hold"))


@query("anom_5_withdrawal_first", with_("payments") + ", f AS (SELECT player_id, min(day) AS seen, min(day) FILTER (withdrawals > 0) AS w, min(day) FILTER (deposits > 0) AS p FROM payments GROUP BY player_id) SELECT player_id, w AS day FROM f WHERE w IS NOT NULL AND (p IS NULL OR p > w) AND seen > (SELECT min(day) FROM payments)")
def anom_5(spark, d):
    """ANOM-5: first withdrawals before any deposit, of players first seen after the data's first day."""
    p = lens.payments(spark, d)
    first = lambda c: F.min(F.when(F.col(c) > 0, F.col("day")))
    found = p.groupBy("player_id").agg(F.min("day").alias("seen"), first("withdrawals").alias("w"), first("deposits").alias("p"))
    return found.join(F.broadcast(p.agg(F.min("day").alias("start")))).where("w is not null and (p is null or p > w) and seen > start").select("player_id", F.col("w").alias("day"))


@query("anom_8_flags", with_("stakes", "players") + """, q AS (SELECT brand, quantile_cont(stake_c, 0.25) AS a, quantile_cont(stake_c, 0.75) AS b, median(stake_c) AS med FROM stakes JOIN players USING (player_id) GROUP BY brand),
m AS (SELECT brand, median(abs(stake_c - med)) AS mad FROM stakes JOIN players USING (player_id) JOIN q USING (brand) GROUP BY brand),
f AS (SELECT brand, stake_c > b + 1.5::DOUBLE * (b - a) OR stake_c < a - 1.5::DOUBLE * (b - a) AS iqr, mad > 0 AND 0.6745::DOUBLE * abs(stake_c - med) / mad > 3.5 AS robust, stake_c < 0 OR payout_c > 2 * stake_c AS bound_ FROM stakes JOIN players USING (player_id) JOIN q USING (brand) JOIN m USING (brand))
SELECT brand, count(*) AS n, count(*) FILTER (iqr) AS iqr, count(*) FILTER (robust) AS robust, count(*) FILTER (bound_) AS bound, count(*) FILTER (iqr OR robust OR bound_) AS flag_any FROM f GROUP BY brand""")
def anom_8(spark, d):
    """ANOM-6, ANOM-8: rows that any of three rules flags, per brand; quartiles and medians are exact and need no group in one task."""
    rows = lens.stakes(spark, d).join(lens.players(spark, d), "player_id").select("brand", "stake_c", "payout_c")
    q = quantiles(rows, "stake_c", ["brand"], [0.25, 0.5, 0.75])
    rows = rows.join(q, "brand").withColumn("off", F.abs(F.col("stake_c") - F.col("q")[1]))
    mad = quantiles(rows, "off", ["brand"], [0.5]).select("brand", F.col("q")[0].alias("mad"))
    low, high, x = F.col("q")[0], F.col("q")[2], F.col("stake_c")
    flagged = rows.join(mad, "brand").select(
        "brand", ((x > high + 1.5 * (high - low)) | (x < low - 1.5 * (high - low))).alias("iqr"), ((F.col("mad") > 0) & (0.6745 * F.col("off") / F.when(F.col("mad") > 0, F.col("mad")) > 3.5)).alias("robust"), ((x < 0) | (F.col("payout_c") > 2 * x)).alias("bound")
    ).na.fill(False)
    return flagged.groupBy("brand").agg(F.count("*").alias("n"), *[F.count_if(F.col(c)).alias(c) for c in ("iqr", "robust", "bound")], F.count_if(F.col("iqr") | F.col("robust") | F.col("bound")).alias("flag_any"))


@query("win_9_previous_day", with_("activity") + f", {pl.CUT}, r AS (SELECT cutoff, player_id, max(day) AS last, bool_or(day = cutoff) AS on_day, max(day) FILTER (day < cutoff) AS before FROM cut JOIN activity ON active AND day > cutoff - 180 AND day <= cutoff GROUP BY ALL) SELECT cutoff, player_id, CAST(cutoff - before AS INT) AS days_from_previous, on_day FROM r")
def win_9(spark, d):
    """WIN-9: days from the last active day before a day."""
    rows = labels._windowed(lens.activity(spark, d).where("active"), pl.cut(spark, d), 180)
    before = F.max(F.when(F.col("day") < F.col("cutoff"), F.col("day")))
    return rows.groupBy("cutoff", "player_id").agg(F.datediff(F.col("cutoff"), before).alias("days_from_previous"), F.bool_or(F.col("day") == F.col("cutoff")).alias("on_day"))


@query("win_8_streak_ending", "WITH e AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events), g AS (SELECT DISTINCT day AS asked FROM e), r AS (SELECT asked, user_id, asked - day AS back, row_number() OVER (PARTITION BY asked, user_id ORDER BY day DESC) - 1 AS i FROM g JOIN e ON day <= asked AND day > asked - 14) SELECT asked, user_id, count(*) AS streak FROM r WHERE back = i GROUP BY ALL")
def win_8_ending(spark, d):
    """WIN-8: days in a row that end on a day, up to 14. The days a day serves are dealt out."""
    e = lens.table(spark, d, "events").select("user_id", F.to_date("ts").alias("day")).distinct()
    asked = e.select(F.col("day").alias("asked")).distinct()
    rows = e.withColumn("asked", F.explode(F.sequence("day", F.date_add("day", 13), F.expr("interval 1 day")))).join(asked, "asked", "left_semi")
    place = F.row_number().over(Window.partitionBy("asked", "user_id").orderBy(F.desc("day"))) - 1
    return rows.withColumn("i", place).where(F.datediff("asked", "day") == F.col("i")).groupBy("asked", "user_id").agg(F.count("*").alias("streak"))


@query("win_19_fill", with_("activity") + ", m AS (SELECT brand, CAST(date_trunc('month', day) AS DATE) AS month, count(*) AS n, CASE WHEN count(*) < 40 THEN NULL WHEN sum(ggr_c) >= 0 THEN 'gain' ELSE 'loss' END AS status FROM activity GROUP BY ALL) SELECT brand, month, n, last_value(status IGNORE NULLS) OVER (PARTITION BY brand ORDER BY month) AS status FROM m")
def win_19(spark, d):
    """WIN-19: the last status that could be tested holds on; a brand has a row per month."""
    m = lens.activity(spark, d).groupBy("brand", F.trunc("day", "month").alias("month")).agg(F.count("*").alias("n"), F.sum("ggr_c").alias("g"))
    status = F.when(F.col("n") >= 40, F.when(F.col("g") >= 0, "gain").otherwise("loss"))
    w = Window.partitionBy("brand").orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    return m.withColumn("_s", status).select("brand", "month", "n", F.last("_s", ignorenulls=True).over(w).alias("status"))

"""Queries on tables of metrics: by brand and cutoff, replays, label thresholds, distributions by segment."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakepulse.operators import labels
from lakepulse.operators import scorecards as sc
from lakepulse.sources import lens
from lakepulse.sources.lake import kept
from lakepulse.sources.lens import with_

from . import players as pl
from .registry import query

DECILES = "[0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]"


def _metrics_sql(source: str, by: str, key: str = "player_id") -> str:
    """Metrics of (by, key, s, y) as DuckDB expressions, the last one `mt`; each from its definition."""
    return f"""k_ AS (SELECT *, rank() OVER (PARTITION BY {by} ORDER BY s) + (count(*) OVER (PARTITION BY {by}, s) - 1) / 2.0::DOUBLE AS r, row_number() OVER (PARTITION BY {by} ORDER BY s DESC, {key}) AS place, greatest(1, floor(count(*) OVER (PARTITION BY {by}) * 0.1::DOUBLE + 0.5)) AS top FROM {source} WHERE y IS NOT NULL),
q_ AS (SELECT {by}, list_sort(list_distinct(quantile_cont(s, {DECILES}))) AS q FROM k_ GROUP BY ALL), b_ AS (SELECT k_.*, len(list_filter(q[2:len(q) - 1], lambda x: x < s)) AS g FROM k_ JOIN q_ USING ({by})), e_ AS (SELECT {by}, sum(n * abs(a - b)) / sum(n) AS ece FROM (SELECT {by}, g, count(*) AS n, avg(y) AS a, avg(s) AS b FROM b_ GROUP BY ALL) GROUP BY ALL),
m_ AS (SELECT {by}, count(*) AS n, round(avg(y) + 1e-9, 6) AS rate, round(avg(s) + 1e-9, 6) AS mean_score, round((sum(r) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2) / nullif(sum(y) * count(*) FILTER (y = 0), 0), 6) AS auc, round(sum(y) FILTER (place <= top) / count(*) FILTER (place <= top), 6) AS top_precision,
  round(sum(y) FILTER (place <= top) / nullif(sum(y), 0), 6) AS top_recall, round(-avg(CASE WHEN y = 1 THEN ln(greatest(1e-6, least(1 - 1e-6, s))) ELSE ln(1 - greatest(1e-6, least(1 - 1e-6, s))) END), 6) AS log_loss, round(avg((s - y) * (s - y)), 6) AS brier FROM k_ GROUP BY ALL),
mt AS (SELECT m_.*, round(ece + 1e-9, 6) AS ece FROM m_ JOIN e_ USING ({by}))"""


def _rounded(found, *columns):
    # A value halfway between two of six digits is rounded up whatever the order of its sum.
    return found.select(*[F.round(F.col(c) + 1e-9, 6).alias(c) if c in columns else c for c in found.columns])


PARTS = "pt AS (SELECT cutoff, CASE WHEN row_number() OVER (ORDER BY cutoff) <= ceil(count(*) OVER () * 0.7::DOUBLE) THEN 'train' WHEN row_number() OVER (ORDER BY cutoff) <= ceil(count(*) OVER () * 0.85::DOUBLE) THEN 'valid' ELSE 'test' END AS part FROM (SELECT DISTINCT cutoff FROM sc))"


@query("eval_13_by_brand", with_("activity") + f""", {pl.SCORED}, {PARTS}, src AS (SELECT part, brand, player_id * 100000 + (cutoff - DATE '1990-01-01') AS id, p AS s, y FROM sc JOIN pt USING (cutoff)), {_metrics_sql("src", "part, brand", "id")} SELECT * FROM mt""")
def eval_13(spark, d):
    """EVAL-13: all metrics of a probability per split of the cutoffs (the first 70%, then 15%) and brand."""
    from .survival import split_by_time

    parts = [p.withColumn("part", F.lit(name)) for name, p in zip(("train", "valid", "test"), split_by_time(kept(pl.scored(spark, d))))]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    rows = rows.withColumn("id", F.col("player_id") * 100000 + F.datediff("cutoff", F.lit("1990-01-01").cast("date")))
    return _rounded(sc.metrics_by(rows, "p", "y", "id", ["part", "brand"]), "rate", "mean_score", "ece")


#: Scores that are compared: a probability, recency on a scale of 360 days, and the plain opposite of active days.
COMPARED = {"probability": "p", "recency": "least(s / 360.0D, 1.0D)", "inactivity": "1 / (1.0D + ad)"}
LONG = " UNION ALL ".join(f"SELECT cutoff, '{k}' AS comparator, player_id, {e.replace('.0D', '.0::DOUBLE')} AS s, y FROM sc" for k, e in COMPARED.items())


def _compared(spark, d):
    cells = F.explode(F.array(*[F.struct(F.lit(k).alias("comparator"), F.expr(e).alias("s")) for k, e in COMPARED.items()]))
    return kept(pl.scored(spark, d).select("cutoff", "player_id", "y", "s", "p", "ad")).select("cutoff", "player_id", "y", cells.alias("c")).select("cutoff", "player_id", "y", "c.*")


@query("bt_2_by_cutoff", with_("activity") + f", {pl.SCORED}, src AS ({LONG}), {_metrics_sql('src', 'cutoff, comparator')} SELECT * FROM mt")
def bt_2_by_cutoff(spark, d):
    """BT-2: metrics of each comparator on each cutoff."""
    return _rounded(sc.metrics_by(_compared(spark, d), "s", "y", "player_id", ["cutoff", "comparator"]), "rate", "mean_score", "ece")


@query("eval_17_compared", with_("activity") + f""", {pl.SCORED}, src AS ({LONG}), b_ AS (SELECT comparator, s, sum(y) AS pos, count(*) - sum(y) AS neg FROM src WHERE y IS NOT NULL GROUP BY ALL), w_ AS (SELECT comparator, sum(pos) OVER x AS tp, sum(neg) OVER x AS fp, sum(pos) OVER (PARTITION BY comparator) AS p, sum(neg) OVER (PARTITION BY comparator) AS n FROM b_ WINDOW x AS (PARTITION BY comparator ORDER BY s DESC)),
k_ AS (SELECT comparator, y, row_number() OVER (PARTITION BY comparator ORDER BY s DESC, id) AS place, greatest(1, floor(count(*) OVER (PARTITION BY comparator) * 0.1::DOUBLE + 0.5)) AS top FROM (SELECT *, player_id * 100000 + (cutoff - DATE '1990-01-01') AS id FROM src))
SELECT comparator, 'curve' AS point, round(fp / n, 6) AS fpr, round(tp / p, 6) AS tpr FROM w_ UNION ALL SELECT comparator, 'top 10%', round(count(*) FILTER (place <= top AND y = 0) / count(*) FILTER (y = 0), 6), round(sum(y) FILTER (place <= top) / sum(y), 6) FROM k_ GROUP BY comparator""")
def eval_17_compared(spark, d):
    """EVAL-17: points of the ROC curves of a probability and its baselines, and where their top 10% lie."""
    from lakepulse.operators import evaluate as ev

    rows = _compared(spark, d).withColumn("id", F.col("player_id") * 100000 + F.datediff("cutoff", F.lit("1990-01-01").cast("date")))
    curve = ev.roc(rows, "s", "y", ["comparator"]).select("comparator", F.lit("curve").alias("point"), "fpr", "tpr")
    top = ev.top_counts(rows, "s", "y", "id", ["comparator"])
    some = lambda c: F.when(c > 0, c)
    return curve.unionByName(top.select("comparator", F.lit("top 10%").alias("point"), F.round((F.col("k") - F.col("hits")) / some(F.col("n") - F.col("pos")), 6).alias("fpr"), F.round(F.col("hits") / some(F.col("pos")), 6).alias("tpr")))


SUMMED = ["auc", "top_precision", "top_recall", "log_loss", "brier", "ece"]


@query("bt_2_summary", with_("activity") + f""", {pl.SCORED}, src AS ({LONG}), {_metrics_sql('src', 'cutoff, comparator')}, u AS (UNPIVOT (SELECT cutoff, comparator, {', '.join(SUMMED)} FROM mt) ON {', '.join(SUMMED)} INTO NAME metric VALUE x)
SELECT comparator, metric, round(avg(x), 6) AS mean, round(median(x), 6) AS median, min(x) AS least, max(x) AS most, true AS inside FROM u GROUP BY ALL""")
def bt_2_summary(spark, d):
    """BT-2, EVAL-11: mean, median, least and greatest value of each metric over the cutoffs; inside: the interval of 2,000 block resamples
    holds the mean."""
    long = bt_2_by_cutoff(spark, d).unpivot(["cutoff", "comparator"], SUMMED, "metric", "x")
    found = sc.block_intervals(long, ["comparator", "metric"], "cutoff", "x")
    return found.select("comparator", "metric", F.round("mean", 6).alias("mean"), F.round("median", 6).alias("median"), "least", "most", ((F.col("low") <= F.col("mean")) & (F.col("mean") <= F.col("high"))).alias("inside"))


@query("bt_2_intervals")
def bt_2_intervals(spark, d):
    """BT-2, EVAL-11: the 95% interval of each comparator's mean metric over the cutoffs, by 2,000 resamples of blocks of three."""
    long = bt_2_by_cutoff(spark, d).unpivot(["cutoff", "comparator"], SUMMED, "metric", "x")
    found = sc.block_intervals(long, ["comparator", "metric"], "cutoff", "x")
    return found.select("comparator", "metric", *[F.round(c, 6).alias(c) for c in ("mean", "low", "high")])


@query("bt_3_replay", with_("activity") + f""", {pl.SCORED}, q AS (SELECT *, greatest(v, 0) / 90.0::DOUBLE * 30 AS w FROM sc), r AS (SELECT cutoff, 'recency' AS ranking, y, y * w AS yv, row_number() OVER (PARTITION BY cutoff ORDER BY s DESC, player_id) AS r FROM q UNION ALL SELECT cutoff, 'value_at_risk', y, y * w, row_number() OVER (PARTITION BY cutoff ORDER BY p * w DESC, player_id) FROM q
  UNION ALL SELECT cutoff, 'probability', y, y * w, row_number() OVER (PARTITION BY cutoff ORDER BY p DESC, player_id) FROM q), t AS (SELECT cutoff, count(*) AS n, sum(y) AS y, sum(y * w) AS v, least(100, count(*)) AS k FROM q GROUP BY cutoff),
fo AS (SELECT cutoff, ranking, count(*) AS contacts, sum(y) AS fy, sum(yv) AS fv FROM r WHERE r <= 100 GROUP BY ALL UNION ALL SELECT cutoff, 'random', k, y * k / n, v * k / n FROM t)
SELECT cutoff, ranking, contacts, round(fy / nullif(y, 0), 6) AS churn_captured, round(fv / nullif(v, 0), 6) AS value_captured, round(fv / contacts * 1000, 2) AS value_per_1000 FROM fo JOIN t USING (cutoff)""")
def bt_3(spark, d):
    """BT-3, TOPK-3: the 100 first contacts of each cutoff by three rankings, and what a random choice can expect."""
    rows = pl.scored(spark, d).withColumn("w", F.greatest(F.col("v"), F.lit(0)) / F.lit(90.0) * 30).withColumn("at_risk", F.col("p") * F.col("w"))
    found = sc.replay(rows, {"recency": "s", "value_at_risk": "at_risk", "probability": "p"}, "player_id", "y", "w", 100, ["cutoff"])
    return found.select("cutoff", "ranking", "contacts", F.round("churn_captured", 6).alias("churn_captured"), F.round("value_captured", 6).alias("value_captured"), F.round("value_per_1000", 2).alias("value_per_1000"))


def both_labels(spark, d):
    """Scored rows with the labels of 60 and of 90 silent days, where both are known."""
    ninety = labels.churn_labels(lens.activity(spark, d), pl.cut(spark, d), None, 90, 180).select("cutoff", "player_id", F.col("event_90d").alias("y90")).where("y90 is not null")
    return kept(pl.scored(spark, d).withColumnRenamed("y", "y60").withColumn("i", -F.col("ad")).join(ninety, ["cutoff", "player_id"]))


BOTH = f"{pl.SCORED}, nx_ AS (SELECT cutoff, pop.player_id, min(day) AS nx FROM pop LEFT JOIN (SELECT DISTINCT player_id, day FROM a) x ON x.player_id = pop.player_id AND day > cutoff GROUP BY ALL), bo AS (SELECT sc.*, sc.y AS y60, CAST(nx IS NULL OR nx > cutoff + 90 AS INT) AS y90, -ad AS i FROM sc JOIN nx_ USING (cutoff, player_id) WHERE cutoff + 90 <= {pl.END_DAY})"
MATRIX = " UNION ALL ".join(f"SELECT cutoff, '{y}' AS label, '{s}' AS score, player_id, {s}::DOUBLE AS s, {y} AS y FROM bo" for y in ("y60", "y90") for s in ("s", "i", "p"))


@query("rpt_3_matrix", with_("activity") + f", {BOTH.replace('sc.*,', 'sc.* EXCLUDE (y),')}, src AS ({MATRIX}), {_metrics_sql('src', 'cutoff, label, score')} SELECT cutoff, label, score, n, rate, auc, top_precision FROM mt")
def rpt_3_matrix(spark, d):
    """RPT-3: each score against the labels of 60 and of 90 silent days: AUC and precision of the top decile, per cutoff."""
    found = sc.label_matrix(both_labels(spark, d), ["y60", "y90"], ["s", "i", "p"], "player_id", ["cutoff"])
    return _rounded(found, "rate")


@query("rpt_3_overlap", with_("activity") + f""", {BOTH.replace('sc.*,', 'sc.* EXCLUDE (y),')}, o AS (SELECT *, row_number() OVER (PARTITION BY cutoff ORDER BY s DESC, player_id) AS a, row_number() OVER (PARTITION BY cutoff ORDER BY i DESC, player_id) AS b, greatest(1, floor(count(*) OVER (PARTITION BY cutoff) * 0.1::DOUBLE + 0.5)) AS top,
  rank() OVER (PARTITION BY cutoff ORDER BY s) + (count(*) OVER (PARTITION BY cutoff, s) - 1) / 2.0::DOUBLE AS ra, rank() OVER (PARTITION BY cutoff ORDER BY i) + (count(*) OVER (PARTITION BY cutoff, i) - 1) / 2.0::DOUBLE AS rb FROM bo)
SELECT cutoff, count(*) AS n, round(corr(ra, rb) + 1e-9, 6) AS spearman, round(count(*) FILTER (a <= top AND b <= top) / max(top) + 1e-9, 6) AS top_overlap, round(1 - avg(y90) FILTER (y60 = 1), 6) AS back_61_90 FROM o GROUP BY cutoff""")
def rpt_3_overlap(spark, d):
    """RPT-3: how far two scores agree on whom to pick, and the share of those churned by 60 days who are back before 90."""
    rows = both_labels(spark, d)
    back = rows.groupBy("cutoff").agg(F.round(1 - F.avg(F.when(F.col("y60") == 1, F.col("y90"))), 6).alias("back_61_90"))
    return _rounded(sc.overlaps(rows, "s", "i", "player_id", ["cutoff"]), "spearman", "top_overlap").join(back, "cutoff")


METRICS = {
    "stake": {"expr": "stake_c / 100.0D", "scale": "log", "width": 0.1, "range": (1, 450_000)},
    "hold": {"expr": "CASE WHEN stake_c > 0 THEN (stake_c - payout_c) / CAST(stake_c AS DOUBLE) END", "scale": "linear", "width": 0.05, "range": (-1, 1)},
    "quantity": {"expr": "quantity", "scale": "int", "width": 1, "range": (1, 45)},
    "payout_ratio": {"expr": "CASE WHEN line > 1 THEN payout_c / CAST(stake_c AS DOUBLE) END", "scale": "linear", "width": 0.02, "range": (0, 0.98)},
}
METRICS_SQL = " UNION ALL ".join(f"SELECT provider % 3 AS p, '{k}' AS metric, CAST({m['expr'].replace('100.0D', '100.0::DOUBLE')} AS DOUBLE) AS x, {m['range'][0]}::DOUBLE AS lo, {m['range'][1]}::DOUBLE AS hi FROM gaming" for k, m in METRICS.items())
SEGMENTED = f"l0 AS ({METRICS_SQL}), lg AS (SELECT 'all' AS segment, metric, x, lo, hi FROM l0 UNION ALL SELECT CAST(p AS VARCHAR), metric, x, lo, hi FROM l0)"


def segmented(spark, d):
    rows = kept(lens.gaming(spark, d).select("stake_c", "payout_c", "quantity", "line", (F.col("provider") % 3).alias("segment")))
    return sc.histograms(rows, METRICS, "segment")


@query("shape_4_scorecard", with_("gaming") + f""", {SEGMENTED} SELECT metric, segment, count(*) AS n_rows, round(count(*) FILTER (x IS NULL) / count(*) + 1e-9, 6) AS null_share, round(max(x) + 1e-9, 6) AS most, round(count(*) FILTER (x < lo) / greatest(count(x), 1) + 1e-9, 6) AS below, round(count(*) FILTER (x > hi) / greatest(count(x), 1) + 1e-9, 6) AS above,
round(quantile_cont(x, 0.01) + 1e-9, 6) AS p1, round(quantile_cont(x, 0.5) + 1e-9, 6) AS median, round(quantile_cont(x, 0.99) + 1e-9, 6) AS p99 FROM lg GROUP BY ALL""")
def shape_4(spark, d):
    """SHAPE-4: a line per metric and segment, all metrics and segments at once."""
    return _rounded(sc.scorecard(segmented(spark, d)), "null_share", "most", "below", "above", "p1", "median", "p99")


@query("shape_4_peaks")
def shape_4_peaks(spark, d):
    """SHAPE-4: peaks of each metric's smoothed histogram, by segment."""
    return sc.segment_peaks(segmented(spark, d))


@query("shape_4_point_masses", with_("gaming") + f""", {SEGMENTED}, n_ AS (SELECT metric, segment, x AS value, count(*) AS n FROM lg WHERE x IS NOT NULL GROUP BY ALL), t_ AS (SELECT metric, segment, count(x) AS t FROM lg GROUP BY ALL)
SELECT a.metric, a.segment, a.value, round(a.n / t + 1e-9, 6) AS share, a.n > 3 * (coalesce(b.n, 0) + coalesce(c.n, 0)) / 2 AS mass FROM n_ a JOIN t_ USING (metric, segment) LEFT JOIN n_ b ON b.metric = a.metric AND b.segment = a.segment AND b.value = a.value - 1 LEFT JOIN n_ c ON c.metric = a.metric AND c.segment = a.segment AND c.value = a.value + 1 WHERE a.value IN (0, 1, 2, 3, 4, 5, 10)""")
def shape_4_masses(spark, d):
    """SHAPE-4: single values that many rows have."""
    return _rounded(sc.point_masses(segmented(spark, d)), "share")

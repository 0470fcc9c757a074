"""Queries that write a day-partitioned lake into the shared folder and read it again."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakepulse.sources import lake, lens
from lakepulse.sources.lens import with_

from . import players as pl
from .registry import query


def _events(spark, d, shift: int = 0):
    return lens.table(spark, d, "events").select("event_id", "user_id", "event_type", "value", F.to_date(F.col("ts") + F.expr(f"interval {shift} minutes")).alias("folder"), F.to_date("ts").alias("day"))


def _written(spark, d, name, shift=0):
    """Events in a folder per day, a file each."""
    path = lake.work_folder(spark, name)
    _events(spark, d, shift).repartition("folder").write.partitionBy("folder").parquet(path)
    return path


@query("scan_3_folders", "SELECT CAST(ts + INTERVAL 90 MINUTE AS DATE) AS folder_day, count(*) AS n, count(*) FILTER (CAST(ts AS DATE) <> CAST(ts + INTERVAL 90 MINUTE AS DATE)) AS other_day FROM events GROUP BY ALL")
def scan_3(spark, d):
    """SCAN-3, DQ-5: rows by the day their path names, and those whose own day is another."""
    rows = lake.read_days(spark, _written(spark, d, "scan", 90))
    return rows.groupBy("folder_day").agg(F.count("*").alias("n"), F.count_if(F.col("day") != F.col("folder_day")).alias("other_day"))


@query("meta_1_inventory", "SELECT CAST(ts AS DATE) AS day, CAST(1 AS BIGINT) AS files, count(*) AS n_rows, count(*) AS least_rows, count(*) AS most_rows FROM events GROUP BY ALL")
def meta_1(spark, d):
    """META-1, META-2: files and rows of each day, from the files themselves."""
    return lake.inventory(spark, _written(spark, d, "inventory")).drop("bytes")


PLANTED = "f AS (SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS day, CAST(CAST(ts AS DATE) - (SELECT min(CAST(ts AS DATE)) FROM events) AS INT) AS i FROM events)"


def _planted(spark, d):
    """Events with the number of their day, from 0."""
    rows = _events(spark, d).drop("folder")
    first = rows.agg(F.min("day").alias("_first"))
    return rows.join(F.broadcast(first)).withColumn("i", F.datediff("day", "_first")).drop("_first")


def _write_days(rows, path):
    rows.withColumnRenamed("day", "folder").repartition("folder").write.mode("append").partitionBy("folder").parquet(path)


@query("meta_3_table", f"""WITH {PLANTED}, p AS (SELECT day, i, count(*) AS n FROM f WHERE i NOT IN (4, 11) GROUP BY ALL) SELECT count(*) AS files, CAST(sum(n) AS BIGINT) AS n_rows, 'folder=YYYY-MM-DD' AS layout, 2 AS schemas, 'event_type' AS added, 'value' AS removed,
min(day) AS first_day, max(day) AS last_day, count(*) AS n_days, median(n) AS rows_per_day, min(n) AS least_rows, max(n) AS most_rows, (SELECT string_agg(DISTINCT CAST(day AS VARCHAR), ',' ORDER BY CAST(day AS VARCHAR)) FROM f WHERE i IN (4, 11)) AS missing_days FROM p""")
def meta_3(spark, d):
    """META-1, META-2, META-3: a table on one row, from the listing and the footers of its files; two days are left out, and a column changes
    halfway."""
    path, rows = lake.work_folder(spark, "table"), _planted(spark, d).where("i not in (4, 11)")
    _write_days(rows.where("i < 15").select("event_id", "user_id", "value", "day"), path)
    _write_days(rows.where("i >= 15").select("event_id", "user_id", "event_type", "day"), path)
    found = lake.table_inventory(lake.footers(lake.files_of(spark, path)))
    text = lambda c: F.array_join(F.array_sort(F.col(c).cast("array<string>")), ",")
    return found.select("files", "n_rows", "layout", "schemas", text("added").alias("added"), text("removed").alias("removed"), "first_day", "last_day", "n_days", "rows_per_day", "least_rows", "most_rows", text("missing_days").alias("missing_days"))


@query("cache_4_rebuild", f"""WITH {PLANTED}, q AS (SELECT day, i, count(*) AS n FROM f GROUP BY ALL), p AS (SELECT *, max(i) OVER () AS last FROM q)
SELECT day, n AS n_rows, 3 AS columns, CASE WHEN i = 2 THEN 'missing' WHEN i = 5 THEN 'columns' WHEN i = 9 THEN 'late' WHEN i > last - 7 THEN 'restated' END AS reason FROM p""")
def cache_4_rebuild(spark, d):
    """CACHE-4, CACHE-6, DQ-9: of a cache that lacks a day, and a column of another, and whose source got one day again later, only those days
    and the last seven are built again and swapped in; the result is the whole cache, and why a day was rebuilt."""
    rows = _planted(spark, d)
    source, cache = lake.work_folder(spark, "source"), lake.work_folder(spark, "cache")
    want = ["event_id", "user_id", "value"]
    _write_days(rows, source)
    _write_days(rows.where("i not in (2, 5)").select(*want, "day"), cache)
    _write_days(rows.where("i = 5").select("event_id", "user_id", "day"), cache)
    again = lake.work_folder(spark, "again")
    rows.where("i = 9").withColumnRenamed("day", "folder").write.partitionBy("folder").parquet(again)
    lake.swap_partitions(spark, again, source, 1)
    todo = lake.kept(lake.days_to_rebuild(lake.files_of(spark, source), lake.footers(lake.files_of(spark, cache)), want))
    built = lake.read_days(spark, source).withColumnRenamed("folder_day", "day").join(F.broadcast(todo.select("day")), "day", "left_semi")
    lake.checked_overwrite(built.select(*want, F.col("day").alias("folder")), cache, ("folder",), {"rows": F.count(F.lit(1)), "nameless": F.count_if(F.col("event_id").isNull())}, {"has rows": lambda v: v["rows"] > 0, "all have ids": lambda v: v["nameless"] == 0})
    per = lake.footers(lake.files_of(spark, cache)).groupBy("day").agg(F.sum("n_rows").alias("n_rows"), F.min(F.size("columns")).alias("columns"))
    return per.join(todo, "day", "left").select("day", "n_rows", "columns", "reason")


@query("meta_4_days", """WITH p AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n_rows, count(*) - count(event_id) AS a0, CAST(min(event_id) AS VARCHAR) AS a1, CAST(max(event_id) AS VARCHAR) AS a2, count(*) - count(nullif(event_type, 'error')) AS b0, min(nullif(event_type, 'error')) AS b1, max(nullif(event_type, 'error')) AS b2 FROM events GROUP BY ALL)
SELECT day, n_rows, 'event_id' AS "column", 'bigint' AS type, a0 AS nulls, a1 AS low, a2 AS high FROM p UNION ALL SELECT day, n_rows, 'event_type', 'string', b0, b1, b2 FROM p""")
def meta_4_days(spark, d):
    """META-4: a profile of columns per day."""
    rows = _events(spark, d).withColumn("event_type", F.expr("nullif(event_type, 'error')"))
    return lake.column_profile(rows, "day", ["event_id", "event_type"])


@query("sink_1_overwrite", with_("activity") + f", {pl.SCORED} SELECT cutoff AS run_date, brand, count(*) AS n, round(sum(CASE WHEN brand = 'BUILDING' THEN p / 2 ELSE p END), 4) AS p FROM sc GROUP BY ALL")
def sink_1(spark, d):
    """SINK-1, CACHE-5: scores in a folder per run date and brand; a second run of one brand replaces its partitions and no others."""
    scores = pl.scored(spark, d).select(F.col("cutoff").alias("run_date"), "brand", "player_id", "p").repartition("brand")
    path = lake.work_folder(spark, "scores")
    n = scores.count()
    seen = {"rows": F.count(F.lit(1)), "bad": F.count_if(F.col("p").isNull() | ~F.col("p").between(0, 1))}
    lake.checked_overwrite(scores, path, ("brand", "run_date"), seen, {"all rows": lambda v: v["rows"] == n, "chances": lambda v: v["bad"] == 0})
    lake.checked_overwrite(scores.where("brand = 'BUILDING'").withColumn("p", F.col("p") / 2), path, ("brand", "run_date"), seen, {"some rows": lambda v: v["rows"] > 0, "chances": lambda v: v["bad"] == 0})
    rows = spark.read.parquet(path)
    return rows.groupBy("run_date", "brand").agg(F.count("*").alias("n"), F.round(F.sum("p"), 4).alias("p"))


@query("sink_2_feature_store", with_("activity") + f", {pl.CUT}, {pl.FEATURES} SELECT cutoff, count(*) AS n, CAST(sum(CASE WHEN month(cutoff) % 2 = 0 THEN -bets_l30d ELSE bets_l30d END) AS BIGINT) AS bets FROM features GROUP BY cutoff")
def sink_2(spark, d):
    """SINK-2, SINK-3: rows of the same cutoffs are replaced, the others stay."""
    f = pl.feat(spark, d).select("cutoff", "player_id", "bets_l30d")
    new = f.where("month(cutoff) % 2 = 0").withColumn("bets_l30d", -F.col("bets_l30d"))
    path = lake.work_folder(spark, "store")
    lake.replace_rows(f, new, ["cutoff"]).write.parquet(path)
    return spark.read.parquet(path).groupBy("cutoff").agg(F.count("*").alias("n"), F.sum("bets_l30d").alias("bets"))


@query("sink_4_sessions", f"WITH {pl.SESSIONS} SELECT day, count(*) AS player_days, CAST(sum(sessions) AS BIGINT) AS sessions, CAST(sum(seconds) AS BIGINT) AS seconds FROM (SELECT user_id, day, count(*) AS sessions, sum(seconds) AS seconds FROM x WHERE minutes = 30 GROUP BY ALL) GROUP BY day")
def sink_4(spark, d):
    """SINK-4: player-days of sessions, in a folder per day."""
    path = lake.work_folder(spark, "sessions")
    lake.overwrite_days(pl.sess_days(spark, d).where("minutes = 30").repartition("day"), path)
    return spark.read.parquet(path).groupBy("day").agg(F.count("*").alias("player_days"), F.sum("sessions").alias("sessions"), F.sum("seconds").alias("seconds"))


@query("sink_5_report", with_("activity") + ", a AS (SELECT brand, CAST(date_trunc('month', day) AS DATE) AS month, count(*) AS n FROM activity GROUP BY ALL) SELECT brand, month, n, CASE WHEN n < 20 THEN 'critical' WHEN n < 40 THEN 'warn' ELSE 'ok' END AS severity FROM a")
def sink_5(spark, d):
    """SINK-5, TOPK-4: an alert table as CSV, ordered by severity."""
    from lakepulse.operators.alerts import rank_of

    rows = lens.activity(spark, d).groupBy("brand", F.trunc("day", "month").alias("month")).agg(F.count("*").alias("n"))
    rows = rows.withColumn("severity", F.when(F.col("n") < 20, "critical").when(F.col("n") < 40, "warn").otherwise("ok"))
    path = lake.work_folder(spark, "alerts")
    rows.orderBy(rank_of(), "brand", "month").write.option("header", True).csv(path)
    return spark.read.schema("brand string, month date, n long, severity string").option("header", True).csv(path)

"""Sessions, gaps, time of play, streaks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def numbered(events: DataFrame, who: str, ts: str, timeouts: tuple[int, ...] = (15, 30, 60)) -> DataFrame:
    """WIN-2, WIN-3: each event with its session's number by inactivity, for several timeouts (minutes) at once."""
    order = Window.partitionBy(who).orderBy(ts, "event_id")
    gap = F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.lag(ts).over(order).cast("timestamp"))
    gaps = events.select(who, F.col(ts).alias("_ts"), "event_id", gap.alias("_gap"))
    each = gaps.select("*", F.explode(F.array(*[F.lit(m) for m in timeouts])).alias("minutes"))
    running = Window.partitionBy(who, "minutes").orderBy("_ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    starts = F.col("_gap").isNull() | (F.col("_gap") > F.col("minutes").cast("long") * 60_000_000)
    return each.withColumn("session", F.sum(starts.cast("long")).over(running))


def sessions(events: DataFrame, who: str, ts: str, timeouts: tuple[int, ...] = (15, 30, 60)) -> DataFrame:
    """SESS-1, STRM-1: sessions for several timeouts, dated by their start; midnight doesn't split them.

    Returns (who, minutes, session, day, events, seconds).
    """
    found = numbered(events, who, ts, timeouts)
    seconds = F.floor((F.unix_micros(F.max("_ts").cast("timestamp")) - F.unix_micros(F.min("_ts").cast("timestamp"))) / 1_000_000)
    return found.groupBy(who, "minutes", "session").agg(F.to_date(F.min("_ts")).alias("day"), F.count("*").alias("events"), seconds.cast("long").alias("seconds"))


def session_days(found: DataFrame, who: str) -> DataFrame:
    """Player-day sums of sessions."""
    return found.groupBy(who, "minutes", "day").agg(F.count("*").alias("sessions"), F.count_if(F.col("events") == 1).alias("single"), F.sum("seconds").alias("seconds"), F.max("seconds").alias("longest"))


def time_of_play(events: DataFrame, who: str, ts: str, zone: str, night: tuple[int, int] = (0, 6)) -> DataFrame:
    """AGG-43: events by local hour, share at night and at weekends, entropy of hours over ln 24."""
    local = F.from_utc_timestamp(F.col(ts).cast("timestamp"), zone)
    hours = events.select(who, F.hour(local).alias("hour"), (F.weekday(local) >= 5).cast("int").alias("weekend")).groupBy(who, "hour").agg(F.count("*").alias("n"), F.sum("weekend").alias("weekend"))
    total = F.sum("n").over(Window.partitionBy(who))
    shares = hours.withColumn("share", F.col("n") / total)
    at_night = F.when((F.col("hour") >= night[0]) & (F.col("hour") < night[1]), F.col("n")).otherwise(0)
    return shares.groupBy(who).agg(
        F.sum("n").alias("events"), F.round(F.sum(at_night) / F.sum("n"), 6).alias("night_share"), F.round(F.sum("weekend") / F.sum("n"), 6).alias("weekend_share"), F.round(-F.sum(F.col("share") * F.log("share")) / F.log(F.lit(24.0)), 6).alias("entropy")
    )


def islands(days: DataFrame, who: str) -> DataFrame:
    """WIN-8, WIN-18: runs of consecutive days of a player."""
    order = Window.partitionBy(who).orderBy("day")
    run = F.date_sub("day", F.row_number().over(order))
    return days.select(who, "day").distinct().withColumn("_run", run).groupBy(who, "_run").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count("*").alias("days")).drop("_run")


def losing_streak(days: DataFrame, who: str | list[str], gain: str) -> DataFrame:
    """F32, WIN-7: latest days in a row on which the house gained (gain > 0), newest first."""
    keys = [who] if isinstance(who, str) else who
    newest = Window.partitionBy(*keys).orderBy(F.desc("day")).rowsBetween(Window.unboundedPreceding, 0)
    flagged = days.withColumn("_other", F.sum((F.col(gain) <= 0).cast("int")).over(newest))
    return flagged.groupBy(*keys).agg(F.count_if(F.col("_other") == 0).alias("streak"), F.count("*").alias("days"))


def dense_days(daily: DataFrame, by: list[str], values: list[str]) -> DataFrame:
    """WIN-21, SETS-3: every day from the first to the last of all, for every group; gaps are 0."""
    ends = daily.agg(F.min("day").alias("_a"), F.max("day").alias("_b"))
    groups = daily.select(*by).distinct() if by else daily.sparkSession.range(1)
    every = groups.join(F.broadcast(ends)).select(*by, F.explode(F.sequence("_a", "_b", F.expr("interval 1 day"))).alias("day"))
    return every.join(daily, [*by, "day"], "left").select(*by, "day", *[F.coalesce(c, F.lit(0)).alias(c) for c in values])

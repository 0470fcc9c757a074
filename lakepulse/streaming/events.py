"""Streaming forms of sessions, late data and repeated messages (STRM-1..3, STRM-5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_messages(events: DataFrame, key: str, ts: str = "ts", late: str = "2 hours") -> DataFrame:
    """STRM-3: messages without those whose key came before, as long as it can be late."""
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def session_windows(events: DataFrame, who: str, ts: str = "ts", gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """STRM-1: sessions by inactivity, dated by their start."""
    found = events.withWatermark(ts, late).groupBy(who, F.session_window(ts, gap).alias("w")).agg(F.count("*").alias("events"))
    return found.select(who, F.col("w.start").alias("start"), F.col("w.end").alias("end"), F.to_date("w.start").alias("day"), "events")


def tumbling(events: DataFrame, by: list[str], value: str, ts: str = "ts", width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """STRM-2, STRM-5: counts and sums per window; rows later than `late` are not counted."""
    found = events.withWatermark(ts, late).groupBy(F.window(ts, width).alias("w"), *by).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return found.select(F.col("w.start").alias("start"), *by, "n", "total")

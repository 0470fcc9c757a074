"""Data quality: rules by column names, failed checks, summaries over days, messages, semantic checks, table profiles."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def by_name(rows: DataFrame, wanted: str, signed: str) -> list[str]:
    """FILT-6: numeric columns whose names fit `wanted` and not `signed`."""
    return [f.name for f in rows.schema.fields if isinstance(f.dataType, T.NumericType) and re.search(wanted, f.name) and not re.search(signed, f.name)]


def non_negative(rows: DataFrame, columns: list[str]) -> DataFrame:
    """DQ-4: a row per column with its negative values and observed limits."""
    one = rows.agg(*[f.alias(f"{c}__{k}") for c in columns for k, f in (("problems", F.count_if(F.col(c) < 0)), ("low", F.min(c).cast("double")), ("high", F.max(c).cast("double")))])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), *[F.col(f"{c}__{k}").alias(k) for k in ("problems", "low", "high")]) for c in columns])).alias("r")).select("r.*")


def failed_checks(rows: DataFrame, grain: list[str], ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """DQ-7: range checks with the observed limits; the grain check with the rows that the latest version would leave."""
    none = F.lit(None)
    found = rows.groupBy(*grain).agg(F.count("*").alias("_n")).agg(
        F.lit("grain").alias("rule"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("problems"), none.cast("double").alias("low"), none.cast("double").alias("high"), F.count("*").alias("rows_left")
    )
    for c, (a, b) in ranges.items():
        found = found.unionByName(rows.agg(F.lit(f"range_{c}").alias("rule"), F.count_if(~F.col(c).between(a, b)).alias("problems"), F.min(c).cast("double").alias("low"), F.max(c).cast("double").alias("high"), none.cast("long").alias("rows_left")))
    return found


def status(share: Column, critical: float = 0.001, delay: bool = False) -> Column:
    """REC-8: ok, warn over 0, critical over a thousandth; delays are one level lower."""
    return F.when(share > critical, "warn" if delay else "critical").when(share > 0, "info" if delay else "warn").otherwise("ok")


def summary(daily: DataFrame, by: list[str]) -> DataFrame:
    """REC-9, DQ-8: over days (day, n, problems): days, days with a problem, problems, greatest share, worst status."""
    share = F.col("problems") / F.col("n")
    level = F.max(F.when(status(share) == "critical", 2).when(status(share) == "warn", 1).otherwise(0))
    return daily.groupBy(*by).agg(
        F.count("*").alias("days"), F.count_if(F.col("problems") > 0).alias("days_hit"), F.sum("problems").alias("problems"), F.round(F.max(share), 6).alias("max_share"), F.element_at(F.array(F.lit("ok"), F.lit("warn"), F.lit("critical")), level + 1).alias("worst")
    )


def messages(rows: DataFrame, folder: str, day: str, key: list[str], part: str) -> DataFrame:
    """REC-1: messages, repeats of the business key, empty keys and events of another day, per folder. Keys are counted before folders."""
    per = rows.groupBy(folder, *key).agg(F.count("*").alias("_n"), F.count_if(F.col(day) != F.col(folder)).alias("_other"))
    return per.groupBy(folder).agg(
        F.sum("_n").alias("messages"), F.sum(F.col("_n") - 1).alias("repeated"), F.coalesce(F.sum(F.when(F.col(part).isNull(), F.col("_n"))), F.lit(0)).alias("empty_keys"), F.sum("_other").alias("other_day")
    )


def semantic(rows: DataFrame, by: list[str], stored: str, again: str, relative: float = 0.02, absolute: float = 0.5, least: float = 0.95) -> DataFrame:
    """DQ-12: how many stored values are within 2% or 0.5 of the recomputed ones, and whether enough are."""
    match = F.abs(F.col(stored) - F.col(again)) <= F.greatest(F.lit(absolute), relative * F.abs(F.col(again)))
    share = F.avg(match.cast("int"))
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.round(share, 6).alias("match_share"), F.sum(stored).alias("stored"), F.sum(again).alias("recomputed"), (share >= least).alias("ok"))


def table_profile(rows: DataFrame, day: Column, key: str, money: str, sparse: str, who: str, people: DataFrame) -> DataFrame:
    """DQ-9: one row for a table. Days, keys and people are counted after they are made distinct by partial aggregation."""
    days = rows.select(day.alias("day")).distinct().agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count("*").alias("days"))
    sums = rows.agg(F.count("*").alias("n_rows"), F.count_if(F.col(money) < 0).alias("negatives"), F.round(100.0 * F.count_if(F.col(sparse).isNull()) / F.count("*"), 6).alias("null_percent"))
    keys = rows.select(key).distinct().agg(F.count("*").alias("keys"))
    orphans = rows.select(who).distinct().join(people.distinct(), who, "left_anti").agg(F.count("*").alias("orphans"))
    # One row each: they meet by union.
    one = days.unionByName(sums, True).unionByName(keys, True).unionByName(orphans, True)
    one = one.agg(*[F.max(c).alias(c) for c in one.columns])
    missing = F.datediff("last_day", "first_day") + 1 - F.col("days")
    return one.select("first_day", "last_day", missing.alias("missing_days"), "n_rows", (F.col("n_rows") - F.col("keys")).alias("repeated"), "negatives", "null_percent", "orphans")

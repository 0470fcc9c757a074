"""Player-day caches, populations and active days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def player_days(stakes: DataFrame) -> DataFrame:
    """CACHE-1, LAB-1: sums per player-day; a day is active if any stake is real money or released bonus."""
    total = lambda e: F.sum(e).cast("long")
    found = stakes.groupBy("player_id", "brand", "tenant", "day").agg(F.count("*").alias("bets"), total("stake_c").alias("turnover_c"), total(F.col("stake_c") - F.col("payout_c")).alias("ggr_c"), F.coalesce(total(F.when(~F.col("real"), F.col("stake_c"))), F.lit(0)).alias("bonus_c"), F.bool_or("real").alias("active"))
    return found.where("bets > 0")


def non_zero_days(days: DataFrame, players: DataFrame, columns: list[str]) -> DataFrame:
    """CACHE-2: days of these players with any of the columns not 0."""
    some = F.greatest(*[F.abs(F.col(c)) for c in columns]) > 0
    return days.join(players.select("player_id").distinct(), "player_id", "left_semi").where(some)


def payment_days(events: DataFrame) -> DataFrame:
    """CACHE-3: purchases are deposits, errors failed deposits, clicks withdrawals."""
    value = F.floor(F.col("value") * 100 + 0.5).cast("long")
    of = lambda kind: F.count_if(F.col("event_type") == kind)
    amount = lambda kind: F.coalesce(F.sum(F.when(F.col("event_type") == kind, value)), F.lit(0)).cast("long")
    return events.groupBy(F.col("user_id").alias("player_id"), F.to_date("ts").alias("day")).agg(
        of("purchase").alias("deposits"), of("error").alias("failed"), of("click").alias("withdrawals"), amount("purchase").alias("deposit_c"), amount("click").alias("withdraw_c")
    )


def scan(days: DataFrame, start: str, end: str, columns: list[str], brand: str | None = None, active_only: bool = False) -> DataFrame:
    """SCAN-1: a day range, pruned and projected."""
    found = days.where(F.col("day").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    if brand is not None:
        found = found.where(F.col("brand") == brand)
    return (found.where("active") if active_only else found).select(columns)


def cutoffs(spark, first: str, last: str, months: int = 1) -> DataFrame:
    """Month starts as a frame: cutoffs are rows, not a loop."""
    return spark.sql(f"SELECT explode(sequence(date'{first}', date'{last}', interval {months} month)) AS cutoff")


def cutoffs_of(days: DataFrame, months: int = 1) -> DataFrame:
    """Month starts after the first day of days and up to the last: a row each."""
    ends = days.agg(F.min("day").alias("a"), F.max("day").alias("b"))
    return ends.select(F.explode(F.sequence(F.trunc(F.add_months("a", 1), "month"), F.trunc("b", "month"), F.expr(f"interval {months} month"))).alias("cutoff"))


def population(days: DataFrame, cutoff: DataFrame, look_back: int = 30) -> DataFrame:
    """FILT-1: (cutoff, player_id, brand) with an active day in (c - look_back, c]. A day is dealt to the month starts it can serve, an equi-join on month."""
    return _windowed(days.where("active"), cutoff, look_back).select("cutoff", "player_id", "brand").distinct()


def _windowed(days: DataFrame, cutoff: DataFrame, look_back: int, ahead: int = 0) -> DataFrame:
    """Days within (c - look_back, c + ahead] of each cutoff. Both sides meet on the month of the cutoff."""
    months = F.sequence(F.trunc(F.date_sub("day", ahead), "month"), F.trunc(F.date_add("day", look_back), "month"), F.expr("interval 1 month"))
    dealt = days.withColumn("_month", F.explode(months))
    on = cutoff.withColumn("_month", F.trunc("cutoff", "month"))
    age = F.datediff("cutoff", "day")
    return dealt.join(F.broadcast(on), "_month").where((age < look_back) & (age >= -ahead)).drop("_month")

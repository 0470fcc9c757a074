"""Deposit, withdrawal and session features at weekly cutoffs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keys import interval_join

#: Look-backs as ages in days: from, and up to but not including.
SPANS = {"7": (0, 7), "30": (0, 30), "prior30": (30, 60), "30_120": (30, 120)}


def weekly_cutoffs(days: DataFrame) -> DataFrame:
    """Every seventh day from a week after the first day."""
    ends = days.agg(F.min("day").alias("a"), F.max("day").alias("b"))
    return ends.select(F.explode(F.sequence(F.date_add("a", 7), F.col("b"), F.expr("interval 7 days"))).alias("cutoff"))


def dealt(days: DataFrame, cutoffs: DataFrame, look_back: int) -> DataFrame:
    """days with each weekly cutoff c that they serve, day in (c - look_back, c]: dealt out by number, without a range join."""
    first = cutoffs.agg(F.min("cutoff").alias("_first"), F.max("cutoff").alias("_last"))
    rows = days.join(F.broadcast(first))
    low = F.greatest(F.lit(0), F.ceil(F.datediff("day", "_first") / 7)).cast("int")
    high = F.least(F.floor((F.datediff("day", "_first") + look_back - 1) / 7), F.floor(F.datediff("_last", "_first") / 7)).cast("int")
    rows = rows.where(low <= high).withColumn("_k", F.explode(F.sequence(low, high)))
    return rows.withColumn("cutoff", F.date_add("_first", F.col("_k") * 7)).drop("_first", "_last", "_k")


def deposit_features(days: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """F02, F10, F11, F17, F18, F24, F35..F41, F43 and SIG-08, SIG-11, from payment days of 180 days."""
    age = F.datediff("cutoff", "day")
    paid = F.col("deposits") > 0
    total = lambda e, w: F.coalesce(F.sum(F.when(w, e)), F.lit(0)).cast("long")
    measures = []
    for name, (near, far) in SPANS.items():
        w = (age >= near) & (age < far)
        measures += [F.count_if(paid & w).alias(f"days_{name}"), total(F.col("deposits"), w).alias(f"n_{name}"), total(F.col("deposit_c"), w).alias(f"sum_{name}"), F.avg(F.when(paid & w, F.col("deposit_c") / F.col("deposits"))).alias(f"mean_{name}")]
    found = dealt(days, cutoffs, 180).groupBy("cutoff", "player_id").agg(
        *measures, F.max(F.when(paid, F.col("day"))).alias("last_deposit"), F.max(F.when((F.col("withdrawals") > 0) & (age < 14), F.col("day"))).alias("last_withdrawal"),
        total(F.col("failed"), age < 14).alias("failed_deposits_14d"), total(F.col("withdraw_c"), age < 30).alias("withdraw_30"),
    )
    c = F.col
    over = lambda a, b: F.when(c(b) > 0, c(a) / c(b))
    since = F.datediff("cutoff", "last_deposit")
    within = lambda n: F.coalesce(since < n, F.lit(False)).cast("int").alias(f"deposited_within_{n}d")
    change = (c("n_7") / F.lit(7.0)) / F.when(c("n_30") > 0, c("n_30") / F.lit(30.0)) - 1
    frequency = F.when(c("n_30") == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(100.0), 50 + 50 * F.greatest(F.lit(-1.0), F.least(F.lit(1.0), change)))))
    trend = F.round(over("mean_30", "mean_30_120"), 6)  # means of daily means
    return found.select(
        "cutoff", "player_id", F.least(F.coalesce(since, F.lit(31)), F.lit(31)).alias("days_since_last_deposit"), c("days_7").alias("n_deposit_days_7d"), c("days_30").alias("n_deposit_days_30d"), c("sum_30").alias("deposits_c_l30d"),
        over("withdraw_30", "sum_30").alias("withdrawals_30d_share"), over("sum_30", "sum_prior30").alias("deposits_30_vs_prior30"), within(3), within(7), within(14), frequency.alias("deposit_frequency_score"), "failed_deposits_14d",
        ((c("days_30") + 1) / (c("days_prior30") + 1)).alias("deposit_days_ratio_30_vs_prior30"), trend.alias("deposit_size_trend"),
        F.coalesce(c("last_withdrawal") >= F.coalesce("last_deposit", F.lit("1900-01-01").cast("date")), F.lit(False)).cast("int").alias("withdrawal_no_redeposit"),
        F.when(c("sum_30") > 0, c("sum_7") / (F.when(c("sum_30") > 0, c("sum_30")) / F.lit(30.0) * 7)).otherwise(0.0).alias("deposit_velocity"),
    )


def session_features(days: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """F08, F09, F28 (SIG-01), F46, F47 and SIG-13, from player-days of sessions over 30 days."""
    age = F.datediff("cutoff", "day")
    total = lambda e, w=None: F.coalesce(F.sum(F.col(e) if w is None else F.when(w, F.col(e))), F.lit(0)).cast("long")
    last, prior = age < 7, (age >= 7) & (age < 14)
    found = dealt(days, cutoffs, 30).groupBy("cutoff", "player_id").agg(
        total("sessions", last).alias("sessions_l7d"), total("sessions").alias("sessions_l30d"), total("seconds", last).alias("t7"), total("seconds").alias("t30"), F.count("*").alias("days"),
        total("sessions", prior).alias("s_p7"), total("seconds", prior).alias("t_p7"), total("seconds", age == 0).alias("today"),
    )
    c = F.col
    capped = lambda x, most: F.least(F.lit(1.0), x / F.lit(most))
    engagement = 0.4 * c("days") / 30 * 100 + 0.3 * capped(c("sessions_l30d"), 60.0) * 100 + 0.3 * capped(c("t30"), 108000.0) * 100
    both = (c("sessions_l7d") > 0) & (c("s_p7") > 0) & (c("t_p7") > 0)
    return found.select(
        "cutoff", "player_id", "sessions_l7d", "sessions_l30d", ((c("sessions_l7d") + 1) / (c("s_p7") + 1)).alias("session_ratio_7_vs_prior7"),
        F.when(both, (c("t7") / F.when(both, c("sessions_l7d"))) / F.when(both, c("t_p7") / c("s_p7"))).alias("session_length_ratio"),
        F.round(F.greatest(F.lit(0.0), F.least(F.lit(100.0), engagement)), 6).alias("engagement_score"), F.round(F.least(F.lit(100.0), 100 * c("today") / (c("t30") / c("days") + 1)), 6).alias("session_intensity"),
        F.when(c("sessions_l30d") > 0, c("t30") / F.when(c("sessions_l30d") > 0, c("sessions_l30d"))).alias("session_seconds"),
    )


def big_wins(plays: DataFrame, cutoffs: DataFrame, times: float = 5.0, most: int = 3) -> DataFrame:
    """whether a player-day of 30 days paid out more than `times` the median daily stake (90 days) over its stake, with a withdrawal
    0..most days later and up to the cutoff. A player's days in a window are at most 90."""
    middle = dealt(plays, cutoffs, 90).groupBy("cutoff", "player_id").agg(F.median("stake_c").alias("_med"))
    paid = interval_join(plays.select("player_id", "day", "stake_c", "payout_c"), plays.where("withdrawals > 0").select("player_id", "day"), "player_id", "day", most)
    won = dealt(paid, cutoffs, 30).where(F.col("later") <= F.col("cutoff")).join(middle, ["cutoff", "player_id"]).where(F.col("payout_c") - F.col("stake_c") > times * F.col("_med"))
    return middle.join(won.select("cutoff", "player_id", F.lit(1).alias("_won")).distinct(), ["cutoff", "player_id"], "left").select("cutoff", "player_id", F.coalesce("_won", F.lit(0)).alias("big_win_then_withdrawal"))

"""Churn labels, spells and recency/frequency/value features at cutoffs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .activity import _windowed, population


def churn_labels(days: DataFrame, cutoff: DataFrame, data_end: str | None = None, horizon: int = 60, look_back: int = 30) -> DataFrame:
    """LAB-2..6: event, duration_days, event_observed and churn within 7/14/30 days for each (cutoff, player).

    Days strictly after the cutoff count. A label whose window passes data_end (None: the last day of the data) is null, not 0. Cutoffs and active days
    of a player lie in one window, latest first: each cutoff sees the next active day and the next one that a silence follows.
    """
    people = population(days, cutoff, look_back)
    active = days.where("active").select("player_id", "day").distinct()
    last = days.agg((F.max("day") if data_end is None else F.max(F.lit(data_end).cast("date"))).alias("end"))
    active = active if data_end is None else active.where(F.col("day") <= F.lit(data_end).cast("date"))
    order = Window.partitionBy("player_id").orderBy("day")
    gaps = active.withColumn("next", F.lead("day").over(order)).join(F.broadcast(last))
    silent = (F.col("next").isNull() | (F.datediff("next", "day") > horizon)) & (F.date_add("day", horizon) <= F.col("end"))
    none = F.lit(None).cast("date")
    rows = gaps.select("player_id", "day", F.lit(1).alias("kind"), F.col("day").alias("active_day"), F.when(silent, F.col("day")).alias("silent_day"), F.lit(None).cast("string").alias("brand"))
    rows = rows.union(people.select("player_id", F.col("cutoff").alias("day"), F.lit(0), none, none, "brand"))
    # Latest first; an active day of the cutoff itself comes after it.
    later = Window.partitionBy("player_id").orderBy(F.desc("day"), "kind").rowsBetween(Window.unboundedPreceding, -1)
    found = rows.withColumn("next_active", F.min("active_day").over(later)).withColumn("next_silent", F.min("silent_day").over(later)).withColumn("last_active", F.max("active_day").over(later))
    found = found.where("kind = 0").withColumnRenamed("day", "cutoff").join(F.broadcast(last))
    known, first = F.datediff("end", "cutoff"), F.datediff("next_active", "cutoff")
    now = (first.isNull() | (first > horizon)) & (known >= horizon)
    found = found.withColumn("known", known).withColumn("first_day", first).withColumn("churn_day", F.when(now, 0).otherwise(F.datediff("next_silent", "cutoff")))
    event = F.when(F.col("known") >= horizon, (F.col("first_day").isNull() | (F.col("first_day") > horizon)).cast("int"))
    within = lambda h: F.when(F.col("known") >= h + horizon, F.coalesce(F.col("churn_day") <= h, F.lit(False)).cast("int"))
    return found.select(
        "cutoff", "player_id", "brand", event.alias(f"event_{horizon}d"), F.coalesce("churn_day", F.datediff("last_active", "cutoff"), F.lit(0)).alias("duration_days"), F.col("churn_day").isNotNull().cast("int").alias("event_observed"),
        *[within(h).alias(f"churn_within_{h}d") for h in (7, 14, 30)],
    )


def rfm_features(days: DataFrame, cutoff: DataFrame, windows: tuple[int, ...] = (7, 30, 90, 180)) -> DataFrame:
    """F01, F03..F07, F12..F16, F19..F23, F25, F31, F33, F45, F48, F49 in one pass over the longest window: look-backs (c - n, c] and prior ones (c - 2n, c - n]."""
    longest = 2 * max(windows)
    days = days if "bonus_c" in days.columns else days.withColumn("bonus_c", F.lit(0))
    rows = _windowed(days, cutoff, longest).withColumn("age", F.datediff("cutoff", "day"))
    within = lambda n, m=0: (F.col("age") < n) & (F.col("age") >= m)
    total = lambda e, w: F.coalesce(F.sum(F.when(w, e)), F.lit(0)).cast("long")
    measures = [F.min(F.when(F.col("active"), F.col("age"))).alias("days_since_last_bet"), F.least(F.max(F.when(F.col("active"), F.col("age"))), F.lit(150)).alias("days_since_first_bet")]
    for n in windows:
        measures += [
            F.count_if(F.col("active") & within(n)).alias(f"active_days_l{n}d"), F.count_if(F.col("active") & within(2 * n, n)).alias(f"prior_active_days_l{n}d"), total(F.col("bets"), within(n)).alias(f"bets_l{n}d"),
            total(F.col("turnover_c"), within(n)).alias(f"wagered_c_l{n}d"), total(F.col("turnover_c"), within(2 * n, n)).alias(f"prior_wagered_c_l{n}d"), total(F.col("ggr_c"), within(n)).alias(f"ggr_c_l{n}d"),
            total(F.col("ggr_c"), within(2 * n, n)).alias(f"prior_ggr_c_l{n}d"), total(F.col("bonus_c"), within(n)).alias(f"bonus_c_l{n}d"),
        ]
    found = rows.groupBy("cutoff", "player_id", "brand").agg(*measures)
    trend = lambda x, y: (F.col(x) + 1) / (F.col(y) + 1)
    mean = lambda x, y: F.try_divide(F.col(x).cast("double"), F.col(y))
    weekly = F.col("ggr_c_l90d") / F.lit(90.0) * 7
    multiple = F.when(weekly > 0, F.col("ggr_c_l7d") / weekly)
    return found.select(
        "*", F.col("ggr_c_l7d").alias("net_loss_7d"), trend("wagered_c_l7d", "prior_wagered_c_l7d").alias("wagered_trend_7"), trend("active_days_l7d", "prior_active_days_l7d").alias("active_days_7_vs_prior7"),
        multiple.alias("heavy_loss_multiple"), F.coalesce((F.col("ggr_c_l7d") > 0) & (multiple > 2), F.lit(False)).cast("int").alias("heavy_loss_flag"),
        mean("wagered_c_l30d", "bets_l30d").alias("avg_bet_c_l30d"), mean("wagered_c_l90d", "bets_l90d").alias("avg_bet_c"), mean("bonus_c_l30d", "wagered_c_l30d").alias("bonus_stake_share_30d"),
    )


def spells(days: DataFrame) -> DataFrame:
    """SPELL-1: silent spells of players: start day, length and whether a return closes it; open ones run to the last day of the data."""
    order = Window.partitionBy("player_id").orderBy("day")
    active = days.where("active").select("player_id", "day").distinct().withColumn("next", F.lead("day").over(order))
    active = active.join(F.broadcast(days.agg(F.max("day").alias("end"))))
    return active.select("player_id", "day", F.datediff(F.coalesce("next", "end"), "day").alias("length"), F.col("next").isNotNull().alias("closed"), F.datediff("end", "day").alias("follow"))


def return_curve(spell: DataFrame, longest: int = 120, window: int = 60) -> DataFrame:
    """SPELL-2: of the spells silent for d days with `window` days of follow-up, the share that return within them, for d = 1..longest.

    Each spell adds to a range of d; sums over differences of counts replace the pairing of spells and thresholds.
    """
    last = F.least(F.col("length"), F.col("follow") - window, F.lit(longest))
    back = F.when(F.col("closed"), F.greatest(F.col("length") - window, F.lit(1)))
    edges = spell.where(last >= 1).select(F.explode(F.array(
        F.struct(F.lit(1).alias("d"), F.lit(1).alias("n"), F.lit(0).alias("r")), F.struct((last + 1).alias("d"), F.lit(-1).alias("n"), F.lit(0).alias("r")),
        F.when(back <= last, F.struct(back.alias("d"), F.lit(0).alias("n"), F.lit(1).alias("r"))), F.when(back <= last, F.struct((last + 1).alias("d"), F.lit(0).alias("n"), F.lit(-1).alias("r"))),
    )).alias("e")).where("e is not null").groupBy("e.d").agg(F.sum("e.n").alias("n"), F.sum("e.r").alias("r"))
    every = spell.sparkSession.range(1, longest + 1).select(F.col("id").cast("int").alias("d"))
    up_to = Window.orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    curve = every.join(edges, "d", "left").select("d", F.sum(F.coalesce("n", F.lit(0))).over(up_to).alias("spells"), F.sum(F.coalesce("r", F.lit(0))).over(up_to).alias("returned"))
    return curve.where("spells > 0").select("d", "spells", "returned", (F.col("returned") / F.col("spells")).alias("return_rate"))


def dormancy(days: DataFrame, cutoff: DataFrame, silent: tuple[int, ...] = (14, 30), look_back: int = 180) -> DataFrame:
    """returns within look_back days after so many days without activity, whenever the silence began, and days since the last of
    them (look_back + 1 if none)."""
    order = Window.partitionBy("player_id").orderBy("day")
    returns = days.where("active").select("player_id", "brand", "day").distinct().withColumn("gap", F.datediff("day", F.lag("day").over(order)))
    rows = _windowed(returns, cutoff, look_back)
    measures = []
    for k in silent:
        back = F.coalesce(F.col("gap") > k, F.lit(False))
        measures += [F.count_if(back).alias(f"prior_dormancy_spells_{k}d"), F.coalesce(F.min(F.when(back, F.datediff("cutoff", "day"))), F.lit(look_back + 1)).alias(f"days_since_last_return_{k}d")]
    return rows.groupBy("cutoff", "player_id").agg(*measures)

"""SIG-01..19: derived signals as column expressions, and tenant z-scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clamp(x: Column, low: float = 0.0, high: float = 100.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def with_z_score(rows: DataFrame, x: str, keys: list[str], name: str) -> DataFrame:
    """WIN-12: (x - mean) / population deviation of the values over 0 in the group; 0 where x or the deviation isn't over 0. Groups are
    aggregated and joined back, so none has to fit into one task."""
    positive = F.when(F.col(x) > 0, F.col(x).cast("double"))
    groups = rows.groupBy(*keys).agg(F.avg(positive).alias("_mean"), F.stddev_pop(positive).alias("_sd"))
    z = F.when((F.col(x) > 0) & (F.col("_sd") > 0), (F.col(x) - F.col("_mean")) / F.when(F.col("_sd") > 0, F.col("_sd"))).otherwise(0.0)
    return rows.join(groups, keys).withColumn(name, z).drop("_mean", "_sd")


def value_decline(short: str, long: str, a: float, b: float) -> Column:
    """SIG-15, SIG-16: 100 * max(0, 1 - (short/a) / (long/b)); 0 without a long-run mean."""
    mean = F.col(long) / F.lit(b)
    return F.when(mean > 0, F.lit(100.0) * F.greatest(F.lit(0.0), 1 - (F.col(short) / F.lit(a)) / F.when(mean > 0, mean))).otherwise(0.0)


def value_score(w7: str, w30: str, w90: str, w180: str) -> Column:
    """SIG-02: recent value counts whole, older value less."""
    g7, g30, g90, g180 = (F.col(c).cast("double") for c in (w7, w30, w90, w180))
    return F.greatest(F.lit(0.0), g7 + 0.7 * (g30 - g7) + 0.4 * (g90 - g30) + 0.2 * (g180 - g90))


def escalation(recent: Column, base: Column) -> Column:
    """SIG-03: relative change of the mean stake, 0 without a base."""
    return F.when(base > 0, (recent - base) / F.when(base > 0, base)).otherwise(0.0)


def risk_appetite(z: Column) -> Column:
    """SIG-06"""
    return clamp(50 + 50 * clamp(z, -1.0, 1.0))


def betting_aggression(z: Column, rise: Column) -> Column:
    """SIG-07"""
    return clamp(50 + 25 * clamp(z, -2.0, 2.0) + 25 * clamp(rise, -1.0, 1.0))


def recency_score(days: Column, today: Column) -> Column:
    """SIG-09"""
    return F.when(today, 100.0).otherwise(100 * (1 - F.least(F.lit(1.0), days / F.lit(30.0))))


def churn_score(recency: Column, frequency: Column, value: Column) -> Column:
    """SIG-17"""
    return clamp(0.5 * recency + 0.3 * frequency + 0.2 * value)


def propensity(days: Column) -> Column:
    """SIG-18"""
    return F.least(F.lit(1.0), days / F.lit(90.0))


def loss_chasing(ggr: str, wagered: str) -> Column:
    """SIG-10: share of the stake that players got back beyond it, at most 1."""
    return F.when((F.col(ggr) < 0) & (F.col(wagered) > 0), F.least(F.lit(1.0), -F.col(ggr) / F.when(F.col(wagered) > 0, F.col(wagered)))).otherwise(0.0)


def band(score: Column) -> Column:
    """SIG-19"""
    return F.when(score < 25, "low").when(score < 50, "medium").when(score < 75, "high").otherwise("critical")


#: Weights of loss chasing, deposit velocity (a third of it), night share, stake escalation and net-loss velocity in the risk score.
RISK = (0.25, 0.2, 0.2, 0.2, 0.15)


def risk(days: DataFrame, weights: tuple[float, ...] = RISK) -> DataFrame:
    """SIG-12, SIG-14 from player-days of 30 days before each cutoff (stake_c, payout_c, plays, n, night, deposit_c)."""
    age = F.datediff("cutoff", "day")
    total = lambda e, w=None: F.coalesce(F.sum(e if w is None else F.when(w, e)), F.lit(0)).cast("long")
    won = F.col("stake_c") - F.col("payout_c")
    r = days.groupBy("cutoff", "player_id").agg(
        total(won, age == 0).alias("today"), total(won).alias("g30"), total(F.col("stake_c")).alias("w30"), total(F.col("stake_c"), age < 7).alias("w7"), total(F.col("plays")).alias("p30"), total(F.col("plays"), age < 7).alias("p7"),
        (F.sum("night") / F.sum("n")).alias("night"), total(F.col("deposit_c")).alias("d30"), total(F.col("deposit_c"), age < 7).alias("d7"),
    )
    c = F.col
    velocity = F.when(c("d30") > 0, c("d7") / (F.when(c("d30") > 0, c("d30")) / F.lit(30.0) * 7)).otherwise(0.0)
    base = c("w30") / F.when(c("p30") > 0, c("p30"))
    rise = F.when((c("p30") > 0) & (c("p7") > 0) & (c("w30") > 0), (c("w7") / F.when(c("p7") > 0, c("p7")) - base) / F.when(base > 0, base)).otherwise(0.0)
    loss = F.greatest(F.lit(0), -c("today")) / (c("d30") / F.lit(30.0) + 1)
    parts = (loss_chasing("g30", "w30"), F.least(F.lit(1.0), velocity / 3), c("night"), clamp(rise, 0.0, 1.0), F.least(F.lit(1.0), loss))
    score = sum((w * p for w, p in zip(weights, parts)), F.lit(0.0))
    return r.select("cutoff", "player_id", F.round(loss, 6).alias("net_loss_velocity"), F.round(clamp(100 * score), 4).alias("risk_score"))

"""Daily monitoring: runs, frozen days, drops, snapshot checks, shifts in time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rolling(daily: DataFrame, by: list[str], x: str, days: int = 28) -> DataFrame:
    """AGG-47: sum and exact median of the last `days` rows, this one included."""
    w = Window.partitionBy(*by).orderBy("day").rowsBetween(1 - days, 0)
    return daily.select(*by, "day", x, F.sum(x).over(w).alias("rolling_sum"), F.percentile(x, 0.5).over(w).alias("rolling_median"))


def frozen_days(daily: DataFrame, by: list[str], x: str, control: str) -> DataFrame:
    """WIN-17: days on which x equals the day before while the control changes."""
    w = Window.partitionBy(*by).orderBy("day")
    return daily.withColumn("frozen", F.coalesce((F.col(x) == F.lag(x).over(w)) & (F.col(control) != F.lag(control).over(w)), F.lit(False)))


def status_runs(rows: DataFrame, by: list[str], order: str, status: str) -> DataFrame:
    """WIN-18: runs of consecutive rows of one status."""
    w = Window.partitionBy(*by).orderBy(order)
    changed = F.coalesce((F.col(status) != F.lag(status).over(w)).cast("int"), F.lit(1))
    run = F.sum("_changed").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("_changed", changed).withColumn("run", run).groupBy(*by, "run", status).agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n"))


def biggest_drop(daily: DataFrame, by: list[str], x: str, days: int = 7) -> DataFrame:
    """WIN-20: the day after which the mean of the next days falls most below the mean of the last ones."""
    w = Window.partitionBy(*by).orderBy("day")
    enough = (F.count(x).over(w.rowsBetween(1 - days, 0)) == days) & (F.count(x).over(w.rowsBetween(1, days)) == days)
    drop = F.avg(x).over(w.rowsBetween(1 - days, 0)) - F.avg(x).over(w.rowsBetween(1, days))
    found = daily.withColumn("drop", F.when(enough, drop)).where(F.col("drop").isNotNull())
    return found.groupBy(*by).agg(F.max(F.struct("drop", (-F.datediff("day", F.lit("1970-01-01").cast("date"))).alias("_early"), "day")).alias("m")).select(*by, F.col("m.day").alias("day"), F.round("m.drop", 6).alias("drop"))


def window_check(snapshots: DataFrame, daily: DataFrame, key: str, value: str, stored: str, days: int) -> DataFrame:
    """CHK-3: a stored look-back against the sum of the daily column over its days: rows, equal, higher, lower.

    Each day is dealt to the snapshots it can serve (month starts), an equi-join.
    """
    months = F.explode(F.sequence(F.trunc("day", "month"), F.trunc(F.date_add("day", days), "month"), F.expr("interval 1 month")))
    sums = daily.select(key, "day", value, months.alias("cutoff")).where((F.datediff("cutoff", "day") >= 0) & (F.datediff("cutoff", "day") < days)).groupBy(key, "cutoff").agg(F.sum(value).alias("expected"))
    both = snapshots.join(sums, [key, "cutoff"], "left").withColumn("expected", F.coalesce("expected", F.lit(0)))
    gap = F.col(stored) - F.col("expected")
    return both.groupBy("cutoff").agg(F.count("*").alias("n"), F.count_if(gap == 0).alias("equal"), F.count_if(gap > 0).alias("higher"), F.count_if(gap < 0).alias("lower"))


def shift_sweep(stored: DataFrame, days: DataFrame, key: str, at: str, value: str, shifts: tuple[int, int]) -> DataFrame:
    """LEAK-2, LEAK-3: how often a stored recency equals the one recomputed as of the day plus s, for each shift s.

    Each row asks for its shifts in one order of a player's days: the last day so far is a running maximum, whatever the history's length.
    """
    asked = stored.select(key, at, value, F.explode(F.sequence(F.lit(shifts[0]), F.lit(shifts[1]))).alias("shift")).withColumn("_t", F.date_add(at, F.col("shift")))
    rows = days.select(key, F.col("day").alias("_t"), F.col("day").alias("_day")).distinct().withColumn("_kind", F.lit(0)).unionByName(asked.withColumn("_kind", F.lit(1)), allowMissingColumns=True)
    so_far = Window.partitionBy(key).orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    found = rows.withColumn("_last", F.max("_day").over(so_far)).where("_kind = 1").select("shift", value, F.datediff("_t", "_last").alias("days"))
    return found.groupBy("shift").agg(F.count("days").alias("n"), F.count_if(F.col("days") == F.col(value)).alias("matches"), F.round(F.count_if(F.col("days") == F.col(value)) / F.count("*"), 6).alias("share"))


def monotone(columns: list[str]) -> Column:
    """ANOM-7: whether windows that contain each other don't fall."""
    return F.coalesce(*[F.lit(True)]) if len(columns) < 2 else F.forall(F.array(*[F.col(a) <= F.col(b) for a, b in zip(columns, columns[1:])]), lambda ok: ok)


def schema_diff(rows: DataFrame, expected: dict[str, str]) -> DataFrame:
    """DQ-6, META-3: missing, extra and changed columns against a contract. Schemas are the driver's."""
    have = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    found = [(c, "missing", t, None) for c, t in expected.items() if c not in have] + [(c, "extra", None, t) for c, t in have.items() if c not in expected] + [(c, "changed", expected[c], have[c]) for c in have if c in expected and have[c] != expected[c]]
    return rows.sparkSession.createDataFrame(found, "column string, problem string, expected string, found string")

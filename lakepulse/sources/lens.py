"""The test tables as the domain's objects: activity, payments, gaming rows, messages. Money is in whole cents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(column: str) -> Column:
    return F.floor(F.col(column) * 100 + 0.5).cast("long")


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(player_id, brand, tenant)"""
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("tenant"))
    return table(spark, sf_dir, "customer").join(nation, "c_nationkey").select(F.col("c_custkey").alias("player_id"), F.col("c_mktsegment").alias("brand"), "tenant")


def stakes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(player_id, day, stake_c, payout_c, real): a row for each order; status F plays with playable bonus only."""
    c = cents("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("player_id"), F.to_date("o_orderdate").alias("day"), F.col("o_orderkey").alias("order_id"), F.col("o_orderpriority").alias("product"),
        c.alias("stake_c"), F.floor(c * (F.col("o_orderkey") % 7) / 4).cast("long").alias("payout_c"), (F.col("o_orderstatus") != "F").alias("real"),
    )


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Player-days (player_id, brand, tenant, day, bets, turnover_c, ggr_c, bonus_c, active)."""
    from lakepulse.operators.activity import player_days

    return player_days(stakes(spark, sf_dir).join(players(spark, sf_dir), "player_id"))


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(player_id, day, deposits, failed, withdrawals, deposit_c, withdraw_c) per player-day of events."""
    from lakepulse.operators.activity import payment_days

    return payment_days(table(spark, sf_dir, "events"))


def gaming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(player_id, game_id, provider, day, stake_c, payout_c, quantity, line, order_id) per line of an order."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        F.col("o_custkey").alias("player_id"), F.col("l_partkey").alias("game_id"), F.col("l_suppkey").alias("provider"), F.to_date("l_shipdate").alias("day"), cents("l_extendedprice").alias("stake_c"),
        F.floor(F.col("l_extendedprice") * (1 - F.col("l_discount")) * 100 + 0.5).cast("long").alias("payout_c"), F.col("l_quantity").cast("long").alias("quantity"), F.col("l_linenumber").alias("line"), F.col("l_orderkey").alias("order_id"),
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(F.col("o_custkey").alias("player_id"), F.to_date("l_shipdate").alias("day"), F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("game_id"),
        F.col("l_linenumber").alias("line"), F.col("l_quantity").cast("long").alias("quantity"), F.col("l_returnflag").alias("flag"), cents("l_extendedprice").alias("c"))


def cash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payment player-days over the days of lines (player_id, day, deposits, failed, withdrawals, deposit_c, withdraw_c, granted_c): flag A is a
    deposit, R a withdrawal, N a failed deposit; a hundredth of each is granted as bonus."""
    of = lambda flag: F.count_if(F.col("flag") == flag)
    amount = lambda flag: F.coalesce(F.sum(F.when(F.col("flag") == flag, F.col("c"))), F.lit(0)).cast("long")
    return _lines(spark, sf_dir).groupBy("player_id", "day").agg(of("A").alias("deposits"), of("N").alias("failed"), of("R").alias("withdrawals"), amount("A").alias("deposit_c"), amount("R").alias("withdraw_c"), F.sum(F.floor(F.col("c") / 100)).cast("long").alias("granted_c"))


def play_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Play player-days over the days of lines (player_id, day, sessions, seconds, plays, night): an order is a session, a quantity a minute, every fourth line at night."""
    return _lines(spark, sf_dir).groupBy("player_id", "day").agg(F.count_distinct("order_id").alias("sessions"), (F.sum("quantity") * 60).alias("seconds"), F.count("*").alias("plays"), F.count_if(F.col("line") % 4 == 0).alias("night"))


def game_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(player_id, game_id, day), a row per line."""
    return _lines(spark, sf_dir).select("player_id", "game_id", "day")


#: The same objects as DuckDB common table expressions, for the oracles.
SQL = {
    "players": "players AS (SELECT c_custkey AS player_id, c_mktsegment AS brand, n_name AS tenant FROM customer JOIN nation ON n_nationkey = c_nationkey)",
    "stakes": """stakes AS (SELECT o_custkey AS player_id, CAST(o_orderdate AS DATE) AS day, o_orderkey AS order_id, o_orderpriority AS product, c AS stake_c,
        CAST(floor(c * (o_orderkey % 7) / 4) AS BIGINT) AS payout_c, o_orderstatus <> 'F' AS real
        FROM (SELECT *, CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT) AS c FROM orders))""",
    "activity": """activity AS (SELECT player_id, brand, tenant, day, count(*) AS bets, CAST(sum(stake_c) AS BIGINT) AS turnover_c, CAST(sum(stake_c - payout_c) AS BIGINT) AS ggr_c, CAST(coalesce(sum(stake_c) FILTER (NOT real), 0) AS BIGINT) AS bonus_c, bool_or(real) AS active
        FROM stakes JOIN players USING (player_id) GROUP BY ALL)""",
    "payments": """payments AS (SELECT user_id AS player_id, CAST(ts AS DATE) AS day, count(*) FILTER (event_type = 'purchase') AS deposits, count(*) FILTER (event_type = 'error') AS failed,
        count(*) FILTER (event_type = 'click') AS withdrawals, CAST(coalesce(sum(c) FILTER (event_type = 'purchase'), 0) AS BIGINT) AS deposit_c, CAST(coalesce(sum(c) FILTER (event_type = 'click'), 0) AS BIGINT) AS withdraw_c
        FROM (SELECT *, CAST(floor(value * 100 + 0.5) AS BIGINT) AS c FROM events) GROUP BY ALL)""",
    "gaming": """gaming AS (SELECT o_custkey AS player_id, l_partkey AS game_id, l_suppkey AS provider, CAST(l_shipdate AS DATE) AS day, CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS stake_c,
        CAST(floor(l_extendedprice * (1 - l_discount) * 100 + 0.5) AS BIGINT) AS payout_c, CAST(l_quantity AS BIGINT) AS quantity, l_linenumber AS line, l_orderkey AS order_id
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey)""",
    "lines": """lines AS (SELECT o_custkey AS player_id, CAST(l_shipdate AS DATE) AS day, l_orderkey AS order_id, l_partkey AS game_id, l_linenumber AS line, CAST(l_quantity AS BIGINT) AS quantity, l_returnflag AS flag, CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS c
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey)""",
    "cash": """cash AS (SELECT player_id, day, count(*) FILTER (flag = 'A') AS deposits, count(*) FILTER (flag = 'N') AS failed, count(*) FILTER (flag = 'R') AS withdrawals, CAST(coalesce(sum(c) FILTER (flag = 'A'), 0) AS BIGINT) AS deposit_c,
        CAST(coalesce(sum(c) FILTER (flag = 'R'), 0) AS BIGINT) AS withdraw_c, CAST(sum(floor(c / 100)) AS BIGINT) AS granted_c FROM lines GROUP BY ALL)""",
    "play_days": "play_days AS (SELECT player_id, day, count(DISTINCT order_id) AS sessions, CAST(sum(quantity) * 60 AS BIGINT) AS seconds, count(*) AS plays, count(*) FILTER (line % 4 = 0) AS night FROM lines GROUP BY ALL)",
}
NEEDS = {"activity": ["players", "stakes"], "cash": ["lines"], "play_days": ["lines"]}


def with_(*names: str, recursive: bool = False) -> str:
    """WITH and the expressions of these objects, each after what it needs."""
    order: list[str] = []
    for n in names:
        order += [x for x in (*NEEDS.get(n, []), n) if x not in order]
    return "WITH " + "RECURSIVE " * recursive + ", ".join(SQL[n] for n in order)

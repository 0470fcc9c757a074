"""Hand-made rows: edges of windows, labels, leakage invariance, schema checks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakepulse.operators import activity, evaluate, keys, labels, monitor, sessions

C = dt.date(2025, 7, 1)


def days(spark, ages, player=1, brand="b", active=True):
    rows = [(player, brand, C - dt.timedelta(days=a), 1, 100, 10, active) for a in ages]
    return spark.createDataFrame(rows, "player_id int, brand string, day date, bets long, turnover_c long, ggr_c long, active boolean")


def cutoff(spark):
    return spark.createDataFrame([(C,)], "cutoff date")


def test_look_back_includes_the_cutoff_and_not_its_far_end(spark):
    f = labels.rfm_features(days(spark, [0, 6, 7, 13, 14, 29, 30, 89, 90, -1]), cutoff(spark), (7, 30, 90)).first()
    assert (f.active_days_l7d, f.prior_active_days_l7d, f.active_days_l30d, f.active_days_l90d) == (2, 2, 6, 8)


@pytest.mark.parametrize(("later", "duration", "event"), [([], 0, 1), ([5], 5, 0), ([20, 70], 70, 0), ([10, 100], 10, 0)])
def test_churn_labels(spark, later, duration, event):
    rows = days(spark, [0, *[-t for t in later]])
    got = labels.churn_labels(rows, cutoff(spark), str(C + dt.timedelta(days=200)), 60).first()
    assert (got.duration_days, got.event_60d) == (duration, event)
    within = [got.churn_within_7d, got.churn_within_14d, got.churn_within_30d]
    assert within == sorted(within)


def test_unknown_labels_are_null(spark):
    got = labels.churn_labels(days(spark, [0]), cutoff(spark), str(C + dt.timedelta(days=40)), 60).first()
    assert got.event_60d is None and got.churn_within_7d is None


def test_features_do_not_see_the_future(spark):
    here, later = days(spark, [0, 3, 40]), days(spark, [-1, -20]).union(days(spark, [-2], player=2))
    a, b = (labels.rfm_features(x, cutoff(spark)).collect() for x in (here, here.union(later)))
    assert a == b


def test_active_day_needs_real_money(spark):
    stakes = spark.createDataFrame([(1, "b", "t", C, 10, 0, True), (2, "b", "t", C, 10, 0, False), (2, "b", "t", C, 5, 0, False)], "player_id int, brand string, tenant string, day date, stake_c long, payout_c long, real boolean")
    assert {r.player_id: (r.bets, r.active) for r in activity.player_days(stakes).collect()} == {1: (1, True), 2: (2, False)}


def test_as_of_join_keeps_time_to_live(spark):
    day = lambda n: dt.date(2025, 1, 1) + dt.timedelta(days=n)
    events = spark.createDataFrame([(1, day(0)), (1, day(2)), (1, day(9)), (2, day(2))], "k int, asked date")
    features = spark.createDataFrame([(1, day(1), 5.0), (1, day(3), 7.0)], "k int, ts date, v double")
    got = {(r.k, r.asked): r.v for r in keys.as_of(events, features, ["k"], "asked", "ts", 5).collect()}
    assert got == {(1, day(0)): None, (1, day(2)): 5.0, (1, day(9)): None, (2, day(2)): None}


def test_midnight_does_not_split_a_session(spark):
    at = lambda s: dt.datetime.fromisoformat(s)
    e = spark.createDataFrame([(1, at("2025-01-01T23:50:00"), 1), (1, at("2025-01-02T00:10:00"), 2), (1, at("2025-01-02T00:41:00"), 3)], "who int, ts timestamp_ntz, event_id long")
    got = {r.minutes: [] for r in sessions.sessions(e, "who", "ts").collect()}
    for r in sessions.sessions(e, "who", "ts").collect():
        got[r.minutes].append((r.day, r.events))
    assert sorted(got[30]) == [(dt.date(2025, 1, 1), 2), (dt.date(2025, 1, 2), 1)] and len(got[15]) == 3 and len(got[60]) == 1


def test_auc_of_perfect_reversed_and_tied_scores(spark):
    rows = spark.createDataFrame([("p", i, int(i >= 5)) for i in range(10)] + [("r", -i, int(i >= 5)) for i in range(10)] + [("t", 1, i % 2) for i in range(10)] + [("n", i, 0) for i in range(3)], "g string, s int, y int")
    assert {r.g: r.auc for r in evaluate.auc(rows, "s", "y", ["g"]).collect()} == {"p": 1.0, "r": 0.0, "t": 0.5, "n": None}


def test_schema_problems(spark):
    rows = spark.createDataFrame([(1, "a")], "x int, y string")
    got = {(r.column, r.problem) for r in monitor.schema_diff(rows, {"x": "bigint", "z": "date"}).collect()}
    assert got == {("x", "changed"), ("z", "missing"), ("y", "extra")}


def test_null_keys_meet(spark):
    a = spark.createDataFrame([(None, 1), (2, 2)], "k int, v int")
    b = spark.createDataFrame([(None, 1), (2, 3), (4, 4)], "k int, v int")
    got = keys.same_keys(a, b, ["k"], ["v"]).first()
    assert (got.only_left, got.only_right, got.both, got.differ_v) == (0, 1, 2, 1)


def test_shifted_is_not_lost(spark):
    d = dt.date(2025, 1, 5)
    left = spark.createDataFrame([(1, d), (2, d), (3, d)], "k int, day date")
    right = spark.createDataFrame([(1, d), (2, d + dt.timedelta(days=1))], "k int, day date")
    got = keys.shifted_keys(left, right, ["k"], "day").first()
    assert (got.missing, got.lost) == (2, 1)


def test_level_shift_sets_the_mean(spark):
    from lakepulse.operators import models

    rows = spark.createDataFrame([("a", p / 100, 0.5) for p in range(10, 60)], "g string, p double, rate double")
    s = models.level_shift(rows, "p", ["g"], "rate").first()["shift"]
    moved = rows.select(F.avg(1 / (1 + F.exp(-(F.log(F.col("p") / (1 - F.col("p"))) + s))))).first()[0]
    assert moved == pytest.approx(0.5, abs=1e-3)

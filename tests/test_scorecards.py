"""Tables of metrics, replays, block intervals, histograms by segment and the feature frame on made-up rows with known answers."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakepulse.operators import alerts, frame, models, scorecards


def test_block_intervals(spark):
    """The interval is that of resampling blocks of consecutive values that wrap round the end."""
    x = np.array([0.1, 0.2, 0.3, 0.9, 0.8, 0.7, 0.2, 0.1, 0.4, 0.5, 0.6, 0.3])
    rows = [("a", i, float(v)) for i, v in enumerate(x)] + [("b", 0, 2.0), ("b", 1, None)]
    got = {r.g: r for r in scorecards.block_intervals(spark.createDataFrame(rows, "g string, t int, x double"), ["g"], "t", "x", 3, 2000).collect()}
    rng = np.random.default_rng(1)
    means = [x[((rng.integers(0, 12, 4)[:, None] + np.arange(3)) % 12).ravel()].mean() for _ in range(4000)]
    low, high = np.percentile(means, [2.5, 97.5])
    assert (got["a"].low, got["a"].high) == (pytest.approx(low, abs=0.02), pytest.approx(high, abs=0.02))
    assert (got["a"].mean, got["a"].median, got["a"].least, got["a"].most) == (pytest.approx(x.mean()), pytest.approx(np.median(x)), 0.1, 0.9)
    assert (got["b"].low, got["b"].mean, got["b"].high) == (2.0, 2.0, 2.0)


def test_replay_against_a_random_choice(spark):
    rows = [("c", i, float(i), i % 2, float(i)) for i in range(10)] + [("d", 1, 1.0, 0, 5.0)]
    got = {(r.g, r.ranking): r for r in scorecards.replay(spark.createDataFrame(rows, "g string, k int, s double, y int, v double"), {"s": "s"}, "k", "y", "v", 4, ["g"]).collect()}
    assert (got["c", "s"].contacts, got["c", "s"].churn_captured, got["c", "s"].value_captured) == (4, 0.4, pytest.approx(16 / 25))
    assert (got["c", "random"].churn_captured, got["c", "random"].value_per_1000) == (0.4, pytest.approx(2500.0))
    assert got["d", "s"].contacts == 1 and got["d", "s"].churn_captured is None


def test_peaks_by_segment(spark):
    rng = np.random.default_rng(3)
    values = [("u", float(v)) for v in rng.normal(20, 3, 3000)] + [("v", float(v)) for v in np.concatenate([rng.normal(10, 2, 2000), rng.normal(40, 2, 2000)])] + [("v", None)]
    long = scorecards.histograms(spark.createDataFrame(values, "s string, x double"), {"m": {"expr": "x", "scale": "linear", "width": 1, "range": (0, 30)}}, "s")
    found = {r.segment: [int(p) for p in r.positions.split(",")] for r in scorecards.segment_peaks(long).collect()}
    assert len(found["u"]) == 1 and abs(found["u"][0] - 20) <= 2
    assert len(found["v"]) == 2 and abs(found["v"][0] - 10) <= 2 and abs(found["v"][1] - 40) <= 2
    card = {r.segment: r for r in scorecards.scorecard(long).collect()}
    assert card["v"].above == pytest.approx(0.5) and card["v"].null_share == pytest.approx(1 / 4001) and card["all"].n_rows == 7001


def test_a_brand_that_the_reference_lacks_is_critical(spark):
    rows = [("old", "f", True, float(i % 30)) for i in range(300)] + [("old", "f", False, float(i % 30)) for i in range(300)] + [("new", "f", False, 1.0)] * 20 + [("moved", "f", i < 100, float(i < 100)) for i in range(200)]
    long = spark.createDataFrame(rows, "b string, feature string, ref boolean, x double")
    edges = alerts.drift_edges(long.where("ref"), ["b", "feature"], "x")
    got = {r.b: (r.psi, r.severity, r.reason) for r in alerts.drift(long, ["b", "feature"], "x", F.col("ref"), edges).collect()}
    assert got["new"] == (None, "critical", "not in the reference") and got["old"] == (pytest.approx(0), "ok", None)
    assert got["moved"][1] == "critical" and got["moved"][0] == pytest.approx(2 * 0.9999 * np.log(1e4), rel=1e-3)  # a bin per value
    counts = {r.b: r.severity for r in alerts.player_counts(long.where("not ref"), long.where("ref").withColumn("t", F.lit(1)), ["b"], "t").collect()}
    assert counts == {"old": "ok", "new": "critical", "moved": "ok"}


def test_any_change_from_a_constant_is_critical(spark):
    day = lambda n: dt.date(2025, 1, 1) + dt.timedelta(n)
    rows = [("a", day(n), 5) for n in range(20)] + [("a", day(20), 6), ("a", day(21), 5)] + [("gap", day(n), 5 + n) for n in range(14)] + [("gap", day(60), 900)]
    got = {(r.g, r.day): r.severity for r in alerts.mad_band(spark.createDataFrame(rows, "g string, day date, n int"), ["g"], "n").collect()}
    assert (got["a", day(19)], got["a", day(20)], got["a", day(21)]) == ("ok", "critical", "ok")
    assert got["gap", day(60)] == "info"  # the days before lie out of the 28 calendar days


def test_distinct_games_add_up_like_sums(spark):
    rng = np.random.default_rng(5)
    start = dt.date(2025, 1, 1)
    plays = sorted({(1, int(g), int(d)) for g, d in zip(rng.integers(0, 6, 60), rng.integers(0, 150, 60))})
    steps = {(r.day - start).days: r.games for r in frame.breadth(spark.createDataFrame([(p, g, start + dt.timedelta(d)) for p, g, d in plays], "player_id int, game_id int, day date")).collect()}
    for c in range(0, 190, 7):
        assert sum(n for d, n in steps.items() if d <= c) == len({g for _, g, d in plays if c - 30 < d <= c})


def test_functions_of_other_features_are_found(spark):
    rng = np.random.default_rng(6)
    rows = [(int(m), int(m) // 3, int(m) * 7, float(x), int(n), int(rng.random() < 0.1 + 0.06 * m)) for m, x, n in zip(rng.integers(0, 12, 3000), rng.random(3000), rng.integers(0, 9, 3000))]
    found = models.dependent(spark.createDataFrame(rows, "month int, quarter int, coded int, x double, noise int, y int"), ["month", "quarter", "coded", "x", "noise"], "y")
    assert found == {"month": "coded", "quarter": "coded"}  # month and coded carry the same


def test_pruning_keeps_the_smallest_set_within_the_tolerance(spark):
    scores = {("a",): 0.70, ("a", "b"): 0.795, ("a", "b", "c"): 0.80}
    kept, score, tried = models.prune(["a", "b", "c"], lambda names: scores[tuple(names)], 0.01)
    assert (kept, score, tried) == (["a", "b"], 0.795, [(1, 0.70), (2, 0.795)])
    assert models.prune(["a", "b", "c"], lambda names: scores[tuple(names)], 0.0)[0] == ["a", "b", "c"]

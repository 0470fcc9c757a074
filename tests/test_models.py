"""Model operators on made-up rows with known answers."""

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from lakepulse.operators import models
from lakepulse.plans import catalog


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    x, noise = rng.standard_normal(1200), rng.standard_normal(1200)
    y = (rng.uniform(size=1200) < 1 / (1 + np.exp(-2 * x))).astype(int)
    data = [(i, "ab"[i % 2], float(a), float(b), float(a * 1.0001), int(c)) for i, (a, b, c) in enumerate(zip(x, noise, y))]
    return spark.createDataFrame(data, "i int, g string, x double, noise double, twin double, y int").repartition(3)


def test_permuted_moves_values_only(rows):
    moved = models.permuted(rows, "x", ["i"])
    a, b = {r.i: (r.x, r.noise) for r in rows.collect()}, {r.i: (r.x, r.noise) for r in moved.collect()}
    assert sorted(v[0] for v in a.values()) == sorted(v[0] for v in b.values())
    assert all(a[i][1] == b[i][1] for i in a) and sum(a[i][0] == b[i][0] for i in a) < 20


def test_importance_finds_the_feature_that_counts(rows):
    fall = {r.feature: r.fall for r in models.permutation_importance(rows, rows, ["x", "noise"], "y", ["i"]).collect()}
    assert fall["x"] > 0.2 and abs(fall["noise"]) < 0.05


def test_correlated_features(rows):
    found = {(r.a, r.b): r.dropped for r in models.correlated(rows, ["x", "noise", "twin"], "y").collect()}
    assert found["x", "noise"] is None and found["noise", "twin"] is None and found["x", "twin"] in ("x", "twin")


def test_calibration(rows):
    p = rows.withColumn("p", 1 / (1 + F.exp(-F.col("x") * 6)))
    for found in (models.platt(p, p, "p", "y"), models.calibrated_by(p, p, "p", "y", "g"), models.isotonic(p, p, "p", "y")):
        assert found.count() == 1200
        r = found.agg(F.avg("calibrated"), F.avg("y"), F.min("calibrated"), F.max("calibrated")).first()
        assert abs(r[0] - r[1]) < 0.02 and r[2] >= 0.005 and r[3] <= 0.995
    choice = models.calibrator_choice(p, "p", "y", "i").collect()
    assert sum(r.chosen for r in choice) == 1 and min(choice, key=lambda r: r.ece).chosen


def test_contributions_add_up(rows):
    found = models.contributions(rows, rows, ["x", "noise"], "y")
    assert abs(found.agg(F.avg("part_x")).first()[0]) < 1e-9
    assert found.where("abs(part_x) > abs(part_noise)").select(F.split("drivers", " ")[0]).distinct().collect()[0][0] == "x"
    summary = {r.feature: (r.mean_size, r.direction) for r in models.contribution_summary(found, ["x", "noise"]).collect()}
    assert summary["x"][0] > summary["noise"][0] and summary["x"][1] == "raises"


def test_boosted_trees_stop_early_and_rank(rows):
    marked = rows.withColumn("late", F.col("i") % 4 == 0)
    found = models.boosted(marked, marked, ["x", "noise"], "y", "late", trees=10)
    r = found.agg(F.avg(F.when(F.col("y") == 1, F.col("p"))), F.avg(F.when(F.col("y") == 0, F.col("p")))).first()
    assert r[0] > r[1] + 0.2


def test_isolation_forest_finds_planted_rows(spark):
    rng = np.random.default_rng(5)
    data = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(0, 1, (990, 2)))] + [(2000 + i, 500.0 + i, -400.0) for i in range(10)]
    frame = spark.createDataFrame(data, "i int, a double, b double")
    found = models.isolation_forest(frame, ["a", "b"], ["i"], trees=60, share=0.01)
    flagged = {r.i for r in found.where("outlier").collect()}
    assert len(flagged & set(range(2000, 2010))) >= 8 and len(flagged) <= 10
    again = models.isolation_forest(frame.repartition(7), ["a", "b"], ["i"], trees=60, share=0.01)
    assert {r.i for r in again.where("outlier").collect()} == flagged
    assert models.isolation_forest(frame.limit(0), ["a", "b"], ["i"]).count() == 0


@pytest.fixture
def observed(spark):
    """A session that has observed metrics, as lake writes do; it can't be sent to tasks any more."""
    seen = Observation()
    spark.range(3).observe(seen, F.count("*").alias("n")).collect()
    assert seen.get == {"n": 3}
    return spark


def test_logistic_equals_the_model(rows):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    got = {r.i: r.p for r in models.logistic(rows, rows, ["x", "noise"], "y").select("i", "p").collect()}
    raw = VectorAssembler(inputCols=["x", "noise"], outputCol="raw").transform(rows)
    scaled = StandardScaler(inputCol="raw", outputCol="v", withMean=True).fit(raw).transform(raw).select("i", "y", "v")
    model = LogisticRegression(featuresCol="v", labelCol="y", maxIter=50, regParam=1e-4).fit(scaled)
    b = model.coefficients.toArray()
    for r in scaled.collect():
        assert got[r.i] == pytest.approx(1 / (1 + np.exp(-(r.v.toArray() @ b + model.intercept))), abs=1e-9)
        if r.i < 20:
            assert got[r.i] == pytest.approx(model.predictProbability(r.v)[1], abs=1e-9)


def test_isotonic_query_after_observed_metrics(observed, sf):
    assert catalog.QUERIES["ml_5_isotonic"](observed, sf).count() > 0


def test_pruning_query_after_observed_metrics(observed, sf):
    assert catalog.QUERIES["ml_14_pruning"](observed, sf).count() == 4


def test_calibrator_choice_query_after_observed_metrics(observed, sf):
    assert sorted(r.calibrator for r in catalog.QUERIES["ml_6_calibrator_choice"](observed, sf).collect()) == ["isotonic", "platt"]


def test_importance_query_after_observed_metrics(observed, sf):
    assert catalog.QUERIES["ml_14_importance"](observed, sf).count() == 4


def test_ablation_query_after_observed_metrics(observed, sf):
    assert catalog.QUERIES["ml_15_ablation"](observed, sf).count() == 4


def test_robustness_query_after_observed_metrics(observed, sf):
    assert catalog.QUERIES["rpt_5_robustness"](observed, sf).count() == 4

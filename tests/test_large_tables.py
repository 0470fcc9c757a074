"""What queries write and order on the way, which decides how they grow: small tables with small ranges stand for large ones."""

import pytest
from pyspark.sql import functions as F

from lakepulse.operators import alerts, evaluate, frame, ranks, scorecards
from lakepulse.plans import catalog, players
from lakepulse.plans import alerts as alert_plans
from lakepulse.plans import extra as extra_plans
from lakepulse.plans import frame as frame_plans
from lakepulse.plans import scorecards as scorecard_plans
from lakepulse.sources import lens
from lakepulse.sources.lake import kept

MODULES = (alerts, evaluate, frame, ranks, scorecards, players, alert_plans, extra_plans, frame_plans, scorecard_plans)


@pytest.fixture
def written(monkeypatch):
    """Rows of each checkpoint that is made."""
    found = []

    def keep(rows):
        out = kept(rows)
        found.append(out.count())
        return out

    for module in MODULES:
        if hasattr(module, "kept"):
            monkeypatch.setattr(module, "kept", keep)
    return found


@pytest.fixture
def ordered(monkeypatch):
    """Groups and column of each order that is made."""
    found, running = [], ranks.running

    def run(rows, by, x, *a, **b):
        found.append((tuple(by), x))
        return running(rows, by, x, *a, **b)

    for module in MODULES:
        if hasattr(module, "running"):
            monkeypatch.setattr(module, "running", run)
    return found


@pytest.mark.parametrize("name", ["bt_2_by_cutoff", "bt_2_summary", "bt_2_intervals", "eval_17_compared"])
def test_scores_that_are_compared_are_not_written_one_by_one(spark, sf, written, name):
    catalog.QUERIES[name](spark, sf).collect()
    assert 0 < max(written) < 3 * players.scored(spark, sf).count()  # three scores each


@pytest.mark.parametrize("name", ["rpt_3_matrix", "rpt_3_overlap"])
def test_two_labels_are_not_written_per_score(spark, sf, written, ordered, name):
    catalog.QUERIES[name](spark, sf).collect()
    assert max(written) < 4 * players.scored(spark, sf).count()  # six pairs of score and label each
    assert all("player_id" not in by and len(by) <= 3 for by, _ in ordered)  # no order of its own for each value of a score


def test_scorecard_writes_no_row_per_metric(spark, sf, written):
    catalog.QUERIES["shape_4_scorecard"](spark, sf).collect()
    assert max(written) < 8 * lens.gaming(spark, sf).count()  # four metrics, each for its segment and for all


def test_ratio_quantiles_order_no_rows(spark, sf, ordered):
    assert catalog.QUERIES["agg_22_ratio_quantiles"](spark, sf).count() == 5
    assert not ordered


def test_drifting_features_are_built_once(spark, sf, monkeypatch, ordered):
    calls, feat = [], players.feat
    monkeypatch.setattr(players, "feat", lambda *a: calls.append(a) or feat(*a))
    catalog.QUERIES["alrt_5_brands"](spark, sf).collect()
    assert len(calls) == 1 and not ordered


def test_places_compare_no_row_with_all_ranges(spark, monkeypatch):
    monkeypatch.setattr(ranks, "RANGE_ROWS", 40)
    rows = spark.range(2000).select(F.lit("g").alias("g"), (F.col("id") % 7).cast("double").alias("x"), "id")
    found = ranks.placed(rows, ["g"], "x", "id")
    assert "lambda" not in found._jdf.queryExecution().optimizedPlan().toString()
    want = sorted(((i % 7, i) for i in range(2000)), key=lambda v: (-v[0], v[1]))
    assert {r.id: (r.place, r.size) for r in found.collect()} == {i: (k, 2000) for k, (_, i) in enumerate(want, 1)}


@pytest.mark.parametrize("descending", [True, False])
def test_places_of_nulls_and_nan(spark, monkeypatch, descending):
    monkeypatch.setattr(ranks, "RANGE_ROWS", 10)
    values = [None, float("nan"), 1.0, -0.0, 0.0, 2.5] * 20
    rows = spark.createDataFrame([("a" if i % 2 else None, v, i) for i, v in enumerate(values)], "g string, x double, i int")
    found = {r.i: r.place for r in ranks.placed(rows, ["g"], "x", "i", descending).collect()}
    for g in (0, 1):
        own = [(v, i) for i, v in enumerate(values) if i % 2 == g]
        size = lambda v: (v is None, 0 if v is None else (-1 if descending else 1) * (9 if v != v else v))
        assert [i for _, i in sorted(own, key=lambda v: (size(v[0]), v[1]))] == sorted((i for _, i in own), key=found.get)


@pytest.mark.parametrize("range_rows", [20, 50_000])
def test_top_ends_agree_with_places(spark, monkeypatch, range_rows):
    monkeypatch.setattr(ranks, "RANGE_ROWS", range_rows)
    rows = spark.createDataFrame([("a" if i % 3 else None, None if i % 11 == 0 else float(i * i % 5), i, i % 4) for i in range(700)], "g string, x double, i int, y int")
    for share in (0.001, 0.1, 0.5, 0.97, 1.0):
        top = F.col("place") <= F.greatest(F.lit(1), F.floor(F.col("size") * share + 0.5))
        want = ranks.placed(rows, ["g"], "x", "i").groupBy("g").agg(F.count_if(top).alias("k"), F.sum(F.when(top, F.col("y"))).alias("hits")).collect()
        found = evaluate.top_counts(rows, "x", "y", "i", ["g"], share).select("g", "k", "hits").collect()
        assert sorted(map(str, found)) == sorted(map(str, want))


@pytest.mark.parametrize("reach", [5, 0])
def test_quantiles_near_the_approximate_ones(spark, monkeypatch, ordered, reach):
    """Exact also where approximate ones are far off, as all values are ordered then."""
    monkeypatch.setattr(ranks, "ACCURACY", 100)
    monkeypatch.setattr(ranks, "REACH", reach)
    rows = kept(spark.range(5000).select((F.col("id") % 2).alias("g"), ((F.col("id") * 7919) % 1009 * 1.5 - 300).alias("x")))
    shares = [0.0, 0.005, 0.25, 0.5, 0.995, 1.0]
    want = {r.g: r.q for r in ranks.quantiles(rows, "x", ["g"], shares).collect()}
    ordered.clear()
    assert {r.g: r.q for r in ranks.quantiles(rows, "x", ["g"], shares, steady=True).collect()} == want
    assert len(ordered) == (reach == 0)


def test_places_of_the_frame_are_shuffled_without_sums(spark, sf):
    plan = catalog.QUERIES["feat_all"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [player_id" in plan


@pytest.mark.parametrize("name", ["feat_fin", "wins_1_all_caps"])
def test_caps_write_and_order_no_row_per_feature(spark, sf, written, ordered, name):
    rows = catalog.QUERIES["feat_all"](spark, sf).count()
    catalog.QUERIES[name](spark, sf).collect()
    assert written[0] == rows and not ordered
    assert sum(n > rows for n in written) <= 1  # the values of groups as small as these are all counted


def test_places_by_two_scores_compare_no_row_with_all_ranges(spark, sf, monkeypatch):
    monkeypatch.setattr(ranks, "RANGE_ROWS", 200)
    found = catalog.QUERIES["sets_4_overlap"](spark, sf)
    assert "lambda" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.count() == players.scored(spark, sf).select("cutoff").distinct().count()

"""Ranks, quantiles, survival checks and shapes against brute force in plain Python and numpy."""

import math
from statistics import mean

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakepulse.operators import checks, evaluate, models, ranks, shapes, survival


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    data = [("a" if i % 3 else None if i % 9 == 0 else "b", float(v), i) for i, v in enumerate(rng.integers(0, 40, 900) ** 2)]
    return data, spark.createDataFrame(data, "g string, x double, i int").repartition(5)


def groups(data):
    out = {}
    for g, x, i in data:
        out.setdefault(g, []).append((x, i))
    return out


@pytest.mark.parametrize("range_rows", [50, 50_000])
def test_places(rows, monkeypatch, range_rows):
    """In one range and in many: equal values are parted by the key."""
    monkeypatch.setattr(ranks, "RANGE_ROWS", range_rows)
    data, frame = rows
    found = {r.i: (r.place, r.size) for r in ranks.placed(frame, ["g"], "x", "i").collect()}
    for own in groups(data).values():
        for place, (_, i) in enumerate(sorted(own, key=lambda v: (-v[0], v[1])), 1):
            assert found[i] == (place, len(own))


@pytest.mark.parametrize("by", [["g"], []])
def test_quantiles(rows, by):
    data, frame = rows
    shares = [0.0, 0.1, 0.333, 0.5, 0.995, 1.0]
    found = ranks.quantiles(frame, "x", by, shares).collect()
    own = groups(data) if by else {None: [(x, i) for _, x, i in data]}
    assert len(found) == len(own)
    for r in found:
        assert r.q == pytest.approx(np.quantile([x for x, _ in own[r.g if by else None]], shares))


def test_first_rows(rows):
    data, frame = rows
    found = evaluate.first_rows(frame, ["g"], [F.desc("x"), F.col("i")], 7).collect()
    want = {i for own in groups(data).values() for _, i in sorted(own, key=lambda v: (-v[0], v[1]))[:7]}
    assert {r.i for r in found} == want


def test_rank_correlation(rows, spark):
    data, frame = rows
    frame = frame.withColumn("y", F.col("x") + F.col("i") % 50 * 10)
    pairs = [(r.x, r.y) for r in frame.collect()]

    def rank(v):
        return [sum(u < w for u in v) + (sum(u == w for u in v) + 1) / 2 for w in v]

    want = np.corrcoef(rank([p[0] for p in pairs]), rank([p[1] for p in pairs]))[0, 1]
    assert checks.rank_correlations(frame, "x", ["y"]).first().y == pytest.approx(want)


@pytest.fixture(scope="module")
def lives(spark):
    rng = np.random.default_rng(8)
    z, w = rng.standard_normal(300), rng.standard_normal(300)
    t = np.ceil(rng.exponential(30 * np.exp(-0.6 * z + 0.3 * w))).astype(int)
    end = rng.integers(5, 90, 300)
    data = [("s" if i % 4 else "r", int(min(a, b)), int(a <= b), float(x), float(y), int(round(x * 3))) for i, (a, b, x, y) in enumerate(zip(t, end, z, w))]
    return data, spark.createDataFrame(data, "g string, t int, e int, z double, w double, r int")


def brute_gradient(data, beta):
    grad, hess = np.zeros(2), np.zeros((2, 2))
    for g, t, e, z, w, _ in data:
        if not e:
            continue
        at_risk = np.array([(x[3], x[4]) for x in data if x[0] == g and x[1] >= t])
        p = np.exp(at_risk @ beta)
        p /= p.sum()
        m = p @ at_risk
        grad += np.array([z, w]) - m
        hess += (at_risk * p[:, None]).T @ at_risk - np.outer(m, m)
    return grad, hess


def test_cox_is_where_the_likelihood_is_flat(lives):
    data, frame = lives
    beta, cov = survival.cox(frame, "t", "e", ["z", "w"], ["g"])
    grad, hess = brute_gradient(data, beta)
    assert np.abs(grad).max() < 1e-4 and np.allclose(cov, np.linalg.inv(hess), rtol=1e-5)
    assert beta[0] > 0.3 and beta[1] < 0
    found = survival.schoenfeld(frame, "t", "e", ["z", "w"], ["g"], beta, 10_000).collect()
    assert {r.feature for r in found} == {"z", "w"} and all(abs(r.mean_residual) < 1e-4 for r in found)


def brute_km(own):
    s, out = 1.0, {}
    for t in sorted({x for x, _ in own}):
        before = s
        n, d = sum(x >= t for x, _ in own), sum(x == t and e for x, e in own)
        s *= 1 - d / n
        out[t] = (before, s)
    return out


def test_curves_weights_and_auc(lives):
    data, frame = lives
    for g in "rs":
        own = [(t, e) for k, t, e, *_ in data if k == g]
        want = brute_km(own)
        got = {r.t: (r.before, r.after) for r in survival.curve(frame.where(F.col("g") == g), "t", "e", ["g"]).collect()}
        assert set(got) == set(want) and all(got[t] == pytest.approx(want[t], abs=1e-9) for t in want)
    censor = {g: brute_km([(t, 1 - e) for k, t, e, *_ in data if k == g]) for g in "rs"}
    for row in survival.auc_at(frame, "t", "e", "r", ["g"], (14, 40)).collect():
        own = [x for x in data if x[0] == row.g]
        good = total = 0.0
        for a in own:
            if a[1] <= row.horizon and a[2]:
                w = 1 / max(1e-6, censor[row.g][a[1]][0])
                for b in own:
                    if b[1] > row.horizon:
                        total += w
                        good += w * (1 if b[5] < a[5] else 0.5 if b[5] == a[5] else 0)
        assert row.auc == pytest.approx(good / total, abs=1e-5)


def at_day(curve, day):
    """The last value of a survival curve by a day."""
    return min([after for t, (_, after) in curve.items() if t <= day], default=1.0)


def test_brier_and_calibration(lives):
    """Those who last beyond the day of the grid are weighted by the censoring curve at that day, not at their own."""
    data, frame = lives
    censor = {g: brute_km([(t, 1 - e) for k, t, e, *_ in data if k == g]) for g in "rs"}
    found = survival.brier(frame, "t", "e", lambda day: F.exp(-day / 50.0), ["g"], [10, 30, 50])
    for row in found.collect():
        s = math.exp(-row.day / 50)
        own, c = [x for x in data if x[0] == row.g], censor[row.g]
        each = [s * s / max(1e-6, c[t][0]) if t <= row.day and e else (1 - s) ** 2 / max(1e-6, at_day(c, row.day)) if t > row.day else 0.0 for _, t, e, *_ in own]
        assert row.brier == pytest.approx(mean(each), abs=1e-9)
    curve = {(r.g, r.day): r.brier for r in found.collect()}
    for row in survival.integrated(found, ["g"]).collect():
        want = sum(20 * (curve[row.g, a] + curve[row.g, b]) / 2 for a, b in ((10, 30), (30, 50))) / 40
        assert row.integrated_brier == pytest.approx(want, abs=1e-6)


def test_concordance(lives):
    data, frame = lives
    got = evaluate.concordance(frame, "t", "e", "r", ["g"]).collect()
    for row in got:
        own = [x for x in data if x[0] == row.g]
        pairs = [(1 if b[5] < a[5] else 0.5 if b[5] == a[5] else 0) for a in own for b in own if a[2] and b[1] > a[1]]
        assert row.pairs == len(pairs) and row.c_index == pytest.approx(mean(pairs), abs=1e-6)


def test_bootstraps(spark, lives):
    _, frame = lives
    found = survival.bootstrap_mean(frame.withColumn("k", F.monotonically_increasing_id()), "e", F.col("k"), 50)
    values = [r.mean for r in found.collect()]
    true = frame.agg(F.avg("e")).first()[0]
    assert abs(mean(values) - true) < 0.02 and 0.005 < np.std(values) < 0.06
    per = spark.createDataFrame([(i, float(i % 4)) for i in range(20)], "c int, x double")
    means = [r.mean for r in survival.block_bootstrap(per, "x", "c", 3, 300).collect()]
    assert len(means) == 300 and abs(mean(means) - 1.5) < 0.1


def test_normal_cdf_and_peaks(spark):
    z = [-3.0, -1.0, -0.2, 0.0, 0.5, 2.0]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in z], "z double").select(shapes.normal_cdf(F.col("z"))).collect()]
    assert got == pytest.approx([0.5 * (1 + math.erf(v / math.sqrt(2))) for v in z], abs=1e-6)
    x = np.arange(60)
    n = (1000 * np.exp(-((x - 15) ** 2) / 18) + 400 * np.exp(-((x - 42) ** 2) / 18) + 5).astype(int)
    frame = spark.createDataFrame([("m", int(b), int(v)) for b, v in zip(x, n)], "g string, bin int, n long")
    assert sorted(r.bin for r in shapes.peaks(frame, ["g"]).collect()) == [15, 42]


def test_average_ranks(rows):
    data, frame = rows
    got = {r.i: r.rank for r in ranks.average_rank(frame, ["g"], "x", "rank").collect()}
    for own in groups(data).values():
        for x, i in own:
            assert got[i] == sum(v < x for v, _ in own) + (sum(v == x for v, _ in own) + 1) / 2


def test_baseline_survival_and_median(lives):
    """S(h) = exp(-H(h) exp(bx)), H being summed over the days with events; the median is the first day at a half or less."""
    data, frame = lives
    beta = np.array([0.4, -0.2])
    hazard = survival.baseline(frame, "t", "e", ["z", "w"], ["g"], beta)
    found = survival.median_survival(survival.horizon_risks(frame, hazard, ["z", "w"], ["g"], beta, (0, 7, 30)), hazard, ["z", "w"], ["g"], beta).collect()
    steps = {}
    for g in "rs":
        own, total = [x for x in data if x[0] == g], 0.0
        steps[g] = {}
        for t in sorted({x[1] for x in own if x[2]}):
            total += sum(x[1] == t and x[2] for x in own) / sum(math.exp(np.dot(beta, x[3:5])) for x in own if x[1] >= t)
            steps[g][t] = total
    assert len(found) == len(data)
    for r in found:
        risk = math.exp(0.4 * r.z - 0.2 * r.w)
        for h in (0, 7, 30):
            last = max([v for t, v in steps[r.g].items() if t <= h], default=0.0)
            assert r[f"cox_p{h}"] == pytest.approx(1 - math.exp(-last * risk))
        assert r.median_days == min([t for t, v in steps[r.g].items() if math.exp(-v * risk) <= 0.5], default=None)


def test_penalties_shrink_and_the_best_is_chosen(lives):
    _, frame = lives
    path, best, beta = survival.penalty_path(frame, frame, "t", "e", ["z", "w"], ["g"], (0.0, 5.0))
    free, _ = survival.cox(frame, "t", "e", ["z", "w"], ["g"])
    bound, _ = survival.cox(frame, "t", "e", ["z", "w"], ["g"], 5.0)
    assert np.abs(bound).sum() < np.abs(free).sum() and [p for p, _ in path] == [0.0, 5.0]
    assert best == max(path, key=lambda x: x[1])[0] and np.allclose(beta, free if best == 0 else bound)


def test_proportional_hazards(lives):
    """Scaled residuals, their means by window and rank correlation, event by event."""
    data, frame = lives
    beta, cov = survival.cox(frame, "t", "e", ["z", "w"], ["g"])
    residuals, days = [], []
    for g, t, e, z, w, _ in data:
        if e:
            at_risk = np.array([(x[3], x[4]) for x in data if x[0] == g and x[1] >= t])
            p = np.exp(at_risk @ beta)
            residuals.append(np.array([z, w]) - p @ at_risk / p.sum())
            days.append(t)
    scaled, days = len(days) * np.array(residuals) @ cov, np.array(days)
    rank = lambda x: np.array([(x < v).sum() + ((x == v).sum() + 1) / 2 for v in x])
    for r in survival.proportional_hazards(frame, "t", "e", ["z", "w"], ["g"], beta, cov).collect():
        j = ["z", "w"].index(r.feature)
        assert r.events == len(days)
        seen = []
        for low, high, name in survival.PH_WINDOWS:
            own = scaled[(days > low) & (days <= high), j]
            assert r[name] == pytest.approx(own.mean() + beta[j], abs=1e-5) if len(own) else r[name] is None
            seen += [own.mean() + beta[j]] if len(own) else []
        assert r.rho == pytest.approx(np.corrcoef(rank(np.round(scaled[:, j], 9)), rank(days))[0, 1], abs=1e-3)
        big = [abs(b) for b in seen if abs(b) >= 0.05]
        want = "negligible" if not big else "sign changes" if max(seen) > 0.05 and min(seen) < -0.05 else "changes size" if max(big) / min(big) > 1.5 else "stable"
        assert r.verdict == want


def test_one_calibration(lives):
    data, frame = lives
    frame = frame.withColumn("p", 1 / (1 + F.exp(-F.col("z"))))
    row = survival.one_calibration(frame.withColumn("all", F.lit(1)), "t", "e", "p", 30, ["all"], 5).first()
    p = np.array([1 / (1 + math.exp(-x[3])) for x in data])
    edges = np.unique(np.quantile(p, np.linspace(0, 1, 6)))[1:-1]
    group = (p[:, None] > edges).sum(axis=1)
    statistic = gap = 0.0
    for k in range(5):
        own = [data[i] for i in np.flatnonzero(group == k)]
        observed, expected = 1 - at_day(brute_km([(x[1], x[2]) for x in own]), 30), p[group == k].mean()
        statistic += len(own) * (observed - expected) ** 2 / (expected * (1 - expected))
        gap += len(own) * abs(observed - expected) / len(data)
    assert (row.groups, row.statistic, row.mean_abs_gap) == (5, pytest.approx(statistic), pytest.approx(gap))


def test_chi_square_tail(spark):
    """Known points of the distribution."""
    points = [(3.841459, 1, 0.05), (5.991465, 2, 0.05), (16.918978, 9, 0.05), (21.665994, 9, 0.01), (18.307038, 10, 0.05), (0.0, 4, 1.0), (900.0, 9, 0.0)]
    got = [r.p for r in spark.createDataFrame(points, "x double, df int, want double").select(survival.chi2_tail(F.col("x"), F.col("df")).alias("p")).collect()]
    assert got == pytest.approx([w for *_, w in points], abs=1e-6)


def test_intervals_of_rank_statistics(spark):
    """Replica 0 is the rows themselves; the interval is that of resampling rows one by one."""
    rng = np.random.default_rng(11)
    score, label = rng.integers(0, 25, 600), None
    label = (rng.random(600) < 0.2 + score / 50).astype(int)

    def stats(s, y):
        order = np.argsort(-s, kind="stable")
        pos, neg = s[y == 1], s[y == 0]
        auc = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
        values, ap, above, tp = np.unique(s)[::-1], 0.0, 0, 0
        for v in values:
            hits = y[s == v].sum()
            above, tp = above + (s == v).sum(), tp + hits
            ap += hits * tp / above
        return auc, ap / y.sum(), y[order[: len(y) // 10]].mean()

    frame = spark.createDataFrame([("a", int(s), int(y)) for s, y in zip(score, label)], "g string, s int, y int")
    found = survival.bootstrap_ranks(frame, "s", "y", ["g"], 300)
    got = {r.statistic: r for r in survival.intervals(found, ["g"], ["auc", "average_precision", "top_precision"]).collect()}
    auc, ap, _ = stats(score, label)
    assert got["auc"].value == pytest.approx(auc) and got["average_precision"].value == pytest.approx(ap)
    draws = np.array([stats(score[i], label[i]) for i in rng.integers(0, 600, (400, 600))])
    for k, name in enumerate(("auc", "average_precision")):
        low, high = np.quantile(draws[:, k], [0.025, 0.975])
        assert got[name].low == pytest.approx(low, abs=0.012) and got[name].high == pytest.approx(high, abs=0.012)
    assert got["top_precision"].low < got["top_precision"].value < got["top_precision"].high


def test_horizon_chances_are_calibrated_and_do_not_fall(spark):
    rng = np.random.default_rng(12)
    p = rng.random(4000)
    rows = [(float(v), float(min(1, v * 1.1)), int(t), 1) for v, t in zip(p, np.where(rng.random(4000) < p**2, 3, 40))]
    frame = spark.createDataFrame(rows, "cox_p7 double, cox_p30 double, t int, e int")
    got = models.horizon_calibrated(frame, frame, "t", "e", (7, 30)).collect()
    assert all(r.p7 <= r.p30 for r in got)
    assert mean(r.p7 for r in got) == pytest.approx(mean(t <= 7 for *_, t, _ in rows), abs=0.01)
    assert max(abs(r.p7 - r.cox_p7**2) for r in got if 0.1 < r.cox_p7 < 0.9) < 0.12

import datetime as dt
import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from veriloom.functions import normal
from veriloom.operators import consensus, forecast
from veriloom.functions.moments import correlation
from veriloom.functions.student import two_sided_p
from veriloom.operators import series as ops


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    out = {"flat": rng.normal(50, 2, 60), "step": np.r_[rng.normal(10, 1, 40), rng.normal(30, 1, 40)],
           "season": 20 + 5 * np.sin(np.arange(72) * 2 * np.pi / 12) + rng.normal(0, .2, 72), "short": rng.normal(5, 1, 12)}
    return out


@pytest.fixture(scope="module")
def series(spark, data):
    rows = [(k, i, dt.date(2000 + i // 12, i % 12 + 1, 1), float(v)) for k, vs in data.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "series string, idx int, date date, value double").cache()


def test_change_points_equal_brute_force(series, data):
    got = {r["series"]: r["change_points"] for r in ops.change_points(series).collect()}
    for k, v in data.items():
        n, hits = len(v), []
        crit = critical(n - 2, 0.01)
        for i in range(10, n - 10):
            a, b = v[:i], v[i:]
            pooled = (((a - a.mean()) ** 2).sum() + ((b - b.mean()) ** 2).sum()) / (n - 2)
            if abs(a.mean() - b.mean()) / math.sqrt(pooled * (1 / len(a) + 1 / len(b))) > crit:
                hits.append(i)
        kept = []
        for i in hits:
            if not kept or i - kept[-1] >= 10:
                kept.append(i)
        assert got[k] == kept, k
    assert got["step"] and got["short"] == []


def tail(t, dof):
    """Two-sided, by quadrature."""
    c = math.exp(math.lgamma((dof + 1) / 2) - math.lgamma(dof / 2)) / math.sqrt(dof * math.pi)
    x, w = np.polynomial.legendre.leggauss(300)
    x = (x + 1) / 2 * t
    return 1 - t * float((w * c * (1 + x * x / dof) ** (-(dof + 1) / 2)).sum())


def critical(dof, alpha):
    lo, hi = 0.0, 100.0
    for _ in range(80):
        lo, hi = ((lo + hi) / 2, hi) if tail((lo + hi) / 2, dof) > alpha else (lo, (lo + hi) / 2)
    return lo


def test_p_values(spark):
    rows = [(t, float(dof)) for t in (0.0, 0.3, 1.0, 2.6403, 8.0) for dof in (1, 2, 10, 78, 1000, 36525)]
    got = spark.createDataFrame(rows, "t double, dof double").withColumn("p", two_sided_p(F.col("t"), F.col("dof"))).collect()
    assert all(r.p == pytest.approx(tail(r.t, r.dof), abs=1e-10) for r in got)
    edge = spark.createDataFrame([(float("inf"), 5.0), (1.0, 0.0)], "t double, dof double").select(two_sided_p(F.col("t"), F.col("dof"))).collect()
    assert [r[0] for r in edge] == [0.0, None]


def test_correlation_keeps_digits_and_survives_flat_sides(spark):
    x, y = [1e9 + i % 3 for i in range(900)], [1e9 - i % 3 + i % 2 for i in range(900)]
    df = spark.createDataFrame([(a, b, 5.1, None if i % 7 else a) for i, (a, b) in enumerate(zip(x, y))], "x double, y double, flat double, few double").repartition(7)
    r = df.agg(correlation("x", "y").alias("a"), correlation("x", "flat").alias("b"), correlation("few", "y").alias("c")).first()
    assert r.a == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-8) and r.b is None
    assert r.c == pytest.approx(np.corrcoef(x[::7], y[::7])[0, 1], abs=1e-8)
    assert df.where("x < 0").agg(correlation("x", "y")).first()[0] is None


@pytest.mark.parametrize("w", [5, 12])
def test_moving_average_equals_numpy(series, data, w):
    got = {}
    for r in ops.moving_average(series, w).collect():
        got.setdefault(r["series"], {})[r["idx"]] = r["trend"]
    for k, v in data.items():
        want = np.convolve(v, np.ones(w) / w, mode="same")
        for i in range(w // 2):
            want[i] = v[:i + 1].mean()
            want[-(i + 1)] = v[-(i + 1):].mean()
        assert [got[k][i] for i in range(len(v))] == pytest.approx(list(want)), k


def test_autocorrelation_and_season(series, data):
    acf = {}
    for r in ops.autocorrelation(series).collect():
        acf.setdefault(r["series"], {})[r["lag"]] = r["acf"]
    for k, v in data.items():
        d = v - v.mean()
        full = np.correlate(d, d, mode="full")[len(v) - 1:] / (d @ d)
        assert [acf[k][i] for i in range(min(51, len(v)))] == pytest.approx(list(full[:51])), k
    peaks = [r["period"] for r in ops.seasonality(series).where("series = 'season'").orderBy("rank").collect()]
    assert peaks[0] == 12
    parts = ops.decompose(series).where("series = 'season'").collect()
    assert all(r["value"] == pytest.approx(r["trend"] + r["seasonal"] + r["residual"]) for r in parts)


def test_kendall_and_spearman_with_ties(spark):
    rng = np.random.default_rng(1)
    x, y = rng.integers(0, 8, 70).astype(float), rng.integers(0, 6, 70).astype(float)
    df = spark.createDataFrame([("a", "b", i, float(p), float(q)) for i, (p, q) in enumerate(zip(x, y))], "target string, candidate string, position int, x double, y double")
    s = tx = ty = 0
    for i, j in itertools.combinations(range(70), 2):
        s += np.sign(x[i] - x[j]) * np.sign(y[i] - y[j])
        tx += x[i] != x[j]
        ty += y[i] != y[j]
    assert ops.correlation(df, "kendall").first()["correlation"] == pytest.approx(s / math.sqrt(tx * ty))
    rank = lambda v: np.array([(v < a).sum() + ((v == a).sum() + 1) / 2 for a in v])
    assert ops.correlation(df, "spearman").first()["correlation"] == pytest.approx(np.corrcoef(rank(x), rank(y))[0, 1])
    same = df.withColumn("y", F.col("x"))
    assert ops.correlation(same, "kendall").first()["correlation"] == pytest.approx(1.0)


def test_polynomials_equal_numpy(series, data):
    for degree in (1, 2, 3):
        got = {}
        for r in ops.polynomial_trend(series, degree).collect():
            got.setdefault(r["series"], {})[r["idx"]] = r["trend"]
        for k, v in data.items():
            i = np.arange(len(v))
            assert [got[k][j] for j in i] == pytest.approx(list(np.polyval(np.polyfit(i, v, degree), i))), (k, degree)


def test_bayes_lies_between_prior_and_data(series):
    for r in forecast.bayes(series, "2010-01-01", "2010-02-01", prior=(0.0, 1.0)).collect():
        assert r["point_estimate"] > 0
    wide = {r["indicator"]: r["point_estimate"] for r in forecast.bayes(series, "2010-01-01", "2010-02-01").collect()}
    mean = {r["series"]: r["m"] for r in series.groupBy("series").agg(F.avg("value").alias("m")).collect()}
    assert all(wide[k] == pytest.approx(mean[k]) for k in mean)


def test_normal_expressions(spark):
    zs = [-4.0, -1.0, 0.0, 0.3, 2.5]
    df = spark.createDataFrame([(z,) for z in zs], "z double")
    got = df.select(normal.cdf(F.col("z")).alias("p"), normal.crps(F.lit(1.0), F.lit(2.0), F.col("z")).alias("c")).collect()
    assert [r["p"] for r in got] == pytest.approx([0.5 * (1 + math.erf(z / math.sqrt(2))) for z in zs], abs=2e-7)
    x = np.linspace(-30, 30, 200_001)
    cdf = np.array([0.5 * (1 + math.erf((v - 1) / 2 / math.sqrt(2))) for v in x])
    for z, r in zip(zs, got):
        assert r["c"] == pytest.approx(float((((cdf - (x >= z)) ** 2).sum()) * (x[1] - x[0])), abs=1e-3)


def experts(spark):
    rows = zip("abcde", ("expert", "master", "expert", "intermediate", "expert"), (.15, .12, .18, .22, .16), (2.8, 3.2, 2.5, 3.0, 2.9), (.4, .5, .6, .7, .4))
    return spark.createDataFrame([(e, lv, m, x, s, "gdp", dt.date(2024, 1, 1)) for e, lv, m, x, s in rows],
                                 "expert_id string, expertise_level string, mae double, point_estimate double, std double, indicator string, target_date date")


def test_consensus_methods(spark):
    e = experts(spark)
    assert consensus.simple(e).first()["consensus"] == pytest.approx(2.88)
    mid = consensus.median(e).first()
    assert mid["consensus"] == pytest.approx(2.9) and mid["consensus_std"] == pytest.approx(0.1 * 1.4826)
    equal = consensus.weighted(e.withColumn("weight", F.lit(3.0))).first()
    assert equal["consensus"] == pytest.approx(2.88)
    cut = consensus.trimmed(e, 0.2).first()
    assert cut["consensus"] == pytest.approx(np.mean([2.8, 2.9, 3.0])) and cut["consensus_std"] == pytest.approx(np.std([2.8, 2.9, 3.0]))
    w = 1 / (np.array([.15, .12, .18, .22, .16]) + .1)
    assert consensus.performance_weighted(e).first()["consensus"] == pytest.approx((w * [2.8, 3.2, 2.5, 3.0, 2.9]).sum() / w.sum())
    with pytest.raises(ValueError):
        consensus.build(e, "guess")
    weights = {r["expert_id"]: r["w"] for r in e.withColumn("w", consensus.weight(F.col("expertise_level"), F.col("mae"), F.lit(0.9))).collect()}
    assert weights["b"] == pytest.approx(2.0 / 0.12 * 0.9)


def test_ensemble_is_the_mixture(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0, 1.0), ("a", 5.0, 1.0, 3.0)], "indicator string, point_estimate double, std double, weight double")
    r = forecast.ensemble(df).first()
    rng = np.random.default_rng(0)
    draws = np.where(rng.random(400_000) < 0.25, rng.normal(1, 2, 400_000), rng.normal(5, 1, 400_000))
    assert r["point_estimate"] == pytest.approx(4.0) and r["std"] == pytest.approx(draws.std(), rel=0.01)


def test_accuracy_needs_enough_forecasts(spark):
    rows = [(f"f{i}", "x" if i < 5 else "y", dt.date(2024, 1, 1), dt.date(2024, 2, 1), 10.0, 1.0) for i in range(9)]
    f = spark.createDataFrame(rows, "forecast_id string, indicator string, forecast_date date, target_date date, point_estimate double, std double")
    a = spark.createDataFrame([(f"f{i}", 12.0) for i in range(9)], "forecast_id string, actual double")
    got = forecast.accuracy(forecast.errors(f, a)).collect()
    assert [(r["indicator"], r["mae"], r["mean_bias"], r["median_absolute_error"], r["directional_accuracy"]) for r in got] == [("x", 2.0, 2.0, 2.0, 100.0)]

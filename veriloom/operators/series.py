"""Time-series features, many series in parallel.

A series frame holds (series, idx, date, value): one row per series and calendar period, idx dense from 0. It
comes out of an aggregation over the raw rows, so a series' length is bounded by the calendar (a century of days
is 36 525 rows) however large the input; windows and arrays per series rest on that bound. What grows with the
data is the number of raw rows and of series, and both spread over tasks.
"""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import WindowSpec
from pyspark.sql import functions as F

from veriloom.functions.moments import correlation as correlation_of
from veriloom.functions.parse import safe_ratio
from veriloom.functions.student import two_sided_p


def by_series() -> WindowSpec:
    return W.partitionBy("series")


def in_order() -> WindowSpec:
    return by_series().orderBy("idx")


def dense_index(df: DataFrame) -> DataFrame:
    """Number each series' periods 0, 1, ... by date."""
    return df.withColumn("idx", (F.row_number().over(by_series().orderBy("date")) - 1).cast("int")).select("series", "idx", "date", "value")


def select_series(series: DataFrame, keys, start: str, end: str) -> DataFrame:
    return series.where(F.col("series").isin(*keys) & F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def latest_value(series: DataFrame) -> DataFrame:
    return series.groupBy("series").agg(F.max("date").alias("date"), F.max_by("value", "date").alias("value"))


def asof_lookup(series: DataFrame, targets: DataFrame) -> DataFrame:
    """Last value on or before each target date; NULL before the first. ``targets``: (series, target_date, ...).

    Only distinct target dates enter the window, so many requests for one series stay spread out.
    """
    asked = targets.select("series", F.col("target_date").alias("date")).distinct().withColumn("_ask", F.lit(True))
    known = series.select("series", "date", F.col("value").alias("_v"))
    w = by_series().orderBy("date", F.col("_ask").asc_nulls_first()).rowsBetween(W.unboundedPreceding, 0)
    both = known.unionByName(asked, allowMissingColumns=True).withColumn("value", F.last("_v", ignorenulls=True).over(w))
    found = both.where("_ask").select("series", F.col("date").alias("target_date"), "value")
    return targets.join(found, ["series", "target_date"], "left")


def growth_rate(series: DataFrame, periods: int = 1) -> DataFrame:
    """Percent change against ``periods`` periods earlier; 12 gives year over year on monthly data."""
    before = F.lag("value", periods).over(in_order())
    return (series.withColumn("_b", before).where(F.col("_b").isNotNull())
            .withColumn("growth", F.try_divide(F.col("value") - F.col("_b"), F.col("_b")) * 100).drop("_b"))


def stats(series: DataFrame) -> DataFrame:
    v = F.col("value")
    df = series.groupBy("series").agg(
        F.avg(v).alias("mean"), F.percentile(v, 0.5).alias("median"), F.stddev_pop(v).alias("std"), F.min(v).alias("min"),
        F.max(v).alias("max"), (F.max(v) - F.min(v)).alias("range"), F.skewness(v).alias("skewness"), F.kurtosis(v).alias("kurtosis"))
    return df.withColumn("cv", safe_ratio(F.col("std"), F.col("mean")))


def trend(series: DataFrame) -> DataFrame:
    """Least-squares line, its fit, and the line over the last quarter. A series without spread has no trend: strength 0."""
    df = series.withColumn("_n", F.count("*").over(by_series()))
    late = F.col("idx") >= F.floor(F.col("_n") * 0.75)
    x, y = F.col("idx").cast("double"), F.col("value")
    out = df.groupBy("series").agg(
        F.regr_slope(y, x).alias("trend_slope"), F.regr_intercept(y, x).alias("trend_intercept"), F.coalesce(F.pow(correlation_of(x, y), 2), F.lit(0.0)).alias("trend_r_squared"),
        F.regr_slope(F.when(late, y), F.when(late, x)).alias("recent_trend_slope"))
    return out.withColumns({
        "trend_strength": F.col("trend_r_squared"), "trend_direction": F.when(F.col("trend_slope") > 0, 1.0).otherwise(-1.0),
        "trend_acceleration": F.col("recent_trend_slope") - F.col("trend_slope")})


def polynomial_trend(series: DataFrame, degree: int = 2) -> DataFrame:
    """Least-squares polynomial per series. Degrees 1 and 2 are closed forms in sums over the centred index, whose
    odd moments vanish because it is dense; higher degrees solve the small system per series in pandas."""
    if degree > 2:
        def fit(pdf: pd.DataFrame) -> pd.DataFrame:
            c = np.polyfit(pdf["idx"], pdf["value"], degree)
            return pdf.assign(trend=np.polyval(c, pdf["idx"]))[["series", "idx", "trend"]]
        return series.groupBy("series").applyInPandas(fit, "series string, idx int, trend double")
    n = F.count("*").over(by_series())
    df = series.withColumn("_u", F.col("idx") - (n - 1) / 2)
    u, v = F.col("_u"), F.col("value")
    sums = df.groupBy("series").agg(F.count("*").alias("n"), F.sum(u * u).alias("s2"), F.sum(u * u * u * u).alias("s4"),
                                    F.sum(v).alias("t0"), F.sum(u * v).alias("t1"), F.sum(u * u * v).alias("t2"))
    n, s2, s4, t0, t2 = (F.col(c) for c in ("n", "s2", "s4", "t0", "t2"))
    curve = F.coalesce(F.try_divide(n * t2 - s2 * t0, n * s4 - s2 * s2), F.lit(0.0)) if degree == 2 else F.lit(0.0)
    coef = sums.withColumn("_c", curve).select(
        "series", "_c", F.coalesce(F.try_divide(F.col("t1"), s2), F.lit(0.0)).alias("_b"), ((t0 - F.col("_c") * s2) / n).alias("_a"))
    return df.join(coef, "series").select("series", "idx", (F.col("_a") + F.col("_b") * u + F.col("_c") * u * u).alias("trend"))


def returns(series: DataFrame) -> DataFrame:
    """(series, r_idx, r): relative change, numbered from 0; NULL after a 0."""
    before = F.lag("value").over(in_order())
    return (series.withColumn("_b", before).where(F.col("_b").isNotNull())
            .select("series", (F.col("idx") - 1).alias("r_idx"), F.try_divide(F.col("value") - F.col("_b"), F.col("_b")).alias("r")))


def max_drawdown(series: DataFrame) -> DataFrame:
    """Deepest fall below the running maximum, as a (negative) share of it; a maximum of 0 so far is passed over."""
    top = F.max("value").over(in_order().rowsBetween(W.unboundedPreceding, 0))
    return (series.withColumn("_top", top).groupBy("series")
            .agg(F.min(F.try_divide(F.col("value") - F.col("_top"), F.col("_top"))).alias("max_drawdown")))


def volatility(series: DataFrame) -> DataFrame:
    order = by_series().orderBy("r_idx")
    df = returns(series).withColumns({
        "_n": F.count("*").over(by_series()), "_s12": F.stddev_pop("r").over(order.rowsBetween(-12, -1))})
    r, n = F.col("r"), F.col("_n")
    last = F.col("r_idx") >= n - F.least(F.lit(12), n - 1)
    out = df.groupBy("series").agg(
        F.stddev_pop(r).alias("volatility"),
        F.coalesce(F.stddev_pop(F.when((n > 1) & last, r)), F.lit(0.0)).alias("rolling_volatility"),
        F.coalesce(F.stddev_pop(F.when((n > 24) & (F.col("r_idx") >= 12), F.col("_s12"))), F.lit(0.0)).alias("volatility_of_volatility"),
        F.coalesce(F.stddev_pop(F.when(r > 0, r)), F.lit(0.0)).alias("upside_volatility"),
        F.coalesce(F.stddev_pop(F.when(r < 0, r)), F.lit(0.0)).alias("downside_volatility"))
    return out.join(max_drawdown(series), "series")


def momentum(series: DataFrame) -> DataFrame:
    """Rates of change over 1, 3 and 12 periods at the last observation, short against long average, place in the range."""
    v = F.col("value")

    def roc(k: int) -> Column:
        before = F.lag("value", k).over(in_order())
        return F.coalesce(F.try_divide(v - before, before), F.lit(0.0))

    n = F.count("*").over(by_series())
    short = F.when(n >= 3, F.avg("value").over(in_order().rowsBetween(-2, 0))).otherwise(v)
    long = F.avg("value").over(in_order().rowsBetween(-11, 0))
    low, high = F.min("value").over(by_series()), F.max("value").over(by_series())
    df = series.select(
        "series", "idx", n.alias("_n"), roc(1).alias("roc_1_period"), roc(3).alias("roc_3_period"), roc(12).alias("roc_12_period"),
        (short - long).alias("ma_crossover"), F.coalesce(F.try_divide(v - low, high - low), F.lit(0.5)).alias("relative_position"))
    score = (F.col("roc_1_period") + F.col("roc_3_period") + F.col("roc_12_period")) / 3
    return df.where(F.col("idx") == F.col("_n") - 1).withColumn("momentum_score", score).drop("idx", "_n")


def moving_average(series: DataFrame, w: int = 12) -> DataFrame:
    """Centred moving average (w/2 before, the rest after); within w/2 of an end, the mean from that end."""
    half = w // 2
    n = F.count("*").over(by_series())
    idx = F.col("idx")
    head = F.avg("value").over(in_order().rowsBetween(W.unboundedPreceding, 0))
    tail = F.avg("value").over(in_order().rowsBetween(0, W.unboundedFollowing))
    mid = F.avg("value").over(in_order().rowsBetween(-half, (w - 1) // 2))
    return series.withColumn("_n", n).withColumn(
        "trend", F.when(idx >= F.col("_n") - half, tail).when(idx < half, head).otherwise(mid)).drop("_n")


def seasonal_component(series: DataFrame, period: int | None = None, periods: DataFrame | None = None, value: str = "value") -> DataFrame:
    """Mean by place in the period, centred on zero. One period for all, or ``periods`` (series, period)."""
    df = series.withColumn("period", F.lit(period)) if period is not None else series.join(periods, "series")
    placed = df.withColumn("_k", F.col("idx") % F.col("period"))
    means = placed.groupBy("series", "_k").agg(F.avg(value).alias("_m"))
    centred = means.withColumn("seasonal", F.col("_m") - F.avg("_m").over(by_series())).drop("_m")
    return placed.join(centred, ["series", "_k"]).drop("_k")


def decompose(series: DataFrame, period: int | None = None, detrended: bool = False) -> DataFrame:
    """Trend (12-period average), seasonal part (given or first detected period; none found: NULL), residual.

    The seasonal part is taken from the raw values unless ``detrended``.
    """
    trended = moving_average(series, 12).withColumn("_x", F.col("value") - F.col("trend") if detrended else F.col("value"))
    if period is None:
        first = seasonality(series).groupBy("series").agg(F.min_by("period", "rank").alias("period"))
        seasonal = seasonal_component(trended, periods=first, value="_x")
    else:
        seasonal = seasonal_component(trended, period, value="_x")
    joined = trended.drop("_x").join(seasonal.select("series", "idx", "seasonal"), ["series", "idx"], "left")
    return joined.withColumn("residual", F.col("value") - F.col("trend") - F.coalesce("seasonal", F.lit(0.0)))


def autocorrelation(series: DataFrame, max_lag: int = 50) -> DataFrame:
    """(series, lag, acf) for lags 0 to min(max_lag, n-1). All lags come from one sorted pass per series: no
    self-join, no row multiplication."""
    df = series.withColumns({"_d": F.col("value") - F.avg("value").over(by_series())})
    lagged = df.select("series", "_d", *[F.lag("_d", k).over(in_order()).alias(f"_l{k}") for k in range(1, max_lag + 1)])
    sums = lagged.groupBy("series").agg(
        F.count("*").alias("_n"), F.sum(F.col("_d") * F.col("_d")).alias("_s0"),
        *[F.sum(F.col("_d") * F.col(f"_l{k}")).alias(f"_s{k}") for k in range(1, max_lag + 1)])
    rows = F.array(*[F.struct(F.lit(k).alias("lag"), F.try_divide(F.col(f"_s{k}"), F.col("_s0")).alias("acf")) for k in range(max_lag + 1)])
    return sums.select("series", "_n", F.inline(rows)).where(F.col("lag") < F.col("_n")).drop("_n")


def seasonality(series: DataFrame, max_lag: int = 50, height: float = 0.3, n: int = 3) -> DataFrame:
    """(series, rank, period, strength): the first n interior peaks of the autocorrelation at or above ``height``."""
    w = by_series().orderBy("lag")
    around = autocorrelation(series, max_lag).where("lag >= 1").withColumns({
        "_p": F.lag("acf").over(w), "_q": F.lead("acf").over(w)})
    peaks = around.where((F.col("acf") > F.col("_p")) & (F.col("acf") > F.col("_q")) & (F.col("acf") >= height))
    return (peaks.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
            .select("series", "rank", F.col("lag").alias("period"), F.col("acf").alias("strength")))


def change_points(series: DataFrame, min_segment: int = 10, alpha: float = 0.01) -> DataFrame:
    """(series, change_points): splits where the means before and after differ by a pooled t-test, thinned from
    the left to at least ``min_segment`` apart. Prefix sums give every split's test in one pass."""
    w = in_order().rowsBetween(W.unboundedPreceding, -1)
    shifted = series.withColumn("_x", F.col("value") - F.avg("value").over(by_series()))  # centring keeps the squares small
    df = shifted.select("series", "idx", F.count("*").over(by_series()).alias("n"), F.sum("_x").over(by_series()).alias("s"),
                        F.sum(F.col("_x") * F.col("_x")).over(by_series()).alias("q"), F.sum("_x").over(w).alias("s1"),
                        F.sum(F.col("_x") * F.col("_x")).over(w).alias("q1"))
    df = df.where((F.col("n") >= 2 * min_segment) & (F.col("idx") >= min_segment) & (F.col("idx") < F.col("n") - min_segment))
    n1, n2 = F.col("idx"), F.col("n") - F.col("idx")
    s1, s2 = F.col("s1"), F.col("s") - F.col("s1")
    within = (F.col("q1") - s1 * s1 / n1) + (F.col("q") - F.col("q1") - s2 * s2 / n2)
    pooled = within / (F.col("n") - 2)
    gap, noise = F.abs(s1 / n1 - s2 / n2), F.sqrt(F.greatest(pooled, F.lit(0.0)) * (1 / n1 + 1 / n2))
    t = F.when(noise > 0, F.try_divide(gap, noise)).when(gap > 0, F.lit(float("inf"))).otherwise(F.lit(0.0))  # no spread and equal means: no split
    hits = df.withColumn("t", t).where(F.col("t") > NormalDist().inv_cdf(1 - alpha / 2))  # Student's tails are the heavier ones
    hits = hits.where(two_sided_p(F.col("t"), F.col("n") - 2) < alpha)
    found = hits.groupBy("series").agg(F.sort_array(F.collect_list("idx")).alias("_all"))
    thinned = F.aggregate("_all", F.array().cast("array<int>"), lambda acc, i: F.when(
        (F.size(acc) == 0) | (i - F.try_element_at(acc, F.lit(-1)) >= min_segment), F.array_append(acc, i)).otherwise(acc))
    names = series.select("series").distinct()
    return names.join(found.select("series", thinned.alias("change_points")), "series", "left").withColumn(
        "change_points", F.coalesce("change_points", F.array().cast("array<int>")))


# ---- pairs of series --------------------------------------------------------------------------------

def align(a: DataFrame, b: DataFrame, pairs: DataFrame, on: str = "date") -> DataFrame:
    """(target, candidate, position, x, y) for the listed pairs of series, matched by date or by idx."""
    left = a.select(F.col("series").alias("target"), F.col(on).alias("position"), F.col("value").alias("x"))
    right = b.select(F.col("series").alias("candidate"), F.col(on).alias("position"), F.col("value").alias("y"))
    return pairs.join(left, "target").join(right, ["candidate", "position"]).select("target", "candidate", "position", "x", "y")


def by_pair() -> WindowSpec:
    return W.partitionBy("target", "candidate")


def _average_rank(column: str) -> Column:
    """Rank with ties sharing their mean place."""
    return F.rank().over(by_pair().orderBy(column)) + (F.count("*").over(W.partitionBy("target", "candidate", column)) - 1) / 2


def correlation(aligned: DataFrame, method: str = "pearson") -> DataFrame:
    """(target, candidate, n, correlation) by pearson, spearman or kendall (tau-b)."""
    keys = ["target", "candidate"]
    if method == "pearson":
        return aligned.groupBy(*keys).agg(F.count("*").alias("n"), correlation_of("x", "y").alias("correlation"))
    if method == "spearman":
        ranks = aligned.select(*keys, _average_rank("x").alias("x"), _average_rank("y").alias("y"))
        return ranks.groupBy(*keys).agg(F.count("*").alias("n"), correlation_of("x", "y").alias("correlation"))
    if method == "kendall":
        return _kendall(aligned)
    raise ValueError(f"unknown method {method}")


def _kendall(aligned: DataFrame) -> DataFrame:
    """Tau-b in n log n rows, without forming pairs of observations.

    In (x, y) order the discordant pairs are the inversions of y. Each inversion is counted at the highest bit
    in which the two dense ranks of y differ: within equal higher bits, a 1 standing before a 0.
    """
    keys = ["target", "candidate"]
    ranked = aligned.select(*keys, "x", "y", F.row_number().over(by_pair().orderBy("x", "y")).alias("place"),
                            (F.dense_rank().over(by_pair().orderBy("y")) - 1).alias("ry"))
    levels = ranked.withColumn("_top", F.max("ry").over(by_pair()))
    bits = F.sequence(F.lit(0), F.floor(F.log2(F.greatest("_top", F.lit(1)))).cast("int"))
    spread = levels.select(*keys, "place", "ry", F.explode(bits).alias("bit"))
    one = spread.select(*keys, "bit", "place", F.expr("shiftright(ry, bit + 1)").alias("high"), F.expr("shiftright(ry, bit) & 1").alias("is_one"))
    before = F.sum("is_one").over(W.partitionBy(*keys, "bit", "high").orderBy("place").rowsBetween(W.unboundedPreceding, -1))
    swaps = one.withColumn("_b", F.coalesce(before, F.lit(0))).groupBy(*keys).agg(
        F.sum(F.when(F.col("is_one") == 0, F.col("_b")).otherwise(0)).alias("d"))

    def ties(*cols: str) -> DataFrame:
        name = "t" + "".join(cols)
        g = aligned.groupBy(*keys, *cols).agg(F.count("*").alias("c"))
        return g.groupBy(*keys).agg(F.sum(F.col("c") * (F.col("c") - 1) / 2).alias(name))

    size = aligned.groupBy(*keys).agg(F.count("*").alias("n"))
    j = size.join(swaps, keys).join(ties("x"), keys).join(ties("y"), keys).join(ties("x", "y"), keys)
    n0 = F.col("n") * (F.col("n") - 1) / 2
    net = n0 - F.col("tx") - F.col("ty") + F.col("txy") - 2 * F.col("d")
    tau = F.try_divide(net, F.sqrt((n0 - F.col("tx")) * (n0 - F.col("ty"))))
    return j.select(*keys, "n", tau.alias("correlation"))


def lagged_pairs(targets: DataFrame, candidates: DataFrame, pairs: DataFrame, max_lag: int = 12) -> DataFrame:
    """(target, candidate, lag, idx, x, y): target at t beside candidate at t - lag, for lags 0 to max_lag."""
    early = candidates.select("series", "value", (F.col("idx")).alias("_i"), F.explode(F.sequence(F.lit(0), F.lit(max_lag))).alias("lag"))
    right = early.select(F.col("series").alias("candidate"), "lag", (F.col("_i") + F.col("lag")).alias("idx"), F.col("value").alias("y"))
    left = targets.select(F.col("series").alias("target"), "idx", F.col("value").alias("x"))
    return pairs.join(left, "target").join(right, ["candidate", "idx"]).select("target", "candidate", "lag", "idx", "x", "y")


def lagged_correlation(lagged: DataFrame, min_pairs: int = 11) -> DataFrame:
    return (lagged.groupBy("target", "candidate", "lag").agg(F.count("*").alias("n"), correlation_of("x", "y").alias("correlation"))
            .where(F.col("n") >= min_pairs))


def leading_indicators(lagged_corr: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Per candidate the lag of largest absolute correlation (the shorter on ties), if it reaches the threshold."""
    strength = F.struct(F.abs("correlation").alias("a"), (-F.col("lag")).alias("b"))
    best = lagged_corr.groupBy("target", "candidate").agg(F.max_by(F.struct("lag", "correlation"), strength).alias("b"))
    return (best.select("target", "candidate", F.col("b.lag").alias("lag"), F.col("b.correlation").alias("correlation"))
            .where(F.abs("correlation") >= threshold).orderBy(F.abs("correlation").desc(), "candidate"))


def quality(series: DataFrame, as_of: str) -> DataFrame:
    """Completeness, outliers beyond three deviations, age in days, and a grade from the number of issues."""
    df = series.withColumns({"_m": F.avg("value").over(by_series()), "_s": F.stddev_pop("value").over(by_series())})
    odd = F.abs(F.try_divide(F.col("value") - F.col("_m"), F.col("_s"))) > 3
    out = df.groupBy("series").agg(
        F.count("*").alias("n_observations"), F.count_if(F.col("value").isNull()).alias("n_missing"), F.count_if(odd).alias("n_outliers"),
        F.datediff(F.lit(as_of).cast("date"), F.max("date")).alias("days_since_update"))
    issues = F.array_compact(F.array(
        F.when(F.col("n_missing") > 0, F.concat(F.col("n_missing").cast("string"), F.lit(" missing observations"))),
        F.when(F.col("n_outliers") > 0, F.concat(F.col("n_outliers").cast("string"), F.lit(" potential outliers detected"))),
        F.when(F.col("days_since_update") > 60, F.concat(F.lit("Data is "), F.col("days_since_update").cast("string"), F.lit(" days old")))))
    return out.withColumns({
        "completeness": F.lit(1.0) - F.col("n_missing") / F.col("n_observations"), "issues": issues,
        "overall_quality": F.when(F.size(issues) == 0, "high").when(F.size(issues) <= 2, "medium").otherwise("low")})


def backtest(series: DataFrame, train_window: int, horizon: int, step: int = 1) -> DataFrame:
    """Rolling origin: the mean of the 12 values before the origin against the value ``horizon`` periods on."""
    past = F.avg("value").over(in_order().rowsBetween(-12, -1))
    df = series.select(
        "series", "idx", F.col("date").alias("forecast_date"), past.alias("forecast_value"), F.lead("value", horizon).over(in_order()).alias("actual_value"),
        F.lead("date", horizon).over(in_order()).alias("target_date"))
    kept = df.where((F.col("idx") >= train_window) & ((F.col("idx") - train_window) % step == 0) & F.col("actual_value").isNotNull())
    e = F.col("actual_value") - F.col("forecast_value")
    return kept.withColumns({
        "error": e, "absolute_error": F.abs(e), "squared_error": e * e,
        "percentage_error": F.when(F.col("actual_value") == 0, 0.0).otherwise(e / F.col("actual_value") * 100), "horizon_periods": F.lit(horizon)})


def analyze(series: DataFrame, related: DataFrame | None = None, pairs: DataFrame | None = None) -> DataFrame:
    """All features of a series in one row; with ``related`` series and ``pairs`` also the strongest leads. Every family of features
    reads the series anew: pass stored ones."""
    peaks = seasonality(series).groupBy("series").agg(
        F.sort_array(F.collect_list(F.struct("rank", "period", "strength"))).alias("seasonal_periods"))
    out = stats(series).join(trend(series), "series").join(volatility(series), "series").join(momentum(series), "series")
    out = out.join(change_points(series), "series", "left").join(peaks, "series", "left").withColumn(
        "has_seasonality", F.col("seasonal_periods").isNotNull())
    if related is not None:
        corr = correlation(align(series, related, pairs)).select(
            F.col("target").alias("series"), F.struct("candidate", "correlation").alias("c"))
        corr = corr.groupBy("series").agg(F.sort_array(F.collect_list("c")).alias("correlations"))
        leads = leading_indicators(lagged_correlation(lagged_pairs(series, related, pairs)))
        leads = leads.groupBy(F.col("target").alias("series")).agg(
            F.sort_array(F.collect_list(F.struct("candidate", "lag", "correlation"))).alias("leading_indicators"))
        out = out.join(corr, "series", "left").join(leads, "series", "left")
    return out

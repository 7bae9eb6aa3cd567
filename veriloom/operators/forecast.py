"""Probabilistic forecasts in closed form, their evaluation, and documented reasoning.

Sampling is replaced by the distribution the samples follow, so two runs agree and a forecast costs a few
aggregates per series.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veriloom.functions import normal
from veriloom.functions.hashing import forecast_id
from veriloom.functions.parse import safe_ratio
from veriloom.operators.series import by_series, latest_value
from veriloom.operators.skew import exact_percentiles, same_keys
from veriloom.session import materialise

# fixed values: widening of the uncertainty by horizon
HORIZON_FACTORS = {"short_term": 1.0, "medium_term": 1.5, "long_term": 2.5, "very_long_term": 4.0}


def with_distribution(df: DataFrame, mean: str = "point_estimate", std: str = "std") -> DataFrame:
    """Quantile and interval maps of a normal forecast."""
    m, s = F.col(mean), F.col(std)
    return df.withColumns({"quantiles": normal.quantile_map(m, s), "intervals": normal.interval_map(m, s)})


def _forecast(df: DataFrame, as_of: str, target_date: str, horizon: str, methodology: str) -> DataFrame:
    made, target = F.lit(as_of).cast("date"), F.lit(target_date).cast("date")
    return df.select(
        forecast_id(F.col("series"), made, target).alias("forecast_id"), F.col("series").alias("indicator"), made.alias("forecast_date"),
        target.alias("target_date"), F.lit(horizon).alias("horizon"), "point_estimate", "std", F.lit(methodology).alias("methodology"),
        F.lit("1.0").alias("model_version"))


def bayes(series: DataFrame, as_of: str, target_date: str, horizon: str = "medium_term", prior: tuple[float, float] | None = None) -> DataFrame:
    """Conjugate normal update of a prior (default: the data's mean, ten deviations wide). A series without spread is certain: its mean,
    deviation 0."""
    s = series.groupBy("series").agg(F.avg("value").alias("m"), F.stddev_pop("value").alias("sd"), F.count("*").alias("n"))
    pm, ps = (F.lit(float(prior[0])), F.lit(float(prior[1]))) if prior else (F.col("m"), F.col("sd") * 10)
    a, b = F.try_divide(F.lit(1.0), ps * ps), F.try_divide(F.col("n"), F.col("sd") * F.col("sd"))
    s = s.withColumns({"point_estimate": F.coalesce((a * pm + b * F.col("m")) / (a + b), F.col("m")),
                       "std": F.coalesce(F.sqrt(F.try_divide(F.lit(1.0), a + b)), F.lit(0.0)) * F.lit(HORIZON_FACTORS.get(horizon, 2.0))})
    return _forecast(s, as_of, target_date, horizon, "Bayesian inference with conjugate prior")


def montecarlo(series: DataFrame, as_of: str, target_date: str, horizon: str = "medium_term") -> DataFrame:
    """Mean plus linear trend over the months ahead; the deviation grows with the root of the distance."""
    periods = F.datediff(F.lit(target_date).cast("date"), F.lit(as_of).cast("date")) / F.lit(30.0)
    s = series.groupBy("series").agg(F.avg("value").alias("m"), F.stddev_pop("value").alias("sd"),
                                     F.regr_slope("value", F.col("idx").cast("double")).alias("slope"))
    s = s.withColumns({"point_estimate": F.col("m") + F.col("slope") * periods, "std": F.col("sd") * F.sqrt(periods)})
    return _forecast(s, as_of, target_date, horizon, "Monte Carlo simulation")


def ensemble(components: DataFrame, keys: Sequence[str] = ("indicator",), weight: str = "weight") -> DataFrame:
    """Mixture of component forecasts: weights normalised per group, deviation of the mixture; NULL where all weights are 0."""
    w, m, s = F.col(weight), F.col("point_estimate"), F.col("std")
    g = components.groupBy(*keys).agg(F.sum(w).alias("_w"), F.sum(w * m).alias("_m"), F.sum(w * (s * s + m * m)).alias("_q"), F.count("*").alias("n_models"))
    mean = F.try_divide("_m", "_w")
    return g.select(*keys, "n_models", mean.alias("point_estimate"),
                    F.when(F.col("_w") != 0, F.sqrt(F.greatest(F.try_divide("_q", "_w") - mean * mean, F.lit(0.0)))).alias("std"))


def forecast_grouped(series: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """A user model per series: ``fn(pandas frame) -> pandas frame``. Series are calendar-bounded, so is a group."""
    return series.groupBy("series").applyInPandas(fn, schema)


def comparison(series: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Current value, forecast, percent change and 90 % bounds."""
    now = latest_value(series).select(F.col("series").alias("indicator"), F.col("value").alias("current_value"))
    lo, hi = normal.INTERVALS[0.90]
    m, s = F.col("point_estimate"), F.col("std")
    return forecasts.join(now, "indicator").select(
        "indicator", "current_value", m.alias("forecast"), F.try_divide(m - F.col("current_value"), F.col("current_value")).alias("_c"),
        (m + normal.Z[lo] * s).alias("lower_90"), (m + normal.Z[hi] * s).alias("upper_90")).withColumn("pct_change", F.col("_c") * 100).drop("_c")


def summary(forecasts: DataFrame) -> DataFrame:
    return forecasts.agg(F.count("*").alias("total_forecasts"), F.avg("std").alias("avg_uncertainty"), F.countDistinct("indicator").alias("n_indicators"))


def covered_indicators(forecasts: DataFrame) -> DataFrame:
    return forecasts.select("indicator").distinct()


def probability_above(forecasts: DataFrame, threshold: Column) -> DataFrame:
    p = normal.probability_above(threshold, F.col("point_estimate"), F.col("std"))
    return forecasts.withColumns({"p_above": p, "p_below": F.lit(1.0) - p})


# ---- evaluation -------------------------------------------------------------------------------------

LEVELS = (0.50, 0.80, 0.90, 0.95)


def errors(forecasts: DataFrame, actuals: DataFrame) -> DataFrame:
    """Forecasts with their outcome: error (actual - forecast), absolute, percent (0 if actual is 0), squared."""
    e = F.col("actual") - F.col("point_estimate")
    return forecasts.join(actuals, "forecast_id").withColumns({
        "error": e, "absolute_error": F.abs(e), "squared_error": e * e,
        "percentage_error": F.when(F.col("actual") == 0, 0.0).otherwise(e / F.col("actual") * 100),
        "horizon_days": F.datediff("target_date", "forecast_date")})


def accuracy(errs: DataFrame, by: Sequence[str] = ("indicator",), min_n: int = 5) -> DataFrame:
    """Error measures per group of at least ``min_n``. Direction compares the error's sign with the forecast's;
    a positive bias means under-prediction."""
    same = F.col("error") * F.col("point_estimate") >= 0
    g = errs.groupBy(*by).agg(
        F.avg("absolute_error").alias("mae"), F.sqrt(F.avg("squared_error")).alias("rmse"), F.avg(F.abs("percentage_error")).alias("mape"),
        (F.count_if(same) / F.count("*") * 100).alias("directional_accuracy"), F.count("*").alias("n_forecasts"), F.avg("error").alias("mean_bias"))
    med = exact_percentiles(errs, by, "absolute_error", {"median_absolute_error": 0.5})
    return same_keys(g.where(F.col("n_forecasts") >= min_n), med, list(by)) if by else g.where(F.col("n_forecasts") >= min_n).withColumn("median_absolute_error", med.scalar())


def _inside(level: float) -> tuple[Column, Column]:
    lo, hi = normal.INTERVALS[level]
    m, s = F.col("point_estimate"), F.col("std")
    lower, upper = m + normal.Z[lo] * s, m + normal.Z[hi] * s
    return F.col("actual").between(lower, upper), upper - lower


def coverage(errs: DataFrame, by: Sequence[str] = ("indicator",), levels=LEVELS, min_n: int = 20) -> DataFrame:
    """(group, level, actual_coverage, sharpness): share of outcomes inside each interval, and the mean width over
    all levels. One pass."""
    aggs = [F.count("*").alias("n")]
    for i, level in enumerate(levels):
        hit, width = _inside(level)
        aggs += [F.count_if(hit).alias(f"h{i}"), F.avg(width).alias(f"w{i}")]
    g = errs.groupBy(*by).agg(*aggs).where(F.col("n") >= min_n)
    sharp = sum((F.col(f"w{i}") for i in range(len(levels))), F.lit(0.0)) / len(levels)
    rows = F.array(*[F.struct(F.lit(level).alias("level"), (F.col(f"h{i}") / F.col("n")).alias("actual_coverage"), F.col(f"w{i}").alias("width"))
                     for i, level in enumerate(levels)])
    return g.select(*by, "n", sharp.alias("sharpness"), F.inline(rows))


def crps(errs: DataFrame, by: Sequence[str] = ("indicator",), min_n: int = 10) -> DataFrame:
    score = normal.crps(F.col("point_estimate"), F.col("std"), F.col("actual"))
    return errs.groupBy(*by).agg(F.count("*").alias("n"), F.avg(score).alias("crps")).where(F.col("n") >= min_n)


def methodology_ranking(errs: DataFrame, min_n: int = 5) -> DataFrame:
    """Accuracy per indicator and methodology, the least mean absolute error marked best."""
    acc = materialise(accuracy(errs, ("indicator", "methodology"), min_n), "accuracy")
    best = acc.groupBy("indicator").agg(F.min_by("methodology", F.struct("mae", "methodology")).alias("_b"))
    return acc.join(best, "indicator").withColumn("is_best", F.col("methodology") == F.col("_b")).drop("_b")


BIAS_SHARE, LEAST_DIRECTION, COVERAGE_GAP = 0.1, 60.0, 0.10


def recommendations(acc: DataFrame, cov: DataFrame) -> DataFrame:
    """(indicator, rule, level, value, threshold): every rule that an indicator breaks, with what was measured and the limit; one row
    ``none`` where it breaks none.

    under_prediction and over_prediction: the bias against a share of the mean error; direction: the share of right signs; narrow and wide:
    the coverage of a level too far below or above it.
    """
    def finding(rule: Column | str, level: Column, value: Column, threshold: Column) -> Column:
        return F.struct((F.lit(rule) if isinstance(rule, str) else rule).alias("rule"), level.cast("double").alias("level"),
                        value.cast("double").alias("value"), threshold.cast("double").alias("threshold"))

    none, bias, limit = F.lit(None), F.col("mean_bias"), F.col("mae") * BIAS_SHARE
    own = acc.select("indicator", F.explode(F.array_compact(F.array(
        F.when(F.abs(bias) > limit, finding(F.when(bias > 0, "under_prediction").otherwise("over_prediction"), none, bias, limit)),
        F.when(F.col("directional_accuracy") < LEAST_DIRECTION, finding("direction", none, F.col("directional_accuracy"), F.lit(LEAST_DIRECTION))),
    ))).alias("_f"))
    gap = F.col("level") - F.col("actual_coverage")
    shape = F.when(gap > 0, "narrow").otherwise("wide")
    per_level = cov.where(F.abs(gap) > COVERAGE_GAP).select("indicator", finding(shape, F.col("level"), F.col("actual_coverage"), F.lit(COVERAGE_GAP)).alias("_f"))
    found = own.unionByName(per_level)
    quiet = acc.join(found, "indicator", "left_anti").select("indicator", finding("none", none, none, none).alias("_f"))
    return found.unionByName(quiet).select("indicator", "_f.*")


def evaluation_report(forecasts: DataFrame, actuals: DataFrame) -> DataFrame:
    """Per indicator: period, accuracy, score, coverage by level and the recommendations."""
    errs = materialise(errors(forecasts, actuals), "errors")
    acc, cov = materialise(accuracy(errs), "accuracy"), materialise(coverage(errs), "coverage")
    span = errs.groupBy("indicator").agg(F.min("target_date").alias("first_target"), F.max("target_date").alias("last_target"))
    levels = cov.groupBy("indicator").agg(F.first("sharpness").alias("sharpness"), F.sort_array(F.collect_list(F.struct("level", "actual_coverage"))).alias("coverage"))
    advice = recommendations(acc, cov).groupBy("indicator").agg(F.sort_array(F.collect_list(F.struct("rule", "level", "value", "threshold"))).alias("recommendations"))
    return (span.join(acc, "indicator", "left").join(crps(errs).drop("n"), "indicator", "left").join(levels, "indicator", "left")
            .join(advice, "indicator", "left"))


def backtest_summary(errs: DataFrame, by: Sequence[str] = ("series",)) -> DataFrame:
    g = errs.groupBy(*by).agg(F.avg("absolute_error").alias("mae"), F.sqrt(F.avg("squared_error")).alias("rmse"),
                              F.avg(F.abs("percentage_error")).alias("mape"), F.count("*").alias("n_forecasts"))
    return same_keys(g, exact_percentiles(errs, by, "absolute_error", {"median_ae": 0.5}), list(by))


# ---- reasoning --------------------------------------------------------------------------------------

SCENARIOS = (("base", 0.60), ("optimistic", 0.20), ("pessimistic", 0.20))


def scenarios(forecasts: DataFrame, up: float = 1.5, down: float = 0.5) -> DataFrame:
    """Three rows per forecast: base, optimistic and pessimistic value with fixed probabilities."""
    factor = {"base": 1.0, "optimistic": up, "pessimistic": down}
    rows = F.array(*[F.struct(F.lit(n).alias("scenario"), (F.col("point_estimate") * factor[n]).alias("scenario_value"), F.lit(p).alias("probability"))
                     for n, p in SCENARIOS])
    return forecasts.select("*", F.inline(rows))


def reasoning_evidence(series: DataFrame) -> DataFrame:
    """Evidence rows per series: historical mean, last 12 against before, volatility."""
    late = F.col("idx") >= F.col("_n") - 12
    v = F.col("value")
    g = series.withColumn("_n", F.count("*").over(by_series())).groupBy("series").agg(
        F.count("*").alias("n"), F.avg(v).alias("mean"), (F.avg(F.when(late, v)) - F.avg(F.when(~late, v))).alias("shift"), F.stddev_pop(v).alias("vol"))

    def text(c: Column) -> Column:
        return F.format_string("%.2f", F.round(c, 2))

    direction = F.when(F.col("shift") > 0, "upward").otherwise("downward")
    rows = F.array_compact(F.array(
        F.struct(F.lit(1).alias("step"), F.concat(F.lit("Historical average: "), text(F.col("mean"))).alias("description"), F.col("mean").alias("quantity"), F.lit("high").alias("reliability")),
        F.when(F.col("shift").isNotNull(), F.struct(
            F.lit(2).alias("step"), F.concat(F.lit("Recent "), direction, F.lit(" trend of "), text(F.abs("shift"))).alias("description"),
            F.col("shift").alias("quantity"), F.lit("medium").alias("reliability"))),
        F.struct(F.lit(3).alias("step"), F.concat(F.lit("Historical volatility: "), text(F.col("vol"))).alias("description"), F.col("vol").alias("quantity"), F.lit("high").alias("reliability"))))
    return g.select("series", F.inline(rows))


def rationale_skeleton(forecasts: DataFrame, creator: str = "System") -> DataFrame:
    return forecasts.select(
        "forecast_id", "indicator", F.lit(creator).alias("created_by"), F.lit("").alias("executive_summary"),
        F.array().cast("array<struct<description:string,sensitivity:string,alternatives:array<string>>>").alias("assumptions"),
        F.array().cast("array<struct<description:string,reliability:string>>").alias("evidence"), F.array().cast("array<string>").alias("steps"),
        F.lit("medium").alias("confidence"), F.array().cast("array<struct<revised_at:string,reason:string,changes:string,revised_by:string>>").alias("revisions"))


def revise_rationale(rationales: DataFrame, revisions: DataFrame) -> DataFrame:
    """Append one revision (revised_at, reason, changes, revised_by) per rationale that has one."""
    new = revisions.select("forecast_id", F.struct("revised_at", "reason", "changes", "revised_by").alias("_r"))
    return (rationales.join(new, "forecast_id", "left")
            .withColumn("revisions", F.when(F.col("_r").isNotNull(), F.array_append("revisions", F.col("_r"))).otherwise(F.col("revisions"))).drop("_r"))


def rationale_consistency(rationales: DataFrame) -> DataFrame:
    """is_valid, issues and warnings from the documented parts."""
    # the messages are fixed values
    low = F.size(F.filter("evidence", lambda e: e["reliability"].isin("low", "very_low")))
    bare = F.filter("assumptions", lambda a: (a["sensitivity"] == "high") & (F.size(a["alternatives"]) == 0))
    named = F.transform(bare, lambda a: F.concat(F.lit("High-sensitivity assumption without alternatives: "), a["description"]))
    first = F.array_compact(F.array(F.when(F.coalesce(F.col("executive_summary"), F.lit("")) == "", "Missing executive summary"),
                                    F.when(F.size("assumptions") == 0, "No key assumptions documented")))
    last = F.array_compact(F.array(F.when(low > F.size("evidence") / 2, "More than 50% of evidence sources have low confidence")))
    issues = F.array_compact(F.array(F.when(F.size("evidence") == 0, "No evidence sources provided"),
                                     F.when(F.size("steps") == 0, "Empty reasoning chain")))
    return rationales.withColumns({"is_valid": F.size(issues) == 0, "issues": issues, "warnings": F.concat(first, named, last)})


def evidence_overlap(rationales: DataFrame, pairs: DataFrame, forecasts: DataFrame) -> DataFrame:
    """Shared and own evidence of two forecasts, the overlap in percent, and the difference of their estimates."""
    def side(k: int) -> DataFrame:
        ev = rationales.select(F.col("forecast_id").alias(f"forecast{k}"), F.array_distinct(F.transform("evidence", lambda e: e["description"])).alias(f"_e{k}"))
        est = forecasts.select(F.col("forecast_id").alias(f"forecast{k}"), F.col("point_estimate").alias(f"_p{k}"), F.col("std").alias(f"std{k}"))
        return ev.join(est, f"forecast{k}")

    j = pairs.join(side(1), "forecast1").join(side(2), "forecast2")
    common = F.array_sort(F.array_intersect("_e1", "_e2"))
    most = F.greatest(F.size("_e1"), F.size("_e2"))
    return j.select("forecast1", "forecast2", common.alias("common"), F.array_sort(F.array_except("_e1", "_e2")).alias("only_1"),
                    F.array_sort(F.array_except("_e2", "_e1")).alias("only_2"), safe_ratio(F.size(common) * 100, most).alias("overlap_pct"),
                    (F.col("_p1") - F.col("_p2")).alias("estimate_difference"), "std1", "std2")


# ---- records ----------------------------------------------------------------------------------------

def forecast_records(forecasts: DataFrame) -> DataFrame:
    """Flat rows for storage: interval bounds as columns."""
    df = with_distribution(forecasts)
    bounds = [F.col("intervals")[F.lit(level)][end].alias(f"ci_{round(level * 100)}_{name}")
              for level in (0.50, 0.80, 0.90, 0.95, 0.99) for end, name in (("lo", "lower"), ("hi", "upper"))]
    return df.select("forecast_id", "indicator", "forecast_date", "target_date", "horizon", "point_estimate", F.col("point_estimate").alias("mean"),
                     F.col("point_estimate").alias("median"), "std", *bounds, "methodology", "model_version")


def rationale_records(rationales: DataFrame) -> DataFrame:
    whole = F.to_json(F.struct("forecast_id", "indicator", "executive_summary", "assumptions", "evidence", "steps"))
    return rationales.select("forecast_id", "executive_summary", F.size("assumptions").alias("n_assumptions"), F.size("evidence").alias("n_evidence_sources"),
                             whole.alias("full_rationale_json"))

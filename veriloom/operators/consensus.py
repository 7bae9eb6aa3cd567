"""Expert track records and consensus forecasts.

An expert frame holds (expert_id, expertise_level, indicator, target_date, forecast_id, point_estimate, std,
calibration). Groups are never sorted in one task: order statistics go through the bracketed helpers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriloom.functions.parse import safe_ratio
from veriloom.operators import forecast as fc
from veriloom.operators.skew import exact_percentiles, running_weight, same_keys
from veriloom.session import materialise

# fixed values: base weight by level of expertise
LEVEL_WEIGHTS = {"novice": 0.5, "intermediate": 1.0, "expert": 1.5, "master": 2.0}
GROUP = ("indicator", "target_date")


def expert_performance(experts: DataFrame, actuals: DataFrame) -> DataFrame:
    """Mean, median and root mean squared error per expert over forecasts with an outcome."""
    errs = materialise(fc.errors(experts, actuals).select("expert_id", "absolute_error", "squared_error"), "errors")
    g = errs.groupBy("expert_id").agg(F.avg("absolute_error").alias("mae"), F.sqrt(F.avg("squared_error")).alias("rmse"), F.count("*").alias("n_forecasts"))
    return g.join(exact_percentiles(errs, ["expert_id"], "absolute_error", {"median_ae": 0.5}), "expert_id")


def expert_calibration(experts: DataFrame, actuals: DataFrame) -> DataFrame:
    """Coverage per expert and level, with the level's mean interval width."""
    return fc.coverage(fc.errors(experts, actuals), ("expert_id",), min_n=1)


def weight(level: Column, mae: Column, calibration: Column) -> Column:
    """Level weight, divided by the error (at least 0.1) and lowered by miscalibration, each where known. Never negative."""
    base = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in LEVEL_WEIGHTS.items() for x in p]), level), F.lit(1.0))
    by_error = F.coalesce(F.lit(1.0) / F.greatest(mae, F.lit(0.1)), F.lit(1.0))
    known = F.when(calibration != 0, calibration)  # 0 stands for not set
    by_calibration = F.coalesce(F.greatest(F.lit(1.0) - F.abs(F.lit(1.0) - known), F.lit(0.0)), F.lit(1.0))
    return base * by_error * by_calibration


def weighted_experts(experts: DataFrame, performance: DataFrame) -> DataFrame:
    mae = performance.select("expert_id", "mae")
    return experts.join(mae, "expert_id", "left").withColumn("weight", weight(F.col("expertise_level"), F.col("mae"), F.col("calibration")))


def _weighted(df: DataFrame, w: Column, by: Sequence[str]) -> DataFrame:
    x, s = F.col("point_estimate"), F.col("std")
    return df.groupBy(*by).agg(F.count("*").alias("n_experts"), F.try_divide(F.sum(w * x), F.sum(w)).alias("consensus"),
                               F.sqrt(F.try_divide(F.sum(w * s * s), F.sum(w))).alias("consensus_std"))


def simple(experts: DataFrame, by: Sequence[str] = GROUP) -> DataFrame:
    return _weighted(experts, F.lit(1.0), by)


def weighted(experts: DataFrame, by: Sequence[str] = GROUP) -> DataFrame:
    """Needs a ``weight`` column."""
    return _weighted(experts, F.col("weight"), by)


def performance_weighted(experts: DataFrame, by: Sequence[str] = GROUP) -> DataFrame:
    """Needs a ``mae`` column; an unknown error counts as 1."""
    return _weighted(experts, F.lit(1.0) / (F.coalesce("mae", F.lit(1.0)) + F.lit(0.1)), by)


def median(experts: DataFrame, by: Sequence[str] = GROUP) -> DataFrame:
    """Median, with 1.4826 times the median absolute deviation as its deviation."""
    mid = exact_percentiles(experts, by, "point_estimate", {"consensus": 0.5})
    away = same_keys(experts.select(*by, "point_estimate"), mid, list(by)).withColumn("_d", F.abs(F.col("point_estimate") - F.col("consensus")))
    mad = exact_percentiles(away, by, "_d", {"_mad": 0.5})
    n = experts.groupBy(*by).agg(F.count("*").alias("n_experts"))
    return same_keys(same_keys(n, mid, list(by)), mad, list(by)).withColumn("consensus_std", F.col("_mad") * 1.4826).drop("_mad")


def trimmed(experts: DataFrame, trim: float = 0.1, by: Sequence[str] = GROUP) -> DataFrame:
    """Mean and population deviation after dropping int(trim * n) estimates at each end.

    Equal estimates are one counted row; how many copies lie inside follows from the count before them.
    """
    keys = list(by)
    counts = experts.groupBy(*keys, "point_estimate").agg(F.count("*").alias("_n"))
    totals = experts.groupBy(*keys).agg(F.count("*").alias("n_experts"))
    placed = same_keys(running_weight(counts, keys, "point_estimate", "_n"), totals, keys)
    cut = F.floor(F.col("n_experts") * F.lit(trim))
    inside = F.greatest(F.lit(0), F.least(F.col("_before") + F.col("_n"), F.col("n_experts") - cut) - F.greatest(F.col("_before"), cut))
    x = F.col("point_estimate")
    sums = placed.withColumn("_k", inside).groupBy(*keys, "n_experts").agg(
        F.sum("_k").alias("k"), F.sum(F.col("_k") * x).alias("s"), F.sum(F.col("_k") * x * x).alias("q"))
    mean = F.try_divide("s", "k")  # NULL if nothing is left
    return sums.select(*keys, "n_experts", mean.alias("consensus"), F.when(F.col("k") > 0, F.sqrt(F.greatest(F.try_divide("q", "k") - mean * mean, F.lit(0.0)))).alias("consensus_std"))


METHODS = {"simple_average": simple, "weighted_average": weighted, "median": median,
           "trimmed_mean": lambda e, by=GROUP: trimmed(e, 0.1, by), "performance_weighted": performance_weighted}


def build(experts: DataFrame, method: str = "weighted_average", by: Sequence[str] = GROUP) -> DataFrame:
    if method not in METHODS:
        raise ValueError(f"unknown method {method}")
    return METHODS[method](experts, by).withColumn("method", F.lit(method))


def strength(experts: DataFrame, by: Sequence[str] = GROUP) -> DataFrame:
    """Dispersion of the estimates and the agreement derived from it."""
    x = F.col("point_estimate")
    g = experts.groupBy(*by).agg(F.count("*").alias("n_experts"), F.avg(x).alias("mean_estimate"), F.stddev_pop(x).alias("std_dev"), (F.max(x) - F.min(x)).alias("range"))
    g = same_keys(g, exact_percentiles(experts, by, "point_estimate", {"median_estimate": 0.5}), list(by))
    cv = safe_ratio(F.col("std_dev"), F.abs("mean_estimate"))
    g = g.withColumn("coefficient_of_variation", cv).withColumn("agreement_score", F.lit(1.0) / (F.lit(1.0) + F.col("coefficient_of_variation")))
    a = F.col("agreement_score")
    return g.withColumn("consensus_strength", F.when(a > 0.8, "strong").when(a > 0.6, "moderate").otherwise("weak"))


def consensus_records(consensus: DataFrame, strengths: DataFrame) -> DataFrame:
    """Flat rows for storage with 90 and 95 % bounds."""
    df = consensus.withColumnRenamed("consensus", "point_estimate").withColumnRenamed("consensus_std", "std")
    df = fc.with_distribution(df).join(strengths.select("indicator", "target_date", "consensus_strength", "agreement_score"), ["indicator", "target_date"])
    ci = F.col("intervals")
    return df.select("indicator", "target_date", "point_estimate", "std", ci[F.lit(0.90)]["lo"].alias("ci_90_lower"), ci[F.lit(0.90)]["hi"].alias("ci_90_upper"),
                     ci[F.lit(0.95)]["lo"].alias("ci_95_lower"), ci[F.lit(0.95)]["hi"].alias("ci_95_upper"), "method", "n_experts", "consensus_strength", "agreement_score")


def contribution_records(experts: DataFrame) -> DataFrame:
    return experts.select("indicator", "target_date", "forecast_id", "expert_id", "expertise_level", "point_estimate", "weight")

"""Normal-distribution expressions in closed form: no sampling, so results repeat."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: standard normal quantiles
Z = {
    0.005: -2.5758293035489004, 0.01: -2.3263478740408408, 0.025: -1.959963984540054,
    0.05: -1.6448536269514729, 0.10: -1.2815515655446004, 0.25: -0.6744897501960817,
    0.50: 0.0, 0.75: 0.6744897501960817, 0.90: 1.2815515655446004, 0.95: 1.6448536269514722,
    0.975: 1.959963984540054, 0.99: 2.3263478740408408, 0.995: 2.5758293035489004,
}
QUANTILES = (0.01, 0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99)
# interval level -> its two quantiles
INTERVALS = {0.50: (0.25, 0.75), 0.80: (0.10, 0.90), 0.90: (0.05, 0.95),
             0.95: (0.025, 0.975), 0.99: (0.005, 0.995)}

# fixed values: Abramowitz and Stegun 7.1.26, error below 1.5e-7
ERF_P = 0.3275911
ERF_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def cdf(z: Column) -> Column:
    """Standard normal CDF by the polynomial above."""
    x = F.abs(z) / F.lit(math.sqrt(2.0))
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(ERF_P) * x)
    poly = F.lit(0.0)
    for a in reversed(ERF_A):
        poly = (poly + F.lit(a)) * t
    erf = F.lit(1.0) - poly * F.exp(-x * x)
    return F.lit(0.5) * (F.lit(1.0) + F.when(z < 0, -erf).otherwise(erf))


def pdf(z: Column) -> Column:
    return F.exp(-z * z / F.lit(2.0)) / F.lit(math.sqrt(2.0 * math.pi))


def crps(mean: Column, std: Column, actual: Column) -> Column:
    """Continuous ranked probability score of a normal forecast."""
    z = (actual - mean) / std
    score = std * (z * (F.lit(2.0) * cdf(z) - F.lit(1.0)) + F.lit(2.0) * pdf(z) - F.lit(1.0 / math.sqrt(math.pi)))
    return F.when(std > 0, score).otherwise(F.abs(actual - mean))


def quantile_map(mean: Column, std: Column, quantiles=QUANTILES) -> Column:
    entries = []
    for q in quantiles:
        entries += [F.lit(q), mean + F.lit(Z[q]) * std]
    return F.create_map(*entries)


def interval_map(mean: Column, std: Column, levels=tuple(INTERVALS)) -> Column:
    """Level -> struct(lo, hi)."""
    entries = []
    for level in levels:
        lo, hi = INTERVALS[level]
        bounds = F.struct((mean + F.lit(Z[lo]) * std).alias("lo"), (mean + F.lit(Z[hi]) * std).alias("hi"))
        entries += [F.lit(level), bounds]
    return F.create_map(*entries)


def probability_above(threshold: Column, mean: Column, std: Column) -> Column:
    """Of a normal value; without spread the value is its mean."""
    return F.when(std == 0, (mean > threshold).cast("double")).otherwise(F.lit(1.0) - cdf(F.try_divide(threshold - mean, std)))


def probability_above_steps(threshold: Column, quantiles: Column) -> Column:
    """Step estimate from a quantile map: 1 - q of the first quantile reaching the threshold, else 0."""
    reached = F.filter(F.map_entries(quantiles), lambda e: e["value"] >= threshold)
    return F.coalesce(F.lit(1.0) - F.array_min(F.transform(reached, lambda e: e["key"])), F.lit(0.0))

"""Student's t as column expressions, from the regularised incomplete beta function."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the published Lanczos coefficients for g = 7
LANCZOS = (0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059,
           12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7)
TINY = 1e-300


def log_gamma(x: Column) -> Column:
    """ln of the gamma function for x of 0.5 or more."""
    z = x - 1
    total = F.lit(LANCZOS[0])
    for k, c in enumerate(LANCZOS[1:], 1):
        total = total + F.lit(c) / (z + k)
    t = z + 7.5
    return F.lit(0.5 * math.log(2 * math.pi)) + (z + 0.5) * F.log(t) - t + F.log(total)


def _apart_from_zero(x: Column) -> Column:
    return F.when(F.abs(x) < TINY, F.lit(TINY)).otherwise(x)


def _fraction(z: Column) -> Column:
    """The continued fraction of the incomplete beta function for the fields a, b and x of ``z``, by the modified Lentz recurrence. Steps
    needed grow with the root of a or b."""
    a, b, x = z["a"], z["b"], z["x"]
    first = 1 / _apart_from_zero(1 - (a + b) * x / (a + 1))
    start = F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("h"))

    def one(s: Column, i: Column) -> Column:
        m = F.floor(i / 2).cast("double")
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        k = F.when(i % 2 == 0, even).otherwise(odd)
        c, d = _apart_from_zero(1 + k / s["c"]), 1 / _apart_from_zero(1 + k * s["d"])
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * c * d).alias("h"))

    last = (60 + 10 * F.sqrt(F.greatest(a, b))).cast("int")
    return F.aggregate(F.sequence(F.lit(2), last), start, one)["h"]


def _bound(expression: Callable[[Column], Column], **values: Column) -> Column:
    """``expression`` of a struct of the values, each computed once."""
    return F.get(F.transform(F.array(F.struct(*[v.alias(k) for k, v in values.items()])), expression), 0)


def incomplete_beta(a: Column, b: Column, x: Column) -> Column:
    """I_x(a, b) for a and b of 0.5 or more and x from 0 to 1."""
    def inside(v: Column) -> Column:
        a, b, x, small = v["a"], v["b"], v["x"], v["small"]  # the fraction converges fast for small x, and on the other side for the rest
        front = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.log(x) + b * F.log(1 - x))
        side = {"a": F.when(small, a).otherwise(b), "b": F.when(small, b).otherwise(a), "x": F.when(small, x).otherwise(1 - x)}
        tail = _bound(lambda z: z["front"] * _fraction(z) / z["a"], front=front, **side)
        return F.when(small, tail).otherwise(1 - tail)

    value = _bound(inside, a=a, b=b, x=x, small=x < (a + 1) / (a + b + 2))
    return F.when(x <= 0, 0.0).when(x >= 1, 1.0).otherwise(value)


def two_sided_p(t: Column, dof: Column) -> Column:
    """Chance of a |t| as large or larger; NULL for no degrees of freedom, 0 for an infinite t."""
    dof = dof.cast("double")
    x = dof / (dof + t * t)
    return F.when(dof > 0, F.when(F.abs(t) == float("inf"), 0.0).otherwise(incomplete_beta(dof / 2, F.lit(0.5), x)))



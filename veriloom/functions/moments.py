"""Correlation from centred co-moments. Spark combines count, means and centred sums of parts pairwise, so large values that differ
little lose no digits, and a side without spread gives NULL instead of a division by zero. Whether there is a spread is asked of the
least and the greatest value: rounding while parts are combined can leave a trace of one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def correlation(x: Column | str, y: Column | str) -> Column:
    """Pearson's r over rows with both values, an aggregate; NULL without rows or where a side has no spread."""
    x, y = (F.col(c).cast("double") if isinstance(c, str) else c.cast("double") for c in (x, y))
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    r = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
    return F.when((F.min(x) < F.max(x)) & (F.min(y) < F.max(y)), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))


def parts(side: Column, name: str) -> list[Column]:
    """Aggregates of one side of a block: number, mean and centred square sum, least and greatest of its values, called n, m, d, l and h with ``name`` after it."""
    value = side.cast("double")
    return [F.count(value).alias(f"n{name}"), F.avg(value).alias(f"m{name}"), (F.var_pop(value) * F.count(value)).alias(f"d{name}"),
            F.min(value).alias(f"l{name}"), F.max(value).alias(f"h{name}")]


def crossed_correlation(blocks: DataFrame, keys: list[str], a: str, b: str) -> DataFrame:
    """keys, n and correlation over all pairs (one value of side ``a``, one of side ``b``) within each block, from the blocks' ``parts``.

    Inside a block every value of one side meets every one of the other, so its centred product sum is 0 and its centred square sums
    are the sides' times the number of the other side. Blocks are combined about the means of all pairs, never as raw power sums.
    """
    na, nb = F.col(f"n{a}"), F.col(f"n{b}")
    n = (na * nb).cast("double")
    middle = blocks.groupBy(*keys).agg(F.try_divide(F.sum(n * F.col(f"m{a}")), F.sum(n)).alias("_ma"), F.try_divide(F.sum(n * F.col(f"m{b}")), F.sum(n)).alias("_mb"))
    centred = blocks.join(middle, keys).withColumns({"_da": F.col(f"m{a}") - F.col("_ma"), "_db": F.col(f"m{b}") - F.col("_mb")})
    sums = centred.groupBy(*keys).agg(
        F.sum(na * nb).alias("n"), *[F.max(F.col(f"h{k}")).alias(f"_h{k}") for k in (a, b)], *[F.min(F.col(f"l{k}")).alias(f"_l{k}") for k in (a, b)],
        F.sum(nb * F.col(f"d{a}") + n * F.col("_da") * F.col("_da")).alias("_aa"),
        F.sum(na * F.col(f"d{b}") + n * F.col("_db") * F.col("_db")).alias("_bb"), F.sum(n * F.col("_da") * F.col("_db")).alias("_ab"))
    spread = (F.col(f"_l{a}") < F.col(f"_h{a}")) & (F.col(f"_l{b}") < F.col(f"_h{b}"))
    r = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.try_divide(F.col("_ab"), F.sqrt(F.col("_aa")) * F.sqrt(F.col("_bb")))))
    return sums.select(*keys, "n", F.when(spread, r).alias("correlation"))

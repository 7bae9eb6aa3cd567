"""Series features and correlations."""

from __future__ import annotations

from pyspark.sql import functions as F

from veriloom.catalog import common  # noqa: F401
from veriloom.catalog.registry import frame_sql, query
from veriloom.operators import series as ops
from veriloom.session import materialise
from veriloom.sources import frames as src


@query("select_series", "series date:d value:r4", """
SELECT * FROM series WHERE series IN ('1-URGENT', '2-HIGH') AND date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'""")
def _(spark, d):
    return ops.select_series(src.series(spark, d), ["1-URGENT", "2-HIGH"], "1996-01-01", "1999-12-31")


@query("latest_value", "series date:d value:r4", "SELECT series, max(date) AS date, arg_max(value, date) AS value FROM series GROUP BY 1")
def _(spark, d):
    return ops.latest_value(src.series(spark, d))


@query("asof_lookup", "o_orderkey series target_date:d value:r4", """
SELECT o_orderkey, o.series, target_date, value FROM (SELECT o_orderkey, o_orderpriority AS series, CAST(o_orderdate AS DATE) - 40 AS target_date FROM orders) o
ASOF LEFT JOIN series s ON o.series = s.series AND o.target_date >= s.date""")
def _(spark, d):
    asks = src.read(spark, d, "orders").select("o_orderkey", F.col("o_orderpriority").alias("series"), F.date_sub(F.to_date("o_orderdate"), 40).alias("target_date"))
    return ops.asof_lookup(src.series(spark, d), asks)


GROWTH = "SELECT * FROM (SELECT *, (value - lag(value, {p}) OVER w) / lag(value, {p}) OVER w * 100 AS growth FROM series WINDOW w AS (PARTITION BY series ORDER BY idx)) WHERE growth IS NOT NULL"


@query("growth_rate", "series idx:i growth:r", GROWTH.format(p=1))
def _(spark, d):
    return ops.growth_rate(src.series(spark, d))


@query("yoy_growth", "series idx:i growth:r", GROWTH.format(p=12))
def _(spark, d):
    return ops.growth_rate(src.series(spark, d), 12)


@query("series_stats", "series mean:r median:r std:r min:r max:r range:r skewness:r kurtosis:r cv:r", """
SELECT *, std / mean AS cv FROM (SELECT s.series, avg(value) AS mean, median(value) AS median, stddev_pop(value) AS std, min(value) AS min, max(value) AS max, max(value) - min(value) AS range,
  avg(pow(value - m, 3)) / pow(stddev_pop(value), 3) AS skewness, kurtosis_pop(value) AS kurtosis
 FROM series s JOIN (SELECT series, avg(value) AS m FROM series GROUP BY 1) USING (series) GROUP BY 1)""")
def _(spark, d):
    return ops.stats(src.series(spark, d))


@query("series_trend", "series trend_slope:r trend_intercept:r trend_r_squared:r recent_trend_slope:r trend_strength:r trend_direction:r trend_acceleration:r", """
SELECT *, trend_r_squared AS trend_strength, CASE WHEN trend_slope > 0 THEN 1 ELSE -1 END AS trend_direction, recent_trend_slope - trend_slope AS trend_acceleration FROM (
 SELECT series, regr_slope(value, idx) AS trend_slope, regr_intercept(value, idx) AS trend_intercept, coalesce(pow(covar_pop(value, idx) / nullif(stddev_pop(value) * stddev_pop(idx), 0), 2), 0) AS trend_r_squared,
  regr_slope(value, idx) FILTER (idx >= floor(n * 0.75)) AS recent_trend_slope FROM (SELECT *, count(*) OVER (PARTITION BY series) AS n FROM series) GROUP BY 1)""")
def _(spark, d):
    return ops.trend(src.series(spark, d))


frame_sql("rets", """
SELECT series, idx - 1 AS r_idx, r, count(*) OVER (PARTITION BY series) AS n, stddev_pop(r) OVER (PARTITION BY series ORDER BY idx ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS s12
FROM (SELECT *, (value - lag(value) OVER w) / lag(value) OVER w AS r FROM series WINDOW w AS (PARTITION BY series ORDER BY idx)) WHERE r IS NOT NULL""")
frame_sql("drawdown", """
SELECT series, min((value - top) / top) AS max_drawdown FROM (SELECT *, max(value) OVER (PARTITION BY series ORDER BY idx) AS top FROM series) GROUP BY 1""")
frame_sql("vols", """
SELECT series, stddev_pop(r) AS volatility, stddev_pop(r) FILTER (r_idx >= n - least(12, n - 1)) AS rolling_volatility, stddev_pop(s12) FILTER (n > 24 AND r_idx >= 12) AS volatility_of_volatility,
 stddev_pop(r) FILTER (r > 0) AS upside_volatility, stddev_pop(r) FILTER (r < 0) AS downside_volatility FROM rets GROUP BY 1""")


@query("series_volatility", "series volatility:r rolling_volatility:r volatility_of_volatility:r upside_volatility:r downside_volatility:r max_drawdown:r",
       "SELECT * FROM vols JOIN drawdown USING (series)")
def _(spark, d):
    return ops.volatility(src.series(spark, d))


@query("max_drawdown", "series max_drawdown:r", "SELECT * FROM drawdown")
def _(spark, d):
    return ops.max_drawdown(src.series(spark, d))


@query("vol_of_vol", "series volatility_of_volatility:r", "SELECT * FROM vols")
def _(spark, d):
    return ops.volatility(src.series(spark, d))


@query("series_momentum", "series roc_1_period:r roc_3_period:r roc_12_period:r ma_crossover:r momentum_score:r relative_position:r", """
SELECT *, (roc_1_period + roc_3_period + roc_12_period) / 3 AS momentum_score FROM (SELECT series, idx, count(*) OVER k AS n, (value - lag(value, 1) OVER w) / lag(value, 1) OVER w AS roc_1_period,
 (value - lag(value, 3) OVER w) / lag(value, 3) OVER w AS roc_3_period, (value - lag(value, 12) OVER w) / lag(value, 12) OVER w AS roc_12_period,
 avg(value) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) - avg(value) OVER (w ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS ma_crossover,
 (value - min(value) OVER k) / (max(value) OVER k - min(value) OVER k) AS relative_position
 FROM series WINDOW w AS (PARTITION BY series ORDER BY idx), k AS (PARTITION BY series)) WHERE idx = n - 1""")
def _(spark, d):
    return ops.momentum(src.series(spark, d))


frame_sql("ma12", """
SELECT *, CASE WHEN idx >= n - 6 THEN avg(value) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) WHEN idx < 6 THEN avg(value) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
 ELSE avg(value) OVER (w ROWS BETWEEN 6 PRECEDING AND 5 FOLLOWING) END AS trend FROM (SELECT *, count(*) OVER (PARTITION BY series) AS n FROM series) WINDOW w AS (PARTITION BY series ORDER BY idx)""")


@query("moving_average_trend", "series idx:i trend:r", "SELECT * FROM ma12")
def _(spark, d):
    return ops.moving_average(src.series(spark, d))


@query("seasonal_component", "series idx:i seasonal:r", """
SELECT s.series, idx, seasonal FROM series s JOIN (SELECT series, k, m - avg(m) OVER (PARTITION BY series) AS seasonal FROM (
 SELECT series, idx % 12 AS k, avg(value) AS m FROM series GROUP BY 1, 2)) x ON s.series = x.series AND s.idx % 12 = x.k""")
def _(spark, d):
    return ops.seasonal_component(src.series(spark, d), 12)


@query("decompose", "series idx:i trend:r seasonal:r residual:r", """
SELECT m.series, idx, trend, seasonal, value - trend - seasonal AS residual FROM ma12 m JOIN (SELECT series, k, v - avg(v) OVER (PARTITION BY series) AS seasonal FROM (
 SELECT series, idx % 12 AS k, avg(value) AS v FROM series GROUP BY 1, 2)) x ON m.series = x.series AND m.idx % 12 = x.k""")
def _(spark, d):
    return ops.decompose(src.series(spark, d), 12)


frame_sql("acf", """
SELECT a.series, l.lag, sum(a.d * b.d) / any_value(v) AS acf FROM (SELECT *, value - avg(value) OVER (PARTITION BY series) AS d, count(*) OVER (PARTITION BY series) AS n,
  var_pop(value) OVER (PARTITION BY series) * count(*) OVER (PARTITION BY series) AS v FROM series) a
JOIN (SELECT unnest(range(0, 51)) AS lag) l ON l.lag < n JOIN (SELECT *, value - avg(value) OVER (PARTITION BY series) AS d FROM series) b ON a.series = b.series AND b.idx = a.idx + l.lag GROUP BY 1, 2""")


@query("autocorrelation", "series lag:i acf:r", "SELECT * FROM acf")
def _(spark, d):
    return ops.autocorrelation(src.series(spark, d))


@query("seasonality_detect", "series rank:i period:i strength:r", """
SELECT * FROM (SELECT series, row_number() OVER (PARTITION BY series ORDER BY lag) AS rank, lag AS period, acf AS strength FROM (
 SELECT *, lag(acf) OVER w AS p, lead(acf) OVER w AS q FROM acf WHERE lag >= 1 WINDOW w AS (PARTITION BY series ORDER BY lag)) WHERE acf > p AND acf > q AND acf >= 0.1) WHERE rank <= 3""")
def _(spark, d):
    return ops.seasonality(src.series(spark, d), height=0.1)


frame_sql("change_points", """
SELECT s.series, coalesce(p.change_points, []) AS change_points FROM (SELECT DISTINCT series FROM series) s LEFT JOIN (
 SELECT series, list_reduce(list([idx] ORDER BY idx), lambda acc, x: CASE WHEN x[1] - acc[-1] >= 10 THEN acc || x ELSE acc END) AS change_points FROM (
  SELECT *, 1 - 2 * exp(lgamma((v + 1) / 2) - lgamma(v / 2)) / sqrt(v * pi()) * t / 6000 * list_sum(list_transform(range(0, 2001),
   lambda i: (CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * pow(1 + pow(t * i / 2000, 2) / v, -(v + 1) / 2))) AS p FROM (
   SELECT series, idx, n - 2 AS v, abs(m1 - m2) / sqrt((q1 * idx + q2 * (n - idx)) / (n - 2) * (1 / idx + 1 / (n - idx))) AS t FROM (
    SELECT c.series, c.idx, c.n, avg(x.value) FILTER (x.idx < c.idx) AS m1, var_pop(x.value) FILTER (x.idx < c.idx) AS q1,
     avg(x.value) FILTER (x.idx >= c.idx) AS m2, var_pop(x.value) FILTER (x.idx >= c.idx) AS q2
    FROM (SELECT *, count(*) OVER (PARTITION BY series) AS n FROM series) c JOIN series x ON x.series = c.series WHERE c.n >= 20 AND c.idx >= 10 AND c.idx < c.n - 10 GROUP BY 1, 2, 3)))
 WHERE p < 0.01 GROUP BY 1) p ON s.series = p.series""")


@query("change_points", "series change_points:j", "SELECT * FROM change_points")
def _(spark, d):
    return ops.change_points(src.series(spark, d))


def _pairs(frame, candidates, target):
    names = candidates.select(F.col("series").alias("candidate")).distinct()
    return names.where(F.col("candidate") != target).select(F.lit(target).alias("target"), "candidate")


TARGET = "3-MEDIUM"
frame_sql("aligned", f"""
SELECT a.series AS target, b.series AS candidate, a.date, a.value AS x, b.value AS y FROM series a JOIN series b ON a.date = b.date AND a.series = '{TARGET}' AND b.series <> '{TARGET}'""")
frame_sql("lagged", f"""
SELECT a.series AS target, b.series AS candidate, l.lag, a.idx, a.value AS x, b.value AS y FROM series a JOIN (SELECT unnest(range(0, 13)) AS lag) l ON a.series = '{TARGET}'
JOIN segment_series b ON b.idx = a.idx - l.lag""")


def _aligned(spark, d):
    s = src.series(spark, d)
    return ops.align(s, s, _pairs(s, s, TARGET))


@query("consecutive_series_align", "target candidate position:d x:r4 y:r4", "SELECT *, date AS position FROM aligned")
def _(spark, d):
    return _aligned(spark, d)


@query("series_correlation", "target candidate n:i correlation:r", "SELECT target, candidate, count(*) AS n, corr(x, y) AS correlation FROM aligned GROUP BY 1, 2")
def _(spark, d):
    return ops.correlation(_aligned(spark, d))


@query("series_correlation_spearman", "target candidate n:i correlation:r", """
SELECT target, candidate, count(*) AS n, corr(rx, ry) AS correlation FROM (SELECT *, rank() OVER (PARTITION BY candidate ORDER BY x) + (count(*) OVER (PARTITION BY candidate, x) - 1) / 2 AS rx,
 rank() OVER (PARTITION BY candidate ORDER BY y) + (count(*) OVER (PARTITION BY candidate, y) - 1) / 2 AS ry FROM aligned) GROUP BY 1, 2""")
def _(spark, d):
    return ops.correlation(_aligned(spark, d), "spearman")


@query("series_correlation_kendall", "target candidate n:i correlation:r", """
SELECT target, candidate, any_value(n) AS n, sum(s) / sqrt(count(*) FILTER (NOT tx) * CAST(count(*) FILTER (NOT ty) AS DOUBLE)) AS correlation FROM (
 SELECT a.target, a.candidate, a.n, sign(a.x - b.x) * sign(a.y - b.y) AS s, a.x = b.x AS tx, a.y = b.y AS ty FROM (SELECT *, count(*) OVER (PARTITION BY candidate) AS n FROM aligned) a
 JOIN aligned b ON a.candidate = b.candidate AND a.date < b.date) GROUP BY 1, 2""")
def _(spark, d):
    return ops.correlation(_aligned(spark, d), "kendall")


def _lagged(spark, d):
    s, c = src.series(spark, d), src.segment_series(spark, d)
    return ops.lagged_pairs(s, c, _pairs(s, c, TARGET))


@query("lagged_pairs", "target candidate lag:i idx:i x:r4 y:r4", "SELECT * FROM lagged")
def _(spark, d):
    return _lagged(spark, d)


frame_sql("lagged_corr", "SELECT target, candidate, lag, count(*) AS n, corr(x, y) AS correlation FROM lagged GROUP BY 1, 2, 3 HAVING count(*) > 10")


@query("lagged_correlation", "target candidate lag:i n:i correlation:r", "SELECT * FROM lagged_corr")
def _(spark, d):
    return ops.lagged_correlation(_lagged(spark, d))


@query("leading_indicators", "target candidate lag:i correlation:r", """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY target, candidate ORDER BY abs(correlation) DESC, lag) AS r FROM lagged_corr) WHERE r = 1 AND abs(correlation) >= 0.05""")
def _(spark, d):
    return ops.leading_indicators(ops.lagged_correlation(_lagged(spark, d)), 0.05)


@query("series_quality", "series n_observations:i n_missing:i n_outliers:i days_since_update:i completeness:r issues:j overall_quality", """
SELECT *, CASE WHEN len(issues) = 0 THEN 'high' WHEN len(issues) <= 2 THEN 'medium' ELSE 'low' END AS overall_quality FROM (
 SELECT *, 1 - n_missing / n_observations AS completeness, list_concat(CASE WHEN n_missing > 0 THEN [n_missing || ' missing observations'] ELSE [] END,
  CASE WHEN n_outliers > 0 THEN [n_outliers || ' potential outliers detected'] ELSE [] END, CASE WHEN days_since_update > 60 THEN ['Data is ' || days_since_update || ' days old'] ELSE [] END) AS issues FROM (
 SELECT series, count(*) AS n_observations, count(*) FILTER (value IS NULL) AS n_missing, count(*) FILTER (abs((value - m) / s) > 3) AS n_outliers, DATE '2001-12-31' - max(date) AS days_since_update
 FROM (SELECT series, date, CASE WHEN idx % 20 <> 3 THEN value END AS value, avg(CASE WHEN idx % 20 <> 3 THEN value END) OVER k AS m, stddev_pop(CASE WHEN idx % 20 <> 3 THEN value END) OVER k AS s
  FROM series WINDOW k AS (PARTITION BY series)) GROUP BY 1))""")
def _(spark, d):
    gaps = src.series(spark, d).withColumn("value", F.when(F.col("idx") % 20 != 3, F.col("value")))
    return ops.quality(gaps, "2001-12-31")


@query("polynomial_trend", "series idx:i trend:r", """
SELECT series, idx, a + b * u + c * u * u AS trend FROM (SELECT *, (t0 - c * s2) / n AS a FROM (
 SELECT s.*, x.*  EXCLUDE (series), t1 / s2 AS b, (n * t2 - s2 * t0) / (n * s4 - s2 * s2) AS c FROM (SELECT *, idx - (count(*) OVER (PARTITION BY series) - 1) / 2 AS u FROM series) s
 JOIN (SELECT series, count(*) AS n, sum(u * u) AS s2, sum(u * u * u * u) AS s4, sum(value) AS t0, sum(u * value) AS t1, sum(u * u * value) AS t2 FROM (
  SELECT *, idx - (count(*) OVER (PARTITION BY series) - 1) / 2 AS u FROM series) GROUP BY 1) x USING (series)))""")
def _(spark, d):
    return ops.polynomial_trend(src.series(spark, d))


@query("analyze_series", "series mean:r median:r std:r min:r max:r trend_slope:r trend_intercept:r trend_r_squared:r volatility:r roc_1_period:r roc_3_period:r "
       "roc_12_period:r change_points:j has_seasonality", """
SELECT * FROM (SELECT series, avg(value) AS mean, median(value) AS median, stddev_pop(value) AS std, min(value) AS min, max(value) AS max, regr_slope(value, idx) AS trend_slope,
  regr_intercept(value, idx) AS trend_intercept, coalesce(pow(covar_pop(value, idx) / nullif(stddev_pop(value) * stddev_pop(idx), 0), 2), 0) AS trend_r_squared, stddev_pop(r) AS volatility,
  arg_max(r, idx) AS roc_1_period, arg_max(r3, idx) AS roc_3_period, arg_max(r12, idx) AS roc_12_period FROM (
  SELECT *, value / lag(value, 1) OVER w - 1 AS r, value / lag(value, 3) OVER w - 1 AS r3, value / lag(value, 12) OVER w - 1 AS r12 FROM series WINDOW w AS (PARTITION BY series ORDER BY idx)) GROUP BY 1)
JOIN change_points USING (series) JOIN (SELECT series, coalesce(bool_or(lag >= 2 AND acf > p AND acf > q AND acf >= 0.3), FALSE) AS has_seasonality FROM (
 SELECT *, lag(acf) OVER w AS p, lead(acf) OVER w AS q FROM acf WHERE lag >= 1 WINDOW w AS (PARTITION BY series ORDER BY lag)) GROUP BY 1) USING (series)""")
def _(spark, d):
    s, c = materialise(src.series(spark, d), "series"), materialise(src.segment_series(spark, d), "segments")
    return ops.analyze(s, c, _pairs(s, c, TARGET))


frame_sql("backtest", """
SELECT *, actual_value - forecast_value AS error, abs(actual_value - forecast_value) AS absolute_error, pow(actual_value - forecast_value, 2) AS squared_error,
 CASE WHEN actual_value = 0 THEN 0 ELSE (actual_value - forecast_value) / actual_value * 100 END AS percentage_error FROM (
 SELECT series, idx, date AS forecast_date, avg(value) OVER (w ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS forecast_value, lead(value, 3) OVER w AS actual_value, lead(date, 3) OVER w AS target_date
 FROM series WINDOW w AS (PARTITION BY series ORDER BY idx)) WHERE idx >= 24 AND (idx - 24) % 2 = 0 AND actual_value IS NOT NULL""")


@query("rolling_backtest", "series idx:i forecast_date:d target_date:d forecast_value:r actual_value:r error:r absolute_error:r squared_error:r percentage_error:r", "SELECT * FROM backtest")
def _(spark, d):
    return ops.backtest(src.series(spark, d), 24, 3, 2)

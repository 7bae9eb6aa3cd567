"""Operators on input that the plain tables lack: NULL keys, series without spread or with a zero, weights that vanish."""

from __future__ import annotations

from pyspark.sql import functions as F

from veriloom.catalog import common  # noqa: F401
from veriloom.catalog.registry import FRAMES_SQL, frame_sql, query
from veriloom.functions import normal
from veriloom.operators import anomaly, consensus, forecast, fraud, marts, quality
from veriloom.operators import rules as R
from veriloom.operators import series as ops
from veriloom.operators.skew import latest_per_key, trailing_count
from veriloom.session import materialise
from veriloom.sources import frames as src

AS_OF, TARGET = "2001-08-31", "2002-02-28"

# ---- a series without spread, and zeros ---------------------------------------------------------------

frame_sql("flat_series", """
SELECT series, date, idx, CASE WHEN series = (SELECT min(series) FROM series) THEN 5.0 WHEN idx = 3 THEN 0.0 ELSE CAST(value AS DOUBLE) END AS value FROM series""")
frame_sql("flat_stats", "SELECT series, avg(value) AS m, stddev_pop(value) AS sd, count(*) AS n FROM flat_series GROUP BY 1")


def _flat(spark, d):
    s = src.series(spark, d)
    value = F.when(F.col("series") == s.agg(F.min("series")).scalar(), 5.0).when(F.col("idx") == 3, 0.0).otherwise(F.col("value").cast("double"))
    return s.withColumn("value", value)


@query("forecast_bayes_flat", "indicator point_estimate:r std:r", """
SELECT series AS indicator, coalesce((m / nullif(100 * sd * sd, 0) + n / nullif(sd * sd, 0) * m) / (1 / nullif(100 * sd * sd, 0) + n / nullif(sd * sd, 0)), m) AS point_estimate,
 coalesce(1.5 * sqrt(1 / (1 / nullif(100 * sd * sd, 0) + n / nullif(sd * sd, 0))), 0) AS std FROM flat_stats""")
def _(spark, d):
    return forecast.bayes(_flat(spark, d), AS_OF, TARGET)


@query("series_returns_zero", "series r_idx:i r:r", """
SELECT series, idx - 1 AS r_idx, (value - b) / nullif(b, 0) AS r FROM (SELECT *, lag(value) OVER (PARTITION BY series ORDER BY idx) AS b FROM flat_series) WHERE b IS NOT NULL""")
def _(spark, d):
    return ops.returns(_flat(spark, d))


@query("series_volatility_flat", "series volatility:r max_drawdown:r", """
SELECT series, stddev_pop((value - b) / nullif(b, 0)) AS volatility, min((value - top) / nullif(top, 0)) AS max_drawdown FROM (
 SELECT *, lag(value) OVER w AS b, max(value) OVER (w ROWS UNBOUNDED PRECEDING) AS top FROM flat_series WINDOW w AS (PARTITION BY series ORDER BY idx)) GROUP BY 1""")
def _(spark, d):
    return ops.volatility(_flat(spark, d))


@query("series_trend_flat", "series trend_slope:r trend_r_squared:r trend_strength:r trend_direction:r", """
SELECT series, regr_slope(value, idx) AS trend_slope, r AS trend_r_squared, r AS trend_strength, CASE WHEN trend_slope > 0 THEN 1 ELSE -1 END AS trend_direction FROM (
 SELECT *, coalesce(pow(covar_pop(value, idx) OVER k / nullif(stddev_pop(value) OVER k * stddev_pop(idx) OVER k, 0), 2), 0) AS r FROM flat_series WINDOW k AS (PARTITION BY series)) GROUP BY series, r""")
def _(spark, d):
    return ops.trend(_flat(spark, d))


def _flat_pairs(spark, d):
    """Every series against every other one, the flat one on either side."""
    s = materialise(_flat(spark, d), "flat")
    names = s.select("series").distinct()
    pairs = names.select(F.col("series").alias("target")).join(names.select(F.col("series").alias("candidate")), F.col("target") != F.col("candidate"))
    return s, pairs


frame_sql("flat_aligned", """
SELECT a.series AS target, b.series AS candidate, a.date, a.value AS x, b.value AS y FROM flat_series a JOIN flat_series b ON a.date = b.date AND a.series <> b.series""")


@query("correlation_flat", "target candidate method n:i correlation:r", """
WITH ranked AS (SELECT *, rank() OVER (PARTITION BY target, candidate ORDER BY x) + (count(*) OVER (PARTITION BY target, candidate, x) - 1) / 2 AS rx,
 rank() OVER (PARTITION BY target, candidate ORDER BY y) + (count(*) OVER (PARTITION BY target, candidate, y) - 1) / 2 AS ry FROM flat_aligned)
SELECT target, candidate, 'pearson' AS method, count(*) AS n, covar_pop(x, y) / nullif(stddev_pop(x) * stddev_pop(y), 0) AS correlation FROM flat_aligned GROUP BY 1, 2
UNION ALL SELECT target, candidate, 'spearman', count(*), covar_pop(rx, ry) / nullif(stddev_pop(rx) * stddev_pop(ry), 0) FROM ranked GROUP BY 1, 2""")
def _(spark, d):
    s, pairs = _flat_pairs(spark, d)
    aligned = ops.align(s, s, pairs)
    return ops.correlation(aligned).withColumn("method", F.lit("pearson")).unionByName(ops.correlation(aligned, "spearman").withColumn("method", F.lit("spearman")))


frame_sql("flat_lagged", """
SELECT a.series AS target, b.series AS candidate, l.lag, count(*) AS n, covar_pop(a.value, b.value) / nullif(stddev_pop(a.value) * stddev_pop(b.value), 0) AS correlation
FROM flat_series a JOIN (SELECT unnest(range(0, 13)) AS lag) l ON TRUE JOIN flat_series b ON b.idx = a.idx - l.lag AND b.series <> a.series GROUP BY 1, 2, 3 HAVING count(*) > 10""")


@query("lagged_correlation_flat", "target candidate lag:i n:i correlation:r", "SELECT * FROM flat_lagged")
def _(spark, d):
    s, pairs = _flat_pairs(spark, d)
    return ops.lagged_correlation(ops.lagged_pairs(s, s, pairs))


@query("leading_indicators_flat", "target candidate lag:i correlation:r", """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY target, candidate ORDER BY abs(correlation) DESC NULLS LAST, lag) AS r FROM flat_lagged) WHERE r = 1 AND abs(correlation) >= 0.05""")
def _(spark, d):
    s, pairs = _flat_pairs(spark, d)
    return ops.leading_indicators(ops.lagged_correlation(ops.lagged_pairs(s, s, pairs)), 0.05)


frame_sql("shifted_lab", "SELECT * REPLACE (CASE WHEN ResultValueNumeric IS NOT NULL AND TestCode = (SELECT min(Test1) FROM x_pairs) THEN 7.0 ELSE 1e9 + ResultValueNumeric END AS ResultValueNumeric) FROM lab")


@query("cross_test_correlation_shifted", "Test1 Test2 Expected n:i correlation:r5", """
SELECT Test1, Test2, Expected, count(*) AS n, covar_pop(a.ResultValueNumeric - 1e9, b.ResultValueNumeric - 1e9)
 / nullif(stddev_pop(a.ResultValueNumeric - 1e9) * stddev_pop(b.ResultValueNumeric - 1e9), 0) AS correlation FROM shifted_lab a JOIN x_pairs ON a.TestCode = Test1
 JOIN shifted_lab b ON b.TestCode = Test2 AND a.PatientId = b.PatientId AND CAST(a.ResultDate AS DATE) = CAST(b.ResultDate AS DATE)
 WHERE a.ResultValueNumeric IS NOT NULL AND b.ResultValueNumeric IS NOT NULL GROUP BY 1, 2, 3""")
def _(spark, d):
    lab = src.lab(spark, d)
    flat = F.col("TestCode") == R.correlation_sides(spark).agg(F.min("Test1")).scalar()
    value = F.when(flat, F.when(F.col("ResultValueNumeric").isNotNull(), 7.0)).otherwise(F.col("ResultValueNumeric") + 1e9)
    found = quality.cross_test_correlation(quality.cross_test_pairs(lab.withColumn("ResultValueNumeric", value)))
    return found.drop("MeetsExpectation")


@query("max_drawdown_zero", "series max_drawdown:r", """
SELECT series, min((value - top) / nullif(top, 0)) AS max_drawdown FROM (
 SELECT series, least(value, 0.0) AS value, max(least(value, 0.0)) OVER (PARTITION BY series ORDER BY idx ROWS UNBOUNDED PRECEDING) AS top FROM flat_series) GROUP BY 1""")
def _(spark, d):
    return ops.max_drawdown(_flat(spark, d).withColumn("value", F.least("value", F.lit(0.0))))


@query("change_points_flat", "series change_points:j", "SELECT DISTINCT series, CAST([] AS INTEGER[]) AS change_points FROM series")
def _(spark, d):
    return ops.change_points(src.series(spark, d).withColumn("value", F.lit(5.0)))


@query("probability_above_flat", "series p:r5", "SELECT series, CASE WHEN m > 4.0 THEN 1.0 ELSE 0.0 END AS p FROM flat_stats WHERE sd = 0")
def _(spark, d):
    stats = _flat(spark, d).groupBy("series").agg(F.avg("value").alias("m"), F.stddev_pop("value").alias("sd"))
    return stats.withColumn("p", normal.probability_above(F.lit(4.0), F.col("m"), F.col("sd"))).where("sd = 0")


@query("forecast_ensemble_unweighted", "indicator n_models:i point_estimate:r std:r", """
SELECT indicator, count(*) AS n_models, CAST(NULL AS DOUBLE) AS point_estimate, CAST(NULL AS DOUBLE) AS std FROM expert_forecasts GROUP BY 1""")
def _(spark, d):
    return forecast.ensemble(src.expert_forecasts(spark, d).withColumn("weight", F.lit(0.0)))


@query("consensus_unweighted", "indicator n_experts:i consensus:r consensus_std:r", """
SELECT indicator, count(*) AS n_experts, CAST(NULL AS DOUBLE) AS consensus, CAST(NULL AS DOUBLE) AS consensus_std FROM expert_forecasts GROUP BY 1""")
def _(spark, d):
    miscalibrated = consensus.weight(F.lit("none"), F.lit(1.0), F.lit(2.0))
    return consensus.weighted(src.expert_forecasts(spark, d).withColumn("weight", miscalibrated), ("indicator",))


@query("consensus_trimmed_empty", "indicator n_experts:i consensus:r", """
SELECT indicator, count(*) AS n_experts, CAST(NULL AS DOUBLE) AS consensus FROM (SELECT *, row_number() OVER (PARTITION BY indicator ORDER BY forecast_id) AS r FROM expert_forecasts) WHERE r <= 4 GROUP BY 1""")
def _(spark, d):
    rows = materialise(src.expert_forecasts(spark, d), "experts")
    least = latest_per_key(rows, ["indicator"], [F.col("forecast_id")], 4)
    return consensus.trimmed(least, 0.5, ("indicator",))


# ---- NULL keys ----------------------------------------------------------------------------------------

NO_KEY = "ResultId % 97 = 0"
frame_sql("null_lab", f"SELECT * REPLACE (CASE WHEN {NO_KEY} THEN NULL ELSE TestCode END AS TestCode, CASE WHEN ResultId % 89 = 0 THEN NULL ELSE PerformingLabId END AS PerformingLabId) FROM lab")


def _null_lab(spark, d):
    return src.lab(spark, d).withColumns({"TestCode": F.when(~F.expr(NO_KEY), F.col("TestCode")), "PerformingLabId": F.when(F.col("ResultId") % 89 != 0, F.col("PerformingLabId"))})


@query("previous_null_test", "ResultId PreviousResult:r", "SELECT ResultId, lag(ResultValueNumeric) OVER (PARTITION BY PatientId, TestCode ORDER BY ResultDate, ResultId) AS PreviousResult FROM null_lab")
def _(spark, d):
    return quality.with_previous(_null_lab(spark, d))


@query("frequency_null_test", "ResultId test_frequency_30d:i", """
SELECT ResultId, count(*) OVER (PARTITION BY PatientId, TestCode ORDER BY ResultDate RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW) AS test_frequency_30d FROM null_lab""")
def _(spark, d):
    return anomaly.frequency(_null_lab(spark, d).select("ResultId", "PatientId", "TestCode", "ResultDate"))


@query("zscore_null_test", "ResultId z_score_within_patient:r5 z_score_population:r5", "SELECT * FROM (" + FRAMES_SQL["zscored"].replace("FROM lab WINDOW", "FROM null_lab WINDOW") + ")")
def _(spark, d):
    return anomaly.zscores(_null_lab(spark, d).select("ResultId", "PatientId", "TestCode", "ResultValueNumeric"))


@query("percentiles_null_lab", "PerformingLabId:i p50:r p95:r p99:r", """
SELECT PerformingLabId, quantile_cont(ResultValueNumeric, 0.5) AS p50, quantile_cont(ResultValueNumeric, 0.95) AS p95, quantile_cont(ResultValueNumeric, 0.99) AS p99 FROM null_lab GROUP BY 1""")
def _(spark, d):
    return marts.kpi_percentiles(_null_lab(spark, d), ["PerformingLabId"])


@query("access_null_user", "n_rows:i n_flagged:i", """
SELECT count(*) AS n_rows, count(*) FILTER (c > 3) AS n_flagged FROM (
 SELECT count(*) OVER (PARTITION BY CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE c_nationkey END ORDER BY DATE '2024-01-01' + CAST(c_custkey % 500 AS INTEGER) RANGE BETWEEN INTERVAL 3 DAY PRECEDING AND CURRENT ROW) AS c FROM customer)""")
def _(spark, d):
    at = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % 500).cast("int")).cast("timestamp")
    rows = src.read(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 97 != 0, F.col("c_nationkey")).alias("UserId"), at.alias("at"))
    counted = trailing_count(rows, ["UserId"], "at", 3, 86400, "c")
    return counted.agg(F.count("*").alias("n_rows"), F.count_if(F.col("c") > 3).alias("n_flagged"))


@query("accuracy_null_group", "grp mae:r median_absolute_error:r n_forecasts:i", """
SELECT grp, avg(absolute_error) AS mae, median(absolute_error) AS median_absolute_error, count(*) AS n_forecasts FROM (
 SELECT CASE WHEN expert_id = (SELECT min(expert_id) FROM expert_forecasts) THEN NULL ELSE expert_id END AS grp, absolute_error FROM errs) GROUP BY 1 HAVING count(*) >= 5""")
def _(spark, d):
    experts = src.expert_forecasts(spark, d)
    errs = materialise(forecast.errors(experts, src.forecast_actuals(spark, d)), "errors")
    return forecast.accuracy(errs.withColumn("grp", F.when(F.col("expert_id") != experts.agg(F.min("expert_id")).scalar(), F.col("expert_id"))), ("grp",))


@query("percentile_rank_nulls", "c_custkey v:i percentile_rank:r", """
SELECT c_custkey, v, CASE WHEN v IS NOT NULL THEN (rank() OVER (PARTITION BY v IS NULL ORDER BY v) - 1) / count(*) OVER (PARTITION BY v IS NULL) * 100 END AS percentile_rank
FROM (SELECT c_custkey, CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE c_custkey % 40 END AS v FROM customer)""")
def _(spark, d):
    v = F.when(F.col("c_custkey") % 97 != 0, F.col("c_custkey") % 40)
    return fraud.percentile_rank(src.read(spark, d, "customer").select("c_custkey", v.alias("v")), "v")

"""Forecast models, evaluation, reasoning and consensus."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from veriloom.catalog import common  # noqa: F401
from veriloom.catalog.registry import frame_sql, query
from veriloom.functions import normal
from veriloom.functions.hashing import forecast_id
from veriloom.operators import consensus, forecast
from veriloom.operators import series as series_ops
from veriloom.session import materialise, work_dir
from veriloom.sources import files
from veriloom.sources import frames as src

AS_OF, TARGET = "2001-08-31", "2002-02-28"
Z90 = normal.Z[0.95]


def cdf_sql(z: str) -> str:
    t = f"(1 / (1 + {normal.ERF_P!r} * abs({z}) / sqrt(2.0)))"
    poly = "0"
    for a in reversed(normal.ERF_A):
        poly = f"(({poly} + {a!r}) * {t})"
    erf = f"(1 - {poly} * exp(-({z}) * ({z}) / 2))"
    return f"(0.5 * (1 + CASE WHEN {z} < 0 THEN -{erf} ELSE {erf} END))"


def crps_sql(m: str, s: str, a: str) -> str:
    z = f"(({a} - {m}) / {s})"
    return f"({s} * ({z} * (2 * {cdf_sql(z)} - 1) + 2 * exp(-{z} * {z} / 2) / sqrt(2 * pi()) - 1 / sqrt(pi())))"


frame_sql("bayes", """
SELECT series AS indicator, n, (m / (100 * sd * sd) + n / (sd * sd) * m) / (1 / (100 * sd * sd) + n / (sd * sd)) AS point_estimate, 1.5 * sqrt(1 / (1 / (100 * sd * sd) + n / (sd * sd))) AS std
FROM (SELECT series, avg(value) AS m, stddev_pop(value) AS sd, count(*) AS n FROM series GROUP BY 1)""")
frame_sql("montecarlo", f"""
SELECT series AS indicator, avg(value) + regr_slope(value, idx) * (DATE '{TARGET}' - DATE '{AS_OF}') / 30.0 AS point_estimate, stddev_pop(value) * sqrt((DATE '{TARGET}' - DATE '{AS_OF}') / 30.0) AS std
FROM series GROUP BY 1""")


def _bayes(spark, d):
    return forecast.bayes(src.series(spark, d), AS_OF, TARGET)


def _mc(spark, d):
    return forecast.montecarlo(src.series(spark, d), AS_OF, TARGET)


@query("forecast_bayes", "indicator forecast_id point_estimate:r std:r", "SELECT *, indicator || '_20010831_20020228' AS forecast_id FROM bayes")
def _(spark, d):
    return _bayes(spark, d)


@query("forecast_bayes_prior", "indicator point_estimate:r std:r", """
SELECT series AS indicator, (50.0 / 25 + n / (sd * sd) * m) / (1.0 / 25 + n / (sd * sd)) AS point_estimate, 2.5 * sqrt(1 / (1.0 / 25 + n / (sd * sd))) AS std
FROM (SELECT series, avg(value) AS m, stddev_pop(value) AS sd, count(*) AS n FROM series GROUP BY 1)""")
def _(spark, d):
    return forecast.bayes(src.series(spark, d), AS_OF, TARGET, "long_term", (50.0, 5.0))


@query("forecast_montecarlo", "indicator point_estimate:r std:r", "SELECT * FROM montecarlo")
def _(spark, d):
    return _mc(spark, d)


@query("forecast_distribution", "indicator q01:r q50:r q95:r lo80:r hi99:r", f"""
SELECT indicator, point_estimate + {normal.Z[0.01]!r} * std AS q01, point_estimate AS q50, point_estimate + {normal.Z[0.95]!r} * std AS q95,
 point_estimate + {normal.Z[0.10]!r} * std AS lo80, point_estimate + {normal.Z[0.995]!r} * std AS hi99 FROM montecarlo""")
def _(spark, d):
    df = forecast.with_distribution(_mc(spark, d))
    q, i = F.col("quantiles"), F.col("intervals")
    return df.select("indicator", q[F.lit(0.01)].alias("q01"), q[F.lit(0.5)].alias("q50"), q[F.lit(0.95)].alias("q95"),
                     i[F.lit(0.80)]["lo"].alias("lo80"), i[F.lit(0.99)]["hi"].alias("hi99"))


@query("probability_above", "indicator p_above:r p_below:r", f"""
SELECT indicator, 1 - {cdf_sql('((40.0 - point_estimate) / std)')} AS p_above, {cdf_sql('((40.0 - point_estimate) / std)')} AS p_below FROM montecarlo""")
def _(spark, d):
    return forecast.probability_above(_mc(spark, d), F.lit(40.0))


@query("probability_above_steps", "indicator p_above:r", """
SELECT indicator, coalesce(1 - min(CASE WHEN point_estimate + z * std >= 40.0 THEN q END), 0) AS p_above FROM montecarlo, (VALUES """
       + ", ".join(f"({q!r}, {normal.Z[q]!r})" for q in normal.QUANTILES) + ") AS t(q, z) GROUP BY 1")
def _(spark, d):
    df = forecast.with_distribution(_mc(spark, d))
    return df.withColumn("p_above", normal.probability_above_steps(F.lit(40.0), F.col("quantiles")))


@query("forecast_ensemble", "indicator n_models:i point_estimate:r std:r", """
SELECT indicator, 2 AS n_models, (2 * b.point_estimate + m.point_estimate) / 3 AS point_estimate,
 sqrt((2 * (pow(b.std, 2) + pow(b.point_estimate, 2)) + pow(m.std, 2) + pow(m.point_estimate, 2)) / 3 - pow((2 * b.point_estimate + m.point_estimate) / 3, 2)) AS std
FROM bayes b JOIN montecarlo m USING (indicator)""")
def _(spark, d):
    both = _bayes(spark, d).withColumn("weight", F.lit(2.0)).unionByName(_mc(spark, d).withColumn("weight", F.lit(1.0)))
    return forecast.ensemble(both)


@query("ensemble_pool", "indicator point_estimate:r std:r", """
SELECT indicator, avg(point_estimate) AS point_estimate, sqrt(avg(std * std + point_estimate * point_estimate) - pow(avg(point_estimate), 2)) AS std FROM expert_forecasts GROUP BY 1""")
def _(spark, d):
    return forecast.ensemble(src.expert_forecasts(spark, d).withColumn("weight", F.lit(0.25)))


@query("forecast_comparison", "indicator current_value:r forecast:r pct_change:r lower_90:r upper_90:r", f"""
SELECT indicator, v AS current_value, point_estimate AS forecast, (point_estimate - v) / v * 100 AS pct_change, point_estimate - {Z90!r} * std AS lower_90, point_estimate + {Z90!r} * std AS upper_90
FROM bayes JOIN (SELECT series AS indicator, arg_max(value, date) AS v FROM series GROUP BY 1) USING (indicator)""")
def _(spark, d):
    return forecast.comparison(src.series(spark, d), _bayes(spark, d))


@query("forecast_summary", "total_forecasts:i avg_uncertainty:r n_indicators:i", "SELECT count(*) AS total_forecasts, avg(std) AS avg_uncertainty, count(DISTINCT indicator) AS n_indicators FROM bayes")
def _(spark, d):
    return forecast.summary(_bayes(spark, d))


@query("forecast_id", "o_orderkey id", """
SELECT o_orderkey, o_orderpriority || '_' || strftime(o_orderdate, '%Y%m%d') || '_' || strftime(o_orderdate + INTERVAL 90 DAY, '%Y%m%d') AS id FROM orders""")
def _(spark, d):
    made = F.to_date("o_orderdate")
    return src.read(spark, d, "orders").select("o_orderkey", forecast_id(F.col("o_orderpriority"), made, F.date_add(made, 90)).alias("id"))


def _naive(pdf: pd.DataFrame) -> pd.DataFrame:
    last = pdf.sort_values("idx").tail(3)
    return pd.DataFrame({"series": [last["series"].iloc[0]], "point_estimate": [float(last["value"].mean())]})


@query("forecast_grouped", "series point_estimate:r", """
SELECT series, avg(value) AS point_estimate FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY idx DESC) AS r FROM series) WHERE r <= 3 GROUP BY 1""")
def _(spark, d):
    return forecast.forecast_grouped(src.series(spark, d), _naive, "series string, point_estimate double")


# ---- evaluation -------------------------------------------------------------------------------------

frame_sql("errs", """
SELECT *, actual - point_estimate AS error, abs(actual - point_estimate) AS absolute_error, pow(actual - point_estimate, 2) AS squared_error,
 CASE WHEN actual = 0 THEN 0 ELSE (actual - point_estimate) / actual * 100 END AS percentage_error, target_date - forecast_date AS horizon_days
FROM expert_forecasts JOIN forecast_actuals USING (forecast_id)""")


def _errors(spark, d):
    """Stored: the measures read it several times."""
    return materialise(forecast.errors(src.expert_forecasts(spark, d), src.forecast_actuals(spark, d)), "errors")


@query("forecast_actual_match", "forecast_id actual:r4 error:r absolute_error:r percentage_error:r squared_error:r horizon_days:i", "SELECT * FROM errs")
def _(spark, d):
    return _errors(spark, d)


def acc_sql(by: str) -> str:
    return f"""SELECT {by}, avg(absolute_error) AS mae, sqrt(avg(squared_error)) AS rmse, avg(abs(percentage_error)) AS mape, median(absolute_error) AS median_absolute_error,
 count(*) FILTER (error * point_estimate >= 0) / count(*) * 100 AS directional_accuracy, count(*) AS n_forecasts, avg(error) AS mean_bias FROM errs GROUP BY {by} HAVING count(*) >= 5"""


ACC = "mae:r rmse:r mape:r median_absolute_error:r directional_accuracy:r n_forecasts:i mean_bias:r"
frame_sql("acc", acc_sql("indicator"))


@query("forecast_accuracy", f"indicator {ACC}", "SELECT * FROM acc")
def _(spark, d):
    return forecast.accuracy(_errors(spark, d))


def cov_sql(by: str, min_n: int) -> str:
    rows = ", ".join(f"({lv!r}, {normal.Z[normal.INTERVALS[lv][1]]!r})" for lv in forecast.LEVELS)
    return f"""SELECT *, avg(width) OVER (PARTITION BY {by}) AS sharpness FROM (SELECT {by}, lv AS level, count(*) AS n, avg(CAST(actual BETWEEN point_estimate - z * std AND point_estimate + z * std AS INT)) AS actual_coverage,
 avg(2 * z * std) AS width FROM errs, (VALUES {rows}) AS t(lv, z) GROUP BY {by}, lv HAVING count(*) >= {min_n})"""


frame_sql("cov", cov_sql("indicator", 20))


@query("forecast_coverage", "indicator level:r2 n:i actual_coverage:r sharpness:r", "SELECT * FROM cov")
def _(spark, d):
    return forecast.coverage(_errors(spark, d))


@query("forecast_crps", "indicator n:i crps:r", f"SELECT indicator, count(*) AS n, avg({crps_sql('point_estimate', 'std', 'actual')}) AS crps FROM errs WHERE std > 0 GROUP BY 1 HAVING count(*) >= 10")
def _(spark, d):
    return forecast.crps(_errors(spark, d).where("std > 0"))


@query("crps_normal", "forecast_id score:r", f"SELECT forecast_id, CASE WHEN std > 0 THEN {crps_sql('point_estimate', 'std', 'actual')} ELSE absolute_error END AS score FROM errs")
def _(spark, d):
    return _errors(spark, d).withColumn("score", normal.crps(F.col("point_estimate"), F.col("std"), F.col("actual")))


@query("methodology_ranking", f"indicator methodology {ACC} is_best", f"""
SELECT *, row_number() OVER (PARTITION BY indicator ORDER BY mae, methodology) = 1 AS is_best FROM ({acc_sql('indicator, expertise_level')}) AS t, LATERAL (SELECT expertise_level AS methodology)""")
def _(spark, d):
    return forecast.methodology_ranking(_errors(spark, d).withColumnRenamed("expertise_level", "methodology"))


frame_sql("advice", """
SELECT indicator, CASE WHEN mean_bias > 0 THEN 'under_prediction' ELSE 'over_prediction' END AS rule, CAST(NULL AS DOUBLE) AS level, mean_bias AS value, 0.1 * mae AS threshold FROM acc WHERE abs(mean_bias) > 0.1 * mae
UNION ALL SELECT indicator, 'direction', NULL, directional_accuracy, 60 FROM acc WHERE directional_accuracy < 60
UNION ALL SELECT indicator, CASE WHEN level > actual_coverage THEN 'narrow' ELSE 'wide' END, level, actual_coverage, 0.10 FROM cov WHERE abs(level - actual_coverage) > 0.10""")
frame_sql("all_advice", "SELECT * FROM advice UNION ALL SELECT indicator, 'none', NULL, NULL, NULL FROM acc WHERE indicator NOT IN (SELECT indicator FROM advice)")


@query("evaluation_recommendations", "indicator rule level:r value:r threshold:r", "SELECT * FROM all_advice")
def _(spark, d):
    errs = _errors(spark, d)
    return forecast.recommendations(materialise(forecast.accuracy(errs), "accuracy"), materialise(forecast.coverage(errs), "coverage"))


@query("evaluation_report", "indicator first_target:d last_target:d mae:r rmse:r crps:r sharpness:r recommendations:j", f"""
SELECT s.indicator, first_target, last_target, mae, rmse, crps, sharpness, recommendations FROM (SELECT indicator, min(target_date) AS first_target, max(target_date) AS last_target FROM errs GROUP BY 1) s
 LEFT JOIN acc USING (indicator) LEFT JOIN (SELECT indicator, avg({crps_sql('point_estimate', 'std', 'actual')}) AS crps FROM errs WHERE std > 0 GROUP BY 1 HAVING count(*) >= 10) USING (indicator)
 LEFT JOIN (SELECT indicator, any_value(sharpness) AS sharpness FROM cov GROUP BY 1) USING (indicator)
 LEFT JOIN (SELECT indicator, list(rule || coalesce(printf(' %.2f', level), '') ORDER BY rule, level) AS recommendations FROM all_advice GROUP BY 1) USING (indicator)""")
def _(spark, d):
    report = forecast.evaluation_report(src.expert_forecasts(spark, d), src.forecast_actuals(spark, d))
    text = lambda r: F.concat(r["rule"], F.coalesce(F.concat(F.lit(" "), F.format_number(r["level"], 2)), F.lit("")))
    return report.withColumn("recommendations", F.transform("recommendations", text))


@query("backtest_summary", "series mae:r rmse:r mape:r median_ae:r n_forecasts:i", """
SELECT series, avg(absolute_error) AS mae, sqrt(avg(squared_error)) AS rmse, avg(abs(percentage_error)) AS mape, median(absolute_error) AS median_ae, count(*) AS n_forecasts FROM backtest GROUP BY 1""")
def _(spark, d):
    return forecast.backtest_summary(series_ops.backtest(src.series(spark, d), 24, 3, 2))


# ---- experts and consensus --------------------------------------------------------------------------

frame_sql("perf", "SELECT expert_id, avg(absolute_error) AS mae, median(absolute_error) AS median_ae, sqrt(avg(squared_error)) AS rmse, count(*) AS n_forecasts FROM errs GROUP BY 1")
frame_sql("weighed", """
SELECT e.*, mae, CASE expertise_level WHEN 'novice' THEN 0.5 WHEN 'expert' THEN 1.5 WHEN 'master' THEN 2.0 ELSE 1.0 END / greatest(mae, 0.1) * (1 - abs(1 - calibration)) AS weight
FROM expert_forecasts e LEFT JOIN perf USING (expert_id)""")


def _weighed(spark, d):
    e = src.expert_forecasts(spark, d)
    return consensus.weighted_experts(e, consensus.expert_performance(e, src.forecast_actuals(spark, d)))


@query("expert_performance", "expert_id mae:r median_ae:r rmse:r n_forecasts:i", "SELECT * FROM perf")
def _(spark, d):
    return consensus.expert_performance(src.expert_forecasts(spark, d), src.forecast_actuals(spark, d))


@query("expert_calibration", "expert_id level:r2 actual_coverage:r width:r", f"SELECT * FROM ({cov_sql('expert_id', 1)})")
def _(spark, d):
    return consensus.expert_calibration(src.expert_forecasts(spark, d), src.forecast_actuals(spark, d))


@query("expert_weight", "forecast_id weight:r", "SELECT * FROM weighed")
def _(spark, d):
    return _weighed(spark, d)


CONS = "indicator target_date:d n_experts:i consensus:r consensus_std:r"
frame_sql("cons_weighted", """
SELECT indicator, target_date, count(*) AS n_experts, sum(weight * point_estimate) / sum(weight) AS consensus, sqrt(sum(weight * std * std) / sum(weight)) AS consensus_std FROM weighed GROUP BY 1, 2""")


@query("consensus_simple", CONS, "SELECT indicator, target_date, count(*) AS n_experts, avg(point_estimate) AS consensus, sqrt(avg(std * std)) AS consensus_std FROM expert_forecasts GROUP BY 1, 2")
def _(spark, d):
    return consensus.simple(src.expert_forecasts(spark, d))


@query("consensus_weighted", CONS, "SELECT * FROM cons_weighted")
def _(spark, d):
    return consensus.build(_weighed(spark, d))


@query("consensus_median", CONS, """
SELECT indicator, target_date, count(*) AS n_experts, any_value(m) AS consensus, 1.4826 * median(abs(point_estimate - m)) AS consensus_std FROM (
 SELECT *, median(point_estimate) OVER (PARTITION BY indicator, target_date) AS m FROM expert_forecasts) GROUP BY 1, 2""")
def _(spark, d):
    return consensus.build(src.expert_forecasts(spark, d), "median")


@query("consensus_trimmed", "indicator n_experts:i consensus:r consensus_std:r", """
SELECT indicator, any_value(n) AS n_experts, avg(point_estimate) AS consensus, stddev_pop(point_estimate) AS consensus_std FROM (
 SELECT *, row_number() OVER (PARTITION BY indicator ORDER BY point_estimate) - 1 AS r, count(*) OVER (PARTITION BY indicator) AS n FROM expert_forecasts)
WHERE r >= floor(n * 0.1) AND r < n - floor(n * 0.1) GROUP BY 1""")
def _(spark, d):
    return consensus.trimmed(src.expert_forecasts(spark, d), 0.1, ["indicator"])


@query("consensus_performance", CONS, """
SELECT indicator, target_date, count(*) AS n_experts, sum(point_estimate / (mae + 0.1)) / sum(1 / (mae + 0.1)) AS consensus, sqrt(sum(std * std / (mae + 0.1)) / sum(1 / (mae + 0.1))) AS consensus_std FROM weighed GROUP BY 1, 2""")
def _(spark, d):
    return consensus.build(_weighed(spark, d), "performance_weighted")


frame_sql("strengths", """
SELECT *, CASE WHEN agreement_score > 0.8 THEN 'strong' WHEN agreement_score > 0.6 THEN 'moderate' ELSE 'weak' END AS consensus_strength FROM (SELECT *, 1 / (1 + coefficient_of_variation) AS agreement_score FROM (
 SELECT indicator, target_date, count(*) AS n_experts, avg(point_estimate) AS mean_estimate, median(point_estimate) AS median_estimate, stddev_pop(point_estimate) AS std_dev,
  max(point_estimate) - min(point_estimate) AS range, stddev_pop(point_estimate) / abs(avg(point_estimate)) AS coefficient_of_variation FROM expert_forecasts GROUP BY 1, 2))""")


@query("consensus_strength", "indicator target_date:d n_experts:i mean_estimate:r median_estimate:r std_dev:r range:r coefficient_of_variation:r agreement_score:r consensus_strength", "SELECT * FROM strengths")
def _(spark, d):
    return consensus.strength(src.expert_forecasts(spark, d))


# ---- reasoning --------------------------------------------------------------------------------------

@query("scenario_rows", "forecast_id scenario scenario_value:r probability:r", """
SELECT forecast_id, s AS scenario, point_estimate * f AS scenario_value, p AS probability FROM expert_forecasts, (VALUES ('base', 1.0, 0.6), ('optimistic', 1.5, 0.2), ('pessimistic', 0.5, 0.2)) AS t(s, f, p)""")
def _(spark, d):
    return forecast.scenarios(src.expert_forecasts(spark, d))


@query("reasoning_evidence", "series step:i description quantity:r reliability", """
SELECT series, unnest([1, 2, 3]) AS step, unnest(['Historical average: ' || printf('%.2f', round(m, 2)), 'Recent ' || CASE WHEN s > 0 THEN 'upward' ELSE 'downward' END || ' trend of ' || printf('%.2f', round(abs(s), 2)),
  'Historical volatility: ' || printf('%.2f', round(v, 2))]) AS description, unnest([m, s, v]) AS quantity, unnest(['high', 'medium', 'high']) AS reliability
FROM (SELECT series, avg(value) AS m, avg(value) FILTER (idx >= n - 12) - avg(value) FILTER (idx < n - 12) AS s, stddev_pop(value) AS v FROM (SELECT *, count(*) OVER (PARTITION BY series) AS n FROM series) GROUP BY 1)""")
def _(spark, d):
    return forecast.reasoning_evidence(src.series(spark, d))


def _rationales(spark, d):
    """Documented reasoning per expert forecast; its completeness varies with month and expert."""
    m, g = F.month("target_date"), F.substring("expert_id", 1, 1).cast("int")
    assumption = F.struct(F.lit("Demand holds").alias("description"), F.when(g % 2 == 0, "high").otherwise("low").alias("sensitivity"),
                          F.when(m % 5 == 0, F.array(F.lit("Demand falls"))).otherwise(F.array().cast("array<string>")).alias("alternatives"))
    ev = F.when(m % 4 != 0, F.transform(F.sequence(F.lit(1), m % 4), lambda k: F.struct(
        F.concat(F.lit("source "), (k + g % 2).cast("string")).alias("description"), F.when(k <= g % 3, "low").otherwise("high").alias("reliability"))))
    steps = F.when(m % 6 != 0, F.transform(F.sequence(F.lit(1), m % 6), lambda k: F.concat(F.lit("step "), k.cast("string"))))
    empty = forecast.rationale_skeleton(src.expert_forecasts(spark, d))
    src_cols = src.expert_forecasts(spark, d).select("forecast_id", "expert_id", "target_date")
    df = empty.join(src_cols, "forecast_id")
    return df.withColumns({
        "executive_summary": F.when(m % 4 != 0, "Outlook").otherwise(""),
        "assumptions": F.when(m % 3 != 0, F.array(assumption)).otherwise(F.col("assumptions")),
        "evidence": F.coalesce(ev, F.col("evidence")), "steps": F.coalesce(steps, F.col("steps"))})


frame_sql("rationales", """
SELECT forecast_id, indicator, target_date, expert_id, point_estimate, m % 4 AS n_ev, m % 6 AS n_steps, m % 3 <> 0 AS has_assumption, CASE WHEN m % 4 = 0 THEN '' ELSE 'Outlook' END AS executive_summary,
 g % 2 = 0 AND m % 5 <> 0 AND m % 3 <> 0 AS bare, least(g % 3, m % 4) AS n_low, [k + g % 2 FOR k IN range(1, m % 4 + 1)] AS sources FROM (
 SELECT *, month(target_date) AS m, CAST(substr(expert_id, 1, 1) AS INTEGER) AS g FROM expert_forecasts)""")


@query("rationale_consistency", "forecast_id is_valid issues:j warnings:j", """
SELECT forecast_id, n_ev > 0 AND n_steps > 0 AS is_valid, [x FOR x IN [CASE WHEN n_ev = 0 THEN 'No evidence sources provided' END, CASE WHEN n_steps = 0 THEN 'Empty reasoning chain' END] IF x IS NOT NULL] AS issues,
 [x FOR x IN [CASE WHEN executive_summary = '' THEN 'Missing executive summary' END, CASE WHEN NOT has_assumption THEN 'No key assumptions documented' END,
  CASE WHEN bare THEN 'High-sensitivity assumption without alternatives: Demand holds' END, CASE WHEN n_low > n_ev / 2 THEN 'More than 50% of evidence sources have low confidence' END] IF x IS NOT NULL] AS warnings FROM rationales""")
def _(spark, d):
    return forecast.rationale_consistency(_rationales(spark, d))


@query("rationale_skeleton", "forecast_id indicator created_by executive_summary n_evidence:i", """
SELECT forecast_id, indicator, 'System' AS created_by, '' AS executive_summary, 0 AS n_evidence FROM expert_forecasts""")
def _(spark, d):
    return forecast.rationale_skeleton(src.expert_forecasts(spark, d)).withColumn("n_evidence", F.size("evidence"))


@query("rationale_revision", "forecast_id n_revisions:i reason", """
SELECT forecast_id, CASE WHEN point_estimate > 2.5 THEN 1 ELSE 0 END AS n_revisions, CASE WHEN point_estimate > 2.5 THEN 'estimate above 2.5' END AS reason FROM expert_forecasts""")
def _(spark, d):
    e = src.expert_forecasts(spark, d)
    rev = e.where("point_estimate > 2.5").select("forecast_id", F.lit("2001-08-31").alias("revised_at"), F.lit("estimate above 2.5").alias("reason"),
                                                 F.lit("checked").alias("changes"), F.col("expert_id").alias("revised_by"))
    out = forecast.revise_rationale(forecast.rationale_skeleton(e), rev)
    return out.withColumn("n_revisions", F.size("revisions")).withColumn("reason", F.try_element_at("revisions", F.lit(1))["reason"])


@query("evidence_overlap", "forecast1 forecast2 n_common:i n_only_1:i n_only_2:i overlap_pct:r estimate_difference:r", """
SELECT a.forecast_id AS forecast1, b.forecast_id AS forecast2, len(list_intersect(a.sources, b.sources)) AS n_common, len(a.sources) - len(list_intersect(a.sources, b.sources)) AS n_only_1,
 len(b.sources) - len(list_intersect(a.sources, b.sources)) AS n_only_2, CASE WHEN greatest(len(a.sources), len(b.sources)) = 0 THEN 0 ELSE len(list_intersect(a.sources, b.sources)) * 100 / greatest(len(a.sources), len(b.sources)) END AS overlap_pct,
 a.point_estimate - b.point_estimate AS estimate_difference FROM rationales a JOIN rationales b USING (indicator, target_date) WHERE a.expert_id = '1-URGENT' AND b.expert_id = '2-HIGH'""")
def _(spark, d):
    e = src.expert_forecasts(spark, d).select("expert_id", "indicator", "target_date", "forecast_id")
    one = e.where("expert_id = '1-URGENT'").select("indicator", "target_date", F.col("forecast_id").alias("forecast1"))
    two = e.where("expert_id = '2-HIGH'").select("indicator", "target_date", F.col("forecast_id").alias("forecast2"))
    pairs = one.join(two, ["indicator", "target_date"]).select("forecast1", "forecast2")
    out = forecast.evidence_overlap(_rationales(spark, d), pairs, src.expert_forecasts(spark, d))
    return out.withColumns({"n_common": F.size("common"), "n_only_1": F.size("only_1"), "n_only_2": F.size("only_2")})


@query("forecast_records_sink", "indicator forecast_id ci_90_lower:r ci_90_upper:r ci_95_lower:r ci_95_upper:r methodology", f"""
SELECT indicator, indicator || '_20010831_20020228' AS forecast_id, point_estimate - {normal.Z[0.95]!r} * std AS ci_90_lower, point_estimate + {normal.Z[0.95]!r} * std AS ci_90_upper,
 point_estimate - {normal.Z[0.975]!r} * std AS ci_95_lower, point_estimate + {normal.Z[0.975]!r} * std AS ci_95_upper, 'Bayesian inference with conjugate prior' AS methodology FROM bayes""")
def _(spark, d):
    return files.read_rows(spark, files.append_rows(forecast.forecast_records(_bayes(spark, d)), work_dir(spark, "forecasts")))


@query("consensus_records_sink", "indicator target_date:d point_estimate:r ci_90_lower:r n_experts:i consensus_strength agreement_score:r", f"""
SELECT *, consensus AS point_estimate, consensus - {normal.Z[0.95]!r} * consensus_std AS ci_90_lower FROM cons_weighted JOIN (SELECT indicator, target_date, consensus_strength, agreement_score FROM strengths) USING (indicator, target_date)""")
def _(spark, d):
    e = _weighed(spark, d)
    rows = consensus.consensus_records(consensus.build(e), consensus.strength(e))
    return files.read_rows(spark, files.append_rows(rows, work_dir(spark, "consensus")))


@query("rationale_records_sink", "forecast_id executive_summary n_assumptions:i n_evidence_sources:i", """
SELECT forecast_id, executive_summary, CASE WHEN has_assumption THEN 1 ELSE 0 END AS n_assumptions, n_ev AS n_evidence_sources FROM rationales""")
def _(spark, d):
    return files.read_rows(spark, files.append_rows(forecast.rationale_records(_rationales(spark, d)), work_dir(spark, "rationales")))


@query("contribution_records_sink", "forecast_id expert_id point_estimate:r4 weight:r", "SELECT * FROM weighed")
def _(spark, d):
    return files.read_rows(spark, files.append_rows(consensus.contribution_records(_weighed(spark, d)), work_dir(spark, "contributions")))

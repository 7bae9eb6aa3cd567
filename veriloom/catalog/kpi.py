"""Key figures over the fact table."""

from __future__ import annotations

from pyspark.sql import functions as F

from veriloom.catalog.common import fact
from veriloom.catalog.marts import _slim_fact
from veriloom.catalog.registry import query
from veriloom.operators import marts
from veriloom.sources import frames as src


@query("kpi_volume", "TestCode total_results:i total_patients:i total_tests:i total_orders:i", """
SELECT TestCode, count(*) AS total_results, count(DISTINCT PatientKey) AS total_patients, count(DISTINCT TestKey) AS total_tests, count(DISTINCT OrderId) AS total_orders
FROM fact GROUP BY 1""")
def _(spark, d):
    return marts.kpi_volume(_slim_fact(spark, d), ["TestCode"])


@query("kpi_rates", "LaboratoryKey:i critical_values:i critical_rate:r out_of_range:i out_of_range_rate:r anomalous:i anomaly_rate:r avg_anomaly_score:r", """
SELECT LaboratoryKey, count(*) FILTER (CriticalFlag) AS critical_values, count(*) FILTER (CriticalFlag) / count(*) AS critical_rate, count(*) FILTER (IsOutOfRange) AS out_of_range,
 count(*) FILTER (IsOutOfRange) / count(*) AS out_of_range_rate, count(*) FILTER (IsAnomaly) AS anomalous, count(*) FILTER (IsAnomaly) / count(*) AS anomaly_rate,
 avg(AnomalyScore) AS avg_anomaly_score FROM fact GROUP BY 1""")
def _(spark, d):
    return marts.kpi_rates(_slim_fact(spark, d), ["LaboratoryKey"])


@query("kpi_tat", "TestCode avg_hours:r median_hours:r sla_share:r tat_display", """
SELECT TestCode, avg(TurnaroundTimeMinutes) / 60 AS avg_hours, median(TurnaroundTimeMinutes) / 60 AS median_hours, count(*) FILTER (TurnaroundTimeMinutes <= 240) / count(*) AS sla_share,
 printf('%.1f hrs', round(avg(TurnaroundTimeMinutes) / 60, 1)) AS tat_display FROM lab GROUP BY 1""")
def _(spark, d):
    return marts.kpi_turnaround(src.lab(spark, d), ["TestCode"])


@query("kpi_mtd_ytd", "day:d results:i mtd:i ytd:i", """
SELECT day, results, sum(results) OVER (PARTITION BY date_trunc('month', day) ORDER BY day) AS mtd, sum(results) OVER (PARTITION BY year(day) ORDER BY day) AS ytd
FROM (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS results FROM orders GROUP BY 1)""")
def _(spark, d):
    return marts.kpi_to_date(src.read(spark, d, "orders"), "o_orderdate")


MONTHLY = "WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS results FROM orders GROUP BY 1)"


@query("kpi_mom", "month:d results:i previous_month:i growth:r growth_text trend", MONTHLY + """
SELECT *, printf('%.1f%%', round(growth * 100, 1)) AS growth_text, CASE WHEN growth > 0.1 THEN '↑ Growing' WHEN growth < -0.1 THEN '↓ Declining' ELSE '→ Stable' END AS trend FROM (
 SELECT m.month, m.results, p.results AS previous_month, coalesce((m.results - p.results) / p.results, 0) AS growth FROM m LEFT JOIN m p ON p.month = m.month - INTERVAL 1 MONTH)""")
def _(spark, d):
    return marts.kpi_month_over_month(src.read(spark, d, "orders"), "o_orderdate")


@query("kpi_yoy", "month:d results:i same_month_last_year:i growth:r", MONTHLY + """
SELECT m.month, m.results, p.results AS same_month_last_year, coalesce((m.results - p.results) / p.results, 0) AS growth FROM m LEFT JOIN m p ON p.month = m.month - INTERVAL 12 MONTH""")
def _(spark, d):
    return marts.kpi_year_over_year(src.read(spark, d, "orders"), "o_orderdate")


@query("kpi_patient", "TestCode tests_per_patient:r avg_tests_per_patient_day:r patients_with_critical:i", """
SELECT TestCode, count(*) / count(DISTINCT PatientKey) AS tests_per_patient, count(*) / count(DISTINCT (PatientKey, ResultDateKey)) AS avg_tests_per_patient_day,
 count(DISTINCT PatientKey) FILTER (CriticalFlag) AS patients_with_critical FROM fact GROUP BY 1""")
def _(spark, d):
    return marts.kpi_patient(_slim_fact(spark, d), ["TestCode"])


@query("kpi_test", "most_common_test utilization_rate:r", """
SELECT (SELECT TestCode FROM fact GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS most_common_test, count(*) / (count(DISTINCT PatientKey) * count(DISTINCT TestKey)) AS utilization_rate FROM fact""")
def _(spark, d):
    return marts.kpi_test(_slim_fact(spark, d))


@query("kpi_validation", "TestCode validation_pass_rate:r range_violations:i temporal_issues:i specimen_issues:i", """
SELECT TestCode, count(*) FILTER (ReferenceRangeValid AND TemporalConsistencyValid AND SpecimenValid) / count(*) AS validation_pass_rate,
 count(*) FILTER (NOT ReferenceRangeValid) AS range_violations, count(*) FILTER (NOT TemporalConsistencyValid) AS temporal_issues, count(*) FILTER (NOT SpecimenValid) AS specimen_issues
FROM fact GROUP BY 1""")
def _(spark, d):
    return marts.kpi_validation(fact(spark, d), ["TestCode"])


@query("kpi_percentiles", "TestCode p50:r p95:r p99:r", """
SELECT TestCode, quantile_cont(ResultValueNumeric, 0.5) AS p50, quantile_cont(ResultValueNumeric, 0.95) AS p95, quantile_cont(ResultValueNumeric, 0.99) AS p99 FROM lab GROUP BY 1""")
def _(spark, d):
    return marts.kpi_percentiles(src.lab(spark, d), ["TestCode"])


@query("kpi_completeness", "TestCode completeness:r missing_values:i", """
SELECT TestCode, count(ResultValueNumeric) / count(*) AS completeness, count(*) FILTER (ResultValueNumeric IS NULL) AS missing_values FROM fact GROUP BY 1""")
def _(spark, d):
    return marts.kpi_completeness(_slim_fact(spark, d), ["TestCode"])


@query("kpi_daily_volume", "TestCode avg_daily_volume:r peak_daily_volume:i", """
SELECT TestCode, avg(n) AS avg_daily_volume, max(n) AS peak_daily_volume FROM (SELECT TestCode, ResultDateKey, count(*) AS n FROM fact GROUP BY 1, 2) GROUP BY 1""")
def _(spark, d):
    return marts.kpi_daily_volume(_slim_fact(spark, d), ["TestCode"])


@query("kpi_quality_score", "TestCode quality_score:r", """
SELECT TestCode, 0.4 * count(*) FILTER (ReferenceRangeValid AND TemporalConsistencyValid AND SpecimenValid) / count(*) + 0.3 * (1 - count(*) FILTER (CriticalFlag) / count(*))
 + 0.3 * (1 - count(*) FILTER (IsAnomaly) / count(*)) AS quality_score FROM fact GROUP BY 1""")
def _(spark, d):
    return marts.kpi_quality_score(fact(spark, d), ["TestCode"])


@query("kpi_colors", "LaboratoryKey:i critical_rate:r sla_share:r critical_color turnaround_color", """
SELECT *, CASE WHEN critical_rate > 0.05 THEN 'Red' WHEN critical_rate > 0.02 THEN 'Yellow' ELSE 'Green' END AS critical_color,
 CASE WHEN sla_share < 0.8 THEN 'Red' WHEN sla_share < 0.9 THEN 'Yellow' ELSE 'Green' END AS turnaround_color FROM (
 SELECT LaboratoryKey, count(*) FILTER (CriticalFlag) / count(*) AS critical_rate, count(*) FILTER (TurnaroundTimeMinutes <= 240) / count(*) AS sla_share FROM fact GROUP BY 1)""")
def _(spark, d):
    return marts.kpi_colors(_slim_fact(spark, d), ["LaboratoryKey"])


@query("kpi_dashboard", "total_results:i total_patients:i critical_values:i critical_rate:r out_of_range_rate:r anomaly_rate:r avg_hours:r median_hours:r sla_share:r "
       "validation_pass_rate:r range_violations:i missing_values:i", """
SELECT count(*) AS total_results, count(DISTINCT PatientKey) AS total_patients, count(*) FILTER (CriticalFlag) AS critical_values, count(*) FILTER (CriticalFlag) / count(*) AS critical_rate,
 count(*) FILTER (IsOutOfRange) / count(*) AS out_of_range_rate, count(*) FILTER (IsAnomaly) / count(*) AS anomaly_rate, avg(TurnaroundTimeMinutes) / 60 AS avg_hours,
 median(TurnaroundTimeMinutes) / 60 AS median_hours, count(*) FILTER (TurnaroundTimeMinutes <= 240) / count(*) AS sla_share,
 count(*) FILTER (ReferenceRangeValid AND TemporalConsistencyValid AND SpecimenValid) / count(*) AS validation_pass_rate, count(*) FILTER (NOT ReferenceRangeValid) AS range_violations,
 count(*) FILTER (ResultValueNumeric IS NULL) AS missing_values FROM fact""")
def _(spark, d):
    return marts.kpi_dashboard(fact(spark, d))

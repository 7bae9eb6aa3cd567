"""Gold marts and star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from veriloom.catalog.common import dim_patient, fact, ranged, validated
from veriloom.catalog.registry import frame_sql, query
from veriloom.operators import marts, rules
from veriloom.sources import frames as src


@query("fact_derived", "ResultId IsOutOfRange PercentOfReferenceRangeMax:r", "SELECT * FROM fact")
def _(spark, d):
    return marts.fact_derived(src.lab(spark, d))


@query("result_category", "ResultId category", """
SELECT ResultId, CASE WHEN CriticalFlag THEN 'Critical' WHEN IsOutOfRange THEN 'Out of Range' WHEN IsAnomaly THEN 'Anomalous' ELSE 'Normal' END AS category FROM fact""")
def _(spark, d):
    return marts.fact_derived(ranged(spark, d)).withColumn("category", marts.result_category())


@query("tat_category", "ResultId category", """
SELECT ResultId, CASE WHEN TurnaroundTimeMinutes <= 120 THEN '< 2 hours' WHEN TurnaroundTimeMinutes <= 240 THEN '2-4 hours'
 WHEN TurnaroundTimeMinutes <= 480 THEN '4-8 hours' ELSE '> 8 hours' END AS category FROM lab""")
def _(spark, d):
    return src.lab(spark, d).withColumn("category", marts.turnaround_category())


@query("latest_two", "PatientId TestCode CurrentValue:r PreviousValue:r", """
SELECT PatientId, TestCode, max(CASE WHEN r = 1 THEN ResultValueNumeric END) AS CurrentValue, max(CASE WHEN r = 2 THEN ResultValueNumeric END) AS PreviousValue
FROM (SELECT *, row_number() OVER (PARTITION BY PatientId, TestCode ORDER BY ResultDate DESC, ResultId DESC) AS r FROM lab) GROUP BY 1, 2""")
def _(spark, d):
    return marts.latest_two(src.lab(spark, d))


@query("patient_test_summary", "PatientId TestCode TotalTests:i TotalAbnormal:i TotalCritical:i TotalAnomalies:i MinValue:r MaxValue:r AvgValue:r9 "
       "StdDevValue:r FirstTestDate:t LastTestDate:t CurrentValue:r PreviousValue:r PercentChange:r4 TrendDirection", """
SELECT *, CASE WHEN PercentChange > 10 THEN 'Increasing' WHEN PercentChange < -10 THEN 'Decreasing' ELSE 'Stable' END AS TrendDirection FROM (
 SELECT *, CASE WHEN PreviousValue <> 0 THEN (CurrentValue - PreviousValue) / PreviousValue * 100 END AS PercentChange FROM (
  SELECT PatientId, TestCode, count(*) AS TotalTests, count(*) FILTER (AbnormalFlag IN ('H', 'L')) AS TotalAbnormal, count(*) FILTER (CriticalFlag) AS TotalCritical,
   count(*) FILTER (IsAnomaly) AS TotalAnomalies, min(ResultValueNumeric) AS MinValue, max(ResultValueNumeric) AS MaxValue, avg(ResultValueNumeric) AS AvgValue,
   stddev_samp(ResultValueNumeric) AS StdDevValue, min(ResultDate) AS FirstTestDate, max(ResultDate) AS LastTestDate,
   max(CASE WHEN r = 1 THEN ResultValueNumeric END) AS CurrentValue, max(CASE WHEN r = 2 THEN ResultValueNumeric END) AS PreviousValue
  FROM (SELECT *, row_number() OVER (PARTITION BY PatientId, TestCode ORDER BY ResultDate DESC, ResultId DESC) AS r FROM validated_lab) GROUP BY 1, 2))""")
def _(spark, d):
    return marts.patient_test_summary(ranged(spark, d))


@query("daily_quality_metrics", "MetricDate:d PerformingLabId:i TestCode TotalTests:i CriticalValues:i AnomalousResults:i ValidationFailures:i "
       "AvgTurnaroundTimeMinutes:r MissingResults:i CriticalValueRate:r AnomalyRate:r ValidationFailureRate:r CompletenessRate:r", """
SELECT *, CriticalValues / TotalTests * 100 AS CriticalValueRate, AnomalousResults / TotalTests * 100 AS AnomalyRate,
 ValidationFailures / TotalTests * 100 AS ValidationFailureRate, (TotalTests - MissingResults) / TotalTests * 100 AS CompletenessRate FROM (
 SELECT CAST(ResultDate AS DATE) AS MetricDate, PerformingLabId, TestCode, count(*) AS TotalTests, count(*) FILTER (CriticalFlag) AS CriticalValues,
  count(*) FILTER (IsAnomaly) AS AnomalousResults, count(*) FILTER (NOT ReferenceRangeValid) AS ValidationFailures, avg(TurnaroundTimeMinutes) AS AvgTurnaroundTimeMinutes,
  count(*) FILTER (ResultValueNumeric IS NULL) AS MissingResults FROM validated_lab GROUP BY 1, 2, 3)""")
def _(spark, d):
    return marts.daily_quality_metrics(ranged(spark, d))


frame_sql("utilization", """
SELECT TestCode, count(*) AS TotalOrders, count(ResultValueNumeric) AS CompletedResults, count(DISTINCT PatientId) AS UniquePatients,
 avg(TurnaroundTimeMinutes) AS AvgTurnaroundTime, count(*) FILTER (CriticalFlag) AS CriticalCount, count(ResultValueNumeric) / count(*) * 100 AS CompletionRate
FROM validated_lab GROUP BY 1""")


@query("test_utilization", "TestCode TotalOrders:i CompletedResults:i UniquePatients:i AvgTurnaroundTime:r CriticalCount:i CompletionRate:r", "SELECT * FROM utilization")
def _(spark, d):
    return marts.test_utilization(ranged(spark, d))


@query("utilization_with_master", "TestCode TotalOrders:i TestName TestCategory TargetMinutes:i", "SELECT * FROM utilization LEFT JOIN x_tests USING (TestCode)")
def _(spark, d):
    return marts.utilization_with_master(marts.test_utilization(ranged(spark, d)), rules.test_catalogue(spark))


@query("quality_metrics_full", "MetricDate:d PerformingLabId:i TestCode TotalTests:i TotalOrders:i StatOrders:i CriticalValues:i AnomalousResults:i ValidationFailures:i "
       "Recollections:i AvgTurnaroundTimeMinutes:r MedianTurnaroundTimeMinutes:r PercentMeetingSLA:r MissingResults:i IncompleteOrders:i", """
SELECT * FROM (SELECT CAST(ResultDate AS DATE) AS MetricDate, PerformingLabId, TestCode, count(*) AS TotalTests, count(*) FILTER (CriticalFlag) AS CriticalValues,
  count(*) FILTER (IsAnomaly) AS AnomalousResults, count(*) FILTER (NOT ReferenceRangeValid) AS ValidationFailures, avg(TurnaroundTimeMinutes) AS AvgTurnaroundTimeMinutes,
  median(TurnaroundTimeMinutes) AS MedianTurnaroundTimeMinutes, count(*) FILTER (TurnaroundTimeMinutes <= 240) / count(*) * 100 AS PercentMeetingSLA,
  count(*) FILTER (ResultValueNumeric IS NULL) AS MissingResults FROM validated_lab GROUP BY 1, 2, 3)
LEFT JOIN (SELECT MetricDate, PerformingLabId, TestCode, count(*) AS TotalOrders, count(*) FILTER (OrderId % 10 = 0) AS StatOrders, count(*) FILTER (h > 0) AS Recollections,
  count(*) FILTER (missing > 0) AS IncompleteOrders FROM (SELECT OrderId, PatientId, TestCode, PerformingLabId, CAST(ResultDate AS DATE) AS MetricDate,
   count(*) FILTER (SpecimenQuality = 'Hemolyzed') AS h, count(*) FILTER (ResultValueNumeric IS NULL) AS missing FROM lab GROUP BY 1, 2, 3, 4, 5) GROUP BY 1, 2, 3)
USING (MetricDate, PerformingLabId, TestCode)""")
def _(spark, d):
    return marts.quality_metrics_full(ranged(spark, d), marts.test_orders(src.lab(spark, d)))


@query("current_rows", "PatientId PatientKey Race Age:i AgeGroup", "SELECT * FROM dim_patient WHERE IsCurrent")
def _(spark, d):
    return marts.current_rows(dim_patient(spark, d))


@query("fact_build", "ResultId PatientKey TestKey OrderDateKey:i ResultDateKey:i ResultTimeKey:i LaboratoryKey:i IsOutOfRange PercentOfReferenceRangeMax:r "
       "CriticalFlag IsAnomaly ReferenceRangeValid TemporalConsistencyValid SpecimenValid", "SELECT * FROM fact")
def _(spark, d):
    return fact(spark, d)


@query("latest_result_per_test", "PatientKey TestCode ResultId ResultValueNumeric:r", """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY PatientKey, TestCode ORDER BY ResultDate DESC, ResultId DESC) AS rn FROM fact WHERE ResultStatus = 'FINAL') WHERE rn = 1""")
def _(spark, d):
    return marts.latest_result_per_test(_slim_fact(spark, d))


def _slim_fact(spark, d):
    """Facts from the range-checked results, for queries that need no temporal flags."""
    return marts.fact_lab_result(ranged(spark, d), dim_patient(spark, d), marts.dim_test(rules.test_catalogue(spark)))


PIVOT = " ".join(f"Latest_{n}:r Latest_{n}_Date:d" for n in marts.PIVOT_TESTS.values())
frame_sql("pivoted", "SELECT PatientKey, " + ", ".join(
    f"max(CASE WHEN TestCode = '{c}' THEN ResultValueNumeric END) AS Latest_{n}, max(CASE WHEN TestCode = '{c}' THEN CAST(ResultDate AS DATE) END) AS Latest_{n}_Date"
    for c, n in marts.PIVOT_TESTS.items()) + """ FROM (SELECT * FROM (SELECT *,
 row_number() OVER (PARTITION BY PatientKey, TestCode ORDER BY ResultDate DESC, ResultId DESC) AS rn FROM fact WHERE ResultStatus = 'FINAL') WHERE rn = 1) GROUP BY 1""")


@query("pivot_latest", f"PatientKey {PIVOT}", "SELECT DISTINCT f.PatientKey, p.* EXCLUDE (PatientKey) FROM fact f LEFT JOIN pivoted p USING (PatientKey)")
def _(spark, d):
    return marts.pivot_latest(_slim_fact(spark, d))


@query("unified_patient_view", f"PatientKey PatientId MRN Age:i AgeGroup Gender Race {PIVOT} TotalUniqueTests:i TotalLabResults:i TotalCriticalValues:i TotalAnomalies:i LastTestDate:d", """
SELECT * FROM (SELECT * FROM dim_patient WHERE IsCurrent) LEFT JOIN pivoted USING (PatientKey) LEFT JOIN (
 SELECT PatientKey, count(DISTINCT TestKey) AS TotalUniqueTests, count(*) AS TotalLabResults, count(*) FILTER (CriticalFlag) AS TotalCriticalValues,
  count(*) FILTER (IsAnomaly) AS TotalAnomalies, CAST(max(ResultDate) AS DATE) AS LastTestDate FROM fact GROUP BY 1) USING (PatientKey)""")
def _(spark, d):
    return marts.unified_patient_view(_slim_fact(spark, d), dim_patient(spark, d))


@query("hierarchy_rollup", "TestCategory CategoryLevel2 CategoryLevel3 TestCode depth:i n_results:i n_critical:i", """
SELECT TestCategory, CategoryLevel2, CategoryLevel3, TestCode, 4 - bit_count(grouping(TestCategory, CategoryLevel2, CategoryLevel3, TestCode)) AS depth,
 count(*) AS n_results, count(*) FILTER (CriticalFlag) AS n_critical FROM (SELECT f.*, t.* EXCLUDE (TestCode) FROM fact f JOIN x_tests t ON f.TestCode = t.TestCode)
GROUP BY ROLLUP (TestCategory, CategoryLevel2, CategoryLevel3, TestCode)""")
def _(spark, d):
    levels = rules.test_catalogue(spark).select("TestCode", "CategoryLevel2", "CategoryLevel3")
    return marts.hierarchy_rollup(ranged(spark, d).join(levels, "TestCode"), ["TestCategory", "CategoryLevel2", "CategoryLevel3", "TestCode"])


@query("hierarchy_rollup_people", "AgeGroup Gender Race depth:i n_results:i n_critical:i", """
SELECT p.AgeGroup, p.Gender, p.Race, 3 - bit_count(grouping(p.AgeGroup, p.Gender, p.Race)) AS depth, count(*) AS n_results, count(*) FILTER (CriticalFlag) AS n_critical
FROM fact f JOIN dim_patient p USING (PatientKey) GROUP BY ROLLUP (p.AgeGroup, p.Gender, p.Race)""")
def _(spark, d):
    who = dim_patient(spark, d).select("PatientKey", "AgeGroup", "Gender", "Race")
    facts = _slim_fact(spark, d).select("PatientKey", "CriticalFlag").join(who, "PatientKey")
    return marts.hierarchy_rollup(facts, ["AgeGroup", "Gender", "Race"])


@query("hierarchy_rollup_calendar", "Year:i Quarter:i Month:i Day:d depth:i n_results:i n_critical:i", """
SELECT Year, Quarter, Month, Day, 4 - bit_count(grouping(Year, Quarter, Month, Day)) AS depth, count(*) AS n_results, count(*) FILTER (CriticalFlag) AS n_critical
FROM (SELECT year(ResultDate) AS Year, quarter(ResultDate) AS Quarter, month(ResultDate) AS Month, CAST(ResultDate AS DATE) AS Day, CriticalFlag FROM fact)
GROUP BY ROLLUP (Year, Quarter, Month, Day)""")
def _(spark, d):
    r = F.col("ResultDate")
    df = ranged(spark, d).select(F.year(r).alias("Year"), F.quarter(r).alias("Quarter"), F.month(r).alias("Month"),
                                 F.to_date(r).alias("Day"), "CriticalFlag")
    return marts.hierarchy_rollup(df, ["Year", "Quarter", "Month", "Day"])

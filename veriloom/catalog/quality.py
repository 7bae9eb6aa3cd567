"""Laboratory validation and quality scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from veriloom.catalog.common import enriched, validated
from veriloom.catalog.registry import FRAMES_SQL, frame_sql, query
from veriloom.functions.parse import join_issues
from veriloom.operators import conform, marts, quality, rules
from veriloom.operators import anomaly as anomaly_ops
from veriloom.sources import frames as src


@query("lab_enriched", "ResultId PatientId TestCode DateOfBirth:d Gender TestName LoincCode TestCategory AgeAtTest:i AgeGroup",
       "SELECT * FROM enriched")
def _(spark, d):
    return enriched(spark, d)


@query("age_at_test", "AgeGroup AgeAtTest:i n:i", "SELECT AgeGroup, AgeAtTest, count(*) AS n FROM enriched GROUP BY ALL")
def _(spark, d):
    return enriched(spark, d).groupBy("AgeGroup", "AgeAtTest").agg(F.count("*").alias("n"))


@query("validate_reference_range", "ResultId ReferenceRangeValid IsCriticalValue RangeMessage", "SELECT * FROM ranged0")
def _(spark, d):
    return quality.reference_range(enriched(spark, d))


@query("validate_plausibility", "ResultId PhysiologicallyPlausible PlausibilityIssues", """
SELECT ResultId, coalesce(ResultValueNumeric BETWEEN PhysMin AND PhysMax, TRUE) AS PhysiologicallyPlausible,
 CASE WHEN ResultValueNumeric NOT BETWEEN PhysMin AND PhysMax THEN 'Value outside physiological range ' || PhysText ELSE '' END AS PlausibilityIssues
FROM lab LEFT JOIN x_labrules USING (TestCode)""")
def _(spark, d):
    return quality.plausibility(src.lab(spark, d))


frame_sql("delta_checked", """
SELECT *, CASE WHEN NOT DeltaCheckPass THEN 'Change of ' || CAST(CAST(round(PercentChange, 1) AS DECIMAL(18,1)) AS VARCHAR) || '% exceeds ' || DeltaText
   || '% threshold within ' || DeltaHours || 'h' ELSE '' END AS DeltaCheckIssues FROM (
 SELECT p.*, l.TestCode, DaysSincePrevious * 24 AS HoursSincePrevious, DeltaText, DeltaHours,
  NOT coalesce(DaysSincePrevious * 24 <= DeltaHours AND PercentChange > MaxDelta, FALSE) AS DeltaCheckPass
 FROM lab_prev p JOIN lab l USING (ResultId) LEFT JOIN x_labrules USING (TestCode))""")


@query("delta_check", "ResultId PreviousResult:r HoursSincePrevious:i PercentChange:r4 DeltaCheckPass DeltaCheckIssues",
       "SELECT * FROM delta_checked")
def _(spark, d):
    return quality.delta_check(src.lab(spark, d))


@query("temporal_consistency", "ResultId TemporalConsistencyValid DaysSincePrevious:i TemporalMessage", """
SELECT *, CASE WHEN NOT TemporalConsistencyValid THEN 'Unrealistic temporal change detected' END AS TemporalMessage FROM validated_lab""")
def _(spark, d):
    return quality.temporal_consistency(quality.with_previous(src.lab(spark, d)))


@query("validate_units", "ResultId UnitValid UnitIssues", """
SELECT ResultId, coalesce(list_contains(Units, ResultUnit), TRUE) OR ResultUnit IS NULL AS UnitValid,
 CASE WHEN ResultUnit IS NOT NULL AND NOT list_contains(Units, ResultUnit) THEN 'Unexpected unit. Expected: ' || array_to_string(Units, ', ') ELSE '' END AS UnitIssues
FROM lab LEFT JOIN x_labrules USING (TestCode)""")
def _(spark, d):
    return quality.unit_consistency(src.lab(spark, d))


@query("validate_loinc", "ResultId LoincValid LoincFormatValid LoincIssues", r"""
SELECT ResultId, LoincCode IS NOT NULL AS LoincValid, coalesce(regexp_matches(LoincCode, '^\d{4,5}-\d$'), TRUE) AS LoincFormatValid,
 CASE WHEN LoincCode IS NULL THEN 'LOINC code not assigned to test' WHEN NOT regexp_matches(LoincCode, '^\d{4,5}-\d$') THEN 'Invalid LOINC code format' ELSE '' END AS LoincIssues
FROM lab LEFT JOIN x_tests USING (TestCode)""")
def _(spark, d):
    return quality.loinc(src.lab(spark, d), rules.test_catalogue(spark))


@query("validate_specimen_type", "ResultId SpecimenIntegrityValid SpecimenIssues", """
SELECT ResultId, SpecimenType IS NULL OR coalesce(list_contains(Specimens, SpecimenType), TRUE) AS SpecimenIntegrityValid,
 CASE WHEN SpecimenType IS NOT NULL AND NOT list_contains(Specimens, SpecimenType) THEN 'Invalid specimen type. Expected: ' || array_to_string(Specimens, ', ') ELSE '' END AS SpecimenIssues
FROM lab LEFT JOIN x_labrules USING (TestCode)""")
def _(spark, d):
    return quality.specimen_integrity(src.lab(spark, d))


@query("hemolysis_flag", "ResultId HemolysisImpact", """
SELECT ResultId, CASE WHEN TestCode IN ('POTASSIUM', 'LDH', 'AST') AND SpecimenQuality = 'Hemolyzed'
 THEN 'Result may be falsely elevated due to hemolysis' END AS HemolysisImpact FROM lab""")
def _(spark, d):
    return quality.hemolysis(src.lab(spark, d))


@query("validate_specimen_tests", "ResultId SpecimenValid", "SELECT * FROM validated_lab")
def _(spark, d):
    return quality.specimen_tests(src.lab(spark, d))


@query("specimen_age", "ResultId SpecimenAgeHours:r SpecimenFresh", """
SELECT ResultId, date_diff('microsecond', CollectedDate, ResultDate) / 3.6e9 AS SpecimenAgeHours,
 CASE WHEN list_contains(ValidTests, TestCode) THEN date_diff('microsecond', CollectedDate, ResultDate) / 3.6e9 <= MaxAgeHours ELSE TRUE END AS SpecimenFresh
FROM lab LEFT JOIN x_specrules USING (SpecimenType)""")
def _(spark, d):
    return quality.specimen_age(src.lab(spark, d))


@query("critical_protocol", "ResultId IsTimeSensitive RequiresImmediateNotification", """
SELECT ResultId, coalesce(TimeSensitive, FALSE) AS IsTimeSensitive, IsCriticalValue AS RequiresImmediateNotification
FROM ranged0 LEFT JOIN x_labrules USING (TestCode)""")
def _(spark, d):
    df = quality.reference_range(enriched(spark, d)).withColumn("CriticalFlag", F.col("IsCriticalValue"))
    return quality.critical_protocol(df)


@query("critical_alerts", "ResultId PatientId TestCode ResultValueNumeric:r ResultDate:t Severity", """
SELECT *, CASE WHEN ResultValueNumeric < ReferenceRangeMin * 0.5 OR ResultValueNumeric > ReferenceRangeMax * 2 THEN 'Critical' ELSE 'High' END AS Severity
FROM ranged0 WHERE IsCriticalValue""")
def _(spark, d):
    return marts.critical_alerts(quality.reference_range(enriched(spark, d)).withColumn("CriticalFlag", F.col("IsCriticalValue")))


@query("pending_alerts", "ResultId TestName ResultUnit AlertGeneratedDate:t AlertStatus", """
SELECT *, lab_as_of AS AlertGeneratedDate, 'PENDING' AS AlertStatus FROM ranged0, as_of WHERE IsCriticalValue""")
def _(spark, d):
    return marts.pending_alerts(quality.reference_range(enriched(spark, d)), F.lit(src.AS_OF).cast("timestamp_ntz"))


@query("issue_messages", "ResultId Issues", r"""
SELECT ResultId, concat_ws('; ', CASE WHEN ResultUnit = 'IU' THEN 'unit' END, CASE WHEN ResultValueNumeric IS NULL THEN 'no value' END,
 CASE WHEN SpecimenQuality = 'Hemolyzed' THEN 'hemolyzed' END) AS Issues FROM lab""")
def _(spark, d):
    return src.lab(spark, d).withColumn("Issues", join_issues(
        F.when(F.col("ResultUnit") == "IU", "unit"), F.when(F.col("ResultValueNumeric").isNull(), "no value"),
        F.when(F.col("SpecimenQuality") == "Hemolyzed", "hemolyzed")))


@query("clinical_flags", "ResultId ReferenceRangeValid TemporalConsistencyValid SpecimenValid ValidationMessage", """
SELECT *, concat_ws('; ', RangeMessage, CASE WHEN NOT TemporalConsistencyValid THEN 'Unrealistic temporal change detected' END) AS ValidationMessage
FROM validated_lab""")
def _(spark, d):
    return quality.clinical_flags(enriched(spark, d))


frame_sql("quality_flags", r"""
SELECT ResultId, l.ResultValueNumeric, PreviousResult, coalesce(l.ResultValueNumeric BETWEEN PhysMin AND PhysMax, TRUE) AS PhysiologicallyPlausible, DeltaCheckPass,
 ResultUnit IS NULL OR coalesce(list_contains(Units, ResultUnit), TRUE) AS UnitValid, LoincCode IS NOT NULL AS LoincValid,
 SpecimenType IS NULL OR coalesce(list_contains(Specimens, SpecimenType), TRUE) AS SpecimenIntegrityValid, l.ResultDate
FROM lab l JOIN delta_checked USING (ResultId) LEFT JOIN x_labrules r ON l.TestCode = r.TestCode LEFT JOIN x_tests t ON l.TestCode = t.TestCode""")


def _flags(spark, d):
    lab = src.lab(spark, d).withColumn("CriticalFlag", F.lit(False))
    return quality.quality_flags(lab, rules.test_catalogue(spark))


@query("quality_flags", "ResultId PhysiologicallyPlausible DeltaCheckPass UnitValid LoincValid SpecimenIntegrityValid",
       "SELECT * FROM quality_flags")
def _(spark, d):
    return _flags(spark, d)


frame_sql("quality_score", """
SELECT count(*) AS total_results, round(count(ResultValueNumeric) / count(*), 4) AS completeness,
 round(count(*) FILTER (PhysiologicallyPlausible) / count(*), 4) AS physiological_validity,
 round(count(*) FILTER (PreviousResult IS NOT NULL AND DeltaCheckPass) / count(PreviousResult), 4) AS delta_check_pass_rate,
 round(count(*) FILTER (UnitValid) / count(*), 4) AS unit_conformity, round(count(*) FILTER (LoincValid) / count(*), 4) AS loinc_coverage,
 round(count(*) FILTER (SpecimenIntegrityValid) / count(*), 4) AS specimen_integrity,
 round((count(ResultValueNumeric) * 0.20 + count(*) FILTER (PhysiologicallyPlausible) * 0.25 + count(*) FILTER (UnitValid) * 0.15
   + count(*) FILTER (LoincValid) * 0.10 + count(*) FILTER (SpecimenIntegrityValid) * 0.10) / count(*)
   + count(*) FILTER (PreviousResult IS NOT NULL AND DeltaCheckPass) / count(PreviousResult) * 0.20, 4) AS overall_quality_score
FROM quality_flags""")


@query("quality_score", "total_results:i completeness:r4 physiological_validity:r4 delta_check_pass_rate:r4 unit_conformity:r4 "
       "loinc_coverage:r4 specimen_integrity:r4 overall_quality_score:r4", "SELECT * FROM quality_score")
def _(spark, d):
    return quality.quality_score(_flags(spark, d))


@query("validation_summary", "total_results:i fully_valid:i valid_rate:r", """
SELECT count(*) AS total_results, count(*) FILTER (ReferenceRangeValid AND TemporalConsistencyValid AND SpecimenValid) AS fully_valid,
 count(*) FILTER (ReferenceRangeValid AND TemporalConsistencyValid AND SpecimenValid) / count(*) * 100 AS valid_rate FROM validated_lab""")
def _(spark, d):
    return quality.validation_summary(quality.clinical_flags(enriched(spark, d)))


@query("dq_flag_averages", "PhysiologicallyPlausible:r DeltaCheckPass:r UnitValid:r LoincValid:r SpecimenIntegrityValid:r", """
SELECT avg(CAST(PhysiologicallyPlausible AS INT)) AS PhysiologicallyPlausible, avg(CAST(DeltaCheckPass AS INT)) AS DeltaCheckPass,
 avg(CAST(UnitValid AS INT)) AS UnitValid, avg(CAST(LoincValid AS INT)) AS LoincValid, avg(CAST(SpecimenIntegrityValid AS INT)) AS SpecimenIntegrityValid FROM quality_flags""")
def _(spark, d):
    return quality.flag_averages(_flags(spark, d))


@query("dq_threshold_results", "TableName CheckType CheckName ExpectedValue:r ActualValue:r4 PassedFlag Severity", """
SELECT 'LabResults' AS TableName, *, CASE WHEN PassedFlag THEN 'Info' ELSE 'Error' END AS Severity FROM (
 SELECT CASE WHEN k = 'completeness' THEN 'Completeness' ELSE 'Conformity' END AS CheckType, k AS CheckName, e AS ExpectedValue, a AS ActualValue, a >= e AS PassedFlag
 FROM (SELECT unnest(['completeness', 'unit_conformity', 'loinc_coverage']) AS k, unnest([0.95, 0.99, 0.99]) AS e,
   unnest([completeness, unit_conformity, loinc_coverage]) AS a FROM quality_score)
 UNION ALL SELECT 'Freshness', 'hours_since_last', 2, h, h <= 2 FROM (SELECT date_diff('microsecond', max(ResultDate), any_value(lab_as_of)) / 3.6e9 AS h FROM lab, as_of))""")
def _(spark, d):
    newest = src.lab(spark, d).agg(F.max("ResultDate").alias("ts"))
    return quality.threshold_results(quality.quality_score(_flags(spark, d)), newest, F.lit(src.AS_OF).cast("timestamp_ntz"))


frame_sql("pair_days", """
SELECT Test1, Test2, Expected, PatientId, Day, count(v1) AS n1, sum(v1) AS s1, count(v2) AS n2, sum(v2) AS s2 FROM (
 SELECT Test1, Test2, Expected, PatientId, CAST(ResultDate AS DATE) AS Day, CASE WHEN TestCode = Test1 THEN ResultValueNumeric END AS v1,
  CASE WHEN TestCode = Test2 THEN ResultValueNumeric END AS v2 FROM lab JOIN x_pairs ON TestCode IN (Test1, Test2) WHERE ResultValueNumeric IS NOT NULL)
GROUP BY ALL HAVING count(v1) > 0 AND count(v2) > 0""")


@query("cross_test_pairs", "Test1 Test2 PatientId Day:d n1:i s1:r4 n2:i s2:r4", "SELECT * FROM pair_days")
def _(spark, d):
    return quality.cross_test_pairs(src.lab(spark, d))


@query("cross_test_correlation", "Test1 Test2 Expected n:i correlation:r MeetsExpectation", """
SELECT *, CASE WHEN Expected = 'positive' THEN correlation >= 0.3 ELSE correlation <= -0.3 END AS MeetsExpectation FROM (
 SELECT Test1, Test2, Expected, count(*) AS n, corr(a.ResultValueNumeric, b.ResultValueNumeric) AS correlation FROM lab a JOIN x_pairs ON a.TestCode = Test1
 JOIN lab b ON b.TestCode = Test2 AND a.PatientId = b.PatientId AND CAST(a.ResultDate AS DATE) = CAST(b.ResultDate AS DATE)
 WHERE a.ResultValueNumeric IS NOT NULL AND b.ResultValueNumeric IS NOT NULL GROUP BY 1, 2, 3)""")
def _(spark, d):
    return quality.cross_test_correlation(quality.cross_test_pairs(src.lab(spark, d)))


@query("lab_validated", "ResultId CriticalFlag IsAnomaly ReferenceRangeValid TemporalConsistencyValid SpecimenValid", "SELECT * FROM validated_lab")
def _(spark, d):
    flags = quality.clinical_flags(enriched(spark, d))
    odd = anomaly_ops.zscore_anomaly(anomaly_ops.zscores(src.lab(spark, d)))
    return marts.validated(src.lab(spark, d), flags, odd)


# the frames of the stored results, over the newest version of each raw result
frame_sql("silver_lab", "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ResultId ORDER BY ModifiedDate DESC) AS newest FROM bronze_lab) WHERE newest = 1")
frame_sql("silver_enriched", FRAMES_SQL["enriched"].replace("FROM lab l", "FROM silver_lab l"))
frame_sql("silver_ranged", FRAMES_SQL["ranged0"].replace("FROM enriched e", "FROM silver_enriched e"))
frame_sql("silver_zscored", FRAMES_SQL["zscored"].replace("FROM lab WINDOW", "FROM silver_lab WINDOW"))


@query("flagship", "MetricDate:d PerformingLabId:i TestCode TotalTests:i CriticalValues:i AnomalousResults:i ValidationFailures:i "
       "AvgTurnaroundTimeMinutes:r MissingResults:i CriticalValueRate:r AnomalyRate:r ValidationFailureRate:r CompletenessRate:r", """
SELECT *, CriticalValues / TotalTests * 100 AS CriticalValueRate, AnomalousResults / TotalTests * 100 AS AnomalyRate,
 ValidationFailures / TotalTests * 100 AS ValidationFailureRate, (TotalTests - MissingResults) / TotalTests * 100 AS CompletenessRate FROM (
 SELECT CAST(ResultDate AS DATE) AS MetricDate, PerformingLabId, TestCode, count(*) AS TotalTests, count(*) FILTER (IsCriticalValue) AS CriticalValues,
  count(*) FILTER (IsAnomaly) AS AnomalousResults, count(*) FILTER (NOT ReferenceRangeValid) AS ValidationFailures, avg(TurnaroundTimeMinutes) AS AvgTurnaroundTimeMinutes,
  count(*) FILTER (ResultValueNumeric IS NULL) AS MissingResults FROM silver_ranged JOIN silver_zscored USING (ResultId) GROUP BY 1, 2, 3)""")
def _(spark, d):
    raw = conform.bronze_to_silver(src.bronze_lab(spark, d), "LabResults", "2024-01-31", F.lit(src.AS_OF).cast("timestamp"))
    extra = src.lab(spark, d).select("ResultId", "TurnaroundTimeMinutes")
    df = quality.reference_range(quality.enrich(raw.join(extra, "ResultId"), src.patients(spark, d), rules.test_catalogue(spark)))
    df = anomaly_ops.zscore_anomaly(anomaly_ops.zscores(df)).withColumn("CriticalFlag", F.col("IsCriticalValue"))
    return marts.daily_quality_metrics(df)

"""Composed frames several subjects query, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriloom.catalog import frames  # noqa: F401  (defines the SQL side)
from veriloom.catalog.registry import frame_sql
from veriloom.operators import anomaly, marts, quality, rules
from veriloom.sources import frames as src
from veriloom.sources.merge import scd2_apply

CHANGE_DAY = "2024-01-15 00:00:00"


def enriched(spark: SparkSession, folder: str) -> DataFrame:
    return quality.enrich(src.lab(spark, folder), src.patients(spark, folder), rules.test_catalogue(spark))


def ranged(spark: SparkSession, folder: str) -> DataFrame:
    """Results with range validity and z-score anomalies: what the daily marts read."""
    df = quality.reference_range(enriched(spark, folder))
    return anomaly.zscore_anomaly(anomaly.zscores(df, anomaly.population_stats(src.lab(spark, folder)))).withColumn("CriticalFlag", F.col("IsCriticalValue"))


def validated(spark: SparkSession, folder: str) -> DataFrame:
    """Results with all clinical flags and z-score anomalies."""
    df = quality.clinical_flags(enriched(spark, folder), anomaly.patient_stats())
    return anomaly.zscore_anomaly(anomaly.zscores(df, anomaly.population_stats(src.lab(spark, folder)))).withColumn("CriticalFlag", F.col("IsCriticalValue"))


def patient_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Two-version history: the race of every fifth patient changed on CHANGE_DAY."""
    p = src.patients(spark, folder)
    cols = ["MRN", "FirstName", "LastName", "DateOfBirth", "Gender", "Race", "Ethnicity"]
    first = p.select("PatientId", *cols, F.lit("1900-01-01 00:00:00").cast("timestamp_ntz").alias("EffectiveDate"),
                     F.lit(None).cast("timestamp_ntz").alias("EndDate"), F.lit(True).alias("IsCurrent"))
    race = F.when(F.col("PatientId") % 5 == 0, "CHANGED").otherwise(F.col("Race"))
    return scd2_apply(first, p.withColumn("Race", race), "PatientId", cols, F.lit(CHANGE_DAY).cast("timestamp_ntz"))


def dim_patient(spark: SparkSession, folder: str) -> DataFrame:
    return marts.with_age(marts.dim_patient(patient_versions(spark, folder)), "2024-01-31")


def fact(spark: SparkSession, folder: str) -> DataFrame:
    return marts.fact_lab_result(validated(spark, folder), dim_patient(spark, folder),
                                 marts.dim_test(rules.test_catalogue(spark)))


frame_sql("enriched", """
SELECT *, CASE WHEN AgeAtTest < 18 THEN 'pediatric' ELSE 'adult' END AS AgeGroup FROM (
 SELECT l.*, DateOfBirth, Gender, TestName, LoincCode, TestCategory,
  CAST(trunc((CAST(ResultDate AS DATE) - DateOfBirth) / 365.25) AS INTEGER) AS AgeAtTest
 FROM lab l LEFT JOIN patients p USING (PatientId) LEFT JOIN x_tests USING (TestCode))""")
frame_sql("ranged0", """
SELECT e.*, CASE WHEN ResultValueNumeric IS NOT NULL AND RuleMin IS NOT NULL THEN ResultValueNumeric BETWEEN RuleMin AND RuleMax END AS ReferenceRangeValid,
  coalesce(ResultValueNumeric < CriticalLow, FALSE) OR coalesce(ResultValueNumeric > CriticalHigh, FALSE) AS IsCriticalValue,
  CASE WHEN ResultValueNumeric NOT BETWEEN RuleMin AND RuleMax
    THEN 'Out of range for ' || e.TestCode || ' (' || RangeGroup || '): expected ' || RangeText END AS RangeMessage
FROM enriched e LEFT JOIN x_ranges r ON e.TestCode = r.TestCode AND (RangeGroup = AgeGroup
  OR (AgeGroup = 'adult' AND RangeGroup = CASE Gender WHEN 'M' THEN 'adult_male' WHEN 'F' THEN 'adult_female' END))""")
frame_sql("lab_prev", """
SELECT *, date_diff('day', CAST(PreviousResultDate AS DATE), CAST(ResultDate AS DATE)) AS DaysSincePrevious,
  CASE WHEN PreviousResult <> 0 THEN abs((ResultValueNumeric - PreviousResult) / PreviousResult * 100) END AS PercentChange
FROM (SELECT ResultId, ResultDate, ResultValueNumeric, lag(ResultValueNumeric) OVER w AS PreviousResult, lag(ResultDate) OVER w AS PreviousResultDate FROM lab
  WINDOW w AS (PARTITION BY PatientId, TestCode ORDER BY ResultDate, ResultId))""")
frame_sql("zscored", """
SELECT ResultId, greatest(abs(z_score_within_patient), abs(z_score_population)) AS AnomalyScore,
  greatest(abs(z_score_within_patient), abs(z_score_population)) > 3 AS IsAnomaly, z_score_within_patient, z_score_population FROM (
 SELECT ResultId, coalesce(CASE WHEN ps > 0 THEN (ResultValueNumeric - pm) / ps ELSE 0 END, 0) AS z_score_within_patient,
   coalesce(CASE WHEN ts > 0 THEN (ResultValueNumeric - tm) / ts ELSE 0 END, 0) AS z_score_population
 FROM (SELECT *, avg(ResultValueNumeric) OVER p AS pm, stddev_samp(ResultValueNumeric) OVER p AS ps,
    avg(ResultValueNumeric) OVER t AS tm, stddev_samp(ResultValueNumeric) OVER t AS ts
   FROM lab WINDOW p AS (PARTITION BY PatientId, TestCode), t AS (PARTITION BY TestCode)))""")
frame_sql("validated_lab", """
SELECT r.*, IsCriticalValue AS CriticalFlag, PreviousResult, PercentChange, DaysSincePrevious,
  NOT coalesce(PercentChange > 200 AND DaysSincePrevious <= 7, FALSE) AS TemporalConsistencyValid,
  coalesce(list_contains(ValidTests, r.TestCode), TRUE) AS SpecimenValid, AnomalyScore, IsAnomaly
FROM ranged0 r JOIN lab_prev USING (ResultId) JOIN zscored USING (ResultId) LEFT JOIN x_specrules s USING (SpecimenType)""")
frame_sql("patient_versions", f"""
SELECT PatientId, MRN, FirstName, LastName, DateOfBirth, Gender, CASE WHEN v = 1 THEN 'CHANGED' ELSE Race END AS Race, Ethnicity,
  CASE WHEN v = 1 THEN TIMESTAMP '{CHANGE_DAY}' ELSE TIMESTAMP '1900-01-01' END AS EffectiveDate,
  CASE WHEN v = 0 AND PatientId % 5 = 0 THEN TIMESTAMP '{CHANGE_DAY}' END AS EndDate, v = 1 OR PatientId % 5 <> 0 AS IsCurrent
FROM patients, (VALUES (0), (1)) AS t(v) WHERE v = 0 OR PatientId % 5 = 0""")
frame_sql("dim_patient", """
SELECT *, CAST('0x' || substr(md5(PatientId || '|' || strftime(EffectiveDate, '%Y%m%d')), 1, 15) AS BIGINT) AS PatientKey, 2024 - year(DateOfBirth) AS Age,
  CASE WHEN 2024 - year(DateOfBirth) < 18 THEN 'Pediatric' WHEN 2024 - year(DateOfBirth) <= 64 THEN 'Adult' ELSE 'Senior' END AS AgeGroup
FROM patient_versions""")
frame_sql("fact", """
SELECT v.* EXCLUDE (DateOfBirth, Gender, AgeGroup, LoincCode, TestName, TestCategory), coalesce(PatientKey, -1) AS PatientKey,
  CAST('0x' || substr(md5(v.TestCode), 1, 15) AS BIGINT) AS TestKey,
  CAST(strftime(ResultDate, '%Y%m%d') AS INTEGER) AS ResultDateKey, CAST(strftime(ResultDate - to_minutes(TurnaroundTimeMinutes), '%Y%m%d') AS INTEGER) AS OrderDateKey,
  hour(ResultDate) * 60 + minute(ResultDate) AS ResultTimeKey, coalesce(PerformingLabId, -1) AS LaboratoryKey,
  coalesce(ResultValueNumeric < ReferenceRangeMin OR ResultValueNumeric > ReferenceRangeMax, FALSE) AND ReferenceRangeMin IS NOT NULL AND ReferenceRangeMax IS NOT NULL AS IsOutOfRange,
  CASE WHEN ReferenceRangeMax > 0 THEN ResultValueNumeric / ReferenceRangeMax * 100 END AS PercentOfReferenceRangeMax
FROM validated_lab v LEFT JOIN dim_patient p ON v.PatientId = p.PatientId AND EffectiveDate <= ResultDate AND (EndDate IS NULL OR ResultDate < EndDate)""")

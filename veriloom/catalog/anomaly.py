"""Features, z-scores and the isolation forest."""

from __future__ import annotations

from pyspark.sql import functions as F

from veriloom.catalog import common  # noqa: F401
from veriloom.catalog.registry import frame_sql, query
from veriloom.operators import anomaly
from veriloom.session import materialise
from veriloom.sources import frames as src


@query("lab_training_set", "ResultId PatientId TestCode ResultValueNumeric:r DateOfBirth:d Gender", """
SELECT l.*, DateOfBirth, Gender FROM lab l LEFT JOIN patients USING (PatientId), as_of
WHERE ResultValueNumeric IS NOT NULL AND ResultStatus = 'FINAL' AND ResultDate >= lab_as_of - INTERVAL 20 DAY""")
def _(spark, d):
    return anomaly.training_set(src.lab(spark, d), src.patients(spark, d), src.AS_OF, 20)


frame_sql("freq30", """
SELECT ResultId, count(*) OVER (PARTITION BY PatientId, TestCode ORDER BY ResultDate RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW) AS test_frequency_30d FROM lab""")


@query("test_frequency_30d", "ResultId test_frequency_30d:i", "SELECT * FROM freq30")
def _(spark, d):
    return anomaly.frequency(src.lab(spark, d).select("ResultId", "PatientId", "TestCode", "ResultDate"))


@query("test_frequency_3d", "ResultId test_frequency_30d:i", """
SELECT ResultId, count(*) OVER (PARTITION BY PatientId, TestCode ORDER BY ResultDate RANGE BETWEEN INTERVAL 3 DAY PRECEDING AND CURRENT ROW) AS test_frequency_30d FROM lab""")
def _(spark, d):
    return anomaly.frequency(src.lab(spark, d).select("ResultId", "PatientId", "TestCode", "ResultDate"), 3)


@query("patient_zscore", "ResultId z_score_within_patient:r5", "SELECT * FROM zscored")
def _(spark, d):
    return anomaly.zscores(src.lab(spark, d).select("ResultId", "PatientId", "TestCode", "ResultValueNumeric"))


@query("population_zscore", "ResultId z_score_population:r5", "SELECT * FROM zscored")
def _(spark, d):
    return anomaly.zscores(src.lab(spark, d).select("ResultId", "PatientId", "TestCode", "ResultValueNumeric"))


frame_sql("lab_features", """
SELECT ResultId, l.TestCode, coalesce(l.ResultValueNumeric, 0) AS result_value_numeric,
 coalesce(CASE WHEN ReferenceRangeMin > 0 THEN (l.ResultValueNumeric - ReferenceRangeMin) / ReferenceRangeMin * 100 ELSE 0 END, 0) AS result_vs_reference_min_pct,
 coalesce(CASE WHEN ReferenceRangeMax > 0 THEN (l.ResultValueNumeric - ReferenceRangeMax) / ReferenceRangeMax * 100 ELSE 0 END, 0) AS result_vs_reference_max_pct,
 coalesce(DaysSincePrevious, 365) AS days_since_last_test, test_frequency_30d, coalesce(PercentChange, 0) AS percent_change_from_previous,
 z_score_within_patient, z_score_population, IsAnomaly, AnomalyScore
FROM lab l JOIN lab_prev USING (ResultId) JOIN freq30 USING (ResultId) JOIN zscored USING (ResultId)""")


@query("lab_features", "ResultId " + " ".join(f"{c}:r4" for c in anomaly.FEATURES), "SELECT * FROM lab_features")
def _(spark, d):
    return anomaly.features(src.lab(spark, d))


@query("zscore_anomaly", "ResultId IsAnomaly AnomalyScore:r5", "SELECT * FROM zscored")
def _(spark, d):
    return anomaly.zscore_anomaly(anomaly.zscores(src.lab(spark, d).select("ResultId", "PatientId", "TestCode", "ResultValueNumeric")))


@query("anomaly_reason", "ResultId IsAnomaly AnomalyReason", """
SELECT ResultId, IsAnomaly, CASE WHEN IsAnomaly THEN concat_ws('; ', CASE WHEN abs(z_score_within_patient) > 3 THEN 'Unusual for patient (z-score > 3)' END,
 CASE WHEN abs(z_score_population) > 3 THEN 'Unusual for population (z-score > 3)' END, CASE WHEN percent_change_from_previous > 100 THEN 'Large change from previous result (>100%)' END,
 CASE WHEN abs(result_vs_reference_max_pct) > 200 THEN 'Far outside reference range (>200%)' END) END AS AnomalyReason FROM lab_features""")
def _(spark, d):
    return anomaly.anomaly_reason(anomaly.zscore_anomaly(anomaly.features(src.lab(spark, d))))


@query("anomaly_summary", "TestCode total_results:i anomalies:i avg_score:r5", """
SELECT TestCode, count(*) AS total_results, count(*) FILTER (IsAnomaly) AS anomalies, avg(AnomalyScore) AS avg_score FROM lab_features GROUP BY 1""")
def _(spark, d):
    return anomaly.anomaly_summary(anomaly.zscore_anomaly(anomaly.zscores(src.lab(spark, d))))


def _features(spark, d):
    return materialise(anomaly.features(src.lab(spark, d)), "features")


@query("iforest_fit", "tree node feature threshold size")
def _(spark, d):
    return anomaly.forest_fit(_features(spark, d))


@query("iforest_score", "ResultId AnomalyScore IsAnomaly")
def _(spark, d):
    feats = _features(spark, d)
    return anomaly.forest_flag(materialise(anomaly.forest_scores(feats, anomaly.forest_fit(feats)), "scores"))


@query("permutation_importance", "feature importance")
def _(spark, d):
    feats = _features(spark, d)
    return anomaly.permutation_importance(feats, materialise(anomaly.forest_fit(feats), "forest"))


@query("permutation_pairing", "feature n:i total:r3 own_total:r3", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(*) AS n, sum({c}) AS total, sum({c}) AS own_total FROM lab_features" for c in anomaly.FEATURES))
def _(spark, d):
    pairs = anomaly.repaired(_features(spark, d))
    sums = pairs.agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in anomaly.FEATURES], *[F.sum(f"_other_{c}").alias(f"_other_{c}") for c in anomaly.FEATURES])
    return sums.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), "n", F.col(f"_other_{c}").alias("total"), F.col(c).alias("own_total"))
                                          for c in anomaly.FEATURES])))

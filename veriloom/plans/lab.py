"""Raw laboratory results to gold: clean, validate, score, mart, star schema."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriloom.operators import anomaly, conform, marts, quality
from veriloom.operators import rules as R

EXTRA = ("SpecimenType", "SpecimenQuality", "TurnaroundTimeMinutes")


@dataclass
class LabTables:
    silver: DataFrame
    validated: DataFrame
    fact: DataFrame
    daily_quality: DataFrame
    patient_summary: DataFrame
    utilization: DataFrame
    alerts: DataFrame


def validate(silver: DataFrame, patients: DataFrame) -> DataFrame:
    """Clinical flags and z-score anomalies in place: each step only adds columns, so no stored results have to be
    joined back by result id."""
    enriched = quality.enrich(silver, patients, R.test_catalogue(silver.sparkSession))
    df = quality.clinical_flags(enriched, anomaly.patient_stats())
    return anomaly.zscore_anomaly(anomaly.zscores(df, anomaly.population_stats(silver))).withColumn("CriticalFlag", F.col("IsCriticalValue"))


def store(df: DataFrame, path: str, cluster_by: list[str] | None = None) -> DataFrame:
    """Write once for the consumers downstream; ranges of ``cluster_by`` per file let scans skip row groups."""
    out = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by) if cluster_by else df
    out.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run(bronze: DataFrame, patients: DataFrame, patient_dim: DataFrame, root: str, load_date: str, as_of=None) -> LabTables:
    """The whole chain. Silver, the validated results and the facts are stored, as each feeds several consumers."""
    spark = bronze.sparkSession
    raw = conform.standardize(bronze, conform.UPPER_COLUMNS["LabResults"])
    clean = conform.dedupe_latest(raw, ["ResultId"], [F.col("ModifiedDate").desc()])
    schema = conform.SCHEMAS["LabResults"]
    core = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    silver = conform.with_technical_columns(clean.select(*core, *EXTRA), load_date, as_of, F.lit("LabResults"))
    silver = store(silver, f"{root}/silver_lab")
    validated = store(validate(silver, patients), f"{root}/validated_lab")
    fact = marts.fact_lab_result(validated, patient_dim, marts.dim_test(R.test_catalogue(spark)))
    fact = store(fact, f"{root}/fact_lab_result", ["PatientKey", "TestCode", "ResultDate"])
    use = marts.utilization_with_master(marts.test_utilization(validated), R.test_catalogue(spark))
    return LabTables(silver, validated, fact, marts.daily_quality_metrics(validated), marts.patient_test_summary(validated), use,
                     marts.critical_alerts(validated))

"""Streaming jobs drained over the whole tables; each agrees with its batch twin's SQL where one exists."""

from __future__ import annotations

from pyspark.sql import functions as F

from veriloom.catalog import common
from veriloom.catalog.audit import EXCESSIVE
from veriloom.catalog.fraud import AS_OF, PARAMS, RANKED
from veriloom.catalog.ingest import _claims_csv
from veriloom.catalog.queue import HEALTH
from veriloom.catalog.registry import query
from veriloom.operators import queue
from veriloom.session import materialise, work_dir
from veriloom.sources import frames as src
from veriloom.sources import merge
from veriloom.streaming import jobs


TASKS_A_PART = 32


def _in_parts(spark, df, order, name, job, parts=3):
    """Let the frame arrive in ranges of ``order``: after each range has landed, the job runs over what is new and
    stops, its checkpoint carrying progress and state to the next run. A range is cut, sorted out and read by many tasks."""
    ranged = df.repartitionByRange(parts * TASKS_A_PART, order)
    cut = materialise(ranged.withColumn("_part", F.floor(F.spark_partition_id() / TASKS_A_PART).cast("int")), name)
    path, checkpoint = work_dir(spark, name), work_dir(spark, "ck")
    for k in range(parts):
        cut.where(F.col("_part") == k).drop("_part").write.mode("append").parquet(path)
        job(jobs.table_source(spark, path, df.schema, 100_000), checkpoint)


@query("stream_claims_source", "claim_id provider_npi billed_amount:r2 units:i", """
SELECT claim_id, provider_npi, CASE WHEN (length(claim_id) + units) % 23 = 0 THEN 0 WHEN (length(claim_id) + units) % 29 = 0 THEN NULL ELSE billed_amount END AS billed_amount,
 CASE WHEN (length(claim_id) + units) % 31 = 0 THEN 1 ELSE units END AS units FROM claims""")
def _(spark, d):
    sink = work_dir(spark, "claims")
    jobs.drain(jobs.claims_source(spark, _stream_claims_csv(spark, d), 4), jobs.to_batches(sink), work_dir(spark, "ck"))
    return spark.read.parquet(sink)


def _stream_claims_csv(spark, d):
    """The claims file laid out with every header, as the stream's fixed schema expects."""
    from veriloom.sources.claims import CLAIM_HEADERS
    raw = spark.read.option("header", True).csv(_claims_csv(spark, d))
    path = work_dir(spark, "claims-in")
    raw.select([(F.col(h) if h in raw.columns else F.lit(None).cast("string")).alias(h) for h in CLAIM_HEADERS]).write.option("header", True).csv(path)
    return path


@query("stream_fraud", RANKED, "SELECT * FROM kept_alerts")
def _(spark, d):
    sink, state = work_dir(spark, "alerts"), work_dir(spark, "measures")
    _in_parts(spark, src.claims(spark, d), F.xxhash64("claim_id"), "claims", lambda s, ck: jobs.fraud_alerts(s, sink, state, ck, AS_OF, PARAMS, fold=2), 3)
    return jobs.last_batch(spark, sink)


@query("stream_provider_profile", "provider_npi total_claims:i total_amount:r2", "SELECT provider_npi, count(*) AS total_claims, sum(billed_amount) AS total_amount FROM claims GROUP BY 1")
def _(spark, d):
    sink = work_dir(spark, "profiles")
    _in_parts(spark, src.claims(spark, d), "service_date", "claims", lambda s, ck: jobs.provider_profile(s, sink, ck))
    return jobs.latest_rows(spark, sink, ["provider_npi"])


@query("stream_silver_upsert", "ResultId AbnormalFlag ResultStatus ResultValueNumeric:r ModifiedDate:t", """
SELECT * REPLACE (upper(trim(AbnormalFlag)) AS AbnormalFlag, upper(trim(ResultStatus)) AS ResultStatus)
FROM (SELECT *, row_number() OVER (PARTITION BY ResultId ORDER BY ModifiedDate DESC) AS r FROM bronze_lab) WHERE r = 1""")
def _(spark, d):
    path = work_dir(spark, "silver")
    at = F.lit(src.AS_OF).cast("timestamp")
    _in_parts(spark, src.bronze_lab(spark, d), "ModifiedDate", "bronze", lambda s, ck: jobs.silver_upsert(s, path, "LabResults", "2024-01-31", ck, at, 16))
    return merge.read_bucketed(spark, path)


@query("stream_critical_alerts", "ResultId PatientId TestCode Severity", """
SELECT *, CASE WHEN ResultValueNumeric < ReferenceRangeMin * 0.5 OR ResultValueNumeric > ReferenceRangeMax * 2 THEN 'Critical' ELSE 'High' END AS Severity FROM ranged0 WHERE IsCriticalValue""")
def _(spark, d):
    sink = work_dir(spark, "critical")
    _in_parts(spark, src.lab(spark, d), "ResultDate", "lab", lambda s, ck: jobs.critical_alerts(s, src.patients(spark, d), sink, ck))
    return spark.read.parquet(sink)


@query("stream_phi_access", "UserId window_start:t access_count:i", """
SELECT UserId, window_start, count(*) AS access_count FROM (SELECT UserId, time_bucket(INTERVAL 5 MINUTE, AccessTimestamp) - to_minutes(CAST(5 * k AS INTEGER)) AS window_start
 FROM access_log, range(0, 12) AS t(k) WHERE PHIAccessed) GROUP BY 1, 2 HAVING count(*) > 1""")
def _(spark, d):
    sink = work_dir(spark, "phi")
    _in_parts(spark, src.access_log(spark, d), "AccessTimestamp", "access", lambda s, ck: jobs.phi_access(s, sink, ck, 1))
    return jobs.latest_rows(spark, sink, ["UserId", "window_start"])


@query("stream_phi_excessive_access", "AuditId UserId AccessTimestamp:t access_count:i event_type description severity", EXCESSIVE)
def _(spark, d):
    sink, state = work_dir(spark, "excess"), work_dir(spark, "accesses")
    _in_parts(spark, src.access_log(spark, d), F.xxhash64("AuditId"), "access", lambda s, ck: jobs.phi_excessive_access(s, sink, state, ck, 1, 24 * 7))
    return jobs.latest_rows(spark, sink, ["AuditId"])


@query("stream_daily_quality", "MetricDate:d PerformingLabId:i TestCode TotalTests:i CriticalValues:i AnomalousResults:i ValidationFailures:i "
       "AvgTurnaroundTimeMinutes:r MissingResults:i CriticalValueRate:r AnomalyRate:r ValidationFailureRate:r CompletenessRate:r", """
SELECT *, CriticalValues / TotalTests * 100 AS CriticalValueRate, AnomalousResults / TotalTests * 100 AS AnomalyRate,
 ValidationFailures / TotalTests * 100 AS ValidationFailureRate, (TotalTests - MissingResults) / TotalTests * 100 AS CompletenessRate FROM (
 SELECT CAST(ResultDate AS DATE) AS MetricDate, PerformingLabId, TestCode, count(*) AS TotalTests, count(*) FILTER (CriticalFlag) AS CriticalValues,
  count(*) FILTER (IsAnomaly) AS AnomalousResults, count(*) FILTER (NOT ReferenceRangeValid) AS ValidationFailures, avg(TurnaroundTimeMinutes) AS AvgTurnaroundTimeMinutes,
  count(*) FILTER (ResultValueNumeric IS NULL) AS MissingResults FROM validated_lab GROUP BY 1, 2, 3)""")
def _(spark, d):
    sink = work_dir(spark, "daily")
    _in_parts(spark, common.validated(spark, d), "ResultDate", "lab", lambda s, ck: jobs.daily_quality(s, sink, ck))
    return jobs.latest_rows(spark, sink, ["MetricDate", "PerformingLabId", "TestCode"])


@query("stream_cdc_apply", "ResultId PatientId ResultValueNumeric:r ModifiedDate:t", """
WITH net AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ResultId ORDER BY seq DESC) AS r FROM change_log WHERE op <> 3) WHERE r = 1)
SELECT ResultId, PatientId, ResultValueNumeric, ModifiedDate FROM net WHERE op <> 1
UNION ALL SELECT t.* FROM change_target t WHERE ResultId NOT IN (SELECT ResultId FROM net)""")
def _(spark, d):
    path = merge.write_bucketed(src.change_target(spark, d), work_dir(spark, "cdc"), ["ResultId"], 16)
    _in_parts(spark, src.change_log(spark, d), "seq", "changes", lambda s, ck: jobs.cdc_apply(s, path, ["ResultId"], ck, 16))
    return merge.read_bucketed(spark, path)


@query("stream_delta_check", "ResultId PreviousResult:r PercentChange:r4 DeltaCheckPass IsLate", "SELECT *, FALSE AS IsLate FROM delta_checked")
def _(spark, d):
    sink = work_dir(spark, "delta")
    _in_parts(spark, src.lab(spark, d), "ResultDate", "lab", lambda s, ck: jobs.delta_check(s, sink, ck))
    return spark.read.parquet(sink)


@query("health_snapshot", HEALTH, "SELECT * FROM health")
def _(spark, d):
    tasks = queue.with_retry_fields(src.tasks(spark, d))
    return jobs.health_snapshot(tasks, src.QUEUE_AS_OF, work_dir(spark, "monitor"))[0]

"""Audit and compliance reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from veriloom.catalog import common  # noqa: F401
from veriloom.catalog.registry import query
from veriloom.functions.hashing import change_signature
from veriloom.operators import audit
from veriloom.sources import frames as src


@query("change_signature", "ModificationId signature", """
SELECT ModificationId, upper(sha256(UserId || '|' || strftime(ModificationTimestamp, '%Y-%m-%d %H:%M:%S') || '|' || ReasonForChange)) AS signature FROM modification_log""")
def _(spark, d):
    when = F.date_format("ModificationTimestamp", "yyyy-MM-dd HH:mm:ss")
    return src.modification_log(spark, d).withColumn("signature", change_signature(F.col("UserId"), when, F.col("ReasonForChange")))


@query("phi_access_report", "UserId phi_access_count:i unique_patients:i", """
SELECT UserId, count(*) AS phi_access_count, count(DISTINCT RecordIdentifier) AS unique_patients FROM access_log, as_of WHERE PHIAccessed AND AccessTimestamp >= lab_as_of - INTERVAL 15 DAY GROUP BY 1""")
def _(spark, d):
    return audit.phi_access_report(src.access_log(spark, d), src.AS_OF, 15)


@query("compliance_dashboard", "phi_accesses:i phi_users:i modifications:i failed_validations:i pending_reviews:i", """
SELECT (SELECT count(*) FROM access_log, as_of WHERE PHIAccessed AND AccessTimestamp >= lab_as_of - INTERVAL 3650 DAY) AS phi_accesses,
 (SELECT count(DISTINCT UserId) FROM access_log, as_of WHERE PHIAccessed AND AccessTimestamp >= lab_as_of - INTERVAL 3650 DAY) AS phi_users,
 (SELECT count(*) FROM modification_log, as_of WHERE ModificationTimestamp >= lab_as_of - INTERVAL 3650 DAY) AS modifications,
 (SELECT count(*) FROM validation_log, as_of WHERE PassFailStatus = 'FAIL' AND ExecutionTimestamp >= lab_as_of - INTERVAL 9000 DAY) AS failed_validations,
 (SELECT count(*) FROM phi_reviews WHERE AlertGenerated AND ReviewRequired AND ReviewedTimestamp IS NULL) AS pending_reviews""".replace("3650", "9000"))
def _(spark, d):
    return audit.compliance_dashboard(src.access_log(spark, d), src.modification_log(spark, d), src.validation_log(spark, d), src.phi_reviews(spark, d), src.AS_OF, 9000)


@query("validation_pass_rate", "ValidationName ExecutionTimestamp:t PassFailStatus TotalRecords:i PassedRecords:i pass_rate:r", """
SELECT *, PassedRecords / TotalRecords AS pass_rate FROM validation_log, as_of WHERE ExecutionTimestamp >= queue_as_of - INTERVAL 90 DAY""")
def _(spark, d):
    return audit.validation_pass_rate(src.validation_log(spark, d), src.QUEUE_AS_OF)


@query("lineage_rollup", "SourceTable TargetTable records:i seconds:i runs:i last_hash", """
SELECT SourceTable, TargetTable, sum(RecordsProcessed) AS records, sum(ProcessDurationSeconds) AS seconds, count(*) AS runs, max(CASE WHEN r = 1 THEN DataHash END) AS last_hash FROM (
 SELECT *, row_number() OVER (PARTITION BY SourceTable, TargetTable ORDER BY ProcessTimestamp DESC, LineageId DESC) AS r FROM lineage_log) GROUP BY 1, 2""")
def _(spark, d):
    return audit.lineage_rollup(src.lineage_log(spark, d))


EXCESSIVE = """
SELECT *, 'PHI_EXCESSIVE_ACCESS' AS event_type, 'User accessed PHI ' || access_count || ' times in the last hour' AS description, 'Warning' AS severity FROM (
 SELECT *, count(*) OVER (PARTITION BY UserId ORDER BY AccessTimestamp RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS access_count FROM access_log WHERE PHIAccessed) WHERE access_count > 1"""


@query("phi_excessive_access", "AuditId UserId AccessTimestamp:t access_count:i event_type description severity", EXCESSIVE)
def _(spark, d):
    return audit.excessive_access(src.access_log(spark, d), 1)


@query("recent_phi_access", "AuditId AccessTimestamp:t UserId RecordIdentifier AccessReason", """
SELECT * FROM access_log WHERE PHIAccessed ORDER BY AccessTimestamp DESC, AuditId DESC LIMIT 1000""")
def _(spark, d):
    return audit.recent_phi_access(src.access_log(spark, d))


@query("pending_reviews", "MonitoringId UserId AccessTimestamp:t", "SELECT * FROM phi_reviews WHERE ReviewRequired AND ReviewedTimestamp IS NULL")
def _(spark, d):
    return audit.pending_reviews(src.phi_reviews(spark, d))

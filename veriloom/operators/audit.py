"""Reports over access, modification, validation and lineage logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriloom.operators.queue import ts
from veriloom.operators.skew import trailing_count


def _since(as_of: str, days: int) -> Column:
    return ts(as_of) - F.make_interval(days=F.lit(days))


def phi_access_report(log: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Accesses to health information and distinct records per user, most active first."""
    rows = log.where(F.col("PHIAccessed") & (F.col("AccessTimestamp") >= _since(as_of, days)))
    return (rows.groupBy("UserId").agg(F.count("*").alias("phi_access_count"), F.countDistinct("RecordIdentifier").alias("unique_patients"))
            .orderBy(F.col("phi_access_count").desc(), "UserId"))


def compliance_dashboard(access: DataFrame, changes: DataFrame, validations: DataFrame, reviews: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Five counters in one row: one aggregate per log, brought together as scalars."""
    start = _since(as_of, days)
    phi = access.where(F.col("PHIAccessed") & (F.col("AccessTimestamp") >= start)).agg(
        F.count("*").alias("phi_accesses"), F.countDistinct("UserId").alias("phi_users"))
    changed = changes.where(F.col("ModificationTimestamp") >= start).agg(F.count("*").alias("n"))
    failed = validations.where((F.col("PassFailStatus") == "FAIL") & (F.col("ExecutionTimestamp") >= start)).agg(F.count("*").alias("n"))
    pending = reviews.where(F.col("AlertGenerated") & F.col("ReviewRequired") & F.col("ReviewedTimestamp").isNull()).agg(F.count("*").alias("n"))
    return phi.select("phi_accesses", "phi_users", changed.scalar().alias("modifications"), failed.scalar().alias("failed_validations"),
                      pending.scalar().alias("pending_reviews"))


def validation_pass_rate(validations: DataFrame, as_of: str, days: int = 90) -> DataFrame:
    return (validations.where(F.col("ExecutionTimestamp") >= _since(as_of, days))
            .withColumn("pass_rate", F.try_divide(F.col("PassedRecords").cast("double"), F.col("TotalRecords").cast("double")))
            .orderBy(F.col("ExecutionTimestamp").desc(), "ValidationName"))


def lineage_rollup(lineage: DataFrame) -> DataFrame:
    """Records, duration and latest hash per source and target."""
    return lineage.groupBy("SourceTable", "TargetTable").agg(
        F.sum("RecordsProcessed").alias("records"), F.sum("ProcessDurationSeconds").alias("seconds"), F.count("*").alias("runs"),
        F.max_by("DataHash", F.struct("ProcessTimestamp", "LineageId")).alias("last_hash"))


def excessive_access(log: DataFrame, limit: int = 100, minutes: int = 60, step_minutes: int = 5) -> DataFrame:
    """Accesses that bring a user above ``limit`` within the trailing hour.

    Counted per user and short step, so a user with very many accesses spreads over tasks; exact.
    """
    rows = log.where("PHIAccessed").select("AuditId", "UserId", "AccessTimestamp")
    counted = trailing_count(rows, ["UserId"], "AccessTimestamp", minutes // step_minutes, step_minutes * 60, "access_count")
    hit = counted.where(F.col("access_count") > limit)
    return hit.select("AuditId", "UserId", "AccessTimestamp", "access_count", F.lit("PHI_EXCESSIVE_ACCESS").alias("event_type"),
                      F.format_string("User accessed PHI %d times in the last hour", "access_count").alias("description"), F.lit("Warning").alias("severity"))


def recent_phi_access(log: DataFrame, n: int = 1000) -> DataFrame:
    return (log.where("PHIAccessed").select("AuditId", "AccessTimestamp", "UserId", "TableName", "RecordIdentifier", "AccessReason")
            .orderBy(F.col("AccessTimestamp").desc(), F.col("AuditId").desc()).limit(n))


def pending_reviews(reviews: DataFrame) -> DataFrame:
    return reviews.where(F.col("ReviewRequired") & F.col("ReviewedTimestamp").isNull())

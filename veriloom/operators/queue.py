"""Analytics over a work-queue table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriloom.functions import backoff

FINISHED = ("COMPLETED", "FAILED", "DEAD_LETTER")


def ts(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _minutes(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))) / 6e7


def with_retry_fields(tasks: DataFrame) -> DataFrame:
    """retry_count, last_error, next_retry_at and table_name out of their JSON columns; only needed keys are parsed."""
    retry = F.from_json("retry_metadata_json", "retry_count int, last_error string, next_retry_at string")
    return tasks.withColumn("_r", retry).select(
        "*", F.coalesce("_r.retry_count", F.lit(0)).alias("retry_count"), F.col("_r.last_error").alias("last_error"),
        F.col("_r.next_retry_at").try_cast("timestamp_ntz").alias("next_retry_at"),
        F.get_json_object("migration_metadata_json", "$.table_name").alias("table_name")).drop("_r")


def retry_schedule(tasks: DataFrame, initial: float = 60, base: float = 2, cap: float = 3600, max_retries: int = 5) -> DataFrame:
    """(task_id, attempt, delay, minutes, cumulative minutes) for each of the task's possible attempts."""
    delay = backoff.exponential(F.col("attempt") - 1, initial, base, cap)
    # at most max_retries terms: summed inside the row instead of by a window
    total = F.aggregate(F.sequence(F.lit(0), F.col("attempt") - 1), F.lit(0.0),
                        lambda acc, i: acc + F.least(F.lit(float(initial)) * F.pow(F.lit(float(base)), i), F.lit(float(cap))))
    rows = tasks.select("task_id", F.explode(F.sequence(F.lit(1), F.lit(max_retries))).alias("attempt"))
    return rows.select("task_id", "attempt", F.round(delay, 2).alias("delay_seconds"), F.round(delay / 60, 2).alias("delay_minutes"),
                       F.round(total / 60, 2).alias("cumulative_minutes"))


def total_retry_seconds(initial: float = 60, base: float = 2, cap: float = 3600, max_retries: int = 5) -> float:
    return float(sum(min(initial * base ** i, cap) for i in range(max_retries)))


def route_failures(failures: DataFrame, as_of: str, max_retries: int = 5) -> DataFrame:
    """Next state of failed tasks (task_id, retry_count, error): a scheduled retry, or the dead letter queue."""
    again = F.col("retry_count") < max_retries
    delay = F.when(again, backoff.exponential(F.col("retry_count")))
    return failures.select(
        "task_id", F.when(again, "RETRY_SCHEDULED").otherwise("DEAD_LETTER").alias("new_status"),
        F.when(again, F.col("retry_count") + 1).otherwise(F.col("retry_count")).alias("retry_count"), F.col("error").alias("last_error"),
        delay.alias("backoff_seconds"), (ts(as_of) + F.make_interval(secs=delay)).alias("next_retry_at"))


def ready(tasks: DataFrame, as_of: str) -> DataFrame:
    """Tasks to pick up: waiting, or scheduled and due; and not locked, or the lock has run out."""
    due = F.col("next_retry_at").isNull() | (F.col("next_retry_at") <= ts(as_of))
    waiting = F.col("status").isin("PENDING", "READY") | ((F.col("status") == "RETRY_SCHEDULED") & due)
    free = F.col("locked_until").isNull() | (F.col("locked_until") < ts(as_of))
    return tasks.where(waiting & free)


def ready_top(tasks: DataFrame, as_of: str, n: int = 10) -> DataFrame:
    return ready(tasks, as_of).orderBy("priority", "created_at", "task_id").limit(n)


def stuck(tasks: DataFrame, as_of: str) -> DataFrame:
    return tasks.where((F.col("status") == "PROCESSING") & (F.col("locked_until") < ts(as_of)))


def recover_stuck(tasks: DataFrame, as_of: str) -> DataFrame:
    """The table with stuck tasks put back to READY and their locks cleared."""
    hit = F.coalesce((F.col("status") == "PROCESSING") & (F.col("locked_until") < ts(as_of)), F.lit(False))
    return tasks.withColumns({"status": F.when(hit, "READY").otherwise(F.col("status")), "locked_until": F.when(~hit, F.col("locked_until"))})


def retry_history(attempts: DataFrame) -> DataFrame:
    """Attempts as rows (task_id, attempt, error, attempted_at), in order; a task may have any number."""
    return attempts.select("task_id", "attempt", "error", "attempted_at").orderBy("task_id", "attempt")


def retry_summary(attempts: DataFrame) -> DataFrame:
    """Number of attempts per task, with the first error and the last time."""
    return attempts.groupBy("task_id").agg(F.count("*").alias("n"), F.min_by("error", "attempt").alias("first_error"), F.max_by("attempted_at", "attempt").alias("last_at"))


def audit_transitions(before: DataFrame, after: DataFrame, actor: str, as_of: str) -> DataFrame:
    """One audit row per task whose status differs between two snapshots, or which is new."""
    old = before.select("task_id", F.col("status").alias("old_status"))
    new = after.select("task_id", F.col("status").alias("new_status"))
    j = new.join(old, "task_id", "left").where(F.col("old_status").isNull() | (F.col("old_status") != F.col("new_status")))
    action = F.when(F.col("old_status").isNull(), "ENQUEUE").otherwise("STATUS_CHANGE")
    return j.select(F.md5(F.concat_ws("|", "task_id", "old_status", "new_status", F.lit(as_of))).alias("audit_id"), "task_id", action.alias("action"),
                    "old_status", "new_status", F.lit(actor).alias("actor"), ts(as_of).alias("timestamp"))


def delete_where(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """(kept rows, one-row count of the deleted). Rows for which the predicate is unknown stay."""
    hit = F.coalesce(predicate, F.lit(False))
    return df.where(~hit), df.agg(F.count_if(hit).alias("n_deleted"))


def retention_delete(tasks: DataFrame, as_of: str, days: int = 30) -> tuple[DataFrame, DataFrame]:
    old = F.col("updated_at") < ts(as_of) - F.make_interval(days=F.lit(days))
    return delete_where(tasks, (F.col("status") == "COMPLETED") & old)


# ---- health -----------------------------------------------------------------------------------------

@dataclass(frozen=True)
class AlertLimits:
    max_pending: int = 100
    max_dlq_per_hour: int = 5
    max_consecutive_failures: int = 3
    max_age_minutes: float = 1440
    min_success_rate: float = 0.95


def status_counts(tasks: DataFrame, by: str = "status") -> DataFrame:
    """Counts per value and the total (NULL)."""
    return tasks.rollup(by).agg(F.count("*").alias("n"))


def consecutive_failures(tasks: DataFrame, n: int = 10) -> DataFrame:
    """One row: the unbroken run of failures at the head of the ``n`` latest finished tasks."""
    latest = (tasks.where(F.col("status").isin(*FINISHED)).select("status", "updated_at", "task_id")
              .orderBy(F.col("updated_at").desc(), F.col("task_id")).limit(n))
    # at most n rows; newest first, ties by task id as in the order above
    age = -F.unix_micros(F.col("updated_at").cast("timestamp"))
    listed = F.sort_array(F.collect_list(F.struct(age.alias("age"), "task_id", (F.col("status") == "COMPLETED").alias("ok"))))
    ends = F.array_position(F.transform("_l", lambda x: x["ok"]), True)
    return latest.agg(listed.alias("_l")).select(F.when(ends > 0, ends - 1).otherwise(F.size("_l")).cast("bigint").alias("consecutive_failures"))


def health(tasks: DataFrame, as_of: str, limits: AlertLimits = AlertLimits()) -> DataFrame:
    """One row of queue metrics with the overall status; one aggregate over the table plus the short top list."""
    s, at = F.col("status"), ts(as_of)
    waiting = s.isin("PENDING", "READY", "RETRY_SCHEDULED")
    row = tasks.agg(
        F.count("*").alias("total_tasks"), F.count_if(s.isin("PENDING", "READY")).alias("pending_tasks"),
        F.count_if(s == "PROCESSING").alias("processing_tasks"), F.count_if(s == "RETRY_SCHEDULED").alias("retry_scheduled_tasks"),
        F.count_if(s == "COMPLETED").alias("completed_tasks"), F.count_if(s == "FAILED").alias("failed_tasks"),
        F.count_if(s == "DEAD_LETTER").alias("dead_letter_tasks"), F.coalesce(F.avg("retry_count"), F.lit(0.0)).alias("avg_retry_count"),
        F.coalesce(F.avg(F.when(s == "COMPLETED", F.col("execution_time_seconds"))), F.lit(0.0)).alias("avg_execution_time_seconds"),
        F.coalesce(_minutes(at, F.min(F.when(waiting, F.col("created_at")))), F.lit(0.0)).alias("oldest_pending_task_age_minutes"),
        F.count_if((s == "DEAD_LETTER") & (F.col("updated_at") >= at - F.make_interval(hours=F.lit(1)))).alias("tasks_in_dlq_last_hour"))
    row = row.withColumn("consecutive_failures", consecutive_failures(tasks).scalar())
    return health_status(row, limits).withColumn("timestamp", at)


def _success_rate() -> Column:
    done, lost = F.col("completed_tasks"), F.col("failed_tasks") + F.col("dead_letter_tasks")
    return F.try_divide(done.cast("double"), (done + lost).cast("double"))


def health_status(row: DataFrame, limits: AlertLimits = AlertLimits()) -> DataFrame:
    status = (F.when(F.col("consecutive_failures") >= limits.max_consecutive_failures, "CRITICAL")
              .when(F.col("tasks_in_dlq_last_hour") >= limits.max_dlq_per_hour, "CRITICAL")
              .when(F.col("pending_tasks") >= limits.max_pending, "DEGRADED")
              .when(F.col("oldest_pending_task_age_minutes") >= limits.max_age_minutes, "DEGRADED")
              .when(_success_rate() < limits.min_success_rate, "DEGRADED").otherwise("HEALTHY"))
    return row.withColumn("health_status", status)


def health_alerts(row: DataFrame, limits: AlertLimits = AlertLimits()) -> DataFrame:
    """(severity, type, message, threshold, actual) rows for every exceeded limit."""
    def alert(hit: Column, severity: str, kind: str, message: Column, threshold: float, actual: Column) -> Column:
        return F.when(hit, F.struct(F.lit(severity).alias("severity"), F.lit(kind).alias("type"), message.alias("message"),
                                    F.lit(float(threshold)).alias("threshold"), actual.cast("double").alias("actual")))

    dlq, run, wait, age = (F.col(c) for c in ("tasks_in_dlq_last_hour", "consecutive_failures", "pending_tasks", "oldest_pending_task_age_minutes"))
    rate = _success_rate()
    text = F.format_string
    # fixed values: severities, types and messages
    return row.select(F.inline(F.array_compact(F.array(
        alert(dlq >= limits.max_dlq_per_hour, "CRITICAL", "DLQ_THRESHOLD_EXCEEDED", text("%d tasks moved to DLQ in last hour", dlq), limits.max_dlq_per_hour, dlq),
        alert(run >= limits.max_consecutive_failures, "CRITICAL", "CONSECUTIVE_FAILURES", text("%d consecutive task failures", run), limits.max_consecutive_failures, run),
        alert(wait >= limits.max_pending, "WARNING", "QUEUE_DEPTH_HIGH", text("%d tasks pending in queue", wait), limits.max_pending, wait),
        alert(age >= limits.max_age_minutes, "WARNING", "TASK_AGE_HIGH", text("Oldest pending task is %.0f minutes old", F.round(age, 0)), limits.max_age_minutes, age),
        alert(rate < limits.min_success_rate, "WARNING", "LOW_SUCCESS_RATE", text("Success rate is %.2f%%", F.round(rate * 100, 2)), limits.min_success_rate, rate)))))


def metrics_trend(metrics: DataFrame, as_of: str, hours: int = 24) -> DataFrame:
    """Newest minus oldest snapshot inside the lookback; no row for fewer than two snapshots."""
    cut = ts(as_of) - F.make_interval(hours=F.lit(hours))
    def change(c: str) -> Column:
        return (F.max_by(c, "timestamp") - F.min_by(c, "timestamp"))
    return (metrics.where(F.col("timestamp") >= cut).agg(
        F.count("*").alias("_n"), change("pending_tasks").alias("pending_tasks_trend"), change("completed_tasks").alias("completed_tasks_trend"),
        change("dead_letter_tasks").alias("dlq_tasks_trend")).where("_n >= 2").drop("_n"))


def retry_stats(tasks: DataFrame) -> DataFrame:
    return tasks.groupBy("status").agg(F.avg("retry_count").alias("avg_retry"), F.max("retry_count").alias("max_retry"), F.count("*").alias("n"))


def error_frequency(tasks: DataFrame, statuses=("FAILED", "DEAD_LETTER", "RETRY_SCHEDULED")) -> DataFrame:
    return (tasks.where(F.col("status").isin(*statuses) & F.col("last_error").isNotNull()).groupBy("last_error")
            .agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "last_error"))


def execution_times(tasks: DataFrame) -> DataFrame:
    """Average and maximum per table, and overall (NULL table)."""
    done = tasks.where((F.col("status") == "COMPLETED") & F.col("execution_time_seconds").isNotNull())
    return done.rollup("table_name").agg(F.avg("execution_time_seconds").alias("avg_seconds"), F.max("execution_time_seconds").alias("max_seconds"), F.count("*").alias("n"))


def failure_rate(tasks: DataFrame, n: int = 100) -> DataFrame:
    """Share of failures among the last ``n`` finished tasks, by time of their last change; NULL if none is finished."""
    done = tasks.where(F.col("status").isin("COMPLETED", "FAILED", "DEAD_LETTER"))
    last = done.orderBy(F.col("updated_at").desc(), "task_id").limit(n)
    return last.agg(F.try_divide(F.count_if(F.col("status") != "COMPLETED"), F.count("*")).alias("failure_rate"))


def queue_summary(tasks: DataFrame) -> DataFrame:
    s, n = F.col("status"), F.count("*")
    return tasks.agg(n.alias("total"), F.coalesce(F.try_divide(F.count_if(s == "COMPLETED") * 100, n), F.lit(0.0)).alias("success_pct"),
                     F.coalesce(F.try_divide(F.count_if(s.isin("FAILED", "DEAD_LETTER")) * 100, n), F.lit(0.0)).alias("failure_pct"))


def recent(tasks: DataFrame, statuses=None, by: str = "updated_at", n: int = 10) -> DataFrame:
    rows = tasks if statuses is None else tasks.where(F.col("status").isin(*statuses))
    return rows.orderBy(F.col(by).desc(), "task_id").limit(n)


def dead_letters(tasks: DataFrame) -> DataFrame:
    return tasks.where(F.col("status") == "DEAD_LETTER").orderBy(F.col("updated_at").desc(), "task_id").select(
        "task_id", "task_name", "table_name", "retry_count", "last_error", "updated_at")


def task_detail(tasks: DataFrame, task_id: str) -> DataFrame:
    return tasks.where(F.col("task_id") == task_id)

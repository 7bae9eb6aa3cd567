"""Work-queue analytics and retry rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from veriloom.catalog import common  # noqa: F401
from veriloom.catalog.registry import frame_sql, query
from veriloom.functions import backoff
from veriloom.operators import queue
from veriloom.sources import frames as src

AS_OF = src.QUEUE_AS_OF
LIMITS = queue.AlertLimits()


def _tasks(spark, d):
    return queue.with_retry_fields(src.tasks(spark, d))


@query("task_json_fields", "task_id retry_count:i last_error next_retry_at:t table_name", "SELECT * FROM tasks")
def _(spark, d):
    return _tasks(spark, d)


@query("retry_delay", "task_id delay:r", "SELECT task_id, least(60 * pow(2, retry_count), 3600) AS delay FROM tasks")
def _(spark, d):
    return _tasks(spark, d).withColumn("delay", backoff.exponential(F.col("retry_count")))


@query("retry_delay_jitter", "task_id bounded repeatable", "SELECT task_id, TRUE AS bounded, TRUE AS repeatable FROM tasks")
def _(spark, d):
    """Jittered delays stay within a tenth of the plain ones and repeat for a key."""
    jittered = backoff.exponential(F.col("retry_count"), jitter=0.1, key=F.col("task_id"))
    df = _tasks(spark, d).withColumns({"delay": jittered, "again": jittered})
    ratio = F.col("delay") / backoff.exponential(F.col("retry_count"))
    return df.select("task_id", ratio.between(0.9 - 1e-9, 1.1 + 1e-9).alias("bounded"), (F.col("delay") == F.col("again")).alias("repeatable"))


@query("retry_delay_jitter_spread", "many:i", "SELECT 1 AS many FROM (SELECT count(*) AS n FROM tasks WHERE retry_count = 2) WHERE n > 1")
def _(spark, d):
    """Tasks of equal retry counts are spread."""
    delay = backoff.exponential(F.col("retry_count"), jitter=0.1, key=F.col("task_id"))
    return _tasks(spark, d).where("retry_count = 2").select(delay.alias("d")).agg(F.countDistinct("d").alias("n")).where("n > 1").select(F.lit(1).alias("many"))


@query("retry_delay_adaptive", "task_id delay:r", """
SELECT task_id, least(least(60 * pow(2, retry_count), 3600) * CASE priority WHEN 1 THEN 0.5 WHEN 2 THEN 2 WHEN 3 THEN 3 ELSE 1 END * (1 + retry_count / 10), 3600) AS delay FROM tasks""")
def _(spark, d):
    kind = F.element_at(F.array(*map(F.lit, ("network_timeout", "rate_limit", "resource_exhausted", "unheard_of"))), F.col("priority"))
    return _tasks(spark, d).withColumn("delay", backoff.delay_for("adaptive", F.col("retry_count"), kind, F.col("retry_count") / 10))


@query("retry_delay_network", "task_id delay:r retryable", "SELECT task_id, [2, 4, 8, 16][least(retry_count + 1, 4)] AS delay, retry_count < 4 AS retryable FROM tasks")
def _(spark, d):
    n = F.col("retry_count")
    return _tasks(spark, d).withColumns({"delay": backoff.network(n), "retryable": backoff.network_retryable(n)})


@query("retry_schedule", "task_id attempt:i delay_seconds:r2 delay_minutes:r2 cumulative_minutes:r2", """
SELECT task_id, a AS attempt, s AS delay_seconds, s / 60 AS delay_minutes, c AS cumulative_minutes FROM tasks, (VALUES (1, 60, 1), (2, 120, 3), (3, 240, 7), (4, 480, 15), (5, 960, 31)) AS t(a, s, c)
WHERE status = 'RETRY_SCHEDULED'""")
def _(spark, d):
    return queue.retry_schedule(src.tasks(spark, d).where("status = 'RETRY_SCHEDULED'"))


@query("classify_network_error", "task_id is_network", "SELECT task_id, coalesce(regexp_matches(lower(last_error), 'timeout|connection'), FALSE) AS is_network FROM tasks")
def _(spark, d):
    return _tasks(spark, d).withColumn("is_network", backoff.is_network_error(F.col("last_error")))


@query("failure_routing", "task_id new_status retry_count:i last_error backoff_seconds:r next_retry_at:t", """
SELECT task_id, CASE WHEN retry_count < 5 THEN 'RETRY_SCHEDULED' ELSE 'DEAD_LETTER' END AS new_status, CASE WHEN retry_count < 5 THEN retry_count + 1 ELSE retry_count END AS retry_count, last_error,
 CASE WHEN retry_count < 5 THEN least(60 * pow(2, retry_count), 3600) END AS backoff_seconds, CASE WHEN retry_count < 5 THEN queue_as_of + to_seconds(CAST(least(60 * pow(2, retry_count), 3600) AS INTEGER)) END AS next_retry_at
FROM tasks, as_of WHERE status = 'FAILED'""")
def _(spark, d):
    failed = _tasks(spark, d).where("status = 'FAILED'").select("task_id", "retry_count", F.col("last_error").alias("error"))
    return queue.route_failures(failed, AS_OF)


READY = """status IN ('PENDING', 'READY') OR (status = 'RETRY_SCHEDULED' AND next_retry_at <= queue_as_of)"""


@query("ready_predicate", "task_id status priority:i", f"SELECT * FROM tasks, as_of WHERE {READY}")
def _(spark, d):
    return queue.ready(_tasks(spark, d), AS_OF)


@query("ready_tasks_topk", "task_id priority:i created_at:t", f"SELECT * FROM tasks, as_of WHERE {READY} ORDER BY priority, created_at, task_id LIMIT 10")
def _(spark, d):
    return queue.ready_top(_tasks(spark, d), AS_OF)


@query("stuck_tasks", "task_id locked_until:t", "SELECT * FROM tasks, as_of WHERE status = 'PROCESSING' AND locked_until < queue_as_of")
def _(spark, d):
    return queue.stuck(src.tasks(spark, d), AS_OF)


@query("recover_stuck", "task_id status locked_until:t", """
SELECT task_id, CASE WHEN status = 'PROCESSING' AND locked_until < queue_as_of THEN 'READY' ELSE status END AS status, CASE WHEN NOT (status = 'PROCESSING' AND locked_until < queue_as_of) THEN locked_until END AS locked_until FROM tasks, as_of""")
def _(spark, d):
    return queue.recover_stuck(src.tasks(spark, d), AS_OF)


def _attempts(spark, d):
    t = _tasks(spark, d).where("retry_count > 0")
    a = F.explode(F.sequence(F.lit(1), F.col("retry_count"))).alias("attempt")
    return t.select("task_id", "last_error", "created_at", a).select(
        "task_id", "attempt", F.col("last_error").alias("error"), (F.col("created_at") + F.make_interval(mins=F.col("attempt"))).alias("attempted_at"))


@query("retry_history", "task_id attempt:i error attempted_at:t", """
SELECT task_id, a AS attempt, last_error AS error, created_at + to_minutes(CAST(a AS INTEGER)) AS attempted_at
FROM (SELECT *, unnest(range(1, CAST(retry_count AS BIGINT) + 1)) AS a FROM tasks WHERE retry_count > 0)""")
def _(spark, d):
    return queue.retry_history(_attempts(spark, d))


@query("retry_summary", "task_id n:i first_error last_at:t", """
SELECT task_id, retry_count AS n, last_error AS first_error, created_at + to_minutes(CAST(retry_count AS INTEGER)) AS last_at FROM tasks WHERE retry_count > 0""")
def _(spark, d):
    return queue.retry_summary(_attempts(spark, d))


@query("audit_append", "task_id action old_status new_status actor timestamp:t", """
SELECT task_id, 'STATUS_CHANGE' AS action, 'PROCESSING' AS old_status, 'READY' AS new_status, 'monitor' AS actor, queue_as_of AS "timestamp" FROM tasks, as_of
WHERE status = 'PROCESSING' AND locked_until < queue_as_of AND priority <> 1
UNION ALL SELECT task_id, 'ENQUEUE', NULL, CASE WHEN status = 'PROCESSING' THEN 'READY' ELSE status END, 'monitor', queue_as_of FROM tasks, as_of WHERE priority = 1""")
def _(spark, d):
    t = src.tasks(spark, d)
    return queue.audit_transitions(t.where("priority <> 1"), queue.recover_stuck(t, AS_OF), "monitor", AS_OF)


@query("retention_delete", "task_id status", "SELECT task_id, status FROM tasks, as_of WHERE NOT (status = 'COMPLETED' AND updated_at < queue_as_of - INTERVAL 30 DAY)")
def _(spark, d):
    return queue.retention_delete(src.tasks(spark, d), AS_OF)[0]


@query("retention_delete_count", "n_deleted:i", "SELECT count(*) AS n_deleted FROM tasks, as_of WHERE status = 'COMPLETED' AND updated_at < queue_as_of - INTERVAL 30 DAY")
def _(spark, d):
    return queue.retention_delete(src.tasks(spark, d), AS_OF)[1]


@query("delete_where", "task_id status", "SELECT * FROM tasks WHERE NOT (status = 'DEAD_LETTER' AND priority >= 3)")
def _(spark, d):
    return queue.delete_where(src.tasks(spark, d), F.expr("status = 'DEAD_LETTER' AND priority >= 3"))[0]


@query("queue_status_counts", "status n:i", "SELECT status, count(*) AS n FROM tasks GROUP BY ROLLUP (status)")
def _(spark, d):
    return queue.status_counts(src.tasks(spark, d))


@query("queue_priority_counts", "priority:i n:i", "SELECT priority, count(*) AS n FROM tasks GROUP BY ROLLUP (priority)")
def _(spark, d):
    return queue.status_counts(src.tasks(spark, d), "priority")


frame_sql("consec", """
SELECT coalesce(min(CASE WHEN status = 'COMPLETED' THEN r END) - 1, count(*)) AS consecutive_failures FROM (
 SELECT status, row_number() OVER (ORDER BY updated_at DESC, task_id) AS r FROM tasks WHERE status IN ('COMPLETED', 'FAILED', 'DEAD_LETTER')) WHERE r <= 10""")
frame_sql("health", """
SELECT *, CASE WHEN consecutive_failures >= 3 OR tasks_in_dlq_last_hour >= 5 THEN 'CRITICAL' WHEN pending_tasks >= 100 OR oldest_pending_task_age_minutes >= 1440
  OR completed_tasks / (completed_tasks + failed_tasks + dead_letter_tasks) < 0.95 THEN 'DEGRADED' ELSE 'HEALTHY' END AS health_status FROM (
 SELECT count(*) AS total_tasks, count(*) FILTER (status IN ('PENDING', 'READY')) AS pending_tasks, count(*) FILTER (status = 'PROCESSING') AS processing_tasks,
  count(*) FILTER (status = 'RETRY_SCHEDULED') AS retry_scheduled_tasks, count(*) FILTER (status = 'COMPLETED') AS completed_tasks, count(*) FILTER (status = 'FAILED') AS failed_tasks,
  count(*) FILTER (status = 'DEAD_LETTER') AS dead_letter_tasks, avg(retry_count) AS avg_retry_count, avg(execution_time_seconds) AS avg_execution_time_seconds,
  date_diff('microsecond', min(CASE WHEN status IN ('PENDING', 'READY', 'RETRY_SCHEDULED') THEN created_at END), any_value(queue_as_of)) / 6e7 AS oldest_pending_task_age_minutes,
  count(*) FILTER (status = 'DEAD_LETTER' AND updated_at >= queue_as_of - INTERVAL 1 HOUR) AS tasks_in_dlq_last_hour FROM tasks, as_of), consec""")

HEALTH = ("total_tasks:i pending_tasks:i processing_tasks:i retry_scheduled_tasks:i completed_tasks:i failed_tasks:i dead_letter_tasks:i avg_retry_count:r "
          "avg_execution_time_seconds:r oldest_pending_task_age_minutes:r tasks_in_dlq_last_hour:i consecutive_failures:i health_status")


@query("consecutive_failures", "consecutive_failures:i", "SELECT * FROM consec")
def _(spark, d):
    return queue.consecutive_failures(src.tasks(spark, d))


@query("queue_health", HEALTH, "SELECT * FROM health")
def _(spark, d):
    return queue.health(_tasks(spark, d), AS_OF)


@query("health_status", "timestamp:t pending_tasks:i health_status", """
SELECT *, CASE WHEN dead_letter_tasks >= 5 THEN 'CRITICAL' WHEN pending_tasks >= 100 THEN 'DEGRADED' WHEN completed_tasks / nullif(completed_tasks + dead_letter_tasks, 0) < 0.95 THEN 'DEGRADED' ELSE 'HEALTHY' END AS health_status FROM health_metrics""")
def _(spark, d):
    day = src.health_metrics(spark, d).withColumns({
        "consecutive_failures": F.lit(0), "tasks_in_dlq_last_hour": F.col("dead_letter_tasks"), "oldest_pending_task_age_minutes": F.lit(0.0), "failed_tasks": F.lit(0)})
    return queue.health_status(day)


@query("health_alerts", "severity type message threshold:r actual:r", """
SELECT 'CRITICAL' AS severity, 'DLQ_THRESHOLD_EXCEEDED' AS type, tasks_in_dlq_last_hour || ' tasks moved to DLQ in last hour' AS message, 5 AS threshold, tasks_in_dlq_last_hour AS actual FROM health WHERE tasks_in_dlq_last_hour >= 5
UNION ALL SELECT 'CRITICAL', 'CONSECUTIVE_FAILURES', consecutive_failures || ' consecutive task failures', 3, consecutive_failures FROM health WHERE consecutive_failures >= 3
UNION ALL SELECT 'WARNING', 'QUEUE_DEPTH_HIGH', pending_tasks || ' tasks pending in queue', 100, pending_tasks FROM health WHERE pending_tasks >= 100
UNION ALL SELECT 'WARNING', 'TASK_AGE_HIGH', printf('Oldest pending task is %.0f minutes old', round(oldest_pending_task_age_minutes, 0)), 1440, oldest_pending_task_age_minutes FROM health WHERE oldest_pending_task_age_minutes >= 1440
UNION ALL SELECT 'WARNING', 'LOW_SUCCESS_RATE', printf('Success rate is %.2f%%', round(s * 100, 2)), 0.95, s FROM (SELECT completed_tasks / (completed_tasks + failed_tasks + dead_letter_tasks) AS s FROM health) WHERE s < 0.95""")
def _(spark, d):
    return queue.health_alerts(queue.health(_tasks(spark, d), AS_OF))


@query("metrics_trend", "pending_tasks_trend:i completed_tasks_trend:i dlq_tasks_trend:i", """
SELECT arg_max(pending_tasks, "timestamp") - arg_min(pending_tasks, "timestamp") AS pending_tasks_trend, arg_max(completed_tasks, "timestamp") - arg_min(completed_tasks, "timestamp") AS completed_tasks_trend,
 arg_max(dead_letter_tasks, "timestamp") - arg_min(dead_letter_tasks, "timestamp") AS dlq_tasks_trend FROM health_metrics, as_of WHERE "timestamp" >= queue_as_of - INTERVAL 720 HOUR""")
def _(spark, d):
    return queue.metrics_trend(src.health_metrics(spark, d), AS_OF, 720)


@query("retry_stats", "status avg_retry:r max_retry:i n:i", "SELECT status, avg(retry_count) AS avg_retry, max(retry_count) AS max_retry, count(*) AS n FROM tasks GROUP BY 1")
def _(spark, d):
    return queue.retry_stats(_tasks(spark, d))


@query("error_frequency", "last_error n:i", "SELECT last_error, count(*) AS n FROM tasks WHERE status IN ('FAILED', 'DEAD_LETTER', 'RETRY_SCHEDULED') AND last_error IS NOT NULL GROUP BY 1")
def _(spark, d):
    return queue.error_frequency(_tasks(spark, d))


@query("exec_time_by_table", "table_name avg_seconds:r max_seconds:r n:i", """
SELECT table_name, avg(execution_time_seconds) AS avg_seconds, max(execution_time_seconds) AS max_seconds, count(*) AS n FROM tasks WHERE status = 'COMPLETED' GROUP BY ROLLUP (table_name)""")
def _(spark, d):
    return queue.execution_times(_tasks(spark, d))


@query("failure_rate", "failure_rate:r", """
SELECT count(*) FILTER (status <> 'COMPLETED') / count(*) AS failure_rate FROM (SELECT status FROM tasks WHERE status IN ('COMPLETED', 'FAILED', 'DEAD_LETTER') ORDER BY updated_at DESC, task_id LIMIT 100)""")
def _(spark, d):
    return queue.failure_rate(src.tasks(spark, d))


@query("queue_summary", "total:i success_pct:r failure_pct:r", """
SELECT count(*) AS total, count(*) FILTER (status = 'COMPLETED') * 100 / count(*) AS success_pct, count(*) FILTER (status IN ('FAILED', 'DEAD_LETTER')) * 100 / count(*) AS failure_pct FROM tasks""")
def _(spark, d):
    return queue.queue_summary(src.tasks(spark, d))


@query("recent_tasks", "task_id status updated_at:t", "SELECT * FROM tasks ORDER BY updated_at DESC, task_id LIMIT 10")
def _(spark, d):
    return queue.recent(src.tasks(spark, d))


@query("recent_failures", "task_id status updated_at:t", "SELECT * FROM tasks WHERE status IN ('FAILED', 'DEAD_LETTER') ORDER BY updated_at DESC, task_id LIMIT 10")
def _(spark, d):
    return queue.recent(src.tasks(spark, d), ("FAILED", "DEAD_LETTER"))


@query("dlq_listing", "task_id task_name table_name retry_count:i last_error updated_at:t", "SELECT * FROM tasks WHERE status = 'DEAD_LETTER'")
def _(spark, d):
    return queue.dead_letters(_tasks(spark, d))


@query("task_detail", "task_id status priority:i table_name last_error", "SELECT * FROM tasks WHERE task_id = 'task-123'")
def _(spark, d):
    return queue.task_detail(_tasks(spark, d), "task-123")

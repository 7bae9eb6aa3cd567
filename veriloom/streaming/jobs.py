"""Streaming jobs over file streams. Every sink is a table in shared storage, keyed by batch where a batch may be
repeated after a failure; nothing is gathered on the driver."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from veriloom.operators import audit, conform, fraud, marts, quality, queue
from veriloom.operators import rules as R
from veriloom.operators.skew import latest_per_key, previous_row, same_keys
from veriloom.plans import fraud as fraud_plan
from veriloom.session import materialise
from veriloom.sources import claims as claim_files
from veriloom.sources import files, merge
from veriloom.streaming import sums


def claims_source(spark: SparkSession, folder: str, per_trigger: int = 1) -> DataFrame:
    """Claims CSV files as they arrive; ``per_trigger`` files form a micro-batch, the last one whatever is left."""
    header = ", ".join(f"{h} string" for h in claim_files.CLAIM_HEADERS)
    raw = (spark.readStream.schema(header).option("header", True).option("mode", "PERMISSIVE")
           .option("enforceSchema", False).option("maxFilesPerTrigger", per_trigger).csv(folder))
    return claim_files._typed(raw, claim_files.CLAIM_HEADERS)


def table_source(spark: SparkSession, folder: str, schema, per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(folder)


def start(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append",
          available_now: bool = True) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).outputMode(mode)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def drain(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Process everything available, then stop; errors inside a batch are raised here."""
    start(stream, each, checkpoint, mode).awaitTermination()


def to_batches(sink: str) -> Callable[[DataFrame, int], None]:
    """Write each micro-batch under its number; a repeated batch replaces itself."""
    def each(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")
    return each


def last_batch(spark: SparkSession, sink: str) -> DataFrame:
    """The rows of the newest batch: a complete-mode result as of now."""
    df = spark.read.parquet(sink)
    return df.where(F.col("batch") == df.agg(F.max("batch")).scalar()).drop("batch")


def latest_rows(spark: SparkSession, sink: str, keys: Sequence[str]) -> DataFrame:
    """The newest version per key of an update-mode result."""
    return latest_per_key(spark.read.parquet(sink), keys, [F.col("batch").desc()]).drop("batch")


def fraud_alerts(stream: DataFrame, sink: str, state: str, checkpoint: str, as_of: str, params: dict | None = None, fold: int = sums.FOLD,
                 confidence: float = 0.5, include_low: bool = False) -> None:
    """The built-in detectors on all claims so far, after every micro-batch.

    What they need of the claims adds up: counts per provider, per day and per physician, and who was seen on which day. These sums are kept in
    ``state`` from batch to batch, so peers, month baselines and provider-days go on where the last batch ended, and however the input
    is cut, the newest batch of ``sink`` holds the alerts of the batch pipeline on the whole. Claims are read once. A repeated batch replaces its own sums
    and alerts.
    """
    write = to_batches(sink)

    def each(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        parts = fraud.measure(fraud_plan.stored_claims(df))
        for name, (keys, added) in fraud.Measures.SHAPE.items():
            sums.add(getattr(parts, name), f"{state}/{name}", batch_id)
        whole = {name: sums.total(spark, f"{state}/{name}", batch_id, keys, added) for name, (keys, added) in fraud.Measures.SHAPE.items()}
        whole["days"] = materialise(whole["days"], "days")  # three detectors read it
        found = fraud_plan.judged(fraud.Measures(**whole), {"as_of": as_of, **(params or {})}, list(fraud.JUDGES))
        write(fraud.keep_confident(found, confidence, include_low), batch_id)
        for name, (keys, added) in fraud.Measures.SHAPE.items():
            sums.fold(spark, f"{state}/{name}", batch_id, keys, added, fold)

    drain(stream, each, checkpoint)


def provider_profile(stream: DataFrame, sink: str, checkpoint: str) -> None:
    """Running claims and amount per provider; each update carries only the providers that changed."""
    agg = stream.groupBy("provider_npi").agg(F.count("*").alias("total_claims"), F.sum("billed_amount").alias("total_amount"))
    drain(agg, to_batches(sink), checkpoint, "update")


SILVER_BUCKETS = 256


def silver_upsert(stream: DataFrame, path: str, table: str, load_date: str, checkpoint: str, as_of=None, buckets: int = SILVER_BUCKETS) -> None:
    """Raw rows to silver per micro-batch: conform, clean, de-duplicate, merge by hash. Only folders of ``path`` in which a key
    of the batch falls are rewritten.

    Rows of a batch may repeat earlier ones: equal hashes leave the stored row, older versions are dropped by
    keeping the later ModifiedDate.
    """
    keys = conform.PRIMARY_KEYS[table]

    def newer(old: DataFrame, new: DataFrame) -> DataFrame:
        return merge.upsert(old, new, keys, since="ModifiedDate")

    def each(df: DataFrame, batch_id: int) -> None:
        new = conform.bronze_to_silver(df, table, load_date, as_of)
        if files.exists(df.sparkSession, path):
            merge.merge_bucketed(df.sparkSession, path, new, keys, newer, buckets)
        else:
            merge.write_bucketed(new, path, keys, buckets)

    drain(stream, each, checkpoint)


def critical_alerts(stream: DataFrame, patients: DataFrame, sink: str, checkpoint: str, rules=None) -> None:
    """Stateless: enrich by stream-static joins, validate, keep critical rows with their severity."""
    df = quality.reference_range(quality.enrich(stream, patients, R.test_catalogue(stream.sparkSession)), rules)
    alerts = marts.critical_alerts(df.withColumn("CriticalFlag", F.col("IsCriticalValue")))
    (alerts.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).outputMode("append")
     .trigger(availableNow=True).start().awaitTermination())


def phi_access_windows(stream: DataFrame, limit: int = 100, delay: str = "10 minutes", width: str = "1 hour", slide: str = "5 minutes") -> DataFrame:
    """Users above ``limit`` accesses in a sliding window; rows later than ``delay`` are dropped."""
    rows = stream.where("PHIAccessed").withColumn("ts", F.col("AccessTimestamp").cast("timestamp")).withWatermark("ts", delay)
    return (rows.groupBy("UserId", F.window("ts", width, slide).alias("w")).agg(F.count("*").alias("access_count"))
            .where(F.col("access_count") > limit).select("UserId", F.col("w.start").alias("window_start"), "access_count"))


def phi_access(stream: DataFrame, sink: str, checkpoint: str, limit: int = 100, delay: str = "10 minutes") -> None:
    drain(phi_access_windows(stream, limit, delay), to_batches(sink), checkpoint, "update")


def phi_excessive_access(stream: DataFrame, sink: str, state: str, checkpoint: str, limit: int = 100, span_hours: int = 1) -> None:
    """Accesses that bring a user above ``limit`` within the trailing hour, as ``audit.excessive_access`` finds them, however they arrive.

    Accesses are kept in folders by span of time and batch. A batch can change counts in its own spans and the hour after them, so those
    spans and the one before are read and counted for the batch's users; no late row is dropped, and a repeated batch replaces its own
    folders. The newest row per AuditId in ``sink`` is the count as of now. Spans should be short on a busy log, long on a sparse one.
    """
    span = F.floor(F.unix_micros(F.col("AccessTimestamp").cast("timestamp")) / F.lit(span_hours * 3_600_000_000)).cast("bigint")

    def each(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        new = df.where("PHIAccessed").select("AuditId", "UserId", "AccessTimestamp", "PHIAccessed", span.alias("span"))
        (new.withColumn("batch", F.lit(batch_id)).hint("rebalance", "span").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("span", "batch").parquet(state))
        touched = sorted(r[0] for r in new.select("span").distinct().where("span IS NOT NULL").collect())  # bounded by the calendar
        ours, after = set(touched), {k + 1 for k in touched}
        names = [f"{state}/span={k}" for k in sorted(ours | after | {k - 1 for k in touched})]
        names = [p for p in names if files.exists(spark, p)]
        if not names:
            return
        schema = new.drop("span").schema
        kept = spark.read.schema(schema.add("span", "long").add("batch", "long")).option("basePath", state).parquet(*names).where(F.col("batch") <= batch_id)
        users = new.select("UserId").distinct()
        rows = same_keys(kept.select("AuditId", "UserId", "AccessTimestamp", "PHIAccessed"), users, ["UserId"], "left_semi")
        counted = audit.excessive_access(rows, limit)
        counted.where(span.isin(sorted(ours | after))).write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

    drain(stream, each, checkpoint)


def daily_quality(stream: DataFrame, sink: str, checkpoint: str, delay: str = "1 day", mode: str = "update") -> None:
    """Daily metrics per laboratory and test of a stream of validated results, all that the batch table has. ``append`` writes a day
    once, when the watermark has passed it."""
    rows = stream.withColumn("ts", F.col("ResultDate").cast("timestamp")).withWatermark("ts", delay)
    agg = rows.groupBy(F.window("ts", "1 day").alias("w"), "PerformingLabId", "TestCode").agg(
        F.count("*").alias("TotalTests"), F.count_if("CriticalFlag").alias("CriticalValues"), F.count_if("IsAnomaly").alias("AnomalousResults"),
        F.count_if(~F.col("ReferenceRangeValid")).alias("ValidationFailures"), F.avg("TurnaroundTimeMinutes").alias("AvgTurnaroundTimeMinutes"),
        F.count_if(F.col("ResultValueNumeric").isNull()).alias("MissingResults"))
    share = lambda n: F.col(n) / F.col("TotalTests") * 100
    out = agg.select(F.to_date("w.start").alias("MetricDate"), "PerformingLabId", "TestCode", "TotalTests", "CriticalValues", "AnomalousResults", "ValidationFailures",
                     "AvgTurnaroundTimeMinutes", "MissingResults", share("CriticalValues").alias("CriticalValueRate"), share("AnomalousResults").alias("AnomalyRate"),
                     share("ValidationFailures").alias("ValidationFailureRate"), (F.lit(100) - share("MissingResults")).alias("CompletenessRate"))
    drain(out, to_batches(sink), checkpoint, mode)


def cdc_apply(stream: DataFrame, path: str, keys: Sequence[str], checkpoint: str, buckets: int = SILVER_BUCKETS) -> None:
    """Apply each micro-batch's net changes to a bucketed table, rewriting only the folders they touch. Micro-batches must follow
    the log."""
    def each(df: DataFrame, batch_id: int) -> None:
        merge.merge_bucketed(df.sparkSession, path, df, keys, lambda target, changes: merge.apply_changes(target, changes, keys), buckets)

    drain(stream, each, checkpoint)


DELTA_OUT = ("ResultId bigint, PatientId bigint, TestCode string, ResultDate timestamp, ResultValueNumeric double, "
             "PreviousResult double, PreviousResultDate timestamp, IsLate boolean")
DELTA_STATE = "value double, micros bigint, result_id bigint"


def _remember(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState, ttl_ms: int | None) -> Iterator[pd.DataFrame]:
    """Per patient and test: pair each result with the one before it; the state is the newest result seen."""
    if state.hasTimedOut:
        state.remove()
        return
    pdf = pd.concat(list(frames), ignore_index=True)
    stamp = pdf["ResultDate"].to_numpy().astype("datetime64[us]").astype("int64")
    ids, values = pdf["ResultId"].to_numpy(), pdf["ResultValueNumeric"].to_numpy(dtype=float)
    last = state.get if state.exists else None
    n = len(pdf)
    late, before, when = np.zeros(n, bool), np.full(n, np.nan), np.full(n, np.datetime64("NaT"), "datetime64[us]")
    order = np.lexsort((ids, stamp))
    if last is not None:
        late[:] = (stamp < last[1]) | ((stamp == last[1]) & (ids < last[2]))
        order = order[~late[order]]
    if len(order):
        before[order[1:]] = values[order[:-1]]
        when[order[1:]] = stamp[order[:-1]].astype("datetime64[us]")
        if last is not None:
            before[order[0]] = np.nan if last[0] is None else last[0]
            when[order[0]] = np.datetime64(last[1], "us")
        newest = order[-1]
        last = (None if np.isnan(values[newest]) else float(values[newest]), int(stamp[newest]), int(ids[newest]))
    state.update(last)
    if ttl_ms is not None:
        state.setTimeoutTimestamp(last[1] // 1000 + ttl_ms)
    yield pd.DataFrame({"ResultId": ids, "PatientId": key[0], "TestCode": key[1], "ResultDate": pdf["ResultDate"], "ResultValueNumeric": values,
                        "PreviousResult": before, "PreviousResultDate": when, "IsLate": late})


def with_previous_state(stream: DataFrame, ttl: str | None = None, delay: str = "1 day") -> DataFrame:
    """Results beside the patient's previous one of the same test. A result older than the state is marked late
    and changes nothing.

    Without ``ttl`` state is kept for good and no row is dropped. With it (such as "365 days") a state expires
    that long after its last result in event time; Spark then drops rows later than ``delay``.
    """
    rows = stream.select("ResultId", "PatientId", "TestCode", F.col("ResultDate").cast("timestamp").alias("ResultDate"), "ResultValueNumeric")
    ttl_ms = None if ttl is None else int(pd.Timedelta(ttl).total_seconds() * 1000)
    timeout = GroupStateTimeout.NoTimeout if ttl is None else GroupStateTimeout.EventTimeTimeout
    if ttl is not None:
        rows = rows.withWatermark("ResultDate", delay)
    return rows.groupBy("PatientId", "TestCode").applyInPandasWithState(
        lambda key, frames, state: _remember(key, frames, state, ttl_ms), DELTA_OUT, DELTA_STATE, "append", timeout)


RESULT_KEYS = ["PatientId", "TestCode"]


def with_previous_stored(df: DataFrame, state: str, batch_id: int, fold: int = sums.FOLD) -> DataFrame:
    """What ``with_previous_state`` without ``ttl`` gives for one micro-batch, with the newest result per patient and test kept as tables in
    ``state`` and the pairs formed by windows over spans of time. A repeated batch replaces its own table."""
    spark = df.sparkSession
    rows = df.select("ResultId", *RESULT_KEYS, F.col("ResultDate").cast("timestamp").alias("ResultDate"), F.col("ResultValueNumeric").cast("double").alias("ResultValueNumeric"))
    place = F.struct("ResultDate", "ResultId", "ResultValueNumeric")
    rows = materialise(rows, "results")
    if batch_id > 0 and files.exists(spark, f"{state}/parts"):
        rows = same_keys(rows, sums.total(spark, state, batch_id - 1, RESULT_KEYS, most=["last"]), RESULT_KEYS, "left")
    else:
        rows = rows.withColumn("last", F.lit(None).cast(rows.select(place.alias("last")).schema["last"].dataType))
    late = F.coalesce(F.struct("ResultDate", "ResultId") < F.struct("last.ResultDate", "last.ResultId"), F.lit(False)) & F.col("last").isNotNull()
    marked = materialise(rows.withColumn("IsLate", late), "marked")
    paired = previous_row(marked.where("NOT IsLate"), RESULT_KEYS, ["ResultDate", "ResultId"], ["ResultValueNumeric", "ResultDate"])
    before = lambda c: F.when(F.col("_prev").isNotNull(), F.col(f"_prev.{c}")).otherwise(F.col(f"last.{c}"))
    on_time = paired.withColumns({"PreviousResult": before("ResultValueNumeric"), "PreviousResultDate": before("ResultDate")}).drop("_prev")
    out = on_time.unionByName(marked.where("IsLate").withColumns({"PreviousResult": F.lit(None).cast("double"), "PreviousResultDate": F.lit(None).cast("timestamp")}))
    sums.add(marked.where("NOT IsLate").groupBy(*RESULT_KEYS).agg(F.max(place).alias("last")), state, batch_id)
    sums.fold(spark, state, batch_id, RESULT_KEYS, every=fold, most=["last"])
    return out.drop("last")


def delta_check(stream: DataFrame, sink: str, checkpoint: str, rules=None, ttl: str | None = None, fold: int = sums.FOLD) -> None:
    """The delta check on a live stream: the previous result comes from what is kept beside the checkpoint, or with ``ttl`` from Spark's state;
    the rules are applied as in batch."""
    prev, write = F.col("PreviousResult"), to_batches(sink)

    def checked(df: DataFrame) -> DataFrame:
        df = df.withColumns({"DaysSincePrevious": F.datediff("ResultDate", "PreviousResultDate"),
                             "PercentChange": F.when(prev != 0, F.abs((F.col("ResultValueNumeric") - prev) / prev * 100))})
        return quality._apply(df, quality._delta, rules=rules)

    if ttl is not None:
        drain(checked(with_previous_state(stream, ttl)), write, checkpoint)
    else:
        newest = f"{checkpoint.rstrip('/')}-newest"
        drain(stream, lambda df, batch_id: write(checked(with_previous_stored(df, newest, batch_id, fold)), batch_id), checkpoint)


def health_snapshot(tasks: DataFrame, as_of: str, sink: str, limits: queue.AlertLimits = queue.AlertLimits()) -> tuple[DataFrame, DataFrame]:
    """One monitoring round: append the health row, return it with the alerts it raises."""
    spark = tasks.sparkSession
    row = queue.health(tasks, as_of, limits)
    files.append_rows(row, f"{sink}/metrics")
    saved = files.read_rows(spark, f"{sink}/metrics").where(F.col("timestamp") == queue.ts(as_of))
    alerts = queue.health_alerts(saved, limits).withColumn("raised_at", queue.ts(as_of))
    files.append_rows(alerts, f"{sink}/alerts")
    return saved, files.read_rows(spark, f"{sink}/alerts").where(F.col("raised_at") == queue.ts(as_of))

"""Domain frames derived from the provided tables; the SQL twins are in ``veriloom.catalog.frames``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2024-01-31 00:00:00"       # one instant after the last event
QUEUE_AS_OF = "2001-08-02 00:00:00"  # one day after the last order

CODES = ("K0001", "K0003", "K0005", "K0007", "K0008", "K0823", "A4352", "A4353", "E0603", "L0643",
         "E0601", "E0431", "E0424", "E0250", "E0570", "E2100", "E0130", "L3000", "E1390", "Z9999")


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _by_code(code: Column, choices: dict, default=None) -> Column:
    out = None
    for k, v in choices.items():
        out = F.when(code == k, F.lit(v)) if out is None else out.when(code == k, F.lit(v))
    return out.otherwise(F.lit(default)) if default is not None else out


def _lab_columns(events: DataFrame, version: Column) -> DataFrame:
    i = F.col("event_id")
    test = (F.when((F.col("event_type") == "error") & (i % 4 == 1), "POTASSIUM")
            .when(F.col("event_type") == "error", "HBA1C")
            .when((F.col("event_type") == "signup") & (i % 5 == 2), "TROPONIN")
            .when(F.col("event_type") == "signup", "WBC")
            .when((F.col("event_type") == "view") & (i % 11 == 5), "LDH")
            .when(F.col("event_type") == "view", "HEMOGLOBIN")
            .when(F.col("event_type") == "click", "GLUCOSE")
            .otherwise("CREATININE"))
    df = events.select("event_id", "user_id", "ts", "value", test.alias("TestCode"), version.alias("_version"))
    t = F.col("TestCode")
    divisor = _by_code(t, {"HBA1C": 10.0, "POTASSIUM": 12.0, "CREATININE": 50.0, "WBC": 5.0,
                           "HEMOGLOBIN": 4.0}, 1.0)
    unit = _by_code(t, {"GLUCOSE": "mg/dL", "HBA1C": "%", "CREATININE": "mg/dL", "WBC": "K/uL",
                        "HEMOGLOBIN": "g/dL", "POTASSIUM": "mEq/L", "TROPONIN": "ng/L"}, "U/L")
    low = _by_code(t, {"GLUCOSE": 70.0, "HBA1C": 4.0, "CREATININE": 0.59, "WBC": 4.5, "HEMOGLOBIN": 12.0,
                       "POTASSIUM": 3.5, "TROPONIN": 0.0}, 140.0)
    high = _by_code(t, {"GLUCOSE": 100.0, "HBA1C": 5.6, "CREATININE": 1.35, "WBC": 11.0, "HEMOGLOBIN": 17.5,
                        "POTASSIUM": 5.1, "TROPONIN": 14.0}, 280.0)
    df = df.select("*", divisor.alias("_div"), unit.alias("_unit"), low.alias("_low"), high.alias("_high"))
    number = F.when(i % 50 != 0, F.round(F.col("value") / F.col("_div"), 4) + F.col("_version"))
    df = df.withColumn("_num", number)
    return df.select(
        i.alias("ResultId"), F.col("user_id").alias("PatientId"), F.floor(i / 3).cast("bigint").alias("OrderId"),
        "TestCode",
        F.round(F.col("value") * 100).cast("bigint").cast("string").alias("ResultValue"),
        F.col("_num").alias("ResultValueNumeric"),
        F.when(i % 40 == 7, F.lit(None)).when(i % 10 == 3, "IU").otherwise(F.col("_unit")).alias("ResultUnit"),
        F.when(i % 60 == 11, F.lit(None)).when(i % 200 == 77, F.col("_high")).otherwise(F.col("_low")).alias("ReferenceRangeMin"),
        F.when(i % 60 == 11, F.lit(None)).when(i % 200 == 77, F.col("_low")).otherwise(F.col("_high")).alias("ReferenceRangeMax"),
        F.when(F.col("_num") > F.col("_high"), "H").when(F.col("_num") < F.col("_low"), "L").alias("AbnormalFlag"),
        F.when(i % 20 == 0, "PRELIM").otherwise("FINAL").alias("ResultStatus"),
        F.col("ts").alias("ResultDate"), (F.col("user_id") % 7).cast("int").alias("PerformingLabId"),
        F.concat(F.lit("T"), (i % 25).cast("string")).alias("TechnicianId"),
        (i * 10 + 1).alias("SpecimenId"),
        F.lit(None).cast("string").alias("Comments"),
        F.col("ts").alias("CreatedDate"),
        (F.col("ts") + F.make_interval(hours=F.col("_version"))).alias("ModifiedDate"),
        F.when(i % 90 == 13, F.lit(None)).otherwise(
            F.element_at(F.array(*map(F.lit, ("Blood", "Serum", "Plasma", "Urine"))), (i % 4 + 1).cast("int"))
        ).alias("SpecimenType"),
        F.when(i % 9 == 0, "Hemolyzed").otherwise("Good").alias("SpecimenQuality"),
        (i * 37 % 600).cast("int").alias("TurnaroundTimeMinutes"),
        (F.col("ts") - F.make_interval(hours=(i * 53 % 60).cast("int"))).alias("CollectedDate"))


def lab(spark: SparkSession, folder: str) -> DataFrame:
    """Silver laboratory results: one row per event."""
    return _lab_columns(read(spark, folder, "events"), F.lit(0))


def bronze_lab(spark: SparkSession, folder: str) -> DataFrame:
    """Raw results: untrimmed lower-case flags, and a later corrected delivery of every tenth row."""
    events = read(spark, folder, "events")
    versions = F.when(F.col("event_id") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = events.withColumn("_v", F.explode(versions))
    df = _lab_columns(rows, F.col("_v"))
    return df.withColumns({
        "AbnormalFlag": F.concat(F.lit(" "), F.lower("AbnormalFlag")),
        "ResultStatus": F.concat(F.lower("ResultStatus"), F.lit("  ")),
    })


def patients(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("c_custkey")
    return read(spark, folder, "customer").select(
        k.alias("PatientId"), F.concat(F.lit("MRN"), k.cast("string")).alias("MRN"),
        F.concat(F.lit("F"), (k % 50).cast("string")).alias("FirstName"),
        F.concat(F.lit("L"), (k % 200).cast("string")).alias("LastName"),
        F.date_add(F.lit("1930-01-01").cast("date"), (k * 97 % 32000).cast("int")).alias("DateOfBirth"),
        F.when(k % 2 == 0, "M").otherwise("F").alias("Gender"),
        F.col("c_mktsegment").alias("Race"), F.col("c_nationkey").cast("string").alias("Ethnicity"),
        F.lit("2023-01-01").cast("date").cast("timestamp_ntz").alias("CreatedDate"),
        F.lit("2023-01-01").cast("date").cast("timestamp_ntz").alias("ModifiedDate"))


def claims(spark: SparkSession, folder: str) -> DataFrame:
    """Billing lines; repeated (order, line) keys collapse to the row with the highest price."""
    line = read(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    # dealt by order first: the lines' choice and the join with orders then need no other shuffle
    line = line.repartition("l_orderkey")
    # the whole row orders the choice, so ties cannot matter
    best = F.max(F.struct("l_extendedprice", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")).alias("x")
    one = line.groupBy("l_orderkey", "l_linenumber").agg(best).select("l_orderkey", "l_linenumber", "x.*")
    orders = read(spark, folder, "orders").select("o_orderkey", "o_custkey")
    j = one.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    code = F.element_at(F.array(*map(F.lit, CODES)), (F.col("l_partkey") % len(CODES) + 1).cast("int"))
    day = F.col("l_shipdate").cast("date")
    return j.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("claim_id"),
        F.lpad(F.col("l_suppkey").cast("string"), 10, "0").alias("provider_npi"),
        F.col("o_custkey").cast("string").alias("beneficiary_id"),
        day.alias("service_date"), F.date_add(day, 5).alias("claim_date"), code.alias("hcpcs_code"),
        (F.floor("l_extendedprice") / 100).alias("billed_amount"),
        (F.floor("l_extendedprice") / 200).alias("paid_amount"),
        F.col("l_quantity").cast("int").alias("units"),
        F.lpad((F.col("o_custkey") % 40).cast("string"), 10, "9").alias("ordering_physician_npi"))


def tasks(spark: SparkSession, folder: str) -> DataFrame:
    """Work-queue tasks."""
    k = F.col("o_orderkey")
    states = F.array(*map(F.lit, ("PENDING", "READY", "PROCESSING", "RETRY_SCHEDULED", "COMPLETED", "COMPLETED",
                                  "COMPLETED", "FAILED", "DEAD_LETTER", "COMPLETED")))
    errors = F.array(*map(F.lit, ("Connection refused by host", "Read timeout", "bad value in column 3",
                                  "schema mismatch")))
    status = F.element_at(states, (k % 10 + 1).cast("int"))
    made = F.col("o_orderdate") + F.make_interval(mins=(k * 7 % 1440).cast("int"))
    df = read(spark, folder, "orders").select(k.alias("k"), status.alias("status"), made.alias("created_at"),
                                              "o_orderpriority", "o_totalprice")
    k = F.col("k")
    retries = k % 7
    error = F.when(retries > 0, F.element_at(errors, (k % 4 + 1).cast("int")))
    return df.select(
        F.concat(F.lit("task-"), k.cast("string")).alias("task_id"),
        F.concat(F.lit("load table_"), (k % 12).cast("string")).alias("task_name"), "status",
        F.least(F.substring("o_orderpriority", 1, 1).cast("int"), F.lit(4)).alias("priority"),
        "created_at",
        (F.col("created_at") + F.make_interval(mins=(k % 300).cast("int"))).alias("updated_at"),
        F.when(F.col("status") == "COMPLETED", F.round(F.col("o_totalprice") / 1000, 3)).alias("execution_time_seconds"),
        F.when(F.col("status") == "PROCESSING", F.col("created_at") + F.make_interval(mins=F.lit(15))).alias("locked_until"),
        F.to_json(F.struct(F.concat(F.lit("table_"), (k % 12).cast("string")).alias("table_name"))).alias("migration_metadata_json"),
        F.to_json(F.struct(
            retries.alias("retry_count"), error.alias("last_error"),
            F.when(F.col("status") == "RETRY_SCHEDULED",
                   F.date_format(F.col("created_at") + F.make_interval(hours=(k % 500).cast("int")), "yyyy-MM-dd HH:mm:ss"))
            .alias("next_retry_at"))).alias("retry_metadata_json"))


def access_log(spark: SparkSession, folder: str) -> DataFrame:
    e = F.col("event_id")
    return read(spark, folder, "events").select(
        e.alias("AuditId"), F.col("ts").alias("AccessTimestamp"),
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("UserId"),
        F.when(F.col("event_type") == "purchase", "UPDATE").otherwise("SELECT").alias("AccessType"),
        F.lit("LabResults").alias("TableName"), (e % 97).cast("string").alias("RecordIdentifier"),
        F.col("event_type").isin("view", "click").alias("PHIAccessed"),
        F.when(e % 3 == 0, "Treatment").otherwise("Operations").alias("AccessReason"),
        (e % 19 != 0).alias("Success"))


def change_log(spark: SparkSession, folder: str) -> DataFrame:
    """Captured changes: 1 delete, 2 insert, 3 before image, 4 after image."""
    k = F.col("o_orderkey")
    return read(spark, folder, "orders").select(
        k.alias("seq"), (k % 4 + 1).cast("int").alias("op"), F.floor(k / 5).cast("bigint").alias("ResultId"),
        F.col("o_custkey").alias("PatientId"), F.round(F.col("o_totalprice"), 2).alias("ResultValueNumeric"),
        F.col("o_orderdate").alias("ModifiedDate"))


def change_target(spark: SparkSession, folder: str) -> DataFrame:
    """The table the changes apply to: every even ResultId at its first logged value."""
    first = change_log(spark, folder).where(F.col("ResultId") % 2 == 0).groupBy("ResultId").agg(
        F.min_by(F.struct("PatientId", "ResultValueNumeric", "ModifiedDate"), "seq").alias("x"))
    return first.select("ResultId", "x.*")


def series(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly indicators: order value in millions by priority. One row per series and calendar month, so
    a series' length is bounded by the calendar however many orders there are."""
    from veriloom.operators.series import dense_index
    month = F.trunc(F.col("o_orderdate").cast("date"), "month")
    monthly = (read(spark, folder, "orders").groupBy(F.col("o_orderpriority").alias("series"), month.alias("date"))
               .agg(F.round(F.sum("o_totalprice") / 1e6, 4).alias("value")))
    return dense_index(monthly)


def segment_series(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly indicators by order status, the second family used for correlations."""
    from veriloom.operators.series import dense_index
    month = F.trunc(F.col("o_orderdate").cast("date"), "month")
    monthly = (read(spark, folder, "orders").groupBy(F.col("o_orderstatus").alias("series"), month.alias("date"))
               .agg(F.round(F.avg("o_totalprice") / 1e4, 4).alias("value")))
    return dense_index(monthly)


def expert_forecasts(spark: SparkSession, folder: str) -> DataFrame:
    """One forecast per (priority, segment, month): priority plays the expert, segment the indicator."""
    orders = read(spark, folder, "orders").select("o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    cust = read(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    month = F.trunc(F.col("o_orderdate").cast("date"), "month")
    g = (orders.join(cust, F.col("o_custkey") == F.col("c_custkey"))
         .groupBy(F.col("o_orderpriority").alias("expert_id"), F.col("c_mktsegment").alias("indicator"), month.alias("target_date"))
         .agg(F.round(F.avg("o_totalprice") / 1e5, 4).alias("point_estimate"),
              F.round(F.stddev_pop("o_totalprice") / 1e5, 4).alias("std"), F.count("*").alias("n")))
    digit = F.substring("expert_id", 1, 1).cast("int")
    level = _by_code(digit, {1: "master", 2: "expert", 3: "intermediate", 4: "novice"}, "expert")
    return g.where("n >= 2").select(
        "expert_id", level.alias("expertise_level"), "indicator", "target_date",
        F.concat_ws("_", "expert_id", "indicator", F.date_format("target_date", "yyyyMMdd")).alias("forecast_id"),
        F.add_months("target_date", -1).alias("forecast_date"), "point_estimate", "std",
        F.round(F.lit(0.8) + digit * 0.05, 2).alias("calibration"))


def outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """Realised value per segment and month: the mean over all orders."""
    orders = read(spark, folder, "orders").select("o_custkey", "o_totalprice", "o_orderdate")
    cust = read(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    month = F.trunc(F.col("o_orderdate").cast("date"), "month")
    return (orders.join(cust, F.col("o_custkey") == F.col("c_custkey"))
            .groupBy(F.col("c_mktsegment").alias("indicator"), month.alias("target_date"))
            .agg(F.round(F.avg("o_totalprice") / 1e5, 4).alias("actual")))


def forecast_actuals(spark: SparkSession, folder: str) -> DataFrame:
    """forecast_id -> actual."""
    made = expert_forecasts(spark, folder).select("forecast_id", "indicator", "target_date")
    return made.join(outcomes(spark, folder), ["indicator", "target_date"]).select("forecast_id", "actual")


def recon_source(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.round("l_extendedprice", 2).alias("l_extendedprice"), "l_quantity", "l_returnflag")


def recon_target(spark: SparkSession, folder: str) -> DataFrame:
    """The source after a faulty copy: rows lost, prices changed, flags blanked, a column renamed."""
    k = F.col("l_orderkey")
    return recon_source(spark, folder).where(k % 1000 != 0).select(
        "l_orderkey", "l_partkey", "l_suppkey", F.col("l_linenumber").alias("line_no"),
        F.when(k % 777 == 0, F.round(F.col("l_extendedprice") + 1, 2)).otherwise(F.col("l_extendedprice")).alias("l_extendedprice"),
        "l_quantity", F.when(k % 501 != 0, F.col("l_returnflag")).alias("l_returnflag"))


def recon_results(spark: SparkSession, folder: str) -> DataFrame:
    """Stored reconciliation results, one per finished task."""
    k = F.col("o_orderkey")
    status = F.when(k % 17 == 0, "FAILED").when(k % 11 == 0, "PARTIAL").otherwise("SUCCESS")
    return read(spark, folder, "orders").where(k % 10 >= 4).select(
        F.concat(F.lit("task-"), k.cast("string")).alias("task_id"), status.alias("status"),
        k.alias("source_row_count"), (k - F.when(k % 17 == 0, 1).otherwise(0)).alias("target_row_count"),
        (F.col("o_orderdate") + F.make_interval(mins=(k * 7 % 1440 + 30).cast("int"))).alias("validated_at"))


def health_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Stored queue snapshots: one per day on which tasks were created."""
    t = tasks(spark, folder)
    day = F.date_trunc("day", F.col("created_at")).cast("timestamp_ntz")
    return t.groupBy(day.alias("timestamp")).agg(
        F.count_if(F.col("status").isin("PENDING", "READY")).alias("pending_tasks"),
        F.count_if(F.col("status") == "COMPLETED").alias("completed_tasks"),
        F.count_if(F.col("status") == "DEAD_LETTER").alias("dead_letter_tasks"))


def validation_log(spark: SparkSession, folder: str) -> DataFrame:
    """Validation executions: one per supplier and month of shipments."""
    month = F.trunc(F.col("l_shipdate").cast("date"), "month").cast("timestamp_ntz")
    g = read(spark, folder, "lineitem").groupBy(
        F.col("l_suppkey"), month.alias("ExecutionTimestamp")).agg(
        F.count("*").alias("TotalRecords"), F.count_if(F.col("l_returnflag") != "R").alias("PassedRecords"))
    return g.select(
        F.concat(F.lit("check_"), F.col("l_suppkey").cast("string")).alias("ValidationName"), "ExecutionTimestamp",
        F.when(F.col("PassedRecords") * 2 >= F.col("TotalRecords"), "PASS").otherwise("FAIL").alias("PassFailStatus"),
        "TotalRecords", "PassedRecords", (F.col("TotalRecords") - F.col("PassedRecords")).alias("FailedRecords"))


def phi_reviews(spark: SparkSession, folder: str) -> DataFrame:
    e = F.col("event_id")
    return read(spark, folder, "events").where(F.col("event_type").isin("view", "click")).select(
        e.alias("MonitoringId"), F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("UserId"),
        F.col("ts").alias("AccessTimestamp"), (e % 6 == 0).alias("AlertGenerated"), (e % 4 == 0).alias("ReviewRequired"),
        F.when(e % 8 == 0, F.col("ts") + F.make_interval(days=F.lit(1))).alias("ReviewedTimestamp"))


def modification_log(spark: SparkSession, folder: str) -> DataFrame:
    e = F.col("event_id")
    return read(spark, folder, "events").where(F.col("event_type") == "purchase").select(
        e.alias("ModificationId"), F.col("ts").alias("ModificationTimestamp"),
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("UserId"),
        F.concat(F.lit("reason "), (e % 5).cast("string")).alias("ReasonForChange"))


def lineage_log(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("o_orderkey")
    return read(spark, folder, "orders").select(
        F.col("o_orderdate").alias("ProcessTimestamp"), k.alias("LineageId"),
        F.concat(F.lit("src_"), (k % 6).cast("string")).alias("SourceTable"),
        F.concat(F.lit("tgt_"), (k % 4).cast("string")).alias("TargetTable"),
        (k % 1000).alias("RecordsProcessed"), (k % 90).cast("int").alias("ProcessDurationSeconds"),
        F.sha2(k.cast("string"), 256).alias("DataHash"))

"""Scans, landing, incremental extraction, merging and conformance."""

from __future__ import annotations

from pyspark.sql import functions as F

from veriloom.catalog import common  # noqa: F401
from veriloom.catalog.registry import frame_sql, query
from veriloom.functions import hashing, parse
from veriloom.operators import conform, dates, marts
from veriloom.session import work_dir
from veriloom.sources import claims as claim_files
from veriloom.sources import files, merge
from veriloom.sources import frames as src

ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
ORDER_COLUMNS = "o_orderkey o_custkey o_orderstatus o_totalprice:r o_orderdate:t o_orderpriority"


def _orders_csv(spark, d, name="orders-csv"):
    path = work_dir(spark, name)
    src.read(spark, d, "orders").write.option("header", True).csv(path)
    return path


@query("csv_scan", ORDER_COLUMNS, "SELECT * FROM orders")
def _(spark, d):
    return files.read_csv(spark, _orders_csv(spark, d), ORDERS)


@query("schema_gate", "column problem", """
SELECT * FROM (VALUES ('o_comment', 'missing'), ('o_orderdate', 'extra'), ('o_orderpriority', 'extra'), ('o_orderstatus', 'extra'), ('o_totalprice', 'extra')) AS t("column", problem)""")
def _(spark, d):
    return files.check_columns(src.read(spark, d, "orders"), ["o_orderkey", "o_custkey", "o_comment"])


@query("source_check", "n_rows:i n_columns:i", "SELECT count(*) AS n_rows, 6 AS n_columns FROM orders")
def _(spark, d):
    return files.source_check(spark, _orders_csv(spark, d), ORDERS)


@query("migrate_table", ORDER_COLUMNS, "SELECT * FROM orders")
def _(spark, d):
    root = work_dir(spark, "lake")
    files.migrate(spark, _orders_csv(spark, d), root, f"{root}/_snapshots", "orders", ["o_orderstatus"], ORDERS, ORDERS_NAMES)
    return files.current_snapshot(spark, f"{root}/_snapshots", "orders")


ORDERS_NAMES = [f.split()[0] for f in ORDERS.split(", ")]


@query("batch_migrate", "task_id success status", "SELECT * FROM (VALUES ('t1', TRUE, 'COMPLETED'), ('t2', FALSE, 'FAILED'), ('t3', TRUE, 'COMPLETED')) AS t(task_id, success, status)")
def _(spark, d):
    root = work_dir(spark, "lake")
    tables = [("t1", _orders_csv(spark, d), "orders"), ("t2", f"{root}/absent", "absent")]
    path = work_dir(spark, "cust")
    src.read(spark, d, "customer").write.option("header", True).csv(path)
    tasks = spark.createDataFrame([*tables, ("t3", path, "customer")], "task_id string, source_path string, table string")
    return files.migrate_many(spark, tasks, root, f"{root}/_snapshots")


@query("bronze_scan", "event_id user_id event_type value:r", "SELECT * FROM events")
def _(spark, d):
    return files.read_parquet(spark, f"{d}/events.parquet")


@query("silver_scan", "c_custkey c_name c_mktsegment", "SELECT * FROM customer")
def _(spark, d):
    root = work_dir(spark, "silver")
    files.write_snapshot(src.read(spark, d, "nation"), root, f"{root}/_snapshots", "customer")
    files.write_snapshot(src.read(spark, d, "customer"), root, f"{root}/_snapshots", "customer")
    return files.current_snapshot(spark, f"{root}/_snapshots", "customer")


@query("bronze_layout_sink", "year:i month:i day:i n:i", """
SELECT year(ts) AS year, month(ts) AS month, day(ts) AS day, count(*) AS n FROM events GROUP BY ALL""")
def _(spark, d):
    root, df = work_dir(spark, "bronze"), src.read(spark, d, "events")
    early, late = df.where("event_id % 2 = 0"), df.where("event_id % 2 = 1")  # two loads of the same days, one of them run twice
    for load, part in (("l1", early), ("l2", late), ("l1", early)):
        path = files.land_bronze(part, root, "events", F.col("ts"), load)
    return spark.read.parquet(path).groupBy("year", "month", "day").agg(F.count("*").alias("n"))


@query("append_partitioned", "MetricDate:d n:i", "SELECT CAST(ts AS DATE) AS MetricDate, count(*) AS n FROM events GROUP BY 1")
def _(spark, d):
    df = src.read(spark, d, "events").withColumn("MetricDate", F.to_date("ts"))
    root = work_dir(spark, "gold")
    early, late = df.where("event_id % 3 = 0"), df.where("event_id % 3 > 0")
    for load, part in (("l1", early), ("l2", late), ("l2", late)):
        files.append_partitioned(part, root, "MetricDate", load)
    return spark.read.parquet(root).groupBy("MetricDate").agg(F.count("*").alias("n"))


@query("watermark_extract", "o_orderkey o_orderdate:t", "SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1999-06-30' AND o_orderdate <= TIMESTAMP '2000-06-30'")
def _(spark, d):
    import datetime as dt
    return merge.extract_incremental(src.read(spark, d, "orders"), "o_orderdate", dt.datetime(1999, 6, 30), dt.datetime(2000, 6, 30))[0]


def _watermarks(spark, d):
    """Control rows per source table name: the last load time and rows seen so far."""
    return (src.lineage_log(spark, d).where("ProcessTimestamp < timestamp'1999-01-01'").groupBy(F.col("SourceTable").alias("TableName"))
            .agg(F.max("ProcessTimestamp").alias("WatermarkValue"), F.max("ProcessTimestamp").alias("LastProcessedDate"),
                 F.count("*").alias("ProcessedRowCount")))


frame_sql("watermarks", """
SELECT SourceTable AS TableName, max(ProcessTimestamp) AS WatermarkValue, max(ProcessTimestamp) AS LastProcessedDate, count(*) AS ProcessedRowCount
FROM lineage_log WHERE ProcessTimestamp < TIMESTAMP '1999-01-01' GROUP BY 1""")


@query("watermark_upsert", "TableName WatermarkValue:t ProcessedRowCount:i", """
SELECT coalesce(w.TableName, u.TableName) AS TableName, coalesce(u.v, w.WatermarkValue) AS WatermarkValue, coalesce(ProcessedRowCount, 0) AS ProcessedRowCount
FROM watermarks w FULL JOIN (SELECT TargetTable AS TableName, max(ProcessTimestamp) AS v FROM lineage_log GROUP BY 1
  UNION ALL SELECT SourceTable, max(ProcessTimestamp) FROM lineage_log WHERE SourceTable <> 'src_2' GROUP BY 1) u USING (TableName)""")
def _(spark, d):
    log = src.lineage_log(spark, d)
    top = F.max("ProcessTimestamp")
    new = log.groupBy(F.col("TargetTable").alias("TableName")).agg(top.alias("WatermarkValue"), top.alias("LastProcessedDate"))
    again = (log.where("SourceTable <> 'src_2'").groupBy(F.col("SourceTable").alias("TableName"))
             .agg(top.alias("WatermarkValue"), top.alias("LastProcessedDate")))
    return merge.set_watermarks(_watermarks(spark, d), new.unionByName(again))


def _runs(spark, d):
    return src.lineage_log(spark, d).where("ProcessTimestamp >= timestamp'1999-01-01'").select(
        F.lit("incremental").alias("PipelineName"), F.col("LineageId").cast("string").alias("RunId"),
        F.col("SourceTable").alias("TableName"), F.col("RecordsProcessed").alias("RowsCopied"),
        F.col("ProcessDurationSeconds").alias("ExecutionDurationSeconds"), F.col("ProcessTimestamp").alias("EndTime"))


@query("pipeline_run_log", "RunId TableName Status RowsCopied:i StartTime:t EndTime:t", """
SELECT CAST(LineageId AS VARCHAR) AS RunId, SourceTable AS TableName, 'Success' AS Status, RecordsProcessed AS RowsCopied,
 ProcessTimestamp - to_seconds(ProcessDurationSeconds) AS StartTime, ProcessTimestamp AS EndTime FROM lineage_log WHERE ProcessTimestamp >= TIMESTAMP '1999-01-01'""")
def _(spark, d):
    return merge.log_runs(_runs(spark, d))


@query("processed_rows", "TableName ProcessedRowCount:i", """
SELECT TableName, ProcessedRowCount + coalesce(r, 0) AS ProcessedRowCount FROM watermarks LEFT JOIN (SELECT SourceTable AS TableName, sum(RecordsProcessed) AS r
 FROM lineage_log WHERE ProcessTimestamp >= TIMESTAMP '1999-01-01' GROUP BY 1) USING (TableName)""")
def _(spark, d):
    return merge.add_processed_rows(_watermarks(spark, d), _runs(spark, d))


def _silver_old(spark, d):
    """The silver table before today's load: patients with key below 1000 or even, a third with another name."""
    p = src.patients(spark, d).select("PatientId", "MRN", "FirstName", "Gender")
    k = F.col("PatientId")
    old = p.where((k < 1000) | (k % 2 == 0)).withColumn("FirstName", F.when(k % 3 == 0, "OLD").otherwise(F.col("FirstName")))
    return old.withColumn("_row_hash", hashing.row_hash(old))


def _silver_new(spark, d):
    p = src.patients(spark, d).select("PatientId", "MRN", "FirstName", "Gender").where("PatientId % 7 <> 0")
    return p.withColumn("_row_hash", hashing.row_hash(p))


@query("upsert_hash_merge", "PatientId MRN FirstName Gender _row_hash", """
SELECT PatientId, MRN, FirstName, Gender, md5(PatientId || '||' || MRN || '||' || FirstName || '||' || Gender) AS _row_hash FROM (
 SELECT PatientId, MRN, Gender, CASE WHEN PatientId % 7 = 0 AND PatientId % 3 = 0 THEN 'OLD' ELSE FirstName END AS FirstName
 FROM patients WHERE PatientId % 7 <> 0 OR PatientId < 1000 OR PatientId % 2 = 0)""")
def _(spark, d):
    return merge.upsert(_silver_old(spark, d), _silver_new(spark, d), ["PatientId"])


@query("upsert_bucketed", "PatientId MRN FirstName Gender _row_hash", """
SELECT PatientId, MRN, FirstName, Gender, md5(PatientId || '||' || MRN || '||' || FirstName || '||' || Gender) AS _row_hash FROM (
 SELECT PatientId, MRN, Gender, CASE WHEN PatientId % 7 = 0 AND PatientId % 3 = 0 THEN 'OLD' ELSE FirstName END AS FirstName
 FROM patients WHERE PatientId % 7 <> 0 OR PatientId < 1000 OR PatientId % 2 = 0)""")
def _(spark, d):
    path = merge.write_bucketed(_silver_old(spark, d), work_dir(spark, "silver"), ["PatientId"], 16)
    merge.merge_bucketed(spark, path, _silver_new(spark, d), ["PatientId"], lambda old, new: merge.upsert(old, new, ["PatientId"]), 16)
    return merge.read_bucketed(spark, path)


@query("cdc_apply_bucketed", "ResultId PatientId ResultValueNumeric:r ModifiedDate:t", """
WITH net AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ResultId ORDER BY seq DESC) AS r FROM change_log WHERE op <> 3) WHERE r = 1)
SELECT ResultId, PatientId, ResultValueNumeric, ModifiedDate FROM net WHERE op <> 1
UNION ALL SELECT t.* FROM change_target t WHERE ResultId NOT IN (SELECT ResultId FROM net)""")
def _(spark, d):
    path = merge.write_bucketed(src.change_target(spark, d), work_dir(spark, "cdc"), ["ResultId"], 16)
    merge.merge_bucketed(spark, path, src.change_log(spark, d), ["ResultId"], lambda target, log: merge.apply_changes(target, log, ["ResultId"]), 16)
    return merge.read_bucketed(spark, path)


@query("cdc_decode", "seq op:i OperationType ResultId", """
SELECT *, CASE op WHEN 2 THEN 'Insert' ELSE 'Update (After)' END AS OperationType FROM change_log WHERE op IN (2, 4)""")
def _(spark, d):
    return merge.decode_changes(src.change_log(spark, d))


@query("cdc_net_changes", "ResultId seq op:i OperationType ResultValueNumeric:r", """
SELECT *, CASE op WHEN 1 THEN 'Delete' WHEN 2 THEN 'Insert' ELSE 'Update' END AS OperationType FROM (
 SELECT *, row_number() OVER (PARTITION BY ResultId ORDER BY seq DESC) AS r FROM change_log WHERE op <> 3 AND seq >= 102) WHERE r = 1""")
def _(spark, d):
    return merge.net_changes(src.change_log(spark, d), ["ResultId"], 102, None)


@query("cdc_apply", "ResultId PatientId ResultValueNumeric:r ModifiedDate:t", """
WITH net AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ResultId ORDER BY seq DESC) AS r FROM change_log WHERE op <> 3) WHERE r = 1)
SELECT ResultId, PatientId, ResultValueNumeric, ModifiedDate FROM net WHERE op <> 1
UNION ALL SELECT t.* FROM change_target t WHERE ResultId NOT IN (SELECT ResultId FROM net)""")
def _(spark, d):
    return merge.apply_changes(src.change_target(spark, d), src.change_log(spark, d), ["ResultId"])


@query("cdc_vs_watermark_check", "ResultId only_in", """
WITH a AS (SELECT DISTINCT ResultId FROM change_log WHERE op IN (2, 4) AND ModifiedDate > TIMESTAMP '1999-01-01'), b AS (SELECT DISTINCT ResultId FROM change_log WHERE ModifiedDate > TIMESTAMP '1999-07-01')
SELECT coalesce(a.ResultId, b.ResultId) AS ResultId, CASE WHEN a.ResultId IS NULL THEN 'watermark' ELSE 'cdc' END AS only_in
FROM a FULL JOIN b ON a.ResultId = b.ResultId WHERE a.ResultId IS NULL OR b.ResultId IS NULL""")
def _(spark, d):
    log = src.change_log(spark, d)
    return merge.extraction_differences(
        log.where("op IN (2, 4) AND ModifiedDate > timestamp'1999-01-01'"), log.where("ModifiedDate > timestamp'1999-07-01'"), ["ResultId"])


@query("scd2_apply", "PatientId Race EffectiveDate:t EndDate:t IsCurrent", "SELECT * FROM patient_versions")
def _(spark, d):
    return common.patient_versions(spark, d)


def _claims_csv(spark, d):
    """Claims under CMS headers, with money as '$1,234.5' text, some bad numbers and some bad dates."""
    c = src.claims(spark, d)
    k = F.length("claim_id") + F.col("units")
    path = work_dir(spark, "claims-csv")
    c.select(
        F.col("claim_id").alias("CLM_ID"), F.col("provider_npi").alias("PRVDR_NPI"), F.col("beneficiary_id").alias("BENE_ID"),
        F.when(k % 19 == 0, "not a day").otherwise(F.col("service_date").cast("string")).alias("CLM_FROM_DT"),
        F.col("hcpcs_code").alias("HCPCS_CD"),
        F.when(k % 23 == 0, "n/a").when(k % 29 == 0, "").otherwise(F.concat(F.lit("$"), F.format_number("billed_amount", 2))).alias("CLM_TOT_CHRG_AMT"),
        F.when(k % 31 == 0, "x").otherwise(F.concat(F.col("units").cast("string"), F.lit(".0"))).alias("LINE_SRVC_CNT"),
    ).write.option("header", True).csv(path)
    return path


@query("claims_csv_scan", "claim_id provider_npi beneficiary_id service_date:d hcpcs_code billed_amount:r2 units:i", """
SELECT claim_id, provider_npi, beneficiary_id, CASE WHEN (length(claim_id) + units) % 19 <> 0 THEN service_date END AS service_date, hcpcs_code,
 CASE WHEN (length(claim_id) + units) % 23 = 0 THEN 0 WHEN (length(claim_id) + units) % 29 = 0 THEN NULL ELSE billed_amount END AS billed_amount,
 CASE WHEN (length(claim_id) + units) % 31 = 0 THEN 1 ELSE units END AS units FROM claims""")
def _(spark, d):
    return claim_files.read_claims_csv(spark, _claims_csv(spark, d))


@query("claims_json_scan", "claim_id provider_npi service_date:d billed_amount:r2 units:i", "SELECT * FROM claims")
def _(spark, d):
    path = work_dir(spark, "claims-json")
    claim_files.write_claims(src.claims(spark, d), path, "json")
    return claim_files.read_claims_json(spark, path, multiline=False)


@query("claims_json_array", "claim_id provider_npi service_date:d billed_amount:r2 units:i", "SELECT * FROM claims")
def _(spark, d):
    """Documents that are arrays of claims of a provider."""
    path = work_dir(spark, "claims-arrays")
    held = claim_files.documents(src.claims(spark, d), F.col("provider_npi"))
    claim_files.write_texts(held.select(F.to_json("claims").alias("value")), path, src.read(spark, d, "lineitem").count())
    return claim_files.read_claims_json(spark, path)


@query("claims_json_object", "claim_id provider_npi service_date:d billed_amount:r2 units:i", "SELECT * FROM claims")
def _(spark, d):
    """Documents that hold their claims under ``claims``, pretty-printed over many lines."""
    path = work_dir(spark, "claims-objects")
    held = claim_files.documents(src.claims(spark, d), F.substring("provider_npi", -1, 1))
    claim_files.write_texts(held.select(F.to_json(F.struct("claims"), {"pretty": "true"}).alias("value")), path, src.read(spark, d, "lineitem").count(), 1)
    return claim_files.read_claims_json(spark, path, multiline=True)


@query("claims_json_document", "claim_id provider_npi service_date:d billed_amount:r2 units:i", "SELECT * FROM claims")
def _(spark, d):
    """Documents of up to 100 000 claims, each read by many tasks."""
    return claim_files.read_claims_documents(spark, claim_files.write_documents(src.claims(spark, d), work_dir(spark, "claims-documents")))


@query("providers_csv_scan", "npi legal_business_name state", """
SELECT lpad(CAST(s_suppkey AS VARCHAR), CASE WHEN s_suppkey % 13 = 0 THEN 9 ELSE 10 END, '0') AS npi, s_name AS legal_business_name, 'S' || s_nationkey AS state
FROM supplier WHERE s_suppkey % 13 <> 0""")
def _(spark, d):
    path = work_dir(spark, "providers-csv")
    k = F.col("s_suppkey")
    npi = F.when(k % 13 == 0, F.lpad(k.cast("string"), 9, "0")).otherwise(F.lpad(k.cast("string"), 10, "0"))
    rows = src.read(spark, d, "supplier").select(
        npi.alias("NPI"), F.explode(F.array(F.lit("superseded"), F.col("s_name"))).alias("PRVDR_LGL_NM"),
        F.concat(F.lit("S"), F.col("s_nationkey").cast("string")).alias("PRVDR_STATE"))
    rows.write.option("header", True).csv(path)
    return claim_files.read_providers_csv(spark, path)


@query("claims_sink", "claim_id provider_npi service_date:d billed_amount:r2 flags", """
SELECT *, '["a","' || hcpcs_code || '"]' AS flags FROM claims""")
def _(spark, d):
    path = work_dir(spark, "claims-out")
    claim_files.write_claims(src.claims(spark, d).withColumn("flags", F.array(F.lit("a"), F.col("hcpcs_code"))), path)
    return spark.read.option("header", True).option("escape", "\\").csv(path)


@query("conform_schema", "ResultId PatientId TestCode ResultValueNumeric:r PerformingLabId:i SpecimenId:i Comments", """
SELECT *, CAST(NULL AS BIGINT) AS SpecimenId FROM (SELECT * EXCLUDE (SpecimenId) FROM lab)""")
def _(spark, d):
    raw = src.lab(spark, d).drop("SpecimenId").withColumn("PerformingLabId", F.col("PerformingLabId").cast("string"))
    return conform.conform(raw, conform.SCHEMAS["LabResults"])


@query("standardize_strings", "ResultId AbnormalFlag ResultStatus ModifiedDate:t", """
SELECT *  REPLACE (upper(trim(AbnormalFlag)) AS AbnormalFlag, upper(trim(ResultStatus)) AS ResultStatus) FROM bronze_lab""")
def _(spark, d):
    return conform.standardize(src.bronze_lab(spark, d), conform.UPPER_COLUMNS["LabResults"])


@query("technical_columns", "event_id _load_date _load_timestamp:t _source_file _row_hash", f"""
SELECT event_id, '2024-01-31' AS _load_date, CAST('{src.AS_OF}' AS TIMESTAMP) AS _load_timestamp, 'events.parquet' AS _source_file,
 md5(event_id || '||' || user_id || '||' || event_type) AS _row_hash FROM events""")
def _(spark, d):
    """Of the source file the part that doesn't depend on the run."""
    df = src.read(spark, d, "events").select("event_id", "user_id", "event_type")
    loaded = conform.with_technical_columns(df, "2024-01-31", F.lit(src.AS_OF).cast("timestamp"))
    return loaded.withColumn("_source_file", F.regexp_extract("_source_file", r"/(events\.parquet)", 1))


HASHED = ["ResultId", "PatientId", "TestCode", "ResultUnit", "ResultStatus", "SpecimenType"]


@query("row_hash", "ResultId _row_hash", """
SELECT ResultId, md5(concat(ResultId, '||', PatientId, '||', TestCode, '||', coalesce(ResultUnit, ''), '||', ResultStatus, '||', coalesce(SpecimenType, ''))) AS _row_hash FROM lab""")
def _(spark, d):
    df = src.lab(spark, d).select(*HASHED)
    return df.withColumn("_row_hash", hashing.row_hash(df))


@query("dedupe_latest", "ResultId AbnormalFlag ResultStatus ResultValueNumeric:r ModifiedDate:t", """
SELECT * REPLACE (upper(trim(AbnormalFlag)) AS AbnormalFlag, upper(trim(ResultStatus)) AS ResultStatus)
FROM (SELECT *, row_number() OVER (PARTITION BY ResultId ORDER BY ModifiedDate DESC) AS r FROM bronze_lab) WHERE r = 1""")
def _(spark, d):
    return conform.bronze_to_silver(src.bronze_lab(spark, d), "LabResults", "2024-01-31", F.lit(src.AS_OF).cast("timestamp"))


@query("duplicate_counts", "l_orderkey l_linenumber:i n_rows:i duplicates:i", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows, count(*) - 1 AS duplicates FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def _(spark, d):
    return conform.duplicate_counts(src.read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("load_quality_checks", "check_name value:i", """
SELECT unnest(['record_count', 'ResultId_null_count', 'ResultUnit_null_count', 'negative_ResultValueNumeric', 'inverted_ReferenceRangeMin_ReferenceRangeMax']) AS check_name,
 unnest([count(*), count(*) FILTER (ResultId IS NULL), count(*) FILTER (ResultUnit IS NULL), count(*) FILTER (ResultValueNumeric < 0),
  count(*) FILTER (ReferenceRangeMin > ReferenceRangeMax)]) AS value FROM lab""")
def _(spark, d):
    return conform.load_checks(src.lab(spark, d), ["ResultId", "ResultUnit"], ["ResultValueNumeric"], [("ReferenceRangeMin", "ReferenceRangeMax")])


@query("phi_mask", "PatientId MRN FirstName DateOfBirth Gender", """
SELECT sha256(CAST(PatientId AS VARCHAR)) AS PatientId, sha256(MRN) AS MRN, sha256(FirstName) AS FirstName, sha256(CAST(DateOfBirth AS VARCHAR)) AS DateOfBirth, Gender FROM patients""")
def _(spark, d):
    return hashing.mask_phi(src.patients(spark, d))


def _money_text(spark, d):
    k = F.col("o_orderkey")
    text = (F.when(k % 11 == 0, "abc").when(k % 13 == 0, "  ").when(k % 17 == 0, "1e3")
            .otherwise(F.concat(F.lit("$"), F.format_number("o_totalprice", 2))))
    return src.read(spark, d, "orders").select(k, "o_totalprice", text.alias("text"))


@query("parse_money", "o_orderkey amount:r2", """
SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 0 WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN 1000 ELSE o_totalprice END AS amount FROM orders""")
def _(spark, d):
    return _money_text(spark, d).withColumn("amount", parse.parse_money(F.col("text")))


@query("parse_units", "o_orderkey units:i", """
SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 1 WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(trunc(o_orderkey / 4) AS BIGINT) END AS units FROM orders""")
def _(spark, d):
    k = F.col("o_orderkey")
    text = F.when(k % 11 == 0, "abc").when(k % 13 == 0, "  ").otherwise((k / 4).cast("decimal(18,2)").cast("string"))
    return src.read(spark, d, "orders").select(k, parse.parse_units(text).alias("units"))


@query("parse_date", "o_orderkey day:d", """
SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0 THEN CAST(o_orderdate AS DATE) END AS day FROM orders""")
def _(spark, d):
    k = F.col("o_orderkey")
    text = (F.when(k % 11 == 0, "2020-02-31").when(k % 13 == 0, F.date_format("o_orderdate", "dd/MM/yyyy"))
            .otherwise(F.date_format("o_orderdate", "yyyy-M-d")))
    return src.read(spark, d, "orders").select(k, parse.parse_date(text).alias("day"))


@query("safe_divide", "event_id ratio:r", "SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 0 ELSE value / (event_id % 5) END AS ratio FROM events")
def _(spark, d):
    return src.read(spark, d, "events").select("event_id", parse.safe_ratio(F.col("value"), F.col("event_id") % 5).alias("ratio"))


@query("date_spine", "date:d", """
SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS date FROM orders""")
def _(spark, d):
    return dates.spine_over(src.read(spark, d, "orders"), "o_orderdate")


@query("date_spine_quarter", "date:d", """
SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 3 MONTH)) AS DATE) AS date FROM orders""")
def _(spark, d):
    return dates.spine_over(src.read(spark, d, "orders"), "o_orderdate", "quarter")


@query("date_dimension", "DateKey:i Date:d Year:i Quarter:i Month:i MonthName Week:i DayOfYear:i DayOfMonth:i DayOfWeek:i DayName IsWeekend FiscalYear:i FiscalQuarter:i FiscalMonth:i", """
SELECT CAST(strftime(x, '%Y%m%d') AS INT) AS DateKey, CAST(x AS DATE) AS Date, year(x) AS Year, quarter(x) AS Quarter, month(x) AS Month, monthname(x) AS MonthName,
 (dayofyear(x) + dayofweek(date_trunc('year', x)) - 1) // 7 + 1 AS Week, dayofyear(x) AS DayOfYear, day(x) AS DayOfMonth, dayofweek(x) + 1 AS DayOfWeek, dayname(x) AS DayName,
 dayofweek(x) IN (0, 6) AS IsWeekend, year(x) + CASE WHEN month(x) >= 7 THEN 1 ELSE 0 END AS FiscalYear,
 CASE WHEN month(x) BETWEEN 7 AND 9 THEN 1 WHEN month(x) >= 10 THEN 2 WHEN month(x) <= 3 THEN 3 ELSE 4 END AS FiscalQuarter, (month(x) + 5) % 12 + 1 AS FiscalMonth
FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS x FROM orders)""")
def _(spark, d):
    return dates.date_dimension(dates.spine_over(src.read(spark, d, "orders"), "o_orderdate"))


@query("date_anti_fill", "date:d", """
SELECT CAST(x AS DATE) AS date FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS x FROM orders)
WHERE x NOT IN (SELECT o_orderdate FROM orders WHERE o_orderkey % 3 = 0)""")
def _(spark, d):
    orders = src.read(spark, d, "orders")
    have = orders.where("o_orderkey % 3 = 0").select(F.to_date("o_orderdate").alias("Date")).distinct()
    return dates.new_dates(have, dates.spine_over(orders, "o_orderdate"))


@query("time_dimension", "TimeKey:i Hour:i Minute:i HourBucket IsBusinessHours Shift", """
SELECT k AS TimeKey, k // 60 AS Hour, k % 60 AS Minute, printf('%02d:00-%02d:00', k // 60, k // 60 + 1) AS HourBucket, k // 60 BETWEEN 8 AND 16 AS IsBusinessHours,
 CASE WHEN k // 60 BETWEEN 7 AND 14 THEN 'Morning' WHEN k // 60 BETWEEN 15 AND 22 THEN 'Afternoon' ELSE 'Night' END AS Shift
FROM (SELECT DISTINCT hour(ts) * 60 + minute(ts) AS k FROM events)""")
def _(spark, d):
    keys = src.read(spark, d, "events").select(dates.time_key(F.col("ts")).alias("TimeKey")).distinct()
    return dates.time_dimension(keys)


@query("dim_patient_age", "PatientId Age:i AgeGroup", """
SELECT PatientId, 2024 - year(DateOfBirth) AS Age, CASE WHEN 2024 - year(DateOfBirth) < 18 THEN 'Pediatric' WHEN 2024 - year(DateOfBirth) <= 64 THEN 'Adult' ELSE 'Senior' END AS AgeGroup FROM patients""")
def _(spark, d):
    return marts.with_age(src.patients(spark, d), "2024-01-31")

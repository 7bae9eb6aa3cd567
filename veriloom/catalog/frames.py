"""SQL twins of the domain frames and rule tables, written independently for the oracle."""

from __future__ import annotations

from veriloom.catalog.registry import frame_sql
from veriloom.operators import rules
from veriloom.sources.frames import AS_OF, CODES, QUEUE_AS_OF


def literal(x) -> str:
    if x is None:
        return "NULL"
    if isinstance(x, bool):
        return "TRUE" if x else "FALSE"
    if isinstance(x, str):
        return "'" + x.replace("'", "''") + "'"
    if isinstance(x, (list, tuple)):
        return "[" + ", ".join(literal(v) for v in x) + "]"
    if isinstance(x, float):
        return f"CAST({x!r} AS DOUBLE)"
    return repr(x)


def values(rows, cols: str) -> str:
    body = ", ".join("(" + ", ".join(literal(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS v({cols})"


frame_sql("x_ranges", values([(t, g, *(None if x is None else float(x) for x in (a, b, c, d)), f"{a}-{b}") for t, g, a, b, c, d in rules.REFERENCE_RANGES], "TestCode, RangeGroup, RuleMin, RuleMax, CriticalLow, CriticalHigh, RangeText"))
frame_sql("x_labrules", values([(t, float(a), float(b), float(c), h, u, s, k, f"{a}-{b}", str(c)) for t, a, b, c, h, u, s, k in rules.LAB_RULES], "TestCode, PhysMin, PhysMax, MaxDelta, DeltaHours, Units, Specimens, TimeSensitive, PhysText, DeltaText"))
frame_sql("x_specrules", values(rules.SPECIMEN_RULES, "SpecimenType, MaxAgeHours, ValidTests"))
frame_sql("x_pairs", values(rules.CORRELATION_PAIRS, "Test1, Test2, Expected"))
frame_sql("x_tests", values(rules.TEST_CATALOGUE, "TestCode, TestName, LoincCode, TestCategory, CategoryLevel2, CategoryLevel3, SpecimenRequired, ResultType, TargetMinutes"))
frame_sql("x_equipment", values([(c, k) for k, cs in rules.EQUIPMENT_CATEGORIES.items() for c in cs], "hcpcs_code, category"))
frame_sql("x_tiers", values(list(rules.WHEELCHAIR_TIERS.items()), "hcpcs_code, tier"))


def _lab(source: str, version: str) -> str:
    return f"""
SELECT event_id AS ResultId, user_id AS PatientId, event_id // 3 AS OrderId, TestCode,
  CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS ResultValue, num AS ResultValueNumeric,
  CASE WHEN event_id % 40 = 7 THEN NULL WHEN event_id % 10 = 3 THEN 'IU' ELSE unit END AS ResultUnit,
  CASE WHEN event_id % 60 = 11 THEN NULL WHEN event_id % 200 = 77 THEN high ELSE low END AS ReferenceRangeMin,
  CASE WHEN event_id % 60 = 11 THEN NULL WHEN event_id % 200 = 77 THEN low ELSE high END AS ReferenceRangeMax,
  CASE WHEN num > high THEN 'H' WHEN num < low THEN 'L' END AS AbnormalFlag,
  CASE WHEN event_id % 20 = 0 THEN 'PRELIM' ELSE 'FINAL' END AS ResultStatus,
  ts AS ResultDate, CAST(user_id % 7 AS INTEGER) AS PerformingLabId, 'T' || (event_id % 25) AS TechnicianId,
  event_id * 10 + 1 AS SpecimenId, CAST(NULL AS VARCHAR) AS Comments, ts AS CreatedDate,
  ts + to_hours({version}) AS ModifiedDate,
  CASE WHEN event_id % 90 = 13 THEN NULL ELSE ['Blood','Serum','Plasma','Urine'][event_id % 4 + 1] END AS SpecimenType,
  CASE WHEN event_id % 9 = 0 THEN 'Hemolyzed' ELSE 'Good' END AS SpecimenQuality,
  CAST(event_id * 37 % 600 AS INTEGER) AS TurnaroundTimeMinutes,
  ts - to_hours(CAST(event_id * 53 % 60 AS INTEGER)) AS CollectedDate
FROM (
 SELECT *, CASE WHEN event_id % 50 <> 0 THEN round(value / CASE TestCode WHEN 'HBA1C' THEN 10 WHEN 'POTASSIUM' THEN 12
     WHEN 'CREATININE' THEN 50 WHEN 'WBC' THEN 5 WHEN 'HEMOGLOBIN' THEN 4 ELSE 1 END, 4) + {version} END AS num,
   CASE TestCode WHEN 'GLUCOSE' THEN 'mg/dL' WHEN 'HBA1C' THEN '%' WHEN 'CREATININE' THEN 'mg/dL' WHEN 'WBC' THEN 'K/uL'
     WHEN 'HEMOGLOBIN' THEN 'g/dL' WHEN 'POTASSIUM' THEN 'mEq/L' WHEN 'TROPONIN' THEN 'ng/L' ELSE 'U/L' END AS unit,
   CAST(CASE TestCode WHEN 'GLUCOSE' THEN 70 WHEN 'HBA1C' THEN 4 WHEN 'CREATININE' THEN 0.59 WHEN 'WBC' THEN 4.5
     WHEN 'HEMOGLOBIN' THEN 12 WHEN 'POTASSIUM' THEN 3.5 WHEN 'TROPONIN' THEN 0 ELSE 140 END AS DOUBLE) AS low,
   CAST(CASE TestCode WHEN 'GLUCOSE' THEN 100 WHEN 'HBA1C' THEN 5.6 WHEN 'CREATININE' THEN 1.35 WHEN 'WBC' THEN 11
     WHEN 'HEMOGLOBIN' THEN 17.5 WHEN 'POTASSIUM' THEN 5.1 WHEN 'TROPONIN' THEN 14 ELSE 280 END AS DOUBLE) AS high
 FROM (
  SELECT *, CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 4 = 1 THEN 'POTASSIUM' ELSE 'HBA1C' END
    WHEN event_type = 'signup' THEN CASE WHEN event_id % 5 = 2 THEN 'TROPONIN' ELSE 'WBC' END
    WHEN event_type = 'view' THEN CASE WHEN event_id % 11 = 5 THEN 'LDH' ELSE 'HEMOGLOBIN' END
    WHEN event_type = 'click' THEN 'GLUCOSE' ELSE 'CREATININE' END AS TestCode
  FROM {source}))"""


frame_sql("lab", _lab("events", "0"))
frame_sql("bronze_lab", "SELECT * REPLACE (' ' || lower(AbnormalFlag) AS AbnormalFlag, lower(ResultStatus) || '  ' AS ResultStatus) FROM ("
          + _lab("(SELECT *, unnest(CASE WHEN event_id % 10 = 0 THEN [0, 1] ELSE [0] END) AS ver FROM events)", "ver") + ")")
frame_sql("patients", """
SELECT c_custkey AS PatientId, 'MRN' || c_custkey AS MRN, 'F' || (c_custkey % 50) AS FirstName, 'L' || (c_custkey % 200) AS LastName,
  DATE '1930-01-01' + CAST(c_custkey * 97 % 32000 AS INTEGER) AS DateOfBirth, CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS Gender,
  c_mktsegment AS Race, CAST(c_nationkey AS VARCHAR) AS Ethnicity,
  TIMESTAMP '2023-01-01' AS CreatedDate, TIMESTAMP '2023-01-01' AS ModifiedDate FROM customer""")
frame_sql("claims", f"""
SELECT l_orderkey || '-' || l_linenumber AS claim_id, lpad(CAST(l_suppkey AS VARCHAR), 10, '0') AS provider_npi,
  CAST(o_custkey AS VARCHAR) AS beneficiary_id, CAST(l_shipdate AS DATE) AS service_date, CAST(l_shipdate AS DATE) + 5 AS claim_date,
  {literal(CODES)}[l_partkey % {len(CODES)} + 1] AS hcpcs_code,
  floor(l_extendedprice) / 100 AS billed_amount, floor(l_extendedprice) / 200 AS paid_amount,
  CAST(l_quantity AS INTEGER) AS units, lpad(CAST(o_custkey % 40 AS VARCHAR), 10, '9') AS ordering_physician_npi
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_extendedprice DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_shipdate DESC) AS pick FROM lineitem)
JOIN orders ON l_orderkey = o_orderkey WHERE pick = 1""")
frame_sql("tasks", """
SELECT 'task-' || k AS task_id, 'load table_' || (k % 12) AS task_name, status,
  least(CAST(substr(o_orderpriority, 1, 1) AS INTEGER), 4) AS priority, created_at,
  created_at + to_minutes(CAST(k % 300 AS INTEGER)) AS updated_at,
  CASE WHEN status = 'COMPLETED' THEN round(o_totalprice / 1000, 3) END AS execution_time_seconds,
  CASE WHEN status = 'PROCESSING' THEN created_at + INTERVAL 15 MINUTE END AS locked_until,
  'table_' || (k % 12) AS table_name, k % 7 AS retry_count,
  CASE WHEN k % 7 > 0 THEN ['Connection refused by host','Read timeout','bad value in column 3','schema mismatch'][k % 4 + 1] END AS last_error,
  CASE WHEN status = 'RETRY_SCHEDULED' THEN created_at + to_hours(CAST(k % 500 AS INTEGER)) END AS next_retry_at
FROM (SELECT o_orderkey AS k, o_orderpriority, o_totalprice,
   ['PENDING','READY','PROCESSING','RETRY_SCHEDULED','COMPLETED','COMPLETED','COMPLETED','FAILED','DEAD_LETTER','COMPLETED'][o_orderkey % 10 + 1] AS status,
   o_orderdate + to_minutes(CAST(o_orderkey * 7 % 1440 AS INTEGER)) AS created_at FROM orders)""")
frame_sql("access_log", """
SELECT event_id AS AuditId, ts AS AccessTimestamp, 'user' || user_id AS UserId,
  CASE WHEN event_type = 'purchase' THEN 'UPDATE' ELSE 'SELECT' END AS AccessType, 'LabResults' AS TableName,
  CAST(event_id % 97 AS VARCHAR) AS RecordIdentifier, event_type IN ('view', 'click') AS PHIAccessed,
  CASE WHEN event_id % 3 = 0 THEN 'Treatment' ELSE 'Operations' END AS AccessReason, event_id % 19 <> 0 AS Success FROM events""")
frame_sql("change_log", """
SELECT o_orderkey AS seq, CAST(o_orderkey % 4 + 1 AS INTEGER) AS op, o_orderkey // 5 AS ResultId, o_custkey AS PatientId,
  round(o_totalprice, 2) AS ResultValueNumeric, o_orderdate AS ModifiedDate FROM orders""")
frame_sql("change_target", """
SELECT ResultId, PatientId, ResultValueNumeric, ModifiedDate FROM (SELECT *, row_number() OVER (PARTITION BY ResultId ORDER BY seq) AS r
  FROM change_log WHERE ResultId % 2 = 0) WHERE r = 1""")
frame_sql("series", """
SELECT series, date, value, CAST(row_number() OVER (PARTITION BY series ORDER BY date) - 1 AS INTEGER) AS idx FROM (
 SELECT o_orderpriority AS series, CAST(date_trunc('month', o_orderdate) AS DATE) AS date, round(sum(o_totalprice) / 1e6, 4) AS value
 FROM orders GROUP BY 1, 2)""")
frame_sql("segment_series", """
SELECT series, date, value, CAST(row_number() OVER (PARTITION BY series ORDER BY date) - 1 AS INTEGER) AS idx FROM (
 SELECT o_orderstatus AS series, CAST(date_trunc('month', o_orderdate) AS DATE) AS date, round(avg(o_totalprice) / 1e4, 4) AS value
 FROM orders GROUP BY 1, 2)""")
frame_sql("expert_forecasts", """
SELECT expert_id, CASE substr(expert_id, 1, 1) WHEN '1' THEN 'master' WHEN '2' THEN 'expert' WHEN '3' THEN 'intermediate'
    WHEN '4' THEN 'novice' ELSE 'expert' END AS expertise_level, indicator, target_date,
  expert_id || '_' || indicator || '_' || strftime(target_date, '%Y%m%d') AS forecast_id,
  CAST(target_date - INTERVAL 1 MONTH AS DATE) AS forecast_date, point_estimate, std,
  round(CAST(0.8 AS DOUBLE) + CAST(substr(expert_id, 1, 1) AS INTEGER) * CAST(0.05 AS DOUBLE), 2) AS calibration
FROM (SELECT o_orderpriority AS expert_id, c_mktsegment AS indicator, CAST(date_trunc('month', o_orderdate) AS DATE) AS target_date,
   round(avg(o_totalprice) / 1e5, 4) AS point_estimate, round(stddev_pop(o_totalprice) / 1e5, 4) AS std, count(*) AS n
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3) WHERE n >= 2""")
frame_sql("outcomes", """
SELECT c_mktsegment AS indicator, CAST(date_trunc('month', o_orderdate) AS DATE) AS target_date, round(avg(o_totalprice) / 1e5, 4) AS actual
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""")
frame_sql("forecast_actuals", "SELECT forecast_id, actual FROM expert_forecasts JOIN outcomes USING (indicator, target_date)")
frame_sql("recon_source", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, round(l_extendedprice, 2) AS l_extendedprice, l_quantity, l_returnflag FROM lineitem""")
frame_sql("recon_target", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber AS line_no,
  CASE WHEN l_orderkey % 777 = 0 THEN round(l_extendedprice + 1, 2) ELSE l_extendedprice END AS l_extendedprice, l_quantity,
  CASE WHEN l_orderkey % 501 <> 0 THEN l_returnflag END AS l_returnflag FROM recon_source WHERE l_orderkey % 1000 <> 0""")
frame_sql("recon_results", """
SELECT 'task-' || o_orderkey AS task_id, CASE WHEN o_orderkey % 17 = 0 THEN 'FAILED' WHEN o_orderkey % 11 = 0 THEN 'PARTIAL' ELSE 'SUCCESS' END AS status,
  o_orderkey AS source_row_count, o_orderkey - CASE WHEN o_orderkey % 17 = 0 THEN 1 ELSE 0 END AS target_row_count,
  o_orderdate + to_minutes(CAST(o_orderkey * 7 % 1440 + 30 AS INTEGER)) AS validated_at FROM orders WHERE o_orderkey % 10 >= 4""")
frame_sql("health_metrics", """
SELECT date_trunc('day', created_at) AS "timestamp", count(*) FILTER (status IN ('PENDING', 'READY')) AS pending_tasks,
  count(*) FILTER (status = 'COMPLETED') AS completed_tasks, count(*) FILTER (status = 'DEAD_LETTER') AS dead_letter_tasks FROM tasks GROUP BY 1""")
frame_sql("validation_log", """
SELECT 'check_' || l_suppkey AS ValidationName, date_trunc('month', l_shipdate) AS ExecutionTimestamp,
  CASE WHEN count(*) FILTER (l_returnflag <> 'R') * 2 >= count(*) THEN 'PASS' ELSE 'FAIL' END AS PassFailStatus, count(*) AS TotalRecords,
  count(*) FILTER (l_returnflag <> 'R') AS PassedRecords, count(*) FILTER (l_returnflag = 'R') AS FailedRecords
FROM lineitem GROUP BY l_suppkey, date_trunc('month', l_shipdate)""")
frame_sql("phi_reviews", """
SELECT event_id AS MonitoringId, 'user' || user_id AS UserId, ts AS AccessTimestamp, event_id % 6 = 0 AS AlertGenerated,
  event_id % 4 = 0 AS ReviewRequired, CASE WHEN event_id % 8 = 0 THEN ts + INTERVAL 1 DAY END AS ReviewedTimestamp
FROM events WHERE event_type IN ('view', 'click')""")
frame_sql("modification_log", """
SELECT event_id AS ModificationId, ts AS ModificationTimestamp, 'user' || user_id AS UserId, 'reason ' || (event_id % 5) AS ReasonForChange
FROM events WHERE event_type = 'purchase'""")
frame_sql("lineage_log", """
SELECT o_orderdate AS ProcessTimestamp, o_orderkey AS LineageId, 'src_' || (o_orderkey % 6) AS SourceTable, 'tgt_' || (o_orderkey % 4) AS TargetTable,
  o_orderkey % 1000 AS RecordsProcessed, CAST(o_orderkey % 90 AS INTEGER) AS ProcessDurationSeconds, sha256(CAST(o_orderkey AS VARCHAR)) AS DataHash FROM orders""")
frame_sql("as_of", f"SELECT TIMESTAMP '{AS_OF}' AS lab_as_of, TIMESTAMP '{QUEUE_AS_OF}' AS queue_as_of")

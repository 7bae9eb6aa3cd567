"""Reconciliation of copies."""

from __future__ import annotations

from pyspark.sql import functions as F

from veriloom.catalog import common  # noqa: F401
from veriloom.catalog.registry import frame_sql, query
from veriloom.operators import reconcile as rc
from veriloom.plans import migration
from veriloom.session import work_dir
from veriloom.sources import files
from veriloom.sources import frames as src

KEYS = ["l_extendedprice", "l_quantity", "l_partkey", "l_tax"]
COMMON = ["l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_returnflag"]
DOUBLES = {"l_extendedprice", "l_quantity"}
#: Rows that a task of the sorted copy holds at most, about: a fixed number of parts would grow with the table.
ROWS_A_PART = 500_000


def _sides(spark, d):
    return src.recon_source(spark, d), src.recon_target(spark, d)


def checksum_sql(c: str) -> str:
    text = f"printf('%.4f', {c})" if c in DOUBLES else f"CAST({c} AS VARCHAR)"
    return f"sum(CAST(CAST('0x' || substr(md5(coalesce({text}, chr(0))), 1, 8) AS BIGINT) AS HUGEINT))"


frame_sql("sigs", " UNION ALL ".join(
    f"SELECT '{c}' AS col, (SELECT CAST({checksum_sql(c)} AS VARCHAR) FROM recon_source) AS s, (SELECT CAST({checksum_sql(c)} AS VARCHAR) FROM recon_target) AS t" for c in COMMON))


frame_sql("recon_nulls", " UNION ALL ".join(
    f"SELECT '{c}' AS col, {i} AS place, (SELECT count(*) - count({c}) FROM recon_source) AS s, (SELECT count(*) - count({c}) FROM recon_target) AS t" for i, c in enumerate(COMMON)))
frame_sql("recon_sums", " UNION ALL ".join(
    f"SELECT '{c}' AS col, {i} AS place, (SELECT sum({c}) FROM recon_source) AS s, (SELECT sum({c}) FROM recon_target) AS t" for i, c in enumerate(KEYS[:3])))


def verdict_sql(counts: str, bad_sigs: str, bad_sums: str, bad_nulls: str) -> str:
    """The verdict and its texts, from the two row counts and the names of differing columns."""
    return f"""
SELECT CASE WHEN s <> t THEN 'FAILED' WHEN sigs IS NOT NULL OR sums IS NOT NULL THEN 'PARTIAL' ELSE 'SUCCESS' END AS status, s = t AS row_count_match,
 s AS source_row_count, t AS target_row_count, sigs IS NULL AS checksum_match, sums IS NULL AS key_sums_match,
 list_filter([CASE WHEN s <> t THEN 'Row count mismatch: source=' || s || ', target=' || t END, 'Column checksum mismatch: ' || sigs, 'Key sum mismatch: ' || sums, 'Null count mismatch: ' || nulls],
             lambda x: x IS NOT NULL) AS discrepancies
FROM (SELECT * FROM ({counts}) AS c, (SELECT ({bad_sigs}) AS sigs, ({bad_sums}) AS sums, ({bad_nulls}) AS nulls) AS b)"""


frame_sql("recon_verdict", verdict_sql(
    "SELECT (SELECT count(*) FROM recon_source) AS s, (SELECT count(*) FROM recon_target) AS t",
    f"SELECT string_agg(col, ', ' ORDER BY list_position({COMMON!r}, col)) FROM sigs WHERE s <> t",
    "SELECT string_agg(col, ', ' ORDER BY place) FROM (SELECT col, place FROM recon_sums WHERE abs(s - t) / greatest(abs(s), 1) > 0.0001 UNION ALL SELECT 'l_tax', 3)",
    "SELECT string_agg(col, ', ' ORDER BY place) FROM recon_nulls WHERE s <> t"))


@query("recon_row_count", "source_rows:i target_rows:i match", """
SELECT *, source_rows = target_rows AS match FROM (SELECT (SELECT count(*) FROM recon_source) AS source_rows, (SELECT count(*) FROM recon_target) AS target_rows)""")
def _(spark, d):
    return rc.row_count(*_sides(spark, d))


@query("recon_checksums", "column source_checksum target_checksum match", "SELECT col AS \"column\", s AS source_checksum, t AS target_checksum, s = t AS match FROM sigs")
def _(spark, d):
    return rc.checksums(*_sides(spark, d))


@query("recon_checksums_fast", "column match", "SELECT col AS \"column\", s = t AS match FROM sigs")
def _(spark, d):
    return rc.checksums(*_sides(spark, d), fast=True)


@query("recon_key_sums", "column source_sum:r2 target_sum:r2 difference:r2 relative_difference:r8 status match", """
SELECT *, CASE WHEN relative_difference <= 0.0001 THEN 'MATCH' ELSE 'MISMATCH' END AS status, relative_difference <= 0.0001 AS match FROM (
 SELECT *, abs(source_sum - target_sum) AS difference, abs(source_sum - target_sum) / greatest(abs(source_sum), 1) AS relative_difference FROM (
  SELECT 'l_extendedprice' AS "column", (SELECT sum(l_extendedprice) FROM recon_source) AS source_sum, (SELECT sum(l_extendedprice) FROM recon_target) AS target_sum
  UNION ALL SELECT 'l_quantity', (SELECT sum(l_quantity) FROM recon_source), (SELECT sum(l_quantity) FROM recon_target)
  UNION ALL SELECT 'l_partkey', (SELECT sum(l_partkey) FROM recon_source), (SELECT sum(l_partkey) FROM recon_target)))
UNION ALL SELECT 'l_tax', 0, 0, 0, 0, 'COLUMN_NOT_FOUND', FALSE""")
def _(spark, d):
    return rc.key_sums(*_sides(spark, d), KEYS)


@query("recon_null_counts", "column source_nulls:i target_nulls:i match", """
SELECT c AS "column", s AS source_nulls, t AS target_nulls, s = t AS match FROM (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS c, (SELECT count(*) - count({c}) FROM recon_source) AS s, (SELECT count(*) - count({c}) FROM recon_target) AS t" for c in COMMON) + ")")
def _(spark, d):
    return rc.null_counts(*_sides(spark, d))


@query("recon_status", "status row_count_match source_row_count:i target_row_count:i checksum_match key_sums_match discrepancies:j", "SELECT * FROM recon_verdict")
def _(spark, d):
    return rc.reconcile(*_sides(spark, d), KEYS)


@query("recon_status_equal", "status row_count_match checksum_match key_sums_match discrepancies:j", verdict_sql(
    "SELECT count(*) AS s, count(*) AS t FROM recon_source", "SELECT string_agg('x', '') FROM recon_source WHERE FALSE",
    "SELECT string_agg('x', '') FROM (SELECT sum(l_extendedprice) AS s FROM recon_source) WHERE s <> s", "SELECT string_agg('x', '') FROM recon_source WHERE FALSE"))
def _(spark, d):
    source = src.recon_source(spark, d)
    parts = max(7, -(-source.count() // ROWS_A_PART))  # counted from the files' footers
    shuffled = source.repartition(parts, "l_partkey").sortWithinPartitions(F.col("l_quantity").desc())
    return rc.reconcile(source, shuffled, ["l_extendedprice"])


OWN = ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_returnflag"]


def _lists(table: str, line: str) -> str:
    lists = ", ".join(f"list({c} ORDER BY {c}) AS {c}" for c in OWN)
    return f"SELECT l_orderkey, {line} AS l_linenumber, count(*) AS n, {lists} FROM {table} GROUP BY 1, 2"


@query("recon_differing_rows", "l_orderkey:i l_linenumber:i kind source_rows:i target_rows:i differing_columns:j", f"""
SELECT l_orderkey, l_linenumber, CASE WHEN t = 0 THEN 'source_only' WHEN s = 0 THEN 'target_only' ELSE 'changed' END AS kind, s AS source_rows, t AS target_rows,
 CASE WHEN s = t THEN list_filter(cols, lambda x: x IS NOT NULL) ELSE [] END AS differing_columns FROM (
 SELECT l_orderkey, l_linenumber, coalesce(a.n, 0) AS s, coalesce(b.n, 0) AS t, [{", ".join(f"CASE WHEN a.{c} IS DISTINCT FROM b.{c} THEN '{c}' END" for c in OWN)}] AS cols
 FROM ({_lists("recon_source", "l_linenumber")}) AS a FULL JOIN ({_lists("recon_target", "line_no")}) AS b USING (l_orderkey, l_linenumber))
WHERE s <> t OR len(list_filter(cols, lambda x: x IS NOT NULL)) > 0""")
def _(spark, d):
    source, target = _sides(spark, d)
    return rc.differing_rows(source, target.withColumnRenamed("line_no", "l_linenumber"), ["l_orderkey", "l_linenumber"])


@query("recon_report_append", "reconciliation_id status discrepancies_json", """
SELECT 'recon_1' AS reconciliation_id, status, '["' || array_to_string(discrepancies, '","') || '"]' AS discrepancies_json FROM recon_verdict""")
def _(spark, d):
    row = rc.report(rc.reconcile(*_sides(spark, d), KEYS), "recon_1", src.QUEUE_AS_OF)
    return files.read_rows(spark, files.append_rows(row, work_dir(spark, "recon")))


@query("recon_status_dist", "status n:i", "SELECT status, count(*) AS n FROM recon_results GROUP BY 1")
def _(spark, d):
    return rc.status_distribution(src.recon_results(spark, d))


@query("recon_failures", "task_id status source_row_count:i target_row_count:i", "SELECT * FROM recon_results WHERE status <> 'SUCCESS'")
def _(spark, d):
    return rc.failed_results(src.recon_results(spark, d))


@query("recent_recon", "task_id status validated_at:t", "SELECT * FROM recon_results ORDER BY validated_at DESC, task_id LIMIT 20")
def _(spark, d):
    return rc.recent_results(src.recon_results(spark, d))


@query("column_set_diff", "column side", """
SELECT "column", side FROM (SELECT unnest(['l_linenumber', 'line_no']) AS "column", unnest(['source_only', 'target_only']) AS side), (SELECT count(*) AS n FROM recon_target) WHERE n >= 0""")
def _(spark, d):
    return rc.column_diff(*_sides(spark, d))


@query("migrate_and_reconcile", "status source_row_count:i target_row_count:i checksum_match key_sums_match", """
SELECT 'SUCCESS' AS status, count(*) AS source_row_count, count(*) AS target_row_count, TRUE AS checksum_match, TRUE AS key_sums_match FROM orders""")
def _(spark, d):
    from veriloom.catalog.ingest import ORDERS, _orders_csv
    root = work_dir(spark, "lake")
    return migration.migrate_and_reconcile(spark, _orders_csv(spark, d), root, f"{root}/_snapshots", "orders", ORDERS, ["o_totalprice"])


@query("reconcile_completed", "task_id status source_row_count:i target_row_count:i", """
SELECT 'good' AS task_id, 'SUCCESS' AS status, count(*) AS source_row_count, count(*) AS target_row_count FROM orders
UNION ALL SELECT 'bad', 'FAILED', (SELECT count(*) FROM lineitem), (SELECT count(*) FROM recon_target)""")
def _(spark, d):
    bad = work_dir(spark, "copy")
    src.recon_target(spark, d).write.parquet(bad)
    pairs = spark.createDataFrame([("good", f"{d}/orders.parquet", f"{d}/orders.parquet", "o_totalprice"), ("bad", f"{d}/lineitem.parquet", bad, "l_quantity")],
                                  "task_id string, source_path string, target_path string, key_column string")
    return migration.reconcile_completed(spark, pairs, work_dir(spark, "recon"), src.QUEUE_AS_OF)

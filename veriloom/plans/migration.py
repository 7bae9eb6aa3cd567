"""Load, prove, record: migrating files and reconciling every completed load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriloom.operators import reconcile as rc
from veriloom.sources import files


def migrate_and_reconcile(spark: SparkSession, src: str, root: str, log: str, table: str, schema: str, key_columns: Sequence[str] = (),
                          tol: float = 1e-4) -> DataFrame:
    """Migrate one CSV and compare what was stored with what was read."""
    stored = files.migrate(spark, src, root, log, table, (), schema)
    return rc.reconcile(files.read_csv(spark, src, schema), stored, key_columns, tol)


def reconcile_completed(spark: SparkSession, pairs: DataFrame, sink: str, as_of: str, parallel: int = 4) -> DataFrame:
    """Re-check completed loads: ``pairs`` (task_id, source_path, target_path, key_column) is a control table, read in pages.

    Each pair is its own distributed job, several at a time, with one report row appended.
    """
    def run(p) -> None:
        source, target = spark.read.parquet(p["source_path"]), spark.read.parquet(p["target_path"])
        row = rc.report(rc.reconcile(source, target, [p["key_column"]]), f"recon_{p['task_id']}", as_of)
        files.append_rows(row.withColumn("task_id", F.lit(p["task_id"])), sink)

    files.run_paged(pairs, run, parallel)
    return files.read_rows(spark, sink)

"""Scans, landing and migration of file tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SNAPSHOT_LOG = "table string, path string, n_rows bigint, created_at timestamp"


def read_csv(spark: SparkSession, path: str, schema: str | None = None, failfast: bool = True) -> DataFrame:
    """CSV with a header. Give a schema where it is known: inferring one costs a pass over the data."""
    reader = spark.read.option("header", True).option("mode", "FAILFAST" if failfast else "PERMISSIVE")
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def check_columns(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """(column, problem) per missing or extra column. Looks at metadata only."""
    have, want = set(df.columns), set(expected)
    rows = [(c, "missing") for c in sorted(want - have)] + [(c, "extra") for c in sorted(have - want)]
    return df.sparkSession.createDataFrame(rows, "column string, problem string")


def require_columns(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """``df`` itself, or an error naming every missing and extra column."""
    have, want = set(df.columns), set(expected)
    if have != want:
        raise ValueError(f"schema mismatch: missing {sorted(want - have)}, extra {sorted(have - want)}")
    return df


def source_check(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """(path, n_rows, n_columns) of a readable CSV source."""
    df = read_csv(spark, path, schema, failfast=False)
    if not df.columns:
        raise ValueError(f"{path} has no columns")
    return df.agg(F.lit(path).alias("path"), F.count("*").alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"))


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def record_snapshot(spark: SparkSession, log: str, table: str, path: str, n_rows: int) -> None:
    """Point ``table`` at ``path``. The row appears whole or not at all, so readers see the old snapshot or the new
    one, never a mixture. One writer per table is assumed; tables may be written side by side."""
    row = spark.range(1).select(
        F.lit(table).alias("table"), F.lit(path).alias("path"), F.lit(n_rows).cast("bigint").alias("n_rows"),
        F.current_timestamp().alias("created_at"))
    append_rows(row, log)


def current_snapshot(spark: SparkSession, log: str, table: str) -> DataFrame:
    """The rows of the table's newest snapshot."""
    newest = (spark.read.schema(SNAPSHOT_LOG).parquet(log).where(F.col("table") == table)
              .agg(F.max_by("path", "created_at").alias("path")).first())
    if newest is None or newest["path"] is None:
        raise ValueError(f"no snapshot of {table} in {log}")
    return spark.read.parquet(newest["path"])


def write_snapshot(df: DataFrame, root: str, log: str, table: str, partition_by: Sequence[str] = ()) -> str:
    """Write ``df`` beside the older snapshots and switch to it once the write has fully succeeded."""
    path = f"{root.rstrip('/')}/{table}/snapshot={uuid.uuid4().hex[:12]}"
    writer = (gathered(df, partition_by) if partition_by else df).write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    n_rows = df.sparkSession.read.parquet(path).count()
    record_snapshot(df.sparkSession, log, table, path, n_rows)
    return path


def migrate(spark: SparkSession, src: str, root: str, log: str, table: str, partition_by: Sequence[str] = (),
            schema: str | None = None, expected: Sequence[str] | None = None) -> DataFrame:
    """Load a CSV as the table's new snapshot, all or nothing, and return the stored rows."""
    df = read_csv(spark, src, schema)
    if expected is not None:
        require_columns(df, expected)
    return spark.read.parquet(write_snapshot(df, root, log, table, partition_by))


def run_paged(control: DataFrame, run: Callable, parallel: int, page: int = 1000) -> list:
    """``run`` of every row of a control table, ``parallel`` at a time; rows come to the driver a page at a time."""
    rows, results = control.toLocalIterator(), []
    with ThreadPoolExecutor(parallel) as pool:
        while part := list(islice(rows, page)):
            results += pool.map(run, part)
    return results


def migrate_many(spark: SparkSession, tasks: DataFrame, root: str, log: str, parallel: int = 4) -> DataFrame:
    """Run several migrations side by side; one result row per task.

    ``tasks`` (task_id, source_path, table) is a control table of any length, read in pages; at most a page of tasks is submitted at a time.
    """

    def run(task) -> tuple:
        try:
            migrate(spark, task["source_path"], root, log, task["table"])
            return task["task_id"], True, "COMPLETED", None
        except Exception as exc:  # one failing source must not stop the others; its error is reported
            return task["task_id"], False, "FAILED", str(exc)

    results = run_paged(tasks.select("task_id", "source_path", "table"), run, parallel)
    return spark.createDataFrame(results, "task_id string, success boolean, status string, error string")


def gathered(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows brought together by partition before a write, so that a partition gets few files; adaptive execution splits large
    partitions by their size and merges small ones."""
    return df.hint("rebalance", *by)


def land_bronze(df: DataFrame, root: str, table: str, ingest_date: Column, load: str) -> str:
    """Snappy parquet under table/yyyy/MM/dd, in a folder per load.

    Loads of one day stand side by side. A rerun under the same ``load`` replaces what that load delivered for its days and nothing else.
    """
    path = f"{root.rstrip('/')}/{table}"
    dated = df.withColumns({"year": F.date_format(ingest_date, "yyyy"), "month": F.date_format(ingest_date, "MM"),
                            "day": F.date_format(ingest_date, "dd"), "load": F.lit(load)})
    (gathered(dated, ["year", "month", "day"]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("compression", "snappy").partitionBy("year", "month", "day", "load").parquet(path))
    return path


def append_partitioned(df: DataFrame, root: str, by: str, load: str) -> str:
    """Add rows to date partitions, in a folder per load; a rerun of a load replaces its own rows instead of doubling them."""
    (gathered(df.withColumn("load", F.lit(load)), [by]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(by, "load").parquet(root))
    return root


def append_rows(df: DataFrame, path: str) -> str:
    """Add report or log rows. Each append is a folder of its own: two jobs appending to one folder at the same time
    would clear away each other's uncommitted files."""
    df.write.parquet(f"{path.rstrip('/')}/append={uuid.uuid4().hex[:12]}")
    return path


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """Everything appended so far."""
    return spark.read.parquet(path).drop("append")

"""Incremental extraction, hash-based upsert and change application."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veriloom.operators.skew import latest_per_key
from veriloom.session import materialise


def extract_incremental(src: DataFrame, wm_col: str, old, new=None) -> tuple[DataFrame, Column | object]:
    """Rows with old < watermark <= new, and the new watermark (the column's maximum unless given).

    Both bounds are literals, so they reach the file scan as pushed filters.
    """
    top = new if new is not None else src.agg(F.max(wm_col)).first()[0]
    c = F.col(wm_col)
    return src.where((c > F.lit(old)) & (c <= F.lit(top))), top


def set_watermark(watermarks: DataFrame, table: str, value: Column, as_of: Column) -> DataFrame:
    """The control table with one table's watermark set; added when absent."""
    name = F.col("TableName")
    known = watermarks.select(
        "TableName", F.when(name == table, value).otherwise(F.col("WatermarkValue")).alias("WatermarkValue"),
        F.when(name == table, as_of).otherwise(F.col("LastProcessedDate")).alias("LastProcessedDate"),
        "ProcessedRowCount")
    fresh = watermarks.agg(F.count_if(name == table).alias("n")).where("n = 0").select(
        F.lit(table).alias("TableName"), value.alias("WatermarkValue"), as_of.alias("LastProcessedDate"),
        F.lit(0).cast("bigint").alias("ProcessedRowCount"))
    return known.unionByName(fresh)


def set_watermarks(watermarks: DataFrame, updates: DataFrame) -> DataFrame:
    """Set-based form: ``updates`` (TableName, WatermarkValue, LastProcessedDate) replaces or inserts."""
    new = updates.select("TableName", F.col("WatermarkValue").alias("_w"), F.col("LastProcessedDate").alias("_l"))
    j = watermarks.join(new, "TableName", "full_outer")
    return j.select("TableName", F.coalesce("_w", "WatermarkValue").alias("WatermarkValue"),
                    F.coalesce("_l", "LastProcessedDate").alias("LastProcessedDate"),
                    F.coalesce("ProcessedRowCount", F.lit(0)).alias("ProcessedRowCount"))


def log_runs(runs: DataFrame) -> DataFrame:
    """Run rows: start time is the end time minus the duration; status Success."""
    return runs.select(
        "PipelineName", "RunId", "TableName", F.lit("Success").alias("Status"), "RowsCopied",
        "ExecutionDurationSeconds",
        (F.col("EndTime") - F.make_interval(secs=F.col("ExecutionDurationSeconds"))).alias("StartTime"), "EndTime")


def add_processed_rows(watermarks: DataFrame, runs: DataFrame) -> DataFrame:
    """Add the rows copied by the runs to each known table's processed count."""
    done = runs.groupBy("TableName").agg(F.sum("RowsCopied").alias("_rows"))
    return (watermarks.join(done, "TableName", "left")
            .withColumn("ProcessedRowCount", F.col("ProcessedRowCount") + F.coalesce("_rows", F.lit(0))).drop("_rows"))


def upsert(target: DataFrame | None, source: DataFrame, keys: Sequence[str], hash_col: str = "_row_hash", since: str | None = None) -> DataFrame:
    """Target after merging: a matched row is replaced only if its hash differs, new rows are added. With ``since``, a column of both, a matched
    row that has it is replaced only by one that isn't older.

    One full outer join on the key. The source must hold one row per key, and a row with a NULL in its key is an error: it has nothing
    to be matched by. No target: the source itself.
    """
    broken = reduce(or_, [F.col(k).isNull() for k in keys])
    checked = F.when(broken, F.raise_error(F.lit(f"a key ({', '.join(keys)}) is NULL"))).otherwise(F.lit(True))
    source = source.where(checked)
    if target is None:
        return source
    cols = target.columns
    t = target.select(*keys, F.struct(*cols).alias("_t"))
    s = source.select(*keys, F.struct(*cols).alias("_s"))
    j = t.join(s, list(keys), "full_outer")
    replace = F.col("_t").isNull() | (F.col("_s").isNotNull() & ~F.col(f"_s.{hash_col}").eqNullSafe(F.col(f"_t.{hash_col}")))
    if since is not None:
        replace = replace & (F.col(f"_t.{since}").isNull() | F.coalesce(F.col(f"_s.{since}") >= F.col(f"_t.{since}"), F.lit(False)))
    return j.select(F.when(replace, F.col("_s")).otherwise(F.col("_t")).alias("_r")).select("_r.*")


BUCKET = "bucket"


def bucketed(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int = 256) -> str:
    """Store a table in folders by a hash of its key, for :func:`merge_bucketed`."""
    bucketed(df, keys, buckets).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(path)
    return path


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BUCKET)


def merge_bucketed(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], merge: Callable[[DataFrame, DataFrame], DataFrame],
                   buckets: int = 256) -> int:
    """Apply ``merge(target, source)`` to a table of :func:`write_bucketed`, reading and rewriting only the folders in which a key of the
    source falls; returns how many.

    The merged folders are written beside the table first and then replace the old ones. One writer a table; a reader
    that must not see folders change needs a transactional format.
    """
    incoming = materialise(bucketed(source, keys, buckets), "incoming")
    hit = sorted(r[0] for r in incoming.select(BUCKET).distinct().collect())  # ``buckets`` rows at most
    if not hit:
        return 0
    target = spark.read.parquet(path)
    merged = merge(target.where(F.col(BUCKET).isin(hit)).drop(BUCKET), incoming.drop(BUCKET))
    stored = materialise(bucketed(merged, keys, buckets), "merged")
    left = {r[0] for r in stored.select(BUCKET).distinct().collect()}
    (stored.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path))
    for gone in set(hit) - left:  # folders whose last row was deleted
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{BUCKET}={gone}")
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return len(hit)


OPERATIONS = {1: "Delete", 2: "Insert", 3: "Update (Before)", 4: "Update (After)"}


def decode_changes(changes: DataFrame) -> DataFrame:
    """Inserts and after-images with a readable operation name."""
    name = F.element_at(F.create_map(*[F.lit(x) for p in OPERATIONS.items() for x in p]), F.col("op"))
    return changes.where(F.col("op").isin(2, 4)).withColumn("OperationType", name)


def net_changes(changes: DataFrame, keys: Sequence[str], from_seq: int | None = None,
                to_seq: int | None = None) -> DataFrame:
    """The last change per key within a sequence range, deletes included; open bounds reach the log's ends."""
    rows = changes.where(F.col("op") != 3)
    if from_seq is not None:
        rows = rows.where(F.col("seq") >= from_seq)
    if to_seq is not None:
        rows = rows.where(F.col("seq") <= to_seq)
    last = latest_per_key(rows, keys, [F.col("seq").desc()])
    kind = F.when(F.col("op") == 1, "Delete").when(F.col("op") == 2, "Insert").otherwise("Update")
    return last.withColumn("OperationType", kind)


def apply_changes(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upserts and deletes of the net changes applied to the target."""
    cols = target.columns
    net = net_changes(changes, keys).select(*keys, "op", F.struct(*cols).alias("_s"))
    t = target.select(*keys, F.struct(*cols).alias("_t"))
    j = t.join(net, list(keys), "full_outer").where(F.col("op").isNull() | (F.col("op") != 1))
    return j.select(F.when(F.col("op").isNotNull(), F.col("_s")).otherwise(F.col("_t")).alias("_r")).select("_r.*")


def extraction_differences(by_cdc: DataFrame, by_watermark: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys one extraction path delivered and the other did not: (keys, only_in). One join serves both ways."""
    a = by_cdc.select(*keys).distinct().withColumn("_a", F.lit(True))
    b = by_watermark.select(*keys).distinct().withColumn("_b", F.lit(True))
    j = a.join(b, list(keys), "full_outer").where(F.col("_a").isNull() | F.col("_b").isNull())
    return j.select(*keys, F.when(F.col("_a").isNull(), "watermark").otherwise("cdc").alias("only_in"))


def scd2_apply(dim: DataFrame, updates: DataFrame, key: str, tracked: Sequence[str], as_of: Column) -> DataFrame:
    """Slowly changing dimension, type 2: a changed current row is closed at ``as_of`` and a new version added.

    ``dim`` holds key, tracked columns, EffectiveDate, EndDate, IsCurrent; ``updates`` one row per key.
    Each row of the full outer join yields one or two versions, so the data moves once.
    """
    cols = [key, *tracked, "EffectiveDate", "EndDate", "IsCurrent"]
    history = dim.where(~F.col("IsCurrent")).select(cols)
    current = dim.where("IsCurrent").select(key, F.struct(cols).alias("_old"))
    incoming = updates.select(key, F.struct(*tracked).alias("_new"))
    j = current.join(incoming, key, "full_outer")
    same = F.col("_new").isNull() | F.struct(*[F.col(f"_old.{c}").alias(c) for c in tracked]).eqNullSafe(F.col("_new"))
    ts = dim.schema["EffectiveDate"].dataType

    def version(src: str, start: Column, end: Column, is_current: bool) -> Column:
        return F.struct(F.col(key).alias(key), *[F.col(f"{src}.{c}").alias(c) for c in tracked],
                        start.cast(ts).alias("EffectiveDate"), end.cast(ts).alias("EndDate"),
                        F.lit(is_current).alias("IsCurrent"))

    none = F.lit(None)
    kept = version("_old", F.col("_old.EffectiveDate"), none, True)
    closed = version("_old", F.col("_old.EffectiveDate"), as_of, False)
    opened = version("_new", as_of, none, True)
    out = (F.when(F.col("_old").isNull(), F.array(opened)).when(same, F.array(kept))
           .otherwise(F.array(closed, opened)))
    return history.unionByName(j.select(F.inline(out)))

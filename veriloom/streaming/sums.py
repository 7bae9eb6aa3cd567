"""Sums kept across micro-batches as tables: one small table per batch and, now and then, one that holds all before it.

A batch writes its own folder, so repeating it after a failure replaces what it wrote; nothing is updated in place. A reader at batch k
adds up the newest base before k and the batches after that base up to k, so it never sees a half-written base or a later batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriloom.sources import files

#: Batches after which a new base is written; a reader opens at most as many folders.
FOLD = 32


def add(part: DataFrame, root: str, batch_id: int) -> None:
    part.write.mode("overwrite").parquet(f"{root}/parts/batch={batch_id}")


def total(spark: SparkSession, root: str, batch_id: int, keys: Sequence[str], sums: Sequence[str] = (), most: Sequence[str] = ()) -> DataFrame:
    """Sums, and largest values of ``most``, per key over all batches up to ``batch_id``; without either the distinct keys."""
    parts = spark.read.parquet(f"{root}/parts")
    since, rows = -1, None
    if files.exists(spark, f"{root}/base"):
        bases = spark.read.parquet(f"{root}/base")
        newest = bases.where(F.col("upto") < batch_id).agg(F.max("upto")).first()[0]
        if newest is not None:
            since, rows = newest, bases.where(F.col("upto") == newest).drop("upto")
    later = parts.where((F.col("batch") > since) & (F.col("batch") <= batch_id)).drop("batch")
    both = later if rows is None else rows.unionByName(later)
    kept = [F.sum(c).alias(c) for c in sums] + [F.max(c).alias(c) for c in most]
    return both.groupBy(*keys).agg(*kept) if kept else both.select(*keys).distinct()


def fold(spark: SparkSession, root: str, batch_id: int, keys: Sequence[str], sums: Sequence[str] = (), every: int = FOLD,
         most: Sequence[str] = ()) -> None:
    """Write a base at every ``every``-th batch."""
    if batch_id % every == every - 1:
        total(spark, root, batch_id, keys, sums, most).write.mode("overwrite").parquet(f"{root}/base/upto={batch_id}")

"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veriloom.session import materialise

#: The white space of all contracts, as a character class body and as Java/Python patterns.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    """A-Z only; ``lower`` would change other alphabets too."""
    return F.translate(c, ASCII_UPPER, ASCII_LOWER)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def byte_slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows holding about ``limit`` bytes of text each; a longer text stands alone."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    group = (np.cumsum(sizes) - 1).clip(0) // limit
    starts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(starts, starts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def stored_rows(df: DataFrame, name: str, row: str = "_row") -> DataFrame:
    """Write narrow rows once with a number of their own. Once stored, the numbers no longer change, also if tasks are repeated."""
    return materialise(df.withColumn(row, F.monotonically_increasing_id()), name)


def rank_within(stored: DataFrame, keys: Sequence[str], row: Sequence[str] = ("_row",), name: str = "rank") -> DataFrame:
    """Add the 0-based place of each row among those with equal ``keys``, in an order fixed by the columns ``row``.

    Rows of a key are dealt into buckets by a hash of ``row``; a bucket's rows are numbered on their own and start
    where the buckets before it end. So a key that holds most rows is spread over all tasks. Null keys are a key.
    """
    buckets = 4 * shuffle_partitions(stored.sparkSession)
    keys = list(keys)
    safe = [f"_k{i}" for i in range(len(keys))]
    cut = stored.withColumn("_bucket", F.pmod(F.xxhash64(*row), F.lit(buckets)))
    for k, s in zip(keys, safe):  # nulls take part in the join as a value
        cut = cut.withColumn(s, F.struct(F.col(k).isNull().alias("n"), F.coalesce(F.col(k), _zero(stored, k)).alias("v")))
    inside = W.partitionBy(*safe, "_bucket").orderBy(*row)
    numbered = cut.withColumn("_own", F.row_number().over(inside) - 1)
    sizes = cut.groupBy(*safe, "_bucket").agg(F.count("*").alias("_n"))
    before = W.partitionBy(*safe).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(*safe, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (numbered.join(offsets.hint("shuffle_merge"), [*safe, "_bucket"])
            .withColumn(name, F.col("_own") + F.col("_offset"))
            .drop("_own", "_offset", "_bucket", *safe))


def bounded_sample(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """At most ``n`` rows, those with the smallest hashes of ``keys``, so the same ones in every run.

    A share of about twice as many is cut out in the tasks first: else every task would send its own ``n`` smallest on.
    """
    share = min(1.0, 2 * n / max(1, df.count()))
    h = F.xxhash64(F.lit("sample"), *keys)
    return df.withColumn("_h", h).where(F.pmod("_h", F.lit(1 << 30)) < int(share * (1 << 30))).orderBy("_h", *keys).limit(n).drop("_h")


def _zero(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    return F.lit("" if kind.simpleString() == "string" else 0).cast(kind)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of undirected ``edges`` (a, b): one row (node, root) per node that has an edge to another, root being
    the smallest node of its component.

    Alternates two steps that replace edges by stars until nothing changes: every node tells its larger neighbours the
    smallest node it knows, then its smaller ones. Only minima are gathered, never lists of neighbours; each round is
    written to the shared folder, so lost executors cost one round at most. The minima are stored too: then both sides of the
    join arrive by a shuffle of its own, and adaptive execution splits a node with very many neighbours. The number of rounds grows with the logarithm of the longest chain.
    """
    pairs = (edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    current, before = materialise(pairs, name), None
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialise(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), name)
        large = (both.where("v > u").join(low.hint("shuffle_merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least.hint("shuffle_merge"), "u")
                 .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        current = materialise(small, name)
        state = current.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.sum(F.expr("shiftright(xxhash64(v, u), 24)"))).first()
        if state == before:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", hint: str | None = None) -> DataFrame:
    """Equi-join on columns of the same names; nulls match nulls."""
    names = {k: f"_same{i}" for i, k in enumerate(keys)}
    other = right.withColumnsRenamed(names)
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
    return left.join(other.hint(hint) if hint else other, same, how).drop(*names.values())

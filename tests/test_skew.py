"""The skew-safe operators must equal plain windows and numpy, also when one key holds most rows."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veriloom.operators import skew


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    data = []
    for i in range(900):
        key = None if i % 23 == 0 else "hot" if rnd.random() < 0.6 else f"k{rnd.randrange(9)}"  # NULL is a key
        # few distinct times, so that ties occur
        at = start + dt.timedelta(hours=rnd.randrange(24 * 40))
        data.append((i, key, at, None if i % 17 == 0 else float(rnd.randrange(50))))
    return spark.createDataFrame(data, "id long, key string, ts timestamp_ntz, v double").cache()


def test_previous_row_equals_lag(rows):
    w = W.partitionBy("key").orderBy("ts", "id")
    plain = rows.select("id", F.lag("v").over(w).alias("p"), F.lag("ts").over(w).alias("t"))
    for seconds in (3600, 86400, 10 * 86400):
        got = skew.previous_row(rows, ["key"], ["ts", "id"], ["v", "ts"], seconds).select("id", F.col("_prev.v"), F.col("_prev.ts"))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))


@pytest.mark.parametrize("steps,seconds", [(30, 86400), (3, 86400), (1, 3600), (12, 300)])
def test_trailing_count_equals_range_window(rows, steps, seconds):
    stamped = rows.withColumn("s", F.unix_timestamp(F.col("ts").cast("timestamp")))
    w = W.partitionBy("key").orderBy("s").rangeBetween(-steps * seconds, 0)
    plain = stamped.select("id", F.count("*").over(w))
    got = skew.trailing_count(rows, ["key"], "ts", steps, seconds, "n").select("id", "n")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))


@pytest.mark.parametrize("q", [0.0, 0.05, 0.5, 0.9, 0.95, 0.99, 1.0])
def test_exact_percentiles_equal_numpy(rows, q):
    got = {r["key"]: r["p"] for r in skew.exact_percentiles(rows, ["key"], "v", {"p": q}).collect()}
    values = {}
    for r in rows.where("v IS NOT NULL").collect():
        values.setdefault(r["key"], []).append(r["v"])
    assert got.keys() == values.keys()
    for k, v in values.items():
        assert got[k] == pytest.approx(np.percentile(v, q * 100))


def test_exact_percentiles_with_coarse_sketch(spark):
    """A sketch far coarser than the data still leads to the exact element."""
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_011).cast("double").alias("v"))
    values = np.array([r["v"] for r in df.collect()])
    wanted = {f"p{i}": q for i, q in enumerate((0.01, 0.5, 0.95))}
    last = F.col("_total") - 1
    got = skew.exact_positions(df, [], "v", {n: (q, last * F.lit(q)) for n, q in wanted.items()}, accuracy=50).first()
    for n, q in wanted.items():
        assert got[n] == pytest.approx(np.percentile(values, q * 100))


def test_running_weight_spans_partitions(rows):
    counts = rows.where("v IS NOT NULL").groupBy("key", "v").agg(F.count("*").alias("n"))
    w = W.partitionBy("key").orderBy("v").rowsBetween(W.unboundedPreceding, -1)
    plain = counts.select("key", "v", F.coalesce(F.sum("n").over(w), F.lit(0)))
    got = skew.running_weight(counts, ["key"], "v", "n").select("key", "v", "_before")
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, plain.collect())))


def test_rows_outside_the_brackets_are_not_shuffled(spark, monkeypatch):
    """What is ranked is the share inside the brackets, however many rows there are."""
    sizes = []
    plain = skew.running_weight
    monkeypatch.setattr(skew, "running_weight", lambda df, *a: sizes.append(df.count()) or plain(df, *a))
    for n in (20_000, 80_000):
        skew.exact_percentiles(spark.range(n).select((F.col("id") * 1.0).alias("v")), [], "v", {"p": 0.5}).collect()
    assert sizes[0] <= 20_000 * 7 / 20_000 + 3 and sizes[1] <= 80_000 * 7 / 20_000 + 3


def test_rank_filter_is_pruned_before_the_shuffle(rows):
    plan = skew.latest_per_key(rows, ["key"], [F.col("ts").desc(), F.col("id")])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan

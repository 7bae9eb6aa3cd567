"""Sums kept across batches: any cut, repeated batches and bases give the sums of the whole."""

import random
from collections import Counter

from pyspark.sql import functions as F

from veriloom.session import work_dir
from veriloom.streaming import sums


def test_sums_over_batches(spark):
    rng, root = random.Random(2), work_dir(spark, "sums")
    rows = [(rng.choice(["a", "b", None]), rng.randrange(9)) for _ in range(300)]
    parts = [rows[i::7] for i in range(7)]
    seen = Counter()
    for batch, part in enumerate(parts):
        df = spark.createDataFrame(part, "k string, n bigint").groupBy("k").agg(F.sum("n").alias("n"))
        for _ in range(2 if batch in (2, 3) else 1):  # a batch repeated after a failure, one with a base among them
            sums.add(df, root, batch)
            got = {r.k: r.n for r in sums.total(spark, root, batch, ["k"], ["n"]).collect()}
            sums.fold(spark, root, batch, ["k"], ["n"], every=2)
        for k, n in part:
            seen[k] += n
        assert got == seen
    assert {r.k for r in sums.total(spark, root, 6, ["k"]).collect()} == {"a", "b", None}

"""A merge that leaves newer rows alone needs one join."""

from veriloom.sources import merge


def test_older_versions_never_replace(spark):
    kinds = "k int, v string, m int, _row_hash bigint"
    target = spark.createDataFrame([(1, "a", 5, 1), (2, "b", 5, 2), (3, "c", None, 3), (4, "d", 5, 4), (5, "e", 5, 5), (6, "f", 5, 6)], kinds)
    source = spark.createDataFrame([(1, "A", 4, 11), (2, "B", 5, 12), (3, "C", 1, 13), (4, "D", None, 14), (5, "E", 6, 5), (7, "G", None, 17)], kinds)
    merged = merge.upsert(target, source, ["k"], since="m")
    assert sorted((r.k, r.v) for r in merged.collect()) == [(1, "a"), (2, "B"), (3, "C"), (4, "d"), (5, "e"), (6, "f"), (7, "G")]
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from veriloom.operators import anomaly, audit, quality
from veriloom.session import work_dir
from veriloom.sources import files
from veriloom.streaming import jobs


@pytest.fixture(scope="module")
def feats(spark):
    cols = [((F.xxhash64("id", F.lit(i)) % 1000) / 1000.0).alias(c) for i, c in enumerate(anomaly.FEATURES)]
    normal = spark.range(3000).select(F.col("id").alias("ResultId"), *cols)
    odd = spark.range(3000, 3020).select(F.col("id").alias("ResultId"), *[F.lit(25.0).alias(c) for c in anomaly.FEATURES])
    return normal.unionByName(odd).cache()


def test_forest_isolates_the_odd_rows(spark, feats):
    model = anomaly.forest_fit(feats, trees=40).cache()
    sizes = model.where("node = 0").groupBy("tree").agg(F.max("size").alias("n")).collect()
    assert len(sizes) == 40 and all(0 < r["n"] <= 256 for r in sizes)
    assert sorted(map(tuple, model.collect())) == sorted(map(tuple, anomaly.forest_fit(feats, trees=40).collect()))
    scored = anomaly.forest_scores(feats, model).cache()
    odd = scored.where("ResultId >= 3000").agg(F.max("AnomalyScore")).first()[0]
    usual = scored.where("ResultId < 3000").agg(F.expr("percentile(AnomalyScore, 0.02)")).first()[0]
    assert -1 <= odd < usual < 0
    flagged = anomaly.forest_flag(scored)
    share = flagged.agg(F.avg(F.col("IsAnomaly").cast("int"))).first()[0]
    assert share == pytest.approx(0.05, abs=0.005)
    assert flagged.where("ResultId >= 3000 AND NOT IsAnomaly").count() == 0


def test_small_inputs_reach_every_tree(feats):
    few = feats.where("ResultId < 50")
    roots = anomaly.forest_fit(few, trees=10).where("node = 0").collect()
    assert [r["size"] for r in roots] == [50] * 10


def test_importance_sums_to_one(feats):
    few = feats.where("ResultId < 400 OR ResultId >= 3000").withColumn(anomaly.FEATURES[0], F.lit(1.0))
    model = anomaly.forest_fit(few, trees=10).cache()
    got = {r["feature"]: r["importance"] for r in anomaly.permutation_importance(few, model).collect()}
    assert sum(got.values()) == pytest.approx(1.0) and got[anomaly.FEATURES[0]] == 0.0


@pytest.mark.parametrize("n,bucket_rows", [(0, 16), (1, 16), (5, 16), (16, 16), (67, 16), (500, 32), (500, 1 << 16)])
def test_repairing_is_one_turn_of_a_seeded_order(spark, n, bucket_rows):
    names = anomaly.FEATURES
    rows = spark.range(n).select(F.col("id").alias("ResultId"), *[(F.col("id") * 100 + k).cast("double").alias(c) for k, c in enumerate(names)])
    order = [r[0] for r in rows.orderBy(F.shiftrightunsigned(F.xxhash64("ResultId", F.lit(42)), 2), "ResultId").select("ResultId").collect()]
    got = {r["ResultId"]: r for r in anomaly.repaired(rows, bucket_rows=bucket_rows).collect()}
    assert sorted(got) == list(range(n))
    for at, i in enumerate(order):
        for k, c in enumerate(names):
            assert got[i][c] == i * 100 + k and got[i][f"_other_{c}"] == order[(at + k + 1) % n] * 100 + k


def test_importance_equals_one_feature_at_a_time(spark, feats):
    few = feats.where("ResultId < 300 OR ResultId >= 3000")
    model = anomaly.forest_fit(few, trees=10).cache()
    pairs = anomaly.repaired(few).cache()
    base = {r["ResultId"]: r["AnomalyScore"] for r in anomaly.forest_scores(few, model).collect()}
    change = {}
    for c in anomaly.FEATURES[:2]:
        swapped = pairs.withColumn(c, F.col(f"_other_{c}"))
        change[c] = sum(abs(r["AnomalyScore"] - base[r["ResultId"]]) for r in anomaly.forest_scores(swapped, model).collect()) / len(base)
    got = {r["feature"]: r["importance"] for r in anomaly.permutation_importance(few, model).collect()}
    a, b = anomaly.FEATURES[:2]
    assert got[a] * change[b] == pytest.approx(got[b] * change[a]) and got[a] > 0


def test_replaced_features_walk_only_where_paths_part():
    """Scores and those with each feature replaced equal a walk row by row, while a row meets far fewer nodes than in nine walks."""
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.normal(size=700), rng.integers(0, 3, 700), rng.lognormal(size=700), np.full(700, 2.0), *rng.normal(size=(4, 700))])
    x[3, 0], x[4, 2], x[5, 4] = np.inf, -np.inf, np.nan
    other = np.roll(x, -1, axis=0)
    grown = [pd.DataFrame(anomaly._grow(x[10 + 60 * t:200 + 60 * t], np.random.default_rng(t), 8), columns=["node", "feature", "threshold", "size"]).assign(tree=t) for t in range(8)]
    walker = anomaly.Walker(pd.concat(grown))
    nodes = [{r.node: r for r in g.itertuples()} for g in grown]

    def score(row):
        total = 0.0
        for tree in nodes:
            at, depth = 0, 0.0
            while tree[at].feature >= 0:
                at, depth = 2 * at + 1 + int(row[tree[at].feature] >= tree[at].threshold), depth + 1
            total += depth + anomaly.average_path(tree[at].size)
        return -np.power(2.0, -(total / len(nodes)) / walker.norm)

    mixed = [np.where(np.arange(8) == k, other, x) for k in range(-1, 8)]
    want = np.array([[score(m[i]) for m in mixed] for i in range(len(x))])
    walked, walk_on = [], walker._walk_on
    walker._walk_on = lambda values, start, *rest: (walked.append(len(start)), walk_on(values, start, *rest))
    assert (walker.changed_scores(x, other) == want).all() and (walker.scores(x) == want[:, 0]).all()
    assert 0 < sum(walked) < 0.5 * 8 * len(x) * len(nodes)
    assert walker.scores(x[:0]).shape == (0,) and walker.changed_scores(x[:0], other[:0]).shape == (0, 9)


def test_excessive_access_counts_the_trailing_hour(spark):
    t0 = dt.datetime(2024, 1, 1, 9, 59)
    times = [t0 + dt.timedelta(minutes=m) for m in (0, 1, 30, 60, 61, 200)]
    log = spark.createDataFrame([(i, "u", t, True) for i, t in enumerate(times)], "AuditId int, UserId string, AccessTimestamp timestamp_ntz, PHIAccessed boolean")
    got = {r["AuditId"]: r["access_count"] for r in audit.excessive_access(log, 0).collect()}
    want = {i: sum(t - dt.timedelta(hours=1) <= s <= t for s in times) for i, t in enumerate(times)}
    assert got == want


LAB = "ResultId long, PatientId long, TestCode string, ResultDate timestamp_ntz, ResultValueNumeric double"


def staged(spark, batches):
    path = work_dir(spark, "in")
    for rows in batches:
        spark.createDataFrame(rows, LAB).coalesce(1).write.mode("append").parquet(path)
    return jobs.table_source(spark, path, spark.createDataFrame([], LAB).schema)


def test_late_results_are_marked_not_applied(spark):
    day = lambda d: dt.datetime(2024, 1, d)
    stream = staged(spark, [[(1, 1, "GLUCOSE", day(10), 100.0)], [(2, 1, "GLUCOSE", day(5), 999.0)], [(3, 1, "GLUCOSE", day(11), 200.0)]])
    sink = work_dir(spark, "out")
    jobs.delta_check(stream, sink, work_dir(spark, "ck"))
    got = {r["ResultId"]: (r["IsLate"], r["PreviousResult"], r["DeltaCheckPass"]) for r in spark.read.parquet(sink).collect()}
    assert got == {1: (False, None, True), 2: (True, None, True), 3: (False, 100.0, False)}


def test_previous_results_need_no_python_per_patient(spark):
    """Many patients over many batches, with folds, missing values, ties in time and a patient without a number."""
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, None if i % 13 == 0 else i % 5, "GLUCOSE" if i % 3 else "WBC", t0 + dt.timedelta(hours=i // 2), None if i % 17 == 0 else float(i % 23)) for i in range(200)]
    path, sink, checkpoint = (work_dir(spark, n) for n in ("in", "out", "ck"))
    for k in range(0, 200, 50):
        spark.createDataFrame(rows[k:k + 50], LAB).coalesce(1).write.mode("append").parquet(path)
        jobs.delta_check(jobs.table_source(spark, path, spark.createDataFrame([], LAB).schema), sink, checkpoint, fold=2)
    got = {r["ResultId"]: (r["PreviousResult"], r["PercentChange"], r["DeltaCheckIssues"], r["IsLate"]) for r in spark.read.parquet(sink).collect()}
    want = {r["ResultId"]: (r["PreviousResult"], r["PercentChange"], r["DeltaCheckIssues"], False) for r in quality.delta_check(spark.createDataFrame(rows, LAB)).collect()}
    assert got == want
    assert files.exists(spark, f"{checkpoint}-newest/base")


def test_closed_days_equal_batch_in_append_mode(spark):
    rows = [(i, 1, "GLUCOSE", dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), float(i)) for i in range(120)]
    full = [[r for r in rows if r[0] < 60], [r for r in rows if r[0] >= 60]]
    stream = staged(spark, full).withColumn("PerformingLabId", F.lit(1)).withColumns({"TurnaroundTimeMinutes": F.lit(5), "CriticalFlag": F.lit(False), "IsAnomaly": F.lit(False), "ReferenceRangeValid": F.lit(True)})
    sink = work_dir(spark, "days")
    jobs.daily_quality(stream, sink, work_dir(spark, "ck"), "1 hour", "append")
    got = {r["MetricDate"].day: r["TotalTests"] for r in spark.read.parquet(sink).collect()}
    assert got and all(n == 24 for n in got.values()) and set(got) == {1, 2, 3, 4}


def test_trailing_hour_of_a_stream_is_exact_in_any_order(spark):
    """Accesses over span borders, on the minute, of a user without a name, weeks late, and repeated batches."""
    t0 = dt.datetime(2024, 1, 1, 9, 0)
    times = [(u, t0 + dt.timedelta(minutes=m)) for u in ("a", "b", None) for m in (0, 1, 59, 60, 61, 119, 120, 121, 180, 60 * 24 * 20)]
    rows = [(i, u, t, i % 7 != 6) for i, (u, t) in enumerate(times)]
    schema = "AuditId int, UserId string, AccessTimestamp timestamp_ntz, PHIAccessed boolean"
    for span, order in ((1, 7), (5, 11), (1, 1)):
        arriving = sorted(rows, key=lambda r: (r[0] * order) % 31)
        path, sink, state, checkpoint = (work_dir(spark, n) for n in ("log", "hits", "state", "ck"))
        for k in range(0, len(arriving), 9):
            spark.createDataFrame(arriving[k:k + 9], schema).write.mode("append").parquet(path)
            stream = jobs.table_source(spark, path, spark.createDataFrame([], schema).schema, 100)
            jobs.phi_excessive_access(stream, sink, state, checkpoint, 1, span)
        got = sorted((r["AuditId"], r["access_count"]) for r in jobs.latest_rows(spark, sink, ["AuditId"]).collect())
        want = sorted((r["AuditId"], r["access_count"]) for r in audit.excessive_access(spark.createDataFrame(rows, schema), 1).collect())
        assert got == want and len(want) > 10

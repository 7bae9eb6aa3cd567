"""Files, merging, reconciliation and parsing."""

import datetime as dt
import json
import re

import pytest
from pyspark.sql import functions as F

from veriloom.functions import backoff, hashing, parse
from veriloom.operators import queue
from veriloom.operators import reconcile as rc
from veriloom.session import work_dir
from veriloom.sources import claims, files, merge


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_upsert_twice_equals_once(spark):
    def hashed(data):
        df = spark.createDataFrame(data, "k int, v string")
        return df.withColumn("_row_hash", hashing.row_hash(df))

    target, source = hashed([(1, "a"), (2, "b")]), hashed([(2, "c"), (3, "d")])
    once = merge.upsert(target, source, ["k"])
    assert [(r["k"], r["v"]) for r in once.orderBy("k").collect()] == [(1, "a"), (2, "c"), (3, "d")]
    assert rows(merge.upsert(once, source, ["k"])) == rows(once)
    assert rows(merge.upsert(None, source, ["k"])) == rows(source)


def test_changes_net_and_apply(spark):
    log = spark.createDataFrame([(1, 2, 10, "a"), (2, 3, 10, "a"), (3, 4, 10, "b"), (4, 1, 11, None), (5, 2, 12, "x"), (6, 1, 12, None)],
                                "seq long, op int, k int, v string")
    target = spark.createDataFrame([(11, "old"), (13, "keep")], "k int, v string")
    assert rows(merge.apply_changes(target, log, ["k"])) == [(10, "b"), (13, "keep")]
    assert {r["k"]: r["OperationType"] for r in merge.net_changes(log, ["k"], None, 5).collect()} == {10: "Update", 11: "Delete", 12: "Insert"}


def test_scd2_closes_and_opens(spark):
    t0, t1 = dt.datetime(2020, 1, 1), dt.datetime(2024, 1, 1)
    dim = spark.createDataFrame([(1, "a", t0, None, True), (2, "b", t0, None, True)],
                                "k int, v string, EffectiveDate timestamp_ntz, EndDate timestamp_ntz, IsCurrent boolean")
    new = spark.createDataFrame([(1, "a"), (2, "B"), (3, "c")], "k int, v string")
    out = merge.scd2_apply(dim, new, "k", ["v"], F.lit(t1))
    assert rows(out) == sorted([(1, "a", t0, None, True), (2, "b", t0, t1, False), (2, "B", t1, None, True), (3, "c", t1, None, True)], key=repr)
    again = merge.scd2_apply(out, new, "k", ["v"], F.lit(dt.datetime(2025, 1, 1)))
    assert rows(again) == rows(out)


def test_watermark_is_inserted_or_replaced(spark):
    w = spark.createDataFrame([("A", 1, 1, 5)], "TableName string, WatermarkValue int, LastProcessedDate int, ProcessedRowCount long")
    assert rows(merge.set_watermark(w, "A", F.lit(9), F.lit(3))) == [("A", 9, 3, 5)]
    assert rows(merge.set_watermark(w, "B", F.lit(9), F.lit(3))) == [("A", 1, 1, 5), ("B", 9, 3, 0)]


@pytest.fixture(scope="module")
def pair(spark):
    data = [(i, f"n{i % 5}", float(i) / 7) for i in range(50)]
    schema = "k int, name string, amount double"
    make = lambda d: spark.createDataFrame(d, schema)
    return data, make


def test_reconcile_statuses(spark, pair):
    data, make = pair
    source = make(data)

    def status(target):
        return rc.reconcile(source, make(target), ["amount"]).first()

    assert status(data)["status"] == "SUCCESS"
    assert status(list(reversed(data)))["status"] == "SUCCESS"
    assert status(data[1:])["status"] == "FAILED"
    changed = [(k, "zz" if k == 7 else n, a) for k, n, a in data]
    got = status(changed)
    assert got["status"] == "PARTIAL" and not got["checksum_match"] and got["key_sums_match"]
    blank = [(k, None if k == 7 else n, a) for k, n, a in data]
    got = status(blank)
    assert got["status"] == "PARTIAL" and any(x.startswith("Null count") for x in got["discrepancies"])
    assert rc.reconcile(source, make(data), ["absent"]).first()["status"] == "PARTIAL"
    only_counts = rc.reconcile(source, make(changed), checks=()).first()
    assert only_counts["status"] == "SUCCESS" and only_counts["row_count_match"]


def test_fast_checksum_sees_repeated_values(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "c string")
    b = spark.createDataFrame([("z",), ("z",), ("y",)], "c string")
    assert not rc.checksums(a, b, fast=True).first()["match"]
    assert not rc.checksums(a, b).first()["match"]


def test_migration_is_all_or_nothing(spark):
    root = work_dir(spark, "lake")
    log = f"{root}/_log"
    good, bad = work_dir(spark, "good"), work_dir(spark, "bad")
    spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string").write.option("header", True).csv(good)
    spark.createDataFrame([("x", "a")], "k string, v string").write.option("header", True).csv(bad)
    files.migrate(spark, good, root, log, "t", schema="k int, v string")
    with pytest.raises(Exception):
        files.migrate(spark, bad, root, log, "t", schema="k int, v string")
    assert rows(files.current_snapshot(spark, log, "t")) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError, match="missing \\['z'\\]"):
        files.migrate(spark, good, root, log, "t", schema="k int, v string", expected=["k", "z"])
    tasks = spark.createDataFrame([("1", good, "u"), ("2", root + "/none", "w")], "task_id string, source_path string, table string")
    got = {r["task_id"]: (r["success"], r["status"]) for r in files.migrate_many(spark, tasks, root, log).collect()}
    assert got == {"1": (True, "COMPLETED"), "2": (False, "FAILED")}


def test_claims_json_document_and_provider_rules(spark, tmp_path):
    record = {"claim_id": "c1", "provider_npi": "1234567890", "service_date": "2024-02-30", "claim_date": "2024-03-01", "billed_amount": 5.5}
    for name, content in (("list", [record, record]), ("object", {"claims": [record]})):
        path = tmp_path / f"{name}.json"
        path.write_text(json.dumps(content, indent=1))
        got = claims.read_claims_json(spark, str(path), multiline=True).collect()
        assert len(got) == (2 if name == "list" else 1)
        assert got[0]["service_date"] is None and got[0]["claim_date"] == dt.date(2024, 3, 1) and got[0]["billed_amount"] == 5.5
    path = tmp_path / "p.csv"
    path.write_text("NPI,PRVDR_LGL_NM\n12345,short\n1234567890,first\n1234567890,last\n")
    assert [(r["npi"], r["legal_business_name"]) for r in claims.read_providers_csv(spark, str(path)).collect()] == [("1234567890", "last")]


@pytest.mark.parametrize("text,money,units", [("$1,234.50", 1234.5, 1), ("", None, None), ("  ", None, None), ("abc", 0.0, 1), ("3.9", 3.9, 3), ("-2", -2.0, -2), ("1e3", 1000.0, 1000)])
def test_lenient_parsing(spark, text, money, units):
    row = spark.createDataFrame([(text,)], "t string").select(parse.parse_money(F.col("t")).alias("m"), parse.parse_units(F.col("t")).alias("u")).first()
    assert row["m"] == money and row["u"] == units


def test_backoff_schedule_and_jitter(spark):
    tasks = spark.createDataFrame([("t",)], "task_id string")
    got = queue.retry_schedule(tasks).orderBy("attempt").collect()
    assert [r["delay_seconds"] for r in got] == [60, 120, 240, 480, 960]
    assert [r["cumulative_minutes"] for r in got] == [1, 3, 7, 15, 31]
    assert queue.total_retry_seconds() == 1860
    df = spark.range(500).select(backoff.exponential(F.lit(2), jitter=0.1, key=F.col("id")).alias("d"))
    values = [r["d"] for r in df.collect()]
    assert 216 <= min(values) < 225 and 255 < max(values) <= 264 and values == [r["d"] for r in df.collect()]


def test_health_orders_its_conditions(spark):
    base = dict(consecutive_failures=0, tasks_in_dlq_last_hour=0, pending_tasks=0, oldest_pending_task_age_minutes=0.0, completed_tasks=0, failed_tasks=0, dead_letter_tasks=0)
    cases = [({}, "HEALTHY"), ({"consecutive_failures": 3, "pending_tasks": 500}, "CRITICAL"), ({"tasks_in_dlq_last_hour": 5}, "CRITICAL"), ({"pending_tasks": 100}, "DEGRADED"),
             ({"oldest_pending_task_age_minutes": 1440.0}, "DEGRADED"), ({"completed_tasks": 94, "failed_tasks": 6}, "DEGRADED"), ({"completed_tasks": 95, "failed_tasks": 5}, "HEALTHY")]
    df = spark.createDataFrame([{**base, **c, "i": i} for i, (c, _) in enumerate(cases)])
    assert [r["health_status"] for r in queue.health_status(df).orderBy("i").collect()] == [w for _, w in cases]


def test_ready_follows_the_retry_time(spark):
    now = dt.datetime(2024, 1, 2)
    data = [("a", "PENDING", None, None), ("b", "RETRY_SCHEDULED", now, None), ("c", "RETRY_SCHEDULED", now + dt.timedelta(seconds=1), None),
            ("d", "READY", None, now + dt.timedelta(hours=1)), ("e", "READY", None, now - dt.timedelta(hours=1)), ("f", "COMPLETED", None, None)]
    df = spark.createDataFrame(data, "task_id string, status string, next_retry_at timestamp_ntz, locked_until timestamp_ntz")
    assert sorted(r["task_id"] for r in queue.ready(df, "2024-01-02 00:00:00").collect()) == ["a", "b", "e"]


def test_incremental_bounds_reach_the_scan(spark, sf):
    df, _ = merge.extract_incremental(files.read_parquet(spark, f"{sf}/orders.parquet"), "o_orderdate", dt.datetime(1999, 1, 1), dt.datetime(2000, 1, 1))
    plan = df.select("o_orderkey")._jdf.queryExecution().toString()
    assert "GreaterThan(o_orderdate" in plan and "o_totalprice" not in plan.split("ReadSchema")[1]


def test_bucketed_merge_leaves_other_folders_alone(spark, tmp_path):
    import glob
    import os

    path = merge.write_bucketed(spark.range(200).selectExpr("id AS k", "id * 2 AS v", "cast(id AS string) AS _row_hash"), f"{tmp_path}/t", ["k"], 16)
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/*/*.parquet")}
    source = spark.createDataFrame([(7, 0, "x"), (500, 1, "y")], "k bigint, v bigint, _row_hash string")
    n = merge.merge_bucketed(spark, path, source, ["k"], lambda t, s: merge.upsert(t, s, ["k"]), 16)
    after = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/*/*.parquet")}
    touched = {os.path.dirname(f) for f in before.keys() ^ after.keys()}
    assert n in (1, 2) and len(touched) == n and all(after[f] == t for f, t in before.items() if os.path.dirname(f) not in touched)
    got = {r.k: r.v for r in merge.read_bucketed(spark, path).collect()}
    assert got == {**{i: 2 * i for i in range(200)}, 7: 0, 500: 1}
    gone = spark.createDataFrame([(i, 1, i) for i in range(200)] + [(500, 1, 1)], "k bigint, op int, seq bigint").selectExpr("k", "op", "seq", "0L AS v", "'' AS _row_hash")
    merge.merge_bucketed(spark, path, gone, ["k"], lambda t, s: merge.apply_changes(t, s, ["k"]), 16)
    assert not glob.glob(f"{path}/bucket=*/*.parquet")


def test_null_key_is_refused(spark):
    source = spark.createDataFrame([(None, "a")], "k int, _row_hash string")
    with pytest.raises(Exception, match="NULL"):
        merge.upsert(source.limit(0), source, ["k"]).collect()


def test_loads_of_a_day_stand_side_by_side(spark, tmp_path):
    df = spark.range(30).selectExpr("id", "date'2024-01-05' AS day")
    for load, part in (("a", df.where("id < 10")), ("b", df.where("id >= 10")), ("a", df.where("id < 10"))):
        path = files.land_bronze(part, f"{tmp_path}/bronze", "t", F.col("day"), load)
        files.append_partitioned(part, f"{tmp_path}/gold", "day", load)
    for p in (path, f"{tmp_path}/gold"):
        assert sorted(r.id for r in spark.read.parquet(p).collect()) == list(range(30))


def test_work_folder_on_a_cluster_must_be_named(spark):
    from veriloom import session

    class Conf:
        def __init__(self, **values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key.replace(".", "_"), default)

    class Fake:
        conf = Conf(spark_master="spark://host:7077")

    with pytest.raises(ValueError, match="share"):
        session.work_dir(Fake, "x")
    Fake.conf = Conf(spark_master="spark://host:7077", spark_checkpoint_dir="hdfs://store/ck")
    assert session.work_dir(Fake, "x").startswith("hdfs://store/ck/x-")


def test_work_tables_are_removed(spark):
    import os

    from veriloom import session

    with session.work(spark):
        path = session.materialise(spark.range(3), "gone").inputFiles()[0]
        folder = os.path.dirname(path.removeprefix("file://").removeprefix("file:"))
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)


def test_differing_rows_are_exactly_the_planted_ones(spark):
    """Repeated and NULL keys, NULL values, another type on the other side, rows whose columns only pair differently."""
    rows = [(i, f"k{i % 3}", float(i), "x") for i in range(300)] + [(None, "k", 1.0, None), (7, "k1", 7.5, "y"), (400, "p", 1.0, "a"), (400, "p", 2.0, "b")]
    other = [r for r in rows if r[0] != 5]
    other = [(r[0], r[1], 99.0 if r[0] == 9 else r[2], None if r[0] == 11 else r[3]) for r in other]
    other = [r for r in other if r[0] != 400] + [(400, "p", 1.0, "b"), (400, "p", 2.0, "a"), (500, "new", 0.0, "x"), (20, "k2", 20.0, "x")]
    source = spark.createDataFrame(rows, "id int, k string, v double, f string")
    target = spark.createDataFrame(other, "id bigint, k string, v double, f string").repartition(5).withColumn("extra", F.lit(1))
    want = {(5, "source_only", 1, 0, ()), (500, "target_only", 0, 1, ()), (9, "changed", 1, 1, ("v",)), (11, "changed", 1, 1, ("f",)),
            (20, "changed", 1, 2, ()), (400, "changed", 2, 2, ())}
    for leaves in (1, 16, 1 << 16):
        got = rc.differing_rows(source, target, ["id", "k"], leaves=leaves).collect()
        assert {(r["id"], r["kind"], r["source_rows"], r["target_rows"], tuple(r["differing_columns"])) for r in got} == want and len(got) == len(want)
    assert rc.differing_rows(source, source.repartition(3), ["id", "k"]).count() == 0
    assert rc.differing_rows(source, source.limit(0), ["id", "k"]).count() == source.select("id", "k").distinct().count()
    assert rc.differing_rows(source.limit(0), source.limit(0), ["id", "k"]).count() == 0


def test_only_folders_of_differences_are_read_again(spark):
    rows = spark.range(2000).select("id", (F.col("id") * 3).alias("v"), F.pmod(F.xxhash64("id"), F.lit(64)).alias("part"))
    changed = rows.withColumn("v", F.when(F.col("id") == 77, 0).otherwise(F.col("v")))
    paths = [work_dir(spark, n) for n in ("left", "right")]
    for df, path in zip((rows, changed), paths):
        df.write.mode("overwrite").partitionBy("part").parquet(path)
    got = rc.differing_rows(*[spark.read.parquet(p) for p in paths], ["id"], folder="part")
    assert [(r["id"], r["kind"], r["differing_columns"]) for r in got.collect()] == [(77, "changed", ["v"])]
    part = rows.where("id = 77").first()["part"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    scans = [f for f in re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", plan) if f]
    assert len(scans) >= 2 and all(f"= {part})" in f for f in scans)

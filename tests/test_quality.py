import datetime as dt
import random

import duckdb
from pyspark.sql import functions as F

from veriloom.functions import parse
from veriloom.operators import conform, marts, quality, rules


def enriched(spark, rows):
    return spark.createDataFrame([(i, t, v, a, g) for i, (t, v, a, g) in enumerate(rows)],
                                 "ResultId long, TestCode string, ResultValueNumeric double, AgeGroup string, Gender string")


def test_every_reference_range_at_its_edges(spark):
    rows, want = [], []
    for test, group, lo, hi, crit_lo, crit_hi in rules.REFERENCE_RANGES:
        age = "pediatric" if group == "pediatric" else "adult"
        sex = {"adult_male": "M", "adult_female": "F"}.get(group, "M")
        for value, ok in ((lo, True), (hi, True), (lo - 0.001, False), (hi + 0.001, False), (None, None)):
            rows.append((test, None if value is None else float(value), age, sex))
            want.append((ok, value is not None and ((crit_lo is not None and value < crit_lo) or (crit_hi is not None and value > crit_hi))))
        for bound, step in ((crit_lo, -0.001), (crit_hi, 0.001)):
            if bound is not None:
                rows += [(test, float(bound), age, sex), (test, bound + step, age, sex)]
                want += [(lo <= bound <= hi, False), (False, True)]
    got = quality.reference_range(enriched(spark, rows)).orderBy("ResultId").collect()
    assert [(r["ReferenceRangeValid"], r["IsCriticalValue"]) for r in got] == want


def test_unknown_tests_and_sexes_have_no_range(spark):
    got = quality.reference_range(enriched(spark, [("SODIUM", 140.0, "adult", "M"), ("CREATININE", 1.0, "adult", None)])).collect()
    assert all(r["ReferenceRangeValid"] is None and not r["IsCriticalValue"] for r in got)


def test_loinc_shapes(spark):
    lab = spark.createDataFrame([(i, t) for i, t in enumerate("abcde")], "ResultId long, TestCode string")
    tests = spark.createDataFrame([("a", "2345-7"), ("b", "123-4"), ("c", "2345-77"), ("d", None)], "TestCode string, LoincCode string")
    got = quality.loinc(lab, tests).orderBy("ResultId").collect()
    assert [(r["LoincValid"], r["LoincFormatValid"]) for r in got] == [(True, True), (True, False), (True, False), (False, True), (False, True)]


def test_messages_have_no_stray_separators(spark):
    lab = spark.createDataFrame([(1, "GLUCOSE", 900.0), (2, "GLUCOSE", 90.0)], "ResultId long, TestCode string, ResultValueNumeric double")
    got = {r["ResultId"]: r["PlausibilityIssues"] for r in quality.plausibility(lab).collect()}
    assert got == {1: "Value outside physiological range 0-700", 2: ""}


def test_rule_tables_are_broadcast_without_cross_joins(spark):
    lab = spark.createDataFrame([(1, "GLUCOSE", 900.0)], "ResultId long, TestCode string, ResultValueNumeric double")
    plan = quality.plausibility(lab)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_delta_check_counts_calendar_days(spark):
    day = dt.datetime(2024, 1, 1, 23, 0)
    rows = [(1, 1, "GLUCOSE", 100.0, day), (2, 1, "GLUCOSE", 160.0, day + dt.timedelta(hours=2)), (3, 1, "GLUCOSE", 80.0, day + dt.timedelta(days=5)),
            (4, 1, "GLUCOSE", 0.0, day + dt.timedelta(days=6)), (5, 1, "GLUCOSE", 90.0, day + dt.timedelta(days=6, hours=1))]
    lab = spark.createDataFrame(rows, "ResultId long, PatientId long, TestCode string, ResultValueNumeric double, ResultDate timestamp_ntz")
    got = {r["ResultId"]: (r["DeltaCheckPass"], r["PercentChange"]) for r in quality.delta_check(lab).collect()}
    assert got[1] == (True, None) and got[2] == (False, 60.0) and got[3] == (True, 50.0)
    assert got[4] == (False, 100.0) and got[5] == (True, None)


def test_doubles_round_as_the_sql_does(spark):
    con = duckdb.connect()
    rng = random.Random(3)
    values = [1.005, 2.675, 0.285, -1.005, -0.04, 0.5, -0.5, 1e300, 123456.0, None, 0.0] + [rng.randrange(1, 10**7) / 10 ** 5 * (1 + 2.0 ** -52 * rng.randrange(-3, 4)) for _ in range(3000)]
    con.execute("CREATE TABLE t (i BIGINT, v DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(values)))
    df = spark.createDataFrame(list(enumerate(values)), "i long, v double")
    got = df.select("i", *[parse.round_half_away(F.col("v"), k).alias(f"r{k}") for k in (1, 2, 4)]).orderBy("i").collect()
    assert [tuple(r) for r in got] == con.execute("SELECT i, round(v, 1), round(v, 2), round(v, 4) FROM t ORDER BY i").fetchall()


def test_delta_check_text_rounds_as_the_sql_does(spark):
    # many changes lie near a tie of the first decimal
    con = duckdb.connect()
    day = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(1, 4000):
        a, b = round(0.5 + i * 0.0125, 4), round((0.5 + i * 0.0125) * (1.6005 + (i % 97) * 0.001), 4)
        rows += [(2 * i, i, "GLUCOSE", a, day), (2 * i + 1, i, "GLUCOSE", b, day + dt.timedelta(hours=1))]
    lab = spark.createDataFrame(rows, "ResultId long, PatientId long, TestCode string, ResultValueNumeric double, ResultDate timestamp_ntz")
    got = {r["ResultId"]: r["DeltaCheckIssues"].split()[2] for r in quality.delta_check(lab).where("NOT DeltaCheckPass").collect()}
    con.execute("CREATE TABLE t (i BIGINT, a DOUBLE, b DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?)", [(rows[k + 1][0], rows[k][3], rows[k + 1][3]) for k in range(0, len(rows), 2)])
    want = dict(con.execute("SELECT i, CAST(CAST(round(abs((b - a) / a * 100), 1) AS DECIMAL(18,1)) AS VARCHAR) || '%' FROM t").fetchall())
    assert len(got) > 3000 and got == {k: want[k] for k in got}


def test_growth_just_below_zero_keeps_its_sign(spark):
    days = [(dt.datetime(2024, 1, 5),)] * 4000 + [(dt.datetime(2024, 2, 5),)] * 3999 + [(dt.datetime(2024, 3, 5),)] * 4000
    got = marts.kpi_month_over_month(spark.createDataFrame(days, "d timestamp_ntz"), "d").orderBy("month").collect()
    assert [r["growth_text"] for r in got] == ["0.0%", "-0.0%", "0.0%"]


def test_dedupe_is_idempotent(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 5)], "k int, m int")
    once = conform.dedupe_latest(df, ["k"], [F.col("m").desc()])
    twice = conform.dedupe_latest(once, ["k"], [F.col("m").desc()])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [(1, 2), (2, 5)]


def test_conform_casts_leniently_and_passes_unknown_tables(spark):
    raw = spark.createDataFrame([("7", "x", "abc")], "ResultId string, TestCode string, ResultValueNumeric string")
    row = conform.conform(raw, conform.SCHEMAS["LabResults"]).first()
    assert row["ResultId"] == 7 and row["ResultValueNumeric"] is None and row["Comments"] is None
    assert conform.conform(raw, None).columns == raw.columns


def test_latest_two_with_a_single_result(spark):
    rows = [(1, "A", 1, dt.datetime(2024, 1, 1), 5.0), (1, "B", 2, dt.datetime(2024, 1, 1), 1.0), (1, "B", 3, dt.datetime(2024, 1, 2), 2.0)]
    df = spark.createDataFrame(rows, "PatientId int, TestCode string, ResultId int, ResultDate timestamp_ntz, ResultValueNumeric double")
    got = {r["TestCode"]: (r["CurrentValue"], r["PreviousValue"]) for r in marts.latest_two(df).collect()}
    assert got == {"A": (5.0, None), "B": (2.0, 1.0)}

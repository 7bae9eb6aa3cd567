import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from veriloom.operators import fraud
from veriloom.plans import fraud as plan
from veriloom.sources import claims as claim_files

COLUMNS = ("claim_id string, provider_npi string, beneficiary_id string, service_date date, hcpcs_code string, billed_amount double, "
           "units int, ordering_physician_npi string")


def claims(spark, rows):
    full = [(r.get("id", f"c{i}"), r.get("npi", "1234567890"), r.get("bene", f"b{i}"), r.get("day"), r.get("code", "E0601"), r.get("amount", 300.0),
             r.get("units", 1), r.get("doc")) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, COLUMNS)


def test_upcoding_flags_the_outlier(spark):
    rows = []
    for i, high in enumerate([3, 5, 4, 6, 5, 7, 4, 8, 5, 6]):
        rows += [{"npi": f"100000000{i}", "code": "K0001"}] * (50 - high) + [{"npi": f"100000000{i}", "code": "K0823"}] * high
    rows += [{"npi": "9999999999", "code": "K0001"}] * 5 + [{"npi": "9999999999", "code": "K0823"}] * 45
    got = fraud.upcoding(claims(spark, rows)).collect()
    assert [(r["provider_npi"], r["fraud_type"]) for r in got] == [("9999999999", "upcoding")]
    assert got[0]["claim_count"] == 50 and got[0]["observed_value"] == pytest.approx(90.0)


def test_upcoding_single_provider_has_no_deviation(spark):
    assert fraud.upcoding(claims(spark, [{"code": "K0823"}] * 12)).count() == 0


def test_phantom_day(spark):
    df = claims(spark, [{"day": dt.date(2024, 6, 15)}] * 100)
    got = fraud.phantom(df).first()
    assert (got["observed_value"], got["risk_level"], got["claim_count"]) == (100.0, "high", 100)
    assert got["confidence_score"] == pytest.approx(0.95) and got["priority_score"] == 79
    assert fraud.alert_claims(df, fraud.phantom(df)).count() == 100


def test_volume_spike(spark):
    rows = []
    for m, n in enumerate([18, 22, 19, 21, 20, 23, 17, 24, 19, 22], start=1):
        rows += [{"day": dt.date(2024, m, 15)}] * n
    rows += [{"day": dt.date(2024, 11, 15), "code": "A4352"}] * 300
    df = claims(spark, rows)
    got = [r for r in fraud.volume_spike(df, 2.0).collect() if r["period"] == "2024-11"]
    assert len(got) == 1 and got[0]["risk_level"] == "critical" and "2024-11" in got[0]["description"]
    assert fraud.alert_claims(df, fraud.volume_spike(df, 2.0)).count() == 300


def test_volume_spike_exactly_at_the_limit_is_none(spark):
    # whole numbers whose z is exactly 3; a running deviation gives 3.0000000000000004 for some of them
    cases = []
    for k in range(3, 10):
        for past in itertools.product(range(1, 6), repeat=min(k, 4)):
            past = list(past) + [3] * (k - len(past))
            square = k * sum(x * x for x in past) - sum(past) ** 2
            for n in range(4, 14):
                if square and (k * n - sum(past)) ** 2 * (k - 1) == 9 * k * square:
                    cases.append((past, n))
    rows = [(f"p{i}", f"2024-{m + 1:02d}", x, 0) for i, (past, n) in enumerate(cases) for m, x in enumerate([*past, n])]
    months = spark.createDataFrame(rows, "provider_npi string, month string, n bigint, risky bigint")
    assert len(cases) > 50
    base = fraud.running_baseline(months)
    at = {(f"p{i}", f"2024-{len(past) + 1:02d}") for i, (past, _) in enumerate(cases)}
    found = {(r["provider_npi"], r["period"]) for r in fraud.volume_spike_of(months).collect()}
    assert not found & at
    assert {r["z"] for r in base.collect() if (r["provider_npi"], r["month"]) in at} == {3.0}


def test_kickback_share(spark):
    rows = [{"npi": "SUPPLIER01", "doc": "DOCTOR0001"}] * 80 + [{"npi": "SUPPLIER01", "doc": f"DOCTOR{i + 2:04d}"} for i in range(20)]
    got = fraud.kickback(claims(spark, rows), 0.5).collect()
    assert len(got) == 1 and got[0]["description"].startswith("80.0%") and got[0]["risk_level"] == "medium"


def test_hit_and_run(spark):
    rows = []
    for i in range(10):
        for m in range(1, 7):
            rows += [{"npi": f"ESTAB{i:05d}", "day": dt.date(2024, m, 15), "amount": 200.0}] * 10
    for m in range(4, 7):
        rows += [{"npi": "NEWPROV001", "day": dt.date(2024, m, 15), "amount": 500.0}] * 100
    got = fraud.hit_and_run(claims(spark, rows), "2024-07-01", 6, 80.0).collect()
    assert "NEWPROV001" in {r["provider_npi"] for r in got}
    assert {r["fraud_type"] for r in got} == {"hit_and_run"}


def test_unit_price_and_high_value(spark):
    df = fraud.with_derived(claims(spark, [{"amount": 1000.0, "units": 5}, {"amount": 500.0}, {"amount": 1500.0, "units": 0}]))
    assert [(r["unit_price"], r["is_high_value"]) for r in df.orderBy("claim_id").collect()] == [(200.0, True), (500.0, False), (0.0, True)]


def test_few_claims_are_noted_and_still_judged(spark):
    rows = [{"id": str(i), "day": dt.date(2024, 1, 1)} for i in range(60)]
    result = plan.run(claims(spark, rows), "2024-07-01", detectors=["phantom"], min_claims=100)
    assert [tuple(r) for r in result.notes.collect()] == [("TOO_FEW_CLAIMS", "60 of 100")]
    assert result.alerts.count() == 1 and result.links.count() == 60
    assert plan.run(claims(spark, rows), "2024-07-01", detectors=["phantom"]).notes.count() == 0


def test_pipeline_switches_filters_and_caps(spark):
    rows = [{"id": f"{d}-{i}", "day": dt.date(2024, 1, d)} for d in range(1, 15) for i in range(60)] + [{"amount": -1.0}, {"npi": ""}]
    result = plan.run(claims(spark, rows), "2024-07-01", detectors=["phantom", "kickback"], per_provider=10)
    got = result.alerts.collect()
    assert len(got) == 10 and {r["detector_name"] for r in got} == {"PhantomBillingDetector"}
    assert fraud.high_priority(result.alerts, 70).count() == 10
    assert fraud.alerts_of_provider(result.alerts, "1234567890").count() == 10
    total = {(r["section"], r["item"]): r["value"] for r in result.summary.collect()}
    assert total[("total_alerts", None)] == 10 and total[("flagged_claims_count", None)] == 600
    assert total[("claims_analyzed", None)] == 840
    strict = plan.run(claims(spark, rows), "2024-07-01", detectors=["phantom"], confidence=0.99, with_summary=False)
    assert strict.alerts.count() == 0


def test_custom_detector_is_used_and_errors_surface(spark):
    def broken(c, p):
        raise RuntimeError("boom")

    fraud.register_detector("broken", broken)
    try:
        with pytest.raises(RuntimeError, match="boom"):
            fraud.run_detectors(claims(spark, [{}] * 3), {"as_of": "2024-01-01"}, ["broken"])
    finally:
        fraud.remove_detector("broken")


def test_percentile_rank_counts_strictly_below(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 2.0, 4.0)], "v double")
    assert sorted(r["percentile_rank"] for r in fraud.percentile_rank(df, "v").collect()) == [0.0, 25.0, 25.0, 75.0]


def test_percentile_rank_numbers_ties_apart(spark):
    df = spark.createDataFrame([("c", 2.0), ("a", 2.0), ("b", 1.0), ("d", None), ("e", 5.0)], "k string, v double")
    got = {r["k"]: r["percentile_rank"] for r in fraud.percentile_rank(df, "v", ties=["k"]).collect()}
    assert got == {"b": 0.0, "a": 25.0, "c": 50.0, "e": 75.0, "d": None}


def test_beneficiary_profiles_hold_one_row_per_pair(spark):
    codes = ["E0601", "K0001", "E0601", "Z9999", "K0001", None]
    rows = [{"bene": b, "npi": n, "code": c} for b, n in (("x", "1"), ("x", "2"), ("y", None), (None, "1")) for c in codes]
    df = claims(spark, rows)
    found = fraud.beneficiary_profiles(df)
    assert "Expand" not in found._jdf.queryExecution().optimizedPlan().toString()
    got = {r["beneficiary_id"]: (r["total_claims"], r["unique_providers"], r["distinct_equipment_types"]) for r in found.collect()}
    assert got == {"x": (12, 2, 2), "y": (6, 0, 2), None: (6, 1, 2)}


@pytest.mark.parametrize("n", [25, 0])
def test_alerts_sink_holds_the_summary_too(spark, tmp_path, n):
    """One supplier with five claims on a day and one on each other day; then no claims at all, where the summary says so."""
    lines = [(i, 1, i, 7, 2.0, 100.0 + i, dt.date(2001, 12, max(5, i))) for i in range(1, n + 1)]
    spark.createDataFrame(lines, "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double, l_shipdate date").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(i, i) for i in range(30)], "o_orderkey bigint, o_custkey bigint").write.parquet(f"{tmp_path}/orders.parquet")
    got = entry.queries()["alerts_sink"](spark, str(tmp_path)).collect()
    alerts = [r for r in got if r["section"] == "alerts"]
    told = {(r["section"], r["item"]): r["value"] for r in got if r["section"] != "alerts"}
    assert {r["fraud_type"] for r in alerts} >= ({"phantom_billing"} if n else set()) and {r["provider_npi"] for r in alerts} == ({"0000000007"} if n else set())
    assert told[("total_alerts", None)] == len(alerts) and told[("claims_analyzed", None)] == n and told[("providers_analyzed", None)] == min(n, 1)
    assert told[("flagged_claims_count", None)] == (5 if n else 0)
    assert told == {(r["section"], r["item"]): r["value"] for r in entry.queries()["alert_summary"](spark, str(tmp_path)).collect()}


def test_a_run_is_read_as_it_was_written(spark, tmp_path):
    rows = [{"id": str(i), "day": dt.date(2024, 1, 1)} for i in range(60)]
    for few, n in ((rows, 1), (rows[:3], 0)):
        result = plan.run(claims(spark, few), "2024-07-01", detectors=["phantom"], min_claims=100)
        path = claim_files.write_run(result.alerts.withColumn("created_at", F.lit("2024-07-01")), result.summary, result.notes, f"{tmp_path}/{n}")
        got = claim_files.read_run(spark, path)
        notes = [r["item"] for r in got.where("section = 'notes'").collect()]
        assert notes == [f"TOO_FEW_CLAIMS {len(few)} of 100"] and got.where("section = 'alerts'").count() == n
        names = list(claim_files.ALERT_SCHEMA.names)[:-1]
        assert got.where("section = 'alerts'").select(names).collect() == result.alerts.select(names).collect()
        own = lambda df: {tuple(r) for r in df.select("section", "item", "value").collect()}
        assert own(got.where("section not in ('alerts', 'notes')")) == own(result.summary)

"""Gold marts, star schema and the unified patient view."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veriloom.functions.parse import fixed_text, safe_ratio
from veriloom.operators.dates import date_key, time_key
from veriloom.operators.skew import exact_percentiles, latest_per_key

ABNORMAL = ("H", "L", "HH", "LL")


def surrogate(*parts: Column) -> Column:
    """Repeatable 60-bit key from natural key columns; needs no global numbering."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[p.cast("string") for p in parts])), 1, 15), 16, 10).cast("bigint")


def validated(lab: DataFrame, validation: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Results with stored validation and anomaly results; critical flag taken from validation."""
    v = validation.select("ResultId", "ReferenceRangeValid", "IsCriticalValue", "TemporalConsistencyValid", "SpecimenValid")
    a = anomalies.select("ResultId", "IsAnomaly", "AnomalyScore")
    return (lab.join(v, "ResultId", "left").join(a, "ResultId", "left")
            .withColumn("CriticalFlag", F.coalesce("IsCriticalValue", F.lit(False)))
            .withColumn("IsAnomaly", F.coalesce("IsAnomaly", F.lit(False))).drop("IsCriticalValue"))


def latest_two(lab: DataFrame) -> DataFrame:
    """Current and previous value per patient and test, by result date."""
    two = latest_per_key(lab.select("PatientId", "TestCode", "ResultDate", "ResultId", "ResultValueNumeric"),
                         ["PatientId", "TestCode"], [F.col("ResultDate").desc(), F.col("ResultId").desc()], 2)
    at = F.struct("ResultDate", "ResultId")
    return two.groupBy("PatientId", "TestCode").agg(
        F.max_by("ResultValueNumeric", at).alias("CurrentValue"),
        F.when(F.count("*") > 1, F.min_by("ResultValueNumeric", at)).alias("PreviousValue"))


def trend_direction(change: Column) -> Column:
    return F.when(change > 10, "Increasing").when(change < -10, "Decreasing").otherwise("Stable")


def patient_test_summary(lab: DataFrame) -> DataFrame:
    totals = lab.groupBy("PatientId", "TestCode").agg(
        F.count("*").alias("TotalTests"), F.count_if(F.col("AbnormalFlag").isin(*ABNORMAL)).alias("TotalAbnormal"),
        F.count_if("CriticalFlag").alias("TotalCritical"), F.count_if("IsAnomaly").alias("TotalAnomalies"),
        F.min("ResultValueNumeric").alias("MinValue"), F.max("ResultValueNumeric").alias("MaxValue"),
        F.avg("ResultValueNumeric").alias("AvgValue"), F.stddev_samp("ResultValueNumeric").alias("StdDevValue"),
        F.min("ResultDate").alias("FirstTestDate"), F.max("ResultDate").alias("LastTestDate"))
    change = F.when(F.col("PreviousValue") != 0,
                    (F.col("CurrentValue") - F.col("PreviousValue")) / F.col("PreviousValue") * 100)
    return (totals.join(latest_two(lab), ["PatientId", "TestCode"], "left").withColumn("PercentChange", change)
            .withColumn("TrendDirection", trend_direction(F.col("PercentChange"))))


def daily_quality_metrics(lab: DataFrame) -> DataFrame:
    n = F.count("*")

    def rate(c: str) -> Column:
        return F.col(c) / F.col("TotalTests") * 100

    return lab.groupBy(F.to_date("ResultDate").alias("MetricDate"), "PerformingLabId", "TestCode").agg(
        n.alias("TotalTests"), F.count_if("CriticalFlag").alias("CriticalValues"),
        F.count_if("IsAnomaly").alias("AnomalousResults"),
        F.count_if(~F.col("ReferenceRangeValid")).alias("ValidationFailures"),
        F.avg("TurnaroundTimeMinutes").alias("AvgTurnaroundTimeMinutes"),
        F.count_if(F.col("ResultValueNumeric").isNull()).alias("MissingResults"),
    ).withColumns({
        "CriticalValueRate": rate("CriticalValues"), "AnomalyRate": rate("AnomalousResults"),
        "ValidationFailureRate": rate("ValidationFailures"),
        "CompletenessRate": (F.col("TotalTests") - F.col("MissingResults")) / F.col("TotalTests") * 100})


def test_utilization(lab: DataFrame) -> DataFrame:
    return lab.groupBy("TestCode").agg(
        F.count("*").alias("TotalOrders"), F.count("ResultValueNumeric").alias("CompletedResults"),
        F.countDistinct("PatientId").alias("UniquePatients"), F.avg("TurnaroundTimeMinutes").alias("AvgTurnaroundTime"),
        F.count_if("CriticalFlag").alias("CriticalCount"),
    ).withColumn("CompletionRate", F.col("CompletedResults") / F.col("TotalOrders") * 100)


def utilization_with_master(utilization: DataFrame, tests: DataFrame) -> DataFrame:
    return utilization.join(tests, "TestCode", "left")


def critical_alerts(lab: DataFrame) -> DataFrame:
    """Critical rows with severity against their reference range."""
    v = F.col("ResultValueNumeric")
    far = F.coalesce(v < F.col("ReferenceRangeMin") * 0.5, F.lit(False)) | F.coalesce(v > F.col("ReferenceRangeMax") * 2, F.lit(False))
    return lab.where("CriticalFlag").select(
        "ResultId", "PatientId", "TestCode", "ResultValueNumeric", "ResultDate", "PerformingLabId", "ReferenceRangeMin",
        "ReferenceRangeMax", F.when(far, "Critical").otherwise("High").alias("Severity"))


def pending_alerts(enriched: DataFrame, as_of: Column) -> DataFrame:
    return enriched.where("IsCriticalValue").select(
        "ResultId", "PatientId", "TestCode", "TestName", "ResultValueNumeric", "ResultUnit", "ResultDate",
        "PerformingLabId", as_of.alias("AlertGeneratedDate"), F.lit("PENDING").alias("AlertStatus"))


def test_orders(lab: DataFrame) -> DataFrame:
    """One row per order and test: status, turnaround, urgency and recollection marks."""
    o = F.col("OrderId")
    return lab.groupBy("OrderId", "PatientId", "TestCode", "PerformingLabId", F.to_date("ResultDate").alias("OrderDate")).agg(
        F.max("TurnaroundTimeMinutes").alias("TurnaroundTimeMinutes"),
        F.when(F.count("ResultValueNumeric") == F.count("*"), "COMPLETE").otherwise("INCOMPLETE").alias("OrderStatus"),
        F.count_if(F.col("SpecimenQuality") == "Hemolyzed").alias("_hemolyzed"),
    ).withColumn("IsStat", o % 10 == 0).withColumn("IsRecollect", F.col("_hemolyzed") > 0).drop("_hemolyzed")


def quality_metrics_full(lab: DataFrame, orders: DataFrame, sla: int = 240) -> DataFrame:
    """Daily metrics with order counts, median turnaround and share within the agreed minutes.

    Turnaround is whole minutes, so the exact percentile's state is bounded by the distinct minutes.
    """
    keys = ["MetricDate", "PerformingLabId", "TestCode"]
    results = lab.groupBy(F.to_date("ResultDate").alias("MetricDate"), "PerformingLabId", "TestCode").agg(
        F.count("*").alias("TotalTests"), F.count_if("CriticalFlag").alias("CriticalValues"),
        F.count_if("IsAnomaly").alias("AnomalousResults"), F.count_if(~F.col("ReferenceRangeValid")).alias("ValidationFailures"),
        F.avg("TurnaroundTimeMinutes").alias("AvgTurnaroundTimeMinutes"),
        F.percentile("TurnaroundTimeMinutes", 0.5).alias("MedianTurnaroundTimeMinutes"),
        (F.count_if(F.col("TurnaroundTimeMinutes") <= sla) / F.count("*") * 100).alias("PercentMeetingSLA"),
        F.count_if(F.col("ResultValueNumeric").isNull()).alias("MissingResults"))
    placed = orders.groupBy(F.col("OrderDate").alias("MetricDate"), "PerformingLabId", "TestCode").agg(
        F.count("*").alias("TotalOrders"), F.count_if("IsStat").alias("StatOrders"),
        F.count_if("IsRecollect").alias("Recollections"),
        F.count_if(F.col("OrderStatus") == "INCOMPLETE").alias("IncompleteOrders"))
    return results.join(placed, keys, "left")


# ---- star schema -----------------------------------------------------------------------------------

def with_age(patients: DataFrame, as_of: str) -> DataFrame:
    """Age as difference of calendar years, and its group."""
    age = F.year(F.lit(as_of).cast("date")) - F.year("DateOfBirth")
    group = F.when(age < 18, "Pediatric").when(age <= 64, "Adult").otherwise("Senior")
    return patients.withColumns({"Age": age, "AgeGroup": group})


def dim_patient(versions: DataFrame) -> DataFrame:
    return versions.withColumn("PatientKey", surrogate(F.col("PatientId"), F.date_format("EffectiveDate", "yyyyMMdd")))


def dim_test(tests: DataFrame) -> DataFrame:
    return tests.withColumn("TestKey", surrogate(F.col("TestCode")))


def current_rows(dim: DataFrame) -> DataFrame:
    return dim.where("IsCurrent")


def out_of_range() -> Column:
    v = F.col("ResultValueNumeric")
    return F.coalesce((v < F.col("ReferenceRangeMin")) | (v > F.col("ReferenceRangeMax")), F.lit(False)) \
        & F.col("ReferenceRangeMin").isNotNull() & F.col("ReferenceRangeMax").isNotNull()


def fact_derived(fact: DataFrame) -> DataFrame:
    pct = F.when(F.col("ReferenceRangeMax") > 0, F.col("ResultValueNumeric") / F.col("ReferenceRangeMax") * 100)
    return fact.withColumns({"IsOutOfRange": out_of_range(), "PercentOfReferenceRangeMax": pct})


def fact_lab_result(lab: DataFrame, patients: DataFrame, tests: DataFrame) -> DataFrame:
    """Validated results with dimension keys. The patient version is the one in force at the result; keys of
    unknown members are -1. Date and time keys are computed, not looked up."""
    who = patients.select("PatientId", "PatientKey", "EffectiveDate", "EndDate")
    what = tests.select("TestCode", "TestKey")
    at = F.col("l.ResultDate")
    j = lab.alias("l").join(
        who.alias("p"),
        (F.col("l.PatientId") == F.col("p.PatientId")) & (F.col("p.EffectiveDate") <= at)
        & (F.col("p.EndDate").isNull() | (at < F.col("p.EndDate"))), "left")
    j = j.select("l.*", F.coalesce("p.PatientKey", F.lit(-1)).alias("PatientKey")).join(what, "TestCode", "left")
    ordered = F.col("ResultDate") - F.make_interval(mins=F.col("TurnaroundTimeMinutes"))
    return fact_derived(j.withColumns({
        "TestKey": F.coalesce("TestKey", F.lit(-1)),
        "OrderDateKey": date_key(ordered), "ResultDateKey": date_key(F.col("ResultDate")),
        "ResultTimeKey": time_key(F.col("ResultDate")), "LaboratoryKey": F.coalesce("PerformingLabId", F.lit(-1))}))


# fixed values: the labels of the categories below
def result_category() -> Column:
    return (F.when(F.col("CriticalFlag"), "Critical").when(F.col("IsOutOfRange"), "Out of Range")
            .when(F.col("IsAnomaly"), "Anomalous").otherwise("Normal"))


def turnaround_category() -> Column:
    m = F.col("TurnaroundTimeMinutes")
    return F.when(m <= 120, "< 2 hours").when(m <= 240, "2-4 hours").when(m <= 480, "4-8 hours").otherwise("> 8 hours")


def latest_result_per_test(fact: DataFrame) -> DataFrame:
    """The newest final result per patient and test."""
    final = fact.where(F.col("ResultStatus") == "FINAL")
    return latest_per_key(final, ["PatientKey", "TestCode"], [F.col("ResultDate").desc(), F.col("ResultId").desc()])


PIVOT_TESTS = {"GLUCOSE": "Glucose", "HBA1C": "HbA1c", "CREATININE": "Creatinine", "WBC": "WBC", "HEMOGLOBIN": "Hemoglobin"}


def _latest(column: str, code: str) -> Column:
    when = (F.col("TestCode") == code) & (F.col("ResultStatus") == "FINAL")
    return F.max_by(column, F.when(when, F.struct("ResultDate", "ResultId")))


def _pivot_columns() -> list[Column]:
    return [*[_latest("ResultValueNumeric", c).alias(f"Latest_{n}") for c, n in PIVOT_TESTS.items()],
            *[F.to_date(_latest("ResultDate", c)).alias(f"Latest_{n}_Date") for c, n in PIVOT_TESTS.items()]]


def pivot_latest(fact: DataFrame) -> DataFrame:
    """Latest final value and day per patient for the common tests, as one aggregate."""
    return fact.groupBy("PatientKey").agg(*_pivot_columns())


def unified_patient_view(fact: DataFrame, patients: DataFrame) -> DataFrame:
    """Current patients with their latest results and totals. One aggregate brings the facts to one row per patient
    before the join, so the join cannot fan out."""
    per_patient = fact.groupBy("PatientKey").agg(
        *_pivot_columns(), F.countDistinct("TestKey").alias("TotalUniqueTests"), F.count("*").alias("TotalLabResults"),
        F.count_if("CriticalFlag").alias("TotalCriticalValues"), F.count_if("IsAnomaly").alias("TotalAnomalies"),
        F.to_date(F.max("ResultDate")).alias("LastTestDate"))
    return current_rows(patients).join(per_patient, "PatientKey", "left")


def hierarchy_rollup(fact: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Counts along a hierarchy; ``depth`` says how many levels a row carries."""
    return fact.rollup(*levels).agg(
        (F.lit(len(levels)) - F.bit_count(F.grouping_id())).cast("int").alias("depth"),
        F.count("*").alias("n_results"), F.count_if("CriticalFlag").alias("n_critical"))


# ---- key figures -----------------------------------------------------------------------------------

def _share(cond: Column) -> Column:
    return safe_ratio(F.count_if(cond), F.count("*"))


def kpi_volume(fact: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return fact.groupBy(*by).agg(
        F.count("*").alias("total_results"), F.countDistinct("PatientKey").alias("total_patients"),
        F.countDistinct("TestKey").alias("total_tests"), F.countDistinct("OrderId").alias("total_orders"))


def kpi_rates(fact: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    crit, out, odd = F.col("CriticalFlag"), F.col("IsOutOfRange"), F.col("IsAnomaly")
    return fact.groupBy(*by).agg(
        F.count_if(crit).alias("critical_values"), _share(crit).alias("critical_rate"),
        F.count_if(out).alias("out_of_range"), _share(out).alias("out_of_range_rate"),
        F.count_if(odd).alias("anomalous"), _share(odd).alias("anomaly_rate"), F.avg("AnomalyScore").alias("avg_anomaly_score"))


def kpi_turnaround(fact: DataFrame, by: Sequence[str] = (), sla: int = 240) -> DataFrame:
    """Hours on average and at the median (exact: whole minutes bound its state), share within the agreement."""
    m = F.col("TurnaroundTimeMinutes")
    df = fact.groupBy(*by).agg(
        F.coalesce(F.avg(m) / 60, F.lit(0.0)).alias("avg_hours"),
        F.coalesce(F.percentile(m, 0.5) / 60, F.lit(0.0)).alias("median_hours"), _share(m <= sla).alias("sla_share"))
    return df.withColumn("tat_display", F.concat(fixed_text(F.col("avg_hours"), 1), F.lit(" hrs")))


def kpi_to_date(fact: DataFrame, date_col: str) -> DataFrame:
    """Daily count with month-to-date and year-to-date totals; windows run over days, not rows."""
    day = fact.groupBy(F.to_date(date_col).alias("day")).agg(F.count("*").alias("results"))
    month = W.partitionBy(F.trunc("day", "month")).orderBy("day")
    year = W.partitionBy(F.trunc("day", "year")).orderBy("day")
    return day.select("day", "results", F.sum("results").over(month).alias("mtd"), F.sum("results").over(year).alias("ytd"))


def _monthly(fact: DataFrame, date_col: str) -> DataFrame:
    return fact.groupBy(F.trunc(F.to_date(date_col), "month").alias("month")).agg(F.count("*").alias("results"))


# fixed values: the labels of trends
def trend_indicator(growth: Column) -> Column:
    return F.when(growth > 0.1, "↑ Growing").when(growth < -0.1, "↓ Declining").otherwise("→ Stable")


def _against(fact: DataFrame, date_col: str, months_back: int, label: str) -> DataFrame:
    now = _monthly(fact, date_col)
    before = now.select(F.add_months("month", months_back).alias("month"), F.col("results").alias(label))
    both = now.join(before, "month", "left")
    growth = safe_ratio(F.col("results") - F.coalesce(F.col(label), F.lit(0)), F.col(label))
    return both.withColumn("growth", growth)


def kpi_month_over_month(fact: DataFrame, date_col: str) -> DataFrame:
    df = _against(fact, date_col, 1, "previous_month")
    return df.withColumns({"growth_text": F.concat(fixed_text(F.col("growth") * 100, 1), F.lit("%")),
                           "trend": trend_indicator(F.col("growth"))})


def kpi_year_over_year(fact: DataFrame, date_col: str) -> DataFrame:
    return _against(fact, date_col, 12, "same_month_last_year")


def kpi_patient(fact: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Tests per patient, mean rows per patient-day, patients with a critical value. One row per patient-day
    is formed first, so no group's rows meet in one task."""
    days = fact.groupBy(*by, "PatientKey", "ResultDateKey").agg(
        F.count("*").alias("n"), F.max(F.col("CriticalFlag").cast("int")).alias("c"))
    people = days.groupBy(*by, "PatientKey").agg(F.sum("n").alias("n"), F.count("*").alias("d"), F.max("c").alias("c"))
    return people.groupBy(*by).agg(
        safe_ratio(F.sum("n"), F.count("*")).alias("tests_per_patient"),
        safe_ratio(F.sum("n"), F.sum("d")).alias("avg_tests_per_patient_day"), F.sum("c").alias("patients_with_critical"))


def kpi_test(fact: DataFrame) -> DataFrame:
    """The most common test (ties: first code) and results / (patients x tests)."""
    per_test = fact.groupBy("TestCode").agg(F.count("*").alias("n"))
    top = per_test.orderBy(F.col("n").desc(), "TestCode").limit(1).select("TestCode")
    sizes = fact.agg(F.count("*").alias("n"), F.countDistinct("PatientKey").alias("p"), F.countDistinct("TestKey").alias("t"))
    return sizes.select(top.scalar().alias("most_common_test"),
                        safe_ratio(F.col("n"), F.col("p") * F.col("t")).alias("utilization_rate"))


def kpi_validation(fact: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    r, t, s = F.col("ReferenceRangeValid"), F.col("TemporalConsistencyValid"), F.col("SpecimenValid")
    return fact.groupBy(*by).agg(
        _share(r & t & s).alias("validation_pass_rate"), F.count_if(~r).alias("range_violations"),
        F.count_if(~t).alias("temporal_issues"), F.count_if(~s).alias("specimen_issues"))


def kpi_percentiles(fact: DataFrame, by: Sequence[str] = (), qs: Sequence[float] = (.5, .95, .99), exact: bool = True) -> DataFrame:
    """Inclusive percentiles of the value; ``exact=False`` uses one mergeable sketch pass."""
    names = {f"p{round(q * 100)}": q for q in qs}
    if exact:
        return exact_percentiles(fact, by, "ResultValueNumeric", names)
    return fact.groupBy(*by).agg(*[F.percentile_approx("ResultValueNumeric", q, 10_000).alias(n) for n, q in names.items()])


def kpi_completeness(fact: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    v = F.col("ResultValueNumeric")
    whole = v.isNotNull() & F.col("ResultDateKey").isNotNull() & (F.col("PatientKey") != -1)
    return fact.groupBy(*by).agg(_share(whole).alias("completeness"), F.count_if(v.isNull()).alias("missing_values"))


def kpi_daily_volume(fact: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    day = fact.groupBy(*by, "ResultDateKey").agg(F.count("*").alias("n"))
    return day.groupBy(*by).agg(F.avg("n").alias("avg_daily_volume"), F.max("n").alias("peak_daily_volume"))


def kpi_quality_score(fact: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    ok = F.col("ReferenceRangeValid") & F.col("TemporalConsistencyValid") & F.col("SpecimenValid")
    score = (_share(ok) * 0.4 + (F.lit(1.0) - _share(F.col("CriticalFlag"))) * 0.3
             + (F.lit(1.0) - _share(F.col("IsAnomaly"))) * 0.3)
    return fact.groupBy(*by).agg(score.alias("quality_score"))


def kpi_colors(fact: DataFrame, by: Sequence[str] = (), sla: int = 240) -> DataFrame:
    crit, met = F.col("critical_rate"), F.col("sla_share")
    df = fact.groupBy(*by).agg(_share(F.col("CriticalFlag")).alias("critical_rate"),
                               _share(F.col("TurnaroundTimeMinutes") <= sla).alias("sla_share"))
    return df.withColumns({
        "critical_color": F.when(crit > 0.05, "Red").when(crit > 0.02, "Yellow").otherwise("Green"),
        "turnaround_color": F.when(met < 0.80, "Red").when(met < 0.90, "Yellow").otherwise("Green")})


def kpi_dashboard(fact: DataFrame, by: Sequence[str] = (), sla: int = 240) -> DataFrame:
    """The additive key figures of one refresh in a single pass over the facts."""
    m = F.col("TurnaroundTimeMinutes")
    r, t, s = F.col("ReferenceRangeValid"), F.col("TemporalConsistencyValid"), F.col("SpecimenValid")
    return fact.groupBy(*by).agg(
        F.count("*").alias("total_results"), F.countDistinct("PatientKey").alias("total_patients"),
        F.count_if("CriticalFlag").alias("critical_values"), _share(F.col("CriticalFlag")).alias("critical_rate"),
        _share(F.col("IsOutOfRange")).alias("out_of_range_rate"), _share(F.col("IsAnomaly")).alias("anomaly_rate"),
        (F.avg(m) / 60).alias("avg_hours"), (F.percentile(m, 0.5) / 60).alias("median_hours"), _share(m <= sla).alias("sla_share"),
        _share(r & t & s).alias("validation_pass_rate"), F.count_if(~r).alias("range_violations"),
        F.count_if(F.col("ResultValueNumeric").isNull()).alias("missing_values"))

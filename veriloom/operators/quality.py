"""Validation of laboratory results and data-quality scores."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriloom.functions import moments
from veriloom.functions.parse import join_issues, round_half_away, safe_ratio
from veriloom.operators import rules as R
from veriloom.operators.conform import unpivot
from veriloom.operators.skew import previous_row


def enrich(lab: DataFrame, patients: DataFrame, tests: DataFrame) -> DataFrame:
    """Results with birth date, gender, test name, LOINC and category. ``tests`` is a rule-sized catalogue and
    carries its own broadcast hint; the patients' join is left to adaptive execution."""
    who = patients.select("PatientId", "DateOfBirth", "Gender")
    what = tests.select("TestCode", "TestName", "LoincCode", "TestCategory")
    return age_at_test(lab.join(who, "PatientId", "left").join(what, "TestCode", "left"))


def age_at_test(df: DataFrame) -> DataFrame:
    """Age in years at the result, by days / 365.25 cut to an integer, and its group."""
    age = (F.datediff("ResultDate", "DateOfBirth") / F.lit(365.25)).cast("int")
    return df.withColumn("AgeAtTest", age).withColumn(
        "AgeGroup", F.when(F.col("AgeAtTest") < 18, "pediatric").otherwise("adult"))


def reference_range(enriched: DataFrame, rules=None) -> DataFrame:
    """ReferenceRangeValid (NULL without rule or value), IsCriticalValue, RangeMessage: one broadcast join."""
    ranges = R.reference_ranges(enriched.sparkSession, rules)
    sexed = F.when(F.col("Gender") == "M", "adult_male").when(F.col("Gender") == "F", "adult_female")
    group = F.col("AgeGroup")
    df = enriched.withColumn("_sexed", F.when(group == "adult", sexed))
    j = df.alias("d").join(
        ranges.withColumnRenamed("TestCode", "_rt"),
        (F.col("TestCode") == F.col("_rt"))
        & ((F.col("RangeGroup") == F.col("AgeGroup")) | (F.col("RangeGroup") == F.col("_sexed"))), "left")
    x = F.col("ResultValueNumeric")
    valid = F.when(x.isNotNull(), x.between(F.col("RuleMin"), F.col("RuleMax")))
    critical = F.coalesce(x < F.col("CriticalLow"), F.lit(False)) | F.coalesce(x > F.col("CriticalHigh"), F.lit(False))
    message = F.when(~valid, F.concat(F.lit("Out of range for "), F.col("TestCode"), F.lit(" ("), F.col("RangeGroup"),
                                      F.lit("): expected "), F.col("RangeText")))
    return j.select("d.*", valid.alias("ReferenceRangeValid"), critical.alias("IsCriticalValue"),
                    message.alias("RangeMessage")).drop("_sexed")


def with_previous(lab: DataFrame, bucket_seconds: int = 7 * 86400, stats: dict[str, Column] | None = None) -> DataFrame:
    """The patient's preceding result of the same test and the change in percent (NULL if it was zero)."""
    df = previous_row(lab, ["PatientId", "TestCode"], ["ResultDate", "ResultId"],
                      ["ResultValueNumeric", "ResultDate"], bucket_seconds, stats=stats)
    prev = F.col("_prev.ResultValueNumeric")
    change = F.when(prev != 0, F.abs((F.col("ResultValueNumeric") - prev) / prev * 100))
    return df.withColumns({
        "PreviousResult": prev, "PreviousResultDate": F.col("_prev.ResultDate"),
        "DaysSincePrevious": F.datediff("ResultDate", F.col("_prev.ResultDate")),
        "PercentChange": change}).drop("_prev")


def temporal_consistency(with_prev: DataFrame, pct: float = 200, days: int = 7) -> DataFrame:
    """False where a result moved more than ``pct`` percent within ``days`` days."""
    judged = F.col("PercentChange").isNotNull() & (F.col("DaysSincePrevious") <= days)
    ok = F.when(judged, F.col("PercentChange") <= pct).otherwise(F.lit(True))
    return with_prev.withColumn("TemporalConsistencyValid", ok).withColumn(
        "TemporalMessage", F.when(~ok, "Unrealistic temporal change detected"))


def _with_rules(lab: DataFrame, rules=None) -> DataFrame:
    return lab.join(R.lab_rules(lab.sparkSession, rules), "TestCode", "left")


RULE_COLUMNS = ("PhysMin", "PhysMax", "MaxDelta", "DeltaHours", "Units", "Specimens", "TimeSensitive", "PhysText",
                "DeltaText")


# fixed values: the messages of the checks below
def _plausible(df: DataFrame) -> dict[str, Column]:
    x = F.col("ResultValueNumeric")
    ok = F.coalesce(x.between(F.col("PhysMin"), F.col("PhysMax")), F.lit(True))
    issue = F.when(~ok, F.concat(F.lit("Value outside physiological range "), F.col("PhysText")))
    return {"PhysiologicallyPlausible": ok, "PlausibilityIssues": join_issues(issue)}


def _delta(df: DataFrame) -> dict[str, Column]:
    hours = F.col("DaysSincePrevious") * 24
    ok = ~F.coalesce((hours <= F.col("DeltaHours")) & (F.col("PercentChange") > F.col("MaxDelta")), F.lit(False))
    issue = F.when(~ok, F.concat(
        F.lit("Change of "), round_half_away(F.col("PercentChange"), 1).cast("decimal(18,1)").cast("string"), F.lit("% exceeds "),
        F.col("DeltaText"), F.lit("% threshold within "), F.col("DeltaHours").cast("string"), F.lit("h")))
    return {"HoursSincePrevious": hours, "DeltaCheckPass": ok, "DeltaCheckIssues": join_issues(issue)}


def _units(df: DataFrame) -> dict[str, Column]:
    ok = F.coalesce(F.array_contains("Units", F.col("ResultUnit")), F.lit(True))
    issue = F.when(~ok, F.concat(F.lit("Unexpected unit. Expected: "), F.array_join("Units", ", ")))
    return {"UnitValid": ok, "UnitIssues": join_issues(issue)}


def _loinc(df: DataFrame) -> dict[str, Column]:
    code = F.col("AssignedLoincCode")
    shaped = F.coalesce(code.rlike(r"^\d{4,5}-\d$"), F.lit(True))
    issues = join_issues(F.when(code.isNull(), "LOINC code not assigned to test"),
                         F.when(~shaped, "Invalid LOINC code format"))
    return {"LoincValid": code.isNotNull(), "LoincFormatValid": shaped, "LoincIssues": issues}


def _specimen(df: DataFrame) -> dict[str, Column]:
    ok = F.coalesce(F.array_contains("Specimens", F.col("SpecimenType")), F.lit(True))
    issue = F.when(~ok, F.concat(F.lit("Invalid specimen type. Expected: "), F.array_join("Specimens", ", ")))
    return {"SpecimenIntegrityValid": ok, "SpecimenIssues": join_issues(issue)}


def hemolysis_impact() -> Column:
    hit = F.col("TestCode").isin(*R.HEMOLYSIS_TESTS) & (F.col("SpecimenQuality") == "Hemolyzed")
    return F.when(hit, "Result may be falsely elevated due to hemolysis")


def _protocol(df: DataFrame) -> dict[str, Column]:
    return {"IsTimeSensitive": F.coalesce("TimeSensitive", F.lit(False)),
            "RequiresImmediateNotification": F.coalesce(F.col("CriticalFlag"), F.lit(False))}


def _apply(df: DataFrame, *parts, rules=None) -> DataFrame:
    joined = _with_rules(df, rules)
    cols: dict[str, Column] = {}
    for part in parts:
        cols.update(part(joined))
    return joined.withColumns(cols).drop(*RULE_COLUMNS)


def plausibility(lab: DataFrame, rules=None) -> DataFrame:
    return _apply(lab, _plausible, rules=rules)


def delta_check(lab: DataFrame, rules=None) -> DataFrame:
    """Changes above the test's limit on the same or the next calendar day (whole days x 24 hours)."""
    return _apply(with_previous(lab), _delta, rules=rules)


def unit_consistency(lab: DataFrame, rules=None) -> DataFrame:
    return _apply(lab, _units, rules=rules)


def with_loinc(lab: DataFrame, tests: DataFrame) -> DataFrame:
    return lab.join(tests.select("TestCode", F.col("LoincCode").alias("AssignedLoincCode")), "TestCode", "left")


def loinc(lab: DataFrame, tests: DataFrame) -> DataFrame:
    """A missing code is invalid; a malformed one fails only the format flag."""
    df = with_loinc(lab, tests)
    return df.withColumns(_loinc(df))


def specimen_integrity(lab: DataFrame, rules=None) -> DataFrame:
    return _apply(lab, _specimen, rules=rules)


def hemolysis(lab: DataFrame) -> DataFrame:
    return lab.withColumn("HemolysisImpact", hemolysis_impact())


def critical_protocol(lab: DataFrame, rules=None) -> DataFrame:
    return _apply(lab, _protocol, rules=rules)


def specimen_tests(lab: DataFrame, rules=None) -> DataFrame:
    """SpecimenValid is false where the specimen's rule does not list the test."""
    rule = R.specimen_rules(lab.sparkSession, rules).select("SpecimenType", "ValidTests")
    j = lab.join(rule, "SpecimenType", "left")
    ok = F.coalesce(F.array_contains("ValidTests", F.col("TestCode")), F.lit(True))
    return j.withColumn("SpecimenValid", ok).drop("ValidTests")


def specimen_age(lab: DataFrame, rules=None) -> DataFrame:
    """SpecimenFresh: the result came within the specimen's hours; true without rule or collection time, and
    judged only for the tests the specimen serves."""
    rule = R.specimen_rules(lab.sparkSession, rules)
    j = lab.join(rule, "SpecimenType", "left")
    hours = (F.unix_micros(F.col("ResultDate").cast("timestamp")) - F.unix_micros(F.col("CollectedDate").cast("timestamp"))) / 3.6e9
    judged = F.array_contains("ValidTests", F.col("TestCode")) & F.col("CollectedDate").isNotNull()
    return (j.withColumn("SpecimenAgeHours", hours)
            .withColumn("SpecimenFresh", F.when(judged, hours <= F.col("MaxAgeHours")).otherwise(F.lit(True)))
            .drop("ValidTests", "MaxAgeHours"))


def quality_flags(lab: DataFrame, tests: DataFrame, rules=None) -> DataFrame:
    """All quality rules at once: one window, two broadcast joins, one projection."""
    df = with_loinc(with_previous(lab), tests)
    return _apply(df, _plausible, _delta, _units, _loinc, _specimen, _protocol, rules=rules).withColumn(
        "HemolysisImpact", hemolysis_impact())


def clinical_flags(enriched: DataFrame, stats: dict[str, Column] | None = None) -> DataFrame:
    """Range, temporal and specimen validity with one joined message; ``stats`` as in ``previous_row``."""
    df = specimen_tests(temporal_consistency(with_previous(reference_range(enriched), stats=stats)))
    return df.withColumn("ValidationMessage", join_issues(F.col("RangeMessage"), F.col("TemporalMessage"))).drop(
        "RangeMessage", "TemporalMessage")


WEIGHTS = {"completeness": 0.20, "physiological_validity": 0.25, "delta_check_pass_rate": 0.20,
           "unit_conformity": 0.15, "loinc_coverage": 0.10, "specimen_integrity": 0.10}


def quality_score(flags: DataFrame) -> DataFrame:
    """Six rates and their weighted score, to four places; the delta rate counts rows with a predecessor."""
    n = F.count("*")
    had = F.col("PreviousResult").isNotNull()
    totals = flags.agg(
        n.alias("total_results"),
        safe_ratio(F.count("ResultValueNumeric"), n).alias("completeness"),
        safe_ratio(F.count_if("PhysiologicallyPlausible"), n).alias("physiological_validity"),
        safe_ratio(F.count_if(had & F.col("DeltaCheckPass")), F.count_if(had)).alias("delta_check_pass_rate"),
        safe_ratio(F.count_if("UnitValid"), n).alias("unit_conformity"),
        safe_ratio(F.count_if("LoincValid"), n).alias("loinc_coverage"),
        safe_ratio(F.count_if("SpecimenIntegrityValid"), n).alias("specimen_integrity"))
    score = sum((F.col(c) * F.lit(w) for c, w in WEIGHTS.items()), F.lit(0.0))
    return totals.select("total_results", *[F.round(c, 4).alias(c) for c in WEIGHTS],
                         F.round(score, 4).alias("overall_quality_score"))


def validation_summary(flags: DataFrame) -> DataFrame:
    """Rows passing range, temporal and specimen checks with no correlation objection; an unknown range flag
    does not pass."""
    ok = F.col("ReferenceRangeValid") & F.col("TemporalConsistencyValid") & F.col("SpecimenValid")
    return flags.agg(F.count("*").alias("total_results"), F.count_if(ok).alias("fully_valid"),
                     F.round(safe_ratio(F.count_if(ok), F.count("*")) * 100, 6).alias("valid_rate"))


def flag_averages(flags: DataFrame, names=("PhysiologicallyPlausible", "DeltaCheckPass", "UnitValid", "LoincValid",
                                           "SpecimenIntegrityValid")) -> DataFrame:
    return flags.agg(*[F.avg(F.col(c).cast("int")).alias(c) for c in names])


# fixed values: thresholds of the quality report
THRESHOLDS = {"completeness": 0.95, "unit_conformity": 0.99, "loinc_coverage": 0.99}
FRESHNESS_HOURS = 2


def threshold_results(score: DataFrame, newest: DataFrame, as_of: Column, table: str = "LabResults",
                      thresholds: Mapping[str, float] = THRESHOLDS) -> DataFrame:
    """Check rows: rates against thresholds, and the age of the newest row (``newest``: one row, column ts)."""
    kinds = {"completeness": "Completeness"}
    rated = unpivot(score, list(thresholds), "CheckName", "ActualValue")
    limits = F.create_map(*[F.lit(x) for p in thresholds.items() for x in p])
    rates = rated.select(
        F.when(F.col("CheckName") == "completeness", kinds["completeness"]).otherwise("Conformity").alias("CheckType"),
        "CheckName", F.element_at(limits, F.col("CheckName")).alias("ExpectedValue"), "ActualValue",
        (F.col("ActualValue") >= F.element_at(limits, F.col("CheckName"))).alias("PassedFlag"))
    age = (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.col("ts").cast("timestamp"))) / 3.6e9
    fresh = newest.select(F.lit("Freshness").alias("CheckType"), F.lit("hours_since_last").alias("CheckName"),
                          F.lit(float(FRESHNESS_HOURS)).alias("ExpectedValue"), F.round(age, 4).alias("ActualValue"),
                          (age <= FRESHNESS_HOURS).alias("PassedFlag"))
    return rates.unionByName(fresh).select(
        F.lit(table).alias("TableName"), "*", F.when(F.col("PassedFlag"), "Info").otherwise("Error").alias("Severity"))


def cross_test_pairs(lab: DataFrame, pairs=None) -> DataFrame:
    """Per patient, day and pair of related tests: number, sum, mean and centred squares of each side's results.

    These stand for all same-day pairs of results without forming them (``moments.crossed_correlation``). Each (patient, day, pair)
    is one row after map-side aggregation.
    """
    rule = R.correlation_sides(lab.sparkSession, pairs)
    base = (lab.where(F.col("ResultValueNumeric").isNotNull())
            .select("PatientId", F.to_date("ResultDate").alias("Day"), "TestCode", F.col("ResultValueNumeric").alias("v")))

    def side(k: int) -> list[Column]:
        v = F.when(F.col("Side") == k, F.col("v"))
        return [F.sum(v).alias(f"s{k}"), *moments.parts(v, str(k))]

    return (base.join(rule, "TestCode").groupBy("Test1", "Test2", "Expected", "PatientId", "Day")
            .agg(*side(1), *side(2)).where("n1 > 0 AND n2 > 0"))


def cross_test_correlation(pair_days: DataFrame, cut: float = 0.3) -> DataFrame:
    """Pearson correlation per test pair over all same-patient same-day pairs, and whether the sign is right."""
    meets = F.when(F.col("Expected") == "positive", F.col("correlation") >= cut).otherwise(F.col("correlation") <= -cut)
    found = moments.crossed_correlation(pair_days, ["Test1", "Test2", "Expected"], "1", "2")
    return found.withColumn("MeetsExpectation", meets)

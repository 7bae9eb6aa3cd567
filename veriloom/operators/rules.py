"""Rule tables as data. Each is fixed in code and small, so joining it by broadcast is always safe."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_RULE_ROWS = 5_000

# fixed values: reference ranges by test and age/sex group: min, max, critical low, critical high
REFERENCE_RANGES = [
    ("GLUCOSE", "adult", 70, 100, 50, 300),
    ("GLUCOSE", "pediatric", 60, 100, 40, 250),
    ("HBA1C", "adult", 4.0, 5.6, None, 10.0),
    ("HBA1C", "pediatric", 4.0, 5.6, None, 10.0),
    ("CREATININE", "adult_male", 0.74, 1.35, 0.3, 5.0),
    ("CREATININE", "adult_female", 0.59, 1.04, 0.3, 5.0),
    ("CREATININE", "pediatric", 0.3, 0.7, 0.2, 2.0),
    ("WBC", "adult", 4.5, 11.0, 1.0, 30.0),
    ("WBC", "pediatric", 5.0, 14.5, 1.0, 30.0),
    ("HEMOGLOBIN", "adult_male", 13.5, 17.5, 7.0, 20.0),
    ("HEMOGLOBIN", "adult_female", 12.0, 15.5, 7.0, 20.0),
    ("HEMOGLOBIN", "pediatric", 11.0, 14.5, 7.0, 20.0),
]

# fixed values: per test: physiological min and max, largest change in percent, hours it applies to,
# units, specimens, whether results are time-sensitive
LAB_RULES = [
    ("GLUCOSE", 0, 700, 50, 24, ["mg/dL", "mmol/L"], ["Blood", "Serum", "Plasma"], False),
    ("HBA1C", 2.0, 18.0, 20, 24, ["%", "mmol/mol"], ["Blood"], False),
    ("CREATININE", 0.1, 25.0, 50, 24, ["mg/dL", "μmol/L"], ["Serum", "Plasma"], False),
    ("WBC", 0, 100.0, 100, 24, ["K/uL", "10^9/L"], ["Blood"], False),
    ("HEMOGLOBIN", 3.0, 25.0, 25, 24, ["g/dL", "g/L"], ["Blood"], False),
    ("POTASSIUM", 1.5, 9.0, 30, 24, ["mEq/L", "mmol/L"], ["Serum", "Plasma"], False),
    ("TROPONIN", 0, 500000, 200, 24, ["ng/mL", "ng/L"], ["Serum", "Plasma"], True),
]

# fixed values: specimen -> hours it keeps, tests it serves
SPECIMEN_RULES = [
    ("Blood", 24, ["GLUCOSE", "HBA1C", "WBC", "HEMOGLOBIN"]),
    ("Serum", 48, ["CREATININE", "BUN", "CALCIUM"]),
    ("Urine", 2, ["URINEPROTEIN", "URINECULTURE"]),
    ("Plasma", 24, ["GLUCOSE", "LACTATE"]),
]

# fixed values: pairs of tests and the sign their values should correlate with
CORRELATION_PAIRS = [
    ("GLUCOSE", "HBA1C", "positive"),
    ("BUN", "CREATININE", "positive"),
    ("TSH", "FREET4", "inverse"),
    ("CALCIUM", "PHOSPHORUS", "inverse"),
]

# fixed values: tests whose results hemolysis raises
HEMOLYSIS_TESTS = ("POTASSIUM", "LDH", "AST")

# fixed values: wheelchair code -> price tier
WHEELCHAIR_TIERS = {
    "K0001": 1, "K0002": 1, "K0003": 2, "K0004": 2, "K0005": 3, "K0006": 3,
    "K0007": 4, "K0008": 4, "K0823": 5, "K0824": 5, "K0825": 5,
}

# fixed values: codes often involved in fraud
HIGH_RISK_CODES = ("A4352", "A4353", "E0603", "L0643", "L2630", "E0601", "K0823", "E0431")

# fixed values: equipment category -> codes
EQUIPMENT_CATEGORIES = {
    "oxygen_equipment": ["E0424", "E0431", "E0433", "E0434", "E0439", "E0441", "E0442", "E0443", "E0444",
                         "E1390", "E1391", "E1392"],
    "wheelchairs": ["K0001", "K0002", "K0003", "K0004", "K0005", "K0006", "K0007", "K0008", "K0009", "K0010"],
    "hospital_beds": ["E0250", "E0251", "E0255", "E0256", "E0260", "E0261", "E0265", "E0266", "E0270", "E0271"],
    "cpap_bipap": ["E0601", "E0470", "E0471", "E0472"],
    "catheters": ["A4351", "A4352", "A4353", "A4354", "A4355", "A4356", "A4357", "A4358"],
    "orthotic_devices": ["L0643", "L2630", "L3000", "L3001", "L3002"],
    "breast_pumps": ["E0602", "E0603", "E0604"],
    "walkers": ["E0130", "E0135", "E0140", "E0141", "E0143", "E0144", "E0147", "E0148", "E0149"],
    "nebulizers": ["E0570", "E0575", "E0580", "E0585"],
    "glucose_monitors": ["E0607", "E2100", "E2101"],
}

# fixed values: test catalogue: code, name, LOINC, category levels 1 to 3, specimen, result type, target minutes
TEST_CATALOGUE = [
    ("GLUCOSE", "Glucose", "2345-7", "Chemistry", "Diabetes Monitoring", "Glucose", "Serum", "NUMERIC", 120),
    ("HBA1C", "Hemoglobin A1c", "4548-4", "Chemistry", "Diabetes Monitoring", "Glucose", "Blood", "NUMERIC", 240),
    ("CREATININE", "Creatinine", "2160-0", "Chemistry", "Basic Metabolic Panel", "Kidney Function", "Serum", "NUMERIC", 120),
    ("POTASSIUM", "Potassium", "2823-33", "Chemistry", "Basic Metabolic Panel", "Electrolytes", "Serum", "NUMERIC", 60),
    ("TROPONIN", "Troponin", "6598-7", "Chemistry", "Cardiac Markers", "Troponin", "Plasma", "NUMERIC", 60),
    ("WBC", "White cell count", "6690-2", "Hematology", "Complete Blood Count", "White Blood Cells", "Blood", "NUMERIC", 120),
    ("HEMOGLOBIN", "Hemoglobin", "718-7", "Hematology", "Complete Blood Count", "Red Blood Cells", "Blood", "NUMERIC", 120),
    ("LDH", "Lactate dehydrogenase", None, "Chemistry", "Comprehensive Metabolic Panel", "Liver Function", "Serum", "NUMERIC", 240),
]

# fixed values: test category hierarchy
CATEGORY_HIERARCHY = [
    ("Chemistry", "Basic Metabolic Panel", "Electrolytes"),
    ("Chemistry", "Basic Metabolic Panel", "Kidney Function"),
    ("Chemistry", "Comprehensive Metabolic Panel", "Liver Function"),
    ("Chemistry", "Lipid Panel", "Cholesterol"),
    ("Chemistry", "Cardiac Markers", "Troponin"),
    ("Chemistry", "Diabetes Monitoring", "Glucose"),
    ("Hematology", "Complete Blood Count", "White Blood Cells"),
    ("Hematology", "Complete Blood Count", "Red Blood Cells"),
    ("Hematology", "Coagulation", "PT/INR"),
    ("Hematology", "Coagulation", "aPTT"),
    ("Microbiology", "Culture", "Blood Culture"),
    ("Microbiology", "Culture", "Urine Culture"),
    ("Microbiology", "Serology", "Antibody Testing"),
    ("Immunology", "Autoimmune", "ANA"),
    ("Immunology", "Allergy", "IgE"),
    ("Endocrinology", "Thyroid", "TSH"),
    ("Endocrinology", "Thyroid", "Free T4"),
    ("Endocrinology", "Reproductive", "Testosterone"),
    ("Molecular", "Genetic Testing", "DNA Sequencing"),
    ("Molecular", "Oncology", "Tumor Markers"),
]


def table(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A rule list as a frame, hinted for broadcast up to MAX_RULE_ROWS rows; a longer one joins like any table."""
    df = spark.createDataFrame(rows, schema)
    return F.broadcast(df) if len(rows) <= MAX_RULE_ROWS else df


def _number(x):
    return None if x is None else float(x)


def reference_ranges(spark: SparkSession, rows=None) -> DataFrame:
    rows = REFERENCE_RANGES if rows is None else rows
    groups = {(r[0], r[1]) for r in rows}
    clash = [t for t, g in groups if g == "adult" and {(t, "adult_male"), (t, "adult_female")} & groups]
    if clash or len(groups) != len(rows):
        raise ValueError(f"overlapping range groups: {sorted(clash)}")
    typed = [(t, g, _number(lo), _number(hi), _number(cl), _number(ch), f"{lo}-{hi}") for t, g, lo, hi, cl, ch in rows]
    return table(spark, typed,
                 "TestCode string, RangeGroup string, RuleMin double, RuleMax double, CriticalLow double, "
                 "CriticalHigh double, RangeText string")


def lab_rules(spark: SparkSession, rows=None) -> DataFrame:
    rows = LAB_RULES if rows is None else rows
    typed = [(t, _number(lo), _number(hi), _number(d), h, u, s, ts, f"{lo}-{hi}", str(d))
             for t, lo, hi, d, h, u, s, ts in rows]
    return table(spark, typed,
                 "TestCode string, PhysMin double, PhysMax double, MaxDelta double, DeltaHours int, "
                 "Units array<string>, Specimens array<string>, TimeSensitive boolean, PhysText string, DeltaText string")


def specimen_rules(spark: SparkSession, rows=None) -> DataFrame:
    return table(spark, SPECIMEN_RULES if rows is None else rows,
                 "SpecimenType string, MaxAgeHours int, ValidTests array<string>")


def correlation_sides(spark: SparkSession, rows=None) -> DataFrame:
    """Each pair as two rows keyed by test, so that joining it is an equi-join."""
    sides = [(t, k, a, b, e) for a, b, e in (CORRELATION_PAIRS if rows is None else rows) for k, t in ((1, a), (2, b))]
    return table(spark, sides, "TestCode string, Side int, Test1 string, Test2 string, Expected string")


def test_catalogue(spark: SparkSession) -> DataFrame:
    return table(spark, TEST_CATALOGUE,
                 "TestCode string, TestName string, LoincCode string, TestCategory string, CategoryLevel2 string, "
                 "CategoryLevel3 string, SpecimenRequired string, ResultType string, TargetMinutes int")


def category_hierarchy(spark: SparkSession) -> DataFrame:
    rows = [(a, b, c, f"{a} > {b} > {c}") for a, b, c in CATEGORY_HIERARCHY]
    return table(spark, rows, "Level1 string, Level2 string, Level3 string, FullPath string")


def equipment_categories(spark: SparkSession) -> DataFrame:
    rows = [(code, cat) for cat, codes in EQUIPMENT_CATEGORIES.items() for code in codes]
    return table(spark, rows, "hcpcs_code string, category string")


def wheelchair_tiers(spark: SparkSession, tiers=None) -> DataFrame:
    return table(spark, list((WHEELCHAIR_TIERS if tiers is None else tiers).items()), "hcpcs_code string, tier int")

"""Claims to ranked alerts and their summary."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriloom.operators import fraud
from veriloom.session import materialise, work_dir


@dataclass
class FraudResult:
    alerts: DataFrame
    links: DataFrame | None
    summary: DataFrame | None
    notes: DataFrame


CLAIM_COLUMNS = ("claim_id", "provider_npi", "beneficiary_id", "service_date", "hcpcs_code", "billed_amount",
                 "ordering_physician_npi")


def detect_side_by_side(claims: DataFrame, params: dict, names: list[str]) -> DataFrame:
    """Every detector as its own Spark job, all submitted together; their stored alerts as one frame. What several of them
    need, the counts per provider and day, is stored first; one plan over all of them takes longer to plan than to run."""
    measures = fraud.measure(claims)
    if any(map(fraud.measured, names)):
        measures = replace(measures, days=materialise(measures.days, "days"), seen=claims)
    return judged(measures, params, names, claims)


def judged(measures: fraud.Measures, params: dict, names: list[str], claims: DataFrame | None = None) -> DataFrame:
    """Stored alerts of the detectors, from ``measures``, or for registered ones from ``claims``."""
    spark = measures.days.sparkSession
    root = work_dir(spark, "detected")

    def one(name: str) -> str:
        found = fraud.JUDGES[name](measures, params) if fraud.measured(name) else fraud.run_detectors(claims, params, [name])
        found.select(*fraud.ALERT_COLUMNS).write.parquet(f"{root}/{name}")
        return f"{root}/{name}"

    with ThreadPoolExecutor(min(8, len(names))) as pool:
        paths = list(pool.map(one, names))
    return spark.read.parquet(*paths).select(*fraud.ALERT_COLUMNS)


def stored_claims(claims: DataFrame) -> DataFrame:
    """The cleaned claims, written once for all that reads them, with the columns they need."""
    return materialise(fraud.preprocess(claims).select(*CLAIM_COLUMNS), "claims")


def run(claims: DataFrame, as_of: str, *, detectors=None, params: dict | None = None, min_claims: int = 0,
        confidence: float = 0.5, include_low: bool = False, per_provider: int | None = None, with_summary: bool = True) -> FraudResult:
    """Preprocess, detect, filter, summarise.

    The cleaned claims feed every detector and the summary, so they are written once; the few alerts are written once as well.
    Every alert is kept unless ``per_provider`` is given. ``notes`` (code, detail) has a row if there are fewer than
    ``min_claims`` claims; the detectors run all the same.
    """
    clean = stored_claims(claims)
    found = detect_side_by_side(clean, {"as_of": as_of, **(params or {})}, list(detectors or fraud.DETECTORS))
    kept = fraud.keep_confident(found, confidence, include_low)
    alerts = materialise(kept if per_provider is None else fraud.cap_per_provider(kept, per_provider), "alerts")
    links = fraud.alert_claims(clean, alerts)
    few = clean.agg(F.count("*").alias("n")).where(F.col("n") < min_claims)
    notes = few.select(F.lit("TOO_FEW_CLAIMS").alias("code"), F.concat(F.col("n").cast("string"), F.lit(f" of {min_claims}")).alias("detail"))
    return FraudResult(alerts, links, fraud.summary(alerts, clean, links) if with_summary else None, notes)

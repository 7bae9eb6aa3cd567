"""Fraud detectors over all providers at once, alert handling and the claim profiles.

An alert row carries counts and text, not claim lists: a flagged provider-day may hold any number of claims.
The claims behind alerts are the long frame of ``alert_claims``, which joins back to claims at any scale.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from typing import ClassVar

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veriloom.functions.parse import fixed_text, safe_ratio
from veriloom.operators import rules as R
from veriloom.operators.skew import exact_positions, latest_per_key, running_weight, same_keys

# fixed values: base priority by risk level
BASE_PRIORITY = {"low": 10, "medium": 40, "high": 70, "critical": 90}
ALERT_COLUMNS = ("alert_id", "detector_name", "fraud_type", "risk_level", "confidence_score", "provider_npi", "period",
                 "claim_count", "description", "evidence_summary", "rules", "observed_value", "expected_value",
                 "standard_deviations", "recommended_action", "priority_score")


def preprocess(claims: DataFrame) -> DataFrame:
    return claims.where((F.length("provider_npi") > 0) & (F.col("billed_amount") > 0))


def with_derived(claims: DataFrame, threshold: float = 1000.0) -> DataFrame:
    unit = F.when(F.col("units") > 0, F.col("billed_amount") / F.col("units")).otherwise(F.lit(0.0))
    return claims.withColumns({"unit_price": unit, "is_high_value": F.col("billed_amount") >= threshold})


def provider_profiles(claims: DataFrame) -> DataFrame:
    return claims.groupBy("provider_npi").agg(
        F.count("*").alias("total_claims"), F.sum("billed_amount").alias("total_amount"),
        F.avg("billed_amount").alias("avg_claim_amount"), F.countDistinct("beneficiary_id").alias("unique_beneficiaries"))


def beneficiary_profiles(claims: DataFrame) -> DataFrame:
    cats = R.equipment_categories(claims.sparkSession)
    # a bit per category, so one narrow row per beneficiary and provider is enough for both distinct counts
    bit = F.element_at(F.create_map(*[x for i, c in enumerate(R.EQUIPMENT_CATEGORIES) for x in (F.lit(c), F.lit(1 << i).cast("bigint"))]), F.col("category"))
    pairs = (claims.select("beneficiary_id", "provider_npi", "hcpcs_code").join(cats, "hcpcs_code", "left").groupBy("beneficiary_id", "provider_npi")
             .agg(F.count("*").alias("n"), F.bit_or(F.coalesce(bit, F.lit(0))).alias("kinds")))
    return pairs.groupBy("beneficiary_id").agg(
        F.sum("n").alias("total_claims"), F.count("provider_npi").alias("unique_providers"),
        F.bit_count(F.bit_or("kinds")).cast("bigint").alias("distinct_equipment_types"))


def zscore(value: Column, mean: Column, std: Column) -> Column:
    return F.when(std == 0, F.lit(0.0)).otherwise((value - mean) / std)


def percentile_rank(df: DataFrame, value: str, by: Iterable[str] = (), ties: Iterable[str] = ()) -> DataFrame:
    """Share of the group's known values strictly below each row's value, in percent; NULL for a NULL value. With ``ties`` rows of
    equal values are numbered apart, in the order of those columns, so each has a place of its own."""
    keys = list(by)
    known = df.where(F.col(value).isNotNull())
    counts = known.groupBy(*keys, value).agg(F.count("*").alias("_n"))
    before = running_weight(counts, keys, value, "_n")
    if keys:
        before = same_keys(before, known.groupBy(*keys).agg(F.count("*").alias("_total")), keys)
    else:
        before = before.withColumn("_total", known.agg(F.count("*")).scalar())
    placed = same_keys(df, before.select(*keys, value, "_before", "_total"), [*keys, value], "left")
    place = F.col("_before")
    if ties:
        place = place + F.row_number().over(W.partitionBy(*keys, value).orderBy(*ties)) - 1
    return placed.withColumn("percentile_rank", place / F.col("_total") * 100).drop("_before", "_total")


# fixed values: detector and rule names, and the wording of descriptions, evidence and actions in the detectors below
def _alerts(df: DataFrame, detector: str, fraud_type: Column, risk: Column, confidence: Column, *, period: Column, count: Column,
            description: Column, evidence: Column, rules: list[str], observed: Column, expected: Column,
            std_devs: Column | None = None, action: str = "") -> DataFrame:
    base = F.element_at(F.create_map(*[F.lit(x) for p in BASE_PRIORITY.items() for x in p]), F.col("risk_level"))
    out = df.select(
        F.lit(detector).alias("detector_name"), fraud_type.alias("fraud_type"), risk.alias("risk_level"),
        confidence.alias("confidence_score"), "provider_npi", period.cast("string").alias("period"),
        count.cast("bigint").alias("claim_count"), description.alias("description"), evidence.alias("evidence_summary"),
        F.lit(", ".join(rules)).alias("rules"), observed.cast("double").alias("observed_value"),
        expected.cast("double").alias("expected_value"),
        (std_devs if std_devs is not None else F.lit(None)).cast("double").alias("standard_deviations"),
        F.lit(action).alias("recommended_action"))
    key = F.md5(F.concat_ws("|", "detector_name", "provider_npi", F.coalesce("period", F.lit(""))))
    priority = F.least(F.lit(100), F.floor(base + F.col("confidence_score") * 10)).cast("int")
    return out.withColumn("priority_score", priority).withColumn("alert_id", key).select(*ALERT_COLUMNS)


def wheelchair_counts(claims: DataFrame, tiers=None) -> DataFrame:
    """Wheelchair claims per provider, and how many are of a high tier."""
    tier = R.wheelchair_tiers(claims.sparkSession, tiers)
    return (claims.select("provider_npi", "hcpcs_code").join(tier, "hcpcs_code").groupBy("provider_npi")
            .agg(F.count("*").alias("n"), F.count_if(F.col("tier") >= 4).alias("high")))


def upcoding(claims: DataFrame, z: float = 2.0, min_claims: int = 10, tiers=None) -> DataFrame:
    """Providers whose share of high-tier wheelchair codes lies far above their peers'."""
    return upcoding_of(wheelchair_counts(claims, tiers), z, min_claims)


def upcoding_of(counts: DataFrame, z: float = 2.0, min_claims: int = 10) -> DataFrame:
    share = counts.where(F.col("n") >= min_claims).withColumn("ratio", F.col("high") / F.col("n"))
    peers = share.agg(F.struct(F.avg("ratio").alias("mean"), F.coalesce(F.stddev_samp("ratio"), F.lit(0.1)).alias("std")).alias("p"))
    scored = share.withColumn("p", peers.scalar())
    scored = scored.withColumn("z", zscore(F.col("ratio"), F.col("p.mean"), F.col("p.std"))).where(F.col("z") > z)
    return _alerts(
        scored, "UpcodingDetector", F.lit("upcoding"), F.when(F.col("z") > 3.0, "high").otherwise("medium"),
        F.least(F.lit(0.95), F.lit(0.5) + (F.col("z") - 2.0) * 0.15), period=F.lit(None),
        count=F.col("n"),
        description=F.concat(F.lit("Provider shows "), fixed_text(F.col("ratio") * 100, 1), F.lit("% high-tier wheelchair claims vs peer average of "),
                             fixed_text(F.col("p.mean") * 100, 1), F.lit("%")),
        evidence=F.concat(F.lit("Z-score: "), fixed_text(F.col("z"), 2), F.lit(", Sample size: "), F.col("n").cast("string"), F.lit(" claims")),
        rules=["UPCODE-WHEELCHAIR-TIER", "PEER-COMPARISON"], observed=F.col("ratio") * 100, expected=F.col("p.mean") * 100,
        std_devs=F.col("z"), action="Review medical necessity documentation for high-tier equipment claims")


def day_counts(claims: DataFrame, high_risk=R.HIGH_RISK_CODES) -> DataFrame:
    """Claims, high-risk codes and billed amount per provider and day; claims without a date are a row of their own. Months, totals and
    first and last days follow from these."""
    return claims.groupBy("provider_npi", "service_date").agg(
        F.count("*").alias("n"), F.count_if(F.col("hcpcs_code").isin(*high_risk)).alias("risky"), F.sum("billed_amount").alias("total"))


def phantom(claims: DataFrame, cap: int = 50) -> DataFrame:
    """Provider-days with more claims than can be delivered. Beneficiaries are counted only for the days flagged."""
    return phantom_of(claims.groupBy("provider_npi", "service_date").agg(F.count("*").alias("n")), claims, cap)


def phantom_of(days: DataFrame, seen: DataFrame, cap: int = 50) -> DataFrame:
    """``seen``: provider_npi, service_date, beneficiary_id of all claims, repeated or not."""
    keys = ["provider_npi", "service_date"]
    over = days.where(F.col("service_date").isNotNull() & (F.col("n") > cap))
    people = seen.select(*keys, "beneficiary_id").join(over.select(*keys), keys, "left_semi").groupBy(*keys).agg(
        F.countDistinct("beneficiary_id").alias("people"))
    day = over.join(people, keys)
    return _alerts(
        day, "PhantomBillingDetector", F.lit("phantom_billing"), F.when(F.col("n") > 100, "critical").otherwise("high"),
        F.least(F.lit(0.95), F.lit(0.6) + F.col("n") / 200), period=F.col("service_date"), count=F.col("n"),
        description=F.concat(F.col("n").cast("string"), F.lit(" claims on "), F.col("service_date").cast("string"),
                             F.lit(" exceeds physical delivery capacity")),
        evidence=F.concat(F.lit("Unique beneficiaries: "), F.col("people").cast("string"), F.lit(", Ratio: "), fixed_text(F.col("people") / F.col("n"), 2)),
        rules=["PHANTOM-VOLUME-LIMIT", "DAILY-DELIVERY-CAP"], observed=F.col("n"), expected=F.lit(cap),
        action="Request proof of delivery documentation for all claims on this date")


def provider_months(claims: DataFrame, high_risk=R.HIGH_RISK_CODES) -> DataFrame:
    """Claims per provider and month with claims, and how many carry high-risk codes."""
    return months_of(claims.select("provider_npi", "service_date", F.lit(1).alias("n"), F.col("hcpcs_code").isin(*high_risk).cast("int").alias("risky")))


def months_of(days: DataFrame) -> DataFrame:
    counted = (days.where(F.col("service_date").isNotNull()).groupBy("provider_npi", F.trunc("service_date", "month").alias("_m"))
               .agg(F.sum("n").alias("n"), F.coalesce(F.sum("risky"), F.lit(0)).alias("risky")))
    return counted.select("provider_npi", F.date_format("_m", "yyyy-MM").alias("month"), "n", "risky")


def running_baseline(months: DataFrame) -> DataFrame:
    """Mean, sample deviation and z-score against all earlier months per provider. A window holds one provider's months, so
    its length is bounded by the calendar, whatever the number of claims.

    Counts are whole numbers, so their sums and squares are kept exactly and rounded once: a month that lies at a limit of z is not
    pushed over it by the rounding of a running mean."""
    w = W.partitionBy("provider_npi").orderBy("month")
    past = w.rowsBetween(W.unboundedPreceding, -1)
    n, k = F.col("n").cast("decimal(18,0)"), F.col("month_index")
    sums = months.withColumns({"month_index": F.row_number().over(w) - 1, "_s": F.sum(n).over(past), "_q": F.sum(n * n).over(past)})
    spread = (k * F.col("_q") - F.col("_s") * F.col("_s")).cast("double")  # k * (k - 1) times the variance
    above = (k * n - F.col("_s")).cast("double")
    z = F.when(spread == 0, F.lit(0.0)).otherwise(F.signum(above) * F.sqrt(above * above * (k - 1) / (k * spread)))
    return sums.withColumns({
        "baseline": F.when(k > 0, F.col("_s").cast("double") / k), "baseline_std": F.when(k > 1, F.sqrt(spread / (k * (k - 1)))),
        "z": F.when(k > 1, z)}).drop("_s", "_q")


def volume_spike(claims: DataFrame, z: float = 3.0, high_risk=R.HIGH_RISK_CODES) -> DataFrame:
    """Months far above the provider's own earlier months, judged from its third month on."""
    return volume_spike_of(provider_months(claims, high_risk), z)


def volume_spike_of(months: DataFrame, z: float = 3.0) -> DataFrame:
    base = running_baseline(months).where("month_index >= 2")
    hit = base.where(F.col("z") > z)
    share = F.col("risky") / F.col("n")
    return _alerts(
        hit, "VolumeAnomalyDetector", F.when(F.col("z") > 5.0, "hit_and_run").otherwise("upcoding"),
        F.when(share > 0.5, "critical").when(F.col("z") > 4.0, "high").otherwise("medium"),
        F.least(F.lit(0.95), F.lit(0.5) + (F.col("z") - z) * 0.1), period=F.col("month"), count=F.col("n"),
        description=F.concat(F.lit("Volume spike in "), F.col("month"), F.lit(": "), F.col("n").cast("string"), F.lit(" claims vs baseline "), fixed_text(F.col("baseline"), 0)),
        evidence=F.concat(F.lit("Z-score: "), fixed_text(F.col("z"), 2), F.lit(", High-risk HCPCS ratio: "), fixed_text(share * 100, 1), F.lit("%")),
        rules=["VOLUME-SPIKE", "MONTHLY-TREND", "HIGH-RISK-CONCENTRATION"], observed=F.col("n"), expected=F.col("baseline"),
        std_devs=F.col("z"), action="Immediate review - potential hit-and-run scheme if new provider")


def kickback(claims: DataFrame, share: float = 0.6, min_claims: int = 20) -> DataFrame:
    """Providers whose referrals come mostly from one physician."""
    return kickback_of(referral_counts(claims), share, min_claims)


def referral_counts(claims: DataFrame) -> DataFrame:
    return claims.where(F.length("ordering_physician_npi") > 0).groupBy("provider_npi", "ordering_physician_npi").agg(F.count("*").alias("n"))


def kickback_of(pairs: DataFrame, share: float = 0.6, min_claims: int = 20) -> DataFrame:
    totals = pairs.groupBy("provider_npi").agg(F.sum("n").alias("total")).where(F.col("total") >= min_claims)
    part = F.col("n") / F.col("total")
    hit = pairs.join(totals, "provider_npi").withColumn("part", part).where(F.col("part") > share)
    return _alerts(
        hit, "KickbackPatternDetector", F.lit("kickback"), F.when(F.col("part") > 0.8, "high").otherwise("medium"),
        F.least(F.lit(0.9), F.col("part")), period=F.col("ordering_physician_npi"), count=F.lit(0),
        description=F.concat(fixed_text(F.col("part") * 100, 1), F.lit("% of claims from single ordering physician "), F.col("ordering_physician_npi")),
        evidence=F.concat(F.lit("Total claims: "), F.col("total").cast("string"), F.lit(", From this physician: "), F.col("n").cast("string")),
        rules=["REFERRAL-CONCENTRATION", "KICKBACK-INDICATOR"], observed=F.col("part") * 100, expected=F.lit(share * 100),
        action="Investigate relationship between supplier and ordering physician")


def provider_totals(claims: DataFrame) -> DataFrame:
    return claims.groupBy("provider_npi").agg(
        F.sum("billed_amount").alias("total"), F.min("service_date").alias("first"), F.max("service_date").alias("last"))


def totals_of(days: DataFrame) -> DataFrame:
    return days.groupBy("provider_npi").agg(F.sum("total").alias("total"), F.min("service_date").alias("first"), F.max("service_date").alias("last"))


def kth_volume(totals: DataFrame, pct: float = 95.0, value: str = "total") -> DataFrame:
    """One row: the sorted totals' element at int(n * pct / 100), found without a global sort."""
    place = F.floor(F.col("_total") * F.lit(float(pct)) / F.lit(100.0))
    return exact_positions(totals, [], value, {"threshold": (pct / 100, place)})


def hit_and_run(claims: DataFrame, as_of: str, months: float = 6, pct: float = 95.0) -> DataFrame:
    """Short-lived providers among the largest billers; critical when silent for over 60 days."""
    return hit_and_run_of(provider_totals(claims), as_of, months, pct)


def hit_and_run_of(totals: DataFrame, as_of: str, months: float = 6, pct: float = 95.0) -> DataFrame:
    cut = kth_volume(totals, pct).scalar()
    days = F.datediff("last", "first") + 1
    idle = F.datediff(F.lit(as_of).cast("date"), F.col("last"))
    df = (totals.where(F.col("first").isNotNull()).withColumns({"days": days, "active": days / 30, "idle": idle})
          .where(F.col("active") <= months).withColumn("cut", cut).where(F.col("total") >= F.col("cut")))
    gone = F.col("idle") > 60
    text = F.concat(F.lit("New provider ("), fixed_text(F.col("active"), 1), F.lit(f" months) with top {100 - pct:.0f}% billing volume"))
    return _alerts(
        df, "HitAndRunDetector", F.lit("hit_and_run"), F.when(gone, "critical").otherwise("high"),
        F.least(F.lit(0.95), F.lit(0.7) + (F.col("total") / F.col("cut") - 1) * 0.1), period=F.lit(None), count=F.lit(0),
        description=F.when(gone, F.concat(text, F.lit(" - No claims for "), F.col("idle").cast("string"), F.lit(" days (possible abandonment)"))).otherwise(text),
        evidence=F.concat(F.lit("Total billed: $"), F.format_number("total", 2), F.lit(", Daily rate: $"), F.format_number(F.col("total") / F.col("days"), 2)),
        rules=["HIT-RUN-NEW-PROVIDER", "HIGH-VOLUME-SHORT-TENURE"], observed=F.col("total"), expected=F.col("cut"),
        action="Prioritize for immediate investigation - high flight risk")


# ---- registry of detectors --------------------------------------------------------------------------

Detector = Callable[[DataFrame, dict], DataFrame]
DETECTORS: dict[str, Detector] = {
    "upcoding": lambda c, p: upcoding(c, p.get("upcoding_z", 2.0)),
    "phantom": lambda c, p: phantom(c, p.get("phantom_cap", 50)),
    "volume": lambda c, p: volume_spike(c, p.get("spike_z", 3.0)),
    "kickback": lambda c, p: kickback(c, p.get("kickback_share", 0.6)),
    "hit_and_run": lambda c, p: hit_and_run(c, p["as_of"], p.get("new_provider_months", 6), p.get("volume_percentile", 95.0)),
}


@dataclass(frozen=True)
class Measures:
    """What the built-in detectors need of any number of claims. Each frame adds up over parts of the claims (``seen``: as a set), so
    parts can be measured one by one and kept."""

    chairs: DataFrame
    days: DataFrame
    referrals: DataFrame
    seen: DataFrame

    #: Per frame its keys and what is summed beside them.
    SHAPE: ClassVar[dict[str, tuple[tuple[str, ...], tuple[str, ...]]]] = {
        "chairs": (("provider_npi",), ("n", "high")), "days": (("provider_npi", "service_date"), ("n", "risky", "total")),
        "referrals": (("provider_npi", "ordering_physician_npi"), ("n",)), "seen": (("provider_npi", "service_date", "beneficiary_id"), ())}


def measure(claims: DataFrame) -> Measures:
    seen = claims.where(F.col("service_date").isNotNull()).select("provider_npi", "service_date", "beneficiary_id").distinct()
    return Measures(wheelchair_counts(claims), day_counts(claims), referral_counts(claims), seen)


JUDGES: dict[str, Callable[[Measures, dict], DataFrame]] = {
    "upcoding": lambda m, p: upcoding_of(m.chairs, p.get("upcoding_z", 2.0)),
    "phantom": lambda m, p: phantom_of(m.days, m.seen, p.get("phantom_cap", 50)),
    "volume": lambda m, p: volume_spike_of(months_of(m.days), p.get("spike_z", 3.0)),
    "kickback": lambda m, p: kickback_of(m.referrals, p.get("kickback_share", 0.6)),
    "hit_and_run": lambda m, p: hit_and_run_of(totals_of(m.days), p["as_of"], p.get("new_provider_months", 6), p.get("volume_percentile", 95.0)),
}
_BUILT_IN = dict(DETECTORS)


def measured(name: str) -> bool:
    """Whether the detector of that name judges measures; one that was registered anew reads claims."""
    return name in JUDGES and DETECTORS.get(name) is _BUILT_IN.get(name)


def register_detector(name: str, fn: Detector) -> None:
    """Add a detector: any function of claims and parameters giving a frame with ALERT_COLUMNS."""
    DETECTORS[name] = fn


def remove_detector(name: str) -> None:
    DETECTORS.pop(name, None)


def union_alerts(*alerts: DataFrame) -> DataFrame:
    out = alerts[0]
    for more in alerts[1:]:
        out = out.unionByName(more)
    return out


def run_detectors(claims: DataFrame, params: dict, names: Iterable[str] | None = None) -> DataFrame:
    """All chosen detectors' alerts. An error in a detector is raised, never swallowed."""
    return union_alerts(*[DETECTORS[n](claims, params).select(*ALERT_COLUMNS) for n in (names or list(DETECTORS))])


def ranked(alerts: DataFrame) -> DataFrame:
    return alerts.orderBy(F.col("priority_score").desc(), "detector_name", "provider_npi", "period")


def keep_confident(alerts: DataFrame, threshold: float = 0.5, include_low: bool = False) -> DataFrame:
    kept = alerts.where(F.col("confidence_score") >= threshold)
    return kept if include_low else kept.where(F.col("risk_level") != "low")


def cap_per_provider(alerts: DataFrame, n: int = 10) -> DataFrame:
    """At most n alerts per provider, by priority; alerts naming no provider all stay."""
    order = [F.col("priority_score").desc(), F.col("detector_name"), F.col("period")]
    own = F.coalesce("provider_npi", "alert_id")  # an alert without provider is alone in its group
    return latest_per_key(alerts.withColumn("_own", own), ["_own"], order, n).drop("_own")


def alert_claims(claims: DataFrame, alerts: DataFrame) -> DataFrame:
    """(alert_id, claim_id): every wheelchair claim of an upcoding alert, every claim of a spike month or a phantom day. Other alerts
    name no claims."""
    def of(detector: str) -> DataFrame:
        return alerts.where(F.col("detector_name") == detector).select("alert_id", "provider_npi", "period")

    base = claims.select("claim_id", "provider_npi", "service_date", "hcpcs_code")
    tier = R.wheelchair_tiers(claims.sparkSession).select("hcpcs_code")
    chairs = base.join(tier, "hcpcs_code", "left_semi").join(of("UpcodingDetector"), "provider_npi")
    days = base.withColumn("period", F.col("service_date").cast("string")).join(of("PhantomBillingDetector"), ["provider_npi", "period"])
    months = base.withColumn("period", F.date_format("service_date", "yyyy-MM")).join(of("VolumeAnomalyDetector"), ["provider_npi", "period"])
    pick = ["alert_id", "claim_id"]
    return chairs.select(pick).unionByName(days.select(pick)).unionByName(months.select(pick))


def flagged_claims(claims: DataFrame, links: DataFrame) -> DataFrame:
    return claims.join(links.select("claim_id"), "claim_id", "left_semi")


def top_flagged_providers(alerts: DataFrame, n: int = 10) -> DataFrame:
    return (alerts.where(F.col("provider_npi").isNotNull()).groupBy("provider_npi").agg(F.count("*").alias("alert_count"))
            .orderBy(F.col("alert_count").desc(), "provider_npi").limit(n))


def high_priority(alerts: DataFrame, minimum: int = 70) -> DataFrame:
    return alerts.where(F.col("priority_score") >= minimum)


def alerts_of_type(alerts: DataFrame, fraud_type: str) -> DataFrame:
    return alerts.where(F.col("fraud_type") == fraud_type)


def alerts_of_provider(alerts: DataFrame, npi: str) -> DataFrame:
    return alerts.where(F.col("provider_npi") == npi)


def summary(alerts: DataFrame, claims: DataFrame, links: DataFrame) -> DataFrame:
    """(section, item, value): totals by risk and type, top providers, flagged and analysed claims."""
    def rows(df: DataFrame, section: str, item: Column, value: Column) -> DataFrame:
        return df.select(F.lit(section).alias("section"), item.cast("string").alias("item"), value.cast("double").alias("value"))

    both = alerts.groupBy("risk_level", "fraud_type").agg(F.count("*").alias("n"))
    risk = both.groupBy("risk_level").agg(F.sum("n").alias("n"))
    kind = both.groupBy("fraud_type").agg(F.sum("n").alias("n"))
    flagged = flagged_claims(claims, links).agg(F.count("*").alias("n"), F.sum("billed_amount").alias("amount"))
    size = claims.agg(F.count("*").alias("n"), F.countDistinct("provider_npi").alias("p"))
    none = F.lit(None)
    parts = [
        rows(both.agg(F.sum("n").alias("n")), "total_alerts", none, F.coalesce("n", F.lit(0))),
        rows(risk, "by_risk_level", F.col("risk_level"), F.col("n")), rows(kind, "by_fraud_type", F.col("fraud_type"), F.col("n")),
        rows(top_flagged_providers(alerts), "top_flagged_providers", F.col("provider_npi"), F.col("alert_count")),
        rows(flagged, "flagged_claims_count", none, F.col("n")), rows(flagged, "flagged_amount_total", none, F.coalesce("amount", F.lit(0.0))),
        rows(size, "claims_analyzed", none, F.col("n")), rows(size, "providers_analyzed", none, F.col("p"))]
    return union_alerts(*parts)


def unit_price_stats(claims: DataFrame) -> DataFrame:
    df = with_derived(claims)
    return df.groupBy("hcpcs_code").agg(F.avg("unit_price").alias("avg_unit_price"),
                                        safe_ratio(F.count_if("is_high_value"), F.count("*")).alias("high_value_share"))

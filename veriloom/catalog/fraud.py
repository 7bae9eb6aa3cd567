"""Claim profiles, fraud detectors and the fraud pipeline.

Thresholds are set to the density of the provided tables; the defaults are the documented ones.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from veriloom.catalog import common  # noqa: F401
from veriloom.catalog.registry import frame_sql, query
from veriloom.operators import fraud, rules
from veriloom.plans import fraud as plan
from veriloom.session import materialise, work_dir
from veriloom.sources import claims as claim_files
from veriloom.sources import frames as src

AS_OF = "2001-12-31"
PARAMS = {"as_of": AS_OF, "phantom_cap": 2, "spike_z": 3.0, "kickback_share": 0.04, "new_provider_months": 90, "volume_percentile": 80.0}


@query("claim_preprocess", "claim_id provider_npi billed_amount:r2", "SELECT * FROM claims WHERE provider_npi <> '' AND billed_amount > 0")
def _(spark, d):
    return fraud.preprocess(src.claims(spark, d))


@query("claim_derived", "claim_id unit_price:r8 is_high_value", """
SELECT claim_id, CASE WHEN units > 0 THEN billed_amount / units ELSE 0 END AS unit_price, billed_amount >= 500 AS is_high_value FROM claims""")
def _(spark, d):
    return fraud.with_derived(src.claims(spark, d), 500.0)


@query("provider_profiles", "provider_npi total_claims:i total_amount:r2 avg_claim_amount:r4 unique_beneficiaries:i", """
SELECT provider_npi, count(*) AS total_claims, sum(billed_amount) AS total_amount, avg(billed_amount) AS avg_claim_amount, count(DISTINCT beneficiary_id) AS unique_beneficiaries
FROM claims GROUP BY 1""")
def _(spark, d):
    return fraud.provider_profiles(src.claims(spark, d))


@query("beneficiary_profiles", "beneficiary_id total_claims:i unique_providers:i distinct_equipment_types:i", """
SELECT beneficiary_id, count(*) AS total_claims, count(DISTINCT provider_npi) AS unique_providers, count(DISTINCT category) AS distinct_equipment_types
FROM claims LEFT JOIN x_equipment USING (hcpcs_code) GROUP BY 1""")
def _(spark, d):
    return fraud.beneficiary_profiles(src.claims(spark, d))


frame_sql("tier_share", """
SELECT *, (ratio - mean) / std AS z FROM (SELECT *, avg(ratio) OVER () AS mean, coalesce(stddev_samp(ratio) OVER (), 0.1) AS std FROM (
 SELECT provider_npi, count(*) AS n, count(*) FILTER (tier >= 4) / count(*) AS ratio FROM claims JOIN x_tiers USING (hcpcs_code) GROUP BY 1 HAVING count(*) >= 10))""")
frame_sql("al_upcoding", """
SELECT 'UpcodingDetector' AS detector_name, 'upcoding' AS fraud_type, CASE WHEN z > 3 THEN 'high' ELSE 'medium' END AS risk_level, least(0.95, 0.5 + (z - 2) * 0.15) AS confidence_score,
 provider_npi, CAST(NULL AS VARCHAR) AS period, n AS claim_count,
 'Provider shows ' || printf('%.1f', round(ratio * 100, 1)) || '% high-tier wheelchair claims vs peer average of ' || printf('%.1f', round(mean * 100, 1)) || '%' AS description,
 ratio * 100 AS observed_value, mean * 100 AS expected_value, z AS standard_deviations FROM tier_share WHERE z > 2""")
frame_sql("al_phantom", """
SELECT 'PhantomBillingDetector' AS detector_name, 'phantom_billing' AS fraud_type, CASE WHEN n > 100 THEN 'critical' ELSE 'high' END AS risk_level, least(0.95, 0.6 + n / 200) AS confidence_score,
 provider_npi, CAST(service_date AS VARCHAR) AS period, n AS claim_count, n || ' claims on ' || service_date || ' exceeds physical delivery capacity' AS description,
 CAST(n AS DOUBLE) AS observed_value, CAST(2 AS DOUBLE) AS expected_value, CAST(NULL AS DOUBLE) AS standard_deviations
FROM (SELECT provider_npi, service_date, count(*) AS n FROM claims GROUP BY 1, 2 HAVING count(*) > 2)""")
frame_sql("provider_month", f"""
SELECT *, row_number() OVER w - 1 AS month_index, avg(n) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS baseline,
 stddev_samp(n) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS baseline_std FROM (
 SELECT provider_npi, strftime(service_date, '%Y-%m') AS month, count(*) AS n, count(*) FILTER (hcpcs_code IN {tuple(rules.HIGH_RISK_CODES)!r}) AS risky FROM claims GROUP BY 1, 2)
WINDOW w AS (PARTITION BY provider_npi ORDER BY month)""")
frame_sql("al_volume", """
SELECT 'VolumeAnomalyDetector' AS detector_name, CASE WHEN z > 5 THEN 'hit_and_run' ELSE 'upcoding' END AS fraud_type,
 CASE WHEN risky / n > 0.5 THEN 'critical' WHEN z > 4 THEN 'high' ELSE 'medium' END AS risk_level, least(0.95, 0.5 + (z - 3) * 0.1) AS confidence_score, provider_npi, month AS period,
 n AS claim_count, 'Volume spike in ' || month || ': ' || n || ' claims vs baseline ' || printf('%.0f', round(baseline, 0)) AS description,
 CAST(n AS DOUBLE) AS observed_value, baseline AS expected_value, z AS standard_deviations
FROM (SELECT *, CASE WHEN baseline_std = 0 THEN 0 ELSE (n - baseline) / baseline_std END AS z FROM provider_month WHERE month_index >= 2) WHERE z > 3""")
frame_sql("al_kickback", """
SELECT 'KickbackPatternDetector' AS detector_name, 'kickback' AS fraud_type, CASE WHEN part > 0.8 THEN 'high' ELSE 'medium' END AS risk_level, least(0.9, part) AS confidence_score, provider_npi,
 ordering_physician_npi AS period, 0 AS claim_count, printf('%.1f', round(part * 100, 1)) || '% of claims from single ordering physician ' || ordering_physician_npi AS description,
 part * 100 AS observed_value, CAST(4 AS DOUBLE) AS expected_value, CAST(NULL AS DOUBLE) AS standard_deviations
FROM (SELECT *, n / sum(n) OVER (PARTITION BY provider_npi) AS part, sum(n) OVER (PARTITION BY provider_npi) AS total FROM (
 SELECT provider_npi, ordering_physician_npi, count(*) AS n FROM claims GROUP BY 1, 2)) WHERE total >= 20 AND part > 0.04""")
frame_sql("provider_total", """
SELECT provider_npi, sum(billed_amount) AS total, min(service_date) AS first, max(service_date) AS last, row_number() OVER (ORDER BY sum(billed_amount)) - 1 AS place, count(*) OVER () AS n
FROM claims GROUP BY 1""")
frame_sql("al_hitrun", f"""
SELECT 'HitAndRunDetector' AS detector_name, 'hit_and_run' AS fraud_type, CASE WHEN idle > 60 THEN 'critical' ELSE 'high' END AS risk_level, least(0.95, 0.7 + (total / cut - 1) * 0.1) AS confidence_score,
 provider_npi, CAST(NULL AS VARCHAR) AS period, 0 AS claim_count, 'New provider (' || printf('%.1f', round(active, 1)) || ' months) with top 20% billing volume'
  || CASE WHEN idle > 60 THEN ' - No claims for ' || idle || ' days (possible abandonment)' ELSE '' END AS description,
 total AS observed_value, cut AS expected_value, CAST(NULL AS DOUBLE) AS standard_deviations
FROM (SELECT *, (last - first + 1) / 30 AS active, DATE '{AS_OF}' - last AS idle, (SELECT total FROM provider_total WHERE place = CAST(floor(n * 80.0 / 100) AS BIGINT)) AS cut FROM provider_total)
WHERE active <= 90 AND total >= cut""")
frame_sql("all_alerts", """
SELECT *, least(100, CAST(floor(CASE risk_level WHEN 'low' THEN 10 WHEN 'medium' THEN 40 WHEN 'high' THEN 70 ELSE 90 END + confidence_score * 10) AS INTEGER)) AS priority_score FROM (
 SELECT * FROM al_upcoding UNION ALL SELECT * FROM al_phantom UNION ALL SELECT * FROM al_volume UNION ALL SELECT * FROM al_kickback UNION ALL SELECT * FROM al_hitrun)""")
frame_sql("kept_alerts", "SELECT * FROM all_alerts WHERE confidence_score >= 0.5 AND risk_level <> 'low'")
frame_sql("capped_alerts", """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY provider_npi ORDER BY priority_score DESC, detector_name, period NULLS FIRST) AS r FROM kept_alerts) WHERE r <= 10""")

ALERT = "detector_name fraud_type risk_level confidence_score:r provider_npi period claim_count:i description observed_value:r4 expected_value:r4 standard_deviations:r5"
RANKED = ALERT + " priority_score:i"


@query("detect_upcoding", ALERT, "SELECT * FROM al_upcoding")
def _(spark, d):
    return fraud.upcoding(src.claims(spark, d))


@query("detect_phantom", ALERT, "SELECT * FROM al_phantom")
def _(spark, d):
    return fraud.phantom(src.claims(spark, d), 2)


@query("running_baseline", "provider_npi month n:i month_index:i baseline:r baseline_std:r", "SELECT * FROM provider_month")
def _(spark, d):
    return fraud.running_baseline(fraud.provider_months(src.claims(spark, d)))


@query("detect_volume_spike", ALERT, "SELECT * FROM al_volume")
def _(spark, d):
    return fraud.volume_spike(src.claims(spark, d))


@query("detect_kickback", ALERT, "SELECT * FROM al_kickback")
def _(spark, d):
    return fraud.kickback(src.claims(spark, d), 0.04)


@query("kth_volume", "threshold:r2", "SELECT total AS threshold FROM provider_total WHERE place = CAST(floor(n * 95.0 / 100) AS BIGINT)")
def _(spark, d):
    return fraud.kth_volume(fraud.provider_totals(src.claims(spark, d)), 95.0)


@query("detect_hit_and_run", ALERT, "SELECT * FROM al_hitrun")
def _(spark, d):
    return fraud.hit_and_run(src.claims(spark, d), AS_OF, 90, 80.0)


def _alerts(spark, d):
    return plan.detect_side_by_side(plan.stored_claims(src.claims(spark, d)), PARAMS, list(fraud.DETECTORS))


@query("detector_union", "detector_name n:i", "SELECT detector_name, count(*) AS n FROM all_alerts GROUP BY 1")
def _(spark, d):
    return _alerts(spark, d).groupBy("detector_name").agg(F.count("*").alias("n"))


@query("alerts_ranked", RANKED, "SELECT * FROM all_alerts")
def _(spark, d):
    return fraud.ranked(_alerts(spark, d))


@query("alerts_per_provider_cap", RANKED, "SELECT * FROM capped_alerts")
def _(spark, d):
    return fraud.cap_per_provider(fraud.keep_confident(_alerts(spark, d)))


def _run(spark, d, **options):
    return plan.run(src.claims(spark, d), AS_OF, params=PARAMS, **options)


@query("fraud_pipeline", RANKED, "SELECT * FROM kept_alerts")
def _(spark, d):
    return fraud.ranked(_run(spark, d, with_summary=False).alerts)


frame_sql("alert_links", """
SELECT detector_name, provider_npi, period, claim_id FROM kept_alerts a JOIN claims c USING (provider_npi) JOIN x_tiers USING (hcpcs_code) WHERE detector_name = 'UpcodingDetector'
UNION ALL SELECT detector_name, a.provider_npi, period, claim_id FROM kept_alerts a JOIN claims c ON a.provider_npi = c.provider_npi AND period = CAST(service_date AS VARCHAR) WHERE detector_name = 'PhantomBillingDetector'
UNION ALL SELECT detector_name, a.provider_npi, period, claim_id FROM kept_alerts a JOIN claims c ON a.provider_npi = c.provider_npi AND period = strftime(service_date, '%Y-%m')
 WHERE detector_name = 'VolumeAnomalyDetector'""")


@query("alert_claims", "detector_name provider_npi period claim_id", "SELECT * FROM alert_links")
def _(spark, d):
    r = _run(spark, d, with_summary=False)
    return r.links.join(r.alerts.select("alert_id", "detector_name", "provider_npi", "period"), "alert_id")


@query("flagged_claims", "claim_id provider_npi billed_amount:r2", "SELECT * FROM claims WHERE claim_id IN (SELECT claim_id FROM alert_links)")
def _(spark, d):
    r = _run(spark, d, with_summary=False)
    return fraud.flagged_claims(src.claims(spark, d), r.links)


frame_sql("top_flagged", "SELECT provider_npi, count(*) AS alert_count FROM kept_alerts GROUP BY 1 ORDER BY alert_count DESC, provider_npi LIMIT 10")


@query("top_flagged_providers", "provider_npi alert_count:i", "SELECT * FROM top_flagged")
def _(spark, d):
    return fraud.top_flagged_providers(_run(spark, d, with_summary=False).alerts)


SUMMARY_SQL = """
SELECT 'total_alerts' AS section, CAST(NULL AS VARCHAR) AS item, count(*) AS value FROM kept_alerts
UNION ALL SELECT 'by_risk_level', risk_level, count(*) FROM kept_alerts GROUP BY 2 UNION ALL SELECT 'by_fraud_type', fraud_type, count(*) FROM kept_alerts GROUP BY 2
UNION ALL SELECT 'top_flagged_providers', provider_npi, alert_count FROM top_flagged
UNION ALL SELECT 'flagged_claims_count', NULL, count(*) FROM claims WHERE claim_id IN (SELECT claim_id FROM alert_links)
UNION ALL SELECT 'flagged_amount_total', NULL, sum(billed_amount) FROM claims WHERE claim_id IN (SELECT claim_id FROM alert_links)
UNION ALL SELECT 'claims_analyzed', NULL, count(*) FROM claims UNION ALL SELECT 'providers_analyzed', NULL, count(DISTINCT provider_npi) FROM claims"""


@query("alert_summary", "section item value:r2", SUMMARY_SQL)
def _(spark, d):
    return _run(spark, d).summary


@query("high_priority_alerts", RANKED, "SELECT * FROM kept_alerts WHERE priority_score >= 70")
def _(spark, d):
    return fraud.high_priority(_run(spark, d, with_summary=False).alerts)


@query("alerts_by_type", RANKED, "SELECT * FROM kept_alerts WHERE fraud_type = 'phantom_billing'")
def _(spark, d):
    return fraud.alerts_of_type(_run(spark, d, with_summary=False).alerts, "phantom_billing")


@query("alerts_by_provider", RANKED, "SELECT * FROM kept_alerts WHERE provider_npi = '0000000007'")
def _(spark, d):
    return fraud.alerts_of_provider(_run(spark, d, with_summary=False).alerts, "0000000007")


@query("percentile_rank", "provider_npi total:r2 percentile_rank:r", "SELECT provider_npi, total, place / n * 100 AS percentile_rank FROM provider_total")
def _(spark, d):
    return fraud.percentile_rank(fraud.provider_totals(src.claims(spark, d)), "total", ties=["provider_npi"])


@query("zscore", "provider_npi z:r", """
SELECT provider_npi, (total - avg(total) OVER ()) / stddev_samp(total) OVER () AS z FROM provider_total""")
def _(spark, d):
    t = materialise(fraud.provider_totals(src.claims(spark, d)), "totals")
    m = t.agg(F.struct(F.avg("total").alias("mean"), F.stddev_samp("total").alias("std")).alias("s")).scalar()
    return t.withColumn("s", m).withColumn("z", fraud.zscore(F.col("total"), F.col("s.mean"), F.col("s.std")))


@query("alerts_sink", "fraud_type risk_level provider_npi claim_count:i observed_value:r4 section item value:r2", f"""
SELECT fraud_type, risk_level, provider_npi, claim_count, observed_value, 'alerts' AS section, CAST(NULL AS VARCHAR) AS item, CAST(NULL AS DOUBLE) AS value FROM kept_alerts
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, section, item, coalesce(value, 0) FROM ({SUMMARY_SQL})""")
def _(spark, d):
    path = work_dir(spark, "alerts-json")
    run = _run(spark, d)
    claim_files.write_run(run.alerts.withColumn("created_at", F.lit(AS_OF)), run.summary, run.notes, path)
    return claim_files.read_run(spark, path)


def _weekend_detector(claims, params):
    """A custom detector: providers with most claims on weekends."""
    weekend = F.count_if(F.dayofweek("service_date").isin(1, 7))
    share = claims.groupBy("provider_npi").agg(F.count("*").alias("n"), weekend.alias("w")).where("w * 10 > n * 3")
    return fraud._alerts(
        share, "WeekendDetector", F.lit("upcoding"), F.lit("medium"), F.lit(0.6), period=F.lit(None), count=F.lit(0),
        description=F.lit("Mostly weekend services"), evidence=F.lit(""), rules=["WEEKEND"], observed=F.col("w") / F.col("n"), expected=F.lit(0.3))


@query("register_detector", "detector_name provider_npi observed_value:r", """
SELECT 'WeekendDetector' AS detector_name, provider_npi, count(*) FILTER (dayofweek(service_date) IN (0, 6)) / count(*) AS observed_value FROM claims GROUP BY 2
HAVING count(*) FILTER (dayofweek(service_date) IN (0, 6)) * 10 > count(*) * 3""")
def _(spark, d):
    fraud.register_detector("weekend", _weekend_detector)
    try:
        return fraud.run_detectors(src.claims(spark, d), PARAMS, ["weekend"])
    finally:
        fraud.remove_detector("weekend")

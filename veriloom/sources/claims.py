"""Claim, provider and alert files."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriloom.functions.parse import parse_date, parse_money, parse_text, parse_units
from veriloom.operators.skew import latest_per_key
from veriloom.schema import struct
from veriloom.session import materialise
from veriloom.sources import json_documents

# fixed values: public CMS header names -> our columns
CLAIM_HEADERS = {
    "CLM_ID": "claim_id", "PRVDR_NPI": "provider_npi", "BENE_ID": "beneficiary_id",
    "CLM_FROM_DT": "service_date", "CLM_THRU_DT": "claim_date", "HCPCS_CD": "hcpcs_code",
    "HCPCS_1ST_MDFR_CD": "hcpcs_modifier", "ICD_DGNS_CD1": "icd10_diagnosis",
    "CLM_PMT_AMT": "paid_amount", "NCH_CLM_PRVDR_PMT_AMT": "allowed_amount",
    "CLM_TOT_CHRG_AMT": "billed_amount", "LINE_SRVC_CNT": "units",
    "PRVDR_STATE_CD": "place_of_service", "ORD_PHYSN_NPI": "ordering_physician_npi",
}
PROVIDER_HEADERS = {
    "NPI": "npi", "PRVDR_LGL_NM": "legal_business_name", "PRVDR_DBA_NM": "doing_business_as",
    "PRVDR_1ST_LN_ADR": "address_line1", "PRVDR_2ND_LN_ADR": "address_line2", "PRVDR_CITY": "city",
    "PRVDR_STATE": "state", "PRVDR_ZIP": "zip_code", "ENRLMT_DT": "enrollment_date",
}
DATES = {"service_date", "claim_date", "enrollment_date", "revalidation_date"}
MONEY = {"billed_amount", "allowed_amount", "paid_amount", "beneficiary_liability"}
COUNTS = {"units", "days_supply"}

CLAIM_SCHEMA = struct(
    "claim_id string, provider_npi string, beneficiary_id string, service_date date, claim_date date, "
    "hcpcs_code string, hcpcs_modifier string, icd10_diagnosis string, billed_amount double, allowed_amount double, "
    "paid_amount double, beneficiary_liability double, units int, days_supply int, place_of_service string, "
    "ordering_physician_npi string, prior_authorization boolean, certificate_of_medical_necessity boolean, "
    "status string, denial_reason string, fraud_flags array<string>, risk_score double")

#: As the claims stand in JSON: days are text.
RECORD_SCHEMA = T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.DateType) else f.dataType) for f in CLAIM_SCHEMA.fields])


def _typed(raw: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    def convert(source: str, name: str) -> Column:
        text = F.col(f"`{source}`")
        if name in DATES:
            return parse_date(text).alias(name)
        if name in MONEY:
            return parse_money(text).alias(name)
        if name in COUNTS:
            return parse_units(text).alias(name)
        return parse_text(text).alias(name)

    return raw.select([convert(s, n) for s, n in mapping.items() if s in raw.columns])


def _text_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)


def read_claims_csv(spark: SparkSession, path: str, mapping: Mapping[str, str] = CLAIM_HEADERS,
                    limit: int | None = None) -> DataFrame:
    """Claims by header name, parsed leniently. Every column is read as text first, so no row is lost."""
    raw = _text_csv(spark, path)
    return _typed(raw if limit is None else raw.limit(limit), mapping)


def read_claims_json(spark: SparkSession, path: str, limit: int | None = None, multiline: bool = False) -> DataFrame:
    """Claims as records, arrays of records, or objects holding them under ``claims``. By default a line is one of these: such
    files split across tasks. ``multiline=True`` reads a document spread over lines, each file whole by one task."""
    text = RECORD_SCHEMA
    both = T.StructType([*text.fields, T.StructField("claims", T.ArrayType(text))])
    raw = spark.read.schema(both).option("multiLine", multiline).json(path)
    record = F.struct(*[f.name for f in text.fields])
    flat = raw.select(F.inline(F.coalesce(F.col("claims"), F.array(record))))
    out = flat.select([(parse_date(F.col(f.name)) if f.name in DATES else F.col(f.name)).alias(f.name) for f in text.fields])
    return out if limit is None else out.limit(limit)


def read_claims_documents(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Claims of documents of any size and layout: an array of records, or an object holding them under ``claims``. A document is read
    by as many tasks as its length gives (``json_documents``); a record that isn't JSON is left out."""
    raw = json_documents.records(spark, path).select(F.from_json("record", RECORD_SCHEMA).alias("r"))
    out = raw.where(F.col("r").isNotNull()).select([(parse_date(F.col(f"r.{f.name}")) if f.name in DATES else F.col(f"r.{f.name}")).alias(f.name) for f in RECORD_SCHEMA.fields])
    return out if limit is None else out.limit(limit)


def write_documents(claims: DataFrame, path: str, most: int = 100_000) -> str:
    """Objects that hold up to ``most`` claims each under ``claims``, one file each and a claim a line. A task writes its own claims as they come, so
    none are shuffled and the number of documents follows the table."""
    first, after = '{"format": "claims {1}",\n"claims": [\n', "\n]}"

    def framed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, held = 0, None  # the last line so far is held back: it may end the document
        for batch in batches:
            lines = batch.column(0).to_pylist()
            texts = [f"{'' if i % most else first}{',' if i % most else ''}{x}{'' if (i + 1) % most else after}" for i, x in enumerate(lines, n)]
            if held is not None:
                texts.insert(0, held)
            n += len(lines)
            held = texts.pop() if texts else None
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["value"])
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held + (after if n % most else "")], pa.string())], ["value"])

    claims.select(F.to_json(F.struct("*")).alias("value")).mapInArrow(framed, "value string").write.option("maxRecordsPerFile", most).text(path)
    return path


def read_providers_csv(spark: SparkSession, path: str, mapping: Mapping[str, str] = PROVIDER_HEADERS) -> DataFrame:
    """Providers with a ten-character npi; of several rows the last wins, by the name of the file and the place in it."""
    raw = _text_csv(spark, path)
    header = next(s for s, n in mapping.items() if n == "npi")
    if header not in raw.columns:
        raise ValueError(f"no {header} column in {path}")
    # ids grow within a split; which split comes first is not said by them, but by file and start
    place = {"_file": F.col("_metadata.file_path"), "_start": F.col("_metadata.file_block_start"), "_line": F.monotonically_increasing_id()}
    names = [*mapping.values()]
    rows = _typed(raw.withColumns(place), {**mapping, "_file": "_file", "_start": "_start", "_line": "_line"})
    rows = rows.withColumns({"_start": F.col("_start").cast("bigint"), "_line": F.col("_line").cast("bigint")}).where(F.length("npi") == 10)
    last = latest_per_key(rows, ["npi"], [F.col("_file").desc(), F.col("_start").desc(), F.col("_line").desc()])
    return last.select(*[n for n in names if n in last.columns])


def write_claims(claims: DataFrame, path: str, fmt: str = "csv") -> str:
    """CSV with arrays as JSON text and ISO dates, or JSON lines, which are compressed: the text is some five times as long as the table."""
    if fmt == "json":
        claims.write.option("compression", "gzip").json(path)
        return path
    cols = [F.to_json(f.name).alias(f.name) if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) else F.col(f.name)
            for f in claims.schema.fields]
    claims.select(cols).write.option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)
    return path


def documents(claims: DataFrame, key: Column, claim: str = "claim_id", most: int = 1000) -> DataFrame:
    """Arrays ``claims`` of whole claims that share ``key``, about ``most / 2`` each, so hardly ever over ``most``, however many share it.

    A key's claims are dealt by a hash of ``claim``, their id, into buckets whose number comes from the key's count. A null key is one.
    """
    stored = materialise(claims.select(F.coalesce(key.cast("string"), F.lit("")).alias("_key"), key.isNull().alias("_none"), F.struct("*").alias("_claim")), "claims")
    sizes = stored.groupBy("_key", "_none").agg(F.ceil(F.count("*") * 2 / most).alias("_buckets"))
    dealt = stored.join(sizes, ["_key", "_none"]).withColumn("_bucket", F.pmod(F.xxhash64(f"_claim.{claim}"), F.col("_buckets")))
    return dealt.groupBy("_key", "_none", "_bucket").agg(F.collect_list("_claim").alias("claims")).select("claims")


#: Documents of a table of more rows are written compressed. Smaller ones stay readable as they are.
MOST_PLAIN = 1_000_000


def write_texts(lines: DataFrame, path: str, rows: int, most_a_file: int = 0) -> str:
    """A column of text, ``most_a_file`` lines a file (0: as they come), of a table of about ``rows`` rows."""
    lines.write.option("maxRecordsPerFile", most_a_file).option("compression", "gzip" if rows > MOST_PLAIN else "none").text(path)
    return path


#: What stands in JSON of an alert, of a line of the summary, and of a note.
ALERT_SCHEMA = struct(
    "alert_id string, fraud_type string, risk_level string, confidence_score double, provider_npi string, claim_count bigint, description string, "
    "observed_value double, expected_value double, recommended_action string, created_at string")
SUMMARY_SCHEMA = struct("section string, item string, value double")
NOTE_SCHEMA = struct("code string, detail string")


def write_alerts(alerts: DataFrame, path: str) -> str:
    """Alert records as JSON lines; the claim list is reduced to its size."""
    alerts.select(*ALERT_SCHEMA.names).write.json(path)
    return path


def write_run(alerts: DataFrame, summary: DataFrame, notes: DataFrame, path: str) -> str:
    """All that a run says, as JSON lines: its alerts, their summary and its notes, each in a folder of ``path``."""
    write_alerts(alerts, f"{path}/alerts")
    summary.write.json(f"{path}/summary")
    notes.write.json(f"{path}/notes")
    return path


def read_run(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_run`` wrote as one frame: alerts, their ``section`` being alerts, and the rows (section, item, value) of the summary and
    of the notes, those with their code and detail as item. A run without alerts or notes is read as well."""
    alerts = spark.read.schema(ALERT_SCHEMA).json(f"{path}/alerts").withColumn("section", F.lit("alerts"))
    summary = spark.read.schema(SUMMARY_SCHEMA).json(f"{path}/summary")
    notes = spark.read.schema(NOTE_SCHEMA).json(f"{path}/notes").select(F.lit("notes").alias("section"), F.concat_ws(" ", "code", "detail").alias("item"))
    return alerts.unionByName(summary, allowMissingColumns=True).unionByName(notes, allowMissingColumns=True)

"""Schema conformance, cleaning, de-duplication and load checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veriloom.functions.hashing import row_hash
from veriloom.operators.skew import latest_per_key
from veriloom.schema import struct


# fixed values: column layouts of the silver tables
SCHEMAS = {
    "LabResults": struct(
        "ResultId bigint not null, PatientId bigint not null, OrderId bigint not null, TestCode string not null, "
        "ResultValue string, ResultValueNumeric double, ResultUnit string, ReferenceRangeMin double, "
        "ReferenceRangeMax double, AbnormalFlag string, ResultStatus string, ResultDate timestamp not null, "
        "PerformingLabId int, TechnicianId string, SpecimenId bigint, Comments string, "
        "CreatedDate timestamp not null, ModifiedDate timestamp not null"),
    "Patients": struct(
        "PatientId bigint not null, MRN string not null, FirstName string not null, LastName string not null, "
        "DateOfBirth date not null, Gender string, Race string, Ethnicity string, "
        "CreatedDate timestamp not null, ModifiedDate timestamp not null"),
    "TestMaster": struct(
        "TestCode string not null, TestName string not null, LoincCode string, TestCategory string, "
        "SpecimenType string, ResultType string, TurnaroundTimeMinutes int, IsActive boolean not null, "
        "CreatedDate timestamp not null, ModifiedDate timestamp not null"),
}
# fixed values: keys, upper-cased columns and required columns per table
PRIMARY_KEYS = {"LabResults": ["ResultId"], "Patients": ["PatientId"], "TestMaster": ["TestCode"],
                "Specimens": ["SpecimenId"], "Orders": ["OrderId"]}
UPPER_COLUMNS = {"LabResults": ["AbnormalFlag", "ResultStatus"], "Patients": ["Gender", "MRN"]}
REQUIRED = {"LabResults": ["ResultId", "PatientId", "TestCode", "ResultDate"],
            "Patients": ["PatientId", "MRN", "DateOfBirth"], "TestMaster": ["TestCode", "TestName"]}


def conform(df: DataFrame, schema: T.StructType | None) -> DataFrame:
    """Exactly the schema's columns in its order: cast leniently, NULL where missing. No schema: unchanged."""
    if schema is None:
        return df
    have = set(df.columns)
    return df.select([
        (F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields])


def standardize(df: DataFrame, upper_cols: Sequence[str] = ()) -> DataFrame:
    """Trim every string column, upper-case the named ones, in one projection."""
    def clean(field: T.StructField) -> Column:
        if not isinstance(field.dataType, T.StringType):
            return F.col(field.name)
        out = F.trim(field.name)
        return (F.upper(out) if field.name in upper_cols else out).alias(field.name)

    return df.select([clean(f) for f in df.schema.fields])


def with_technical_columns(df: DataFrame, load_date: str, as_of: Column | None = None,
                           source: Column | None = None) -> DataFrame:
    """Load time, load date, source file and row hash. Frames read from files carry ``_metadata``."""
    hashed = row_hash(df)
    return df.select(
        "*", (as_of if as_of is not None else F.current_timestamp()).alias("_load_timestamp"),
        F.lit(load_date).alias("_load_date"),
        (source if source is not None else F.col("_metadata.file_path")).alias("_source_file"),
        hashed.alias("_row_hash"))


def dedupe_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order_by``; pass a tie-breaker for repeatable results."""
    return latest_per_key(df, keys, order_by)


def duplicate_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return (df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")
            .withColumn("duplicates", F.col("n_rows") - 1))


def load_checks(df: DataFrame, required: Sequence[str], negative: Sequence[str] = (),
                ranges: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """One pass over the data: (check_name, value) rows."""
    checks: dict[str, Column] = {"record_count": F.count("*")}
    for c in required:
        checks[f"{c}_null_count"] = F.count_if(F.col(c).isNull())
    for c in negative:
        checks[f"negative_{c}"] = F.count_if(F.col(c) < 0)
    for lo, hi in ranges:
        checks[f"inverted_{lo}_{hi}"] = F.count_if(F.col(lo) > F.col(hi))
    row = df.agg(*[c.alias(n) for n, c in checks.items()])
    return unpivot(row, checks, "check_name", "value")


def unpivot(row: DataFrame, names: Sequence[str] | Mapping, name_col: str, value_col: str,
            keep: Sequence[str] = ()) -> DataFrame:
    """Wide columns to (name, value) rows."""
    pairs = F.array(*[F.struct(F.lit(n).alias(name_col), F.col(n).alias(value_col)) for n in names])
    return row.select(*keep, F.inline(pairs))


def bronze_to_silver(df: DataFrame, table: str, load_date: str, as_of: Column | None = None,
                     source: Column | None = None) -> DataFrame:
    """Conform, clean, stamp and de-duplicate raw rows of one table. Unknown tables pass unconformed and keep
    their duplicates, as no key is known for them."""
    out = standardize(conform(df, SCHEMAS.get(table)), UPPER_COLUMNS.get(table, ()))
    out = with_technical_columns(out, load_date, as_of, source if source is not None else F.lit(table))
    keys = PRIMARY_KEYS.get(table)
    if keys is None:
        return out
    return dedupe_latest(out, keys, [F.col("ModifiedDate").desc(), F.col("_row_hash")])

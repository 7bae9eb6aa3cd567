"""Row hashes, masking and signatures."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: personal health information fields
PHI_FIELDS = (
    "PatientId", "MRN", "FirstName", "LastName", "DateOfBirth",
    "ResultValue", "ResultValueNumeric", "SpecimenId",
)


def row_hash(df: DataFrame, cols: Iterable[str] | None = None) -> Column:
    """md5 over the '||'-joined text of all columns whose name does not start with '_'."""
    names = list(cols) if cols is not None else [c for c in df.columns if not c.startswith("_")]
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names]
    return F.md5(F.concat_ws("||", *parts))


def mask_phi(df: DataFrame, fields: Iterable[str] = PHI_FIELDS, mode: str = "hash") -> DataFrame:
    """Replace PHI columns by their SHA-256 text (``hash``) or by NULL (``null``)."""
    hidden = set(fields)

    def masked(name: str) -> Column:
        if name not in hidden:
            return F.col(name)
        if mode == "null":
            return F.lit(None).cast(df.schema[name].dataType).alias(name)
        return F.sha2(F.col(name).cast("string"), 256).alias(name)

    return df.select([masked(c) for c in df.columns])


def change_signature(user: Column, time: Column, reason: Column) -> Column:
    """Upper-case SHA-256 of user, time and reason joined by '|'."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (user, time, reason)]
    joined = F.concat_ws("|", *parts)
    return F.upper(F.sha2(joined, 256))


def forecast_id(name: Column, made: Column, target: Column) -> Column:
    return F.concat_ws("_", name, F.date_format(made, "yyyyMMdd"), F.date_format(target, "yyyyMMdd"))

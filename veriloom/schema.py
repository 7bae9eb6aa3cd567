"""Schemas from short text, usable before a session exists."""

from __future__ import annotations

from pyspark.sql import types as T

TYPES = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
         "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType(),
         "array<string>": T.ArrayType(T.StringType())}


def struct(text: str) -> T.StructType:
    """'a bigint not null, b string' -> StructType."""
    fields = []
    for part in text.split(","):
        name, kind, *rest = part.split()
        fields.append(T.StructField(name, TYPES[kind], rest != ["not", "null"]))
    return T.StructType(fields)

"""Registration of queries, and the SQL side's shared table expressions."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriloom.functions.parse import round_half_away

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
FRAMES_SQL: dict[str, str] = {}


def frame_sql(name: str, body: str) -> None:
    """Define a table expression that oracle SQL may mention by name."""
    FRAMES_SQL[name] = body


def _mentioned(body: str) -> list[str]:
    return [n for n in FRAMES_SQL if re.search(rf"\b{n}\b", body)]


def with_frames(body: str) -> str:
    """Prepend every table expression the body needs, dependencies first."""
    order: list[str] = []

    def visit(name: str, trail: tuple[str, ...]) -> None:
        if name in order or name in trail:
            return
        for other in _mentioned(FRAMES_SQL[name]):
            if other != name:
                visit(other, (*trail, name))
        order.append(name)

    for name in _mentioned(body):
        visit(name, ())
    if not order:
        return body.strip()
    heads = ",\n".join(f"{n} AS ({FRAMES_SQL[n].strip()})" for n in order)
    text = body.strip()
    if text[:5].upper() == "WITH ":
        return f"WITH {heads},\n{text[5:]}"
    return f"WITH {heads}\n{text}"


# output kinds: plain, i integer, r rounded double, d date, t timestamp, s text, j array joined by '|'
def _spark_column(name: str, kind: str):
    c = F.col(f"`{name}`")
    if kind == "i":
        c = c.cast("bigint")
    elif kind[:1] == "r":
        c = round_half_away(c, int(kind[1:] or 6)) + F.lit(0.0)
    elif kind in ("d", "s"):
        c = c.cast("string")
    elif kind == "t":
        c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    elif kind == "j":
        c = F.array_join(c, "|")
    return c.alias(name)


def _sql_column(name: str, kind: str) -> str:
    c = f'"{name}"'
    if kind == "i":
        c = f"CAST({c} AS BIGINT)"
    elif kind[:1] == "r":
        c = f"round(CAST({c} AS DOUBLE), {int(kind[1:] or 6)}) + CAST(0.0 AS DOUBLE)"
    elif kind in ("d", "s"):
        c = f"CAST({c} AS VARCHAR)"
    elif kind == "t":
        c = f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"
    elif kind == "j":
        c = f"array_to_string({c}, '|')"
    return f'{c} AS "{name}"'


def query(name: str, columns: str | None = None, sql: str | None = None):
    """Register a query. ``columns`` ("name:kind ...") is projected on both sides so that types agree; ``sql``
    is the oracle, left out where SQL cannot express the operator or is too slow on whole tables."""

    def keep(fn):
        if name in QUERIES:
            raise ValueError(f"{name} registered twice")
        spec = [(c.partition(":")[0], c.partition(":")[2]) for c in columns.split()] if columns else None
        if spec is None:
            QUERIES[name] = fn
        else:
            QUERIES[name] = lambda spark, folder: fn(spark, folder).select(*[_spark_column(c, k) for c, k in spec])
        if sql is not None:
            body = sql.strip()
            if spec is not None:
                body = f"SELECT {', '.join(_sql_column(c, k) for c, k in spec)} FROM (\n{body}\n) AS result"
            ORACLES[name] = with_frames(body)
        return fn

    return keep

"""Lenient parsing of text fields. ANSI mode raises on bad casts, so every cast here is a try."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def blank_to_null(text: Column) -> Column:
    return F.when(F.trim(text) != "", text)


def parse_money(text: Column) -> Column:
    """'$1,234.50' -> 1234.5; unreadable -> 0.0; blank -> NULL."""
    bare = F.trim(F.regexp_replace(text, r"[$,]", ""))
    number = F.when(bare.rlike(NUMBER), bare.try_cast("double"))
    return F.when(blank_to_null(text).isNotNull(), F.coalesce(number, F.lit(0.0)))


def parse_units(text: Column) -> Column:
    """'3.0' -> 3 (fraction dropped); unreadable -> 1; blank -> NULL."""
    bare = F.trim(text)
    number = F.when(bare.rlike(NUMBER), bare.try_cast("double")).try_cast("bigint")
    return F.when(blank_to_null(text).isNotNull(), F.coalesce(number, F.lit(1).cast("bigint")))


def parse_date(text: Column) -> Column:
    """ISO day; anything else -> NULL."""
    shape = text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$")
    return F.when(shape, F.try_to_date(text, "yyyy-M-d"))


def parse_text(text: Column) -> Column:
    return F.trim(blank_to_null(text))


def safe_ratio(top: Column, bottom: Column, default: float = 0.0) -> Column:
    """top / bottom, ``default`` when bottom is zero or NULL."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(default))


def join_issues(*issues: Column) -> Column:
    """'; '-joined text of the issues that are not NULL; '' when there are none."""
    return F.array_join(F.array_compact(F.array(*issues)), "; ")


def round_half_away(c: Column, places: int) -> Column:
    """A double to ``places`` decimals, halves away from zero, rounded on the scaled double as SQL engines do. Spark's own round goes
    by the shortest decimal text, so the two part at ties that a double only nearly holds: 1.005 is 1.01 there and 1.0 here."""
    x, scale = c.cast("double"), F.lit(10.0 ** places)
    return F.when(F.abs(x) < 1e290, F.round(x * scale, 0) / scale).otherwise(x)


def fixed_text(c: Column, places: int) -> Column:
    """Text with ``places`` decimals; what rounds to zero from below keeps its sign, as printf writes it; NULL for NULL."""
    x = c.cast("double")
    digits = F.format_string(f"%.{places}f", F.abs(round_half_away(x, places)))
    return F.when(x.isNotNull(), F.concat(F.when(x < 0, "-").otherwise(""), digits))

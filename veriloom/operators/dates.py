"""Calendar spines and the date and time dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STEPS = {"day": "INTERVAL 1 DAY", "month": "INTERVAL 1 MONTH", "quarter": "INTERVAL 3 MONTH"}


def date_spine(spark: SparkSession, start: str, end: str, step: str = "day") -> DataFrame:
    """Every day, month or quarter from start to end, both included."""
    return spark.range(1).select(
        F.explode(F.expr(f"sequence(DATE '{start}', DATE '{end}', {STEPS[step]})")).alias("date"))


def spine_over(df: DataFrame, column: str, step: str = "day") -> DataFrame:
    """The spine between a column's least and greatest date; one aggregate over the data."""
    bounds = df.agg(F.min(F.col(column).cast("date")).alias("lo"), F.max(F.col(column).cast("date")).alias("hi"))
    return bounds.select(F.explode(F.expr(f"sequence(lo, hi, {STEPS[step]})")).alias("date"))


def date_key(d: Column) -> Column:
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_dimension(spine: DataFrame) -> DataFrame:
    """Calendar and fiscal attributes per date; the fiscal year starts in July. Weeks start on Sunday and
    week 1 holds 1 January."""
    d = F.col("date")
    month = F.month(d)
    first_weekday = F.dayofweek(F.trunc(d, "year"))
    return spine.select(
        date_key(d).alias("DateKey"), d.alias("Date"), F.year(d).alias("Year"), F.quarter(d).alias("Quarter"),
        month.alias("Month"), F.date_format(d, "MMMM").alias("MonthName"),
        F.floor((F.dayofyear(d) + first_weekday - 2) / 7 + 1).cast("int").alias("Week"),
        F.dayofyear(d).alias("DayOfYear"), F.dayofmonth(d).alias("DayOfMonth"), F.dayofweek(d).alias("DayOfWeek"),
        F.date_format(d, "EEEE").alias("DayName"), F.dayofweek(d).isin(1, 7).alias("IsWeekend"),
        F.lit(False).alias("IsHoliday"),
        (F.year(d) + F.when(month >= 7, 1).otherwise(0)).alias("FiscalYear"),
        F.when(month >= 7, F.floor((month - 7) / 3) + 1).otherwise(F.floor((month - 1) / 3) + 3).cast("int").alias("FiscalQuarter"),
        F.when(month >= 7, month - 6).otherwise(month + 6).alias("FiscalMonth"))


def new_dates(dim_date: DataFrame, spine: DataFrame) -> DataFrame:
    """Spine dates the dimension does not hold yet."""
    return spine.join(dim_date.select(F.col("Date").alias("date")), "date", "left_anti")


def time_key(ts: Column) -> Column:
    """Minute of the day."""
    return (F.hour(ts) * 60 + F.minute(ts)).cast("int")


def time_dimension(minutes: DataFrame) -> DataFrame:
    """Attributes per ``TimeKey``: hour bucket, business hours (08-17), shift."""
    hour = F.floor(F.col("TimeKey") / 60).cast("int")
    return minutes.select(
        "TimeKey", hour.alias("Hour"), (F.col("TimeKey") % 60).cast("int").alias("Minute"),
        F.format_string("%02d:00-%02d:00", hour, hour + 1).alias("HourBucket"),
        ((hour >= 8) & (hour < 17)).alias("IsBusinessHours"),
        F.when((hour >= 7) & (hour < 15), "Morning").when((hour >= 15) & (hour < 23), "Afternoon")
        .otherwise("Night").alias("Shift"))


def full_time_dimension(spark: SparkSession) -> DataFrame:
    return time_dimension(spark.range(1440).select(F.col("id").cast("int").alias("TimeKey")))

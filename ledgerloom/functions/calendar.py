"""Dates and times: shifts, renderings, ages in hours and the month calendar."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Day rendering, local zone and the first day of an open history.
DAY_FORMAT = "dd/MM/yyyy"
LOCAL_ZONE = "America/Sao_Paulo"
EPOCH = date(1900, 1, 1)


def or_epoch(day: Column) -> Column:
    """The day, or the first day of history where it is unknown."""
    return F.coalesce(day, F.lit(EPOCH))


def render_day(day: Column) -> Column:
    return F.date_format(day, DAY_FORMAT)


def shift_days(day: Column, days: int) -> Column:
    return F.date_add(day, days)


def local_day_and_time(utc: Column, zone: str = LOCAL_ZONE) -> tuple[Column, Column]:
    """Local day and wall-clock time, as text, of a UTC timestamp."""
    local = F.from_utc_timestamp(utc, zone)
    return F.date_format(local, DAY_FORMAT), F.date_format(local, "HH:mm:ss")


def hours_since(stamp: Column, now: datetime | Column) -> Column:
    """Hours between a timestamp and now; null for a null timestamp."""
    micros = F.unix_micros(F.lit(now).cast("timestamp")) - F.unix_micros(stamp.cast("timestamp"))
    return micros / F.lit(3.6e9)


def months_between(start: Column, end: Column) -> Column:
    """List of the first days of all months from the one of ``start`` up to ``end``."""
    return F.sequence(F.trunc(start, "MM").cast("date"), end.cast("date"), F.expr("interval 1 month"))


def month_ranges(spark: SparkSession, start: date, end: date) -> DataFrame:
    """First and last day of every month from start to end; the last range runs to its month's end."""
    months = spark.range(1).select(F.explode(months_between(F.lit(start), F.lit(end))).alias("first_day"))
    return months.select("first_day", F.last_day("first_day").alias("last_day"))

"""Calendar dimension."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.columns import as_col


@dataclass(frozen=True)
class Period:
    """A named span of days, both ends included."""

    start: dt.date
    end: dt.date
    label: str


CALENDAR_COLUMNS = [
    "date_key",
    "date",
    "year",
    "month",
    "month_name",
    "quarter",
    "year_month",
    "iso_week",
    "day",
    "weekday",
    "weekday_name",
    "is_weekend",
    "in_period",
    "period_label",
]


def calendar(
    spark: SparkSession,
    start: dt.date,
    end: dt.date,
    periods: list[Period] = (),
    outside_label: str = "outside",
) -> DataFrame:
    """One row per day from ``start`` to ``end`` with date attributes and period flags."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))).alias("date")
    )
    return _describe(days, periods, outside_label)


def calendar_between(
    df: DataFrame, date: str | Column, periods: list[Period] = (), outside_label: str = "outside"
) -> DataFrame:
    """The calendar from the first to the last day of a date column."""
    day = F.to_date(as_col(date))
    days = df.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date")
    )
    return _describe(days, periods, outside_label)


def period_of(date: str | Column, periods: list[Period], outside_label: str) -> Column:
    """Label of the first period that contains the date."""
    day = as_col(date)
    hits = [F.when(day.between(p.start, p.end), F.lit(p.label)) for p in periods]
    return F.coalesce(*hits, F.lit(outside_label))


def in_any_period(date: str | Column, periods: list[Period]) -> Column:
    flag = F.lit(False)
    for p in periods:
        flag = flag | as_col(date).between(p.start, p.end)
    return flag


def _describe(days: DataFrame, periods: list[Period], outside_label: str) -> DataFrame:
    date = F.col("date")
    return days.select(
        F.date_format(date, "yyyyMMdd").cast("int").alias("date_key"),
        date,
        F.year(date).alias("year"),
        F.month(date).alias("month"),
        F.date_format(date, "MMMM").alias("month_name"),
        F.quarter(date).alias("quarter"),
        F.date_format(date, "yyyy-MM").alias("year_month"),
        F.weekofyear(date).alias("iso_week"),
        F.dayofmonth(date).alias("day"),
        F.dayofweek(date).alias("weekday"),
        F.date_format(date, "EEEE").alias("weekday_name"),
        F.dayofweek(date).isin(1, 7).alias("is_weekend"),
        in_any_period(date, periods).alias("in_period"),
        period_of(date, periods, outside_label).alias("period_label"),
    )

"""Date parts and period labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martloom.functions.columns import as_col

DATE_PARTS = {
    "year": F.year,
    "quarter": F.quarter,
    "month": F.month,
    "iso_week": F.weekofyear,
    "day": F.dayofmonth,
    "weekday": F.dayofweek,
}


def date_parts(c: str | Column, parts: dict[str, str]) -> list[Column]:
    """``{"year": "order_year", ...}`` -> aliased columns. Weekday 1 is Sunday."""
    return [DATE_PARTS[part](as_col(c)).alias(name) for part, name in parts.items()]


def month_label(year: str | Column, month: str | Column) -> Column:
    """``YYYY-MM`` from a year and a month number; a missing part is left out."""
    known = as_col(year).isNotNull() | as_col(month).isNotNull()
    text = F.concat_ws("-", as_col(year), F.lpad(as_col(month).cast("string"), 2, "0"))
    return F.when(known, text)


def week_label(year: str | Column, week: str | Column) -> Column:
    """``YYYY-WW``."""
    return F.concat(
        as_col(year).cast("string"), F.lit("-"), F.lpad(as_col(week).cast("string"), 2, "0")
    )


def iso_year(c: str | Column) -> Column:
    """The year an ISO week belongs to: the year of that week's Thursday."""
    day = F.to_date(as_col(c))
    return F.year(F.date_add(day, 3 - F.weekday(day)))

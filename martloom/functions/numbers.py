"""Money and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martloom.functions.columns import as_col


def money(c: str | Column) -> Column:
    """Two-digit decimal: sums do not depend on the order of the rows."""
    return as_col(c).cast("decimal(18,2)")


def exact_sum(c: str | Column) -> Column:
    """Sum of amounts held as doubles, unrounded to the eighth digit, as ``decimal(38,8)``.

    Decimal sums do not depend on the order of the rows. NaN, infinity and amounts of 10^20 and
    more are errors, not other numbers.
    """
    value = as_col(c).cast("double")
    odd = F.isnan(value) | (F.abs(value) >= 1e20)
    checked = F.when(odd, F.raise_error(F.lit("amount is not a finite number below 10^20"))).otherwise(value)
    return F.sum(checked.cast("decimal(28,8)")).cast("decimal(38,8)")


def money_sum(c: str | Column) -> Column:
    """Exact sum of amounts, rounded once, half up, to a two-digit decimal."""
    return F.round(exact_sum(c), 2).cast("decimal(38,2)")


def money_mean(c: str | Column) -> Column:
    """Mean of amounts as a double that does not depend on the order of the rows."""
    return F.try_divide(exact_sum(c).cast("double"), F.count(as_col(c)).cast("double"))


def rounded_money_mean(c: str | Column) -> Column:
    """Mean of amounts rounded half up to two digits, exactly.

    A mean of doubles that lies on a half cent goes up or down by the order
    of its rows.
    """
    total, n = exact_sum(c), F.count(as_col(c))
    # in units of 10^-8, so that the division is one of whole numbers
    units = (F.abs(total) * F.lit(10**8).cast("decimal(9,0)")).cast("decimal(38,0)")
    cent = n.cast("decimal(20,0)") * F.lit(10**6).cast("decimal(7,0)")
    halves = F.call_function("div", units * 2 + cent, F.when(n > 0, cent * 2))
    return F.signum(total.cast("double")) * halves / 100


def ratio(part: str | Column, whole: str | Column, digits: int = 4) -> Column:
    return F.round(F.try_divide(as_col(part), as_col(whole)), digits)


def percent(part: str | Column, whole: str | Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(as_col(part), as_col(whole)) * 100, digits)


def exact_percent(part: str | Column, whole: str | Column, digits: int = 2) -> Column:
    """Percentage of two counts, divided and rounded in decimals, half up."""
    share = F.try_divide(
        as_col(part).cast("decimal(20,0)") * F.lit(100).cast("decimal(4,1)"),
        as_col(whole).cast("decimal(20,0)"),
    )
    return F.round(share, digits).cast("double")

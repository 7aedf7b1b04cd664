"""Column expressions shared by the query plans.

Money is DECIMAL inside a plan and becomes DOUBLE only at the output edge.
Averages are an exact sum divided once, so that the value does not depend on
the order in which partitions are combined.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def month_of(col: Column | str) -> Column:
    return F.trunc(_c(col), "month")


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as DOUBLE, NULL when whole is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(F.lit(100.0) * part.cast("double"), whole.cast("double"))


def total(col: Column | str) -> Column:
    """Sum of money or counts, 0 over an empty input."""
    return F.coalesce(F.sum(_c(col)).cast("double"), F.lit(0.0))


def money_sum(col: Column | str) -> Column:
    return F.sum(_c(col)).cast("double")


def mean(col: Column | str) -> Column:
    """Exact sum over non-null count, NULL over an empty input."""
    return ratio(F.sum(_c(col)), F.count(_c(col)))


def weighted_mean(weighted_sum: str, weight: str) -> Column:
    """Mean of a pre-aggregated pair (sum, count)."""
    return ratio(F.sum(weighted_sum), F.sum(weight))


def rows_where(cond: Column) -> Column:
    return F.count_if(cond)


def share(cond: Column) -> Column:
    """Percent of rows that satisfy cond (NULL counts as not)."""
    return percent(F.count_if(cond), F.count(F.lit(1)))


def on_time_pct(delay: Column | str = "delivery_delay_hours") -> Column:
    return share(_c(delay) <= 0)


def round4(col: Column) -> Column:
    """For values whose last bits depend on summation order (deviations)."""
    return F.round(col, 4)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """end - start in seconds, exact to the microsecond, in any session zone."""
    gap = (_c(end) - _c(start)).cast("interval second")
    return gap.cast("decimal(20,6)")


def hours_between(start: Column | str, end: Column | str) -> Column:
    return seconds_between(start, end).cast("double") / 3600


def category_of(col: Column | str = "product_category_name") -> Column:
    return F.coalesce(_c(col), F.lit("Unknown"))


def monday_week_of_year(day: Column | str) -> Column:
    """Week number with Monday as first day; days before the first Monday are week 0."""
    d = _c(day)
    return F.floor((F.dayofyear(d) + 6 - F.weekday(d)) / 7).cast("int")


def month_gap(start: Column, end: Column) -> Column:
    """Calendar months from start to end."""
    return (F.year(end) - F.year(start)) * 12 + (F.month(end) - F.month(start))

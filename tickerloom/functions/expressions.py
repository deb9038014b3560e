"""Column expressions shared by the operators. All are built-in Spark expressions."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def yearly_return() -> Column:
    return F.try_divide(F.col("last_close") - F.col("first_close"), F.col("first_close"))


def volatility() -> Column:
    """Average daily range relative to the first close: a unit-less proxy, not a sigma."""
    return F.try_divide(F.col("avg_daily_range"), F.col("first_close"))


def risk_adj_return() -> Column:
    """Return per unit of volatility; NULL, not an error, where the volatility is zero."""
    return F.try_divide(F.col("yearly_return"), F.col("volatility"))


def debt_to_equity() -> Column:
    return F.try_divide(F.col("long_term_debt"), F.col("total_equity"))


def fixed(value: Column, digits: int) -> Column:
    """Fixed decimals with thousands left ungrouped, rounding the binary value half-even."""
    return F.call_function("format_number", value, F.lit("0." + "0" * digits))


def percent(value: Column, digits: int = 1) -> Column:
    return F.concat(fixed(value * 100, digits), F.lit("%"))


def nulls_last(*names: str) -> list[Column]:
    return [F.col(name).asc_nulls_last() for name in names]


def in_years(date: Column, years: list[int]) -> Column:
    """Dates of the given years as date ranges, which Parquet statistics can skip by."""
    ranges = [date.between(dt.date(y, 1, 1), dt.date(y, 12, 31)) for y in years]
    return reduce(Column.__or__, ranges, F.lit(False))

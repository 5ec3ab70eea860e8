"""Fiscal-calendar and date-text helpers."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, functions as F

from .columns import as_col

# Fiscal year starts in April; spreadsheets count days from this date.
FISCAL_START_MONTH = 4
SERIAL_EPOCH = "1899-12-30"
MONTHS = ["JANUARY", "FEBRUARY", "MARCH", "APRIL", "MAY", "JUNE",
          "JULY", "AUGUST", "SEPTEMBER", "OCTOBER", "NOVEMBER", "DECEMBER"]
FISCAL_MONTHS = MONTHS[3:] + MONTHS[:3]


def parse_date(c: str | Column, fmt: str) -> Column:
    """Date from text; null where the text does not fit."""
    return F.try_to_timestamp(as_col(c), F.lit(fmt)).cast("date")


def serial_date(c: str | Column) -> Column:
    """Date from a spreadsheet day number held as text; null where it is no number."""
    return F.date_add(F.lit(SERIAL_EPOCH).cast("date"), as_col(c).try_cast("int"))


def clock_time(c: str | Column) -> Column:
    """Timestamp on 1970-01-01 from an HHmmss text."""
    return F.try_to_timestamp(as_col(c), F.lit("HHmmss"))


def fiscal_year(d: str | Column, start_month: int = FISCAL_START_MONTH) -> Column:
    """Calendar year in which the fiscal year of ``d`` starts."""
    d = as_col(d)
    return F.year(d) - F.when(F.month(d) < start_month, 1).otherwise(0)


def fiscal_month(d: str | Column, start_month: int = FISCAL_START_MONTH) -> Column:
    """1..12 counted from the first fiscal month."""
    return F.pmod(F.month(as_col(d)) - F.lit(start_month), F.lit(12)) + 1


def fiscal_quarter(d: str | Column, start_month: int = FISCAL_START_MONTH) -> Column:
    return F.ceil(fiscal_month(d, start_month) / 3).cast("int")


def week_of_year(d: str | Column) -> Column:
    """Week number with Sunday as first day; days before the first Sunday are week 0."""
    d = as_col(d)
    return F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7).cast("int")


def month_week(d: str | Column) -> Column:
    """1..4: days 1-7, 8-14, 15-21 and the rest of the month."""
    return F.least(F.ceil(F.dayofmonth(as_col(d)) / 7), F.lit(4)).cast("int")


def days_in_month(d: str | Column) -> Column:
    return F.dayofmonth(F.last_day(as_col(d)))


def sheet_month_number(name: str | Column) -> Column:
    """1..12 from an English month name."""
    return F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.upper(F.trim(as_col(name)))).cast("int")


def sheet_date(fy: str | Column, month: Column, year_is: str = "end") -> Column:
    """First of the month of a fiscal-year sheet.

    ``year_is`` tells what the sheet's year column holds: the calendar year in which
    the fiscal year ``"end"``s or ``"start"``s, or already the ``"calendar"`` year.
    """
    fy = as_col(fy).cast("int")
    late = month >= FISCAL_START_MONTH
    if year_is == "end":
        year = fy - F.when(late, 1).otherwise(0)
    elif year_is == "start":
        year = fy + F.when(late, 0).otherwise(1)
    elif year_is == "calendar":
        year = fy
    else:
        raise ValueError(f"year_is: {year_is}")
    return F.make_date(year, month, F.lit(1))


def month_distance(later: Column, earlier: Column) -> Column:
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def previous_month_end(day: str) -> str:
    """The ``as_of`` under which a period is restated at its closing."""
    return (datetime.date.fromisoformat(day).replace(day=1) - datetime.timedelta(days=1)).isoformat()

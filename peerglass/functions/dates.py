"""Dates of listing, periods and year labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from peerglass import fixed_values as V
from peerglass.functions.text import as_col, strip

CENTURY_PIVOT = 69


def parse_listing_date(value: Column | str) -> Column:
    """Date from 'YYYY-MM-DD', else 'MM-DD-YY' (69-99 are 19xx); anything else gives null."""
    s = strip(F.replace(as_col(value), F.lit("\n"), F.lit("")))
    iso = F.try_to_date(s, "yyyy-M-d")
    short = r"^(\d{1,2})-(\d{1,2})-(\d{2})$"
    month, day, year = (F.regexp_extract(s, short, i) for i in (1, 2, 3))
    century = F.when(year.try_cast("int") >= CENTURY_PIVOT, F.lit("19")).otherwise(F.lit("20"))
    us = F.when(s.rlike(short), F.try_to_date(F.concat(century, year, F.lit("-"), month, F.lit("-"), day), "yyyy-M-d"))
    return F.coalesce(F.when(s.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), iso), us)


def listed_days(listed: Column | str, as_of: str) -> Column:
    return F.datediff(F.lit(as_of).cast("date"), as_col(listed))


def listed_years(listed: Column | str, as_of: str) -> Column:
    """Whole years of 365 days, cut towards zero."""
    return (listed_days(listed, as_of) / 365).cast("int")


def year_label(value: Column | str, as_of_year: int) -> Column:
    """'YYYY' or 'YYYY(E)' for marked or current and later years; other texts stay."""
    c = as_col(value)
    year = F.regexp_extract(c, r"\d{4}", 0)
    estimate = F.contains(F.upper(c), F.lit("E")) | (year.try_cast("int") >= as_of_year)
    return F.when(year == "", c).when(estimate, F.concat(year, F.lit("(E)"))).otherwise(year)


def statement_periods(columns: Column | str, as_of_year: int) -> Column:
    """struct<labels, n_periods> of a statement's header cells: the first names the accounts, the others are periods.

    A statement without period columns is headed as the usual number of years.
    """
    cells = as_col(columns)
    labels = F.transform(cells, lambda cell, i: F.when(i == 0, cell).otherwise(year_label(cell, as_of_year)))
    return F.struct(labels.alias("labels"), F.when(F.size(cells) > 1, F.size(cells) - 1).otherwise(F.lit(V.DEFAULT_PERIODS)).alias("n_periods"))

"""Dates from strings and parts; nothing here fails on a bad value unless it says so."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lenient_date(text: Column) -> Column:
    """yyyy-MM-dd, or null."""
    return F.to_date(F.try_to_timestamp(text, F.lit("yyyy-MM-dd")))


def strict_date(text: Column) -> Column:
    """yyyy-MM-dd; other text fails the job."""
    return F.to_date(text, "yyyy-MM-dd")


def from_parts(year: Column, month: Column, day: Column) -> Column:
    """A date, or null for a day that doesn't exist."""
    zero = F.lit(0)
    return F.to_date(F.try_make_timestamp(year, month, day, zero, zero, zero))


def year_of(text: Column) -> Column:
    """The first four characters as a number, or null."""
    return F.substring(text, 1, 4).try_cast("int")

"""Months as YYYYMM integers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Months are numbered year * 12 + (month - 1); no date lies outside years 0-9999.
_LAST_INDEX = 9999 * 12 + 11


def year_month(day: Column) -> Column:
    return (F.year(day) * 100 + F.month(day)).cast("int")


def tolerant_year_month(text: Column) -> Column:
    """NULL where the text is not an integer, instead of an error."""
    return text.try_cast("int")


def _year(ym: Column) -> Column:
    return F.floor(ym / 100)


def is_month(ym: Column) -> Column:
    return (ym % 100).between(1, 12)


def month_index(ym: Column) -> Column:
    """Consecutive numbers for consecutive calendar months; NULL if not a month."""
    return F.when(is_month(ym), (_year(ym) * 12 + ym % 100 - 1).cast("int"))


def first_index_from(ym: Column) -> Column:
    """Index of the first calendar month whose YYYYMM is at least ``ym``."""
    within = F.least(F.greatest(ym % 100 - 1, F.lit(0)), F.lit(12))
    index = _year(ym) * 12 + within
    return F.least(F.greatest(index, F.lit(0)), F.lit(_LAST_INDEX + 1)).cast("int")


def from_index(index: Column) -> Column:
    return (F.floor(index / 12) * 100 + index % 12 + 1).cast("int")


def month_starts_before(cutoff: int, first: Column, second: Column) -> Column:
    """``coalesce(first, second)`` falls in a month before ``cutoff`` (YYYYMM).

    Spelled without coalesce or year/month arithmetic, so that the comparison
    reaches the file scan and can skip row groups.
    """
    year, month = divmod(cutoff, 100)
    day = F.lit(f"{year:04d}-{month:02d}-01").cast("date")
    return (first < day) | (first.isNull() & (second < day))

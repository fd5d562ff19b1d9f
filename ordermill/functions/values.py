"""Dates, numbers and comparisons.  Bad input gives null (or 0 where stated), never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ordermill.schema import DATE_PATTERN


def parse_date(text: Column) -> Column:
    """``MM-dd-yy`` to a date; null unless the day exists."""
    return F.try_to_date(text, DATE_PATTERN)


def parse_date_clamped(text: Column) -> Column:
    """``MM-dd-yy`` to a date, where day 29 to 31 of a shorter month means its last day.

    ``02-30-22`` is 2022-02-28; ``02-32-22`` and ``4-3-22`` are null.
    """
    well_formed = text.rlike(r"^\d{2}-(0[1-9]|[12]\d|3[01])-\d{2}\z")
    year, month, day = F.substring(text, 7, 2), F.substring(text, 1, 2), F.substring(text, 4, 2)
    month_start = F.concat(F.lit("20"), year, F.lit("-"), month, F.lit("-01")).try_cast("date")
    date = F.date_add(month_start, day.try_cast("int") - 1)
    return F.when(well_formed, F.least(date, F.last_day(month_start)))


def utc_date(moment: Column) -> Column:
    """The UTC day of a timestamp, whatever the zone of the session."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(moment) / 86_400).cast("int"))


def month_of(date: Column) -> Column:
    """First day of the month: a cheaper grouping key than its text, see `month_text`."""
    return F.trunc(date, "month")


def month_text(month: Column) -> Column:
    """``yyyy-MM``, for results."""
    return F.date_format(month, "yyyy-MM")


def number_or_zero(text: Column, kind: str) -> Column:
    """Cast to ``int`` or ``double``; 0 when the text is not such a number."""
    return F.coalesce(text.try_cast(kind), F.lit(0).cast(kind))


def is_positive(number: Column) -> Column:
    """True above zero.  NaN, which Spark sorts above every number, does not count."""
    return (number > 0) & ~F.isnan(number.cast("double"))


def percentage(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part, whole) * 100, 4)



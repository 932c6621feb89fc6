"""Dates and periods found in report files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted date layouts, first match wins (day before month).
DATE_FORMATS = (
    "yyyy-MM-dd HH:mm:ss.SSS",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd",
    "dd/MM/yyyy",
    "d/M/yyyy",
    "dd-MM-yyyy",
    "d-M-yyyy",
    "MM/dd/yyyy",
    "M/d/yyyy",
)
# Layouts with month names, tried after the numeric ones.
NAMED_MONTH_FORMATS = (
    "MMM dd yyyy hh:mm:ss:SSSa",
    "MMM d yyyy hh:mm:ss:SSSa",
    "MMM dd yyyy hh:mm:ss:SSS a",
    "MMM d yyyy hh:mm:ss:SSS a",
    "MMM dd yyyy",
    "MMM d yyyy",
)


def parse_date(column: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First layout that reads the text; NULL when none does."""
    text = F.trim(F.replace(column.cast("string"), F.lit("T"), F.lit(" ")))
    return F.coalesce(*[F.try_to_date(text, layout) for layout in formats])


def _number_in(column: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(column.cast("string"), pattern, 1), F.lit("")).cast("int")


def year_number(column: Column) -> Column:
    return _number_in(column, r"([0-9]{4})")


def month_number(column: Column) -> Column:
    return _number_in(column, r"(?:^|[^0-9])(0?[1-9]|1[0-2])(?:[^0-9]|$)")


def quarter_month(column: Column) -> Column:
    """First month of a quarter label such as ``Q3``."""
    return _number_in(column, r"(?i)q([1-4])") * 3 - 2


def half_month(column: Column) -> Column:
    """First month of a half-year label such as ``H2``."""
    return _number_in(column, r"(?i)h([12])") * 6 - 5


def semester(date: Column) -> Column:
    return F.when(F.month(date) <= 6, "H1").otherwise("H2")


def semester_index(year: Column, half: Column) -> Column:
    """Integer that grows by one per half-year."""
    return year * 2 + F.when(half == "H2", 1).otherwise(0)


def month_start(date: Column) -> Column:
    return F.to_date(F.date_trunc("month", date))


def period_start(year: Column, period: Column) -> Column:
    """First day of ``q1``-``q4``, ``h1``-``h2`` or a two-digit month in ``year``."""
    label = F.lower(period)
    month = F.coalesce(
        quarter_month(label),
        half_month(label),
        F.when(label.rlike(r"^\d{2}$"), label.try_cast("int")),
    )
    return F.when(month.between(1, 12), F.make_date(year, month, F.lit(1)))


def period_type(period: Column) -> Column:
    label = F.lower(period)
    return (
        F.when(label.rlike(r"^q"), "quarterly")
        .when(label.rlike(r"^h"), "semi-annual")
        .when(label.rlike(r"^\d+$"), "monthly")
    )


def submission_number(timestamp: Column) -> Column:
    """Sortable 17-digit submission number of an arrival time."""
    return F.date_format(timestamp, "yyyyMMddHHmmssSSS").cast("long")

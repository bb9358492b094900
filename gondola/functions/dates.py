"""Business dates and the "last update" footer of raw files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Footer mark (with and without accent on the first letter), footer date pattern.
FOOTER_MARK = "ltima actualizaci"
FOOTER_DATE = r"(\d{4}-\d{2}-\d{2})"

# Weekday names, Monday first, without accents.
WEEKDAYS = ("lunes", "martes", "miercoles", "jueves", "viernes", "sabado", "domingo")

BUSINESS_UTC_OFFSET_HOURS = -3


def is_footer(c: Column) -> Column:
    """True for a footer line; a null value is not a footer."""
    return F.coalesce(F.lower(c).contains(FOOTER_MARK), F.lit(False))


def footer_date(line: Column) -> Column:
    """First ISO date in a footer line, null when there is none or it is no calendar day."""
    return F.nullif(F.regexp_extract(line, FOOTER_DATE, 1), F.lit("")).try_cast("date")


def business_date(utc: Column, offset_hours: int = BUSINESS_UTC_OFFSET_HOURS) -> Column:
    """Business day of a naive UTC timestamp."""
    return (utc + F.expr(f"INTERVAL '{offset_hours}' HOUR")).cast("date")


def weekday_name(day: Column) -> Column:
    return F.element_at(F.array(*[F.lit(name) for name in WEEKDAYS]), F.weekday(day) + 1)

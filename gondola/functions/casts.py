"""Lenient text to number casts: whatever does not parse becomes null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for a missing value.
NULL_TOKENS = ("", "NULL", "null")


def blank_to_null(c: Column) -> Column:
    return F.when(~c.isin(*NULL_TOKENS), c)


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(" \t\r\n"))


def _decimal_text(c: Column) -> Column:
    # Spark also parses Java literals such as "1.0d"; a closing type letter is text here.
    return F.when(~F.substring(c, -1, 1).isin("d", "D", "f", "F"), c)


def soft_double(c: Column) -> Column:
    return _decimal_text(c).try_cast("double")


def soft_float(c: Column) -> Column:
    return _decimal_text(c).try_cast("float")


def soft_int(c: Column) -> Column:
    """Through double, so "1.0" gives 1 and "1.7" gives 1; overflow and NaN give null."""
    return soft_double(c).try_cast("int")


def soft_long(c: Column) -> Column:
    return soft_double(c).try_cast("bigint")


def clean_id(c: Column) -> Column:
    """Trimmed id text without the ".0" tail that spreadsheets leave behind."""
    return F.regexp_replace(strip(c), r"\.0+$", "")

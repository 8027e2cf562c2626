"""Numeric features from listing, history and inspection columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotledger.functions.text import strip_commas
from lotledger.schemas import DAYS_PER_YEAR, NONE_TEXT, SATURATION_SCALE


def flag_present(text: Column) -> Column:
    """0 for the "none" text, 1 for everything else, null included."""
    return F.when(text == NONE_TEXT, 0).otherwise(1)


def flag_nonzero(number: Column) -> Column:
    """0 for zero, 1 for everything else, null included."""
    return F.when(number == 0, 0).otherwise(1)


def flag_equals(text: Column, value: str) -> Column:
    """1 for exactly ``value``, 0 for everything else, null included."""
    return F.when(text == value, 1).otherwise(0)


def parse_mileage(text: Column) -> Column:
    """Leading run of digits and separators, as INT; null when there is none."""
    return strip_commas(F.regexp_extract(text, "([0-9][0-9,]*)", 1)).try_cast("int")


def digits_only(text: Column) -> Column:
    """All digits of the text as INT; null when there are none."""
    return F.regexp_replace(text, "[^0-9]", "").try_cast("int")


def parse_cc(text: Column) -> Column:
    """``2999cc`` to 2999."""
    return F.replace(text, F.lit("cc"), F.lit("")).try_cast("int")


def parse_date(text: Column) -> Column:
    """``yyyy/MM/dd`` text to DATE; null when it is not a date."""
    return F.try_to_date(text, "yyyy/MM/dd")


def car_age(text: Column, as_of: dt.date | str) -> Column:
    """Years between a ``yyyy/MM/dd`` registration and ``as_of``."""
    day = F.lit(str(as_of)).cast("date")
    return F.date_diff(day, parse_date(text)) / F.lit(DAYS_PER_YEAR)


def saturate(value: Column, scale: float = SATURATION_SCALE) -> Column:
    """``1 - exp(-value / scale)``."""
    return F.lit(1.0) - F.exp(-value / F.lit(scale))

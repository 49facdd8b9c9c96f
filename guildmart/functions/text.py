"""Splitting names and addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns decide which names and addresses come out.
BLANKS = r"\s+"
DIGITS = r"\d+"
LATIN_WORDS = r"[a-zA-Z]+[a-zA-Z\s]+"


def word(text: Column, n: int) -> Column:
    """n-th blank-separated word, from 1; NULL past the end. A leading blank makes word 1 empty."""
    return F.get(F.split(text, BLANKS), F.lit(n - 1))


def building_digits(address: Column) -> Column:
    """First run of digits, as text; NULL without digits."""
    return F.regexp_substr(address, F.lit(DIGITS))


def building(address: Column, strict: bool = True) -> Column:
    """First run of digits as int; NULL without digits. One that does not fit is an error, or NULL if
    not ``strict``."""
    digits = building_digits(address)
    return digits.cast("int") if strict else digits.try_cast("int")


def street(address: Column) -> Column:
    """First run of two or more Latin letters and blanks, blanks at its end included."""
    return F.regexp_substr(address, F.lit(LATIN_WORDS))

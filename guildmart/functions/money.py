"""Exact money: decimals throughout, rounded half away from zero."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the platform's share of what customers spend.
COMMISSION_RATE = Decimal("0.1")


def money(total: Column) -> Column:
    return total.cast("decimal(15,2)")


def commission(total: Column) -> Column:
    """The platform's share, rounded to a whole unit (a cast alone would cut the fraction)."""
    rate = F.lit(COMMISSION_RATE).cast("decimal(2,1)")
    return F.round(total.cast("decimal(19,0)") * rate).cast("bigint")


def mean_price(total: Column, count: Column) -> Column:
    """total / count to two digits, divided as decimals: ``avg`` of a bigint would be a double."""
    return (total.cast("decimal(29,0)") / count.cast("decimal(19,0)")).cast("decimal(10,2)")

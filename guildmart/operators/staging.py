"""Join the two feeds into the flat staging table and split off rows the warehouse would refuse."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guildmart.functions import building, building_digits, street, word
from guildmart.operators.sizing import is_small
from guildmart.operators.spread import apart, join_dealt
from guildmart.schemas import STAGING, WAREHOUSE, conform

REASON = "reject_reason"
OVERFLOW = "out of range"
CRAFTSMAN_TEXT = ("craftsman_name", "craftsman_address", "craftsman_birthday", "craftsman_email")


def split_person(feed: DataFrame, kind: str, strict: bool = True) -> DataFrame:
    """Replace a raw name and address by the raw name, its parts and the address parts."""
    name, address = F.col(f"{kind}_name"), F.col(f"{kind}_address")
    return feed.withColumns(
        {
            f"{kind}_name_all": name,
            f"{kind}_name": word(name, 1),
            f"{kind}_surname": word(name, 2),
            f"{kind}_address_building": building(address, strict),
            f"{kind}_address_street": street(address),
        }
    )


def build_staging(
    orders_feed: DataFrame, customers_feed: DataFrame, strict: bool = True
) -> DataFrame:
    """One row per order line whose customer is known.

    Customers are parsed before the join, once each and not once per order line; so are craftsmen, where
    they are few, and a line carries a number for them. Many are parsed after it, so that only their raw
    text is shuffled. A building number that does not fit is an error, or left NULL, for
    ``reject_reason`` to name, if not ``strict``.
    """
    customers = split_person(customers_feed, "customer", strict)
    lines, texts = apart(orders_feed, CRAFTSMAN_TEXT, "_craftsman")
    if is_small(customers):
        lines = lines.join(F.broadcast(customers), "customer_id")
    else:
        lines = join_dealt(lines, customers, ["customer_id"])
    if texts is not None:
        parsed = split_person(texts, "craftsman", strict=False)
        # a number that does not fit is an error of a line that is kept; that of others is none
        if not strict or parsed.filter(_overflow("craftsman_address_building")).isEmpty():
            return conform(lines.join(F.broadcast(parsed), "_craftsman"), STAGING)
        lines = lines.join(F.broadcast(texts), "_craftsman")
    return conform(split_person(lines, "craftsman", strict), STAGING)


def _required() -> list[str]:
    """Staging columns that some warehouse table declares NOT NULL, ids aside."""
    required = {
        field.name
        for table in WAREHOUSE
        for field in table.schema.fields
        if not field.nullable and not field.name.endswith("_id")
    }
    return [name for name in STAGING.names if name in required]


def _overflow(name: str) -> Column:
    """Whether a building number is missing as it was too large."""
    return F.col(name).isNull() & building_digits(F.col(name.removesuffix("_building"))).isNotNull()


def _fault(name: str) -> Column:
    """What to say of a missing value: its column's name, and whether a number was too large."""
    if not name.endswith("_address_building"):
        return F.lit(name)
    return F.when(_overflow(name), F.lit(f"{name} {OVERFLOW}")).otherwise(F.lit(name))


def reject_reason() -> Column:
    """Names of the missing required columns, comma separated; NULL for a complete row."""
    return F.when(~_complete(), F.concat_ws(",", *(F.when(F.col(c).isNull(), _fault(c)) for c in _required())))


def _complete() -> Column:
    """Whether no required column is missing."""
    return reduce(and_, (F.col(c).isNotNull() for c in _required()))


def accepted(staging: DataFrame) -> DataFrame:
    return staging.filter(reject_reason().isNull())


def rejected(staging: DataFrame) -> DataFrame:
    return staging.withColumn(REASON, reject_reason()).filter(F.col(REASON).isNotNull())


def require_complete(staging: DataFrame) -> DataFrame:
    """Strict form: the first incomplete row fails the job, as a NOT NULL column would."""
    return staging.filter(
        F.when(_complete(), True).otherwise(
            F.raise_error(F.concat(F.lit("incomplete staging row: "), reject_reason()))
        )
    )

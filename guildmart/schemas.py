"""Table contracts: column names, order, types and nullability, and how to force a frame into them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal(15,2)": T.DecimalType(15, 2),
    "decimal(10,2)": T.DecimalType(10, 2),
    "decimal(10,1)": T.DecimalType(10, 1),
    "decimal(3,1)": T.DecimalType(3, 1),
}


def _schema(*columns: str) -> T.StructType:
    """Read lines such as ``"order_id bigint"``; a trailing ``?`` marks a nullable column."""
    fields = []
    for line in columns:
        name, type_name = line.split(" ", 1)
        nullable = type_name.endswith("?")
        fields.append(T.StructField(name, TYPES[type_name.rstrip("?")], nullable))
    return T.StructType(fields)


def _person(kind: str) -> list[str]:
    return [
        f"{kind}_name string",
        f"{kind}_surname string",
        f"{kind}_address_building int",
        f"{kind}_address_street string",
        f"{kind}_birthday date",
        f"{kind}_email string",
    ]


# Names, order, types and nullability of all columns.

ORDERS_FEED = _schema(
    "id bigint?",
    "craftsman_id bigint?",
    "craftsman_name string?",
    "craftsman_address string?",
    "craftsman_birthday date?",
    "craftsman_email string?",
    "product_id bigint?",
    "product_name string?",
    "product_description string?",
    "product_type string?",
    "product_price bigint?",
    "order_id bigint?",
    "order_created_date date?",
    "order_completion_date date?",
    "order_status string?",
    "customer_id bigint?",
)

CUSTOMERS_FEED = _schema(
    "customer_id bigint?",
    "customer_name string?",
    "customer_address string?",
    "customer_birthday date?",
    "customer_email string?",
)

STAGING = _schema(
    "id bigint?",
    "craftsman_id bigint?",
    "craftsman_name_all string?",
    "craftsman_name string?",
    "craftsman_surname string?",
    "craftsman_address string?",
    "craftsman_address_building int?",
    "craftsman_address_street string?",
    "craftsman_birthday date?",
    "craftsman_email string?",
    "product_id bigint?",
    "product_name string?",
    "product_description string?",
    "product_type string?",
    "product_price bigint?",
    "order_id bigint?",
    "order_created_date date?",
    "order_completion_date date?",
    "order_status string?",
    "customer_id bigint?",
    "customer_name_all string?",
    "customer_name string?",
    "customer_surname string?",
    "customer_address string?",
    "customer_address_building int?",
    "customer_address_street string?",
    "customer_birthday date?",
    "customer_email string?",
)

PRODUCTS = _schema(
    "product_id bigint",
    "product_name string",
    "product_description string",
    "product_type string",
    "product_price bigint",
    "load_dttm timestamp_ntz",
)
CRAFTSMEN = _schema("craftsman_id bigint", *_person("craftsman"), "load_dttm timestamp_ntz")
CUSTOMERS = _schema("customer_id bigint", *_person("customer"), "load_dttm timestamp_ntz")

FACT_STAGING = _schema(
    "product_id bigint",
    "craftsman_id bigint",
    "customer_id bigint",
    "order_created_date date",
    "order_completion_date date?",
    "order_status string",
)
ORDERS = _schema(
    "order_id bigint",
    "product_id bigint",
    "craftsman_id bigint",
    "customer_id bigint",
    "order_created_date date",
    "order_completion_date date?",
    "order_status string",
    "load_dttm timestamp_ntz",
)

REPORT = _schema(
    "customer_id bigint",
    *_person("customer"),
    "customer_money decimal(15,2)",
    "platform_money bigint",
    "count_order bigint",
    "avg_price_order decimal(10,2)",
    "avg_age_customer decimal(3,1)",
    "median_time_order_completed decimal(10,1)?",
    "top_product_category string",
    "top_craftsman bigint",
    "count_order_created bigint",
    "count_order_in_progress bigint",
    "count_order_delivery bigint",
    "count_order_done bigint",
    "count_order_not_done bigint",
    "report_period string",
)
CUSTOMER_REPORT = T.StructType([T.StructField("id", T.LongType(), False), *REPORT.fields])

LOAD_LOG = _schema("id bigint", "load_dttm timestamp_ntz")

# What the report is derived from: sums of a customer's orders in a month per category, per craftsman
# and per number of days to completion, which ``kind`` and ``item`` name.
REPORT_SUMS = _schema(
    "customer_id bigint",
    "report_period string",
    "kind string",
    "item string",
    "total bigint",
    "priced bigint",
    "count_order bigint",
    "count_order_created bigint",
    "count_order_in_progress bigint",
    "count_order_delivery bigint",
    "count_order_done bigint",
    "count_order_not_done bigint",
)
PRODUCT_MONTHS = _schema("product_id bigint", "order_month string")

# The directory column of a part: how many bits of the digest it has, and which they are.
KEY_PART = "key_part"


@dataclass(frozen=True)
class Table:
    """What an upsert needs to know about a table."""

    name: str
    schema: T.StructType
    id_col: str
    keys: tuple[str, ...]
    update_cols: tuple[str, ...]
    parents: tuple[tuple[str, str], ...] = ()
    partition_col: str | None = None
    # Columns whose digest deals rows out to parts, so that a changed row rewrites one part only.
    spread_by: tuple[str, ...] = ()

    @property
    def source_cols(self) -> tuple[str, ...]:
        return self.keys + self.update_cols

    @property
    def stored(self) -> T.StructType:
        """The schema of the files, directory columns included."""
        schema = self.schema
        for name in self.folders:
            schema = with_text(schema, name)
        return schema

    @property
    def folders(self) -> tuple[str, ...]:
        """The directory columns: the month of a table kept by months, and the part of the digest."""
        month = (self.partition_col,) if self.partition_col else ()
        return month + ((KEY_PART,) if self.spread_by else ())


def _person_table(name: str, kind: str, schema: T.StructType) -> Table:
    return Table(
        name,
        schema,
        id_col=f"{kind}_id",
        keys=(f"{kind}_name", f"{kind}_surname", f"{kind}_email"),
        update_cols=(
            f"{kind}_address_building",
            f"{kind}_address_street",
            f"{kind}_birthday",
        ),
        spread_by=(f"{kind}_name", f"{kind}_surname", f"{kind}_email"),
    )


PRODUCTS_TABLE = Table(
    "products",
    PRODUCTS,
    id_col="product_id",
    keys=("product_name", "product_description", "product_price"),
    update_cols=("product_type",),
    spread_by=("product_name", "product_description", "product_price"),
)
CRAFTSMEN_TABLE = _person_table("craftsmen", "craftsman", CRAFTSMEN)
CUSTOMERS_TABLE = _person_table("customers", "customer", CUSTOMERS)
ORDERS_TABLE = Table(
    "orders",
    ORDERS,
    id_col="order_id",
    keys=("product_id", "craftsman_id", "customer_id", "order_created_date"),
    update_cols=("order_status", "order_completion_date"),
    parents=(
        ("products", "product_id"),
        ("craftsmen", "craftsman_id"),
        ("customers", "customer_id"),
    ),
    partition_col="order_month",
    spread_by=("product_id", "craftsman_id", "customer_id", "order_created_date"),
)
REPORT_TABLE = Table(
    "customer_report",
    CUSTOMER_REPORT,
    id_col="id",
    keys=("customer_id", "report_period"),
    update_cols=tuple(c for c in REPORT.names if c not in ("customer_id", "report_period")),
    partition_col="report_period",
    spread_by=("customer_id",),
)
SUMS_TABLE = Table(
    "report_sums",
    REPORT_SUMS,
    id_col="",
    keys=("customer_id", "report_period", "kind", "item"),
    update_cols=tuple(REPORT_SUMS.names[4:]),
    partition_col="report_period",
    spread_by=("customer_id",),
)
PRODUCT_MONTHS_TABLE = Table(
    "product_months",
    PRODUCT_MONTHS,
    id_col="",
    keys=("product_id", "order_month"),
    update_cols=(),
    spread_by=("product_id",),
)
LOG_TABLE = Table("load_log", LOAD_LOG, id_col="id", keys=("id",), update_cols=("load_dttm",))

DIMENSIONS = (PRODUCTS_TABLE, CRAFTSMEN_TABLE, CUSTOMERS_TABLE)
WAREHOUSE = (*DIMENSIONS, ORDERS_TABLE, REPORT_TABLE, LOG_TABLE, SUMS_TABLE, PRODUCT_MONTHS_TABLE)


def assign(name: str, source: T.DataType, target: T.DataType) -> Column:
    """Assignment cast. Fractions going into an integer are rounded, where a bare cast would cut."""
    value = F.col(name)
    if source == target:
        return value
    if isinstance(target, T.IntegralType) and isinstance(source, (T.DecimalType, T.FractionalType)):
        value = F.round(value)
    # by name: casting to a type object asks the session to parse the type each time
    return value.cast(target.simpleString()).alias(name)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the contract's columns by name, in its order and types."""
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name not in have]
    if missing:
        raise ValueError(f"columns missing from the frame: {missing}")
    return df.select(*(assign(f.name, have[f.name], f.dataType) for f in schema.fields))


def with_text(schema: T.StructType, name: str) -> T.StructType:
    """The schema with a string column at its end, unless it has it."""
    if name in schema.names:
        return schema
    return T.StructType([*schema.fields, T.StructField(name, T.StringType())])


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)

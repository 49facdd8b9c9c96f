"""The registered queries: each operator run over the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.tables import (
    AS_OF,
    FIRST_LOAD,
    SECOND_LOAD,
    THIRD_LOAD,
    Star,
    feeds,
    first_batch,
    star,
)
from guildmart.functions import building, days_between, month_of, street, whole_years, word
from guildmart.operators import delta, quality
from guildmart.operators.keys import assign_ids, dense_ids
from guildmart.operators.rekey import rekey, star_join
from guildmart.operators.staging import REASON, build_staging, rejected
from guildmart.operators.upsert import KEEP_FIRST, LATEST, ORDER, inserted, load_stamp, updated, upsert
from guildmart.plans import report as R
from guildmart.plans import sums
from guildmart.plans.loads import Policy, distinct_source, increment, read_report, refresh_report
from guildmart.schemas import (
    CRAFTSMEN,
    CRAFTSMEN_TABLE,
    CUSTOMERS,
    CUSTOMERS_TABLE,
    DIMENSIONS,
    LOG_TABLE,
    ORDERS,
    ORDERS_TABLE,
    PRODUCT_MONTHS_TABLE,
    PRODUCTS,
    PRODUCTS_TABLE,
    REPORT,
    REPORT_TABLE,
    Table,
    empty,
)
from guildmart.sources.warehouse import Warehouse, shared_folder, written

Query = Callable[[SparkSession, str], DataFrame]


def _mark():
    return load_stamp(FIRST_LOAD)


def _staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_staging(*feeds(spark, sf_dir))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = star(spark, sf_dir)
    return R.order_lines(tables.orders, tables.products)


def _loaded_dims(spark: SparkSession, staging: DataFrame) -> list[DataFrame]:
    """The dimensions, written, as each is measured and read."""
    return [
        written(
            upsert(
                empty(spark, table.schema),
                distinct_source(staging, table),
                table,
                FIRST_LOAD,
                KEEP_FIRST,
            )
        )
        for table in DIMENSIONS
    ]


# Scans and staging -----------------------------------------------------------------------------


def scan_orders_feed(spark, sf_dir):
    return feeds(spark, sf_dir)[0]


def scan_customers_feed(spark, sf_dir):
    return feeds(spark, sf_dir)[1]


def staging_rejected(spark, sf_dir):
    """Customers of one market segment come without a first word in their name."""
    orders, customers = feeds(spark, sf_dir)
    one_word = F.regexp_replace("customer_name", "^BUILDING ", "")
    lines = rejected(build_staging(orders, customers.withColumn("customer_name", one_word)))
    return lines.select("id", "order_id", "customer_id", REASON)


def staging_overflow(spark, sf_dir):
    """Every tenth customer has a building number of eleven digits, which a lenient load leaves out."""
    orders, customers = feeds(spark, sf_dir)
    long = F.concat(F.lit("99999999999 "), "customer_address")
    address = F.when(F.col("customer_id") % 10 == 0, long).otherwise(F.col("customer_address"))
    lines = rejected(build_staging(orders, customers.withColumn("customer_address", address), strict=False))
    return lines.select("id", "order_id", "customer_id", REASON)


def _kept_staging(spark: SparkSession, sf_dir: str, *tables: Table) -> DataFrame:
    """Staging with the columns that make up the tables and the orders' own, written."""
    wanted = dict.fromkeys(c for table in tables for c in table.source_cols)
    own = ("order_created_date", "order_completion_date", "order_status")
    return written(_staging(spark, sf_dir).select(*wanted, *own))


def staging_fact(spark, sf_dir):
    staging = _kept_staging(spark, sf_dir, *DIMENSIONS)
    return rekey(staging, *_loaded_dims(spark, staging))


def distinct_of(table: Table) -> Query:
    return lambda spark, sf_dir: distinct_source(_staging(spark, sf_dir), table)


# Scalar functions ------------------------------------------------------------------------------


def split_names(spark, sf_dir):
    name = F.col("customer_name")
    return feeds(spark, sf_dir)[1].select(
        "customer_id",
        word(name, 1).alias("first_word"),
        word(name, 2).alias("second_word"),
        word(name, 3).alias("third_word"),
    )


def parse_address(spark, sf_dir):
    address = F.col("customer_address")
    return feeds(spark, sf_dir)[1].select(
        "customer_id", building(address).alias("building"), street(address).alias("street")
    )


def customer_age(spark, sf_dir):
    age = whole_years(F.col("customer_birthday"), F.lit(AS_OF).cast("date"))
    return feeds(spark, sf_dir)[1].select("customer_id", age.alias("customer_age"))


def completion_days(spark, sf_dir):
    days = days_between(F.col("order_created_date"), F.col("order_completion_date"))
    return star(spark, sf_dir).orders.select("order_id", "product_id", days.alias("days"))


def report_period(spark, sf_dir):
    month = month_of(F.col("order_created_date"))
    return star(spark, sf_dir).orders.select("order_id", "product_id", month.alias("report_period"))


# Upserts ---------------------------------------------------------------------------------------


def surrogate_keys_dense(spark, sf_dir):
    rows = distinct_source(_staging(spark, sf_dir), CUSTOMERS_TABLE)
    return dense_ids(rows, CUSTOMERS_TABLE.keys, "customer_id")


def surrogate_keys(spark, sf_dir):
    rows = distinct_source(_staging(spark, sf_dir), CUSTOMERS_TABLE)
    return assign_ids(rows, CUSTOMERS_TABLE.keys, "customer_id", F.lit(0).cast("bigint"))


def _merge(spark, sf_dir, table: Table, renewed: dict[str, F.Column], policy: str) -> DataFrame:
    """The first batch's rows, then the second batch's with changed attributes merged into them."""
    staging = _kept_staging(spark, sf_dir, table)
    before = upsert(
        empty(spark, table.schema),
        distinct_source(staging.filter(first_batch()), table),
        table,
        FIRST_LOAD,
        policy,
    )
    news = distinct_source(staging.filter(~first_batch()), table).withColumns(renewed)
    return upsert(written(before), written(news), table, SECOND_LOAD, policy)


def merge_products(spark, sf_dir):
    renewed = {"product_type": F.lower("product_type")}
    return _merge(spark, sf_dir, PRODUCTS_TABLE, renewed, KEEP_FIRST)


def merge_craftsmen(spark, sf_dir):
    renewed = {"craftsman_address_street": F.upper("craftsman_address_street")}
    return _merge(spark, sf_dir, CRAFTSMEN_TABLE, renewed, "error")


def merge_customers(spark, sf_dir):
    renewed = {"customer_address_building": F.col("customer_address_building") + 100}
    return _merge(spark, sf_dir, CUSTOMERS_TABLE, renewed, "error")


def merge_orders(spark, sf_dir):
    """All lines merged into those of the first batch, finished orders now under another status."""
    orders = written(star(spark, sf_dir).orders)
    first = orders.filter(first_batch())
    before = upsert(empty(spark, ORDERS), first, ORDERS_TABLE, FIRST_LOAD, KEEP_FIRST)
    status = F.regexp_replace("order_status", "^delivery$", "done")
    news = orders.withColumn("order_status", status)
    return upsert(written(before), news, ORDERS_TABLE, SECOND_LOAD, KEEP_FIRST)


def merge_orders_latest(spark, sf_dir):
    """All lines, the open ones in two states of which the later is done, merged into the first batch."""
    orders = written(star(spark, sf_dir).orders)
    first = orders.filter(first_batch())
    before = upsert(empty(spark, ORDERS), first, ORDERS_TABLE, FIRST_LOAD, KEEP_FIRST)
    earlier = orders.withColumn(ORDER, F.col("order_id") * 2)
    later = orders.filter("order_status <> 'done'").withColumns(
        {"order_status": F.lit("done"), ORDER: F.col("order_id") * 2 + 1}
    )
    return upsert(written(before), earlier.unionByName(later), ORDERS_TABLE, SECOND_LOAD, LATEST)


def merge_null_keys(spark, sf_dir):
    """A person without a name matches nobody: kept in the target and inserted from the source."""
    staging = _kept_staging(spark, sf_dir, CUSTOMERS_TABLE)
    nameless = {"customer_name": F.nullif(F.col("customer_name"), F.lit("BUILDING"))}
    before = upsert(
        empty(spark, CUSTOMERS),
        distinct_source(staging.filter(first_batch()), CUSTOMERS_TABLE).withColumns(nameless),
        CUSTOMERS_TABLE,
        FIRST_LOAD,
    )
    news = distinct_source(staging.filter(~first_batch()), CUSTOMERS_TABLE).withColumns(nameless)
    return upsert(written(before), written(news), CUSTOMERS_TABLE, SECOND_LOAD).drop("customer_id")


# Integrity -------------------------------------------------------------------------------------


def _contracts(tables: Star, spark: SparkSession) -> list[tuple[str, DataFrame, object]]:
    return [
        ("products", tables.products, PRODUCTS),
        ("craftsmen", tables.craftsmen, CRAFTSMEN),
        ("customers", tables.customers, CUSTOMERS),
        ("orders", tables.orders, ORDERS),
        ("report", R.customer_report(tables.orders, tables.products, tables.customers, AS_OF), REPORT),
    ]


def _union(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def table_contracts(spark, sf_dir):
    contracts = _contracts(star(spark, sf_dir), spark)
    return _union([quality.column_report(df, schema, name) for name, df, schema in contracts])


def check_nulls(spark, sf_dir):
    contracts = _contracts(star(spark, sf_dir), spark)
    return _union([quality.forbidden_nulls(df, schema, name) for name, df, schema in contracts])


def check_unique(spark, sf_dir):
    return quality.duplicate_keys(star(spark, sf_dir).orders, ["order_id"])


def check_orphans(spark, sf_dir):
    """Order lines whose product came with the second load only."""
    tables = star(spark, sf_dir)
    known = tables.products.filter(F.col("load_dttm") <= _mark())
    return quality.orphans(tables.orders, known, "product_id")


def check_keys(spark, sf_dir):
    """Primary and natural keys of every table after a load: rows, and key values on several rows.

    Natural keys of the derived tables do repeat, so that the second count is not always zero.
    """
    tables = star(spark, sf_dir)
    report = written(_report(tables, tables.orders))
    counted = []
    for table, frame in (
        *zip(DIMENSIONS, tables.dims(), strict=True),
        (ORDERS_TABLE, tables.orders),
        (REPORT_TABLE, report),
    ):
        for keys in {(table.id_col,), table.keys} if table.id_col in frame.columns else {table.keys}:
            repeated = quality.duplicate_keys(frame, keys).agg(
                F.count(F.lit(1)).alias("repeated_keys"),
                F.coalesce(F.sum("row_count"), F.lit(0)).alias("repeated_rows"),
            )
            name, key = F.lit(table.name).alias("table_name"), F.lit(", ".join(keys)).alias("key")
            counted.append(repeated.select(name, key, "repeated_keys", "repeated_rows"))
    return _union(counted)


def check_parents(spark, sf_dir):
    """Order lines whose product, craftsman or customer came with the second load only."""
    tables = star(spark, sf_dir)
    parents = dict(zip((table.name for table in DIMENSIONS), tables.dims(), strict=True))
    missing = []
    for name, key in ORDERS_TABLE.parents:
        known = parents[name].filter(F.col("load_dttm") <= _mark())
        found = quality.orphans(tables.orders, known, key)
        missing.append(
            found.select(F.lit(name).alias("parent"), F.col(key).alias("key"), "row_count")
        )
    return _union(missing)


def check_load(spark, sf_dir):
    """What a second load breaks if its ids are taken, its rows repeat, values are missing and products
    unknown: every hundredth order has its neighbour's id, every seventieth no state, and a report row
    the id of its customer."""
    tables = star(spark, sf_dir)
    late = F.col("load_dttm") > _mark()
    taken = F.when(F.col("order_id") % 100 == 0, F.col("order_id") - 1).otherwise(F.col("order_id"))
    state = F.when(F.col("order_id") % 70 != 0, F.col("order_status"))
    orders = tables.orders.withColumns({"order_status": state, "order_id": taken})
    known = {t.name: d.filter(~late) for t, d in zip(DIMENSIONS, tables.dims(), strict=True)}
    report = written(_report(tables, tables.orders).withColumn("id", F.col("customer_id")))
    log = tables.orders.groupBy("load_dttm").agg(F.least(F.count(F.lit(1)), F.lit(1)).cast("bigint").alias("id"))
    people = {
        name: tables.customers.withColumn("customer_id", F.floor(F.col("customer_id") / width).cast("bigint"))
        for name, width in (("fresh", 2), ("rest", 4))
    }
    found = [
        quality.load_violations(ORDERS_TABLE, orders.filter(late), orders.filter(~late), known),
        quality.load_violations(PRODUCTS_TABLE, tables.products.filter(late), tables.products, {}),
        quality.load_violations(CRAFTSMEN_TABLE, tables.craftsmen.filter(late), tables.craftsmen, {}),
        quality.load_violations(CUSTOMERS_TABLE, people["fresh"].filter(late), people["rest"].filter(~late), {}),
        quality.load_violations(
            REPORT_TABLE, report.filter("report_period >= '1998'"), report.filter("report_period < '1998'"), {}
        ),
        quality.load_violations(LOG_TABLE, log.filter(late), log.filter(~late), {}),
    ]
    return _union(found)


def stored_types(spark, sf_dir):
    """The types in the files of every table after two loads."""
    warehouse = _with_renewed_products(spark, sf_dir)
    return warehouse.stored_types().select("table_name", "column_name", "stored_type").distinct()


# Deltas ----------------------------------------------------------------------------------------


def _delta(tables: Star) -> DataFrame:
    return delta.changed_orders(tables.orders, *tables.dims(), _mark())


def _touched(tables: Star, report: DataFrame) -> DataFrame:
    return delta.touched_months(tables.orders, *tables.dims(), report, _mark())


def _report(tables: Star, orders: DataFrame) -> DataFrame:
    return R.customer_report(orders, tables.products, tables.customers, AS_OF)


def _report_before(tables: Star) -> DataFrame:
    """The report as the first load left it."""
    return _report(tables, tables.orders.filter(F.col("load_dttm") <= _mark()))


def read_watermark(spark, sf_dir):
    return delta.read_mark(star(spark, sf_dir).orders.select("load_dttm"))


def advance_watermark(spark, sf_dir):
    return delta.next_mark(_delta(star(spark, sf_dir)), SECOND_LOAD)


def delta_changed_orders(spark, sf_dir):
    return _delta(star(spark, sf_dir))


def touched_months(spark, sf_dir):
    tables = star(spark, sf_dir)
    return _touched(tables, _report_before(tables)).select(*delta.PAIR)


def _reported(tables: Star) -> DataFrame:
    """Customers with a finished order from the first load stand for those in the report."""
    loaded = tables.orders.filter(F.col("load_dttm") <= _mark())
    return loaded.filter(F.col("order_status") == "done").select("customer_id")


def new_customers(spark, sf_dir):
    tables = star(spark, sf_dir)
    return delta.new_customers(_delta(tables), _reported(tables))


def existing_customers(spark, sf_dir):
    tables = star(spark, sf_dir)
    return delta.existing_customers(_delta(tables), _reported(tables))


def existing_customers_orders(spark, sf_dir):
    tables = star(spark, sf_dir)
    known = delta.existing_customers(_delta(tables), _reported(tables))
    return delta.orders_of(tables.orders, known).select("order_id", "product_id", "customer_id")


def star_join_query(spark, sf_dir):
    tables = star(spark, sf_dir)
    return star_join(tables.orders, *tables.dims())


# Report ----------------------------------------------------------------------------------------


def over_lines(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(_lines(spark, sf_dir))


def report_full(spark, sf_dir):
    tables = star(spark, sf_dir)
    return _report(tables, tables.orders)


def _recomputed(tables: Star, before: DataFrame) -> DataFrame:
    return R.customer_report_for(
        written(_touched(tables, before)), tables.orders, tables.products, tables.customers, AS_OF
    )


def report_as_written(spark, sf_dir):
    tables = star(spark, sf_dir)
    lines = R.order_lines(tables.orders, tables.products)
    return R.report_as_written(lines, tables.customers, AS_OF)


def report_incremental(spark, sf_dir):
    tables = star(spark, sf_dir)
    return _recomputed(tables, _report_before(tables))


def report_incremental_sums(spark, sf_dir):
    """The report of what changed, from kept sums: early orders that are open had another state before,
    and products of the second load another category."""
    tables = star(spark, sf_dir)
    late = F.col("load_dttm") > _mark()
    open_before = {
        "order_status": F.when(late, F.lit("in progress")).otherwise(F.col("order_status")),
        "order_completion_date": F.when(~late, F.col("order_completion_date")),
    }
    before = tables.orders.filter(first_batch()).withColumns(open_before)
    old_type = F.when(late, F.lower("product_type")).otherwise(F.col("product_type"))
    products_before = tables.products.withColumn("product_type", old_type)
    nothing = tables.orders.limit(0)
    kept = written(sums.changes(before, nothing, products_before, products_before))
    change = written(
        sums.changes(
            tables.orders.filter(late),
            before.filter(late),
            tables.products,
            products_before,
            tables.orders.filter(~late),
            written(sums.retyped(tables.products, products_before)),
        )
    )
    renewed = tables.customers.filter(late).select("customer_id")
    theirs = kept.select(*R.GROUP).distinct().join(renewed, "customer_id", "left_semi")
    touched = written(change.select(*R.GROUP).unionByName(theirs).distinct())
    figures = sums.figures_of(sums.applied(kept, change), touched)
    return R.with_customers(figures, tables.customers, AS_OF)


def _with_renewed_products(spark, sf_dir) -> Warehouse:
    """Two loads of other lines; the second's products come in another category than before."""
    orders, customers = feeds(spark, sf_dir)
    root = f"{shared_folder(spark)}/warehouse-{uuid.uuid4().hex}"
    warehouse = Warehouse(spark, root).create()
    policy = Policy(on_conflict=LATEST, only_if_changed=True, order_by=("id",))
    old = F.concat("product_type", F.lit(" (old)"))
    early = orders.filter("id % 3 <> 0").withColumn("product_type", old)
    increment(warehouse, early, customers, FIRST_LOAD, AS_OF, policy)
    increment(warehouse, orders.filter("id % 3 = 0"), customers, SECOND_LOAD, AS_OF, policy)
    return warehouse


def increment_renewed_products(spark, sf_dir):
    warehouse = _with_renewed_products(spark, sf_dir)
    return warehouse.read(REPORT_TABLE, warehouse.snapshot()).drop("id")


def product_months(spark, sf_dir):
    """The stored months in which each product was sold."""
    warehouse = _with_renewed_products(spark, sf_dir)
    tables = warehouse.tables()
    sold = tables[PRODUCT_MONTHS_TABLE.name].join(tables[PRODUCTS_TABLE.name], "product_id")
    return sold.select(*PRODUCTS_TABLE.keys, "order_month")


def datamart_insert_new(spark, sf_dir):
    """Rows the second load adds to the report."""
    tables = star(spark, sf_dir)
    before = written(_report_before(tables).select(*R.GROUP))
    target = before.withColumn("id", F.lit(0).cast("bigint"))
    rows = inserted(target, _recomputed(tables, before), REPORT_TABLE, SECOND_LOAD)
    return rows.select(*REPORT.names)


def datamart_update_existing(spark, sf_dir):
    """The first load's rows as the second load leaves them."""
    tables = star(spark, sf_dir)
    before = written(_report_before(tables))
    target = before.withColumn("id", F.lit(0).cast("bigint"))
    rows = updated(target, _recomputed(tables, before), REPORT_TABLE, SECOND_LOAD)
    return rows.select(*REPORT.names)


def increment_two_batches(spark, sf_dir):
    """Both batches loaded one after the other into a warehouse in the shared folder."""
    orders, customers = feeds(spark, sf_dir)
    root = f"{shared_folder(spark)}/warehouse-{uuid.uuid4().hex}"
    warehouse = Warehouse(spark, root).create()
    policy = Policy(on_conflict=KEEP_FIRST)
    for batch, load_ts in ((first_batch(), FIRST_LOAD), (~first_batch(), SECOND_LOAD)):
        increment(warehouse, orders.filter(batch), customers, load_ts, AS_OF, policy)
    return warehouse.read(REPORT_TABLE, warehouse.snapshot()).drop("id")


def load_log(spark, sf_dir):
    """The stored log after both batches and a refresh that finds nothing changed, and the marks read
    from it and from an empty log."""
    orders, customers = feeds(spark, sf_dir)
    root = f"{shared_folder(spark)}/warehouse-{uuid.uuid4().hex}"
    warehouse = Warehouse(spark, root).create()
    policy = Policy(on_conflict=KEEP_FIRST)
    empty_log = warehouse.read(LOG_TABLE, warehouse.snapshot())
    for batch, load_ts in ((first_batch(), FIRST_LOAD), (~first_batch(), SECOND_LOAD)):
        increment(warehouse, orders.filter(batch), customers, load_ts, AS_OF, policy)
    refresh_report(warehouse, THIRD_LOAD, AS_OF, policy)
    log = warehouse.read(LOG_TABLE, warehouse.snapshot())
    no_id = F.lit(None).cast("bigint").alias("id")
    return _union(
        [
            log.select(F.lit("load").alias("entry"), "id", "load_dttm"),
            delta.read_mark(log).select(F.lit("mark").alias("entry"), no_id, "load_dttm"),
            delta.read_mark(empty_log).select(F.lit("empty").alias("entry"), no_id, "load_dttm"),
        ]
    )


def increment_overlapping_batches(spark, sf_dir):
    """Two batches that share months, customers and orders, which are open in the first; ages as of
    the second. Only changed rows are stamped."""
    orders, customers = feeds(spark, sf_dir)
    root = f"{shared_folder(spark)}/warehouse-{uuid.uuid4().hex}"
    warehouse = Warehouse(spark, root).create()
    policy = Policy(on_conflict=LATEST, only_if_changed=True, order_by=("id",))
    shared = F.col("id") % 3 == 1
    early = orders.filter("id % 3 <> 0").withColumns(
        {
            "order_status": F.when(shared, "created").otherwise(F.col("order_status")),
            "order_completion_date": F.when(~shared, F.col("order_completion_date")),
        }
    )
    increment(warehouse, early, customers, FIRST_LOAD, "2020-01-01", policy)
    increment(warehouse, orders.filter("id % 3 <> 2"), customers, SECOND_LOAD, AS_OF, policy)
    return read_report(warehouse, AS_OF).drop("id")


QUERIES: dict[str, Query] = {
    "scan_orders_feed": scan_orders_feed,
    "scan_customers_feed": scan_customers_feed,
    "staging_flat": _staging,
    "staging_rejected": staging_rejected,
    "staging_overflow": staging_overflow,
    "staging_fact": staging_fact,
    "distinct_products": distinct_of(PRODUCTS_TABLE),
    "distinct_craftsmen": distinct_of(CRAFTSMEN_TABLE),
    "distinct_customers": distinct_of(CUSTOMERS_TABLE),
    "split_names": split_names,
    "parse_address": parse_address,
    "customer_age": customer_age,
    "completion_days": completion_days,
    "report_period": report_period,
    "surrogate_keys": surrogate_keys,
    "surrogate_keys_dense": surrogate_keys_dense,
    "merge_products": merge_products,
    "merge_craftsmen": merge_craftsmen,
    "merge_customers": merge_customers,
    "merge_orders": merge_orders,
    "merge_orders_latest": merge_orders_latest,
    "merge_null_keys": merge_null_keys,
    "table_contracts": table_contracts,
    "check_nulls": check_nulls,
    "check_unique": check_unique,
    "check_orphans": check_orphans,
    "check_keys": check_keys,
    "check_parents": check_parents,
    "check_load": check_load,
    "stored_types": stored_types,
    "read_watermark": read_watermark,
    "advance_watermark": advance_watermark,
    "delta_changed_orders": delta_changed_orders,
    "touched_months": touched_months,
    "new_customers": new_customers,
    "existing_customers": existing_customers,
    "existing_customers_orders": existing_customers_orders,
    "star_join": star_join_query,
    "status_counts": over_lines(R.status_counts),
    "report_measures": over_lines(R.report_measures),
    "median_completion": over_lines(R.median_completion),
    "category_counts": over_lines(R.category_counts),
    "craftsman_counts": over_lines(R.craftsman_counts),
    "top_category": over_lines(R.top_category),
    "top_craftsman": over_lines(R.top_craftsman),
    "top_category_as_written": over_lines(R.top_categories_as_written),
    "top_craftsman_as_written": over_lines(R.top_craftsmen_as_written),
    "report_as_written": report_as_written,
    "report_full": report_full,
    "report_incremental": report_incremental,
    "report_incremental_sums": report_incremental_sums,
    "datamart_insert_new": datamart_insert_new,
    "datamart_update_existing": datamart_update_existing,
    "increment_two_batches": increment_two_batches,
    "load_log": load_log,
    "increment_overlapping_batches": increment_overlapping_batches,
    "increment_renewed_products": increment_renewed_products,
    "product_months": product_months,
}

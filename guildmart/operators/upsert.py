"""Update-or-insert on natural keys, as frames: target and source in, new state of the target out."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from guildmart.operators.keys import BUCKETS, assign_ids, bucket, highest_id
from guildmart.schemas import Table, assign, conform

ERROR, KEEP_FIRST, LATEST = "error", "keep_first", "latest"
POLICIES = (ERROR, KEEP_FIRST, LATEST)
# The column that says how late a source row is, for the policy ``latest``.
ORDER = "_order"


def order_column(names: Sequence[str]) -> Column:
    """Several columns order as one, the first of them first; a missing value is the earliest."""
    return (F.col(names[0]) if len(names) == 1 else F.struct(*names)).alias(ORDER)


def load_stamp(load_ts: datetime | str) -> Column:
    return F.lit(str(load_ts)).cast("timestamp_ntz")


def one_per_key(
    rows: DataFrame, keys: Sequence[str], values: Sequence[str], on_conflict: str = ERROR
) -> DataFrame:
    """Reduce source rows to one per key; equal rows always collapse.

    Different values under one key either fail the job (``error``) or the smallest, compared in
    the order of ``values``, stays (``keep_first``), or the one whose ``ORDER`` column is the largest
    (``latest``; of equally late ones the largest values). Equal rows are counted first, in a hash
    aggregation that combines before its shuffle, so only the few distinct rows are sorted and a key
    repeated in a third of all rows costs one row per task and variant. A row with a NULL in its key
    matches nothing, so it is told apart by its values too and kept.
    """
    _check_policy(rows, on_conflict)
    value = F.struct(*values)
    if on_conflict == LATEST:
        aggregates = [F.max(F.struct(ORDER, "_value"))["_value"].alias("_first")]
    else:
        aggregates = [F.min("_value").alias("_first")]
    if on_conflict == ERROR:
        aggregates.append(F.max("_value").alias("_last"))
    reduced = (
        _distinct_rows(rows, keys, values, on_conflict)
        .withColumns({"_value": value, "_apart": F.when(_no_match(keys), value)})
        .groupBy(*keys, "_apart")
        .agg(*aggregates)
    )
    if on_conflict == ERROR:
        reduced = reduced.filter(_one_value(keys, F.col("_first"), F.col("_last")))
    return reduced.select(*keys, "_first.*")


def _check_policy(rows: DataFrame, on_conflict: str) -> None:
    if on_conflict not in POLICIES:
        raise ValueError(f"unknown conflict policy: {on_conflict}")
    if on_conflict == LATEST and ORDER not in rows.columns:
        raise ValueError(f"the policy {LATEST} needs columns that order the source rows")


def _no_match(keys: Sequence[str]) -> Column:
    """Whether a key column is missing."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return missing


def _distinct_rows(rows: DataFrame, keys: Sequence[str], values: Sequence[str], on_conflict: str) -> DataFrame:
    """The distinct source rows, with the latest place of each if that decides."""
    counted = [F.count(F.lit(1)).alias("_rows")]
    if on_conflict == LATEST:
        counted.append(F.max(ORDER).alias(ORDER))
    # The filter is always true. Without a use of the count the optimizer would drop the aggregation as
    # redundant and sort all source rows in the next one.
    return rows.groupBy(*keys, *values).agg(*counted).filter("_rows > 0").drop("_rows")


def _one_value(keys: Sequence[str], first: Column, last: Column) -> Column:
    """True, or an error that names the key if its source rows differ."""
    shown = F.to_json(F.struct(*keys))
    return F.when(first.eqNullSafe(last), True).otherwise(
        F.raise_error(F.concat(F.lit("several source rows for one key: "), shown))
    )


def updated(
    target: DataFrame,
    rows: DataFrame,
    table: Table,
    load_ts: datetime | str,
    only_if_changed: bool = False,
) -> DataFrame:
    """Every target row, with the new values and the load stamp where its key is matched.

    ``rows`` hold at most one row per key.
    """
    news = rows.select(
        *(F.col(k).alias(f"_{k}") for k in table.keys),
        F.struct(*table.update_cols).alias("_new"),
    )
    matched = F.col("_new").isNotNull()
    if only_if_changed:
        current = F.struct(*table.update_cols)
        matched = matched & ~F.col("_new").eqNullSafe(current)
    replaced = {c: F.when(matched, F.col(f"_new.{c}")).otherwise(F.col(c)) for c in table.update_cols}
    if "load_dttm" in table.schema.names:
        replaced["load_dttm"] = F.when(matched, load_stamp(load_ts)).otherwise(F.col("load_dttm"))
    joined = target.join(news, [F.col(k) == F.col(f"_{k}") for k in table.keys], "left")
    columns = (replaced.get(c, F.col(c)).alias(c) for c in table.schema.names)
    return conform(joined.select(*columns), table.schema)


def inserted(
    target: DataFrame,
    rows: DataFrame,
    table: Table,
    load_ts: datetime | str,
    start: Column | None = None,
) -> DataFrame:
    """Rows whose key the target lacks, with new ids and the load stamp."""
    fresh = rows.join(target.select(*table.keys), list(table.keys), "left_anti")
    if "load_dttm" in table.schema.names:
        fresh = fresh.withColumn("load_dttm", load_stamp(load_ts))
    first_free = highest_id(target, table.id_col) if start is None else start
    return conform(assign_ids(fresh, table.keys, table.id_col, first_free), table.schema)


def changed(target: DataFrame, rows: DataFrame, table: Table) -> DataFrame:
    """The rows that the target lacks or has with other values; a NULL in a key matches nothing.

    ``rows`` hold at most one row per key.
    """
    known = target.select(*(F.col(k).alias(f"_{k}") for k in table.keys), F.struct(*table.update_cols).alias("_old"))
    joined = rows.join(known, [F.col(k) == F.col(f"_{k}") for k in table.keys], "left")
    differs = F.col("_old").isNull() | ~F.col("_old").eqNullSafe(F.struct(*table.update_cols))
    return joined.filter(differs).select(*rows.columns)


def merge_single(
    target: DataFrame,
    rows: DataFrame,
    table: Table,
    load_ts: datetime | str,
    only_if_changed: bool = False,
    start: Column | None = None,
    small: bool = False,
    places: tuple[Column, int] | None = None,
    anew: bool = False,
) -> DataFrame:
    """New state of ``target`` after loading ``rows``, which hold at most one row per key.

    If ``rows`` are known to be ``small``, the target is not shuffled at all: it is only ever filtered
    by them, and a left and an anti join broadcast either side. Else both sides are shuffled once, see
    ``_merged``. ``start`` overrides the highest id in use, for a target given in part. ``places``, a
    function of the key and the number of its values, are what both sides are put together by, and new
    ids given in, instead of the digest's buckets; the result's partitions then hold whole places. Where a
    table is begun ``anew``, the target has no row, so rows are given their ids only, the same ones.
    """
    if start is None:
        start = highest_id(target, table.id_col)
    if anew:
        return _begun(target, rows, table, load_ts, start, places)
    if not small:
        return _merged(target, rows, table, load_ts, KEEP_FIRST, only_if_changed, start, places)
    news = F.broadcast(rows)
    matched = target.join(news.select(*table.keys), list(table.keys), "left_semi")
    known = F.broadcast(matched.select(*table.keys))
    return updated(target, news, table, load_ts, only_if_changed).unionByName(
        inserted(known, rows, table, load_ts, start)
    )


def _begun(
    target: DataFrame, rows: DataFrame, table: Table, load_ts: datetime | str, start: Column, places: tuple[Column, int] | None
) -> DataFrame:
    """What ``_merged`` makes of rows, at most one per key, that meet an empty target: one shuffle, one window."""
    keys, values = list(table.keys), list(table.update_cols)
    of_key, buckets = places or (bucket(keys), BUCKETS)
    fresh = _in_types_of(rows, target, keys + values).select(*keys, *values)
    fresh = fresh.withColumn("_bucket", of_key).repartition("_bucket")
    place = F.row_number().over(W.partitionBy("_bucket").orderBy(*keys, *values)).cast("bigint")
    fresh = fresh.withColumn(table.id_col, start + 1 + F.col("_bucket") + (place - 1) * buckets)
    if "load_dttm" in table.schema.names:
        fresh = fresh.withColumn("load_dttm", load_stamp(load_ts))
    return conform(fresh, table.schema)


def _merged(
    target: DataFrame,
    rows: DataFrame,
    table: Table,
    load_ts: datetime | str,
    on_conflict: str,
    only_if_changed: bool,
    start: Column,
    places: tuple[Column, int] | None = None,
) -> DataFrame:
    """Target and distinct source rows, put together by the buckets (or places) that ids are given in.

    Both are shuffled once, by their bucket alone. Matching, the choice between conflicting rows and
    the ids of new rows are windows inside it, over one sort, so that neither side is computed or moved
    again for any of them. A row with a NULL in its key neither matches nor conflicts.
    """
    keys, values = list(table.keys), list(table.update_cols)
    stamped = "load_dttm" in table.schema.names
    order = [ORDER] if on_conflict == LATEST else []
    old = target.select(*table.schema.names, F.lit(False).alias("_fresh"))
    fresh = _in_types_of(rows, target, keys + values).select(*keys, *values, *order, F.lit(True).alias("_fresh"))
    of_key, buckets = places or (bucket(keys), BUCKETS)
    both = old.unionByName(fresh, allowMissingColumns=True).withColumn("_bucket", of_key).repartition("_bucket")

    # of one key the target's rows come first, then the source's from the smallest
    first = W.partitionBy("_bucket", *keys).orderBy("_fresh", *values)
    whole = first.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    value, is_fresh = F.struct(*values), F.col("_fresh")
    news = {"_n": F.row_number().over(first)}
    if on_conflict == LATEST:
        news["_new"] = F.max(F.when(is_fresh, F.struct(ORDER, value.alias("value")))).over(whole)["value"]
    else:
        news["_new"] = F.min(F.when(is_fresh, value)).over(whole)
    if on_conflict == ERROR:
        news["_last"] = F.max(F.when(is_fresh, value)).over(whole)
    lonely = _no_match(keys)
    both = both.withColumns(news)
    if on_conflict == ERROR:
        both = both.filter(lonely | _one_value(keys, F.col("_new"), F.col("_last")))
    both = both.filter(~is_fresh | (F.col("_n") == 1) | lonely)

    place = F.count(F.when(is_fresh, 1)).over(W.partitionBy("_bucket").orderBy(*keys, "_fresh", *values).rowsBetween(W.unboundedPreceding, 0))
    new_id = start + 1 + F.col("_bucket") + (place - 1) * buckets
    matched = ~lonely & F.col("_new").isNotNull()
    if only_if_changed:
        matched = matched & (is_fresh | ~F.col("_new").eqNullSafe(value))
    replaced = {c: F.when(matched, F.col(f"_new.{c}")).otherwise(F.col(c)) for c in values}
    replaced[table.id_col] = F.when(is_fresh, new_id).otherwise(F.col(table.id_col))
    if stamped:
        replaced["load_dttm"] = F.when(matched | is_fresh, load_stamp(load_ts)).otherwise(F.col("load_dttm"))
    return conform(both.select(*(replaced.get(c, F.col(c)).alias(c) for c in table.schema.names)), table.schema)


def _in_types_of(rows: DataFrame, target: DataFrame, names: Sequence[str]) -> DataFrame:
    """The rows with the named columns in the target's types."""
    types = {f.name: f.dataType for f in rows.schema.fields}
    return rows.withColumns({n: assign(n, types[n], target.schema[n].dataType) for n in names})


def upsert(
    target: DataFrame,
    source: DataFrame,
    table: Table,
    load_ts: datetime | str,
    on_conflict: str = ERROR,
    only_if_changed: bool = False,
) -> DataFrame:
    """New state of ``target`` after loading ``source``, whose rows may repeat a key.

    Equal source rows are combined per task before any shuffle; which of several different ones stays
    is decided where they meet the target, as ``one_per_key`` would.
    """
    _check_policy(source, on_conflict)
    rows = _distinct_rows(source, table.keys, table.update_cols, on_conflict)
    return _merged(target, rows, table, load_ts, on_conflict, only_if_changed, highest_id(target, table.id_col))

"""Loading feeds into the warehouse and keeping the report current."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import UTC, date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from guildmart.functions import month_of
from guildmart.operators import delta, quality
from guildmart.operators.rekey import rekey
from guildmart.operators.sizing import BROADCAST_BYTES, broadcast_small, total_bytes
from guildmart.operators.staging import REASON, build_staging, reject_reason, require_complete
from guildmart.operators.upsert import (
    ERROR,
    LATEST,
    ORDER,
    changed,
    load_stamp,
    merge_single,
    one_per_key,
    order_column,
)
from guildmart.plans import sums
from guildmart.plans.report import GROUP, aged, with_customers
from guildmart.schemas import (
    CRAFTSMEN_TABLE,
    CUSTOMERS_TABLE,
    DIMENSIONS,
    KEY_PART,
    LOG_TABLE,
    ORDERS_TABLE,
    PRODUCT_MONTHS,
    PRODUCT_MONTHS_TABLE,
    PRODUCTS_TABLE,
    REPORT_TABLE,
    SUMS_TABLE,
    Table,
    conform,
)
from guildmart.sources.warehouse import (
    TASK_ROWS,
    WHOLE,
    Part,
    Snapshot,
    Warehouse,
    digest_part,
    key_part,
    month_and_bits,
    month_column,
    placed,
    write_places,
)


@dataclass(frozen=True)
class Policy:
    """How a load treats conflicting, unchanged and incomplete rows.

    ``order_by`` names the staging columns that say which of several source rows is the latest. A
    ``checked`` load is not committed if what it wrote breaks a key, a parent or a NOT NULL rule.
    """

    on_conflict: str = ERROR
    only_if_changed: bool = False
    strict: bool = True
    order_by: tuple[str, ...] = ("id",)
    checked: bool = False

    def ordered(self, staging: DataFrame) -> DataFrame:
        if self.on_conflict != LATEST:
            return staging
        return staging.withColumn(ORDER, order_column(self.order_by))


def distinct_source(staging: DataFrame, table: Table) -> DataFrame:
    """The dimension rows contained in staging, with the latest place of each if staging is ordered.

    Hash-combined per task before any shuffle.
    """
    if ORDER in staging.columns:
        return staging.groupBy(*table.source_cols).agg(F.max(ORDER).alias(ORDER))
    return staging.select(*table.source_cols).distinct()


class Load:
    """One run: everything it reads is pinned at its start, and one commit at its end shows it.

    ``load_ts`` stamps all rows it changes, now (UTC) by default, and ages are counted at ``as_of``,
    by default the day of the stamp. Loads of one warehouse must follow one another, with growing
    stamps: what carries the last load's stamp counts as reported.
    """

    def __init__(
        self,
        warehouse: Warehouse,
        load_ts: datetime | str | None = None,
        as_of: date | str | None = None,
        policy: Policy = Policy(),
    ) -> None:
        self.warehouse, self.policy = warehouse, policy
        self.load_ts = load_ts or datetime.now(UTC).replace(tzinfo=None)
        self.as_of = as_of or str(self.load_ts)[:10]
        self.before: Snapshot = warehouse.snapshot()
        self.load_id = warehouse.free_number(self.before.last_load)
        self.attempt = uuid.uuid4().hex
        self.mark = self.before.newest([LOG_TABLE]) or datetime.fromisoformat(delta.NEVER)
        self.written: dict[Table, tuple[dict[str, Part], int]] = {}
        self.current: dict[str, DataFrame] = {}
        self.pieces: dict[Table, int] = {}

    def stage(self, orders_feed: DataFrame, customers_feed: DataFrame) -> DataFrame:
        """Write the flat table once, so that the feeds are joined once and cannot move under us."""
        if datetime.fromisoformat(str(self.load_ts)) <= self.mark:
            raise ValueError(f"load_ts {self.load_ts} is not after the last load, {self.mark}")
        staging = build_staging(orders_feed, customers_feed, self.policy.strict)
        # of a strict load the rows that pass have no reason, so it is not worked out a second time
        reason = reject_reason()
        if self.policy.strict:
            staging, reason = require_complete(staging), F.lit(None).cast("string")
        written = self._kept("_staging", staging.withColumn(REASON, reason))
        return self.policy.ordered(written.filter(F.col(REASON).isNull()).drop(REASON))

    def _kept(self, name: str, frame: DataFrame) -> DataFrame:
        """Write an intermediate of this load, so that its several readers compute it once."""
        path = self.warehouse.path(name, self.load_id, self.attempt)
        frame.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.warehouse.spark.read.schema(frame.schema).parquet(path)

    def _deal(self, table: Table, rows: DataFrame, anew: bool = False) -> tuple[set[str], dict[str, int], int]:
        """Where written rows go: the parts they fall into, the digest bits of each month, and their bytes.

        A month that would hold more rows than its parts should is dealt out anew, into all of its parts.
        With ``anew`` the table's own rows do not count, and all of its parts are named. In how many pieces
        tasks may take the largest part is kept, see ``_places``.
        """
        bits = self.before.bits(table)
        month = month_column(rows, table)
        part = key_part(table, month, bits)
        # One row per month and part, as many as the table has.
        found = rows.groupBy(month.alias("_month"), part.alias(KEY_PART)).agg(
            F.count(F.lit(1)).alias("rows"), total_bytes(rows).alias("bytes")
        )
        parts: dict[str, set[str]] = {}
        news: dict[str, int] = {}
        size = 0
        for row in found.collect():
            parts.setdefault(row._month, set()).add(row[KEY_PART])
            news[row._month] = news.get(row._month, 0) + row.rows
            size += row.bytes
        have = {} if anew else self.before.rows(table)
        self.pieces[table] = 1
        for name, n in news.items():
            depth = bits.get(name, 0)
            while have.get(name, 0) + n > self.warehouse.part_rows << depth:
                depth += 1
            if depth > bits.get(name, 0) or anew:
                parts[name] = {f"{depth}-{place}" for place in range(1 << depth)}
            bits[name] = depth
            self.pieces[table] = max(self.pieces[table], -(-((have.get(name, 0) + n) >> depth) // TASK_ROWS))
        named = {f"{m}/{p}" if m else p for m, own in parts.items() for p in own}
        gone = {p for p in self.before.of(table) if anew and month_and_bits(p)[0] not in parts}
        return named | gone, bits, size

    def _places(self, table: Table, frame: DataFrame, parts: set[str], bits: dict[str, int]) -> tuple[Column, int]:
        """What to put rows such as those of the frame together by, that go to the given parts."""
        return write_places(table, month_column(frame, table), bits, parts, self.pieces[table])

    def _older(self, table: Table, parts: set[str]) -> set[str]:
        """The parts, as they were, whose rows the given ones take the place of."""
        dealt = {month_and_bits(p)[0] for p in parts if p not in self.before.of(table)}
        return {p for p in self.before.of(table) if p in parts or month_and_bits(p)[0] in dealt}

    def _merge(self, table: Table, rows: DataFrame, replace: bool = False, kept: bool = False) -> None:
        """Merge rows, at most one per key, into the parts of the table that they fall into.

        ``kept`` rows are written already. With ``replace`` the table's rows that none of them matches go. Rows that the table has already
        are left out if they would not be stamped, and parts without any other are not written.
        """
        rows = rows if kept else self._kept(f"_{table.name}_news", rows)
        parts, bits, size = self._deal(table, rows, replace)
        if not parts:
            return
        target = self.warehouse.read(table, self.before, self._older(table, parts))
        stamped = "load_dttm" in table.schema.names and not self.policy.only_if_changed
        if replace:
            target = target.join(rows.select(*table.keys), list(table.keys), "left_semi")
        elif not stamped and self.before.of(table):
            rows = self._kept(f"_{table.name}_changes", changed(target, rows, table))
            parts, bits, size = self._deal(table, rows)
            if not parts:
                return
            target = self.warehouse.read(table, self.before, self._older(table, parts))
        older = self.before.of(table)
        # Tables kept by months are put together as they are written; their ids are referred to by none.
        small = size <= BROADCAST_BYTES
        together = bool(table.partition_col) and not small
        merged = merge_single(
            target,
            rows,
            table,
            self.load_ts,
            only_if_changed=self.policy.only_if_changed,
            start=F.lit(self.before.max_id(table)).cast("bigint"),
            small=small,
            places=self._places(table, target, parts, bits) if together else None,
            anew=not any(older[p].rows for p in self._older(table, parts)),
        )
        self._write(table, merged, parts, bits, together=together)

    def _single(self, table: Table, source: DataFrame) -> DataFrame:
        return one_per_key(source, table.keys, table.update_cols, self.policy.on_conflict)

    def _write(
        self,
        table: Table,
        frame: DataFrame,
        parts: set[str],
        bits: dict[str, int] | None = None,
        highest: int | None = None,
        together: bool = False,
    ) -> None:
        """Write the rows that the given parts are to have."""
        if table.folders:
            frame = placed(frame, table, self.before.bits(table) if bits is None else bits)
        found = self.warehouse.write(table, self.load_id, self.attempt, frame, parts, together)
        if highest is None:
            highest = max([self.before.max_id(table), *(p.max_id for p in found.values())])
        self.written[table] = (found, highest)
        self.current[table.name] = self.warehouse.read(table, self._state(table))

    def _state(self, table: Table) -> Snapshot:
        """The table's parts as this run has left them so far."""
        parts = dict(self.before.of(table))
        if table in self.written:
            news = self.written[table][0]
            parts = {p: old for p, old in parts.items() if p not in self._older(table, set(news))} | news
        attempts = {**self.before.attempts, self.load_id: self.attempt}
        return Snapshot(self.load_id, {}, {}, attempts, {table.name: parts})

    def table(self, table: Table) -> DataFrame:
        """The table as this run has left it so far."""
        if table.name not in self.current:
            self.current[table.name] = self.warehouse.read(table, self.before)
        return self.current[table.name]

    def dimensions(self, staging: DataFrame) -> None:
        """Merge the three dimensions, which do not depend on each other, side by side."""

        def merge(table: Table) -> None:
            self._merge(table, self._single(table, distinct_source(staging, table)))

        with ThreadPoolExecutor(len(DIMENSIONS)) as pool:
            list(pool.map(merge, DIMENSIONS))

    def orders(self, staging: DataFrame) -> None:
        """Merge into the parts the batch has orders in. All that they depend on is in the match key, so
        no other part can hold a match."""
        lines = rekey(
            staging,
            self.table(PRODUCTS_TABLE),
            self.table(CRAFTSMEN_TABLE),
            self.table(CUSTOMERS_TABLE),
        )
        lines = self._kept("_lines", self._single(ORDERS_TABLE, lines))
        self._merge(ORDERS_TABLE, lines, kept=True)
        self._where_used(lines)

    def _where_used(self, lines: DataFrame) -> None:
        """Note the months in which products were sold, for a product that changes later."""
        month = month_of(F.col("order_created_date")).alias("order_month")
        sold = self._kept("_sold", lines.select("product_id", month).distinct())
        parts, bits, _ = self._deal(PRODUCT_MONTHS_TABLE, sold)
        older = self._older(PRODUCT_MONTHS_TABLE, parts)
        known = self.warehouse.read(PRODUCT_MONTHS_TABLE, self.before, older)
        if older:
            sold = self._kept("_sold_first", sold.join(known, list(PRODUCT_MONTHS.names), "left_anti"))
            parts, bits, _ = self._deal(PRODUCT_MONTHS_TABLE, sold)
            known = self.warehouse.read(PRODUCT_MONTHS_TABLE, self.before, self._older(PRODUCT_MONTHS_TABLE, parts))
        if parts:
            self._write(PRODUCT_MONTHS_TABLE, conform(known.unionByName(sold), PRODUCT_MONTHS), parts, bits)

    def report(self) -> None:
        """Bring the sums, and the report's rows of the (customer, month) pairs that changed, up to date."""
        customers = self.table(CUSTOMERS_TABLE)
        change = self._kept("_change", self._change())
        first = not self.before.of(SUMS_TABLE) and not self.before.of(REPORT_TABLE)
        parts, bits, _ = self._deal(SUMS_TABLE, change)
        if parts:
            if older := self._older(SUMS_TABLE, parts):
                old = self.warehouse.read(SUMS_TABLE, self.before, older)
                place, _ = self._places(SUMS_TABLE, change, parts, bits)
                self._write(SUMS_TABLE, sums.applied(old, change, place), parts, bits, together=True)
            else:
                self._write(SUMS_TABLE, change.filter("count_order <> 0"), parts, bits)
        state = self._state(SUMS_TABLE)
        if first:  # all pairs that there are
            figures = sums.written_figures(self.warehouse.read(SUMS_TABLE, state)) if parts else None
        else:
            touched = self._kept("_touched", change.select(*GROUP).unionByName(self._renewed_months()).distinct())
            mine = self._parts_with(SUMS_TABLE, state, touched)
            known = self.warehouse.read(SUMS_TABLE, state, mine)
            figures = sums.figures_of(known, touched, sums.written_figures) if mine else None
        if figures:
            self._merge(REPORT_TABLE, with_customers(figures, customers, self.as_of))
        self._log()

    def _renewed_months(self) -> DataFrame:
        """The report's (customer, month) pairs of customers stamped since the mark, from their parts."""
        fresh, _ = self._rewritten(CUSTOMERS_TABLE, self._reported())
        newer = F.col("load_dttm") > load_stamp(self.mark)
        customers = self.warehouse.read(CUSTOMERS_TABLE, self._state(CUSTOMERS_TABLE), fresh)
        renewed = customers.filter(newer).select("customer_id")
        found = self.before.of(REPORT_TABLE)
        parts = [digest_part(REPORT_TABLE, F.lit(n)) for n in set(self.before.bits(REPORT_TABLE).values())]
        theirs = set()
        if fresh and parts:
            theirs = {row[0] for row in renewed.select(F.explode(F.array(*parts))).distinct().collect()}
        report = self.warehouse.read(REPORT_TABLE, self.before, {p for p in found if p.rpartition("/")[2] in theirs})
        return report.select(*GROUP).join(broadcast_small(renewed), "customer_id", "left_semi") if theirs else report.select(*GROUP)

    def _parts_with(self, table: Table, state: Snapshot, rows: DataFrame) -> set[str]:
        """The parts that may hold rows with the months and the spread of the given ones."""
        month = month_column(rows, table)
        found = rows.select(month, key_part(table, month, state.bits(table))).distinct().collect()
        return {"/".join(filter(None, row)) for row in found}

    def _reported(self) -> Snapshot:
        """What the sums were last brought up to date with: nothing, if there are none."""
        if not self.before.of(SUMS_TABLE):
            return Snapshot(0, {}, {}, {}, {})
        return self.warehouse.snapshot(self.before.max_id(LOG_TABLE))

    def _change(self) -> DataFrame:
        """What the sums change by since the last report: from the parts of orders that were written
        since, as they are and as they were, and from orders of products that changed their category,
        in the months that sold them."""
        old = self._reported()
        fresh, before = self._rewritten(ORDERS_TABLE, old)
        orders, products = self._state(ORDERS_TABLE), self.table(PRODUCTS_TABLE)
        products_before = self.warehouse.read(PRODUCTS_TABLE, old)
        others = None
        if moved := self._retyped(old):
            rest = set(orders.of(ORDERS_TABLE)) - fresh
            months = self._months_that_sold(moved[0])
            rest = {p for p in rest if month_and_bits(p)[0] in months}
            others = self.warehouse.read(ORDERS_TABLE, orders, rest) if rest else None
        return sums.changes(
            self.warehouse.read(ORDERS_TABLE, orders, fresh),
            self.warehouse.read(ORDERS_TABLE, old, before),
            products,
            products_before,
            others,
            moved[0] if moved else None,
        )

    def _rewritten(self, table: Table, old: Snapshot) -> tuple[set[str], set[str]]:
        """The parts of a table written after a snapshot, and those of the snapshot they took the place of."""
        now, then = self._state(table).of(table), old.of(table)
        fresh = {p for p, part in now.items() if part.load > old.last_load}
        return fresh, {p for p in then if p in fresh or p not in now}

    def _retyped(self, old: Snapshot) -> list[DataFrame]:
        """The products that changed their category since, if there are any; of parts written since."""
        fresh, before = self._rewritten(PRODUCTS_TABLE, old)
        if not fresh or not before:
            return []
        now = self.warehouse.read(PRODUCTS_TABLE, self._state(PRODUCTS_TABLE), fresh)
        moved = sums.retyped(now, self.warehouse.read(PRODUCTS_TABLE, old, before))
        moved = self._kept("_retyped", moved)
        return [] if moved.isEmpty() else [moved]

    def _months_that_sold(self, products: DataFrame) -> set[str]:
        """The months, which the calendar bounds, in which any of the products was ever sold."""
        sold = self.table(PRODUCT_MONTHS_TABLE).join(broadcast_small(products.select("product_id")), "product_id")
        return {row[0] for row in sold.select("order_month").distinct().collect()}

    def full_report(self) -> None:
        """Compute every sum and every month anew, replacing the whole report.

        Rows keep the ids they had; one that no order supports any more goes.
        """
        nothing = Snapshot(0, {}, {}, {}, {})
        orders, products = self.table(ORDERS_TABLE), self.table(PRODUCTS_TABLE)
        none = self.warehouse.read(ORDERS_TABLE, nothing)
        fresh = self._kept("_sums", sums.changes(orders, none, products, products))
        parts, bits, _ = self._deal(SUMS_TABLE, fresh, anew=True)
        if parts:
            self._write(SUMS_TABLE, fresh, parts, bits)
        rows = with_customers(sums.written_figures(fresh), self.table(CUSTOMERS_TABLE), self.as_of)
        self._merge(REPORT_TABLE, rows, replace=True)
        self._log(all_tables=True)

    def _log(self, all_tables: bool = False) -> None:
        """Write the log anew with one row more, in one part, so that reading it opens one file.

        The row is the newest stamp of the four tables, by their records, or this load's if nothing was
        stamped since the last one.
        """
        found = [self._state(t).newest([t]) for t in (ORDERS_TABLE, *DIMENSIONS)]
        newest = max((stamp for stamp in found if stamp), default=None)
        if newest is None or (newest <= self.mark and not all_tables):
            newest = self.load_ts
        row = self.warehouse.spark.createDataFrame([(self.load_id,)], "id bigint").withColumn("load_dttm", load_stamp(newest))
        log = self.warehouse.read(LOG_TABLE, self.before).unionByName(conform(row, LOG_TABLE.schema)).coalesce(1)
        self._write(LOG_TABLE, log, {WHOLE}, highest=self.load_id)

    def violations(self) -> DataFrame:
        """The rules that the parts written by this run break, read back from storage."""
        parents = {t.name: self.table(t) for t in DIMENSIONS}
        found = []
        for table, (parts, _) in self.written.items():
            state = self._state(table)
            fresh = self.warehouse.read(table, state, parts)
            rest = self.warehouse.read(table, state, set(state.of(table)) - set(parts))
            found.append(quality.load_violations(table, fresh, rest, parents))
        result = found[0]
        for one in found[1:]:
            result = result.unionByName(one)
        return result

    def commit(self, marks: dict[str, int] | None = None) -> None:
        if self.policy.checked and self.written and (broken := self.violations().limit(5).collect()):
            raise ValueError(f"load {self.load_id} breaks rules: {[tuple(row) for row in broken]}")
        self.warehouse.commit(self.load_id, self.attempt, self.written, marks, self.before.last_load)


def increment(
    warehouse: Warehouse,
    orders_feed: DataFrame,
    customers_feed: DataFrame,
    load_ts: datetime | str | None = None,
    as_of: date | str | None = None,
    policy: Policy = Policy(),
    marks: dict[str, int] | None = None,
) -> None:
    """Load one batch of feeds and bring the report up to date with it."""
    load = Load(warehouse, load_ts, as_of, policy)
    staging = load.stage(orders_feed, customers_feed)
    load.dimensions(staging)
    load.orders(staging)
    load.report()
    load.commit(marks)


def refresh_report(
    warehouse: Warehouse,
    load_ts: datetime | str | None = None,
    as_of: date | str | None = None,
    policy: Policy = Policy(),
) -> None:
    """Bring the report up to date with tables that were changed by other loads."""
    load = Load(warehouse, load_ts, as_of, policy)
    load.report()
    load.commit()


def rebuild(
    warehouse: Warehouse,
    load_ts: datetime | str | None = None,
    as_of: date | str | None = None,
    policy: Policy = Policy(),
) -> None:
    """Compute the whole report anew from the tables."""
    load = Load(warehouse, load_ts, as_of, policy)
    load.full_report()
    load.commit()


def read_report(warehouse: Warehouse, as_of: date | str) -> DataFrame:
    """The report with all ages counted at ``as_of``, whenever its rows were written.

    A load ages the rows it writes; counting when reading makes increments equal a rebuild of that day
    without rewriting the rows of customers that nothing else touched.
    """
    return aged(warehouse.read(REPORT_TABLE, warehouse.snapshot()), as_of)

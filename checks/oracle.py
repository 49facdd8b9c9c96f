"""The same results in plain SQL over the test tables, for an independent engine to compute."""

from __future__ import annotations

FIRST, SECOND = "timestamp '2024-01-01 00:00:00'", "timestamp '2024-01-02 00:00:00'"
AS_OF, SPLIT = "date '2024-01-01'", "date '2001-01-01'"

# Named sub-queries; each may use those above it. ``_with`` takes the ones a query needs.
VIEWS: dict[str, str] = {
    "customers_feed": """
        select c_custkey as customer_id, concat(c_mktsegment, ' ', c_name) as customer_name,
          concat(cast(c_custkey % 97 + 1 as varchar), ' ', r_name, ' Street ',
                 cast(c_nationkey as varchar)) as customer_address,
          date '1950-01-01' + cast(c_custkey * 37 % 18000 as int) as customer_birthday,
          concat(lower(c_name), '@example.com') as customer_email
        from customer join nation on c_nationkey = n_nationkey
          join region on n_regionkey = r_regionkey""",
    "orders_feed": """
        select l_orderkey * 10 + l_linenumber as id, s_suppkey as craftsman_id,
          concat('Master ', s_name) as craftsman_name,
          concat(cast(s_suppkey % 89 + 1 as varchar), ' ', r_name, ' Lane') as craftsman_address,
          date '1950-01-01' + cast(s_suppkey * 41 % 15000 as int) as craftsman_birthday,
          concat(lower(s_name), '@example.com') as craftsman_email,
          p_partkey as product_id, p_name as product_name, p_brand as product_description,
          p_type as product_type, cast(round(p_retailprice * 10) as bigint) as product_price,
          o_orderkey as order_id, cast(o_orderdate as date) as order_created_date,
          case when o_orderstatus = 'F' then cast(o_orderdate as date)
            + cast(l_orderkey % 11 + l_linenumber as int) end as order_completion_date,
          case when o_orderstatus = 'F' then 'done' when o_orderstatus = 'P' then 'delivery'
            when l_linestatus = 'O' then 'created' else 'in progress' end as order_status,
          o_custkey as customer_id
        from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
          join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
          join region on n_regionkey = r_regionkey""",
    "people": r"""
        select customer_id, customer_name as customer_name_all,
          string_split_regex(customer_name, '\s+')[1] as customer_name,
          string_split_regex(customer_name, '\s+')[2] as customer_surname,
          customer_address,
          cast(nullif(regexp_extract(customer_address, '\d+'), '') as int)
            as customer_address_building,
          nullif(regexp_extract(customer_address, '[a-zA-Z]+[a-zA-Z\s]+'), '')
            as customer_address_street,
          customer_birthday, customer_email
        from customers_feed""",
    "lines_feed": r"""
        select * exclude (craftsman_name), craftsman_name as craftsman_name_all,
          string_split_regex(craftsman_name, '\s+')[1] as craftsman_name,
          string_split_regex(craftsman_name, '\s+')[2] as craftsman_surname,
          cast(nullif(regexp_extract(craftsman_address, '\d+'), '') as int)
            as craftsman_address_building,
          nullif(regexp_extract(craftsman_address, '[a-zA-Z]+[a-zA-Z\s]+'), '')
            as craftsman_address_street
        from orders_feed""",
    "staging": "select * from lines_feed join people using (customer_id)",
    "s_products": f"""
        select distinct p_partkey as product_id, p_name as product_name,
          p_brand as product_description, p_type as product_type,
          cast(round(p_retailprice * 10) as bigint) as product_price,
          case when p_size > 48 then {SECOND} else {FIRST} end as load_dttm
        from part""",
    "s_craftsmen": f"""
        select distinct craftsman_id, craftsman_name, craftsman_surname,
          craftsman_address_building, craftsman_address_street, craftsman_birthday,
          craftsman_email,
          case when craftsman_address_building = 7 then {SECOND} else {FIRST} end as load_dttm
        from lines_feed""",
    "s_customers": f"""
        select customer_id, customer_name, customer_surname, customer_address_building,
          customer_address_street, customer_birthday, customer_email,
          case when customer_address_street like 'ASIA%' then {SECOND} else {FIRST} end
            as load_dttm
        from people""",
    "s_orders": f"""
        select id as order_id, product_id, craftsman_id, customer_id, order_created_date,
          order_completion_date, order_status,
          case when order_created_date >= {SPLIT} or order_status = 'created'
            then {SECOND} else {FIRST} end as load_dttm
        from orders_feed""",
    "lines": """
        select o.*, strftime(order_created_date, '%Y-%m') as report_period,
          cast(order_completion_date - order_created_date as int) as days,
          p.product_type, p.product_price
        from s_orders o join s_products p using (product_id)""",
    "early_lines": f"select * from lines where load_dttm <= {FIRST}",
    "delta": f"""
        select o.order_id, o.product_id, o.craftsman_id, o.customer_id,
          strftime(o.order_created_date, '%Y-%m') as report_period,
          o.load_dttm as orders_load_dttm,
          case when p.load_dttm > {FIRST} then p.load_dttm end as products_load_dttm,
          case when c.load_dttm > {FIRST} then c.load_dttm end as craftsmen_load_dttm,
          case when u.load_dttm > {FIRST} then u.load_dttm end as customers_load_dttm
        from s_orders o join s_products p using (product_id)
          join s_craftsmen c using (craftsman_id) join s_customers u using (customer_id)
        where o.load_dttm > {FIRST} or p.load_dttm > {FIRST} or c.load_dttm > {FIRST}
          or u.load_dttm > {FIRST}""",
    "reported": f"""
        select distinct customer_id from s_orders
        where load_dttm <= {FIRST} and order_status = 'done'""",
}

STATUS_COUNTS = """
    cast(count(*) filter (order_status = 'created') as bigint) as count_order_created,
    cast(count(*) filter (order_status = 'in progress') as bigint) as count_order_in_progress,
    cast(count(*) filter (order_status = 'delivery') as bigint) as count_order_delivery,
    cast(count(*) filter (order_status = 'done') as bigint) as count_order_done,
    cast(count(*) filter (order_status <> 'done') as bigint) as count_order_not_done"""

MEASURES = f"""
    cast(sum(product_price) as decimal(15,2)) as customer_money,
    cast(round(sum(product_price) * cast(0.1 as decimal(2,1))) as bigint) as platform_money,
    cast(count(order_id) as bigint) as count_order,
    cast(cast(sum(product_price) as decimal(38,6)) / count(product_price) as decimal(10,2))
      as avg_price_order, {STATUS_COUNTS}"""

MEDIAN = """cast(percentile_cont(0.5) within group (order by days) as decimal(10,1))
    as median_time_order_completed"""

PERSON = """customer_name, customer_surname, customer_address_building, customer_address_street,
    customer_birthday, customer_email"""


def report(lines: str, customers: str = "s_customers") -> str:
    """Report rows over a relation of order lines with price, category, month and days."""

    def best(column: str, name: str) -> str:
        return f"""(select customer_id, report_period, {column} as {name} from (
            select customer_id, report_period, {column}, row_number() over (
              partition by customer_id, report_period order by count(*) desc, {column}) as n
            from {lines} group by customer_id, report_period, {column}) where n = 1)"""

    return f"""
        select m.customer_id, {PERSON}, customer_money, platform_money, count_order,
          avg_price_order,
          cast(date_part('year', age({AS_OF}, customer_birthday)) as decimal(3,1))
            as avg_age_customer,
          median_time_order_completed, top_product_category, top_craftsman,
          count_order_created, count_order_in_progress, count_order_delivery, count_order_done,
          count_order_not_done, report_period
        from (select customer_id, report_period, {MEASURES}, {MEDIAN}
              from {lines} group by customer_id, report_period) m
          join {best("product_type", "top_product_category")} using (customer_id, report_period)
          join {best("craftsman_id", "top_craftsman")} using (customer_id, report_period)
          join {customers} using (customer_id)"""


VIEWS["report_after"] = report("lines")
VIEWS["report_before"] = report("early_lines")
VIEWS["touched"] = "select distinct customer_id, report_period from delta"

PRODUCT_KEYS = ["product_name", "product_description", "product_price"]
CRAFTSMAN_KEYS = ["craftsman_name", "craftsman_surname", "craftsman_email"]
CUSTOMER_KEYS = ["customer_name", "customer_surname", "customer_email"]
ORDER_KEYS = ["product_id", "craftsman_id", "customer_id", "order_created_date"]

CRAFTSMAN_VALUES = ["craftsman_address_building", "craftsman_address_street", "craftsman_birthday"]
CUSTOMER_VALUES = ["customer_address_building", "customer_address_street", "customer_birthday"]


def _columns(names: list[str], prefix: str = "") -> str:
    return ", ".join(prefix + n for n in names)


def numbered(rows: str, keys: list[str], id_col: str, start: str = "0") -> str:
    """Surrogate keys: digest bucket plus 2^20 times the position within the bucket."""
    bucket = f"cast('0x' || substr(md5(concat_ws(chr(31), {_columns(keys)})), 1, 5) as bigint)"
    return f"""
        select cast({start} + 1 + b + (row_number() over (partition by b order by {_columns(keys)})
            - 1) * 1048576 as bigint) as {id_col}, * exclude (b)
        from (select *, {bucket} as b from {rows})"""


def first_per_key(rows: str, keys: list[str], values: list[str]) -> str:
    order = ", ".join(f"{v} asc nulls first" for v in values)
    return f"""
        select {_columns(keys + values)} from {rows}
        qualify row_number() over (partition by {_columns(keys)} order by {order}) = 1"""


def loaded(name: str, rows: str, id_col: str, keys: list[str], values: list[str]) -> dict[str, str]:
    """A first load into an empty table."""
    return {
        f"{name}_first": first_per_key(rows, keys, values),
        name: f"""select {id_col}, {_columns(keys + values)}, {FIRST} as load_dttm
                  from ({numbered(f"{name}_first", keys, id_col)})""",
    }


def merged(target: str, rows: str, id_col: str, keys: list[str], values: list[str]) -> str:
    """A second load merged into a table."""
    same = " and ".join(f"t.{k} = s.{k}" for k in keys)
    fresh = f"(select * from news s where not exists (select 1 from {target} t where {same}))"
    taken = ", ".join(f"case when s.{keys[0]} is null then t.{v} else s.{v} end as {v}" for v in values)
    return f"""
        with news as ({first_per_key(rows, keys, values)})
        select t.{id_col}, {_columns(keys, "t.")}, {taken},
          case when s.{keys[0]} is null then t.load_dttm else {SECOND} end as load_dttm
        from {target} t left join news s on {same}
        union all
        select {id_col}, {_columns(keys + values)}, {SECOND}
        from ({numbered(fresh, keys, id_col, f"(select max({id_col}) from {target})")})"""


def _merge_query(id_col: str, keys: list[str], values: list[str], renewed: str) -> str:
    """First batch loaded, second batch merged; ``renewed`` is what the second one changes."""
    early = f"(select * from staging where order_created_date < {SPLIT})"
    late = f"""(select distinct {_columns(keys)}, {_columns(values)} from
               (select * replace ({renewed}) from staging where order_created_date >= {SPLIT}))"""
    views = loaded("target", early, id_col, keys, values)
    return _with(merged("target", late, id_col, keys, values), **views)


def _needed(sql: str, views: dict[str, str]) -> list[str]:
    """Views mentioned in the text, and those they mention, in order of definition."""
    names, frontier = set(), [sql]
    while frontier:
        text = frontier.pop()
        words = set(_words(text))
        for name in views:
            if name in words and name not in names:
                names.add(name)
                frontier.append(views[name])
    return [name for name in views if name in names]


def _words(text: str) -> list[str]:
    return "".join(c if c.isalnum() or c == "_" else " " for c in text).split()


def _with(sql: str, **extra: str) -> str:
    views = {**VIEWS, **extra}
    names = _needed(sql, views)
    return "with " + ",\n".join(f"{n} as ({views[n]})" for n in names) + f"\nselect * from ({sql})"


def _contract(name: str, relation: str, columns: str) -> str:
    """``columns``: name and type of each, with a question mark where NULL is allowed."""
    selects = []
    for column in columns.split("; "):
        column_name, data_type = column.split()
        nullable = str(data_type.endswith("?")).lower()
        selects.append(
            f"""select '{name}' as table_name, '{column_name}' as column_name,
            '{data_type.rstrip("?")}' as data_type, {nullable} as nullable,
            cast(count(*) as bigint) as row_count,
            cast(count(*) - count({column_name}) as bigint) as null_count from {relation}"""
        )
    return " union all ".join(selects)


def _person_columns(kind: str) -> str:
    return (
        f"{kind}_name string; {kind}_surname string; {kind}_address_building int; "
        f"{kind}_address_street string; {kind}_birthday date; {kind}_email string"
    )


CONTRACTS = " union all ".join(
    [
        _contract(
            "products",
            "s_products",
            "product_id bigint; product_name string; product_description string; "
            "product_type string; product_price bigint; load_dttm timestamp_ntz",
        ),
        _contract(
            "craftsmen",
            "s_craftsmen",
            f"craftsman_id bigint; {_person_columns('craftsman')}; load_dttm timestamp_ntz",
        ),
        _contract(
            "customers",
            "s_customers",
            f"customer_id bigint; {_person_columns('customer')}; load_dttm timestamp_ntz",
        ),
        _contract(
            "orders",
            "s_orders",
            "order_id bigint; product_id bigint; craftsman_id bigint; customer_id bigint; "
            "order_created_date date; order_completion_date date?; order_status string; "
            "load_dttm timestamp_ntz",
        ),
        _contract(
            "report",
            "report_after",
            f"customer_id bigint; {_person_columns('customer')}; customer_money decimal(15,2); "
            "platform_money bigint; count_order bigint; avg_price_order decimal(10,2); "
            "avg_age_customer decimal(3,1); median_time_order_completed decimal(10,1)?; "
            "top_product_category string; top_craftsman bigint; count_order_created bigint; "
            "count_order_in_progress bigint; count_order_delivery bigint; "
            "count_order_done bigint; count_order_not_done bigint; report_period string",
        ),
    ]
)


def _repeated(name: str, relation: str, key: str) -> str:
    return f"""select '{name}' as table_name, '{key}' as key,
        cast(count(*) as bigint) as repeated_keys,
        cast(coalesce(sum(n), 0) as bigint) as repeated_rows
        from (select count(*) as n from {relation} group by {key} having count(*) > 1)"""


PERSON_KEYS = {k: f"{k}_name, {k}_surname, {k}_email" for k in ("craftsman", "customer")}
REPEATED = " union all ".join(
    [
        _repeated("products", "s_products", "product_id"),
        _repeated("products", "s_products", "product_name, product_description, product_price"),
        _repeated("craftsmen", "s_craftsmen", "craftsman_id"),
        _repeated("craftsmen", "s_craftsmen", PERSON_KEYS["craftsman"]),
        _repeated("customers", "s_customers", "customer_id"),
        _repeated("customers", "s_customers", PERSON_KEYS["customer"]),
        _repeated("orders", "s_orders", "order_id"),
        _repeated("orders", "s_orders", "product_id, craftsman_id, customer_id, order_created_date"),
        _repeated("customer_report", "report_after", "customer_id, report_period"),
    ]
)


def _without_parent(name: str, key: str) -> str:
    return f"""select '{name}' as parent, {key} as key, cast(count(*) as bigint) as row_count
        from s_orders where {key} not in (select {key} from s_{name} where load_dttm <= {FIRST})
        group by {key}"""


PARENTLESS = " union all ".join(
    [
        _without_parent("products", "product_id"),
        _without_parent("craftsmen", "craftsman_id"),
        _without_parent("customers", "customer_id"),
    ]
)


def _broken(name: str, relation: str, fresh: str, id_col: str, keys: str, rest: str = "") -> str:
    """Ids of new rows that are taken, and natural keys on several new rows."""
    text = "concat_ws('|', " + ", ".join(f"{k}::varchar" for k in keys.split(", ")) + ")"
    ids = f"""select '{name}' as table_name, 'unique {id_col}' as rule, {id_col}::varchar as key,
        cast(count(*) as bigint) as row_count
        from (select {id_col} from {relation} where {fresh} union all
              {rest or f"select {id_col} from {relation} where not ({fresh})"})
        where {id_col} in (select {id_col} from {relation} where {fresh})
        group by {id_col} having count(*) > 1"""
    own = f"""select '{name}', 'unique key', {text}, cast(count(*) as bigint) from {relation} where {fresh}
        group by {keys} having count(*) > 1"""
    return ids if keys == id_col else f"{ids} union all {own}"


LATE = f"load_dttm > {FIRST}"
BROKEN_VIEWS = {
    "b_orders": """
        select * replace (case when order_id % 70 <> 0 then order_status end as order_status,
          case when order_id % 100 = 0 then order_id - 1 else order_id end as order_id) from s_orders""",
    "b_report": "select customer_id as id, * from report_after",
    "b_log": "select 1 as id, load_dttm from (select distinct load_dttm from s_orders)",
    "b_fresh": "select * replace (customer_id // 2 as customer_id) from s_customers",
}
BROKEN = " union all ".join(
    [
        _broken("orders", "b_orders", LATE, "order_id", "product_id, craftsman_id, customer_id, order_created_date"),
        f"""select 'orders', 'not null order_status', null, cast(count(*) as bigint) from b_orders
            where {LATE} and order_status is null having count(*) > 0""",
        *(
            f"""select 'orders', 'parent {name}', {key}::varchar, cast(count(*) as bigint) from b_orders
            where {LATE} and {key} not in (select {key} from s_{name} where load_dttm <= {FIRST}) group by {key}"""
            for name, key in (("products", "product_id"), ("craftsmen", "craftsman_id"), ("customers", "customer_id"))
        ),
        _broken(
            "products", "s_products", LATE, "product_id", "product_name, product_description, product_price",
            "select product_id from s_products",
        ),
        _broken(
            "craftsmen", "s_craftsmen", LATE, "craftsman_id", PERSON_KEYS["craftsman"], "select craftsman_id from s_craftsmen"
        ),
        _broken(
            "customers", "b_fresh", LATE, "customer_id", PERSON_KEYS["customer"],
            f"select customer_id // 4 from s_customers where not ({LATE})",
        ),
        _broken("customer_report", "b_report", "report_period >= '1998'", "id", "customer_id, report_period"),
        _broken("load_log", "b_log", LATE, "id", "id"),
    ]
)


def _counted(key: str, group: str) -> str:
    return f"""select {group}, {key}, cast(count(*) as bigint) as count_product
               from lines group by {group}, {key}"""


def _top(key: str, name: str) -> str:
    return f"""
        select customer_id, report_period, {key} as {name}, count_product
        from ({_counted(key, "customer_id, report_period")})
        qualify row_number() over (partition by customer_id, report_period
                                   order by count_product desc, {key}) = 1"""


TIES = f"""
    select customer_id, product_type, count_product from ({_counted("product_type", "customer_id")})
    qualify rank() over (partition by customer_id order by count_product desc) = 1"""
MASTERS = f"""
    select customer_id, craftsman_id, count_product from ({_counted("craftsman_id", "customer_id")})
    qualify row_number() over (partition by customer_id, craftsman_id
                               order by count_product desc) = 1"""

# The literal SQL joins every month of a customer with each tied category and each craftsman.
AS_WRITTEN = f"""
    select m.*, {PERSON}, cast(date_part('year', age({AS_OF}, customer_birthday))
        as decimal(3,1)) as avg_age_customer, tied_categories, first_category, craftsmen, first_craftsman, written_rows
    from (select customer_id, report_period, {MEASURES}, {MEDIAN} from lines
          group by customer_id, report_period) m
      join s_customers using (customer_id)
      join (select customer_id, cast(count(distinct product_type) as bigint) as tied_categories,
              min(product_type) as first_category,
              cast(count(distinct craftsman_id) as bigint) as craftsmen,
              min(craftsman_id) as first_craftsman, cast(count(*) as bigint) as written_rows
            from ({TIES}) t join ({MASTERS}) k using (customer_id) group by customer_id) f
        using (customer_id)"""

DIM_VIEWS = {
    **loaded("d_products", "staging", "product_id", PRODUCT_KEYS, ["product_type"]),
    **loaded("d_craftsmen", "staging", "craftsman_id", CRAFTSMAN_KEYS, CRAFTSMAN_VALUES),
    **loaded("d_customers", "staging", "customer_id", CUSTOMER_KEYS, CUSTOMER_VALUES),
}
REKEYED = f"""
    select d.product_id, c.craftsman_id, u.customer_id, order_created_date,
      order_completion_date, order_status
    from staging s
      join d_products d using ({_columns(PRODUCT_KEYS)})
      join d_craftsmen c using ({_columns(CRAFTSMAN_KEYS)})
      join d_customers u using ({_columns(CUSTOMER_KEYS)})"""


def _two_loads(name: str, id_col: str, keys: list[str], values: list[str]) -> dict[str, str]:
    """Ids of a table loaded in two batches: the second numbers on from the first's highest."""
    early = f"(select * from staging where order_created_date < {SPLIT})"
    late = f"(select * from staging where order_created_date >= {SPLIT})"
    first = loaded(f"{name}_early", early, id_col, keys, values)
    return {**first, name: merged(f"{name}_early", late, id_col, keys, values)}


BATCH_VIEWS = {
    **_two_loads("w_products", "product_id", PRODUCT_KEYS, ["product_type"]),
    **_two_loads("w_craftsmen", "craftsman_id", CRAFTSMAN_KEYS, CRAFTSMAN_VALUES),
    **_two_loads("w_customers", "customer_id", CUSTOMER_KEYS, CUSTOMER_VALUES),
    "w_rekeyed": REKEYED.replace("d_products", "w_products")
    .replace("d_craftsmen", "w_craftsmen")
    .replace("d_customers", "w_customers"),
    "w_orders": first_per_key(
        "w_rekeyed", ORDER_KEYS, ["order_status", "order_completion_date"]
    ),
    "w_lines": """
        select o.*, 1 as order_id, strftime(order_created_date, '%Y-%m') as report_period,
          cast(order_completion_date - order_created_date as int) as days, product_type,
          product_price
        from w_orders o join w_products using (product_id)""",
}

ORDER_VALUES = ["order_status", "order_completion_date"]
ORDER_VIEWS = {
    **loaded(
        "target",
        f"(select * from s_orders where order_created_date < {SPLIT})",
        "order_id",
        ORDER_KEYS,
        ORDER_VALUES,
    ),
    "renewed": """select * replace (case order_status when 'delivery' then 'done'
                                    else order_status end as order_status) from s_orders""",
}



def latest_per_key(rows: str, keys: list[str], values: list[str], order: str) -> str:
    """Of the rows of a key the one with the largest order, of equals the largest values."""
    by = ", ".join(f"{v} desc nulls last" for v in [order, *values])
    return f"""
        select {_columns(keys + values)} from {rows}
        qualify row_number() over (partition by {_columns(keys)} order by {by}) = 1"""


LATEST_VIEWS = {
    "target_first": ORDER_VIEWS["target_first"],
    "target": ORDER_VIEWS["target"],
    "states": """
        select *, order_id * 2 as place from s_orders union all
        select * replace ('done' as order_status), order_id * 2 + 1 from s_orders
        where order_status <> 'done'""",
    "newest": latest_per_key("states", ORDER_KEYS, ORDER_VALUES, "place"),
}


def _overlapping(name: str, id_col: str, keys: list[str], values: list[str]) -> dict[str, str]:
    early = f"({latest_per_key('(select * from staging where id % 3 <> 0)', keys, values, 'id')})"
    late = f"({latest_per_key('(select * from staging where id % 3 <> 2)', keys, values, 'id')})"
    first = loaded(f"{name}_early", early, id_col, keys, values)
    return {**first, name: merged(f"{name}_early", late, id_col, keys, values)}


def _rekeyed(lines: str) -> str:
    return f"""
        select s.id, d.product_id, c.craftsman_id, u.customer_id, order_created_date,
          order_completion_date, order_status
        from {lines} s
          join x_products d using ({_columns(PRODUCT_KEYS)})
          join x_craftsmen c using ({_columns(CRAFTSMAN_KEYS)})
          join x_customers u using ({_columns(CUSTOMER_KEYS)})"""


OVERLAP_VIEWS = {
    **_overlapping("x_products", "product_id", PRODUCT_KEYS, ["product_type"]),
    **_overlapping("x_craftsmen", "craftsman_id", CRAFTSMAN_KEYS, CRAFTSMAN_VALUES),
    **_overlapping("x_customers", "customer_id", CUSTOMER_KEYS, CUSTOMER_VALUES),
    "x_open": """
        select * replace (case when id % 3 = 1 then 'created' else order_status end as order_status,
          case when id % 3 <> 1 then order_completion_date end as order_completion_date)
        from staging where id % 3 <> 0""",
    "x_early": _rekeyed("x_open"),
    "x_late": _rekeyed("(select * from staging where id % 3 <> 2)"),
    "x_first": latest_per_key("x_early", ORDER_KEYS, ORDER_VALUES, "id"),
    "x_second": latest_per_key("x_late", ORDER_KEYS, ORDER_VALUES, "id"),
    "x_orders": f"""
        select * from x_second union all
        select f.* from x_first f anti join x_second s using ({_columns(ORDER_KEYS)})""",
    "x_lines": """
        select o.*, 1 as order_id, strftime(order_created_date, '%Y-%m') as report_period,
          cast(order_completion_date - order_created_date as int) as days, product_type,
          product_price
        from x_orders o join x_products using (product_id)""",
}

# Two loads of other lines, the second with products in another category.
RENEWED_SETS = {
    "y_old": "select * replace (product_type || ' (old)' as product_type) from staging where id % 3 <> 0",
    "y_new": "select * from staging where id % 3 = 0",
}


def _renewed(name: str, id_col: str, keys: list[str], values: list[str]) -> dict[str, str]:
    early, late = (f"({latest_per_key(rows, keys, values, 'id')})" for rows in RENEWED_SETS)
    first = loaded(f"{name}_early", early, id_col, keys, values)
    return {**first, name: merged(f"{name}_early", late, id_col, keys, values)}


RENEWED_VIEWS = {
    **RENEWED_SETS,
    **_renewed("y_products", "product_id", PRODUCT_KEYS, ["product_type"]),
    **_renewed("y_craftsmen", "craftsman_id", CRAFTSMAN_KEYS, CRAFTSMAN_VALUES),
    **_renewed("y_customers", "customer_id", CUSTOMER_KEYS, CUSTOMER_VALUES),
    **{
        f"{rows}_{state}": text
        for rows in RENEWED_SETS
        for state, text in (
            ("keyed", _rekeyed(rows).replace("x_", "y_")),
            ("last", latest_per_key(f"{rows}_keyed", ORDER_KEYS, ORDER_VALUES, "id")),
        )
    },
    "y_orders": f"""
        select * from y_new_last union all
        select f.* from y_old_last f anti join y_new_last s using ({_columns(ORDER_KEYS)})""",
    "y_lines": OVERLAP_VIEWS["x_lines"].replace("x_", "y_"),
}

# Literal types, as the files have them: directory columns are text and not in the files.
STORED = {
    "products": "product_id bigint; product_name string; product_description string; product_type string; "
    "product_price bigint; load_dttm timestamp_ntz",
    "craftsmen": f"craftsman_id bigint; {_person_columns('craftsman')}; load_dttm timestamp_ntz",
    "customers": f"customer_id bigint; {_person_columns('customer')}; load_dttm timestamp_ntz",
    "orders": "order_id bigint; product_id bigint; craftsman_id bigint; customer_id bigint; "
    "order_created_date date; order_completion_date date; order_status string; load_dttm timestamp_ntz",
    "customer_report": f"id bigint; customer_id bigint; {_person_columns('customer')}; customer_money decimal(15,2); "
    "platform_money bigint; count_order bigint; avg_price_order decimal(10,2); "
    "avg_age_customer decimal(3,1); median_time_order_completed decimal(10,1); "
    "top_product_category string; top_craftsman bigint; count_order_created bigint; "
    "count_order_in_progress bigint; count_order_delivery bigint; count_order_done bigint; "
    "count_order_not_done bigint",
    "load_log": "id bigint; load_dttm timestamp_ntz",
    "report_sums": "customer_id bigint; kind string; item string; total bigint; priced bigint; count_order bigint; "
    "count_order_created bigint; count_order_in_progress bigint; count_order_delivery bigint; "
    "count_order_done bigint; count_order_not_done bigint",
    "product_months": "product_id bigint; order_month string",
}
STORED_TYPES = " union all ".join(
    f"select '{table}' as table_name, '{column.split()[0]}' as column_name, '{column.split()[1]}' as stored_type"
    for table, columns in STORED.items()
    for column in columns.split("; ")
)

# Changed since the sums were kept: new orders, orders with another state, products in another category.
SUMS_TOUCHED = f"""
    select distinct o.customer_id, o.report_period from lines o
      join (select product_id, load_dttm as product_stamp from s_products) using (product_id)
      join (select customer_id, load_dttm as customer_stamp from s_customers) using (customer_id)
    where o.load_dttm > {FIRST} or product_stamp > {FIRST}
      or (customer_stamp > {FIRST} and order_created_date < {SPLIT})"""

NAMELESS = "(select distinct * replace (nullif(customer_name, 'BUILDING') as customer_name) from {})"
PEOPLE_OF = "(select distinct {} from staging where order_created_date {} " + SPLIT + ")"


def _null_keys() -> str:
    """Nameless people match nobody, so they are kept on one side and inserted from the other."""
    columns = _columns(CUSTOMER_KEYS + CUSTOMER_VALUES)
    before = NAMELESS.format(PEOPLE_OF.format(columns, "<"))
    news = NAMELESS.format(PEOPLE_OF.format(columns, ">="))
    same = " and ".join(f"t.{k} = s.{k}" for k in CUSTOMER_KEYS)
    return f"""
        select t.*, case when exists (select 1 from {news} s where {same})
          then {SECOND} else {FIRST} end as load_dttm from {before} t
        union all
        select s.*, {SECOND} as load_dttm from {news} s
        where not exists (select 1 from {before} t where {same})"""


STAGED = """id, craftsman_id, craftsman_name_all, craftsman_name, craftsman_surname,
    craftsman_address, craftsman_address_building, craftsman_address_street, craftsman_birthday,
    craftsman_email, product_id, product_name, product_description, product_type, product_price,
    order_id, order_created_date, order_completion_date, order_status, customer_id,
    customer_name_all, customer_name, customer_surname, customer_address,
    customer_address_building, customer_address_street, customer_birthday, customer_email"""

ORACLE: dict[str, str] = {
    "scan_orders_feed": _with("select * from orders_feed"),
    "scan_customers_feed": _with("select * from customers_feed"),
    "staging_flat": _with(f"select {STAGED} from staging"),
    "staging_rejected": _with(
        """select id, order_id, customer_id, 'customer_surname' as reject_reason
           from staging where customer_name = 'BUILDING'"""
    ),
    "staging_overflow": _with(
        """select id, order_id, customer_id,
             'customer_address_building out of range' as reject_reason
           from staging where customer_id % 10 = 0"""
    ),
    "staging_fact": _with(REKEYED, **DIM_VIEWS),
    "distinct_products": _with(f"select distinct {_columns(PRODUCT_KEYS)}, product_type from staging"),
    "distinct_craftsmen": _with(
        f"select distinct {_columns(CRAFTSMAN_KEYS + CRAFTSMAN_VALUES)} from staging"
    ),
    "distinct_customers": _with(
        f"select distinct {_columns(CUSTOMER_KEYS + CUSTOMER_VALUES)} from staging"
    ),
    "split_names": _with(
        r"""select customer_id, string_split_regex(customer_name, '\s+')[1] as first_word,
              string_split_regex(customer_name, '\s+')[2] as second_word,
              string_split_regex(customer_name, '\s+')[3] as third_word from customers_feed"""
    ),
    "parse_address": _with(
        """select customer_id, customer_address_building as building,
             customer_address_street as street from people"""
    ),
    "customer_age": _with(
        f"""select customer_id,
              cast(date_part('year', age({AS_OF}, customer_birthday)) as int) as customer_age
            from customers_feed"""
    ),
    "completion_days": _with("select order_id, product_id, days from lines"),
    "report_period": _with("select order_id, product_id, report_period from lines"),
    "surrogate_keys_dense": _with(
        f"""select cast(row_number() over (order by {_columns(CUSTOMER_KEYS)}) as bigint) as customer_id, *
            from (select distinct {_columns(CUSTOMER_KEYS + CUSTOMER_VALUES)} from staging)"""
    ),
    "surrogate_keys": _with(
        numbered(
            f"(select distinct {_columns(CUSTOMER_KEYS + CUSTOMER_VALUES)} from staging)",
            CUSTOMER_KEYS,
            "customer_id",
        )
    ),
    "merge_products": _merge_query(
        "product_id", PRODUCT_KEYS, ["product_type"],
        "lower(product_type) as product_type",
    ),
    "merge_craftsmen": _merge_query(
        "craftsman_id", CRAFTSMAN_KEYS, CRAFTSMAN_VALUES,
        "upper(craftsman_address_street) as craftsman_address_street",
    ),
    "merge_customers": _merge_query(
        "customer_id", CUSTOMER_KEYS, CUSTOMER_VALUES,
        "customer_address_building + 100 as customer_address_building",
    ),
    "merge_orders": _with(
        merged("target", "renewed", "order_id", ORDER_KEYS, ORDER_VALUES), **ORDER_VIEWS
    ),
    "merge_orders_latest": _with(
        merged("target", "newest", "order_id", ORDER_KEYS, ORDER_VALUES), **LATEST_VIEWS
    ),
    "merge_null_keys": _with(_null_keys()),
    "table_contracts": _with(CONTRACTS),
    "check_nulls": _with(
        f"select table_name, column_name, null_count from ({CONTRACTS}) where not nullable"
    ),
    "check_unique": _with(
        """select order_id, cast(count(*) as bigint) as row_count from s_orders
           group by order_id having count(*) > 1"""
    ),
    "check_orphans": _with(
        f"""select product_id, cast(count(*) as bigint) as row_count from s_orders
            where product_id not in (select product_id from s_products where load_dttm <= {FIRST})
            group by product_id"""
    ),
    "check_keys": _with(REPEATED),
    "check_parents": _with(PARENTLESS),
    "check_load": _with(BROKEN, **BROKEN_VIEWS),
    "stored_types": STORED_TYPES,
    "read_watermark": _with(
        "select coalesce(max(load_dttm), timestamp '1900-01-01') as load_dttm from s_orders"
    ),
    "advance_watermark": _with(
        f"""select coalesce(greatest(max(orders_load_dttm), max(products_load_dttm),
              max(craftsmen_load_dttm), max(customers_load_dttm)), {SECOND}) as load_dttm
            from delta"""
    ),
    "delta_changed_orders": _with("select * from delta"),
    "touched_months": _with("select * from touched"),
    "new_customers": _with(
        """select distinct d.customer_id from delta d
           left join reported r using (customer_id) where r.customer_id is null"""
    ),
    "existing_customers": _with(
        "select distinct customer_id from delta where customer_id in (select * from reported)"
    ),
    "existing_customers_orders": _with(
        """select order_id, product_id, customer_id from s_orders
           where customer_id in (select customer_id from delta)
             and customer_id in (select customer_id from reported)"""
    ),
    "star_join": _with(
        """select o.* exclude (load_dttm), p.* exclude (load_dttm, product_id),
             c.* exclude (load_dttm, craftsman_id), u.* exclude (load_dttm, customer_id)
           from s_orders o join s_products p using (product_id)
             join s_craftsmen c using (craftsman_id) join s_customers u using (customer_id)"""
    ),
    "status_counts": _with(
        f"""select customer_id, report_period, {STATUS_COUNTS} from lines
            group by customer_id, report_period"""
    ),
    "report_measures": _with(
        f"""select customer_id, report_period, {MEASURES} from lines
            group by customer_id, report_period"""
    ),
    "median_completion": _with(
        f"""select customer_id, report_period, {MEDIAN} from lines
            group by customer_id, report_period"""
    ),
    "category_counts": _with(_counted("product_type", "customer_id")),
    "craftsman_counts": _with(_counted("craftsman_id", "customer_id")),
    "top_category": _with(_top("product_type", "top_product_category")),
    "top_craftsman": _with(_top("craftsman_id", "top_craftsman")),
    "top_category_as_written": _with(TIES),
    "top_craftsman_as_written": _with(MASTERS),
    "report_as_written": _with(AS_WRITTEN),
    "report_full": _with("select * from report_after"),
    "report_incremental": _with(
        "select r.* from report_after r join touched using (customer_id, report_period)"
    ),
    "report_incremental_sums": _with(
        "select r.* from report_after r join sums_touched using (customer_id, report_period)",
        sums_touched=SUMS_TOUCHED,
    ),
    "increment_renewed_products": _with(report("y_lines", "y_customers"), **RENEWED_VIEWS),
    "product_months": _with(
        f"""select distinct {_columns(PRODUCT_KEYS)}, strftime(order_created_date, '%Y-%m') as order_month
            from y_orders join y_products using (product_id)""",
        **RENEWED_VIEWS,
    ),
    "datamart_insert_new": _with(
        """select r.* from report_after r
           anti join report_before b using (customer_id, report_period)"""
    ),
    "datamart_update_existing": _with(
        """select r.* from report_after r join touched using (customer_id, report_period)
             semi join report_before b using (customer_id, report_period)
           union all
           select b.* from report_before b anti join touched using (customer_id, report_period)"""
    ),
    "load_log": f"""
        select 'empty' as entry, cast(null as bigint) as id, timestamp '1900-01-01' as load_dttm
        union all select 'load', 1, {FIRST} union all select 'load', 2, {SECOND}
        union all select 'load', 3, timestamp '2024-01-03 00:00:00'
        union all select 'mark', cast(null as bigint), timestamp '2024-01-03 00:00:00'""",
    "increment_two_batches": _with(report("w_lines", "w_customers"), **BATCH_VIEWS),
    "increment_overlapping_batches": _with(report("x_lines", "x_customers"), **OVERLAP_VIEWS),
}

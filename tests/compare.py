"""Run registered queries in Spark and their SQL in DuckDB and compare the results as multisets."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = "region nation customer supplier part orders lineitem".split()


def sql_engine(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(row) for row in df.select(*names).collect())


def sql_rows(con, sql: str) -> tuple[list[str], Counter]:
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    order = sorted(range(len(columns)), key=columns.__getitem__)
    rows = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    return [columns[i] for i in order], rows


def difference(spark, con, name: str, query, sql: str, sf_dir: str) -> str | None:
    names, ours = spark_rows(query(spark, sf_dir))
    sql_names, theirs = sql_rows(con, sql)
    if names != sql_names:
        return f"{name}: columns {names} != {sql_names}"
    if ours != theirs:
        extra, missing = ours - theirs, theirs - ours
        return (
            f"{name}: {sum(extra.values())} rows only in Spark, {sum(missing.values())} only in SQL"
            f"\n  {names}\n  Spark {list(extra)[:2]}\n  SQL   {list(missing)[:2]}"
        )
    return None


def main(sf_dir: str, only: list[str]) -> None:
    from __spark_entry__ import oracle_sql, queries
    from tests.conftest import local_session

    spark, con = local_session(), sql_engine(sf_dir)
    for name, query in queries().items():
        if only and name not in only:
            continue
        begin = time.time()
        try:
            wrong = difference(spark, con, name, query, oracle_sql()[name], sf_dir)
        except Exception as error:  # noqa: BLE001 - the run goes on to the next query
            wrong = f"{name}: {type(error).__name__} {str(error)[:600]}"
        print(f"{time.time() - begin:6.1f}s", wrong or f"{name}: equal", flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])

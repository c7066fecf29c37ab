"""Run registered queries beside their SQL in DuckDB and compare.

    python tests/oracle.py [folder] [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def plain(value):
    """Value in a form in which both engines' results are equal or not, without tolerance."""
    if isinstance(value, decimal.Decimal):
        return ("n", float(value))
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, (int, float)):
        return ("nan",) if isinstance(value, float) and math.isnan(value) else ("n", float(value))
    if isinstance(value, datetime.datetime):
        return ("t", value.isoformat())
    if isinstance(value, datetime.date):
        return ("d", value.isoformat())
    if isinstance(value, (list, tuple)):
        return ("l", tuple(plain(v) for v in value))
    return ("s", value) if value is not None else ("0",)


def compare(spark_df, sql: str, connection) -> list[str]:
    """Differences found, none when the results are the same."""
    cursor = connection.execute(sql)
    sql_columns = [d[0] for d in cursor.description]
    sql_rows = cursor.fetchall()
    columns = sorted(spark_df.columns)
    if columns != sorted(sql_columns):
        return [f"columns {columns} <> {sorted(sql_columns)}"]
    ours = sorted(tuple(plain(row[c]) for c in columns) for row in spark_df.collect())
    places = [sql_columns.index(c) for c in columns]
    theirs = sorted(tuple(plain(row[p]) for p in places) for row in sql_rows)
    found = []
    if len(ours) != len(theirs):
        found.append(f"rows {len(ours)} <> {len(theirs)}")
    different = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if different:
        found.append(f"{len(different)} rows differ, first {str(different[0])[:700]}")
    return found


def main(arguments: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as contract
    from cotejo.session import get_session

    folder = arguments[0] if arguments else "/root/testdata/sf0.01"
    wanted = arguments[1:] or list(contract.queries())
    spark = get_session("oracle", "local[8]", 8, {"spark.ui.enabled": "false", **({"spark.sql.autoBroadcastJoinThreshold": "-1"} if os.environ.get("NO_BROADCAST") else {})})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    failed = 0
    for name in wanted:
        started = time.time()
        try:
            df = contract.queries()[name](spark, folder)
            sql = contract.oracle_sql().get(name)
            if sql is None:
                print(f"{name:28} rows only {df.count()}  {time.time() - started:.2f}s")
                continue
            found = compare(df, sql, connection)
        except Exception as error:  # noqa: BLE001
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(found)
        print(f"{name:28} {'ok' if not found else 'FAIL ' + '; '.join(found)}  {time.time() - started:.2f}s")
    print("failed", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

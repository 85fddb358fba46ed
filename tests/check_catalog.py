"""Compares every catalogue query with its SQL: python tests/check_catalog.py DIR [name ...]."""

from __future__ import annotations

import datetime
import decimal
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "nation", "customer", "orders", "events", "documents", "embeddings", "pages", "labels",
)


def open_duckdb(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return format(value.normalize(), "f") if value else "0"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, float):
        return round(value, 12)
    return value


def rows_as_bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    """Empty when columns, types of NULL-free values and row bags agree."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = rows_as_bag(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} <> {sorted(names)}"]
    got = rows_as_bag(df.columns, df.collect())
    if got == want:
        return []
    return [
        f"rows {sum(got.values())} <> {sum(want.values())}",
        f"only spark: {list((got - want).items())[:3]}",
        f"only sql: {list((want - got).items())[:3]}",
    ]


def main(folder: str, names: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries

    from kinbridge.session import local_session

    spark = local_session(cores=8)
    spark.sparkContext.setLogLevel("ERROR")
    con, checks, bad = open_duckdb(folder), oracle_sql(), 0
    for name, fn in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            if name in checks:
                found = differences(df, con, checks[name])
                note = "" if con.execute(checks[name]).fetchone() else " (empty)"
            else:
                found, note = [], f" no sql, {df.count()} rows"
        except Exception as error:  # report and go on with the next query
            found, note = [str(error)[:600]], ""
        bad += bool(found)
        print(f"{'DIFF' if found else 'ok  '} {name} {time.time() - start:.1f}s{note}", flush=True)
        for line in found:
            print("     ", line, flush=True)
    print("queries without a match:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))

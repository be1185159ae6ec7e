"""Runs queries in Spark and their SQL in DuckDB and compares rows as multisets."""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import glob
import math
import os
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame, SparkSession

from verification import oracle, registry


def _plain(value: object) -> object:
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float, decimal.Decimal)):
        number = float(value)
        return "nan" if math.isnan(number) else number + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _multiset(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def oracle_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    return [d[0] for d in cursor.description], cursor.fetchall()


def difference(df: DataFrame, columns: list[str], rows: list[tuple]) -> str | None:
    """None when both sides hold the same columns and rows, else what differs."""
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(set(df.columns) ^ set(columns))}"
    ours = _multiset(df.columns, [tuple(r) for r in df.collect()])
    theirs = _multiset(columns, rows)
    if ours == theirs:
        return None
    extra, missing = list((ours - theirs).items())[:2], list((theirs - ours).items())[:2]
    return f"{sum(ours.values())} rows against {sum(theirs.values())}; only ours {extra}; only SQL {missing}"


def main() -> None:
    from wattloom.session import local_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark: SparkSession = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = duck(args.sf), oracle.oracle_sql(), 0
    for name, query in registry.queries().items():
        if args.names and name not in args.names:
            continue
        start = time.time()
        try:
            df = query(spark, args.sf)
            found = difference(df, *oracle_rows(con, sql[name])) if name in sql else f"no SQL, {df.count()} rows"
        except Exception as error:  # report and go on with the other queries
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += found is not None and not found.startswith("no SQL")
        print(f"{'ok  ' if found is None else 'DIFF' if name in sql else 'rows'} {name} {time.time() - start:.1f}s {found or ''}", flush=True)
    print("unregistered oracles:", sorted(set(sql) - set(registry.queries())), "bad:", bad)


if __name__ == "__main__":
    main()

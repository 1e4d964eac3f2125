"""Run registered queries in Spark and DuckDB and compare the rows."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def _value(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        return f"{float(value):.9g}"
    return str(value)


def normal(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(row[i]) for i in order) for row in rows)


def compare(spark, connection, sf_dir: str, function, sql: str) -> tuple[int, float, float]:
    """(rows, Spark seconds, DuckDB seconds); raises when the results differ."""
    start = time.time()
    df = function(spark, sf_dir)
    got = normal(df.columns, df.collect())
    middle = time.time()
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = normal(names, cursor.fetchall())
    end = time.time()
    assert sorted(df.columns) == sorted(names), (sorted(df.columns), sorted(names))
    assert len(got) == len(expected), f"{len(got)} rows, expected {len(expected)}"
    for mine, theirs in zip(got, expected, strict=True):
        assert mine == theirs, f"{sorted(names)}\n  spark  {mine}\n  duckdb {theirs}"
    return len(got), middle - start, end - middle


def main(sf_dir: str, names: list[str]) -> None:
    import __spark_entry__ as entry
    from mergelens.session import build_session

    spark = build_session(
        "compare", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="20g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    oracles = entry.oracle_sql()
    failed = []
    for name, function in entry.queries().items():
        if names and name not in names:
            continue
        try:
            if name in oracles:
                rows, mine, theirs = compare(spark, connection, sf_dir, function, oracles[name])
                print(f"ok   {name:26} {rows:8} rows  spark {mine:6.2f}s  duckdb {theirs:6.2f}s")
            else:
                start = time.time()
                rows = function(spark, sf_dir).count()
                print(f"rows {name:26} {rows:8} rows  spark {time.time() - start:6.2f}s")
        except Exception as failure:
            failed.append(name)
            print(f"FAIL {name:26} {type(failure).__name__}: {str(failure)[:1500]}")
        sys.stdout.flush()
    print("failed:", failed)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])

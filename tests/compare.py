"""Runs a query in Spark and its SQL answer in DuckDB and compares all rows."""

from __future__ import annotations

import datetime
import decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return str(value)
    return value


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(plain(row[i]) for i in order) for row in rows),
        key=lambda row: tuple((v is None, str(v)) for v in row),
    )


def duck_rows(sf_dir: str, sql: str):
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    return names, types, result.fetchall()


def compare(df, sf_dir: str, sql: str) -> list[str]:
    """Differences between the DataFrame and the SQL answer; empty when equal."""
    names, types, expected = duck_rows(sf_dir, sql)
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(set(df.columns) ^ set(names))}"]
    left = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    right = sorted_rows(names, expected)
    problems = []
    spark_types = dict(df.dtypes)
    same = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
            "boolean": "BOOLEAN"}
    for name in names:
        if same.get(spark_types[name]) != types[name].upper():
            problems.append(f"type of {name}: {spark_types[name]} / {types[name]}")
    if len(left) != len(right):
        problems.append(f"rows {len(left)} / {len(right)}")
    different = [(a, b) for a, b in zip(left, right) if a != b]
    if different:
        problems.append(f"{len(different)} rows differ, first: {different[0]}")
    return problems

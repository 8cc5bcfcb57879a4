"""Compare a Spark result with a DuckDB result as bags of normalised rows."""

import datetime
import decimal
import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder):
    connection = duckdb.connect()
    connection.execute("SET threads = 4")
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, decimal.Decimal):
        return value.normalize() + 0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(df, connection, sql, shown=3):
    """None if equal, else a short text."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    left = bag(df.columns, [tuple(row) for row in df.collect()])
    right = bag(names, result.fetchall())
    if left == right:
        return None
    more, less = left - right, right - left
    return (
        f"rows {sum(left.values())} / {sum(right.values())}, only Spark {sum(more.values())}: "
        f"{list(more)[:shown]}, only SQL {sum(less.values())}: {list(less)[:shown]}"
    )

"""Compare a Spark result with the oracle SQL run by DuckDB on the same files."""

from __future__ import annotations

import datetime
import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


def plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


SAME_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": ("VARCHAR", "JSON"),
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def compare(df: DataFrame, db: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Differences between the two results; empty when they agree."""
    result = db.execute(sql)
    columns = [d[0] for d in result.description]
    expected = rows_of(columns, result.fetchall())
    types = {r[0]: r[1] for r in db.execute(f"DESCRIBE {sql}").fetchall()}
    problems = []
    if sorted(df.columns) != sorted(columns):
        return [f"columns {sorted(df.columns)} != {sorted(columns)}"]
    for name, kind in df.dtypes:
        want = SAME_TYPES.get(kind, ())
        if types[name] not in ([want] if isinstance(want, str) else want):
            problems.append(f"type of {name}: {kind} against {types[name]}")
    actual = rows_of(df.columns, df.collect())
    if actual != expected:
        order = sorted(df.columns)
        problems.append(
            f"{sum(actual.values())} rows against {sum(expected.values())} of {order}; "
            f"only here {list((actual - expected).items())[:3]}; only there {list((expected - actual).items())[:3]}"
        )
    return problems

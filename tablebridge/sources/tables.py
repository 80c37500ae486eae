"""Reading and counting tables."""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Mapping
from functools import reduce
from typing import NamedTuple

from py4j.protocol import Py4JError, Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tablebridge.functions.paths import quote


class Partitioning(NamedTuple):
    """How to split a JDBC read: a numeric or date column, its bounds, and the number of readers."""

    column: str
    lower: object
    upper: object
    count: int


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    partition: Partitioning | None = None,
    predicates: list[str] | None = None,
    columns: Iterable[str] | None = None,
    properties: Mapping[str, str] | None = None,
    fetch_size: int = 3000,
) -> DataFrame:
    """Read a SQL table over JDBC, with several readers when ``partition`` or ``predicates`` is given.

    Column and filter pruning reach the database. Bounds only place the split
    points: rows outside them are read too. A column with a hot value splits
    badly by range; give the ``predicates`` of :func:`split_evenly` instead.
    """
    options = {"preferTimestampNTZ": "true", "fetchsize": str(fetch_size), **(properties or {})}
    if predicates:
        df = spark.read.jdbc(url, table, predicates=predicates, properties=options)
    else:
        reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
        if partition:
            reader = reader.options(
                partitionColumn=partition.column,
                lowerBound=str(partition.lower),
                upperBound=str(partition.upper),
                numPartitions=str(partition.count),
            )
        df = reader.load()
    return df.select(*[quote(c) for c in columns]) if columns is not None else df


def identifier_mark(url: str) -> str:
    """What names are quoted with in the database's own SQL."""
    return "`" if url.startswith(("jdbc:mysql", "jdbc:mariadb")) else '"'


def split_by(
    spark: SparkSession, url: str, table: str, column: str, count: int, properties: Mapping[str, str] | None = None
) -> Partitioning | None:
    """Ask the database for the bounds of ``column`` (named as the reader shows it); None for an empty table."""
    mark = identifier_mark(url)
    quoted = mark + column.replace(mark, mark * 2) + mark
    query = f"SELECT MIN({quoted}) AS lo, MAX({quoted}) AS hi FROM {table}"
    row = spark.read.format("jdbc").options(url=url, query=query, **(properties or {})).load().first()
    return None if row is None or row[0] is None else Partitioning(column, row[0], row[1], count)


def _sql_value(value: object) -> str:
    """A literal in the database's own SQL; dates and times by the escapes that all JDBC drivers know."""
    if isinstance(value, datetime.datetime):
        return f"{{ts '{value:%Y-%m-%d %H:%M:%S.%f}'}}"
    if isinstance(value, datetime.date):
        return f"{{d '{value:%Y-%m-%d}'}}"
    return str(value)


def _edges(df: DataFrame, column: str, parts: int) -> list:
    """Upper ends of ``parts`` shares of the rows; the same value again where one value fills several shares."""
    if parts < 2:
        return []
    places = [i / parts for i in range(1, parts)]
    return list(df.agg(F.percentile_approx(F.col(quote(column)), places, 10_000)).first()[0] or [])


def split_evenly(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    count: int,
    tie: str | None = None,
    sample: float = 1.0,
    partition: Partitioning | None = None,
    properties: Mapping[str, str] | None = None,
) -> list[str]:
    """Predicates for :func:`read_table` that cut a table into about ``count`` parts of about as many rows each.

    They follow from the quantiles of a ``sample`` of the keys alone, which are counted in Spark (read by several tasks with
    ``partition``); every row is in one part, whatever was sampled. Where one value of ``column`` fills more than a part, its
    rows are cut by quantiles of ``tie``, another numeric or date column. Rows without a key are a part of their own.
    """
    mark = identifier_mark(url)

    def name(c: str) -> str:
        return mark + c.replace(mark, mark * 2) + mark

    columns = [column, *([tie] if tie else [])]
    keys = read_table(spark, url, table, partition, columns=columns, properties=properties)
    keys = keys.sample(sample, seed=1) if sample < 1 else keys
    edges = _edges(keys, column, count)
    if not edges:
        return ["1 = 1"]
    key = name(column)
    hot = {v: edges.count(v) for v in edges if edges.count(v) > 1}
    parts = [f"{key} IS NULL"]
    ends = sorted(set(edges))
    for low, high in zip([None, *ends], [*ends, None]):
        # From an end on, or behind it where its value has parts of its own.
        sides = [f"{key} {'>' if low in hot else '>='} {_sql_value(low)}"] if low is not None else []
        sides += [f"{key} < {_sql_value(high)}"] if high is not None else []
        parts.append(" AND ".join(sides))
    for value, filled in hot.items():
        same = f"{key} = {_sql_value(value)}"
        among = keys.where(F.col(quote(column)) == F.lit(value))
        cuts = sorted(set(_edges(among, tie, filled + 1))) if tie else []
        for low, high in zip([None, *cuts], [*cuts, None]):
            sides = [f"{name(tie)} >= {_sql_value(low)}"] if low is not None else []
            sides += [f"{name(tie)} < {_sql_value(high)}"] if high is not None else []
            # Rows whose tie is NULL go with the first part of their value.
            tied = " AND ".join(sides)
            parts.append(f"{same} AND ({tied} OR {name(tie)} IS NULL)" if tied and low is None else f"{same} AND {tied}" if tied else same)
    return parts


def read_parquet(spark: SparkSession, path: str, schema: str | None = None, merge_schema: bool = False) -> DataFrame:
    """Read a Parquet directory.

    ``merge_schema`` sees columns that only later files have, at the price of
    reading every footer; on large directories give ``schema`` instead.
    """
    reader = spark.read.option("mergeSchema", merge_schema)
    return (reader.schema(schema) if schema else reader).parquet(path)


def count_table(spark: SparkSession, table: str | DataFrame) -> DataFrame:
    """One row ``n``: the number of rows, 0 for a catalog table that does not exist. Other errors are raised."""
    if isinstance(table, str):
        if not spark.catalog.tableExists(table):
            return spark.range(1).select(F.lit(0).cast("bigint").alias("n"))
        table = spark.table(table)
    return table.agg(F.count(F.lit(1)).alias("n"))


# The SQL states that say a table does not exist (standard, PostgreSQL, Derby).
NO_SUCH_TABLE = ("42S02", "42P01", "42X05")


def jdbc_table_exists(spark: SparkSession, url: str, table: str, properties: Mapping[str, str] | None = None) -> bool:
    """Whether the database knows the table; errors other than its absence are raised."""
    try:
        spark.read.format("jdbc").options(url=url, dbtable=table, **(properties or {})).load()
    except (PySparkException, Py4JJavaError) as error:
        cause = error.java_exception if isinstance(error, Py4JJavaError) else getattr(error, "_origin", None)
        while cause is not None:
            if _sql_state(cause) in NO_SUCH_TABLE:
                return False
            cause = cause.getCause()
        raise
    return True


def _sql_state(cause) -> str | None:
    try:
        return cause.getSQLState()
    except Py4JError:  # not an exception of the database
        return None


def count_jdbc(spark: SparkSession, url: str, table: str, properties: Mapping[str, str] | None = None) -> int:
    """Count a SQL table in the database itself; only the number travels. A table that does not exist counts 0."""
    if not jdbc_table_exists(spark, url, table, properties):
        return 0
    reader = spark.read.format("jdbc").options(
        url=url, query=f"SELECT COUNT(*) AS n FROM {table}", **(properties or {})
    )
    return int(reader.load().first()[0])


def table_inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(name, n)`` per table, counted in one plan."""
    if not tables:
        raise ValueError("no tables given")
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n") for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def list_databases(spark: SparkSession) -> list[str]:
    return [d.name for d in spark.catalog.listDatabases()]


def list_tables(spark: SparkSession, database: str) -> list[str]:
    """Names of the tables of a database; empty when there is no such database."""
    if not spark.catalog.databaseExists(database):
        return []
    return [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]


# How the databases list what they hold.
CATALOG_QUERIES = {
    "postgresql": {
        "databases": "SELECT datname AS name FROM pg_database WHERE NOT datistemplate",
        "tables": "SELECT table_name AS name FROM information_schema.tables WHERE table_schema = '{schema}'",
    },
    "mysql": {
        "databases": "SELECT schema_name AS name FROM information_schema.schemata",
        "tables": "SELECT table_name AS name FROM information_schema.tables WHERE table_schema = '{schema}'",
    },
    "mariadb": {
        "databases": "SELECT schema_name AS name FROM information_schema.schemata",
        "tables": "SELECT table_name AS name FROM information_schema.tables WHERE table_schema = '{schema}'",
    },
    "derby": {
        "tables": "SELECT t.tablename AS name FROM sys.systables t JOIN sys.sysschemas s ON t.schemaid = s.schemaid "
        "WHERE s.schemaname = '{schema}'",
    },
}


def jdbc_names(
    spark: SparkSession, url: str, what: str, schema: str = "", properties: Mapping[str, str] | None = None
) -> DataFrame:
    """One column ``name``: the ``databases`` of a server or the ``tables`` of a schema."""
    dialect = url.split(":")[1]
    query = CATALOG_QUERIES.get(dialect, {}).get(what)
    if query is None:
        raise ValueError(f"cannot list {what} over {dialect}")
    query = query.format(schema=schema.replace("'", "''"))
    return spark.read.format("jdbc").options(url=url, query=query, **(properties or {})).load().toDF("name")

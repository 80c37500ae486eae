"""Appending a DataFrame to a sink.

File appends commit whole or not at all per job. JDBC appends commit per
partition, so a job that fails half way leaves rows behind: give ``key`` and a
repeated append skips the rows that are already there; or use
:func:`tablebridge.sinks.once.append_once`.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_
from typing import Protocol

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from tablebridge.functions.paths import quote
from tablebridge.functions.rows import encode_nested
from tablebridge.operators.columns import missing_columns
from tablebridge.operators.reconcile import row_hashes
from tablebridge.session import path_exists
from tablebridge.sources.tables import Partitioning, count_jdbc, jdbc_table_exists, read_parquet, read_table


class Sink(Protocol):
    def write(self, df: DataFrame) -> None: ...

    def read(self, spark: SparkSession) -> DataFrame | None: ...


class SchemaChange(ValueError):
    """The frame does not fit the sink."""


# Types of one line take the last of any two.
WIDER = ((T.ByteType, T.ShortType, T.IntegerType, T.LongType), (T.FloatType, T.DoubleType))


def common_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds all values of both: whole numbers of any width, floating ones, and nested types of these."""
    if a == b:
        return a
    for line in WIDER:
        if type(a) in line and type(b) in line:
            return max(a, b, key=lambda kind: line.index(type(kind)))
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        inner = common_type(a.elementType, b.elementType)
        return inner and T.ArrayType(inner)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        inner = common_type(a.keyType, b.keyType), common_type(a.valueType, b.valueType)
        return T.MapType(*inner) if all(inner) else None
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return common_schema(a, b)
    # Whether a value may be NULL is no part of its type here.
    return a if a.simpleString() == b.simpleString() else None


def common_schema(a: T.StructType, b: T.StructType) -> T.StructType | None:
    """Columns of both, by name, each of the common type; None where two have none."""
    theirs = {f.name: f.dataType for f in b.fields}
    fields = [(f.name, common_type(f.dataType, theirs[f.name]) if f.name in theirs else f.dataType) for f in a.fields]
    fields += [(f.name, f.dataType) for f in b.fields if f.name not in a.names]
    return T.StructType([T.StructField(name, kind) for name, kind in fields]) if all(kind for _, kind in fields) else None


@dataclass(frozen=True)
class ParquetSink:
    """A Parquet directory. With ``evolve`` new columns may be appended, which read as NULL in older files, and wider types.

    A column takes the widest type that any append had (see :func:`common_type`). The first append that widens one leaves
    the schema in a small file beside the data, whose readers take that schema and widen older files as they read them.
    """

    path: str
    evolve: bool = False

    @property
    def schemas(self) -> str:
        """A folder that Spark does not take for data."""
        return f"{self.path.rstrip('/')}/_schemas"

    def schema(self, spark: SparkSession) -> T.StructType | None:
        """The widest schema that appends have left; None while the files agree."""
        if not path_exists(spark, self.schemas):
            return None
        found = [T.StructType.fromJson(json.loads(r.value)) for r in spark.read.text(self.schemas).collect()]
        return reduce(common_schema, found) if found else None

    def read(self, spark: SparkSession) -> DataFrame | None:
        if not path_exists(spark, self.path):
            return None
        if self.evolve and (schema := self.schema(spark)) is not None:
            return spark.read.schema(schema).parquet(self.path)
        try:
            return read_parquet(spark, self.path, merge_schema=self.evolve)
        except AnalysisException as error:
            if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # the folder holds no files yet
                return None
            raise

    def write(self, df: DataFrame) -> None:
        target = self.read(df.sparkSession)
        if target is not None:
            check_fits(df, target, self.evolve)
            kept = self.schema(df.sparkSession) if self.evolve else None
            schema = common_schema(target.schema, df.schema) if self.evolve else None
            if schema is not None:
                kinds = {f.name: f.dataType for f in schema.fields}
                widened = any(f.dataType.simpleString() != kinds[f.name].simpleString() for f in target.schema.fields)
                if widened or kept is not None and len(schema) > len(kept):
                    # Before the rows, so that no reader meets files wider than the schema it finds.
                    line = df.sparkSession.createDataFrame([(schema.json(),)], "value string")
                    line.coalesce(1).write.mode("append").text(self.schemas)
        df.write.mode("append").parquet(self.path)


@dataclass(frozen=True)
class JdbcSink:
    """A SQL table over JDBC. Nested values go out as JSON text; arrays too, unless the database has them.

    ``partition`` or ``predicates`` split what a keyed append reads back over several connections.
    """

    url: str
    table: str
    batch_size: int = 1000
    native_arrays: bool = False
    max_connections: int | None = None
    properties: Mapping[str, str] = field(default_factory=dict)
    partition: Partitioning | None = None
    predicates: Sequence[str] = ()

    def read(self, spark: SparkSession) -> DataFrame | None:
        if not jdbc_table_exists(spark, self.url, self.table, self.properties):
            return None
        predicates = list(self.predicates) or None
        return read_table(spark, self.url, self.table, self.partition, predicates, properties=self.properties)

    def write(self, df: DataFrame) -> None:
        options = {"batchsize": str(self.batch_size), **self.properties}
        if self.max_connections:
            options["numPartitions"] = str(self.max_connections)
        target = self.read(df.sparkSession)
        if target is not None:
            have = {name.lower() for name in target.columns}
            new = [name for name in df.columns if name.lower() not in have]
            if new:
                raise SchemaChange(f"the table {self.table} has no columns {', '.join(new)}; add them before the append")
        encode_nested(df, arrays=not self.native_arrays).write.jdbc(
            self.url, self.table, mode="append", properties=options
        )

    def count(self, spark: SparkSession) -> int:
        return count_jdbc(spark, self.url, self.table, self.properties)


def check_fits(df: DataFrame, target: DataFrame, evolve: bool) -> None:
    """Refuse a column that changed type, unless ``evolve`` finds a type for both, and new columns unless ``evolve``."""
    have = {f.name: f.dataType for f in target.schema.fields}

    def fits(a: T.DataType, b: T.DataType) -> bool:
        return a.simpleString() == b.simpleString() or evolve and common_type(a, b) is not None

    changed = [
        f"{f.name}: {have[f.name].simpleString()} -> {f.dataType.simpleString()}"
        for f in df.schema.fields
        if f.name in have and not fits(have[f.name], f.dataType)
    ]
    if changed:
        raise SchemaChange(f"columns change type: {', '.join(changed)}")
    new = missing_columns(df, target)
    if new and not evolve:
        raise SchemaChange(f"the sink has no columns {', '.join(new)}; append with evolve to add them")


def single_rows(df: DataFrame, key: Sequence[str], repeated: Observation | None = None) -> DataFrame:
    """One row for each key: of several, that whose hash is least, so that no partitioning changes which.

    ``repeated`` is told, under ``left_out``, how many rows with a key of another row, and unlike it, are not among them.
    """
    columns = [F.col(quote(c)) for c in df.columns]
    first, second = row_hashes(df, df.columns)
    hashed = df.select(*[F.col(quote(k)).alias(f"_key{i}") for i, k in enumerate(key)], F.struct(first, second).alias("_hash"), F.struct(*columns).alias("_row"))
    groups = hashed.groupBy(*[f"_key{i}" for i in range(len(key))]).agg(
        F.min_by("_row", "_hash").alias("_row"), F.count("*").alias("_n"), F.min("_hash").alias("_least"), F.max("_hash").alias("_most")
    )
    if repeated is not None:
        unlike = F.when(F.col("_least") != F.col("_most"), F.col("_n") - 1).otherwise(0)
        groups = groups.observe(repeated, F.coalesce(F.sum(unlike), F.lit(0)).alias("left_out"))
    return groups.select("_row.*")


def unseen(df: DataFrame, present: DataFrame | None, key: Sequence[str], repeated: Observation | None = None) -> DataFrame:
    """One row of ``df`` (see :func:`single_rows`) for each key that ``present`` lacks. NULL is a key like any other."""
    df = single_rows(df, key, repeated)
    if present is None:
        return df
    there = present.select(*[F.col(quote(k)).alias(f"_present{i}") for i, k in enumerate(key)]).distinct()
    same = [df[quote(k)].eqNullSafe(F.col(f"_present{i}")) for i, k in enumerate(key)]
    return df.join(there, reduce(and_, same), "left_anti")


def append(
    df: DataFrame,
    sink: Sink,
    key: Sequence[str] = (),
    observe: Callable[[DataFrame], DataFrame] = lambda df: df,
    repeated: Observation | None = None,
) -> None:
    """Append ``df``. With ``key``, only rows whose key the sink does not hold, one for each key (see :func:`unseen`)."""
    if key:
        df = unseen(df, sink.read(df.sparkSession), key, repeated)
    sink.write(observe(df))


def evolve(parts: Sequence[DataFrame]) -> DataFrame:
    """One frame of several appends: columns by name, of the widest type, NULL where a part lacks one."""
    out = parts[0]
    for part in parts[1:]:
        check_fits(part, out, evolve=True)
        out = out.unionByName(part, allowMissingColumns=True)  # a union takes the wider type
    return out

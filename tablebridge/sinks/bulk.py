"""Bulk-insert payloads for a SQL-over-HTTP endpoint.

A payload is ``{"stmt": "INSERT INTO s.t (c, ...) VALUES (?, ...)", "bulk_args": [[...], ...]}``;
its rows all have the same columns. Documents are turned into argument lists by
Spark expressions and cut into payloads where they lie: each task sorts its own
rows by shape (Spark spills such a sort) and chunks them one after the other. So
there is no shuffle, a task holds one payload at a time, and no payload exceeds
the batch size or the byte limit however skewed shapes, ids or copies are.

Cut so, every task ends every shape with a short batch. With ``full`` the batches are those of the whole collection: counts
per shape and task, a few numbers each, give every row its number within its shape, and rows go to the task of their batch,
so a shape has one short batch however the documents were spread. That costs one write and one shuffle of the rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.datasource import DataSource

from tablebridge.functions.cells import HTTP, normalise_elements, scalar_text
from tablebridge.functions.paths import entries, quote
from tablebridge.functions.tags import kind
from tablebridge.operators.discover import DOC
from tablebridge.session import scratch_path
from tablebridge.sinks.bulk_tasks import PAYLOAD_SCHEMA, BulkDataSource, chunker


def _argument(v: str, k: str) -> str:
    """JSON text of one value. Plain scalars and objects go straight out, the rest through the ``HTTP`` steps."""
    cell = normalise_elements(f"array({v})", HTTP)
    return f"""CASE
        WHEN {k} IS NULL OR {k} = 'VOID' THEN 'null'
        WHEN {k} IN ('STRING', 'BIGINT') THEN to_json({v})
        WHEN {k} = 'BOOLEAN' THEN concat('"', to_json({v}), '"')
        WHEN {k} = 'DOUBLE' OR startswith({k}, 'DECIMAL') THEN concat('"', {scalar_text(v, 'Double64')}, '"')
        WHEN startswith({k}, 'OBJECT') AND NOT contains(to_json({v}), '"$') THEN to_json(cast(to_json({v}) AS variant))
        ELSE coalesce(to_json({cell}[0].value), 'null') END"""


def argument_rows(docs: DataFrame, doc: str = DOC) -> DataFrame:
    """``(..., keys, args)``: the sorted keys of each document and its values as one JSON array."""
    fields = entries(quote(doc))
    cells = f"transform(map_values({fields}), v -> named_struct('v', v, 'kind', {kind('v')}))"
    args = f"transform({cells}, e -> {_argument('e.v', 'e.kind')})"
    others = [quote(name) for name in docs.columns if name != doc]
    return docs.selectExpr(
        *others, f"to_json(map_keys({fields})) AS keys", f"concat('[', array_join({args}, ','), ']') AS args"
    )


def has_keys(doc: str = DOC) -> str:
    """Whether a document has any key; one without cannot be inserted."""
    return f"coalesce(size(map_keys({entries(quote(doc))})), 0) > 0"


def bulk_payloads(
    docs: DataFrame,
    schema: str,
    table: str,
    size: int = 1000,
    doc: str = DOC,
    ignore_conflicts: bool = False,
    max_bytes: int = 16_000_000,
    full: bool = False,
) -> DataFrame:
    """``(shape, stmt, n_rows, payload)``: one row per homogenous batch of at most ``size`` documents.

    With ``full`` all batches of a shape but one have ``size`` documents, unless the byte limit closes them.

    A batch is closed early when its argument lists reach ``max_bytes``; a single longer document goes alone. Documents
    without keys have no statement and are left out: ``docs.where(~expr(has_keys()))`` are these.
    """
    if size < 1:
        raise ValueError("size must be at least 1")
    rows = argument_rows(docs.select(quote(doc)).where(has_keys(doc)), doc).select("keys", "args")
    sorted_rows = _numbered(rows, size) if full else rows.sortWithinPartitions("keys")
    return sorted_rows.mapInArrow(chunker(schema, table, size, ignore_conflicts, max_bytes), PAYLOAD_SCHEMA)


def _numbered(rows: DataFrame, size: int) -> DataFrame:
    """``(keys, args, batch)`` in the tasks of their batches.

    Rows are written with the task and place that they had, so that counting and cutting see the same order whatever is
    tried again. The place of a row is its distance from the first one of its shape in its task, plus the rows of the
    shape in earlier tasks.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "bulk-rows")
    placed = rows.sortWithinPartitions("keys").withColumn("place", F.monotonically_increasing_id())
    placed.withColumn("task", F.spark_partition_id()).write.parquet(path)
    written = spark.read.parquet(path)
    counts = written.groupBy("keys", "task").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("keys").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("keys", "task", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("offset"))
    batch = F.floor((F.col("place") + F.col("offset")) / size)
    cut = written.join(offsets, ["keys", "task"]).select("keys", "args", batch.alias("batch"))
    return cut.repartition("keys", "batch").sortWithinPartitions("keys", "batch")


@dataclass(frozen=True)
class BulkSink:
    """Sends documents as bulk-insert payloads. Takes a frame with a document column."""

    url: str
    schema: str
    table: str
    size: int = 1000
    ignore_conflicts: bool = False
    source: type[DataSource] = BulkDataSource
    max_bytes: int = 16_000_000
    full: bool = False

    def read(self, spark: SparkSession) -> None:
        return None

    def write(self, df: DataFrame) -> None:
        df.sparkSession.dataSource.register(self.source)
        payloads = bulk_payloads(
            df, self.schema, self.table, self.size, ignore_conflicts=self.ignore_conflicts, max_bytes=self.max_bytes, full=self.full
        )
        payloads.write.format(self.source.name()).option("url", self.url).mode("append").save()

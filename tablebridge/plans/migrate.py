"""Moving a table or a document collection to a sink, end to end.

One lazy plan per step: read, drop what is ignored, normalise or conform,
append. Counts are observed while the rows pass through, so the report costs no
extra pass over the data.
"""

from __future__ import annotations

import time
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tablebridge.functions.paths import JSON_OPTIONS
from tablebridge.functions.rows import normalise_sql
from tablebridge.operators.columns import ignore_columns, ignore_keys
from tablebridge.operators.align import normalise
from tablebridge.operators.conform import REJECTS, conform_with_rejects, identified, split_rejects
from tablebridge.operators.deliver import native_columns
from tablebridge.operators.discover import DOC, MAX_KEYS, Known, discover
from tablebridge.sinks.append import Sink, append
from tablebridge.sinks.bulk import BulkSink, has_keys

REPORT_SCHEMA = "step string, rows bigint, elapsed_ms bigint"


@dataclass
class Report:
    """Steps of a migration with their row counts and times."""

    steps: list[tuple[str, int | None, int]] = field(default_factory=list)
    _last: float = field(default_factory=time.monotonic)

    def step(self, name: str, rows: int | None = None) -> None:
        now = time.monotonic()
        self.steps.append((name, rows, round((now - self._last) * 1000)))
        self._last = now

    def frame(self, spark: SparkSession) -> DataFrame:
        """``(step, rows, elapsed_ms, rows_per_s)``, a ``total`` row last; the rate is NULL at 0 ms."""
        sent = sum(rows or 0 for name, rows, _ in self.steps if name == "append")
        total = ("total", sent, sum(ms for _, _, ms in self.steps))
        ms = F.col("elapsed_ms")
        return spark.createDataFrame([*self.steps, total], REPORT_SCHEMA).withColumn(
            "rows_per_s", F.when(ms > 0, F.col("rows") * 1000.0 / ms)
        )


def migrate_table(
    df: DataFrame,
    sink: Sink,
    ignore: Iterable[str] = (),
    json_columns: Iterable[str] = (),
    key: Sequence[str] = (),
) -> DataFrame:
    """Append a SQL table to ``sink`` and return the report. ``key`` makes a repeated run skip rows already there.

    Of rows that share a key one goes in, always the same; a step ``repeated`` counts the others that are unlike it.

    ``json_columns`` arrive as native values: arrays of numbers, arrays of text, or text (see :func:`native_columns`).
    """
    report = Report()
    json_columns = [c for c in json_columns if c in df.columns]
    rows = normalise_sql(ignore_columns(df, ignore), json_columns)
    if json_columns:
        rows = native_columns(rows, [c for c in json_columns if c in rows.columns])
        report.step("discover")
    _append(report, rows, sink, key)
    return report.frame(df.sparkSession)


def _append(report: Report, rows: DataFrame, sink: Sink, key: Sequence[str] = ()) -> None:
    """Append, and report what went in and, as ``repeated``, rows left out because another row has their key."""
    counted, repeated = Observation(), Observation() if key else None
    append(rows, sink, key, lambda df: df.observe(counted, F.count(F.lit(1)).alias("n")), repeated)
    report.step("append", counted.get["n"])
    if repeated is not None and repeated.get["left_out"]:
        report.step("repeated", repeated.get["left_out"])


def migrate_typed(
    docs: DataFrame,
    sink: Sink,
    keys: Iterable[str] | None = None,
    ignore: Iterable[str] = (),
    key: Sequence[str] = (),
    doc: str = DOC,
    rest: str | None = None,
) -> DataFrame:
    """Append documents to ``sink`` as typed columns and return the report.

    With ``rest`` only ``keys`` get columns; the others stay together in the column of that name, as JSON text.

    Every value is normalised by the ``typed`` rules and arrives as a native value; a key whose values have several types
    gets a column for each of them.
    """
    report = Report()
    cells = normalise(ignore_keys(docs, ignore, doc), "typed", keys, doc, rest=rest)
    rows = native_columns(cells, [c for c in cells.columns if (c not in docs.columns or c == doc) and c != rest])
    report.step("discover")
    _append(report, rows, sink, key)
    return report.frame(docs.sparkSession)


def migrate_documents(
    docs: DataFrame,
    sink: Sink,
    spec: object = None,
    ignore: Iterable[str] = (),
    known: Known | None = None,
    row_id: str | None = None,
    rejects: Sink | None = None,
    doc: str = DOC,
    max_keys: int | None = MAX_KEYS,
    stable: bool = False,
    rest: str | None = None,
) -> DataFrame:
    """Conform documents to ``spec``, append them to ``sink`` and return the report.

    Without ``row_id`` rows and rejects carry a hash of the document under that name, so that they can be joined. With
    ``rest`` undeclared keys stay together in that column, as JSON text. Values that cannot be placed go to the ``rejects`` sink. They are read from
    the source again, and only if the first pass saw any; without that sink
    such a migration is reported, then fails, since values would be missing.
    """
    spark = docs.sparkSession
    report = Report()
    if known is None:
        known = discover(docs, spec, doc, max_keys, declared_only=rest is not None)
        report.step("discover")
        strict = False
    else:
        strict = True
    docs, row_id = identified(docs, row_id, doc)
    options = {"doc": doc, "ignore": ignore, "stable": stable, "strict": strict, "rest": rest}
    rows, _ = conform_with_rejects(docs, spec, known, **options)
    counted = Observation()
    rows = rows.observe(
        counted,
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.size(REJECTS)), F.lit(0)).alias("rejected"),
    )
    append(rows.drop(REJECTS), sink)
    n, rejected = counted.get["n"], counted.get["rejected"]
    report.step("append", n)
    if rejected:
        if rejects is None:
            raise RejectedValues(rejected, report.frame(spark))
        again, _ = conform_with_rejects(docs, spec, known, **options)
        append(split_rejects(again, [row_id]), rejects)
        report.step("rejects", rejected)
    return report.frame(spark)


class RejectedValues(RuntimeError):
    """Rows were appended, but some of their values could not be placed and no rejects sink was given."""

    def __init__(self, count: int, report: DataFrame):
        super().__init__(f"{count} values could not be placed; pass a rejects sink to keep them")
        self.report = report


def migrate_bulk(docs: DataFrame, sink: BulkSink, ignore: Iterable[str] = (), doc: str = DOC) -> DataFrame:
    """Send documents as bulk-insert payloads and return the report.

    A document without keys cannot be inserted; such documents are counted in a step ``rejects``.
    """
    report = Report()
    counted = Observation()
    kept = ignore_keys(docs, ignore, doc).select(F.col(doc).alias(DOC))
    empty = F.expr(f"NOT {has_keys(DOC)}")
    sent = (F.count(F.lit(1)) - F.count_if(empty)).alias("n")
    sink.write(kept.observe(counted, sent, F.count_if(empty).alias("empty")))
    report.step("append", counted.get["n"])
    if counted.get["empty"]:
        report.step("rejects", counted.get["empty"])
    return report.frame(docs.sparkSession)


def export_documents(df: DataFrame, path: str) -> None:
    """Append each row as one JSON document to text files under ``path``; NULL fields are null, timestamps keep microseconds."""
    df.select(F.to_json(F.struct("*"), JSON_OPTIONS).alias("value")).write.mode("append").text(path)


def load_collection(df: DataFrame, uri: str, database: str, collection: str) -> None:
    """Append rows to a document-database collection through the ``mongodb`` Spark connector, when present."""
    (
        df.write.format("mongodb")
        .option("connection.uri", uri)
        .option("database", database)
        .option("collection", collection)
        .mode("append")
        .save()
    )

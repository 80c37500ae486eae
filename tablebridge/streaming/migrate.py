"""Incremental migration: new JSON-lines files are conformed and appended as they arrive.

Every micro-batch writes its own directory ``batch_id=<n>`` with overwrite, so a
batch that is run again after a failure replaces its output. Column types
follow from the spec alone (see ``stable`` in :func:`conform`), so batches agree
with each other, and :func:`read_migrated` sees the columns of all of them.

What keys and tags the batches hold is kept beside the checkpoint. A batch is conformed to what is known so far, in one
read; only if that leaves keys or tags over is it searched for them and written again, with what it adds to the known. So
a stream whose documents have settled down is read once, however many keys it has.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tablebridge.operators.conform import REJECTS, ROW_ID, conform_with_rejects, identified, split_rejects
from tablebridge.operators.discover import DOC, MAX_KEYS, Known, discover, merge_known
from tablebridge.session import path_exists
from tablebridge.sinks.append import ParquetSink
from tablebridge.sources.documents import is_document, parse_column, stream_documents

# The folders under the output path, and the one beside the checkpoint.
ROWS, REJECTED, MALFORMED, REPORT = "rows", "rejects", "malformed", "report"
KNOWN = "known-keys"
REPORT_ROW = "step string, rows bigint, elapsed_ms bigint"


class KnownKeys:
    """Keys and tags that batches have shown: one small file of JSON lines for every batch that showed new ones."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.before: dict[int, Known] = {}
        if path_exists(spark, folder):
            for row in spark.read.text(folder).select("value", "batch_id").collect():
                entry = json.loads(row.value)
                self.before[row.batch_id] = merge_known(self.before.get(row.batch_id, {}), {tuple(entry["path"]): frozenset(entry["tags"])})

    def at(self, batch_id: int) -> Known:
        """What the batches before this one have shown; a batch that is run again finds what it found then."""
        return merge_known(*[found for i, found in self.before.items() if i < batch_id])

    def add(self, batch_id: int, found: Known) -> None:
        lines = [(json.dumps({"path": path, "tags": sorted(tags)}),) for path, tags in sorted(found.items())]
        written = self.spark.createDataFrame(lines, "value string").coalesce(1)
        written.write.mode("overwrite").text(f"{self.folder}/batch_id={batch_id}")
        self.before[batch_id] = found


def _is_known(known: Known, column: str, tag: str) -> bool:
    """Whether a reject is of a key and tag that were known, so that searching the batch again would add nothing."""
    return any(".".join(path) == column and tag in tags for path, tags in known.items())


def stream_migrate(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    spec: object,
    checkpoint: str,
    known: Known | None = None,
    ignore: Iterable[str] = (),
    max_files_per_trigger: int | None = None,
    max_keys: int | None = MAX_KEYS,
    trigger: dict | None = None,
    rest: str | None = None,
) -> StreamingQuery:
    """Start the migration and return the running query.

    By default it takes what is there and stops (``availableNow``). With
    ``known`` each batch is read once and keys beside it are rejected; without, new keys are
    found as they come (see above). With ``rest`` undeclared keys stay together in that column, as JSON text. Rows
    carry ``row_id``, a hash of their document, so a document without
    keys is a row too. Values that cannot be placed, under the same id, and
    lines that are no documents are written beside the rows, when there are any. Each batch writes report rows
    (see :func:`stream_report`).
    """
    ignore = list(ignore)
    kept = KnownKeys(spark, f"{checkpoint.rstrip('/')}/{KNOWN}") if known is None else None

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        started = time.monotonic()

        def target(kind: str) -> str:
            return f"{out_dir.rstrip('/')}/{kind}/batch_id={batch_id}"

        parsed = parse_column(batch, "value")
        good = is_document("value")
        docs = parsed.where(good).select(DOC)

        def write(found: Known, strict: bool) -> tuple[int, int, int]:
            """Write the rows, and the rejects if there are any; numbers of rows, rejects and malformed lines."""
            seen, placed = Observation(), Observation()
            options = {"ignore": ignore, "stable": True, "strict": strict, "rest": rest}
            counted = parsed.observe(seen, F.coalesce(F.sum((~good).cast("bigint")), F.lit(0)).alias("malformed"))
            rows, _ = conform_with_rejects(identified(counted.where(good).select(DOC), None)[0], spec, found, **options)
            n = F.count(F.lit(1)).alias("n")
            rows = rows.observe(placed, n, F.coalesce(F.sum(F.size(REJECTS)), F.lit(0)).alias("rejected"))
            rows.drop(REJECTS).write.mode("overwrite").parquet(target(ROWS))
            if placed.get["rejected"]:
                keyed, _ = conform_with_rejects(identified(docs, None)[0], spec, found, **options)
                split_rejects(keyed, [ROW_ID]).write.mode("overwrite").parquet(target(REJECTED))
            return placed.get["n"], placed.get["rejected"], seen.get["malformed"]

        def search() -> Known:
            found = discover(docs, spec, max_keys=max_keys, declared_only=rest is not None)
            return {path: tags for path, tags in found.items() if path[0] not in ignore}

        if kept is None:
            n, rejected, malformed = write(known, True)
        else:
            before = kept.at(batch_id)
            found = before or search()
            n, rejected, malformed = write(found, True)
            if before and rejected:
                # At most one row for each key and tag.
                left = spark.read.parquet(target(REJECTED)).select("column", "actual").distinct().collect()
                if not all(_is_known(found, r.column, r.actual) for r in left):
                    found = merge_known(found, search())
                    if found != before:
                        n, rejected, malformed = write(found, True)
                        if not rejected:
                            _remove(spark, target(REJECTED))
            if found != before:
                kept.add(batch_id, {path: tags for path, tags in found.items() if tags != before.get(path)})
        if malformed:
            parsed.where(~good).select(F.col("value").alias("raw")).write.mode("overwrite").parquet(target(MALFORMED))
        steps = [("append", n), ("rejects", rejected), ("malformed", malformed)]
        ms = round((time.monotonic() - started) * 1000)
        report = spark.createDataFrame([(step, rows, ms if step == "append" else 0) for step, rows in steps], REPORT_ROW)
        report.where("rows > 0 OR step = 'append'").coalesce(1).write.mode("overwrite").parquet(target(REPORT))

    return (
        stream_documents(spark, in_dir, max_files_per_trigger)
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _remove(spark: SparkSession, path: str) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(conf).delete(target, True)


def stream_report(spark: SparkSession, out_dir: str) -> DataFrame:
    """``(batch_id, step, rows, elapsed_ms, rows_per_s)`` of all batches: ``append`` always, ``rejects`` and ``malformed`` where there are any.

    A batch writes its report after its rows, so a batch without one is not done yet.
    """
    rows = ParquetSink(f"{out_dir.rstrip('/')}/{REPORT}").read(spark)
    if rows is None:
        rows = spark.createDataFrame([], f"{REPORT_ROW}, batch_id int")
    rate = F.when(F.col("elapsed_ms") > 0, F.col("rows") * 1000.0 / F.col("elapsed_ms"))
    return rows.select("batch_id", "step", "rows", "elapsed_ms", rate.alias("rows_per_s"))


def read_migrated(spark: SparkSession, out_dir: str, kind: str = ROWS) -> DataFrame | None:
    """What the batches have written so far, with the columns of all batches; None when there is nothing."""
    return ParquetSink(f"{out_dir.rstrip('/')}/{kind}", evolve=True).read(spark)

"""Small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablebridge.session import scratch_path

# Words of the contracts: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def kept(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared scratch folder and read back: lineage ends here, and lost executors lose nothing."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    written.kept_at = path
    return written


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``kept`` wrote, once all that is read from them has been written itself."""
    for table in tables:
        if path := getattr(table, "kept_at", None):
            jvm, conf = table.sparkSession.sparkContext._jvm, table.sparkSession.sparkContext._jsc.hadoopConfiguration()
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(conf).delete(target, True)


def portions(batch: pa.RecordBatch, column: int, rows: int = 1000, volume: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of at most ``rows`` rows and ``volume`` bytes of a text or binary column; a longer value is alone.

    After each, memory that Arrow holds for later goes back: a worker that lives on would keep what its largest slice took.
    """
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        before = int(ends[at - 1]) if at else 0
        to = min(at + rows, max(at + 1, int(np.searchsorted(ends, before + volume, side="right"))), batch.num_rows)
        yield batch.slice(at, to - at)
        pa.default_memory_pool().release_unused()
        at = to


def _taken(docs: DataFrame) -> set[str]:
    return {c.lower() for c in docs.columns}


def fresh(docs: DataFrame, *names: str) -> list[str]:
    """Names for columns of an operator's own that no column of ``docs`` has."""
    taken = _taken(docs)
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def apart(docs: DataFrame, *results: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``docs``, in which a column that has the name of a result stays with ``_before`` behind its name.

    Columns in ``keep`` are read by name and may not have a result's name.
    """
    wanted = {r.lower() for r in results}
    if clash := [c for c in keep if c.lower() in wanted]:
        raise ValueError(f"columns {', '.join(clash)} are read here and cannot have the name of a result")
    moved = {c: fresh(docs, f"{c}_before")[0] for c in docs.columns if c.lower() in wanted}
    return docs.withColumnsRenamed(moved) if moved else docs


def held_out(column: str, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text falls into ``part`` of ``parts``."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % parts == part


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once: a plain column inside a lambda is worked out for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other code point left alone."""
    return F.translate(text, UPPER, LOWER)


def spread(column: str) -> Column:
    """A uniform 60-bit number made of an id, the same in any engine that has md5."""
    digest = F.md5(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")

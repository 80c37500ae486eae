"""Documents stored in shredded columns, of which a reader of few keys reads few."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablebridge.functions.paths import get, quote, step

WRITE = {"spark.sql.variant.writeShredding.enabled": "true", "spark.sql.variant.inferShreddingSchema": "true"}


@contextmanager
def _settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def write_shredded(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write Parquet in which every VARIANT column, a whole document or an aligned key, is split by its keys.

    Each writing task finds the common keys and types of its first rows; a key of mixed types has a column of its own for
    the values unlike the others, and rare keys stay together. No key is lost, and any reader of VARIANT reads it back.
    """
    with _settings(df.sparkSession, WRITE):
        df.write.mode(mode).parquet(path)


def _path(key: str) -> str:
    spelled = step(key)
    if spelled is None:
        raise ValueError(f"no path can spell the key {key}")
    return f"${spelled}"


def read_keys(spark: SparkSession, path: str, column: str, keys: Mapping[str, str], carry: tuple[str, ...] = ()) -> DataFrame:
    """Columns in ``carry`` and, of the documents in ``column``, the given top-level keys as the given Spark types.

    Values of other types are converted where they can be, else NULL, as by ``try_variant_get``. The keys are all that is
    asked of the documents, so the scan reads only the columns that hold them.
    """
    taken = [f"{get(quote(column), _path(key), dtype)} AS {quote(key)}" for key, dtype in keys.items()]
    return spark.read.parquet(path).select(*[F.col(quote(c)) for c in carry], *[F.expr(e) for e in taken])

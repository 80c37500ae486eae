"""Reading document collections.

Documents are read as text and parsed in the same scan, so that a line that is
no document keeps its text and goes to the rejects.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablebridge.functions.cells import OBJECT_TEXT
from tablebridge.functions.paths import quote
from tablebridge.operators.discover import DOC


class Documents(NamedTuple):
    docs: DataFrame
    rejects: DataFrame


def spread(df: DataFrame) -> DataFrame:
    """``df`` in at least as many partitions as the cluster runs tasks at once.

    One Parquet row group is one task, however many cores are idle, and parsing and conforming its documents costs far
    more than dealing them out. Data in enough partitions, as any large input is, and streams stay as they are.
    """
    if df.isStreaming:
        return df
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df


def parse_column(df: DataFrame, text: str, doc: str = DOC) -> DataFrame:
    """Add ``doc``, the parsed ``text``, NULL where it is not JSON.

    The parse sits in a generator, through which the optimizer moves no filter:
    a filter on ``doc`` would otherwise parse every text a second time.
    """
    return df.select("*", F.explode(F.array(F.try_parse_json(F.col(quote(text))))).alias(doc))


def is_document(text: str, doc: str = DOC) -> Column:
    """Whether a parsed row holds a JSON object; never NULL."""
    return F.col(quote(doc)).isNotNull() & F.coalesce(F.col(quote(text)).rlike(OBJECT_TEXT), F.lit(False))


def parse_documents(df: DataFrame, text: str = "value", doc: str = DOC) -> Documents:
    """Parse a text column into documents and quarantine the rows that hold none.

    The other columns are carried along. The rejects keep the text and say why:
    ``malformed`` (also for a repeated key or no text at all) or ``not an object``.
    """
    others = [quote(name) for name in df.columns if name != text]
    parsed = parse_column(df, text, doc)
    docs = parsed.where(is_document(text, doc)).select(*others, doc)
    rejects = parsed.where(~is_document(text, doc)).select(
        *others,
        F.col(quote(text)).alias("raw"),
        F.when(F.col(doc).isNull(), "malformed").otherwise("not an object").alias("reason"),
    )
    return Documents(docs, rejects)


def read_documents(spark: SparkSession, path: str | list[str], doc: str = DOC) -> Documents:
    """Read JSON-lines files or directories; every line is one (Extended-)JSON document."""
    return parse_documents(spark.read.text(path), "value", doc)


def read_json_files(spark: SparkSession, path: str | list[str], doc: str = DOC) -> DataFrame:
    """Read files that each hold one JSON document or one array of documents.

    Each file is one task here; :func:`tablebridge.sources.arrays.read_json_arrays` splits large ones.
    """
    whole = spark.read.option("multiLine", True).option("singleVariantColumn", "v").json(path)
    one_or_many = F.coalesce(F.try_variant_get("v", "$", "array<variant>"), F.array("v"))
    return whole.select(F.explode(one_or_many).alias(doc))


def stream_documents(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of JSON-lines files as a ``value`` text column; parse it with :func:`parse_documents`."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)


def read_collection(spark: SparkSession, uri: str, database: str, collection: str, doc: str = DOC) -> Documents:
    """Read a document-database collection through the ``mongodb`` Spark connector, when it is on the classpath.

    The connector hands over each whole document as Extended-JSON text, so no
    schema is sampled and ragged documents arrive as they are.
    """
    reader = (
        spark.read.format("mongodb")
        .option("connection.uri", uri)
        .option("database", database)
        .option("collection", collection)
        .option("aggregation.pipeline", '[{"$project": {"_id": 0, "value": "$$ROOT"}}]')
        .option("outputExtendedJson", "true")
        .schema("value string")
    )
    return parse_documents(reader.load(), "value", doc)

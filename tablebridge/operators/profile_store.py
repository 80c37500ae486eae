"""A profile that is kept in a table and grows by new files only: counts, distinct values and quantiles per key and tag.

A profile is a table of sketch rows ``(key, tag, what, slot, amount)``. Rows of two collections are merged by adding up
amounts (``bucket``) or taking the larger (``register``), so the profile of the whole is that of its parts merged, row by
row and in any order:

* ``bucket``: how many values fall into a bucket of numbers, 64 to each power of two and so at most 1.6 % wide; the slot is
  NULL for what is no number. All buckets of a tag together count its values.
* ``register``: HyperLogLog, the longest run of zero bits among the hashes of one of 1,024 registers.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tablebridge.functions.cells import typed
from tablebridge.functions.tags import NONE, tag_of
from tablebridge.operators.discover import DOC, fields
from tablebridge.session import path_exists
from tablebridge.sources.documents import parse_documents

REGISTERS = 1024
PER_POWER = 64  # buckets from one power of two to the next
ZERO = 100_000  # slots of positive numbers lie around it, those of negative ones mirrored, that of 0 is 0

SKETCH = "key string, tag string, what string, slot int, amount bigint"
QUANTILES = (0.5, 0.95, 0.99)


def _slot(number: str) -> str:
    """Bucket of a number. The bounds are sums of powers of two, so that no engine rounds them."""
    size = f"abs({number})"
    power = f"floor(log2({size}))"
    step = f"floor(({size} / pow(2, {power}) - 1) * {PER_POWER})"
    slot = f"cast({ZERO} + {power} * {PER_POWER} + {step} AS int)"
    return f"CASE WHEN {number} = 0 THEN 0 WHEN {number} < 0 THEN -{slot} WHEN {size} < double('infinity') THEN {slot} END"


def sketch_profile(docs: DataFrame, doc: str = DOC) -> DataFrame:
    """Sketch rows of a collection, one scan. Values are told apart by their JSON text; JSON null has a count only.

    Rows combine before the shuffle: a key in every document costs as many rows per task as it has buckets and registers.
    """
    digest = "md5(to_json(value))"
    numbers = " ".join(f"WHEN '{t}' THEN cast({typed('value', t)} AS double)" for t in ("I32", "I64", "Double64"))
    values = (
        fields(docs, doc)
        .selectExpr("key", f"{tag_of('value', 'kind')} AS tag", "value")
        .where("key IS NOT NULL")
        .selectExpr(
            "key",
            "tag",
            f"CASE tag {numbers} END AS number",
            f"CASE WHEN tag <> '{NONE}' THEN {digest} END AS hash",
        )
        .selectExpr(
            "key",
            "tag",
            f"{_slot('number')} AS slot",
            f"cast(conv(substr(hash, 1, 3), 16, 10) AS int) % {REGISTERS} AS register",
            "cast(conv(substr(hash, 4, 13), 16, 10) AS bigint) AS bits",
        )
    )
    run = "CASE WHEN bits = 0 THEN 53 ELSE 53 - length(bin(bits)) END"
    rows = values.selectExpr(
        "key",
        "tag",
        f"""inline(array(named_struct('what', 'bucket', 'slot', slot, 'amount', 1L),
            named_struct('what', 'register', 'slot', register, 'amount', cast({run} AS bigint))))""",
    )
    return _merged(rows.where("what = 'bucket' OR slot IS NOT NULL"))


def _merged(rows: DataFrame) -> DataFrame:
    amount = F.when(F.col("what") == "register", F.max("amount")).otherwise(F.sum("amount"))
    return rows.groupBy("key", "tag", "what", "slot").agg(amount.alias("amount"))


def merge_profiles(*parts: DataFrame) -> DataFrame:
    """Sketch rows of several collections together."""
    return _merged(reduce(DataFrame.unionByName, parts))


def _middle(slot: Column) -> Column:
    """The number in the middle of a bucket."""
    place = F.abs(slot) - ZERO
    power = F.floor(place / PER_POWER)
    size = F.pow(F.lit(2.0), power) * (1 + (place - power * PER_POWER + 0.5) / PER_POWER)
    return F.when(slot == 0, 0.0).otherwise(F.signum(slot.cast("double")) * size)


def read_profile(sketch: DataFrame, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """``(key, tag, n, n_distinct, p50, ...)``: counts, an estimate of distinct values, quantiles of numbers.

    A quantile is the middle of the bucket that holds the value of nearest rank: 0.8 % off at most. The estimate of
    distinct values is 3 % off in the mean. Both are NULL where a tag has no numbers or no values.
    """
    group = ["key", "tag"]
    empty = REGISTERS - F.count(F.lit(1))
    harmonic = F.sum(F.pow(F.lit(2.0), -F.col("amount"))) + empty
    raw = 0.7213 / (1 + 1.079 / REGISTERS) * REGISTERS * REGISTERS / harmonic
    linear = REGISTERS * F.log(REGISTERS / empty)
    few = (raw <= 2.5 * REGISTERS) & (empty > 0)
    distinct = sketch.where("what = 'register'").groupBy(group).agg(F.round(F.when(few, linear).otherwise(raw)).cast("bigint").alias("n_distinct"))
    buckets = sketch.where("what = 'bucket'")
    counts = buckets.groupBy(group).agg(F.sum("amount").alias("n"))
    # At most some 270,000 buckets a tag, whatever the number of values.
    within = Window.partitionBy(group)
    ranked = buckets.where("slot IS NOT NULL").select(
        *group,
        "slot",
        F.sum("amount").over(within.orderBy("slot")).alias("up_to"),
        F.sum("amount").over(within).alias("numbers"),
    )
    at = [
        _middle(F.min(F.when(F.col("up_to") >= F.ceil(F.col("numbers") * q), F.col("slot")))).alias(f"p{round(q * 100)}")
        for q in quantiles
    ]
    return counts.join(distinct, group, "left").join(ranked.groupBy(group).agg(*at), group, "left")


def _ledger(spark: SparkSession, store: str) -> DataFrame:
    """``(part, file)``: which files each finished part of the stored profile covers."""
    path = f"{store}/files"
    return spark.read.schema("part string, file string").parquet(path) if path_exists(spark, path) else spark.createDataFrame([], "part string, file string")


def update_profile(spark: SparkSession, path: str | list[str], store: str) -> int:
    """Add the JSON-lines files under ``path`` that the stored profile does not cover yet; returns how many were read.

    The sketch is written first and the files it covers are then noted in one commit: a part without its note, left by a
    run that was lost, counts nothing, and its files are read by the next run. One run at a time. Files must not change.
    """
    found = spark.createDataFrame([(name,) for name in spark.read.text(path).inputFiles()], "file string")
    new = [row.file for row in found.join(_ledger(spark, store), "file", "left_anti").collect()]
    if not new:
        return 0
    part = uuid.uuid4().hex
    docs = parse_documents(spark.read.text(new)).docs
    sketch_profile(docs).write.parquet(f"{store}/sketches/run={part}")
    note = spark.createDataFrame([(part, name) for name in new], "part string, file string")
    note.coalesce(1).write.mode("append").parquet(f"{store}/files")
    return len(new)


def stored_profile(spark: SparkSession, store: str) -> DataFrame:
    """Sketch rows of all files that the store covers; read them with :func:`read_profile`."""
    parts = [row.part for row in _ledger(spark, store).select("part").distinct().collect()]
    if not parts:
        return spark.createDataFrame([], SKETCH)
    return _merged(spark.read.schema(SKETCH).parquet(*[f"{store}/sketches/run={part}" for part in parts]))

"""Comparing two tables, and copying rows for load tests."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tablebridge.functions.paths import quote

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def family(kind: T.DataType) -> str:
    """What a type is compared as: whole numbers of any width are one family, as are floating ones and decimals."""
    if isinstance(kind, _WHOLE):
        return "whole"
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return "floating"
    if isinstance(kind, T.DecimalType):
        return "decimal"
    if isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        return "text"
    if isinstance(kind, T.ArrayType):
        return f"array<{family(kind.elementType)}>"
    if isinstance(kind, T.MapType):
        return f"map<{family(kind.keyType)},{family(kind.valueType)}>"
    if isinstance(kind, T.StructType):
        return f"struct<{','.join(f'{f.name}:{family(f.dataType)}' for f in kind.fields)}>"
    return kind.simpleString()


def _flagged(c: Column, kind: T.DataType) -> Column:
    """A nested value beside whether it is NULL, since a hash passes over NULLs."""
    return F.struct(c.isNull().alias("none"), canonical(c, kind).alias("value"))


def canonical(c: Column, kind: T.DataType) -> Column:
    """A value that Spark's hashes tell from every unequal one of its family, and from no equal one.

    Nested values carry their sizes and a flag for every NULL; the entries of a map are sorted. Numbers take the widest
    type of their family. Variants are compared as JSON text, which has no types narrower than JSON's.
    """
    if isinstance(kind, _WHOLE):
        return c.cast("bigint")
    if isinstance(kind, T.FloatType):
        return c.cast("double")
    if isinstance(kind, T.DecimalType):
        text = c.cast("string")
        return F.regexp_replace(text, r"\.?0+$", "") if kind.scale > 0 else text
    if isinstance(kind, T.VariantType):
        return F.to_json(c)
    if isinstance(kind, T.ArrayType):
        return F.struct(F.size(c).alias("n"), F.transform(c, lambda x: _flagged(x, kind.elementType)).alias("items"))
    if isinstance(kind, T.MapType):
        # A variant cannot be sorted, but its text can.
        def entry(e: Column) -> Column:
            return F.struct(canonical(e["key"], kind.keyType).alias("key"), _flagged(e["value"], kind.valueType).alias("value"))

        return F.struct(F.size(c).alias("n"), F.sort_array(F.transform(F.map_entries(c), entry)).alias("entries"))
    if isinstance(kind, T.StructType):
        return F.struct(*[_flagged(c.getField(f.name), f.dataType).alias(f"f{i}") for i, f in enumerate(kind.fields)])
    return c


def row_values(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """The columns as values to hash: one number of bits that say which are NULL for every 60 of them, then their values."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    flags = []
    for at in range(0, len(columns), 60):
        bits = [F.when(F.col(quote(c)).isNull(), F.lit(1 << i).cast("bigint")).otherwise(0) for i, c in enumerate(columns[at : at + 60])]
        flags.append(reduce(lambda x, y: x + y, bits))
    return [*flags, *[canonical(F.col(quote(c)), fields[c]) for c in columns]]


def row_hashes(df: DataFrame, columns: Sequence[str], marks: Sequence[str] = ()) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row from different seeds; NULLs count wherever they stand. ``marks`` are hashed along."""
    parts = [*map(F.lit, marks), *row_values(df, columns)] or [F.lit(0)]
    return F.xxhash64(*parts), F.xxhash64(F.lit(7), *parts)


def _hex(*hashes: Column) -> Column:
    return F.concat(*[F.lpad(F.hex(h), 16, "0") for h in hashes])


def row_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """Both hashes of a row as one text of 32 digits."""
    return _hex(*row_hashes(df, columns))


def _marks(df: DataFrame, other: DataFrame, columns: Sequence[str]) -> list[str]:
    """The families of columns whose families differ: such columns are never equal, whatever their values."""
    mine, theirs = ({f.name: family(f.dataType) for f in x.schema.fields} for x in (df, other))
    return [f"{c}:{mine[c]}" for c in columns if mine[c] != theirs[c]]


def unmatched_columns(a: DataFrame, b: DataFrame) -> tuple[list[str], list[str]]:
    """Columns that only ``a`` has and columns that only ``b`` has."""
    return [c for c in a.columns if c not in b.columns], [c for c in b.columns if c not in a.columns]


def _counted(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    columns = [name for name in a.columns if name in b.columns]

    def side(df: DataFrame, other: DataFrame, in_a: int) -> DataFrame:
        first, second = row_hashes(df, columns, _marks(df, other, columns))
        return df.select(
            *[quote(k) for k in keys],
            first.alias("_hash"),
            second.alias("_other_hash"),
            F.lit(in_a).cast("bigint").alias("in_a"),
            F.lit(1 - in_a).cast("bigint").alias("in_b"),
        )

    return (
        side(a, b, 1)
        .unionAll(side(b, a, 0))
        .groupBy(*[quote(k) for k in keys], "_hash", "_other_hash")
        .agg(F.sum("in_a").alias("n_a"), F.sum("in_b").alias("n_b"))
    )


def differences(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys..., row_hash, n_a, n_b)`` for rows that the two tables do not hold equally often.

    One shuffle of keys and hashes. Equal rows are counted before it, so a row
    copied many times costs one record per task.
    """
    found = _counted(a, b, keys).where(F.col("n_a") != F.col("n_b"))
    return found.select(*[quote(k) for k in keys], _hex(F.col("_hash"), F.col("_other_hash")).alias("row_hash"), "n_a", "n_b")


def reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: ``n_a, n_b, missing`` (rows of a that b lacks), ``extra`` (rows of b that a lacks), ``matches``.

    Rows are compared on the columns that both have: numbers by value within a family (see :func:`family`), nested values
    with their NULLs, maps whatever their order; a column whose types are of two families differs. ``missing_columns`` and ``extra_columns`` name the others, and where
    there are any the tables do not match.
    """
    only_a, only_b = unmatched_columns(a, b)

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0).cast("bigint"))

    n_a, n_b = F.col("n_a"), F.col("n_b")
    none = F.lit(0).cast("bigint")
    return (
        _counted(a, b, keys)
        .agg(
            total(n_a).alias("n_a"),
            total(n_b).alias("n_b"),
            total(F.greatest(n_a - n_b, none)).alias("missing"),
            total(F.greatest(n_b - n_a, none)).alias("extra"),
        )
        .withColumns(
            {
                "missing_columns": F.lit(",".join(only_a)),
                "extra_columns": F.lit(",".join(only_b)),
                "matches": (F.col("missing") == 0) & (F.col("extra") == 0) & F.lit(not only_a and not only_b),
            }
        )
    )


BLOCK = 4096


def replicate(df: DataFrame, n: int, copy: str = "copy") -> DataFrame:
    """Every row ``n`` times, numbered 0 to n-1 in ``copy``.

    Copies are made in blocks, so no row holds them all at once; where there are several blocks, they are spread by row
    and block, so that neither one row nor one block number becomes one endless task.
    """
    if n < 0:
        raise ValueError("n must not be negative")
    if n == 0:
        return df.withColumn(copy, F.lit(0).cast("bigint")).where(F.lit(False))
    last = (n - 1) // BLOCK
    start = F.col("_block") * BLOCK
    blocks = df.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(last).cast("bigint"))))
    if last:
        # A given number of partitions: a block is a short row before it is copied, and short rows would be merged.
        many = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        blocks = blocks.withColumn("_row", row_hash(df, df.columns)).repartition(many, "_row", "_block").drop("_row")
    copies = F.sequence(start, F.least(start + BLOCK, F.lit(n)) - 1)
    return blocks.withColumn(copy, F.explode(copies)).drop("_block")

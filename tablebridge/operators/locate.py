"""Where two tables differ: hashes summed by key range, then the columns of single keys.

Both tables are cut into the same ranges of their first key, and each range is a few sums over the hashes of its rows,
combined in the tasks that read them. Only ranges whose sums differ are cut again, and only they are read again: the ranges
are plain predicates on the key, so Parquet footers and databases skip the rest. When ranges are short, their rows are
compared key by key and column by column, by sums too, so a key that a table repeats without end is still one row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F

from tablebridge.functions.paths import quote
from tablebridge.operators.reconcile import _marks, canonical, row_hashes

FANOUT = 64  # ranges that one range is cut into
SHORT = 10_000  # rows of a range that is compared key by key
MOST_RANGES = 1024  # where more ranges differ, cutting them on would save nothing


@dataclass(frozen=True)
class Range:
    """Keys from ``low`` up to, but without, ``high``; None leaves a side open. ``nulls`` stands for the NULL keys alone."""

    low: object = None
    high: object = None
    nulls: bool = False

    def holds(self, key: Column) -> Column:
        if self.nulls:
            return key.isNull()
        sides = [key >= F.lit(self.low)] if self.low is not None else []
        sides += [key < F.lit(self.high)] if self.high is not None else []
        return reduce(and_, sides, key.isNotNull())


def _within(df: DataFrame, key: str, ranges: Sequence[Range] | None) -> DataFrame:
    if ranges is None:
        return df
    return df.where(reduce(or_, [r.holds(F.col(quote(key))) for r in ranges], F.lit(False)))


def _sums(df: DataFrame, other: DataFrame, key: str, columns: Sequence[str], ranges: Sequence[Range]) -> DataFrame:
    """(range, n, sums): a multiset of rows as numbers that differ if the rows do, however they are ordered."""
    number = F.coalesce(*[F.when(r.holds(F.col(quote(key))), i) for i, r in enumerate(ranges)])
    first, second = row_hashes(df, columns, _marks(df, other, columns))
    rows = _within(df, key, ranges).select(number.alias("range"), first.alias("x"), second.alias("y"))
    half = (1 << 32) - 1
    return rows.groupBy("range").agg(
        F.count("*").alias("n"),
        F.sum(F.shiftrightunsigned("x", 32)).alias("high"),
        F.sum(F.col("x").bitwiseAND(half)).alias("low"),
        F.bit_xor("y").alias("mixed"),
    )


def _cut(df: DataFrame, key: str, whole: Range, fanout: int) -> list[Range]:
    """Parts of a range that hold about as many rows each; itself, if its keys cannot be told apart."""
    places = [i / fanout for i in range(1, fanout)]
    kind = df.schema[key].dataType.typeName()
    column = F.col(quote(key))
    inside = _within(df, key, [whole])
    if kind in ("string", "binary"):
        # Quantiles of text: a bounded sample, sorted here; the ranges stay whole whatever it holds.
        sample = sorted({r[0] for r in inside.select(column).orderBy(F.xxhash64(column)).limit(64 * fanout).collect()})
        found = [sample[int(len(sample) * p)] for p in places] if sample else []
    else:
        found = inside.agg(F.percentile_approx(column, places, 10_000)).first()[0] or []
    edges = sorted({x for x in found if x is not None and (whole.low is None or x > whole.low)})
    return [Range(low, high) for low, high in zip([whole.low, *edges], [*edges, whole.high])]


def differing_ranges(
    a: DataFrame, b: DataFrame, keys: Sequence[str], fanout: int = FANOUT, short: int = SHORT, most: int = MOST_RANGES
) -> list[Range]:
    """Ranges of the first key that hold all differences, cut until they are short or nothing is gained.

    The driver holds the sums of at most ``fanout`` parts of ``most`` ranges.
    """
    key = keys[0]
    columns = [c for c in a.columns if c in b.columns]
    ranges = [Range(nulls=True), *_cut(a, key, Range(), fanout)]
    done: list[Range] = []
    while ranges:
        sides = [{r.range: tuple(r)[1:] for r in _sums(x, y, key, columns, ranges).collect()} for x, y in ((a, b), (b, a))]
        left: list[Range] = []
        for i, r in enumerate(ranges):
            mine, theirs = (side.get(i, (0,)) for side in sides)
            if mine != theirs:
                (done if r.nulls or max(mine[0], theirs[0]) <= short else left).append(r)
        if len(done) + len(left) > most:
            return done + left
        ranges = []
        for r in left:
            # By the fuller table, so that a range which one of them lacks is cut, too.
            parts = max((_cut(x, key, r, fanout) for x in (a, b)), key=len)
            (ranges if len(parts) > 1 else done).extend(parts)
    return done


def locate_differences(
    a: DataFrame, b: DataFrame, keys: Sequence[str], fanout: int = FANOUT, short: int = SHORT, most: int = MOST_RANGES
) -> DataFrame:
    """``(keys..., n_a, n_b, columns)`` for each key whose rows differ; ``columns`` names what differs where both have the key.

    Rows of one key are compared as a multiset, column by column; if every column agrees but their combination does not,
    all columns are named. Keys must be comparable and sortable values; NULL is a key like any other. Columns that one
    table lacks are not compared (see :func:`reconcile`).
    """
    columns = [c for c in a.columns if c in b.columns]
    others = [c for c in columns if c not in keys]
    ranges = differing_ranges(a, b, keys, fanout, short, most)

    def side(df: DataFrame, other: DataFrame, name: str) -> DataFrame:
        fields = {f.name: f.dataType for f in df.schema.fields}
        marks = {m.rsplit(":", 1)[0]: m for m in _marks(df, other, others)}

        def total(c: str) -> Column:
            value = F.col(quote(c))
            parts = [value.isNull(), canonical(value, fields[c]), *([F.lit(marks[c])] if c in marks else [])]
            return F.sum(F.xxhash64(*parts).cast("decimal(38,0)"))

        whole = F.sum(row_hashes(df, columns, _marks(df, other, columns))[0].cast("decimal(38,0)"))
        return (
            _within(df, keys[0], ranges)
            .groupBy(*[F.col(quote(k)).alias(f"{name}_key{i}") for i, k in enumerate(keys)])
            .agg(F.count("*").alias(f"n_{name}"), whole.alias(f"{name}_row"), *[total(c).alias(f"{name}_{i}") for i, c in enumerate(others)])
        )

    left, right = side(a, b, "a"), side(b, a, "b")
    same = reduce(and_, [F.col(f"a_key{i}").eqNullSafe(F.col(f"b_key{i}")) for i in range(len(keys))])
    changed = F.array_compact(F.array(*[F.when(~F.col(f"a_{i}").eqNullSafe(F.col(f"b_{i}")), c) for i, c in enumerate(others)]))
    both = F.col("n_a").isNotNull() & F.col("n_b").isNotNull()
    named = F.when(both, F.when(F.size(changed) > 0, changed).otherwise(F.array(*map(F.lit, others)))).otherwise(F.array().cast("array<string>"))
    none = F.lit(0).cast("bigint")
    found = left.join(right, same, "full").where(~F.col("a_row").eqNullSafe(F.col("b_row")) | ~F.col("n_a").eqNullSafe(F.col("n_b")))
    # A key of one side is NULL on the other, so the side that counted decides.
    key = [F.when(F.col("n_a").isNotNull(), F.col(f"a_key{i}")).otherwise(F.col(f"b_key{i}")).alias(k) for i, k in enumerate(keys)]
    return found.select(*key, F.coalesce("n_a", none).alias("n_a"), F.coalesce("n_b", none).alias("n_b"), named.alias("columns"))

"""What a document collection holds: keys, type tags, shapes, batches."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator, Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tablebridge.functions.paths import entries, field, get, literal, quote
from tablebridge.functions.tags import DECLARED_ONLY, NONE, OBJECTS, kind, tag_as, tag_of
from tablebridge.spec import ELEMENT, Spec, declared_tag, parse_spec

DOC = "doc"
MAX_KEYS = None  # no bound unless the caller sets one

# Path of keys -> the tags seen there.
Known = Mapping[tuple[str, ...], frozenset[str]]


class TooManyKeys(ValueError):
    """The documents use data as keys: turning keys into columns would not end well."""


def fields(docs: DataFrame, doc: str) -> DataFrame:
    """One ``(key, value, kind)`` row per top-level field."""
    spark = docs.sparkSession
    return (
        docs.select(F.col(doc).alias("v"))
        .lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
        .selectExpr("key", "value", f"{kind('value')} AS kind")
    )


def profile(docs: DataFrame, doc: str = DOC) -> DataFrame:
    """``(key, tag, n)`` for every key and type tag, JSON null counted as tag ``None``.

    Counts are combined before the shuffle, so a key found in every document
    costs one row per task.
    """
    return (
        fields(docs, doc)
        .selectExpr("key", f"{tag_of('value', 'kind')} AS tag")
        .groupBy("key", "tag")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _path(keys: Iterable[str]) -> str:
    return f"cast(array({', '.join(map(literal, keys))}) AS array<string>)"


def _levels(at: DataFrame, prefix: tuple[str, ...], spec: Spec) -> Iterator[tuple[tuple[str, ...], DataFrame]]:
    """The documents themselves (``_at``), then the objects in them that have a ``sub_schema``, with their path.

    An array with a ``sub_schema`` stands for its elements, each a row.
    """
    yield prefix, at
    for name, column in spec.items():
        if column.sub_schema and column.dtype == "VecDyn":
            elements = get(field("_at", name), "$", "array<variant>")
            yield from _levels(at.selectExpr(f"explode({elements}) AS _at"), prefix + (name, ELEMENT), column.sub_schema)
        elif column.sub_schema:
            yield from _levels(at.selectExpr(f"{field('_at', name)} AS _at"), prefix + (name,), column.sub_schema)


def _declared(spec: Spec, dtype: str, prefix: tuple[str, ...] = ()) -> Iterator[tuple[str, ...]]:
    for name, column in spec.items():
        inner = prefix + ((name, ELEMENT) if column.dtype == "VecDyn" else (name,))
        if declared_tag(column) == dtype:
            yield prefix + (name,)
        yield from _declared(column.sub_schema, dtype, inner)


def _tag_by_path(spec: Spec) -> str:
    branches = ""
    for dtype in (*DECLARED_ONLY, OBJECTS):
        paths = ", ".join(_path(keys) for keys in _declared(spec, dtype))
        if paths:
            branches += f" WHEN path IN ({paths}) THEN {tag_as('value', 'kind', dtype)}"
    found = tag_of("value", "kind")
    return f"CASE {branches} ELSE {found} END" if branches else found


def _bounded(found: DataFrame, max_keys: int | None) -> list:
    """The rows, or an error (never a cut) if there are more than ``max_keys``."""
    rows = (found if max_keys is None else found.limit(max_keys + 1)).collect()
    if max_keys is not None and len(rows) > max_keys:
        raise TooManyKeys(f"more than {max_keys} distinct keys; raise max_keys, or keep undeclared keys in one column")
    return rows


def discover(
    docs: DataFrame,
    spec: object = None,
    doc: str = DOC,
    max_keys: int | None = MAX_KEYS,
    declared_only: bool = False,
) -> Known:
    """Run one job that finds the keys and the tags under each, following ``sub_schema`` into objects and arrays of them.

    One row per key wanted as a column reaches the driver: all keys, or with
    ``declared_only`` those of the spec, however many others there are.
    """
    spec = parse_spec(spec)
    parts = []
    for prefix, at in _levels(docs.selectExpr(f"{quote(doc)} AS _at"), (), spec):
        parts.append(fields(at, "_at").selectExpr(f"concat({_path(prefix)}, array(key)) AS path", "value", "kind"))
        if prefix and prefix[-1] == ELEMENT:
            parts.append(at.selectExpr(f"{_path(prefix)} AS path", "_at AS value", f"{kind('_at')} AS kind"))
    values = reduce(DataFrame.unionAll, parts)
    if declared_only:
        values = values.where(F.col("path")[0].isin(list(spec)))
    counted = (
        values.where("value IS NOT NULL")
        .selectExpr("path", f"{_tag_by_path(spec)} AS tag")
        .groupBy("path")
        .agg(F.collect_set("tag").alias("tags"))
    )
    return {tuple(row.path): frozenset(row.tags) for row in _bounded(counted, max_keys)}


def discover_keys(docs: DataFrame, doc: str = DOC, max_keys: int | None = MAX_KEYS) -> list[str]:
    """Distinct top-level keys in alphabetical order. One job, bounded like :func:`discover`."""
    keys = docs.selectExpr(f"explode(map_keys({entries(quote(doc))})) AS key").distinct()
    return sorted(row.key for row in _bounded(keys, max_keys))


def merge_known(*parts: Known) -> Known:
    """Union of what several collections hold."""
    merged: dict[tuple[str, ...], set[str]] = defaultdict(set)
    for part in parts:
        for path, tags in part.items():
            merged[path] |= tags
    return {path: frozenset(tags) for path, tags in merged.items()}


def schema_report(docs: DataFrame, spec: object, doc: str = DOC) -> DataFrame:
    """One row per key: expected type and strategy, the tags seen, and how many values mismatch.

    Columns outside the spec are expected ``Unknown`` with strategy ``Ignore``.
    The spec is a literal, looked up per group after counting.
    """
    spec = parse_spec(spec)

    def declared(attribute: str, default: str) -> str:
        pairs = ", ".join(f"{literal(name)}, {literal(getattr(column, attribute))}" for name, column in spec.items())
        return f"coalesce(map({pairs})[key], '{default}')" if pairs else f"'{default}'"

    special = " ".join(
        f"WHEN key = {literal(name)} THEN {tag_as('value', 'kind', column.dtype)}"
        for name, column in spec.items()
        if column.dtype in DECLARED_ONLY
    )
    found = tag_of("value", "kind")
    return (
        fields(docs, doc)
        .selectExpr(
            "key",
            f"{found} AS tag",
            f"CASE {special} ELSE {found} END AS own" if special else f"{found} AS own",
        )
        .groupBy("key", "tag", "own")
        .agg(F.count(F.lit(1)).alias("n"))
        .selectExpr(
            "*", f"{declared('dtype', 'Unknown')} AS expected_dtype", f"{declared('strategy', 'Ignore')} AS strategy"
        )
        .groupBy("key", "expected_dtype", "strategy")
        .agg(
            F.expr(f"array_join(sort_array(collect_set(tag) FILTER (WHERE tag <> '{NONE}')), ',') AS dtypes"),
            F.expr(f"coalesce(sum(n) FILTER (WHERE tag <> '{NONE}'), 0) AS n_values"),
            F.expr(
                f"coalesce(sum(n) FILTER (WHERE tag <> '{NONE}' AND expected_dtype <> 'Unknown' AND own <> expected_dtype), 0) "
                "AS n_mismatch"
            ),
        )
    )


def with_spec(df: DataFrame, spec: object) -> DataFrame:
    """Attach expected type and strategy to the columns that exist, as field metadata."""
    for name, column in parse_spec(spec).items():
        if name in df.columns:
            df = df.withMetadata(name, {"expected_dtype": column.dtype, "dtype_collision_strategy": column.strategy})
    return df


def shape_keys(v: str) -> str:
    """The sorted keys of a document. Variant objects store their fields sorted, so no sort is needed."""
    return f"map_keys({entries(v)})"


def shape_groups(docs: DataFrame, doc: str = DOC) -> DataFrame:
    """``(shape, n_keys, n)``: how many documents have each set of keys; ``shape`` is their JSON text."""
    return (
        docs.groupBy(F.expr(shape_keys(quote(doc))).alias("keys"))
        .agg(F.count(F.lit(1)).alias("n"))
        .selectExpr("to_json(keys) AS shape", "size(keys) AS n_keys", "n")
    )


def batch_plan(docs: DataFrame, size: int, doc: str = DOC, full: bool = False) -> DataFrame:
    """``(shape, n, n_batches)``: the batches that a bulk sink sends, each of one shape and at most ``size`` rows.

    Batches are cut where the rows lie, so every task that holds a shape sends a last one that may be short; with ``full``
    they are cut over the whole collection.
    """
    if size < 1:
        raise ValueError("size must be at least 1")
    if full:
        batches = F.expr(f"cast(ceil(n / {size}) AS bigint)").alias("n_batches")
        return shape_groups(docs, doc).select("shape", "n", batches)
    return (
        docs.selectExpr(f"to_json({shape_keys(quote(doc))}) AS shape", "spark_partition_id() AS task")
        .groupBy("shape", "task")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("shape")
        .agg(F.sum("n").alias("n"), F.expr(f"sum(cast(ceil(n / {size}) AS bigint))").alias("n_batches"))
    )

"""Lining up ragged documents into columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from tablebridge.functions.cells import HTTP, NESTED, TYPED, elements, normalise_columns, typed
from tablebridge.functions.paths import entries, field, let, literal, quote
from tablebridge.functions.tags import kind, tag_of
from tablebridge.operators.discover import DOC, MAX_KEYS, discover_keys
from tablebridge.spec import spark_type, suffix

# The normalisers by the path that uses them.
MODES = {"typed": TYPED, "http": HTTP, "nested": NESTED}


def check_names(df: DataFrame, names: Iterable[str]) -> None:
    """Refuse column names that the session cannot tell apart."""
    sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive", "false") == "true"
    seen: dict[str, str] = {}
    for name in names:
        folded = name if sensitive else name.lower()
        if folded in seen:
            hint = "" if sensitive or seen[folded] == name else "; set spark.sql.caseSensitive=true"
            raise ValueError(f"columns {seen[folded]!r} and {name!r} clash{hint}")
        seen[folded] = name


def carried_columns(docs: DataFrame, doc: str) -> list[str]:
    return [name for name in docs.columns if name != doc]


def others_text(v: str, keys: Iterable[str]) -> str:
    """The fields of ``v`` beside ``keys`` as JSON text, without JSON nulls; NULL where there are none."""
    listed = f"cast(array({', '.join(map(literal, sorted(keys)))}) AS array<string>)"
    others = f"map_filter({entries(v)}, (k, x) -> NOT array_contains({listed}, k) AND NOT is_variant_null(x))"
    return let("o", others, "CASE WHEN size(o) > 0 THEN to_json(o) END")


def align(
    docs: DataFrame,
    keys: Iterable[str] | None = None,
    doc: str = DOC,
    max_keys: int | None = MAX_KEYS,
    rest: str | None = None,
) -> DataFrame:
    """One VARIANT column per key; a missing key and JSON null both give NULL.

    Columns besides ``doc`` are carried in front. Without ``keys`` one job finds
    them, and they come in alphabetical order. With ``rest`` the keys that are not in ``keys`` stay together in the column of
    that name, as JSON text, and no job looks for any.
    """
    if keys is None and rest is not None:
        raise ValueError("rest takes what is not in keys; name the keys that get columns")
    keys = discover_keys(docs, doc, max_keys) if keys is None else list(keys)
    carried = carried_columns(docs, doc)
    check_names(docs, [*carried, *keys, *([rest] if rest is not None else [])])

    def cell(key: str) -> str:
        v = field(quote(doc), key)
        return f"CASE WHEN NOT is_variant_null({v}) THEN {v} END AS {quote(key)}"

    left = [f"{others_text(quote(doc), keys)} AS {quote(rest)}"] if rest is not None else []
    return docs.selectExpr(*[quote(c) for c in carried], *[cell(key) for key in keys], *left)


def normalise(
    docs: DataFrame,
    mode: str,
    keys: Iterable[str] | None = None,
    doc: str = DOC,
    max_keys: int | None = MAX_KEYS,
    rest: str | None = None,
) -> DataFrame:
    """One ``struct<tag, value>`` column per key, normalised for a ``typed``, ``http`` or ``nested`` consumer.

    With ``rest`` undeclared keys stay together as in :func:`align`.
    """
    steps = MODES[mode]
    aligned = align(docs, keys, doc, max_keys, rest)
    cells = aligned.columns[len(carried_columns(docs, doc)) :]
    return normalise_columns(aligned, cells[:-1] if rest is not None else cells, steps)


def split_mixed(df: DataFrame, column: str, tags: Iterable[str], depth: int = 0) -> DataFrame:
    """Split a VARIANT array column into one array column ``<column>_<suffix>`` per element tag.

    ``depth`` levels of arrays inside the array are opened first, so that their
    elements are split too. A column is NULL where no element has its tag.
    """
    found = elements(quote(column))
    for _ in range(depth):
        opened = f"CASE WHEN startswith({kind('e')}, 'ARRAY') THEN {elements('e')} ELSE array(e) END"
        found = f"flatten(transform({found}, e -> {opened}))"
    with_kind = f"transform({found}, e -> named_struct('v', e, 'kind', {kind('e')}))"
    tagged = f"transform({with_kind}, e -> named_struct('v', e.v, 'tag', {tag_of('e.v', 'e.kind')}))"

    def part(dtype: str) -> str:
        kept = f"transform(filter(_tagged, e -> e.tag = '{dtype}'), e -> {typed('e.v', dtype)})"
        values = f"cast({kept} AS array<{spark_type(dtype)}>)"
        return f"CASE WHEN exists(_tagged, e -> e.tag = '{dtype}') THEN {values} END AS {quote(f'{column}_{suffix(dtype)}')}"

    parts = [part(dtype) for dtype in tags]
    return df.selectExpr("*", f"{tagged} AS _tagged").selectExpr("*", *parts).drop("_tagged")

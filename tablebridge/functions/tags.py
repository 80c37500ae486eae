"""Type tags of variant values, as SQL text.

A tag is one of the type names in :data:`tablebridge.spec.DTYPES`, or
``None`` for a missing value or JSON null. Extended-JSON wrappers such as
``{"$oid": "..."}`` count as the scalar they stand for.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tablebridge.functions.paths import get, literal, quote

NONE = "None"

# Schema text of each Extended-JSON wrapper, by the tag of the scalar in it.
WRAPPERS = {
    "String": ("OBJECT<`$oid`: STRING>",),
    "I32": ("OBJECT<`$numberInt`: STRING>",),
    "I64": (
        "OBJECT<`$numberLong`: STRING>",
        "OBJECT<`$date`: STRING>",
        "OBJECT<`$date`: BIGINT>",
        "OBJECT<`$date`: OBJECT<`$numberLong`: STRING>>",
    ),
    "Double64": ("OBJECT<`$numberDouble`: STRING>", "OBJECT<`$numberDecimal`: STRING>"),
}

# The bounds of the narrow integer types.
I16_RANGE = "-32768 AND 32767"
I32_RANGE = "-2147483648 AND 2147483647"
LARGEST_FLOAT = "3.4028235e38D"

# Types that a value gets only where they are declared.
DECLARED_ONLY = ("I64", "I16", "Double32", "VecString", "VecI32", "VecI64", "VecF32", "VecF64")

# What an array whose objects have a schema of their own is declared as: any array is one, an empty one too.
OBJECTS = "VecDyn of objects"

# Wrappers of values that have no type of their own and go out as text.
TEXT_WRAPPERS = r"^OBJECT<`\$(binary|code|dbPointer|maxKey|minKey|regularExpression|symbol|timestamp|undefined|uuid)`:"


def kind(v: str) -> str:
    """Schema text of a variant, NULL for a missing one. Tags are read off it."""
    return f"schema_of_variant({v})"


def one_of(value: str, *texts: str) -> str:
    return f"{value} IN ({', '.join(map(literal, texts))})"


def is_date_wrapper(k: str) -> str:
    return one_of(k, *[wrapper for wrapper in WRAPPERS["I64"] if "$date" in wrapper])


def tag_of(v: str, k: str) -> str:
    """Type tag of a variant whose kind is ``k``."""
    wrappers = " ".join(f"WHEN {one_of(k, *kinds)} THEN '{name}'" for name, kinds in WRAPPERS.items())
    return f"""CASE
        WHEN {k} IS NULL OR {k} = 'VOID' THEN '{NONE}'
        WHEN {k} = 'STRING' THEN 'String'
        WHEN {k} = 'BIGINT' THEN CASE WHEN {get(v, '$', 'bigint')} BETWEEN {I32_RANGE} THEN 'I32' ELSE 'I64' END
        WHEN {k} = 'BOOLEAN' THEN 'Bool'
        WHEN {k} IN ('DOUBLE', 'FLOAT') OR startswith({k}, 'DECIMAL') THEN 'Double64'
        WHEN startswith({k}, 'ARRAY') THEN
            CASE WHEN {k} = 'ARRAY<VOID>' AND {get(v, '$[0]', 'variant')} IS NULL THEN 'VecString' ELSE 'VecDyn' END
        WHEN startswith({k}, 'OBJECT<`$') THEN
            CASE WHEN {k} RLIKE {literal(TEXT_WRAPPERS)} THEN 'String' {wrappers} ELSE 'Object' END
        WHEN startswith({k}, 'OBJECT') THEN 'Object'
        ELSE 'String' END"""


def double_of(v: str) -> str:
    """A number with a fraction, plain or in a wrapper."""
    paths = ("$", '$["$numberDouble"]', '$["$numberDecimal"]')
    return f"coalesce({', '.join(get(v, path, 'double') for path in paths)})"


def _within(v: str, dtype: str, low: str, high: str) -> str:
    """Whether the smallest and the largest element lie in a range; an array of nulls does."""
    values = get(v, "$", f"array<{dtype}>")
    return f"coalesce(array_min({values}) >= {low}, true) AND coalesce(array_max({values}) <= {high}, true)"


_WHOLE = "{k} = 'ARRAY<BIGINT>'"
_NUMBERS = "{k} RLIKE '^ARRAY<(BIGINT|DECIMAL[^>]*|DOUBLE|FLOAT)>$'"
_ELEMENTS_FIT = {
    "VecString": lambda v, k: f"{k} = 'ARRAY<STRING>'",
    "VecI32": lambda v, k: f"{_WHOLE.format(k=k)} AND {_within(v, 'bigint', *I32_RANGE.split(' AND '))}",
    "VecI64": lambda v, k: _WHOLE.format(k=k),
    "VecF32": lambda v, k: f"{_NUMBERS.format(k=k)} AND {_within(v, 'double', '-' + LARGEST_FLOAT, LARGEST_FLOAT)}",
    "VecF64": lambda v, k: _NUMBERS.format(k=k),
}


def tag_as(v: str, k: str, expected: str | None) -> str:
    """Tag of ``v``, of kind ``k``, in a column declared as ``expected``.

    A plain JSON integer carries no width, so one that fits the declared
    integer type has that type. Explicit ``$numberInt`` / ``$numberLong``
    wrappers keep the width they state. An array has the declared array type
    if all its elements fit, and an empty one fits any; a number with a
    fraction is a ``Double32`` if it lies in that type's range.
    """
    if expected == "Double32":
        fits = f"({tag_of(v, k)}) = 'Double64' AND abs({double_of(v)}) <= {LARGEST_FLOAT}"
        return f"CASE WHEN {fits} THEN 'Double32' ELSE {tag_of(v, k)} END"
    if expected in _ELEMENTS_FIT:
        empty = f"{k} = 'ARRAY<VOID>' AND {get(v, '$[0]', 'variant')} IS NULL"
        return f"CASE WHEN {empty} OR ({_ELEMENTS_FIT[expected](v, k)}) THEN '{expected}' ELSE {tag_of(v, k)} END"
    if expected == OBJECTS:
        return f"CASE WHEN startswith({k}, 'ARRAY') THEN 'VecDyn' ELSE {tag_of(v, k)} END"
    if expected == "I64":
        return f"CASE WHEN {k} = 'BIGINT' THEN 'I64' ELSE {tag_of(v, k)} END"
    if expected == "I16":
        fits = f"{k} = 'BIGINT' AND {get(v, '$', 'bigint')} BETWEEN {I16_RANGE}"
        return f"CASE WHEN {fits} THEN 'I16' ELSE {tag_of(v, k)} END"
    return tag_of(v, k)


def with_tags(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add the tag of each variant column under the given name.

    A tag reads the kind many times and Spark does not share it between the
    branches of a CASE, so the kinds are columns of a projection of their own.
    """
    kinds = {column: f"_kind{i}" for i, column in enumerate(columns)}
    staged = df.selectExpr("*", *[f"{kind(quote(column))} AS {name}" for column, name in kinds.items()])
    tags = [f"{tag_of(quote(column), kinds[column])} AS {quote(name)}" for column, name in columns.items()]
    return staged.selectExpr(*[quote(c) for c in df.columns], *tags)

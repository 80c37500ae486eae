"""Reader for the JSON schema spec.

A spec names, per column, the expected type and what to do with a value of
another type::

    {"name":   {"dtype": "String", "dtype_collision_strategy": "NewCol",
                "sub_schema": {"k": {"dtype": "I32", "dtype_collision_strategy": "Cast"}}},
     "ref": {"dtype": "I32", "dtype_collision_strategy": "NewCol"}}

The ``sub_schema`` of a ``VecDyn`` column is that of the objects in the array. Type and strategy names are read case-insensitively, with or without
underscores (``NewCol``, ``new_col``).
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from tablebridge.functions.tags import OBJECTS

# Type name -> (suffix of a spill column, Spark type of a typed column).
DTYPES = {
    "Bool": ("bool", "boolean"),
    "I16": ("i16", "smallint"),
    "I32": ("i32", "int"),
    "I64": ("i64", "bigint"),
    "Double32": ("f32", "float"),
    "Double64": ("f64", "double"),
    "String": ("str", "string"),
    "VecString": ("vecstring", "array<string>"),
    "VecI32": ("vec_i32", "array<int>"),
    "VecI64": ("vec_i64", "array<bigint>"),
    "VecF32": ("vec_f32", "array<float>"),
    "VecF64": ("vec_f64", "array<double>"),
    "VecDyn": ("vecdyn", "variant"),
    "Object": ("object", "variant"),
}

# The collision strategies.
STRATEGIES = ("NewCol", "Cast", "Ignore", "Remove")

_DTYPE_BY_SPELLING = {name.lower(): name for name in DTYPES}
_STRATEGY_BY_SPELLING = {name.lower(): name for name in STRATEGIES}


class SpecError(ValueError):
    """The spec text cannot be used."""


@dataclass(frozen=True)
class ColumnSpec:
    dtype: str
    strategy: str = "Ignore"
    sub_schema: Mapping[str, "ColumnSpec"] = field(default_factory=dict)


Spec = Mapping[str, ColumnSpec]

# Stands in a path for the elements of an array, as a key that no document has.
ELEMENT = "\0[]"


def declared_tag(column: ColumnSpec) -> str:
    """The type that values of a column are tagged by."""
    return OBJECTS if column.dtype == "VecDyn" and column.sub_schema else column.dtype


def suffix(dtype: str) -> str:
    return DTYPES[dtype][0]


def spark_type(dtype: str) -> str:
    return DTYPES[dtype][1]


def _lookup(table: Mapping[str, str], text: object, what: str, path: str) -> str:
    found = table.get(str(text).replace("_", "").lower())
    if found is None:
        raise SpecError(f"{path}: {text!r} is not a {what}; expected one of {sorted(set(table.values()))}")
    return found


def parse_spec(spec: str | Mapping | None, path: str = "spec") -> dict[str, ColumnSpec]:
    """Turn JSON text, a plain mapping, or an already parsed spec into ``{column: ColumnSpec}``."""
    if spec is None:
        return {}
    if isinstance(spec, str):
        try:
            spec = json.loads(spec)
        except json.JSONDecodeError as error:
            raise SpecError(f"{path}: not JSON: {error}") from error
    if not isinstance(spec, Mapping):
        raise SpecError(f"{path}: expected an object of columns")
    columns: dict[str, ColumnSpec] = {}
    for name, entry in spec.items():
        where = f"{path}.{name}"
        if isinstance(entry, ColumnSpec):
            columns[name] = entry
            continue
        if not isinstance(entry, Mapping):
            raise SpecError(f"{where}: expected an object")
        for required in ("dtype", "dtype_collision_strategy"):
            if required not in entry:
                raise SpecError(f"{where}: {required} is missing")
        columns[name] = ColumnSpec(
            dtype=_lookup(_DTYPE_BY_SPELLING, entry["dtype"], "type", where),
            strategy=_lookup(_STRATEGY_BY_SPELLING, entry["dtype_collision_strategy"], "strategy", where),
            sub_schema=parse_spec(entry.get("sub_schema"), where),
        )
    return columns

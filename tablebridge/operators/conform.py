"""Conforming ragged documents to a declared schema.

Each declared column has one expected type and a strategy for values of other
types: ``NewCol`` moves them to ``<column>_<suffix>`` in the same row, ``Cast``
converts them, ``Remove`` makes them NULL and ``Ignore`` leaves them alone.
Columns outside the spec are ignored in that sense. JSON null and a missing key
never mismatch.

The output columns depend on the data, so conforming takes two passes: one
small aggregation that finds the tags per key, then one projection without any
shuffle. Pass ``known`` to skip the first, as streams must. Whatever the
projection cannot place (a failed cast, a type or key that ``known`` lacks, a
spill name already taken in the row) is a row of the rejects frame, with its
JSON text: no value is lost.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from tablebridge.functions.cells import json_text, scalar_text, strict_int, typed
from tablebridge.functions.paths import entries, field, get, literal, quote
from tablebridge.functions.tags import NONE, WRAPPERS, kind, one_of, tag_as, tag_of
from tablebridge.operators.align import carried_columns, check_names
from tablebridge.operators.discover import DOC, MAX_KEYS, Known, discover
from tablebridge.spec import ELEMENT, ColumnSpec, Spec, declared_tag, parse_spec, spark_type, suffix

REJECTS = "_rejects"
ROW_ID = "row_id"

# Types that Extended-JSON wrappers stand for.
_WRAPPED = (*WRAPPERS, "Double32")
_REJECT_TYPE = "array<struct<column:string,expected:string,actual:string,raw_json:string>>"

Path = tuple[str, ...]


class Conformed(NamedTuple):
    rows: DataFrame
    rejects: DataFrame
    clashes: list[str]


@dataclass(frozen=True)
class _Output:
    """One output column: its value, its type, and when the row has a value for it."""

    name: str
    value: str
    kind: str
    holds: str
    source: Path
    spill: bool = False


def _reject(column: str, expected: str, actual: str, raw: str) -> str:
    return f"named_struct('column', {column}, 'expected', {literal(expected)}, 'actual', {actual}, 'raw_json', {raw})"


class _Plan:
    """The projection for one spec and one set of known keys, as SQL text over cell and tag columns.

    An array of objects has a plan of its own, over the fields of the element that a lambda stands for.
    """

    def __init__(self, spec: Spec, known: Known, stable: bool, depth: int = 0):
        whole = {path: tags for path, tags in known.items() if all(path[:i] in known for i in range(1, len(path)))}
        self.known = {path: tags for path, tags in whole.items() if ELEMENT not in path}
        self.deeper = {path: tags for path, tags in whole.items() if ELEMENT in path}
        self.spec, self.stable, self.depth = spec, stable, depth
        # Inside arrays the cells are fields of the element that a lambda stands for.
        self.scope = f"e{depth}." if depth else ""
        self.names = {path: i for i, path in enumerate(sorted(self.known))}
        self.cells = {path: f"{self.scope}_cell{i}" for path, i in self.names.items()}
        self.kinds = {path: f"{self.scope}_kind{i}" for path, i in self.names.items()}
        self.tags = {path: f"{self.scope}_tag{i}" for path, i in self.names.items()}
        self.elements: dict[Path, _Plan] = {}
        self.rejects: list[str] = []
        self.clashes: list[str] = []
        self.columns = self.build((), spec)

    def keys(self, prefix: Path, spec: Spec) -> list[str]:
        """Spec order first, then what else was found, alphabetically."""
        here = {path[-1] for path in self.known if path[:-1] == prefix}
        return [name for name in spec if name in here] + sorted(here - set(spec))

    def build(self, prefix: Path, spec: Spec) -> dict[str, str]:
        """Output columns of one object level, name to value."""
        by_name: dict[str, list[_Output]] = {}
        for key in self.keys(prefix, spec):
            for out in self.outputs(prefix + (key,), spec.get(key)):
                by_name.setdefault(out.name, []).append(out)
        return {name: self.merged(sorted(outs, key=lambda out: out.spill)) for name, outs in by_name.items()}

    def merged(self, outs: list[_Output]) -> str:
        """One column for all sources of its name: the real column first; whatever comes too late is rejected."""
        if len(outs) == 1:
            return outs[0].value
        same = len({out.kind for out in outs}) == 1
        taken = outs[0].holds
        for out in outs[1:]:
            self.clashes.append(f"{'.'.join(out.source)} -> {out.name}")
            self.reject(f"({taken}) AND {out.holds}", out.source, outs[0].kind)
            taken = f"{taken} OR {out.holds}"
        values = [out.value if same else f"CASE WHEN {out.holds} THEN {self.cells[out.source]} END" for out in outs]
        return f"coalesce({', '.join(values)})"

    def reject(self, condition: str, path: Path, expected: str) -> None:
        name = ".".join(path)
        entry = _reject(literal(f".{name}" if self.depth else name), expected, self.tags[path], f"to_json({self.cells[path]})")
        self.rejects.append(f"CASE WHEN {condition} THEN {entry} END")

    def reject_malformed(self, out: _Output, column: ColumnSpec | None) -> None:
        """A wrapper whose text is no value of its type has a tag but no value: it goes to the rejects."""
        wrapped = f"startswith({self.kinds[out.source]}, 'OBJECT<`$')"
        expected = column.dtype if column else out.kind
        self.reject(f"{wrapped} AND {out.holds} AND ({out.value}) IS NULL", out.source, expected)

    def stages(self, v: str) -> list[dict[str, str]]:
        """What is worked out step by step, each under a name of its own: cells of ``v``, their kinds, their tags, elements."""
        cells = {f"_cell{i}": field(v, *path) for path, i in self.names.items()}
        kinds = {f"_kind{i}": kind(self.cells[path]) for path, i in self.names.items()}
        tags = {f"_tag{i}": tag_as(self.cells[p], self.kinds[p], _declared(p, self.spec)) for p, i in self.names.items()}
        elements = {f"_elements{self.names[p]}": inner.conformed(self.cells[p]) for p, inner in self.elements.items()}
        return [cells, kinds, tags, elements]

    def all_rejects(self) -> str:
        """The rejects of a row, or of an element; those of elements say which one."""
        parts = [f"cast(array_compact(array({', '.join(self.rejects)})) AS {_REJECT_TYPE})"] if self.rejects else []
        for path in self.elements:
            name = ".".join(path)
            at = f"concat({literal(f'.{name}' if self.depth else name)}, '[', cast(x.i AS string), ']', r.column)"
            moved = f"transform(x.rejects, r -> named_struct('column', {at}, 'expected', r.expected, 'actual', r.actual, 'raw_json', r.raw_json))"
            found = f"flatten(transform({self.scope}_elements{self.names[path]}, x -> {moved}))"
            parts.append(f"coalesce(cast({found} AS {_REJECT_TYPE}), {_NO_REJECTS})")
        return f"concat({', '.join(parts)})" if len(parts) > 1 else parts[0] if parts else _NO_REJECTS

    def conformed(self, array: str) -> str:
        """``array<struct<i, value, rejects>>``: the objects of an array, each conformed; what is no object has no value."""
        e = self.scope[:-1]
        kept = {"i": f"{e}.i", "x": f"{e}.x", "tag": f"{e}.tag"}
        first, *others = self.stages("x")
        fields = {"i": "i", "x": "x", "tag": tag_of("x", kind("x")), **first}

        def struct(values: dict[str, str]) -> str:
            return f"named_struct({', '.join(f'{literal(name)}, {value}' for name, value in values.items())})"

        sql = f"transform({get(array, '$', 'array<variant>')}, (x, i) -> {struct(fields)})"
        known = list(first)
        for stage in others:
            if stage:
                sql = f"transform({sql}, {e} -> {struct({**kept, **{name: f'{e}.{name}' for name in known}, **stage})})"
                known += stage
        odd = _reject("''", "Object", f"{e}.tag", f"to_json({e}.x)")
        rejects = f"""CASE WHEN {e}.tag = 'Object' THEN {self.all_rejects()} WHEN {e}.tag = '{NONE}' THEN {_NO_REJECTS}
            ELSE cast(array({odd}) AS {_REJECT_TYPE}) END"""
        value = f"CASE WHEN {e}.tag = 'Object' THEN {struct({name: value for name, value in self.columns.items()})} END"
        return f"transform({sql}, {e} -> {struct({'i': f'{e}.i', 'value': value, 'rejects': rejects})})"

    def element_plan(self, path: Path, spec: Spec) -> _Plan | None:
        """The plan for the objects of an array; None while no object in it has a key."""
        if path not in self.elements:
            start = path + (ELEMENT,)
            inner = _Plan(spec, {p[len(start) :]: tags for p, tags in self.deeper.items() if p[: len(start)] == start and p != start}, self.stable, self.depth + 1)
            if not inner.columns:
                return None
            self.elements[path] = inner
            self.clashes += [f"{'.'.join(path)}[].{clash}" for clash in inner.clashes]
        return self.elements[path]

    def value(self, path: Path, dtype: str, column: ColumnSpec | None) -> str:
        """The typed value of a cell; objects with a ``sub_schema`` become structs, arrays of them arrays of structs."""
        if dtype == "VecDyn" and column and column.sub_schema and self.element_plan(path, column.sub_schema):
            return f"transform({self.scope}_elements{self.names[path]}, x -> x.value)"
        if dtype == "Object" and column and column.sub_schema:
            inner = self.build(path, column.sub_schema)
            if inner:
                return f"named_struct({', '.join(f'{literal(name)}, {value}' for name, value in inner.items())})"
        return typed(self.cells[path], dtype)

    def outputs(self, path: Path, column: ColumnSpec | None) -> list[_Output]:
        name, cell, found = path[-1], self.cells[path], self.tags[path]
        seen = sorted(self.known[path] - {NONE})

        def output(dtype: str, as_name: str = name, spill: bool = False) -> _Output:
            value = f"CASE WHEN {found} = '{dtype}' THEN {self.value(path, dtype, column)} END"
            out = _Output(as_name, value, dtype, f"{found} = '{dtype}'", path, spill)
            if dtype in _WRAPPED:
                self.reject_malformed(out, column)
            return out

        if column is None or column.strategy == "Ignore":
            if len(seen) == 1 and not self.stable:
                self.reject(f"NOT {one_of(found, NONE, seen[0])}", path, seen[0])
                return [output(seen[0])]
            holds = f"{found} <> '{NONE}'"
            return [_Output(name, f"CASE WHEN {holds} THEN {cell} END", "variant", holds, path)]

        expected = column.dtype
        if column.strategy == "Remove":
            return [output(expected)]
        if column.strategy == "Cast":
            return [self.cast(path, column)]
        spills = sorted((dtype for dtype in seen if dtype != expected), key=suffix)
        self.reject(f"NOT {one_of(found, NONE, expected, *spills)}", path, expected)
        return [output(expected)] + [output(dtype, f"{name}_{suffix(dtype)}", spill=True) for dtype in spills]

    def cast(self, path: Path, column: ColumnSpec) -> _Output:
        """The cast covers every tag, also ones that a fixed ``known`` lacks; what fails is rejected."""
        cell, found, expected = self.cells[path], self.tags[path], column.dtype
        branches = {expected: self.value(path, expected, column)}
        failed = f"NOT {one_of(found, NONE, expected)}"
        if expected == "String":
            words = get(cell, "$", "array<string>")
            only_words = f"{self.kinds[path]} = 'ARRAY<STRING>' AND size(array_compact({words})) = size({words})"
            for dtype in ("I32", "I64", "Double64", "Bool", "Object"):
                branches[dtype] = scalar_text(cell, dtype)
            branches["VecString"] = "''"
            branches["VecDyn"] = f"CASE WHEN {only_words} THEN array_join({words}, ' ') ELSE {json_text(cell)} END"
            failed = ""
        elif expected == "I32":
            parsed = strict_int(typed(cell, "String"), spark_type("I32"))
            branches["String"] = parsed
            failed = f"NOT {one_of(found, NONE, expected, 'String')} OR ({found} = 'String' AND ({parsed}) IS NULL)"
        if failed:
            self.reject(failed, path, expected)
        value = " ".join(f"WHEN '{dtype}' THEN {branch}" for dtype, branch in branches.items())
        # A text that is no number has been rejected above.
        wrapped = one_of(found, *(dtype for dtype in branches if dtype in _WRAPPED and not (dtype == "String" != expected)))
        out = _Output(path[-1], f"CASE {found} {value} END", expected, one_of(found, *branches), path)
        self.reject_malformed(replace(out, holds=wrapped), column)
        return out


def default_row_id(doc: str = DOC) -> str:
    """Identity of a document without a key of its own: equal documents have equal ids."""
    return f"sha2(to_json({quote(doc)}), 256)"


def identified(docs: DataFrame, row_id: str | None, doc: str = DOC) -> tuple[DataFrame, str]:
    """The documents with a row id, and its name; a hash of the document where the caller names no column."""
    if row_id is not None:
        return docs, row_id
    others = [quote(c) for c in docs.columns]
    return docs.selectExpr(f"{default_row_id(doc)} AS {ROW_ID}", *others), ROW_ID


def conform_with_rejects(
    docs: DataFrame,
    spec: object,
    known: Known | None = None,
    doc: str = DOC,
    max_keys: int | None = MAX_KEYS,
    ignore: Iterable[str] = (),
    stable: bool = False,
    strict: bool | None = None,
    rest: str | None = None,
) -> tuple[DataFrame, list[str]]:
    """The conformed columns plus ``_rejects``, an array that is empty for clean rows; and the name clashes.

    Writing this frame once serves rows and rejects in one pass over the source.
    ``strict`` (the default when ``known`` is given) also rejects keys that ``known`` does not list. With ``rest``
    undeclared keys get no columns: they stay together in the column of that name, as JSON text.
    """
    spec = parse_spec(spec)
    strict = known is not None if strict is None else strict
    if known is None:
        known = discover(docs, spec, doc, max_keys, declared_only=rest is not None)
    ignore = set(ignore)
    known = {path: tags for path, tags in known.items() if path[0] not in ignore}
    if rest is not None:
        known = {path: tags for path, tags in known.items() if path[0] in spec}
    plan = _Plan(spec, known, stable)
    carried = carried_columns(docs, doc)
    check_names(docs, [*carried, REJECTS, *plan.columns, *([rest] if rest is not None else [])])

    kept = [quote(c) for c in carried]
    v = quote(doc)
    cells, *later = ([f"{value} AS {name}" for name, value in stage.items()] for stage in plan.stages(v))
    rejects = plan.all_rejects()
    if rest is not None:
        # Whatever the plan has no cell for: undeclared keys, and declared ones that a given ``known`` lacks.
        listed = f"cast(array({', '.join(map(literal, sorted({path[0] for path in known} | ignore)))}) AS array<string>)"
        others = f"map_filter({entries(v)}, (k, x) -> NOT array_contains({listed}, k) AND NOT is_variant_null(x))"
        cells.append(f"{others} AS _others")
    elif strict:
        cells.append(f"{_stray_keys(v, {path[0] for path in known} | ignore)} AS _stray")
        rejects = f"concat({rejects}, _stray)"
    columns = [f"{value} AS {quote(name)}" for name, value in plan.columns.items()]
    if rest is not None:
        columns.append(f"CASE WHEN size(_others) > 0 THEN to_json(_others) END AS {quote(rest)}")
    # The kinds have a projection of their own: see with_tags.
    rows = docs.selectExpr(*kept, *cells)
    for stage in later:
        rows = rows.selectExpr("*", *stage) if stage else rows
    return rows.selectExpr(*kept, *columns, f"{rejects} AS {REJECTS}"), plan.clashes


_NO_REJECTS = f"cast(array() AS {_REJECT_TYPE})"


def _declared(path: Path, spec: Spec) -> str | None:
    column = None
    for key in path:
        column = spec.get(key)
        spec = column.sub_schema if column else {}
    return declared_tag(column) if column else None


def _stray_keys(v: str, listed: Iterable[str]) -> str:
    """Rejects for top-level keys that are not listed."""
    top = f"cast(array({', '.join(map(literal, sorted(listed)))}) AS array<string>)"
    fields = f"map_entries(map_filter({entries(v)}, (k, x) -> NOT array_contains({top}, k)))"
    with_kind = f"transform({fields}, e -> named_struct('key', e.key, 'v', e.value, 'kind', {kind('e.value')}))"
    strays = f"transform({with_kind}, e -> {_reject('e.key', 'Unknown', tag_of('e.v', 'e.kind'), 'to_json(e.v)')})"
    return f"coalesce(cast(filter({strays}, e -> e.actual <> '{NONE}') AS {_REJECT_TYPE}), {_NO_REJECTS})"


def split_rejects(rows: DataFrame, row_id: Iterable[str]) -> DataFrame:
    """``(row_id..., column, expected, actual, raw_json)`` from the ``_rejects`` arrays.

    There is no filter on the array: the optimizer would move it below the
    projections, to the source, and work out every cell and tag again there.
    """
    return rows.select(*[quote(c) for c in row_id], F.inline(F.array_compact(REJECTS)))


def conform(
    docs: DataFrame,
    spec: object,
    row_id: str | None = None,
    known: Known | None = None,
    doc: str = DOC,
    max_keys: int | None = MAX_KEYS,
    ignore: Iterable[str] = (),
    stable: bool = False,
    rest: str | None = None,
) -> Conformed:
    """Conform ``docs`` to ``spec``.

    ``row_id`` names the carried column that identifies a row in the rejects;
    without one rows and rejects alike carry a hash of the document as
    ``row_id``. Keys in ``ignore`` are left out; with ``rest`` undeclared keys stay
    together in that column, as JSON text, so no number of keys matters. With ``stable`` the type of a column follows from
    the spec alone: an ignored column is VARIANT even while it holds one type,
    so that separate batches agree.
    """
    strict = known is not None
    if known is None:
        known = discover(docs, spec, doc, max_keys, declared_only=rest is not None)
    options = {"doc": doc, "ignore": ignore, "stable": stable, "strict": strict, "rest": rest}
    docs, row_id = identified(docs, row_id, doc)
    rows, clashes = conform_with_rejects(docs, spec, known, **options)
    return Conformed(rows.drop(REJECTS), split_rejects(rows, [row_id]), clashes)

"""Values of variant cells, as SQL text: typed extraction, text forms and the per-cell normalisers.

Every normaliser yields ``struct<tag string, value variant>``: a cell of a
ragged column keeps its own type next to its value. A normaliser is a chain of
small steps, each a struct of what the next one needs, so that the kind of a
cell is worked out once whether the chain runs as projections over columns
(:func:`normalise_columns`) or as nested transforms over an array
(:func:`normalise_elements`).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from tablebridge.functions.paths import get, let, literal, quote
from tablebridge.functions.tags import NONE, double_of, is_date_wrapper, kind, tag_of
from tablebridge.spec import spark_type

# The number texts a strict parser accepts.
INTEGER_TEXT = r"^[+-]?[0-9]+\z"
NUMBER_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"

# How the text of a JSON object and of a JSON array begins.
OBJECT_TEXT = r"^[ \t\r\n]*\{"
ARRAY_TEXT = r"^[ \t\r\n]*\["

# Extended-JSON wrappers in compact JSON text, and what replaces them.
WRAPPER_TEXT = (
    (r'\{"\$number(?:Int|Long)":"([+-]?[0-9]+)"\}', "$1"),
    (r'\{"\$number(?:Double|Decimal)":"(-?[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?)"\}', "$1"),
    (r'\{"\$(?:oid|numberDouble|numberDecimal)":("[^"]*")\}', "$1"),
    (r'\{"\$date":(-?[0-9]+)\}', "$1"),
)
DATE_TEXT = r'\{"\$date":"([^"\\]*)"\}'
# Text without these has no wrapper in it, whatever its strings hold.
WRAPPER_KEY = r'\{"\$(oid|date|number(Int|Long|Double|Decimal))":'


def _millis(text: str) -> str:
    return f"unix_millis(try_cast({text} AS timestamp))"


def date_millis(v: str) -> str:
    """Epoch milliseconds of a ``{"$date": ...}`` wrapper."""
    text = get(v, '$["$date"]', "string")
    long = get(v, '$["$date"]["$numberLong"]', "string")
    return f"coalesce(try_cast({long} AS bigint), try_cast({text} AS bigint), {_millis(text)})"


def plain_json(text: str) -> str:
    """Replace Extended-JSON wrappers at any depth of compact JSON text by the plain values they hold.

    An unescaped quote can only delimit a key or a string in JSON text, so the
    patterns never match inside a string value.
    """
    plain = text
    for pattern, value in WRAPPER_TEXT:
        plain = f"regexp_replace({plain}, {literal(pattern)}, {literal(value)})"
    millis = f"coalesce(cast({_millis('d')} AS string), to_json(cast(d AS variant)))"
    pieces = f"split(p, {literal(DATE_TEXT)}, -1)"
    dates = f"transform(regexp_extract_all(p, {literal(DATE_TEXT)}, 1), d -> {millis})"
    dated = f"array_join(zip_with({pieces}, {dates}, (piece, ms) -> concat(piece, coalesce(ms, ''))), '')"
    replaced = let("p", plain, f"""CASE WHEN contains(p, '{{"$date":"') THEN {dated} ELSE p END""")
    return f"""CASE WHEN {has_wrapper(text)} THEN {replaced} ELSE {text} END"""


def has_wrapper(text: str) -> str:
    return f"""(contains({text}, '{{"$') AND {text} RLIKE {literal(WRAPPER_KEY)})"""


def json_text(v: str) -> str:
    """Compact JSON text without Extended-JSON wrappers."""
    return let("j", f"to_json({v})", plain_json("j"))


def nested(v: str) -> str:
    """An array or object variant with the Extended-JSON wrappers inside it replaced."""
    return f"CASE WHEN {has_wrapper(f'to_json({v})')} THEN try_parse_json({json_text(v)}) ELSE {v} END"


def typed(v: str, dtype: str) -> str:
    """Value of a cell whose tag is ``dtype``, as the Spark type of that tag.

    ``try_variant_get`` coerces (``true`` becomes 1, ``"7"`` becomes 7), so use
    this only behind a test of the tag.
    """
    if dtype == "I32":
        return f"try_cast(coalesce({get(v, '$', 'bigint')}, {get(v, '$["$numberInt"]', 'bigint')}) AS int)"
    if dtype == "I64":
        long = f"try_cast({get(v, '$["$numberLong"]', 'string')} AS bigint)"
        return f"coalesce({get(v, '$', 'bigint')}, {long}, {date_millis(v)})"
    if dtype == "Double64":
        return double_of(v)
    if dtype == "Double32":
        return f"cast({double_of(v)} AS float)"
    if dtype == "String":
        return f"coalesce({get(v, '$["$oid"]', 'string')}, {get(v, '$', 'string')})"
    if dtype in ("VecDyn", "Object"):
        return nested(v)
    return get(v, "$", spark_type(dtype))


def strict_int(text: str, dtype: str) -> str:
    """Whole-number text as an integer; NULL unless the text is exactly a number that fits."""
    return f"CASE WHEN {text} RLIKE {literal(INTEGER_TEXT)} THEN try_cast({text} AS {dtype}) END"


def scalar_text(v: str, dtype: str) -> str:
    """Text of a cell whose tag is ``dtype``: strings bare, everything else as JSON text."""
    if dtype == "String":
        return typed(v, "String")
    if dtype in ("VecDyn", "VecString", "Object"):
        return json_text(v)
    return f"cast({typed(v, dtype)} AS string)"


def text_of(v: str, found: str) -> str:
    """Text of a cell of any tag; NULL for none."""
    scalars = " ".join(
        f"WHEN '{dtype}' THEN {scalar_text(v, dtype)}" for dtype in ("String", "I32", "I64", "Double64", "Bool")
    )
    return f"CASE {found} {scalars} WHEN '{NONE}' THEN NULL ELSE {json_text(v)} END"


def elements(v: str) -> str:
    """Elements of an array variant; NULL for anything else."""
    return get(v, "$", "array<variant>")


def rfc3339(millis: str) -> str:
    """RFC-3339 text in UTC; the fraction has no trailing zeros and is left out when zero."""
    seconds = f"cast(cast({millis} AS decimal(18,0)) / 1000 AS decimal(18,6))"
    at = f"timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {seconds})"
    return f"concat(translate(cast({at} AS string), ' ', 'T'), 'Z')"


Step = Callable[[str], str]

_NUMBER = "'^(BIGINT|DECIMAL|DOUBLE|FLOAT)'"
_NUMBERS = "'^ARRAY<(BIGINT|DECIMAL|DOUBLE|FLOAT)'"
_FRACTION = "'^(DECIMAL|DOUBLE|FLOAT)'"
_EMPTY = "cast(cast(array() AS array<string>) AS variant)"


def _parts(p: str, *kept: str, **added: str) -> str:
    fields = [f"'{name}', {p}.{name}" for name in kept] + [f"'{name}', {value}" for name, value in added.items()]
    return f"named_struct({', '.join(fields)})"


def _with_kind(v: str) -> str:
    return _parts(v, v=v, kind=kind(v))


def _with_tag(p: str) -> str:
    return _parts(p, "v", "kind", tag=tag_of(f"{p}.v", f"{p}.kind"))


def _with_array(p: str) -> str:
    """Arrays also with their wrappers replaced; ``long`` when a wrapper states 64 bits."""
    return _parts(
        p,
        "v",
        "kind",
        "tag",
        a=f"CASE WHEN {p}.tag = 'VecDyn' THEN {nested(f'{p}.v')} END",
        long=f"contains({p}.kind, '`$numberLong`')",
    )


def _with_array_kind(p: str) -> str:
    first = get(f"{p}.a", "$[0]", "variant")
    return _parts(p, "v", "kind", "tag", "a", "long", array_kind=kind(f"{p}.a"), first_kind=kind(first))


def _texts(a: str) -> str:
    """Elements as text, those that are no strings as JSON text."""
    return f"cast(transform({get(a, '$', 'array<string>')}, e -> coalesce(e, 'null')) AS variant)"


def _doubles(a: str) -> str:
    return f"cast({get(a, '$', 'array<double>')} AS variant)"


def _scalar(p: str) -> str:
    """Value of a cell that is no array: integers stay, everything else becomes text."""
    v = f"{p}.v"
    return f"""CASE {p}.tag
        WHEN 'I32' THEN cast({typed(v, 'I32')} AS variant)
        WHEN 'I64' THEN cast({typed(v, 'I64')} AS variant)
        WHEN 'VecString' THEN {_EMPTY}
        WHEN '{NONE}' THEN NULL
        ELSE cast({text_of(v, f'{p}.tag')} AS variant) END"""


def _typed_cell(p: str) -> str:
    v, a, found = f"{p}.v", f"{p}.a", f"{p}.tag"
    integers = f"{p}.array_kind = 'ARRAY<BIGINT>'"
    numbers = f"{p}.array_kind RLIKE {_NUMBERS}"
    longs = get(a, "$", "array<bigint>")
    # JSON integers have no width: one that needs 64 bits makes the whole array 64 bits wide.
    wide = f"{p}.long OR array_max({longs}) > 2147483647 OR array_min({longs}) < -2147483648"
    out = f"""CASE WHEN {found} IN ('Bool', 'Object') THEN 'String'
        WHEN {found} <> 'VecDyn' THEN {found}
        WHEN {integers} THEN CASE WHEN {wide} THEN 'VecI64' ELSE 'VecI32' END
        WHEN {numbers} THEN 'VecF64' ELSE 'VecString' END"""
    value = f"""CASE WHEN {found} = 'Double64' THEN cast({typed(v, 'Double64')} AS variant)
        WHEN {found} <> 'VecDyn' THEN {_scalar(p)}
        WHEN {integers} THEN cast({longs} AS variant)
        WHEN {numbers} THEN {_doubles(a)} ELSE {_texts(a)} END"""
    return _parts(p, tag=out, value=value)


def _http_cell(p: str) -> str:
    v, a, found = f"{p}.v", f"{p}.a", f"{p}.tag"
    is_date = is_date_wrapper(f"{p}.kind")
    numbers = f"{p}.first_kind RLIKE {_FRACTION} AND {p}.array_kind RLIKE {_NUMBERS}"
    out = f"""CASE WHEN {is_date} OR {found} IN ('Bool', 'Double64', 'Object') THEN 'String'
        WHEN {found} <> 'VecDyn' THEN {found}
        WHEN {numbers} THEN 'VecF64' ELSE 'VecString' END"""
    value = f"""CASE WHEN {is_date} THEN cast({rfc3339(date_millis(v))} AS variant)
        WHEN {found} <> 'VecDyn' THEN {_scalar(p)}
        WHEN {numbers} THEN {_doubles(a)} ELSE {_texts(a)} END"""
    return _parts(p, tag=out, value=value)


def _nested_cell(p: str) -> str:
    v = f"{p}.v"
    scalars = " ".join(
        f"WHEN '{dtype}' THEN cast({typed(v, dtype)} AS variant)" for dtype in ("I32", "I64", "Double64", "String")
    )
    value = f"CASE {p}.tag {scalars} WHEN 'VecDyn' THEN {p}.a WHEN '{NONE}' THEN NULL ELSE {nested(v)} END"
    return _parts(p, "tag", value=value)


def _homogenised(p: str) -> str:
    a, found = f"{p}.a", f"{p}.tag"
    numbers = f"{p}.first_kind RLIKE {_NUMBER}"
    texts = f"{p}.first_kind = 'STRING'"
    none = f"{found} IN ('VecString', '{NONE}')"
    number = f"CASE WHEN {kind('e')} RLIKE {_NUMBER} THEN {get('e', '$', 'double')} END"
    mixed = f"cast(transform({elements(a)}, e -> {number}) AS variant)"
    out = f"""CASE WHEN {none} THEN '{NONE}' WHEN {numbers} THEN 'VecF64'
        WHEN {texts} THEN 'VecString' ELSE 'String' END"""
    value = f"""CASE WHEN {none} THEN NULL
        WHEN {numbers} THEN CASE WHEN {p}.array_kind RLIKE {_NUMBERS} THEN {_doubles(a)} ELSE {mixed} END
        WHEN {texts} THEN {_texts(a)}
        ELSE cast({json_text(f'{p}.v')} AS variant) END"""
    return _parts(p, tag=out, value=value)


_COMMON: tuple[Step, ...] = (_with_kind, _with_tag, _with_array, _with_array_kind)

# For a typed sink: booleans and documents become text. Arrays take the type of
# their elements: integers, other numbers, or else text, so nothing is lost.
TYPED: tuple[Step, ...] = (*_COMMON, _typed_cell)

# For a JSON body: integers, text, number arrays (by their first element) and text arrays.
HTTP: tuple[Step, ...] = (*_COMMON, _http_cell)

# For nested use: every level keeps its type, dates are epoch milliseconds.
NESTED: tuple[Step, ...] = (*_COMMON, _nested_cell)

# One element type per JSON array, chosen by its first element. Number first:
# doubles, other elements NULL. Text first: text, other elements as JSON text.
# Empty: none. Anything else is kept as JSON text.
HOMOGENISE: tuple[Step, ...] = (*_COMMON, _homogenised)


def normalise_columns(df: DataFrame, columns: Sequence[str], steps: Sequence[Step]) -> DataFrame:
    """Replace variant columns by their normalised cells, one projection per step."""
    targets = set(columns)
    for step in steps:
        df = df.selectExpr(
            *[f"{step(quote(c))} AS {quote(c)}" if c in targets else quote(c) for c in df.columns]
        )
    return df


def normalise_elements(values: str, steps: Sequence[Step]) -> str:
    """Normalise every element of an array of variants."""
    for step in steps:
        values = f"transform({values}, c -> {step('c')})"
    return values


def safe_decode(text: str, dtype: str) -> str:
    """Decode text as ``dtype``; NULL where it is not exactly a value of that type."""
    if dtype in ("I16", "I32", "I64"):
        return strict_int(text, spark_type(dtype))
    if dtype in ("Double32", "Double64"):
        return f"CASE WHEN {text} RLIKE {literal(NUMBER_TEXT)} THEN try_cast({text} AS {spark_type(dtype)}) END"
    if dtype == "Bool":
        return f"CASE lower({text}) WHEN 'true' THEN true WHEN 'false' THEN false END"
    if dtype == "String":
        return text
    parsed = f"try_parse_json({text})"
    if dtype == "Object":
        return f"CASE WHEN {text} RLIKE {literal(OBJECT_TEXT)} THEN {parsed} END"
    value = parsed if dtype == "VecDyn" else get(parsed, "$", spark_type(dtype))
    return f"CASE WHEN {text} RLIKE {literal(ARRAY_TEXT)} THEN {value} END"

"""SQL text for names, literals and the fields of a variant.

Expressions over variants are built as SQL text: a document has many keys and
each needs many small expressions, which Spark parses far faster than Python
can assemble them node by node.
"""

from __future__ import annotations


def quote(name: str) -> str:
    """Backtick-quote a column name."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """A string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def get(v: str, path: str, dtype: str) -> str:
    """The value at ``path`` as ``dtype``, NULL when absent or not convertible."""
    return f"try_variant_get({v}, {literal(path)}, '{dtype}')"


def let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def step(key: str) -> str | None:
    """Path step for ``key``, or None when no path can spell it."""
    if '"' not in key:
        return f'["{key}"]'
    if "'" not in key:
        return f"['{key}']"
    return None


def field(v: str, *keys: str) -> str:
    """The variant found by following ``keys`` from ``v``; NULL when absent."""
    path = "$"
    for key in keys:
        spelled = step(key)
        if spelled is not None:
            path += spelled
            continue
        if path != "$":
            v, path = get(v, path, "variant"), "$"
        v = f"element_at({entries(v)}, {literal(key)})"
    return v if path == "$" else get(v, path, "variant")


def entries(v: str) -> str:
    """Fields of an object variant as ``map<string,variant>``; NULL for anything else."""
    return get(v, "$", "map<string,variant>")


# JSON text keeps NULL fields and all six digits of a timestamp's fraction.
JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def whole_json(value: str) -> str:
    """JSON text of a nested value that loses neither NULL fields nor microseconds."""
    options = ", ".join(literal(text) for pair in JSON_OPTIONS.items() for text in pair)
    return f"to_json({value}, map({options}))"

"""Choosing columns and keys by name."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from tablebridge.functions.paths import entries, quote
from tablebridge.functions.tags import one_of


def ignore_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop ``names``; names the table lacks are harmless."""
    return df.drop(*names)


def ignore_keys(docs: DataFrame, names: Iterable[str], doc: str = "doc") -> DataFrame:
    """Remove keys from every document; documents that lack them are left as they are."""
    names = list(names)
    if not names:
        return docs
    kept = f"map_filter({entries(quote(doc))}, (k, v) -> NOT {one_of('k', *names)})"
    return docs.withColumn(doc, F.expr(f"to_variant_object({kept})"))


def select_existing(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Keep those of ``names`` that exist, in the order asked for."""
    have = set(df.columns)
    return df.select(*[quote(name) for name in names if name in have])


def missing_columns(df: DataFrame, target: DataFrame) -> list[str]:
    """Columns of ``df`` that ``target`` would need to gain before ``df`` can be appended to it."""
    have = {name.lower() for name in target.columns}
    return [name for name in df.columns if name.lower() not in have]

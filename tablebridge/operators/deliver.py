"""Native columns out of ``struct<tag, value>`` cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tablebridge.functions.paths import get, quote
from tablebridge.functions.tags import NONE
from tablebridge.operators.align import check_names
from tablebridge.spec import spark_type, suffix


def tags_of(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """The tags that the cells of each column have, by one job whose result is as small as the list of types."""
    found = df.agg(*[F.collect_set(F.col(f"{quote(c)}.tag")).alias(f"_{i}") for i, c in enumerate(columns)]).first()
    return {c: sorted(set(found[i]) - {NONE}, key=suffix) for i, c in enumerate(columns)}


def native_columns(df: DataFrame, columns: Sequence[str], tags: dict[str, list[str]] | None = None) -> DataFrame:
    """Replace cells by values of a type that sinks know.

    A column of one type keeps its name; one of several becomes ``<column>_<suffix>`` for each of them, all but one NULL
    in a row. A column without any value is text. ``tags`` (see :func:`tags_of`) saves the job that finds them.
    """
    if not columns:
        return df
    tags = tags_of(df, columns) if tags is None else tags

    def parts(column: str) -> list[tuple[str, str]]:
        cell = quote(column)
        seen = tags[column] or ["String"]
        names = {dtype: column if len(seen) == 1 else f"{column}_{suffix(dtype)}" for dtype in seen}
        return [
            (names[dtype], f"CASE WHEN {cell}.tag = '{dtype}' THEN {get(f'{cell}.value', '$', spark_type(dtype))} END")
            for dtype in seen
        ]

    out = [part for c in df.columns for part in (parts(c) if c in columns else [(c, quote(c))])]
    check_names(df, [name for name, _ in out])
    return df.selectExpr(*[f"{value} AS {quote(name)}" for name, value in out])

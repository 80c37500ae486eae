"""Gram matrices of many rows, summed by Spark from one small matrix per task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUMBERS = 1 << 21  # numbers of a block of rows that a task works on at once


def finite(vector: Column) -> Column:
    """Whether a vector is there and has neither null nor non-finite components."""
    good = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(vector.isNotNull() & good, F.lit(False))


def steps_of(vector: Column, scale: int, most: int) -> Column:
    """floor(scale * x) of each component as a long; what lies beyond ``most`` on either side is ``most``."""
    far = F.lit(most).cast("long")
    return F.transform(vector, lambda x: F.greatest(F.least(F.floor(x.cast("double") * scale), far), -far))


def blocks(batch: pa.RecordBatch, column: int, size: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(from, to, rows) of a list column whose lists all have ``size`` numbers, in blocks of bounded size."""
    step = max(1, NUMBERS // max(1, size))
    for at in range(0, batch.num_rows, step):
        lists = batch.column(column).slice(at, step)
        yield at, at + len(lists), lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), size)


def gram(rows: DataFrame, column: str, size: int, prepare: Callable[[np.ndarray], np.ndarray], width: int | None = None) -> np.ndarray:
    """The sum of y'y over the rows, where ``prepare`` turns a block of vectors into a block of y's of ``width`` columns.

    Each task gives the upper triangle of one matrix; the driver gets width * (width + 1) / 2 numbers, whatever the rows.
    """
    width = size if width is None else width
    above = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for _, _, x in blocks(batch, 0, size):
                y = prepare(x)
                total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(a) for a in (*above, total[above])], names=["i", "j", "value"])

    out = np.zeros((width, width))
    summed = rows.select(column).mapInArrow(run, "i long, j long, value double").groupBy("i", "j").agg(F.sum("value").alias("value"))
    for i, j, value in summed.collect():
        out[i, j] = out[j, i] = value
    return out

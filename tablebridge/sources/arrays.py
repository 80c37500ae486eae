"""Reading large JSON files, each one array of documents, by byte ranges.

The files are read as text split at commas, which Spark does by byte ranges, one task each. Whether a comma ends a document
depends on all that comes before it: whether it is inside a string, and how deep in brackets. But what a range does to
that state is short, one answer for a start outside a string and one for a start inside (how the depth changes, and where it
ends), and such answers compose. So a first pass gives two answers for each range, they are composed range by range, and a
second pass, now knowing the state at each start, cuts documents independently. Only the first and the last piece of a
range can belong to a document of several ranges; these pieces are put together by a small shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tablebridge.operators.discover import DOC
from tablebridge.sources.documents import Documents, parse_documents

EFFECT = "file string, start long, flips boolean, outside long, inside long, opens string"
STATE = "file string, start long, in_string boolean, depth long, is_array boolean"
PIECE = "file string, start long, place int, ends boolean, is_array boolean, text string"
# Places of a piece: a document that lies within its range, what comes before the first end of one there, and after the last.
WHOLE, HEAD, TAIL = 0, 1, 2


def _fragments(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text between commas with what it does to the state: ``flips`` in and out of a string, and changes of depth."""
    read = spark.read.option("lineSep", ",").text(path)
    parts = F.split(F.regexp_replace("value", r"\\.", ""), '"', -1)
    rows = read.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value", parts.alias("parts")
    )

    def depth(odd: int):
        """Brackets opened less those closed in every other part, which lie outside strings."""
        text = F.array_join(F.filter("parts", lambda _, i: i % 2 == odd), "")
        return (F.length(F.translate(text, "]}", "")) - F.length(F.translate(text, "[{", ""))).cast("long")

    return rows.select("file", "start", "value", (F.size("parts") % 2 == 0).alias("flips"), depth(0).alias("outside"), depth(1).alias("inside"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], int, int]]:
    """(range, from, to) of the rows of one range, which follow each other."""
    starts = batch.column(1).to_numpy(zero_copy_only=False)
    files = batch.column(0).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    edges = np.flatnonzero((np.diff(starts) != 0) | (np.diff(files) != 0)) + 1 if len(starts) else []
    for at, to in zip([0, *edges], [*edges, len(starts)]):
        if to > at:
            yield (batch.column(0)[int(at)].as_py(), int(starts[at])), int(at), int(to)


def _after(flips: np.ndarray, outside: np.ndarray, inside: np.ndarray, in_string: bool) -> tuple[np.ndarray, np.ndarray]:
    """After each fragment: whether it ends in a string, and the change of depth since the start."""
    ends = (np.cumsum(flips) + in_string) % 2 == 1
    begins = np.concatenate([[in_string], ends[:-1]])
    return ends, np.cumsum(np.where(begins, inside, outside))


def _effects(fragments: DataFrame) -> DataFrame:
    """``EFFECT``: one row for each byte range; ``opens`` is its first sign that is no space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], list] = {}
        for batch in batches:
            flips, outside, inside = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3, 4))
            for key, at, to in _runs(batch):
                state = found.setdefault(key, [False, 0, 0, ""])
                changes = []
                for in_string in (state[0], not state[0]):  # as from a start outside, and inside
                    ends, depth = _after(flips[at:to], outside[at:to], inside[at:to], in_string)
                    changes.append(int(depth[-1]))
                state[1] += changes[0]
                state[2] += changes[1]
                state[0] = bool(_after(flips[at:to], outside[at:to], inside[at:to], state[0])[0][-1])
                state[3] = state[3] or "".join(batch.column(5).slice(at, to - at).to_pylist())[:1]
        rows = [(*key, *state) for key, state in found.items()]
        yield pa.RecordBatch.from_pylist([dict(zip(_names(EFFECT), row)) for row in rows], schema=_arrow(EFFECT))

    opens = F.regexp_extract("value", r"^[\s\x{FEFF}]*(\S)", 1)
    return fragments.select("file", "start", "flips", "outside", "inside", opens.alias("opens")).mapInArrow(run, EFFECT)


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _arrow(schema: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in schema.split(", "))])


def _states(effects: DataFrame) -> DataFrame:
    """``STATE`` at the start of each range: the effects of those before it, one after the other. One row a range."""

    def compose(ranges: pd.DataFrame) -> pd.DataFrame:
        in_string, depth, rows, opens = False, 0, [], ""
        for r in ranges.sort_values("start").itertuples():
            opens = opens or r.opens
            rows.append((r.file, r.start, in_string, depth))
            depth += r.inside if in_string else r.outside
            in_string = in_string != r.flips
        return pd.DataFrame([(*row, opens == "[") for row in rows], columns=_names(STATE))

    return effects.groupBy("file").applyInPandas(compose, STATE)


def _pieces(fragments: DataFrame) -> DataFrame:
    """``PIECE`` of fragments with the state at the start of their range, which come in the order of the file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, ended, state, array = None, [], False, (False, 0), False

        def last() -> list[tuple]:
            return [(*current, TAIL if ended else HEAD, False, array, ",".join(held))] if current and held else []

        for batch in batches:
            flips, outside, inside, in_string, depth, is_array = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3, 9))
            out: list[tuple] = []
            for key, at, to in _runs(batch):
                if key != current:
                    out += last()
                    current, held, ended, state, array = key, [], False, (bool(in_string[at]), int(depth[at])), bool(is_array[at])
                ends, change = _after(flips[at:to], outside[at:to], inside[at:to], state[0])
                texts = batch.column(2).slice(at, to - at).to_pylist()
                begin = 0
                # The comma behind a fragment ends a document if it lies outside strings, in the array alone.
                for cut in np.flatnonzero(~ends & (change + state[1] == 1) & is_array[at:to]).tolist():
                    held += texts[begin : cut + 1]
                    out.append((*key, WHOLE if ended else HEAD, True, array, ",".join(held)))
                    held, ended, begin = [], True, cut + 1
                held += texts[begin:]
                state = (bool(ends[-1]), state[1] + int(change[-1]))
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(_names(PIECE), row)) for row in out], schema=_arrow(PIECE))
        if rest := last():
            yield pa.RecordBatch.from_pylist([dict(zip(_names(PIECE), row)) for row in rest], schema=_arrow(PIECE))

    columns = ["file", "start", "value", "flips", "outside", "inside", "in_string", "depth", "is_array"]
    return fragments.select(*columns).mapInArrow(run, PIECE)


def _assembled(pieces: DataFrame) -> DataFrame:
    """(value): the text of each document, without the brackets of the array around it."""
    cut = pieces.where(F.col("place") != WHOLE)
    before = Window.partitionBy("file").orderBy("start", "place").rowsBetween(Window.unboundedPreceding, -1)
    numbered = cut.withColumn("number", F.coalesce(F.sum(F.col("ends").cast("long")).over(before), F.lit(0)))
    parts = F.sort_array(F.collect_list(F.struct("start", "place", "text")))
    whole = numbered.groupBy("file", "number").agg(F.array_join(F.transform(parts, lambda p: p["text"]), ",").alias("value"), F.first("is_array").alias("is_array"))
    last = F.max("number").over(Window.partitionBy("file"))
    ends = whole.select("number", "is_array", "value", last.alias("last"))
    text = F.when(F.col("is_array") & (F.col("number") == 0), F.regexp_replace("value", r"^[\s\x{FEFF}]*\[", "")).otherwise(F.col("value"))
    text = F.when(F.col("is_array") & (F.col("number") == F.col("last")), F.regexp_replace(text, r"\][\s]*$", "")).otherwise(text)
    ends = ends.select("last", text.alias("value")).where(~((F.col("last") == 0) & F.col("value").rlike(r"^\s*$")))
    return pieces.where(F.col("place") == WHOLE).select(F.col("text").alias("value")).unionAll(ends.select("value"))


def read_json_arrays(spark: SparkSession, path: str | list[str], doc: str = DOC) -> Documents:
    """Read files that each hold one array of documents, or one document, each file by as many tasks as it has byte ranges.

    Elements that are no documents, and what is left of a file that was cut short, are quarantined as in
    :func:`read_documents`. An empty array, and an empty file, hold nothing. Compressed files cannot be split.
    """
    fragments = _fragments(spark, path)
    # A broadcast, of one short row for each byte range, leaves the fragments of a range where and in the order they are read.
    # A join that shuffled them would need a sort behind it, in which a task holds all fragments of its ranges.
    placed = fragments.join(F.broadcast(_states(_effects(fragments))), ["file", "start"])
    return parse_documents(_assembled(_pieces(placed)), "value", doc)

"""Filter interaction audit (11): what every order of several filters keeps, removes and removes twice, per part of a corpus.

A document's failures are a bit mask, so each part is at most 2 ** filters cells (mask, rows, marked rows), however many
documents it has. A Gray-code walk over the subsets of active filters toggles one filter at a time: every cell counts its
active failures, and a cell that gains its first or loses its last one leaves or rejoins the running survivors. The
survivors of all subsets are stored, and any step of any order is the difference of two of them: what a filter removes
after others is states[others] - states[others and it], and its Shapley value sums that over all orders.

Only ids, parts, masks and a 256-bit hash of each text leave the scan. Repeats are found without a join of rows: counts
combine by text and part first, so a text that a third of all rows share is a few rows per task before any shuffle.

Defined cases: a null text is an empty one, a null part the empty string; a condition that is null does not fail. A row
without an id is never a repeat and makes none; rows of one id and text are no repeats of each other. A row is marked if
any label row of its id is 1. Texts are the same if their SHA-256 is. Long texts are judged whole; extra columns are left
out. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablebridge.llm.common import UPPER, kept

BLANKS = " \t\n\x0b\x0c\r"
REPEATED = "repeated"
CELL = "part string, mask int, n long, good long, toxic long"
STEP = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def text_filters(text: Column) -> dict[str, Column | str]:
    """The contract's five failure conditions; ``REPEATED`` stands for a text that a smaller id has."""
    bare = F.btrim(text, F.lit(BLANKS))
    words = F.split(bare, r"[\x20\x09-\x0D]+")
    none = (bare == "").cast("int")  # splitting nothing gives one empty word
    n_words = F.size(words) - none
    capitals = F.length(text) - F.length(F.translate(text, UPPER, ""))
    return {
        "A": n_words < 100,
        "B": (F.size(F.array_distinct(words)) - none) * 100 < n_words * 80,
        "C": capitals.cast("long") * 100 > F.length(text).cast("long") * 10,
        "D": text.rlike(r"[#$%&*|]"),
        "E": REPEATED,
    }


def failure_cells(
    docs: DataFrame,
    filters: dict[str, Column | str],
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    part_column: str = "lang",
) -> DataFrame:
    """(part, mask, n, good, toxic): rows of each part by the filters they fail; bit i of the mask is the i-th filter."""
    bits = [
        F.when(F.coalesce(test, F.lit(False)), 1 << i).otherwise(0)
        for i, test in enumerate(filters.values())
        if not isinstance(test, str)
    ]
    repeat = sum(1 << i for i, test in enumerate(filters.values()) if isinstance(test, str))
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(part_column).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        reduce(lambda a, b: a + b, bits, F.lit(0)).alias("mask"),
    )
    counted = rows.groupBy("doc_id", "digest", "part", "mask").agg(F.count("*").alias("n"))
    # Rows without an id match no label; a hash spreads them over the tasks of the join.
    counted = counted.withColumn("spread", F.when(F.col("doc_id").isNull(), F.xxhash64("digest", "part")))
    marks = (
        labels.select(F.col(id_column).cast("long").alias("label_id"), "quality", "toxic")
        .groupBy("label_id")
        .agg(
            F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("long")).alias("good"),
            F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("long")).alias("toxic"),
        )
        .withColumn("no_spread", F.lit(None).cast("long"))
    )
    same = (F.col("doc_id") == F.col("label_id")) & F.col("spread").eqNullSafe(F.col("no_spread"))
    marked = counted.join(marks, same, "left").select(
        "doc_id",
        "digest",
        "part",
        "mask",
        "n",
        (F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        (F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
    )
    sums = [F.sum(c).alias(c) for c in ("n", "good", "toxic")]
    if not repeat:
        return marked.groupBy("part", "mask").agg(*sums)
    # Of one text in one part, only the rows of the smallest id can be its first.
    known = F.col("doc_id").isNotNull()
    texts = kept(
        marked.groupBy("digest", "part", "mask", known.alias("known")).agg(
            *sums, F.min(F.when(known, F.struct("doc_id", "n", "good", "toxic"))).alias("first")
        ),
        "audit-texts",
    )
    least = texts.filter("known").groupBy("digest").agg(F.min("first.doc_id").alias("least"))
    mine = F.col("first.doc_id") == F.col("least")
    single = {c: F.when(~F.col("known"), F.col(c)).when(mine, F.col(f"first.{c}")).otherwise(0) for c in ("n", "good", "toxic")}
    both = F.array(
        F.struct("mask", *[single[c].alias(c) for c in single]),
        F.struct((F.col("mask") + repeat).alias("mask"), *[(F.col(c) - single[c]).alias(c) for c in single]),
    )
    halves = texts.join(least, "digest", "left").select("part", F.inline(both))
    return halves.filter("n > 0").groupBy("part", "mask").agg(*sums)


def survivors(masks: np.ndarray, counts: np.ndarray, filters: int) -> np.ndarray:
    """Sums of ``counts`` over the cells that pass, for every subset of active filters (a bit mask), by a Gray-code walk."""
    states = np.empty((1 << filters, counts.shape[1]), np.int64)
    failing = np.zeros(len(masks), np.int64)  # active filters that each cell fails
    alive = counts.sum(axis=0)
    active = 0
    states[active] = alive
    for turn in range(1, 1 << filters):
        bit = (turn & -turn).bit_length() - 1
        hit = (masks >> bit & 1).astype(bool)
        if active >> bit & 1:
            failing[hit] -= 1
            alive = alive + counts[hit & (failing == 0)].sum(axis=0)
        else:
            alive = alive - counts[hit & (failing == 0)].sum(axis=0)
            failing[hit] += 1
        active ^= 1 << bit
        states[active] = alive
    return states


def steps(states: np.ndarray, names: list[str]) -> Iterator[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of all orders."""
    everything = len(states) - 1
    walked = []
    shapley = [0] * len(names)
    for order in permutations(range(len(names))):
        active = 0
        for place, i in enumerate(order, 1):
            lost = states[active] - states[active | 1 << i]
            shapley[i] += int(lost[0])
            active |= 1 << i
            walked.append((order, place, i, int(states[active][0]), *map(int, lost)))
    for order, place, i, left, removed, good, toxic in walked:
        fails = int(states[0][0] - states[1 << i][0])
        unique = int(states[everything ^ 1 << i][0] - states[everything][0])
        yield "".join(names[j] for j in order), place, left, removed, fails - removed, unique, good, toxic, shapley[i]


def audit(docs: DataFrame, filters: dict[str, Column | str], labels: DataFrame, **columns: str) -> DataFrame:
    """One row per part, order of the filters and step of it; the orders are all permutations, so few filters are meant."""
    names = list(filters)

    def walk(cells: pd.DataFrame) -> pd.DataFrame:
        """At most 2 ** filters rows: the cells of one part."""
        states = survivors(cells["mask"].to_numpy(), cells[["n", "good", "toxic"]].to_numpy(np.int64), len(names))
        part = cells["part"].iloc[0]
        return pd.DataFrame([(part, *step) for step in steps(states, names)], columns=[x.split()[0] for x in STEP.split(", ")])

    return failure_cells(docs, filters, labels, **columns).groupBy("part").applyInPandas(walk, STEP)

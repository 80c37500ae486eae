"""Exact top-k search (13): the largest inner products of whole-number vectors, in order of falling length.

All vectors are sorted by length into stripes of bounded size. A query visits stripes from the longest on, in rounds that
grow fourfold; after a round its k-th best score so far is a floor, and a stripe whose longest vector times the query's
length stays below that floor is never sent the query. Inside a stripe vectors are turned by the right singular vectors of
the whole table, so that the first coordinates hold most of every length. Partial sums over a few coordinates at a time,
plus the product of the lengths of what is left (Cauchy-Schwarz), bound each score; pairs bounded below the floor drop
out, and the rest are scored in whole numbers. Bounds carry a margin for rounding, so nothing that could count is lost.

Queries go to the stripes (they are few beside the vectors), not vectors to queries: a task sorts a stripe's vectors
before its queries, holds the stripe and streams the queries. It gives at most k rows for each, so no result grows
with the table. The stripe's lengths, one number each, and d * d numbers for the rotation are all that the driver holds.

Defined cases: vectors that are null or hold null or non-finite components take no part; vectors meet only those of their
own length; the rows of the query's own id are no candidates. Each row of a repeated id is a query, and equal rows are
candidates of their own; rows without an id are candidates that come last among ties. Components beyond 2 ** 31 - 1 after
scaling count as that; a score that no long holds counts as the nearest long. Extra columns are left out. An empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablebridge.llm.common import kept
from tablebridge.llm.grams import finite, gram, steps_of

FARTHEST = (1 << 31) - 1
STRIPES = 4096  # so many at most, while they fit in memory
LEAST_ROWS, MOST_ROWS = 1024, 1 << 18  # of a stripe
PORTION, ASKED = 1024, 256  # vectors of a stripe and queries that meet at once
PAIRS = 1 << 14  # scored at once
COORDINATES = 16  # of a partial sum
NO_FLOOR = -float("inf")
FOUND = "query long, query_id long, vec_id long, score long"


def products(a: np.ndarray, b: np.ndarray, q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products of the rows ``q`` of ``a`` with the rows ``v`` of ``b``, exact: the numbers decide in what arithmetic."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    kind = np.float64 if most < 1 << 53 else np.int64 if most < 1 << 63 else object
    a, b = a.astype(kind), b.astype(kind)
    if len(q) * 8 >= len(a) * len(b):
        found = (a @ b.T)[q, v]
    else:
        found = np.concatenate([(a[q[i : i + PAIRS]] * b[v[i : i + PAIRS]]).sum(axis=1) for i in range(0, max(1, len(q)), PAIRS)])
    return (np.clip(found, -(1 << 63), (1 << 63) - 1) if kind is object else found).astype(np.int64)


class Side:
    """Vectors of one length: ids, whole numbers, turned coordinates and the length of what follows each partial sum."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, rotation: np.ndarray) -> None:
        self.ids, self.x = ids, x
        self.turned = x.astype(np.float64) @ rotation
        squares = self.turned**2
        cuts = range(0, x.shape[1], COORDINATES)
        self.cuts = [(at, min(at + COORDINATES, x.shape[1])) for at in cuts]
        self.left = [np.sqrt(squares[:, to:].sum(axis=1)) for _, to in self.cuts]
        self.length = np.sqrt(squares.sum(axis=1))

    def part(self, at: int, to: int) -> Side:
        out = object.__new__(Side)
        out.ids, out.x, out.turned, out.cuts = self.ids[at:to], self.x[at:to], self.turned[at:to], self.cuts
        out.left, out.length = [v[at:to] for v in self.left], self.length[at:to]
        return out


def survivors(queries: Side, floors: np.ndarray, vectors: Side) -> tuple[np.ndarray, np.ndarray]:
    """(query, vector) places of the pairs whose score may reach the query's floor."""
    margin = 1e-9 * (1 + queries.length[:, None] * vectors.length.max(initial=0))
    wanted = floors[:, None] - margin
    alive = queries.length[:, None] * vectors.length[None, :] >= wanted
    sums = np.zeros(alive.shape)
    for place, (at, to) in enumerate(queries.cuts):
        if np.count_nonzero(alive) * 8 < alive.size:
            q, v = np.nonzero(alive)  # few pairs are left: go on with these alone
            some = sums[q, v]
            for later, (at, to) in list(enumerate(queries.cuts))[place:]:
                some = some + np.einsum("ij,ij->i", queries.turned[q, at:to], vectors.turned[v, at:to])
                on = some + queries.left[later][q] * vectors.left[later][v] >= wanted[q, 0]
                q, v, some = q[on], v[on], some[on]
            return q, v
        sums += queries.turned[:, at:to] @ vectors.turned[:, at:to].T
        alive &= sums + queries.left[place][:, None] * vectors.left[place][None, :] >= wanted
    return np.nonzero(alive)


def best_of(query: np.ndarray, score: np.ndarray, vec_id: np.ndarray, unknown: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's k best: by score, then the smaller id, those without an id last."""
    order = np.lexsort((vec_id, unknown, -score, query))
    query = query[order]
    first = np.searchsorted(query, query)
    return order[np.arange(len(order)) - first < k]


class Stripe:
    """A stripe's vectors by length, longest first, against portions of queries."""

    def __init__(self, ids: list[np.ndarray], vectors: list[np.ndarray], rotations: dict[int, np.ndarray]) -> None:
        self.sides: dict[int, Side] = {}
        self.rotations = rotations
        sizes = np.array([len(x) for x in vectors])
        for size in np.unique(sizes).tolist():
            own = np.flatnonzero(sizes == size)
            side = Side(np.array([ids[i] for i in own], object), np.stack([vectors[i] for i in own]), rotations[size])
            order = np.argsort(-side.length, kind="stable")
            self.sides[size] = Side(side.ids[order], side.x[order], rotations[size])

    def best(self, number: np.ndarray, ids: np.ndarray, x: np.ndarray, floors: np.ndarray, k: int) -> list[tuple]:
        """(query number, query id, vec_id, score) of each query's k best here, if they reach its floor."""
        size = x.shape[1]
        if size not in self.sides:
            return []
        side, queries = self.sides[size], Side(ids, x, self.rotations[size])
        floors = floors.copy()
        unknown = np.array([i is None for i in side.ids])
        numbers = np.array([0 if i is None else i for i in side.ids], np.int64)
        empty = np.zeros(0, np.int64)
        found = (empty, empty, empty)  # query, vector, score
        for at in range(0, len(numbers), PORTION):
            q, v = survivors(queries, floors, side.part(at, at + PORTION))
            v = v + at
            other = unknown[v] | (numbers[v] != ids[q])
            q, v = q[other], v[other]
            if not len(q):
                continue
            now = (q, v, products(queries.x, side.x[at : at + PORTION], q, v - at))
            q, v, score = (np.concatenate(pair) for pair in zip(found, now))
            best = best_of(q, score, numbers[v], unknown[v], k)
            found = q, v, score = q[best], v[best], score[best]
            # best_of sorts by query: where k are found the last one's score is the floor from here on.
            last = np.flatnonzero(np.append(q[1:] != q[:-1], True))
            full = np.diff(last, prepend=-1) == k
            floors[q[last[full]]] = np.maximum(floors[q[last[full]]], score[last[full]])
        q, v, score = found
        return list(zip(number[q].tolist(), ids[q].tolist(), side.ids[v].tolist(), score.tolist()))


def _searched(rows: DataFrame, k: int, rotations: dict[int, np.ndarray]) -> DataFrame:
    """``FOUND`` of rows (stripe, query, id, x, floor), which come sorted by stripe, its vectors (query is null) first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, ids, vectors, stripe = None, [], [], None
        for batch in batches:
            lists = batch.column(3)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            begins = ends - lists.value_lengths().to_numpy(zero_copy_only=False)
            of, number, own, floor = (batch.column(i).to_pylist() for i in (0, 1, 2, 4))
            asked: list[int] = []

            def answer() -> Iterator[pa.RecordBatch]:
                nonlocal stripe
                if not asked:
                    return
                if stripe is None:
                    stripe = Stripe(ids, vectors, rotations)
                by_size: dict[int, list[int]] = {}
                for i in asked:
                    by_size.setdefault(int(ends[i] - begins[i]), []).append(i)
                found: list[tuple] = []
                for size, places in by_size.items():
                    for at in range(0, len(places), ASKED):
                        some = places[at : at + ASKED]
                        x = np.stack([flat[begins[i] : ends[i]] for i in some])
                        numbers, names = (np.array([a[i] for i in some], np.int64) for a in (number, own))
                        found += stripe.best(numbers, names, x, np.array([floor[i] for i in some], np.float64), k)
                asked.clear()
                columns = list(zip(*found)) or [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[c.split()[0] for c in FOUND.split(", ")])

            for i, here in enumerate(of):
                if here != current:
                    yield from answer()
                    current, ids, vectors, stripe = here, [], [], None
                if number[i] is None:
                    ids.append(own[i])
                    vectors.append(flat[begins[i] : ends[i]].copy())
                else:
                    asked.append(i)
            yield from answer()

    return rows.mapInArrow(run, FOUND)


def striped(vectors: DataFrame, scale: int, id_column: str, vector_column: str) -> DataFrame:
    """(number, vec_id, x, length, stripe) of the usable vectors, stripe 0 the longest; all but ``stripe`` are fixed by the row."""
    vector = F.col(vector_column)
    usable = vectors.filter(finite(vector)).select(
        F.col(id_column).cast("long").alias("vec_id"), F.transform(steps_of(vector, scale, FARTHEST), lambda x: x.cast("int")).alias("x")
    )
    square = F.aggregate("x", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
    rows = kept(usable.withColumn("length", F.sqrt(square)), "search-rows").withColumn("number", F.monotonically_increasing_id())
    n = rows.count()
    per_stripe = min(MOST_ROWS, max(LEAST_ROWS, -(-n // STRIPES)))
    stripes = max(1, -(-n // per_stripe))
    # The row's number breaks ties, so that copies of one vector spread over many stripes.
    cut = rows.repartitionByRange(stripes, F.col("length").desc(), "number")
    return kept(cut.withColumn("stripe", F.spark_partition_id()), "search-stripes")


def top_inner_products(
    vectors: DataFrame,
    k: int = 5,
    scale: int = 256,
    every: int = 50,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best of all other rows for each row whose id ``every`` divides."""
    table = striped(vectors, scale, id_column, vector_column)
    edges = sorted((r.stripe, r.most) for r in table.groupBy("stripe").agg(F.max("length").alias("most")).collect())
    numbers, longest = [s for s, _ in edges], [most for _, most in edges]
    sizes = sorted(r.size for r in table.select(F.size("x").alias("size")).distinct().collect())
    rotations = {}
    for size in sizes:
        alike = table.filter(F.size("x") == size)
        g = gram(alike, "x", size, lambda x: x.astype(np.float64)) if size else np.zeros((0, 0))
        rotations[size] = np.linalg.eigh(g)[1][:, ::-1].copy()
    queries = kept(table.filter(F.col("vec_id") % every == 0).select("number", "vec_id", "x", "length"), "search-queries")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "vec_id")
    best = rows = None
    at, many = 0, 1
    while at < len(numbers):
        to = min(at + many, len(numbers))
        asking = queries.withColumn("floor", F.lit(NO_FLOOR))
        if best is not None:
            floors = best.filter(F.col("rank") == k).select(F.col("query").alias("number"), F.col("score").cast("double").alias("at_least"))
            asking = queries.join(floors, "number", "left").withColumn("floor", F.coalesce("at_least", F.lit(NO_FLOOR)))
        # Stripes fall in length, so those that may reach the floor are the first ones of this round.
        ahead = F.array(*[F.struct(F.lit(s).alias("stripe"), F.lit(m * (1 + 1e-9)).alias("most")) for s, m in zip(numbers[at:to], longest[at:to])])
        near = F.filter(ahead, lambda s: F.col("length") * (1 + 1e-9) * s["most"] + 1e-6 >= F.col("floor"))
        sent = asking.select(F.explode(near).alias("to"), F.col("number").alias("query"), F.col("vec_id").alias("id"), "x", "floor")
        sent = sent.select("to.stripe", "query", "id", "x", "floor")
        some = table.filter(F.col("stripe").between(numbers[at], numbers[to - 1]))
        held = some.select("stripe", F.lit(None).cast("long").alias("query"), F.col("vec_id").alias("id"), "x", F.lit(0.0).alias("floor"))
        met = held.unionByName(sent).repartition(to - at, "stripe").sortWithinPartitions("stripe", F.asc_nulls_first("query"))
        found = _searched(met, k, rotations)
        if best is not None:
            found = found.unionByName(best.drop("rank"))
        best = kept(found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k), "search-best")
        at, many = to, many * 4
    if best is None:
        return table.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score"))
    return best.select("query_id", "rank", "vec_id", "score")

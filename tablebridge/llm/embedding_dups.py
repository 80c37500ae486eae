"""Embedding near-duplicates (8): an inverted multi-index with verification.

Each half of a vector has a codebook of its own, so k + k centroids make a grid of k * k cells. A vector lies in one cell and
visits the cells nearest to it, in the order of the multi-sequence traversal (the sum of its distances to the two
centroids), until the target recall. How many cells that takes is measured: the true neighbours of query vectors, drawn until enough of them
have any, are found by brute force over all vectors, and the visits cover the wanted share of their cells, as the mean over
these queries. A pair is
compared if either vector visits the cell of the other, and linked if its cosine in double precision reaches the
threshold, so links are never wrong and seldom missing.

Equal vectors are one class from the start. Cells are cut into blocks of bounded size, and pairs of blocks are dealt out
one by one: each gives for every vector the number of links and one edge into a component of the block pair, never the
pairs themselves. So a crowded cell costs arithmetic, in many tasks, but no rows beyond its members.

The codebooks are fitted on a bounded sample; all vectors are indexed.

Defined cases: vectors that are null, empty or zero, or hold null or non-finite components, and rows without an id, link
with nothing (component: their own id); vectors link only with those of the same length; repeated rows are vectors of
their own, linked with each other; extra columns are left out. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablebridge.llm.common import kept
from tablebridge.llm.components import components

Codebooks = dict[int, tuple[np.ndarray, np.ndarray]]  # by vector length


def _unit(values: list[bytes], kind: str) -> np.ndarray:
    x = np.stack([np.frombuffer(v, kind) for v in values]).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # so that squares of very large or small numbers stay finite
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum(0, (x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)[None, :])


def codebook(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centroids by Lloyd's rounds from evenly spaced starting rows."""
    centres = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        nearest = _squared(x, centres).argmin(axis=1)
        count = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        centres = np.where(count[:, None] > 0, sums / np.maximum(1, count)[:, None], centres)
    return centres


def traversal(x: np.ndarray, books: tuple[np.ndarray, np.ndarray], steps: int) -> tuple[np.ndarray, np.ndarray]:
    """(cells, sums): the ``steps`` nearest cells of each row in the order of the multi-sequence traversal.

    The i-th and j-th nearest centroids of the halves (from 1 on) can be met within ``steps`` only if i * j <= steps, as
    all cells nearer in both halves come before theirs; among these the order is that of the sums.
    """
    first, second = books
    half = x.shape[1] // 2
    a, b = _squared(x[:, :half], first), _squared(x[:, half:], second)
    ia, ib = np.argsort(a, axis=1, kind="stable")[:, :steps], np.argsort(b, axis=1, kind="stable")[:, :steps]
    i, j = np.nonzero(np.outer(np.arange(1, ia.shape[1] + 1), np.arange(1, ib.shape[1] + 1)) <= steps)
    sums = np.take_along_axis(a, ia, 1)[:, i] + np.take_along_axis(b, ib, 1)[:, j]
    cells = ia[:, i] * len(second) + ib[:, j]
    order = np.argsort(sums, axis=1, kind="stable")[:, :steps]
    return np.take_along_axis(cells, order, 1), np.take_along_axis(sums, order, 1)


def _classes(vectors: DataFrame, kind: str) -> DataFrame:
    """(vec_id, node, vector): raw numbers of usable vectors and their 128-bit hash; both null for others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            values = lists.flatten().to_numpy(zero_copy_only=False).astype(kind) + 0.0  # -0.0 becomes 0.0
            sizes = np.nan_to_num(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)).astype(int)
            ends = np.cumsum(sizes)
            raw: list[bytes | None] = []
            for end, size, known in zip(ends, sizes, ids.is_valid().to_pylist()):
                x = values[end - size : end]
                raw.append(x.tobytes() if known and size and np.isfinite(x).all() and x.any() else None)
            nodes = [hashlib.blake2b(v, digest_size=16).digest() if v else None for v in raw]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(nodes, pa.binary()), pa.array(raw, pa.binary())], names=["vec_id", "node", "vector"]
            )

    return vectors.mapInArrow(run, "vec_id long, node binary, vector binary")


def _placed(classes: DataFrame, books: Codebooks, steps: int, kind: str) -> DataFrame:
    """``classes`` with ``size`` (length of the vector), its ``cell`` and the other cells that it ``visits``."""
    shared = classes.sparkSession.sparkContext.broadcast(books)
    width = np.dtype(kind).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                raw = batch.column(1).to_pylist()
                sizes = np.array([len(v) // width for v in raw])
                cells: list[int] = [0] * len(raw)
                visits: list[list[int]] = [[] for _ in raw]
                for size in set(sizes.tolist()) & shared.value.keys():
                    rows = np.flatnonzero(sizes == size)
                    found, _ = traversal(_unit([raw[i] for i in rows], kind), shared.value[size], steps)
                    for i, own in zip(rows, found.tolist()):
                        cells[i], visits[i] = own[0], own[1:]
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns,
                        pa.array(sizes, pa.int32()),
                        pa.array(cells, pa.int32()),
                        pa.array(visits, pa.list_(pa.int32())),
                    ],
                    names=["node", "vector", "copies", "size", "cell", "visits"],
                )

    schema = "node binary, vector binary, copies long, size int, cell int, visits array<int>"
    return classes.select("node", "vector", "copies").mapInArrow(run, schema)


def _ranks(classes: DataFrame, books: Codebooks, queries: dict[int, np.ndarray], threshold: float, most: int, kind: str):
    """For the queries of each size, true neighbours (columns) by how many cells are visited before theirs; ``most``: not within ``most``."""
    prepared = {}
    for size, x in queries.items():
        cells, _ = traversal(x, books[size], most)
        prepared[size] = (x, [{cell: rank for rank, cell in enumerate(own)} for own in cells.tolist()])
    shared = classes.sparkSession.sparkContext.broadcast((books, prepared))
    width = np.dtype(kind).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, prepared = shared.value
        counts = {size: np.zeros((len(x), most + 1), np.int64) for size, (x, _) in prepared.items()}
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                raw = whole.column(0).slice(at, 1000).to_pylist()
                for size in {len(v) // width for v in raw} & prepared.keys():
                    x, ranks = prepared[size]
                    own = _unit([v for v in raw if len(v) // width == size], kind)
                    q, r = np.nonzero((cos := x @ own.T) >= threshold)
                    far = cos[q, r] < 1 - 1e-12  # a query is no neighbour of itself
                    q, r = q[far], r[far]
                    cells = traversal(own[r], books[size], 1)[0][:, 0] if len(r) else []
                    for a, cell in zip(q, cells):
                        counts[size][a, ranks[a].get(int(cell), most)] += 1
        for size, of in counts.items():
            q, rank = np.nonzero(of)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(q), size)), pa.array(q), pa.array(rank), pa.array(of[q, rank])], names=["size", "q", "rank", "n"]
            )

    counts = {size: np.zeros((len(x), most + 1), np.int64) for size, x in queries.items()}
    rows = classes.select("vector").mapInArrow(run, "size long, q long, rank long, n long")
    for row in rows.groupBy("size", "q", "rank").agg(F.sum("n").alias("n")).collect():
        counts[row["size"]][row.q, row["rank"]] = row.n
    return counts


def _covered(counts: np.ndarray) -> np.ndarray:
    """The share of a query's neighbours within 1, 2, ... cells, as the mean over queries that have any: a crowd counts as one."""
    some = counts[counts.sum(axis=1) > 0]
    return (np.cumsum(some, axis=1) / some.sum(axis=1, keepdims=True)).mean(axis=0)


def fit_index(
    classes: DataFrame,
    kind: str,
    threshold: float,
    recall: float,
    sample_rows: int = 20_000,
    query_rows: int = 1_000,
    linked_queries: int = 200,
    most_steps: int = 64,
) -> tuple[Codebooks, int, float]:
    """(codebooks, cells to visit, measured recall). The driver sees at most ``sample_rows`` vectors, and at most 64 MB.

    Blocks of queries are drawn until ``linked_queries`` of them have neighbours or every vector was one; those of the
    codebook sample come last. If ``most_steps`` cells don't reach the recall, the codebooks are halved, down to a grid of
    ``most_steps`` cells, which reaches any.
    """
    n = classes.count()
    width = np.dtype(kind).itemsize
    longest = classes.agg(F.max(F.length("vector"))).first()[0] or 1
    rows = max(1, min(sample_rows, n // 2, 64_000_000 // longest))
    drawn = kept(classes.select("node", "vector", F.xxhash64("node").alias("h")), "embedding-drawn")
    picked = drawn.orderBy("h", "node").limit(rows).collect()
    k = 2 ** int(np.clip(np.round(np.log2(max(1.0, np.sqrt(n)) / 4)), 1, 10))
    by_size = {size: _unit(values, kind) for size, values in _by_size(picked, width).items()}

    def fitted(k: int) -> Codebooks:
        each = {size: max(1, min(k, len(x) // 16)) for size, x in by_size.items()}
        return {
            size: (codebook(x[:, : size // 2], each[size]), codebook(x[:, size // 2 :], each[size])) for size, x in by_size.items()
        }

    books = fitted(k)
    linked: dict[int, list[np.ndarray]] = {}
    counts: list[np.ndarray] = []
    left, asked, found = drawn, 0, 0
    while asked < n and found < linked_queries:
        block = left.orderBy(F.desc("h"), F.desc("node")).limit(max(1, min(max(query_rows, asked), 8 * query_rows, 64_000_000 // longest))).collect()
        last = block[-1]
        left = drawn.filter((F.col("h") < last.h) | (F.col("h") == last.h) & (F.col("node") < F.lit(bytes(last.node))))
        asked += len(block)
        # Vectors of a length without codebooks are all compared with each other.
        queries = {size: _unit(values, kind) for size, values in _by_size(block, width).items() if size in books}
        for size, of in _ranks(classes, books, queries, threshold, most_steps, kind).items():
            some = of.sum(axis=1) > 0
            linked.setdefault(size, []).append(queries[size][some])
            counts.append(of[some])
            found += int(some.sum())
    if not found:
        return books, 1, 1.0  # every vector was asked, and none has a neighbour
    covered = _covered(np.concatenate(counts))
    # Within rounding, as the whole grid must count as all.
    while covered[-2] < recall - 1e-9:
        if k * k <= most_steps:
            raise ValueError(f"recall {covered[-2]} instead of {recall} in {most_steps} cells")
        k //= 2
        books = fitted(k)
        again = {size: np.concatenate(x) for size, x in linked.items()}
        covered = _covered(np.concatenate(list(_ranks(classes, books, again, threshold, most_steps, kind).values())))
    steps = int(np.argmax(covered[:-1] >= recall - 1e-9)) + 1
    return books, steps, float(covered[steps - 1])


def _by_size(rows: list, width: int) -> dict[int, list[bytes]]:
    found: dict[int, list[bytes]] = {}
    for row in rows:
        found.setdefault(len(row.vector) // width, []).append(bytes(row.vector))
    return found


def _linked(left: dict, right: dict, threshold: float, kind: str, within: bool):
    """Links of two blocks: (node, number of linked vectors, a node of its component in the block pair)."""
    x, y = _unit(left["vector"], kind), _unit(right["vector"], kind)
    alike = x @ y.T >= threshold
    if within and left["block"] == right["block"]:
        np.fill_diagonal(alike, False)
    r, c = np.nonzero(alike)
    if not within and len(r):
        # Of two vectors that visit each other's cells, the one of the smaller cell compares.
        mine, there = np.array(left["cell"])[r], right["cell"][0]
        visited = [set(v) for v in right["visits"]]
        stays = np.array([a < there or a not in visited[j] for a, j in zip(mine.tolist(), c.tolist())], bool)
        r, c = r[stays], c[stays]
    if not len(r):
        return [], [], []
    own = within and left["block"] == right["block"]
    a, b = np.array(left["copies"]), np.array(right["copies"])
    offset = 0 if own else len(x)
    total = np.zeros(len(x) + (0 if own else len(y)))
    np.add.at(total, r, b[c])
    if not own:
        np.add.at(total, offset + c, a[r])
    label = np.arange(len(total))
    while True:
        least = np.minimum(label[r], label[offset + c])
        after = label.copy()
        np.minimum.at(after, r, least)
        np.minimum.at(after, offset + c, least)
        if (after == label).all():
            break
        label = after
    nodes = left["node"] + ([] if own else right["node"])
    rows = np.flatnonzero(total)
    return [nodes[i] for i in rows], total[rows].astype(np.int64).tolist(), [nodes[label[i]] for i in rows]


MEMBER = "array<struct<node:binary,vector:binary,copies:bigint,cell:int,visits:array<int>>>"


def _blocks(rows: DataFrame, cell: str, block_rows: int) -> DataFrame:
    """(size, at, block, n_blocks, members): the rows of a cell in blocks of about ``block_rows``, by a hash of the node."""
    counts = kept(rows.groupBy("size", F.col(cell).alias("at")).agg(F.count("*").alias("n")), "embedding-cells")
    many = F.ceil(F.col("n") / block_rows).cast("int")
    dealt = rows.withColumn("at", F.col(cell)).join(counts, ["size", "at"]).withColumn("n_blocks", many)
    member = F.struct("node", "vector", "copies", "cell", "visits")
    return dealt.groupBy("size", "at", F.pmod(F.xxhash64("node"), "n_blocks").cast("int").alias("block"), "n_blocks").agg(
        F.collect_list(member).alias("members")
    )


def _compared(pairs: DataFrame, threshold: float, kind: str, within: bool) -> DataFrame:
    """(node, links, other) of pairs of blocks (left_block, left, right_block, right)."""

    def columns(members: pa.Array, block: int) -> dict:
        flat = members.values if isinstance(members, pa.ListScalar) else members
        return {name: flat.field(name).to_pylist() for name in ("node", "vector", "copies", "cell", "visits")} | {"block": block}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                left = columns(batch.column(1)[i], batch.column(0)[i].as_py())
                right = columns(batch.column(3)[i], batch.column(2)[i].as_py())
                nodes, links, others = _linked(left, right, threshold, kind, within)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes, pa.binary()), pa.array(links, pa.int64()), pa.array(others, pa.binary())],
                    names=["node", "links", "other"],
                )

    ready = pairs.select("left_block", "left", "right_block", "right")
    return ready.mapInArrow(run, "node binary, links long, other binary")


def embedding_duplicates(
    vectors: DataFrame,
    threshold: float = 0.95,
    recall: float = 0.9995,
    block_rows: int = 1_024,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id and the index's ``steps`` and ``measured_recall``."""
    kind = "<f4" if "float" in vectors.schema[vector_column].dataType.simpleString() else "<f8"
    element = "float" if kind == "<f4" else "double"
    cast = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast(f"array<{element}>").alias("v"))
    rows = kept(_classes(cast, kind), "embedding-rows")
    grouped = rows.filter(F.col("node").isNotNull()).groupBy("node")
    classes = kept(
        grouped.agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"), F.max("vector").alias("vector")),
        "embedding-classes",
    )
    books, steps, measured = fit_index(classes, kind, threshold, recall)
    placed = kept(_placed(classes, books, steps, kind), "embedding-placed")
    index = kept(_blocks(placed, "cell", block_rows), "embedding-blocks")
    others = F.filter(F.sequence(F.lit(0), F.col("n_blocks") - 1), lambda j: j >= F.col("left_block"))
    right = index.select("size", "at", F.col("block").alias("right_block"), F.col("members").alias("right"))
    own = index.filter((F.col("n_blocks") > 1) | (F.size("members") > 1)).select(
        "size", "at", "n_blocks", F.col("block").alias("left_block"), F.col("members").alias("left")
    )
    inside = own.withColumn("right_block", F.explode(others)).join(right, ["size", "at", "right_block"])
    visitors = placed.withColumn("target", F.explode("visits")).join(
        kept(placed.select("size", F.col("cell").alias("target")).distinct(), "embedding-targets"), ["size", "target"]
    )
    asking = _blocks(visitors, "target", block_rows).select(
        "size", "at", F.col("block").alias("left_block"), F.col("members").alias("left")
    )
    numbers = index.select("size", "at", "block").groupBy("size", "at").agg(F.collect_list("block").alias("there"))
    across = (
        asking.join(kept(numbers, "embedding-numbers"), ["size", "at"])
        .withColumn("right_block", F.explode("there"))
        .join(right, ["size", "at", "right_block"])
    )
    found = kept(
        _compared(inside, threshold, kind, True).unionByName(_compared(across, threshold, kind, False)), "embedding-links"
    )
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("u"), F.col("other").alias("v")))
    described = (
        classes.select("node", "first_id", "copies")
        .join(links, "node", "left")
        .join(roots, "node", "left")
        .select("node", "first_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("root", "node").alias("root"))
    )
    described = kept(described, "embedding-described")
    least = kept(described.groupBy("root").agg(F.min("first_id").alias("component_id")), "embedding-least")
    result = kept(described.join(least, "root").select("node", "links", "component_id"), "embedding-components")
    return rows.join(result, "node", "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.lit(steps).alias("steps"),
        F.lit(measured).alias("measured_recall"),
    )

"""Embedding whitening (12): principal components of unit variance by shifted Cholesky QR.

Vectors become whole numbers, floor(scale * c), and the fit list holds each distinct one once. With their number n and
their sums S, n * x - S is exact, so rows are centred without rounding before anything is multiplied (a constant added to
every x cancels there, so none is stored). The centred rows A are orthogonalised by passes over the fit list: a pass sums
the Gram matrix of A divided by the factors found so far (triangular solves inside the tasks), and its Cholesky factor is
the next one. The first Gram matrix is shifted by 11 (n d + d (d + 1)) u |A|^2, which keeps it positive however badly
conditioned A is; passes go on until the Gram matrix is near the identity, so that the last factor is accurate. The
product R of the factors has A's singular values and right vectors, and its SVD takes the condition of A, not of A'A.

The driver holds d * d numbers a pass, never rows. Every length of vector is a population of its own.

Defined cases: vectors that are null or hold null or non-finite components are left out; empty vectors have no
components. Components numbered beyond the length do not exist. Along a component without variance whitened is 0, and the
identity is measured over the others. Numbers beyond +-2 ** 40 after scaling count as 2 ** 40. Rows without an id and
repeated rows are returned like any other; equal vectors count once in the fit. A deviation that no long holds is null.
Extra columns are left out. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablebridge.llm.common import kept
from tablebridge.llm.grams import blocks, finite, gram, steps_of

FARTHEST = 1 << 40
UNIT = 2.0**-53
PASSES = 8
ROW = "vec_id long, size int, n long, deviation long, whitened array<double>"


@dataclass
class Whitening:
    """Centre and components of the vectors of one length; ``values`` are all eigenvalues, ``directions`` the kept ones."""

    size: int
    n: int
    sums: list[int]
    reach: int  # no component is larger, or farther from another one, than this
    values: np.ndarray
    directions: np.ndarray
    identity_error: float = 0.0

    def numerators(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact; Python's own integers where 64 bits might not do."""
        if self.n * self.reach < 1 << 61:
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.numerators(x).astype(np.float64) / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        apart = self.numerators(x)
        if apart.dtype != object and self.size * (self.n * self.reach) ** 2 < 1 << 63:
            return (apart * apart).sum(axis=1).tolist()
        totals = [sum(int(v) ** 2 for v in row) for row in apart]
        return [total if total < 1 << 63 else None for total in totals]

    def has_variance(self) -> np.ndarray:
        e = self.values[: self.directions.shape[1]]
        return e > self.values.max(initial=0) * (self.size * 1e-14) ** 2

    def whiten(self, x: np.ndarray) -> np.ndarray:
        alive = self.has_variance()
        scale = np.where(alive, 1 / np.sqrt(np.where(alive, self.values[: len(alive)], 1)), 0)
        return self.centred(x) @ self.directions * scale


def quantised(vectors: DataFrame, scale: int, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, x) of the usable vectors."""
    vector = F.col(vector_column)
    return vectors.filter(finite(vector)).select(F.col(id_column).cast("long").alias("vec_id"), steps_of(vector, scale, FARTHEST).alias("x"))


def _sums(fit: DataFrame, size: int) -> tuple[int, list[int], int]:
    """Number of rows, exact sum of each component and the widest range of one."""
    flush = 1 << 20  # rows whose sum 64 bits hold for certain

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(n, total, low, high):
            numbers = [np.arange(size), np.full(size, n), total, low, high]
            return pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in numbers], names=["j", "n", "total", "low", "high"])

        n = 0
        for batch in batches:
            for _, _, x in blocks(batch, 0, size):
                if n == 0:
                    total, low, high = np.zeros(size, np.int64), x.min(axis=0), x.max(axis=0)
                n += len(x)
                total = total + x.sum(axis=0)
                low, high = np.minimum(low, x.min(axis=0)), np.maximum(high, x.max(axis=0))
                if n >= flush:
                    yield row(n, total, low, high)
                    n = 0
        if n:
            yield row(n, total, low, high)

    parts = fit.select("x").mapInArrow(run, "j long, n long, total long, low long, high long")
    found = parts.groupBy("j").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    rows = sorted(found.collect())
    return rows[0].n, [int(r.total) for r in rows], max(max(r.high - r.low, abs(r.low), abs(r.high)) for r in rows)


def _factors(fit: DataFrame, model: Whitening) -> np.ndarray:
    """The product of the Cholesky factors: R with A = QR, Q orthonormal."""
    size, one = model.size, np.eye(model.size)
    solved: list[np.ndarray] = []

    def prepare(x: np.ndarray) -> np.ndarray:
        y = model.centred(x).T
        for r in solved:
            y = np.linalg.solve(r.T, y)
        return y.T

    product = one
    for turn in range(PASSES):
        g = gram(fit, "x", size, prepare)
        w, v = np.linalg.eigh(g)
        if w[-1] <= 0:
            return np.zeros((size, size))
        if turn and (np.all((np.abs(w - 1) < 1e-3) | (w < 1e-9)) or turn == PASSES - 1):
            # Orthonormal but for directions without variance, which no factor can make so.
            return (np.linalg.cholesky(g).T if w[0] > 0.5 else np.sqrt(np.maximum(w, 0))[:, None] * v.T) @ product
        shift = 11 * (model.n * size + size * (size + 1)) * UNIT * w[-1]
        r = np.linalg.cholesky(g if w[0] > shift and turn else g + shift * one).T
        product = r @ product
        solved.append(r)


def fit_whitening(fit: DataFrame, size: int, components: int = 16) -> Whitening:
    """The components of the distinct vectors ``x`` of one length."""
    n, sums, reach = _sums(fit, size)
    model = Whitening(size, n, sums, reach, np.zeros(size), np.eye(size)[:, :components])
    _, sigma, rows = np.linalg.svd(_factors(fit, model))
    largest = np.abs(rows).argmax(axis=1)
    directions = (rows * np.sign(rows[np.arange(size), largest])[:, None]).T
    model = Whitening(size, n, sums, reach, sigma**2 / n, directions[:, :components])
    alive = model.has_variance()
    if alive.any():
        # One more pass: the covariance of what comes out, centred by its own mean.
        with_one = gram(fit, "x", size, lambda x: np.column_stack([model.whiten(x)[:, alive], np.ones(len(x))]), int(alive.sum()) + 1) / n
        mean = with_one[:-1, -1]
        model.identity_error = float(np.abs(with_one[:-1, :-1] - np.outer(mean, mean) - np.eye(len(mean))).max())
    return model


def whitened(rows: DataFrame, model: Whitening) -> DataFrame:
    """(vec_id, size, n, deviation, whitened) of (vec_id, x), all of the model's length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, x in blocks(batch, 1, model.size):
                w = model.whiten(x)
                width = w.shape[1]
                offsets = pa.array(np.arange(0, width * (len(x) + 1), width) if width else np.zeros(len(x) + 1, int), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, to - at),
                        pa.array(np.full(len(x), model.size), pa.int32()),
                        pa.array(np.full(len(x), model.n), pa.int64()),
                        pa.array(model.deviations(x), pa.int64()),
                        pa.ListArray.from_arrays(offsets, pa.array(w.ravel())),
                    ],
                    names=[c.split()[0] for c in ROW.split(", ")],
                )

    return rows.select("vec_id", "x").mapInArrow(run, ROW)


def whiten(
    vectors: DataFrame, components: int = 16, scale: int = 64, id_column: str = "vec_id", vector_column: str = "embedding"
) -> tuple[DataFrame, dict[int, Whitening]]:
    """Every usable row whitened, and the models by vector length."""
    rows = kept(quantised(vectors, scale, id_column, vector_column), "whitening-rows")
    fit = kept(rows.select("x").distinct(), "whitening-fit")
    sizes = sorted(r.size for r in fit.select(F.size("x").alias("size")).distinct().collect() if r.size)
    models: dict[int, Whitening] = {}
    out = rows.sparkSession.createDataFrame([], ROW)
    for size in sizes:
        alike = F.size("x") == size
        models[size] = fit_whitening(fit.filter(alike), size, components)
        out = out.unionByName(whitened(rows.filter(alike), models[size])) if len(models) > 1 else whitened(rows.filter(alike), models[size])
    return out, models

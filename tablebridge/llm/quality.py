"""Quality classifier (7): a linear-chain conditional random field over the lines of a document.

Every line is good or bad. What speaks for either are signs of the line itself and of the lines before and after it (shares
of letters, capitals, marks, digits and spaces, word lengths, repeated words and lines, length), each cut into bins
with a weight per bin, and the step from one line's state to the next. Forward-backward gives each line the probability of
being good given all lines. Their mean, weighted by the lines' lengths, is the document's share of good text, and a logistic
curve fitted on a fold of its own turns it into a score.

Labels are given for documents, so in fitting all lines of a document have its label; the steps between states learn how
alike neighbours are. All arithmetic runs over many documents at a time.

Defined cases: a null text is an empty one; an empty text is one empty line; without labelled documents of both kinds every
score is the share of good ones among the labelled (0 if there are none); repeated rows are scored once each; extra columns
pass through. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tablebridge.llm.common import apart, portions
from tablebridge.llm.samples import labelled_sample, logistic

SIGNS = ("length", "letters", "capitals", "digits", "spaces", "stops", "marks", "pipes", "shouts", "word", "fresh", "echo", "again")
BINS = 12
KINDS = 8  # letters, capitals, digits, spaces, stops, pipes, shouts, other marks


def _kinds() -> np.ndarray:
    """The kind of each code point of the basic plane."""
    kind = np.zeros(65536, np.uint8)
    for code in range(65536):
        sign = chr(code)
        if sign.isupper():
            kind[code] = 1
        elif sign.isalpha():
            kind[code] = 0
        elif sign.isnumeric():
            kind[code] = 2
        elif sign.isspace():
            kind[code] = 3
        elif sign in ".,;:?'\"-()":
            kind[code] = 4
        elif sign == "|":
            kind[code] = 5
        elif sign == "!":
            kind[code] = 6
        else:
            kind[code] = 7
    return kind


_KIND: list[np.ndarray] = []


def line_signs(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signs, lines per text, code points per line): a row of SIGNS for every line of every text."""
    if not _KIND:
        _KIND.append(_kinds())
    lines, per_text, fresh, echo, again = [], [], [], [], []
    for text in texts:
        own = (text or "").split("\n")
        per_text.append(len(own))
        lines += own
        seen: set[str] = set()
        for line in own:
            words = line.split()
            fresh.append(len(set(words)) / len(words) if words else 1.0)
            echo.append(sum(map(eq, words, words[1:])) / len(words) if words else 0.0)
            again.append(1.0 if line in seen and line else 0.0)
            seen.add(line)
    codes = np.frombuffer("\n".join(lines).encode("utf-32-le", "replace"), "<u4")
    length = np.fromiter(map(len, lines), np.int64, len(lines))
    start = np.concatenate([[0], np.cumsum(length[:-1] + 1)]).astype(np.int64)
    kind = _KIND[0][np.minimum(codes, 65535)]
    line_of = np.repeat(np.arange(len(lines)), length + 1)[: len(codes)]
    counts = np.bincount(line_of * KINDS + kind, minlength=len(lines) * KINDS).reshape(len(lines), KINDS).astype(float)
    counts[:-1, 3] -= 1  # the joining line ends
    at_space = kind == 3
    begins = ~at_space
    begins[1:] &= at_space[:-1]
    words = np.maximum(1, np.bincount(line_of[begins], minlength=len(lines)))
    n = np.maximum(1, length)
    letters = counts[:, 0] + counts[:, 1]
    signs = np.column_stack(
        [
            np.log1p(length),
            letters / n,
            counts[:, 1] / np.maximum(1, letters),
            counts[:, 2] / n,
            counts[:, 3] / n,
            counts[:, 4] / n,
            counts[:, 7] / n,
            counts[:, 5] / n,
            counts[:, 6] / n,
            (length - counts[:, 3]) / words,
            np.array(fresh),
            np.array(echo),
            np.array(again),
        ]
    )
    return signs, np.array(per_text), length


@dataclass
class QualityModel:
    """Bin bounds, weights and curve; a few kilobytes."""

    base: float = 0.0
    bounds: np.ndarray | None = None  # signs x (BINS - 1)
    weights: np.ndarray | None = None  # 3 x signs x (BINS + 1): the line before, itself, the line after; good against bad
    steps: np.ndarray | None = None  # 2 x 2 log-weights of state to state; 1 is good
    curve: tuple[float, float] | None = None


def _binned(signs: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.column_stack([np.searchsorted(bounds[k], signs[:, k], side="left") for k in range(len(bounds))])


def _neighbours(bins: np.ndarray, per_text: np.ndarray) -> list[np.ndarray]:
    """Bins of the line before, the line itself and the line after; ``BINS`` where there is none."""
    ends = np.cumsum(per_text)
    before, after = np.full_like(bins, BINS), np.full_like(bins, BINS)
    before[1:], after[:-1] = bins[:-1], bins[1:]
    before[ends - per_text], after[ends - 1] = BINS, BINS
    return [before, bins, after]


def _evidence(near: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
    signs = np.arange(weights.shape[1])
    return sum(weights[side][signs, near[side]].sum(axis=1) for side in range(3))


def marginals(evidence: np.ndarray, per_text: np.ndarray, steps: np.ndarray):
    """P(good) per line, expected state-to-state counts (over all texts), and the log partition of each text.

    Forward-backward over all texts side by side: the t-th step treats the t-th line of every text that has one. Texts
    go in order of length, so those still running are always the first ones.
    """
    order = np.argsort(-per_text, kind="stable")
    start = (np.cumsum(per_text) - per_text)[order]
    count = per_text[order]
    longest = int(count[0])
    running = np.searchsorted(-count, -np.arange(longest), side="left")  # texts with more than t lines
    scale = np.exp(steps)
    half = np.clip(evidence, -40, 40) / 2
    local = np.exp(np.stack([-half, half], axis=1))  # weights of bad and good
    forward = np.empty((len(evidence), 2))
    norm = np.empty(len(evidence))
    for t in range(longest):
        rows = start[: running[t]] + t
        f = local[rows] if t == 0 else (forward[rows - 1] @ scale) * local[rows]
        norm[rows] = f.sum(axis=1)
        forward[rows] = f / norm[rows][:, None]
    backward = np.ones((len(evidence), 2))
    moves = np.zeros((2, 2))
    for t in range(longest - 2, -1, -1):
        rows = start[: running[t + 1]] + t
        onward = local[rows + 1] * backward[rows + 1] / norm[rows + 1][:, None]
        moves += scale * (forward[rows].T @ onward)
        backward[rows] = onward @ scale.T
    joint = forward * backward
    good = joint[:, 1] / joint.sum(axis=1)
    return good, moves, np.log(norm)


def fit_chain(near, per_text, y, weights_shape, rounds: int = 120, ridge: float = 1e-3):
    """Weights and steps that make the labels of all lines most likely, by gradient steps of an adaptive size."""
    labels = np.repeat(y, per_text).astype(float)
    lines = len(labels)
    inner = np.ones(lines, bool)
    inner[(np.cumsum(per_text) - 1)] = False
    moved = np.zeros((2, 2))
    seen = np.repeat(y, per_text).astype(int)
    np.add.at(moved, (seen[:-1][inner[:-1]], seen[1:][inner[:-1]]), 1)
    weights, steps = np.zeros(weights_shape), np.zeros((2, 2))
    first = [np.zeros(weights_shape), np.zeros((2, 2))]
    second = [np.zeros(weights_shape), np.zeros((2, 2))]
    signs = weights_shape[1]
    flat = [near[side] + np.arange(signs) * weights_shape[2] for side in range(3)]
    for step in range(1, rounds + 1):
        good, moves, _ = marginals(_evidence(near, weights), per_text, steps)
        off = (labels - good) / lines
        slope = np.stack(
            [
                np.bincount(flat[side].ravel(), np.repeat(off, signs), minlength=signs * weights_shape[2]).reshape(signs, -1)
                for side in range(3)
            ]
        )
        slopes = [slope - ridge * weights, (moved - moves) / lines - ridge * steps]
        for k, value in enumerate((weights, steps)):
            first[k] = 0.9 * first[k] + 0.1 * slopes[k]
            second[k] = 0.99 * second[k] + 0.01 * slopes[k] ** 2
            value += 0.1 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return weights, steps


def good_share(texts: list[str | None], model: QualityModel) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(share of good text per text, P(good) per line, lines per text, code points per line)."""
    signs, per_text, length = line_signs(texts)
    near = _neighbours(_binned(signs, model.bounds), per_text)
    good, _, _ = marginals(_evidence(near, model.weights), per_text, model.steps)
    weight = np.maximum(1, length)
    starts = np.cumsum(per_text) - per_text
    share = np.add.reduceat(good * weight, starts) / np.add.reduceat(weight, starts)
    return share, good, per_text, length


def _log_odds(share: np.ndarray) -> np.ndarray:
    share = np.clip(share, 1e-6, 1 - 1e-6)
    return np.log(share / (1 - share))


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    rows: int = 12_000,
    label: str = "quality",
    id_column: str = "doc_id",
    text_column: str = "text",
    most_lines: int = 200,
) -> QualityModel:
    """Fit on at most ``rows`` labelled documents, and of each at most ``most_lines`` lines that follow each other, from a place
    that its hash draws: the documented bounds of the sample. ``labels`` must hold no test rows.

    The lines' signs are taken on the executors; the driver gets a dozen short numbers for each line of the sample.
    """
    sample = labelled_sample(docs, labels, label, rows, id_column, text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, 0, rows=500):
                signs, per_text, length = line_signs(part.column(0).to_pylist())
                ends, few = np.cumsum(per_text), np.minimum(per_text, most_lines)
                drawn = part.column(3).to_numpy(zero_copy_only=False) % (per_text - few + 1)
                begins = ends - per_text + drawn
                packed = signs.astype("<f4")
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(1),
                        part.column(2),
                        pa.array([packed[b : b + n].tobytes() for b, n in zip(begins, few)], pa.binary()),
                        pa.array([length[b : b + n].astype("<i8").tobytes() for b, n in zip(begins, few)], pa.binary()),
                    ],
                    names=["label", "fold", "signs", "length"],
                )

    place = F.pmod(F.xxhash64(F.lit("lines"), "doc_id"), F.lit(1 << 40)).alias("place")
    found = sample.select("text", "label", "fold", place).mapInArrow(run, "label int, fold int, signs binary, length binary").collect()
    y = np.array([int(row.label > 0) for row in found])
    model = QualityModel(base=float(y.mean()) if len(y) else 0.0)
    learn = np.array([row.fold > 0 for row in found], bool)
    if len(set(y[learn])) < 2:
        return model
    per_text = np.array([len(row.length) // 8 for row in found])
    length = np.frombuffer(b"".join(row.length for row in found), "<i8")
    signs = np.frombuffer(b"".join(row.signs for row in found), "<f4").reshape(-1, len(SIGNS))
    of_learn = np.repeat(learn, per_text)
    # Bounds by the quantiles of bad and good lines alike, so that rare signs of either kind have bins of their own.
    line_y = np.repeat(y, per_text)
    bounds = []
    for k in range(len(SIGNS)):
        cuts = [np.quantile(signs[of_learn & (line_y == kind), k], [0.05, 0.2, 0.4, 0.6, 0.8, 0.95][kind::2]) for kind in (0, 1)]
        cuts.append(np.quantile(signs[of_learn, k], [0.02, 0.1, 0.5, 0.9, 0.98]))
        bounds.append(np.sort(np.concatenate(cuts))[: BINS - 1])
    model.bounds = np.array(bounds)
    near = _neighbours(_binned(signs, model.bounds), per_text)
    shape = (3, len(SIGNS), BINS + 1)
    model.weights, model.steps = fit_chain([x[of_learn] for x in near], per_text[learn], y[learn], shape)
    good, _, _ = marginals(_evidence(near, model.weights), per_text, model.steps)
    weight = np.maximum(1, length)
    starts = np.cumsum(per_text) - per_text
    share = np.add.reduceat(good * weight, starts) / np.add.reduceat(weight, starts)
    tune = ~learn if len(set(y[~learn])) == 2 else np.ones(len(y), bool)
    model.curve = tuple(float(b) for b in logistic(_log_odds(share[tune])[:, None], y[tune].astype(float)))
    return model


RESULT = "struct<score:double,good_share:double,lines:array<double>>"


def score_quality(docs: DataFrame, model: QualityModel, text_column: str = "text", result: str = "quality") -> DataFrame:
    """``docs`` with a struct: ``score`` (likelihood of label 1), ``good_share`` and P(good) of each of its ``lines``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @arrow_udf(RESULT)
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value

        def some(texts: list[str | None]) -> pa.Array:
            if model.curve is None:
                rows = [{"score": model.base, "good_share": model.base, "lines": []} for _ in texts]
                return pa.array(rows, KIND)
            share, good, per_text, _ = good_share(texts, model)
            a, b = model.curve
            score = 1 / (1 + np.exp(-np.clip(a * _log_odds(share) + b, -30, 30)))
            offsets = np.concatenate([[0], np.cumsum(per_text)]).astype(np.int32)
            lines = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(good, pa.float64()))
            return pa.StructArray.from_arrays([pa.array(score), pa.array(share), lines], names=["score", "good_share", "lines"])

        for texts in batches:
            whole = pa.RecordBatch.from_arrays([texts], names=["text"])
            parts = [some(part.column(0).to_pylist()) for part in portions(whole, 0, rows=250)]
            yield pa.concat_arrays(parts) if parts else pa.array([], KIND)

    return apart(docs, result, keep=(text_column,)).withColumn(result, scored(F.col(text_column).cast("string")))


KIND = pa.struct([("score", pa.float64()), ("good_share", pa.float64()), ("lines", pa.list_(pa.float64()))])

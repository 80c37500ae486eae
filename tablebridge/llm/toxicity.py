"""Toxicity (5): maximum-scoring segments of token log-odds.

Every word has a log-odds of standing in a toxic document against a clean one. Its estimate starts from that of the
word's first letters (three, four, five of them, each a Dirichlet prior for the next) and counts documents, so a rare word
stays near its stem and a stem stays near the corpus. Less a drift, word scores are negative on average, and the linear
scan of Ruzzo and Tompa finds every maximal segment: the passages that hold more evidence than anything around them.

Segment scores of clean text follow an extreme-value law: a text of n words holds K * n * exp(-lambda * S) clean segments of
score S or more. Lambda solves the law's own equation for the word scores of clean documents, K fits their best segments. A
passage is significant if that expectation is small, whatever the text's length. A logistic curve over the calibrated best
and total of a document, fitted on a fold of its own, gives the score.

Defined cases: null, empty and wordless texts have no passage, and the score of a text without any; without labelled
documents of both kinds every score is the share of toxic ones among the labelled (0 if there are none); repeated rows are
scored once each; extra columns pass through. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tablebridge.llm.common import apart, portions
from tablebridge.llm.samples import labelled_sample, logistic

WORDS = re.compile(r"[^\W\d_]+")
STEMS = (3, 4, 5)  # letters of the stems, each the prior of the next, the last that of the word
PRIOR = 5.0  # documents that a prior counts as
CACHED = 100_000


@dataclass
class ToxicModel:
    """Word scores and the law of clean segments; ``shares`` is bounded by the fitting sample."""

    shares: dict[str, float] = field(default_factory=dict)
    drift: float = 1.0
    rate: float = 1.0  # lambda
    size: float = 1.0  # K
    curve: tuple[float, float, float] | None = None
    base: float = 0.0

    def word_score(self, word: str) -> float:
        shares = self.shares
        if (known := shares.get(word + "$")) is not None:
            return known - self.drift
        for n in reversed(STEMS):
            if len(word) >= n and (known := shares.get(word[:n])) is not None:
                return known - self.drift
        return -self.drift


class Scores(dict):
    """Scores of words, found when first asked for."""

    def __init__(self, model: ToxicModel) -> None:
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        self[word] = score = self.model.word_score(word.lower())
        return score


def maximal_segments(scores: np.ndarray) -> list[tuple[float, int, int]]:
    """(score, first, last) of all maximal scoring segments, in order; linear in the number of scores.

    A segment is kept with the sums before and after it. One that lies higher than an earlier one with a lower start
    grows back to that start and swallows what is between.
    """
    places = np.flatnonzero(scores > 0)
    if not len(places):
        return []
    sums = np.cumsum(scores)
    after = sums[places].tolist()
    before = (sums[places] - scores[places]).tolist()
    stack: list[tuple[float, float, int, int, int]] = []  # before, after, first, last, nearest lower start
    for place, low, high in zip(places.tolist(), before, after):
        first = place
        at = len(stack) - 1
        while True:
            while at >= 0 and stack[at][0] >= low:
                at = stack[at][4]
            if at < 0 or stack[at][1] >= high:
                stack.append((low, high, first, place, at))
                break
            low, first = stack[at][0], stack[at][2]
            del stack[at:]
            at = len(stack) - 1
    return [(high - low, first, last) for low, high, first, last, _ in stack]


def _counted(sample: DataFrame) -> DataFrame:
    """(token, toxic, clean): documents of the sample that have the stem or word (a word ends in ``$``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = {w.lower() for w in WORDS.findall(text)}
                tokens = {w + "$" for w in words}
                for n in STEMS:
                    tokens.update(w[:n] for w in words if len(w) >= n)
                counts[1 if label else 0].update(tokens)
        tokens = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(tokens, pa.string()),
                pa.array([counts[1][t] for t in tokens], pa.int64()),
                pa.array([counts[0][t] for t in tokens], pa.int64()),
            ],
            names=["token", "toxic", "clean"],
        )

    made = sample.select("text", "label").mapInArrow(run, "token string, toxic long, clean long")
    return made.groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _log_odds(counts: list[tuple[str, int, int]], toxic: int, clean: int) -> dict[str, float]:
    """Log-odds of stems and words, only where they tell more than their prior does."""
    root = toxic / (toxic + clean)
    by_length: dict[int, list[tuple[str, int, int]]] = {n: [] for n in (*STEMS, 0)}
    for token, y, n in counts:
        by_length[0 if token.endswith("$") else len(token)].append((token, y, n))
    shares: dict[str, float] = {}

    def prior(token: str, n: int) -> float:
        for m in reversed([m for m in STEMS if n == 0 or m < n]):
            if (found := shares.get(token[:m])) is not None and len(token) >= m:
                return found
        return 0.0

    base = np.log(root / (1 - root))
    for n in (*STEMS, 0):
        for token, y, x in by_length[n]:
            above = prior(token.rstrip("$"), n)
            share = 1 / (1 + np.exp(-(above + base)))
            alpha, beta = PRIOR * share, PRIOR * (1 - share)
            odds = np.log((y + alpha) / (x + beta)) - base
            if abs(odds - above) > 1.28 * np.sqrt(1 / (y + alpha) + 1 / (x + beta)):
                shares[token] = float(odds)
    return shares


def word_values(words: list[str], scores: Scores) -> np.ndarray:
    """Scores of the words in order; a word right after itself is no further evidence."""
    values = np.fromiter(map(scores.__getitem__, words), float, len(words))
    for i in np.flatnonzero((values[1:] == values[:-1]) & (values[1:] > 0)).tolist():
        if words[i + 1].lower() == words[i].lower():
            values[i + 1] = 0.0
    return values


def segments_of(text: str, scores: Scores) -> tuple[list[tuple[float, int, int]], int]:
    words = WORDS.findall(text)
    return maximal_segments(word_values(words, scores)), len(words)


def summary(segments: list[tuple[float, int, int]], n: int, model: ToxicModel) -> tuple[float, float]:
    """The best segment and the sum of all, as calibrated evidence (0: what clean text is expected to show)."""
    if not segments:
        return 0.0, 0.0
    free = np.log(max(model.size * n, 1e-9))
    over = [max(0.0, model.rate * s - free) for s, _, _ in segments]
    return max(over), sum(over)


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, rows: int = 20_000, label: str = "toxic", id_column: str = "doc_id", text_column: str = "text"
) -> ToxicModel:
    """Fit on at most ``rows`` labelled documents, the documented bound of the sample. ``labels`` must hold no test rows."""
    sample = labelled_sample(docs, labels, label, rows, id_column, text_column)
    kinds = {row.label: row["count"] for row in sample.groupBy((F.col("label") > 0).cast("int").alias("label")).count().collect()}
    toxic, clean = kinds.get(1, 0), kinds.get(0, 0)
    model = ToxicModel(base=toxic / max(1, toxic + clean))
    learn, tune = sample.filter("fold > 0"), sample.filter("fold = 0")
    sizes = {row.label: row["count"] for row in learn.groupBy((F.col("label") > 0).cast("int").alias("label")).count().collect()}
    if not sizes.get(1) or not sizes.get(0):
        return model
    counts = _counted(learn).filter("toxic + clean >= 3")
    model.shares = _log_odds([tuple(row) for row in counts.toLocalIterator()], sizes[1], sizes[0])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per document of the tuning fold: label, words, its best segment; and for clean ones a histogram of word scores."""
        scores = Scores(shared.value)
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = WORDS.findall(text)
                values = word_values(words, scores)
                best = max((s for s, _, _ in maximal_segments(values)), default=0.0)
                bins, many = np.unique(np.round(values, 1), return_counts=True) if label == 0 else ([], [])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([label], pa.int32()),
                        pa.array([len(words)], pa.int64()),
                        pa.array([best], pa.float64()),
                        pa.array([list(map(float, bins))], pa.list_(pa.float64())),
                        pa.array([list(map(int, many))], pa.list_(pa.int64())),
                    ],
                    names=["label", "n", "best", "bins", "many"],
                )

    schema = "label int, n long, best double, bins array<double>, many array<long>"
    tuned = tune.select("text", "label").mapInArrow(run, schema).collect()
    if not any(row.label for row in tuned) or all(row.label for row in tuned):
        tune = sample
        tuned = tune.select("text", "label").mapInArrow(run, schema).collect()
    histogram: Counter = Counter()
    for row in tuned:
        if not row.label:
            histogram.update(dict(zip(row.bins, row.many)))
    model.rate = _rate(histogram)
    best = [(row.best, row.n) for row in tuned if not row.label and row.n]
    if best:
        s, n = np.array(best).T
        model.size = float(np.exp(np.mean(model.rate * s - np.log(n)) - np.euler_gamma))
    calibrated = docs.sparkSession.sparkContext.broadcast(model)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The evidence of a document from all of its segments, as scoring takes it."""
        model = calibrated.value
        scores = Scores(model)
        for batch in batches:
            found = [summary(*segments_of(text, scores), model) for text in batch.column(0).to_pylist()]
            columns = [batch.column(1), *(pa.array([x[i] for x in found], pa.float64()) for i in range(2))]
            yield pa.RecordBatch.from_arrays(columns, names=["label", "best", "total"])

    weighed = tune.select("text", "label").mapInArrow(weigh, "label int, best double, total double").collect()
    x = np.array([(row.best, np.log1p(row.total)) for row in weighed])
    beta = logistic(x, np.array([float(row.label > 0) for row in weighed]))
    model.curve = tuple(float(b) for b in beta)
    return model


def _rate(histogram: Counter) -> float:
    """Lambda, the positive root of E[exp(lambda * score)] = 1 over the words of clean text."""
    values = np.array(sorted(histogram), float)
    many = np.array([histogram[v] for v in sorted(histogram)], float)
    if not len(values) or values.max() <= 0:
        return 1.0
    share = many / many.sum()
    low, high = 1e-6, 50.0 / values.max()
    over = lambda rate: np.log((share * np.exp(rate * values)).sum())
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if over(middle) < 0 else (low, middle)
    return float(low)


RESULT = "struct<score:double,words:bigint,passages:array<struct<start:bigint,length:bigint,score:double,expected:double>>>"
PASSAGE = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())])
KIND = pa.struct([("score", pa.float64()), ("words", pa.int64()), ("passages", pa.list_(PASSAGE))])


def score_toxicity(
    docs: DataFrame, model: ToxicModel, text_column: str = "text", expected: float = 0.01, result: str = "toxicity"
) -> DataFrame:
    """``docs`` with a struct: ``score``, ``words`` and the significant ``passages`` (places in code points of the text).

    A passage is listed if clean text of that length holds fewer than ``expected`` segments of its score.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @arrow_udf(RESULT)
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        scores = Scores(model)

        def one(text: str | None) -> tuple[float, int, list[dict]]:
            segments, n = segments_of(text or "", scores)
            if model.curve is None:
                return model.base, n, []
            best, total = summary(segments, n, model)
            a, b, c = model.curve
            score = float(1 / (1 + np.exp(-np.clip(a * best + b * np.log1p(total) + c, -30, 30))))
            limit = (np.log(max(model.size * n, 1e-9)) - np.log(expected)) / model.rate
            found = [x for x in segments if x[0] >= limit]
            if not found:
                return score, n, []
            places = [m.span() for m in WORDS.finditer(text)]
            return score, n, [
                {
                    "start": places[first][0],
                    "length": places[last][1] - places[first][0],
                    "score": s,
                    "expected": float(model.size * n * np.exp(-model.rate * s)),
                }
                for s, first, last in found
            ]

        def some(texts: list[str | None]) -> pa.Array:
            if len(scores) > CACHED:
                scores.clear()
            rows = list(map(one, texts))
            columns = [pa.array([x[i] for x in rows], kind.type) for i, kind in enumerate(KIND)]
            return pa.StructArray.from_arrays(columns, names=["score", "words", "passages"])

        for texts in batches:
            whole = pa.RecordBatch.from_arrays([texts], names=["text"])
            parts = [some(part.column(0).to_pylist()) for part in portions(whole, 0)]
            yield pa.concat_arrays(parts) if parts else pa.array([], KIND)

    return apart(docs, result, keep=(text_column,)).withColumn(result, scored(F.col(text_column).cast("string")))

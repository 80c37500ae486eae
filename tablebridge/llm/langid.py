"""Language identification (9): unigram piece models, marginalised over all segmentations.

Every language has a probability for each piece of a fixed public vocabulary. The likelihood of a word is the sum over all
ways to cut it into pieces, which a forward pass adds up position by position; that of a text is the product over its
words. The probabilities are learnt by expectation-maximisation: expected uses of each piece over all segmentations of the
words of a language's sample, summed in Spark, then normalised.

A word of letters is lower-cased and opened by the vocabulary's word mark. A letter that is no piece of its own counts as
the unknown piece. Words of more than 40 letters are read as several of 40, the mark on the first alone.

Defined cases: null texts and texts without a letter are ``und`` with score 0; texts without a language and null texts teach
nothing; equal likelihoods go to the language that comes first; with no language learnt every text is ``und``; repeated rows
are scored once each; extra columns pass through. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tablebridge.llm.common import apart, kept

WORDS = re.compile(r"[^\W\d_]+")
MARK = "▁"
LONGEST_WORD, LONGEST_PIECE = 40, 16
UNKNOWN = 0  # the vocabulary's own unknown piece
UNDETERMINED = "und"


def pieces_of(path: str) -> list[str]:
    """The pieces of a public vocabulary file, by number."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i) for i in range(model.get_piece_size())]


class Vocabulary:
    """Numbers of pieces, found for many words at a time by hashes of their letters."""

    BASE = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, pieces: list[str]) -> None:
        plain = {p: i for i, p in enumerate(pieces) if 0 < len(p) <= LONGEST_PIECE and not p.startswith("<")}
        self.longest = max(map(len, plain), default=1)
        codes, length = self._codes(list(plain))
        hashes = self._ends(codes)[np.arange(len(plain)), length]
        order = np.argsort(hashes)
        self.hashes, self.numbers = hashes[order], np.array(list(plain.values()), np.int32)[order]
        self.lengths = length[order]

    @staticmethod
    def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Code points plus one, padded with zeros, and lengths."""
        length = np.fromiter(map(len, words), np.int64, len(words))
        codes = np.zeros((len(words), int(length.max(initial=1))), np.uint64)
        flat = np.frombuffer("".join(words).encode("utf-32-le", "replace"), "<u4")
        codes[np.arange(codes.shape[1]) < length[:, None]] = flat.astype(np.uint64) + np.uint64(1)
        return codes, length

    def _ends(self, codes: np.ndarray) -> np.ndarray:
        """Hash of the first j letters in column j."""
        ends = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
        mixed = (codes ^ (codes << np.uint64(17))) * np.uint64(0xBF58476D1CE4E5B9)
        with np.errstate(over="ignore"):
            for j in range(codes.shape[1]):
                ends[:, j + 1] = ends[:, j] * self.BASE + mixed[:, j]
        return ends

    def lattice(self, words: list[str]) -> tuple[list[tuple[int, int, np.ndarray, np.ndarray]], np.ndarray]:
        """(end, length, rows, piece numbers) for all pieces in the words, by end; and the words' lengths."""
        codes, length = self._codes(words)
        ends = self._ends(codes)
        found = []
        with np.errstate(over="ignore"):
            powers = [np.uint64(1)]
            for _ in range(self.longest):
                powers.append(powers[-1] * self.BASE)
            for end in range(1, int(length.max(initial=0)) + 1):
                live = np.flatnonzero(length >= end)
                for n in range(1, min(end, self.longest) + 1):
                    hashes = ends[live, end] - ends[live, end - n] * powers[n]
                    at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
                    hit = (self.hashes[at] == hashes) & (self.lengths[at] == n)
                    if n == 1:
                        found.append((end, 1, live, np.where(hit, self.numbers[at], UNKNOWN)))
                    elif hit.any():
                        found.append((end, n, live[hit], self.numbers[at[hit]]))
        return found, length


def split_words(text: str) -> list[str]:
    """Words with their mark, long ones in runs of LONGEST_WORD letters."""
    words = []
    for word in WORDS.findall(text.lower()):
        word = MARK + word
        words += [word] if len(word) <= LONGEST_WORD else [word[i : i + LONGEST_WORD] for i in range(0, len(word), LONGEST_WORD)]
    return words


def forward(words: list[str], vocabulary: Vocabulary, chances: np.ndarray):
    """Sums over all segmentations of every beginning of every word, per language: words x positions x languages."""
    lattice, length = vocabulary.lattice(words)
    sums = np.zeros((len(words), int(length.max(initial=0)) + 1, chances.shape[1]))
    sums[:, 0] = 1.0
    for end, n, rows, numbers in lattice:
        sums[rows, end] += sums[rows, end - n] * chances[numbers]
    return sums, lattice, length


def log_likelihoods(words: list[str], vocabulary: Vocabulary, chances: np.ndarray) -> np.ndarray:
    sums, _, length = forward(words, vocabulary, chances)
    return np.log(np.maximum(sums[np.arange(len(words)), length], 1e-300))


def expected_uses(words: list[str], counts: np.ndarray, vocabulary: Vocabulary, chances: np.ndarray) -> np.ndarray:
    """Expected uses of each piece over all segmentations of the words; ``chances`` and the result are of one language."""
    sums, lattice, length = forward(words, vocabulary, chances[:, None])
    sums = sums[:, :, 0]
    back = np.zeros_like(sums)
    rows = np.arange(len(words))
    back[rows, length] = counts / np.maximum(sums[rows, length], 1e-300)
    uses = np.zeros(len(chances))
    for end, n, at, numbers in reversed(lattice):
        onward = back[at, end] * chances[numbers]
        uses += np.bincount(numbers, sums[at, end - n] * onward, minlength=len(chances))
        np.add.at(back, (at, end - n), onward)
    return uses


@dataclass
class LanguageModel:
    languages: list[str]
    chances: np.ndarray  # pieces x languages
    vocabulary: Vocabulary | None


def fit_languages(
    docs: DataFrame,
    vocabulary_path: str,
    rows: int = 2_500,
    rounds: int = 3,
    smoothing: float = 0.05,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
) -> LanguageModel:
    """Fit on about ``rows`` documents of each language, the documented bound of the sample. ``docs`` must hold no test rows.

    A document is in the sample if a hash of its id lies below its language's share, so no language is sorted. Word
    counts and expected uses are summed in Spark; the driver holds a number for each piece and language.
    """
    spark = docs.sparkSession
    known = docs.filter(F.col(lang_column).isNotNull() & F.col(text_column).isNotNull()).select(
        F.col(lang_column).cast("string").alias("lang"),
        F.col(text_column).cast("string").alias("text"),
        F.shiftrightunsigned(F.xxhash64(F.lit("languages"), F.col(id_column), F.col(text_column)), 2).alias("hash"),
    )
    totals = {row.lang: row["count"] for row in known.groupBy("lang").count().collect()}
    languages = sorted(totals)
    vocabulary = Vocabulary(pieces := pieces_of(vocabulary_path))
    if not languages:
        return LanguageModel([], np.zeros((len(pieces), 0)), vocabulary)
    bound = F.create_map(
        *[x for lang in languages for x in (F.lit(lang), F.lit(int(min(1.0, rows / totals[lang]) * (1 << 62))))]
    )
    chosen = known.filter(F.col("hash") <= F.element_at(bound, F.col("lang"))).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts.update((lang, word) for word in split_words(text))
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.string()), pa.array(list(counts.values()), pa.int64())],
            names=["lang", "word", "n"],
        )

    words = chosen.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = kept(words, "language-words")
    at = {lang: i for i, lang in enumerate(languages)}
    # To begin with, a piece is as likely as its length is common: longer ones are rarer in any language.
    sizes = np.array([len(p) for p in pieces])
    start = np.exp(-0.5 * sizes.astype(float))
    chances = np.repeat((start / start.sum())[:, None], len(languages), axis=1)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((vocabulary, chances, at))

        def uses(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            vocabulary, chances, at = shared.value
            total = {}
            for batch in batches:
                langs = np.array(batch.column(0).to_pylist(), object)
                for lang in set(langs):
                    rows = pa.array(np.flatnonzero(langs == lang))
                    own, n = batch.column(1).take(rows).to_pylist(), batch.column(2).take(rows).to_numpy()
                    own, n = zip(*sorted(zip(own, n), key=lambda x: len(x[0])))
                    for i in range(0, len(own), 5_000):
                        part = expected_uses(list(own[i : i + 5_000]), np.array(n[i : i + 5_000], float), vocabulary, chances[:, at[lang]])
                        total[lang] = total.get(lang, 0) + part
            for lang, part in total.items():
                used = np.flatnonzero(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(part[used])],
                    names=["lang", "piece", "n"],
                )

        summed = words.mapInArrow(uses, "lang string, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
        chances = np.full((len(pieces), len(languages)), smoothing)
        for row in summed.toLocalIterator():
            chances[row.piece, at[row.lang]] += row.n
        chances /= chances.sum(axis=0)
    return LanguageModel(languages, chances, vocabulary)


class WordScores:
    """Log-likelihoods of words, kept by a Python worker for the words it has met; about 64 MB of numbers at most."""

    def __init__(self, model: LanguageModel) -> None:
        self.model = model
        self.most = max(1_000, min(600_000, 64_000_000 // (8 * max(1, len(model.languages)))))
        self.clear()

    def clear(self) -> None:
        self.row: dict[str, int] = {}
        self.values = np.zeros((0, len(self.model.languages)))

    def texts(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, posterior at equal priors) of each text."""
        if len(self.row) > self.most:
            self.clear()
        split = [WORDS.findall((text or "").lower()) for text in texts]
        row = self.row
        new = sorted({word for words in split for word in words if word not in row}, key=len)
        parts = []
        for i in range(0, len(new), 10_000):
            some = new[i : i + 10_000]
            if len(some[-1]) < LONGEST_WORD:
                parts.append(log_likelihoods([MARK + w for w in some], self.model.vocabulary, self.model.chances))
            else:
                runs = [split_words(w) for w in some]
                logs = log_likelihoods([r for x in runs for r in x], self.model.vocabulary, self.model.chances)
                starts = np.cumsum([0, *map(len, runs[:-1])])
                parts.append(np.add.reduceat(logs, starts))
        row.update(zip(new, range(len(row), len(row) + len(new))))
        self.values = np.concatenate([self.values, *parts]) if parts else self.values
        out = []
        for words in split:
            if not self.model.languages or not any(map(has_letter, words)):
                out.append((UNDETERMINED, 0.0))
                continue
            logs = self.values[np.fromiter(map(row.__getitem__, words), np.int64, len(words))].sum(axis=0)
            best = int(np.argmax(logs))
            out.append((self.model.languages[best], float(1 / np.exp(logs - logs[best]).sum())))
        return out


def has_letter(word: str) -> bool:
    return word.isalpha() or any(map(str.isalpha, word))


RESULT = "struct<lang:string,score:double>"


def identify(docs: DataFrame, model: LanguageModel, text_column: str = "text", result: str = "language") -> DataFrame:
    """``docs`` with a struct: the most likely ``lang`` and its ``score``, the posterior at equal priors."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @arrow_udf(RESULT)
    def identified(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scores = scores_of(shared)
        for texts in batches:
            rows = []
            for at in range(0, len(texts), 1_000):
                rows += scores.texts(texts.slice(at, 1_000).to_pylist())
            yield pa.StructArray.from_arrays(
                [pa.array([x[0] for x in rows], pa.string()), pa.array([x[1] for x in rows], pa.float64())], names=["lang", "score"]
            )

    return apart(docs, result, keep=(text_column,)).withColumn(result, identified(F.col(text_column).cast("string")))


_SCORES: dict[int, WordScores] = {}


def scores_of(shared) -> WordScores:
    """The worker's word scores for this model: kept from task to task, as most words come again."""
    model = shared.value
    if id(model) not in _SCORES:
        _SCORES.clear()
        _SCORES[id(model)] = WordScores(model)
    return _SCORES[id(model)]

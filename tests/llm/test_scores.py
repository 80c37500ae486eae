"""Toxicity, quality and language: held-out accuracy, exact parts against plain versions, and odd input."""

import itertools
import math
import random

import numpy as np
import public_tokenizers
import pytest
from llm_fixtures import corpus, nothing, prose, words  # noqa: F401

from tablebridge.llm.langid import MARK, Vocabulary, expected_uses, fit_languages, forward, identify, log_likelihoods
from tablebridge.llm.quality import fit_quality, line_signs, marginals, score_quality
from tablebridge.llm.samples import labelled_sample
from tablebridge.llm.toxicity import ToxicModel, fit_toxicity, maximal_segments, score_toxicity

PIECES = public_tokenizers.path("piece_bpe_32k.model")
INSULTS = ["zorg", "vlurb", "quax", "brimpo"]


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(400):
        toxic, poor = i % 5 == 0, i % 4 == 1
        own = prose(rng, ("en", "de")[i % 2], rng.randint(20, 150)).split(" ")
        if toxic:
            at = rng.randrange(len(own))
            own[at:at] = [rng.choice(INSULTS) + rng.choice(["", "en", "ix"]) for _ in range(rng.randint(4, 8))]
        text = " ".join(own)
        if poor:
            text = text.upper().replace(" ", "!! ") if i % 8 == 1 else text.replace(" ", " | ")
        rows.append((i, text))
        labels.append((i, int(not poor), int(toxic)))
    labels += [(5, None, None), (None, 1, 1), (0, 1, 1), (7, 1, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), {r[0]: r for r in labels if r[0] is not None and r[1] is not None}


def segments_by_definition(scores):
    """Maximal segments by their recursive definition: the best (then shortest) segment, then the same left and right of it."""
    best = max(
        ((sum(scores[i:j]), -(j - i), -i, i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=None
    )
    if best is None or best[0] <= 0:
        return []
    _, _, _, i, j = best
    left = [(s, a, b) for s, a, b in segments_by_definition(scores[:i])]
    right = [(s, a + j, b + j) for s, a, b in segments_by_definition(scores[j:])]
    return [*left, (sum(scores[i:j]), i, j - 1), *right]


def test_maximal_segments():
    rng = random.Random(1)
    for _ in range(300):
        scores = [rng.choice([-3.25, -1.5, -1.0625, 1.0, 2.125, 4.5, -0.0078125]) for _ in range(rng.randint(0, 14))]
        assert maximal_segments(np.array(scores)) == segments_by_definition(scores)


def test_toxicity(spark, labelled, corpus, nothing):
    docs, labels, truth = labelled
    model = fit_toxicity(docs, labels.filter("doc_id % 3 <> 0"))
    found = {r.doc_id: r for r in score_toxicity(docs, model).collect()}
    held = [i for i in found if i % 3 == 0]
    assert sum((found[i].toxicity.score >= 0.5) == bool(truth[i][2]) for i in held) >= 0.95 * len(held)
    passages = [(found[i].text[p.start : p.start + p.length].lower(), p) for i in held for p in found[i].toxicity.passages]
    assert all(p.expected < 0.01 and p.score > 0 and p.length > 0 for _, p in passages)
    assert sum(any(x in text for x in INSULTS) for text, _ in passages) >= 0.8 * len(passages) >= 16
    odd = score_toxicity(corpus, model).collect()
    assert len(odd) == corpus.count() and all(0 <= r.toxicity.score <= 1 for r in odd)
    assert score_toxicity(nothing, model).count() == 0
    blind = fit_toxicity(nothing, labels)
    assert {r.toxicity.score for r in score_toxicity(corpus, blind).collect()} == {0.0}


def test_quality(labelled, corpus, nothing):
    docs, labels, truth = labelled
    model = fit_quality(docs, labels.filter("doc_id % 3 <> 0"))
    found = {r.doc_id: r for r in score_quality(docs, model).collect()}
    held = [i for i in found if i % 3 == 0]
    assert sum((found[i].quality.score >= 0.3) == bool(truth[i][1]) for i in held) >= 0.95 * len(held)
    assert all(len(r.quality.lines) == r.text.count("\n") + 1 for r in found.values())
    odd = score_quality(corpus, model).collect()
    assert len(odd) == corpus.count() and all(0 <= r.quality.score <= 1 for r in odd)
    assert score_quality(nothing, model).count() == 0
    blind = fit_quality(nothing, labels)
    assert {r.quality.score for r in score_quality(corpus, blind).collect()} == {0.0}


def test_marginals_by_enumeration():
    rng = np.random.default_rng(4)
    per_text, steps = np.array([3, 1, 5, 3]), rng.normal(size=(2, 2))
    evidence = rng.normal(size=per_text.sum())
    good, moves, _ = marginals(evidence, per_text, steps)
    at, want_moves = 0, np.zeros((2, 2))
    for n in per_text:
        total, up, seen = 0.0, np.zeros(n), np.zeros((2, 2))
        for path in itertools.product((0, 1), repeat=int(n)):
            w = math.exp(sum((s - 0.5) * evidence[at + i] for i, s in enumerate(path)) + sum(steps[a, b] for a, b in zip(path, path[1:])))
            total += w
            up += w * np.array(path)
            for a, b in zip(path, path[1:]):
                seen[a, b] += w
        assert np.allclose(good[at : at + n], up / total)
        want_moves += seen / total
        at += n
    assert np.allclose(moves, want_moves)


def test_line_signs_are_those_of_each_line_alone():
    texts = [None, "", "a\n\nB!! | 3", "x x y\nx x y", "é\U0001f600 Ünd."]
    signs, per_text, length = line_signs(texts)
    assert per_text.tolist() == [1, 1, 3, 2, 1] and length.tolist() == [0, 0, 1, 0, 7, 5, 5, 7]
    rows = [line for text in texts for line in (text or "").split("\n")]
    for i, line in enumerate(rows):
        alone = line_signs([line])[0][0]
        assert np.allclose(signs[i][:-1], alone[:-1])
    assert signs[6][-1] == 1.0 and signs[5][-1] == 0.0


def test_sample_leaves_copies_out(corpus, spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(210)], "doc_id long, label int")
    found = labelled_sample(corpus, labels, "label", 1000).collect()
    ids = [r.doc_id for r in found]
    assert len({r.text for r in found if r.text.strip()}) == len([r for r in found if r.text.strip() and r.doc_id != 3]) + (3 in ids)
    assert sum(100 <= i < 146 for i in ids) <= 3
    assert labelled_sample(corpus, labels, "label", 10).count() <= 10


def test_forward_sums_all_segmentations():
    vocabulary = Vocabulary(["<unk>", MARK, MARK + "a", "a", "b", "ab", "ba", "bab", MARK + "ab"])
    chances = np.array([[0.01, 0.02], [0.1, 0.2], [0.2, 0.1], [0.15, 0.1], [0.1, 0.3], [0.2, 0.05], [0.1, 0.1], [0.09, 0.1], [0.05, 0.03]])
    number = {MARK: 1, MARK + "a": 2, "a": 3, "b": 4, "ab": 5, "ba": 6, "bab": 7, MARK + "ab": 8}

    def cuts(word):
        if not word:
            yield []
        for n in range(1, len(word) + 1):
            piece = number.get(word[:n], 0 if n == 1 else None)
            if piece is not None:
                for rest in cuts(word[n:]):
                    yield [piece, *rest]

    tried = [MARK + "abab", MARK + "a", MARK + "bxa", "babba"]
    logs = log_likelihoods(tried, vocabulary, chances)
    for lang in range(2):
        uses, mass = np.zeros(9), 0.0
        for i, word in enumerate(tried):
            ways = [(math.prod(chances[p, lang] for p in cut), cut) for cut in cuts(word)]
            total = sum(p for p, _ in ways)
            assert logs[i, lang] == pytest.approx(math.log(total))
            for p, cut in ways:
                for piece in cut:
                    uses[piece] += (i + 1) * p / total
        assert np.allclose(expected_uses(tried, np.arange(1.0, 5.0), vocabulary, chances[:, lang]), uses)
    assert forward([], vocabulary, chances)[0].shape[0] == 0


def test_language(corpus, nothing, spark):
    rng = random.Random(9)
    rows = [(i, " ".join(words(rng, lang := ("en", "de", "fr")[i % 3], 40)), lang) for i in range(150)]
    rows += [(900, None, "xx"), (901, "no language", None), (902, "12 !!", "de")]
    model = fit_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"), PIECES)
    assert model.languages == ["de", "en", "fr"] and np.allclose(model.chances.sum(axis=0), 1)
    for r in identify(corpus, model).collect():
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.language.lang == "und") == (not letters) and 0 <= r.language.score <= 1
        if r.lang and letters and len(r.text.split()) >= 5 and r.doc_id != 208:
            assert r.language.lang == r.lang
    assert identify(nothing, model).count() == 0
    empty = fit_languages(nothing, PIECES)
    assert {r.language.lang for r in identify(corpus, empty).collect()} == {"und"}

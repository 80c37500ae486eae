import random
import re

import pytest

from llm_fixtures import nothing  # noqa: F401

from tablebridge.llm.licenses import BASE_PHRASES, TEMPLATES, scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def files(spark):
    filler = "lorem ipsum dolor the software and the license of any person " * 30
    texts = [t.text.upper() for t in TEMPLATES] + [
        None,
        "",
        "MIT License. mit  license/mit\nlicense cc-by cc by",
        "gnu general public apache license gnu general public license",
        "Licensed under the Apache License, Version 2.0." + filler + "Licensed under CC BY-NC 4.0.",
        filler,
        "licénse mİt license K mit license",
        filler * 40 + "Released under the MIT License.",
        "permission is hereby granted free of charge but not more",
    ]
    return spark.createDataFrame([(i, t, "x", 3) for i, t in enumerate(texts)], "doc_id long, text string, found string, n int")


def test_base_places_and_labels(files):
    for r in scan(files).collect():
        words = WORD.findall((r.text or "").translate(LOWER))
        places = sorted(
            (i, label) for phrase, label in BASE_PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()
        )
        assert r.n_words == len(words) and sorted((p.place, p.label) for p in r.base) == places
        assert {label for _, label in places} <= set(r.labels) and r.labels == sorted(set(r.labels))
        for f in r.found:  # a template's key phrases stand at their places
            kinds = [t for t in TEMPLATES if t.label == f.label]
            assert any(all(words[f.place + at : f.place + at + len(key)] == key for at, key in t.key_places()) for t in kinds)
            assert 0 < f.share <= 1


def test_every_template_finds_itself(files):
    found = {r.doc_id: r for r in scan(files).collect()}
    for i, t in enumerate(TEMPLATES):
        assert t.label in found[i].labels and max(f.share for f in found[i].found) == 1.0
    n = len(TEMPLATES)
    assert {"apache-2.0", "cc-by-nc"} <= set(found[n + 4].labels) and not found[n + 5].labels
    assert "mit-released" in found[n + 7].labels and "mit-text" not in found[n + 8].labels


def test_long_files_keep_their_notices(spark):
    rng = random.Random(1)
    words = sorted({w for t in TEMPLATES for w in t.words})
    around = lambda n: " ".join(rng.choices(words, k=n))
    texts = [" ".join(t.text for t in TEMPLATES), *(f"{around(10_000)} {t.text} {around(10_000)}" for t in TEMPLATES)]
    # A corpus in which some template words are rarer than others.
    texts += [" ".join(rng.choices(words[: 1 + i], k=40)) for i in range(len(words))]
    found = {r.doc_id: r for r in scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert {t.label for t in TEMPLATES} <= set(found[0].labels)
    for i, t in enumerate(TEMPLATES, 1):
        assert (t.label, 10_000, 1.0) in [(f.label, f.place, f.share) for f in found[i].found]


def test_nothing(nothing):
    assert scan(nothing).count() == 0

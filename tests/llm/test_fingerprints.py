import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import corpus, nothing, rows_of  # noqa: F401

from tablebridge.llm.fingerprints import containment, edited, fingerprint, fingerprints, hashes_of, likeness, merged, resemblance, shingle_hashes, sketch, with_next


def test_equal_texts_have_equal_fingerprints(corpus):
    found = fingerprints(corpus).select("text", "fingerprint", "sketch").collect()
    by_text = {}
    for r in found:
        by_text.setdefault(r.text or "", set()).add(r.fingerprint)
        assert bool(r.sketch) == bool((r.text or "").split())
    assert all(len(x) == 1 for x in by_text.values())


def test_sketch_keeps_what_is_below_the_fraction(corpus):
    bound = -(1 << 63) + (1 << 64) // 8
    for r in corpus.select(sketch(F.col("text")).alias("s"), shingle_hashes(F.col("text"), 5).alias("h")).collect():
        below = sorted({x for x in r.h if x < bound})
        assert r.s == (below if len(below) >= 16 else sorted(set(r.h))[:16])


def test_likeness_against_exact_sets(spark):
    """Texts held whole by another, and texts with an edited end: exact while both are short, near the truth otherwise."""
    rng = random.Random(3)
    rows = []
    for n in (8, 12, 20, 60, 400):
        for _ in range(60):
            own = [f"w{rng.randrange(10**6)}" for _ in range(n)]
            changed = own[: n - n // 3] + [f"x{rng.randrange(10**6)}" for _ in range(n // 3)]
            longer = own + [f"y{rng.randrange(10**6)}" for _ in range(n // 4)]
            rows.append((n, " ".join(own), " ".join(changed), " ".join(longer)))
    docs = spark.createDataFrame(rows, "n int, a string, b string, c string")
    a, b, c = (sketch(F.col(x)) for x in "abc")
    h = [shingle_hashes(F.col(x), 5).alias(f"h{x}") for x in "abc"]
    found = docs.select("n", likeness(a, b).alias("like"), containment(a, c).alias("held"), resemblance(a, b).alias("j"), (likeness(a, a) == 1).alias("same"), *h).collect()
    off = {}
    for r in found:
        x, y = set(r.ha), set(r.hb)
        off.setdefault(r.n, []).append((abs(r.like - len(x & y) / min(len(x), len(y))), abs(r.j - len(x & y) / len(x | y)), r.held))
        assert r.same and set(r.ha) <= set(r.hc)
    for n, values in off.items():
        like, j, held = np.array(values).T
        assert like.mean() < 0.12 and j.mean() < 0.12 and held.min() == 1
        if n <= 12:
            assert like.max() == 0 and j.max() == 0


def test_merge_and_containment(spark):
    words = [f"w{i}" for i in range(4000)]
    whole, part = " ".join(words), " ".join(words[:400])
    both = " ".join(words[300:900])
    one = spark.createDataFrame([(whole, part, both)], "a string, b string, c string")
    a, b, c = (sketch(F.col(x)) for x in "abc")
    r = one.select(containment(b, a).alias("in_whole"), containment(b, c).alias("quarter"), likeness(a, b).alias("like"), resemblance(a, b).alias("j"), (hashes_of(fingerprint(a)) == a).alias("back"), (containment(c, merged(b, c))).alias("m")).first()
    assert r.in_whole == 1.0 and r.like == 1.0 and r.m == 1.0 and r.back
    assert r.quarter == pytest.approx(0.25, abs=0.12) and r.j == pytest.approx(0.1, abs=0.05)


def test_next_and_edited_text(corpus, rows_of):
    rows = [r for r in rows_of if r.doc_id is not None and not (r.doc_id == 3)]
    docs = corpus.filter("doc_id is not null and doc_id <> 3").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    for size in (3, 2000):
        found = with_next(docs, ["text"], rows_per_range=size).withColumn("e", edited(F.col("text"), F.col("next_text"))).collect()
        order = sorted(rows, key=lambda r: -r.doc_id)
        after = {a.doc_id: (b.text or "") for a, b in zip(order, order[1:] + order[:1])}
        assert len(found) == len(rows)
        for r in found:
            assert r.next_text == after[r.doc_id]
            half = len(r.text) // 2
            assert r.e == r.text[: len(r.text) - half] + r.next_text[:half]


def test_repeats_nulls_and_nothing(corpus, nothing):
    docs = corpus.select("doc_id", "text")
    assert with_next(docs, ["text"], rows_per_range=4).count() == corpus.count()
    assert with_next(nothing, ["text"]).count() == 0 and fingerprints(nothing).count() == 0
    single = corpus.filter("doc_id = 203").select("doc_id", "text")
    assert with_next(single, ["text"]).first().next_text == "one two"

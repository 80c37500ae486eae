import re
from itertools import permutations

import numpy as np
import pytest
from llm_fixtures import corpus, nothing, rows_of  # noqa: F401
from pyspark.sql import functions as F

from tablebridge.llm.filter_audit import REPEATED, audit, failure_cells, survivors, text_filters

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LABELS = "doc_id long, quality int, toxic int, text string, n long"


def failures(rows):
    """The set of letters that each (doc_id, text, lang) fails, straight from the definitions."""
    out = []
    for doc, text, _ in rows:
        text = text or ""
        words = WORD.findall(text)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": doc is not None and any(o is not None and o < doc and (t or "") == text for o, t, _ in rows),
        }
        out.append({k for k, bad in fails.items() if bad})
    return out


def brute(rows, labels):
    """Every order walked over every document."""
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, t in labels if t == 1}
    fails = failures(rows)
    out = set()
    for part in {lang or "" for _, _, lang in rows}:
        own = [(d, f) for (d, _, lang), f in zip(rows, fails) if (lang or "") == part]
        walked, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [x for x in left if letter in x[1]]
                left = [x for x in left if letter not in x[1]]
                shapley[letter] += len(gone)
                walked.append((order, step, letter, len(left), gone))
        for order, step, letter, kept, gone in walked:
            failing = sum(letter in f for _, f in own)
            alone = sum(f == {letter} for _, f in own)
            marks = [sum(d is not None and d in marked for d, _ in gone) for marked in (good, toxic)]
            out.add((part, "".join(order), step, kept, len(gone), failing - len(gone), alone, *marks, shapley[letter]))
    return out


@pytest.fixture(scope="module")
def labels():
    return [(i, i % 2, i % 3 % 2) for i in range(0, 220, 2)] + [(4, None, 1), (6, 1, None), (None, 1, 1), (8, 0, 0), (8, 1, 0), (9999, 1, 1)]


def test_equals_a_walk_over_all_documents(spark, corpus, rows_of, labels):
    marks = spark.createDataFrame([(*r, "x", 1) for r in labels], LABELS)
    extra = [("part" , 1), ("digest", 2), ("mask", 3), ("spread", 4), ("label_id", 5), ("good", 6), ("n", 7), ("toxic", 8)]
    odd = spark.createDataFrame([(300, "SHOUT # it " * 60, "en"), (301, "SHOUT # it " * 60, "de"), (302, "a&b", ""), (None, "a&b", None)], "doc_id long, text string, lang string")
    docs = corpus.select("doc_id", "text", "lang").unionByName(odd).select("*", *[F.lit(v).alias(c) for c, v in extra])
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    found = [tuple(r) for r in audit(docs.repartition(6), text_filters(F.coalesce("text", F.lit(""))), marks).collect()]
    assert len(found) == len(set(found)) and set(found) == brute(rows, labels)


def test_a_hot_text_is_few_rows(spark, labels):
    """A third of all rows share one text in two parts: only the smallest id's rows are no repeats."""
    rows = [(i, "same words", "ab"[i % 2]) for i in range(3000, 2000, -1)] + [(i, f"text {i}", "a") for i in range(2000)] + [(2001, "same words", "b")] * 2
    cells = failure_cells(spark.createDataFrame(rows, "doc_id long, text string, lang string"), {"E": REPEATED}, spark.createDataFrame([(*r, "x", 1) for r in labels], LABELS))
    found = {(r.part, r.mask): r.n for r in cells.collect()}
    assert found == {("a", 0): 2000, ("a", 1): 500, ("b", 0): 3, ("b", 1): 499}


def test_gray_walk_equals_filtering():
    rng = np.random.default_rng(1)
    masks, counts = np.arange(16), rng.integers(0, 50, (16, 3))
    states = survivors(masks, counts, 4)
    for active in range(16):
        assert states[active].tolist() == counts[masks & active == 0].sum(axis=0).tolist()


def test_nothing(spark, nothing, corpus):
    marks = spark.createDataFrame([], LABELS)
    assert audit(nothing, text_filters(F.col("text")), marks).count() == 0
    found = audit(corpus, {"A": F.lit(None).cast("boolean")}, marks).collect()  # a null condition fails nothing
    assert sum(r.kept for r in found) == corpus.count() and all(r.removed == r.shapley == 0 for r in found)


def test_a_long_text(spark):
    text = "word Word " * 400_000 + "|"
    cells = failure_cells(spark.createDataFrame([(1, text, "en")], "doc_id long, text string, lang string"), text_filters(F.col("text")), spark.createDataFrame([], LABELS))
    assert [tuple(r) for r in cells.collect()] == [("en", 0b1010, 1, 0, 0)]

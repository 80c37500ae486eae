import hashlib
import re

import pytest

from llm_fixtures import corpus, nothing, rows_of  # noqa: F401

from tablebridge.llm.mixing import mix, mixture_plan

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, weights, most):
    """Shared by weight; what is above a stop is shared again, round after round."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    stopped, left = {}, float(sum(sizes.values()))
    while True:
        free = [s for s in names if s not in stopped]
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return {**share, **stopped}
        for s in over:
            stopped[s] = float(most * sizes[s])
            left -= stopped[s]


def test_targets_and_takes(corpus, rows_of):
    mixed = mix(corpus, mixture_plan(corpus)).collect()
    assert len(mixed) == len(rows_of)
    size = lambda r: len(WORDS.findall(r.text or ""))
    sizes = {}
    for r in rows_of:
        sizes[r.source] = sizes.get(r.source, 0) + size(r)
    want = targets(sizes, (5, 2, 1), 3)
    taken, largest = {}, {}
    for r in mixed:
        assert r.mix_size == sizes[r.source] and r.mix_target == pytest.approx(want[r.source])
        assert 0 <= r.mix_copies <= 3
        taken[r.source] = taken.get(r.source, 0) + size(r) * r.mix_copies
        same = sum(size(x) for x in rows_of if x.doc_id == r.doc_id and x.source == r.source)
        largest[r.source] = max(largest.get(r.source, 0), same)
    for source, words in taken.items():
        assert abs(words - want[source]) <= largest[source] / 2 + 1e-9
    by_source = {}
    for r in mixed:  # a larger hash is never taken more often
        h = int(hashlib.md5(str("" if r.doc_id is None else r.doc_id).encode()).hexdigest()[:15], 16)
        by_source.setdefault(r.source, []).append((h, r.mix_copies))
    for own in by_source.values():
        copies = [c for _, c in sorted(own)]
        assert copies == sorted(copies, reverse=True)


def test_a_larger_budget_only_adds(corpus):
    small = {(r.doc_id, r.text): r.mix_copies for r in mix(corpus, mixture_plan(corpus, total=3000.0)).collect()}
    large = {(r.doc_id, r.text): r.mix_copies for r in mix(corpus, mixture_plan(corpus, total=9000.0)).collect()}
    assert all(large[k] >= n for k, n in small.items()) and sum(large.values()) > sum(small.values())


def test_nothing(nothing):
    assert mix(nothing, mixture_plan(nothing)).count() == 0
    empty = nothing.sparkSession.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert {r.mix_target for r in mix(empty, mixture_plan(empty)).collect()} == {0.0}

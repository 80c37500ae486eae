import random
import re

import pytest
from llm_fixtures import corpus, near, nothing, prose, rows_of, words  # noqa: F401

from tablebridge.llm.components import components
from tablebridge.llm.neardup import _Comparison, deduplicated, near_duplicates

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute(rows, n):
    """Smallest id reachable and set size, by comparing all pairs of full sets."""
    sets = []
    for _, text in rows:
        w = WORD.findall((text or "").encode().lower())
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None:
                continue
            common = len(sets[i] & sets[j])
            if rows[i][0] == rows[j][0] or sets[i] and sets[j] and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                label[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((d, len(s), least[find(i)] if d is not None else None) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


@pytest.mark.parametrize("n", [4, 5])
def test_components_match_brute_force(corpus, rows_of, n):
    found = [tuple(r) for r in near_duplicates(corpus, words=n).collect()]
    assert sorted(found, key=str) == brute([(r.doc_id, r.text) for r in rows_of], n)


def test_large_family_without_one_common_ancestor(spark):
    rng = random.Random(8)
    text, rows = prose(rng, "en", 300), []
    for i in range(60):  # a chain: each copy differs a little from the one before
        text = near(rng, text, 3)
        rows.append((i, text))
    rows += [(1000 + i, prose(rng, "en", 40) + " " + rows[0][1][:400]) for i in range(30)]  # one passage in many
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in near_duplicates(docs).collect()), key=str) == brute(rows, 5)
    assert sorted((tuple(r) for r in near_duplicates(docs, rounds=0).collect()), key=str) == brute(rows, 5)


def test_one_of_each_group_stays(corpus, rows_of, nothing):
    want = {d for d, _, c in brute([(r.doc_id, r.text) for r in rows_of], 5) if d == c and d is not None}
    rows = deduplicated(corpus).collect()
    assert {r.doc_id for r in rows if r.doc_id is not None} == want and sum(r.doc_id is None for r in rows) == 2
    assert rows[0].asDict().keys() == rows_of[0].asDict().keys()
    assert near_duplicates(nothing).count() == 0 and deduplicated(nothing).count() == 0


def test_each_kept_id_has_one_row(spark):
    rng = random.Random(9)
    a, b, c = (prose(rng, "en", 60) for _ in range(3))
    rows = [(5, a, {"k": 1})] * 200 + [(5, b, {"k": 2}), (5, near(rng, a, 1), {"k": 3}), (7, a, {"k": 4}), (8, c, {"k": 5}), (8, c, {"k": 5})]
    rows += [(9, None, None), (9, None, None), (9, "", {"k": 6}), (None, a, None), (None, a, None), (10, prose(rng, "de", 60), {})]
    frame = spark.createDataFrame(rows, "doc_id long, text string, more map<string,int>")
    found = deduplicated(frame).collect()
    assert sorted((r.doc_id for r in found), key=str) == [10, 5, 8, 9, None, None]
    assert all((r.doc_id, r.text, r.more) in rows for r in found) and found[0].asDict().keys() == {"doc_id", "text", "more"}
    again = deduplicated(frame.repartition(7, "text")).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))


def test_one_id_with_two_texts(spark):
    rng = random.Random(3)
    a, b = prose(rng, "en", 60), prose(rng, "de", 60)
    rows = [(5, a), (5, b), (7, a), (9, b), (11, near(rng, b, 1)), (5, a)]
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.component_id) for r in found} == {(5, 5), (7, 5), (9, 5), (11, 5)} and len(found) == 6


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(found[i] == 1 for i in range(1, 201)) and all(found[1000 + i] == 1000 for i in range(300))


def family(rng, n, fewest, most, size=400):
    """Texts that each replace some words of one base."""
    base = words(rng, "en", size)
    out = []
    for i in range(n):
        own = list(base)
        for at in rng.sample(range(size), rng.randint(fewest, most)):
            own[at] = words(rng, "de", 1)[0] + str(rng.randrange(30))
        out.append((i, " ".join(own)))
    return out


def compared(monkeypatch, spark, rows):
    """Components, and how many pairs were compared in full."""
    counts = []
    joined = _Comparison.joined
    monkeypatch.setattr(_Comparison, "joined", lambda self, pairs: counts.append(pairs.count()) or joined(self, pairs))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((tuple(r) for r in near_duplicates(docs).collect()), key=str)
    monkeypatch.undo()
    return found, sum(counts)


def test_half_alike_families_cost_about_their_size(spark, monkeypatch):
    """No two of these are alike at 0.8: pairs within the family would be 5,000, 20,000 and 80,000."""
    counts = []
    for n in (100, 200, 400):
        found, pairs = compared(monkeypatch, spark, family(random.Random(n), n, 14, 14))
        assert all(doc == component for doc, _, component in found)
        counts.append(pairs)
    print(counts)
    assert counts[2] <= 3 * counts[1] <= 9 * counts[0] and counts[2] <= 400 * 10


def test_graded_family_equals_brute_force(spark, monkeypatch):
    """Changes of 0 to 20 % of the words: some are alike the base, some each other, many nothing."""
    rng = random.Random(12)
    rows = family(rng, 150, 0, 12, 120)
    rows += [(500 + i, near(rng, rows[i][1], 3)) for i in range(0, 150, 5)]  # partners of those at the edge
    found, _ = compared(monkeypatch, spark, rows)
    assert found == brute(rows, 5)
    assert 2 < len({c for _, _, c in found}) < len(rows)

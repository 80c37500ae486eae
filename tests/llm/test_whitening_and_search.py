import numpy as np
import pytest

from tablebridge.llm.registered import op12_whitening, op13_search
from tablebridge.llm.top_inner import FARTHEST, Side, best_of, products, survivors, top_inner_products
from tablebridge.llm.whitening import whiten

SCHEMA = "vec_id long, embedding array<double>, size int, n long, x string, number long, stripe int, query long, length string"


def frame(spark, rows, kind="double"):
    return spark.createDataFrame([(*r, 1, 2, "x", 3, 4, 5, "y") for r in rows], SCHEMA.replace("array<double>", f"array<{kind}>"))


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    base = rng.normal(size=(150, 12)) * np.linspace(3, 0.2, 12) + 5
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[0][1]) for i in range(80)]  # a third is one vector
    rows += [(50, rows[3][1]), (50, rows[3][1]), (None, rows[4][1]), (None, rows[4][1])]
    rows += [(2000, None), (2001, []), (2002, [float("nan")] * 12), (2003, [None] + [1.0] * 11), (2050, [float("-inf")] * 12)]
    return rows


def usable(rows):
    return [(i, v) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]


def brute_whitening(rows, k=16):
    own = [(i, v) for i, v in usable(rows) if v]
    x = np.floor(64 * np.array([v for _, v in own])).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    a = (n * fit - sums) / n
    e, v = np.linalg.eigh(a.T @ a / n)
    e, v = e[::-1], v[:, ::-1][:, :k]
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    return own, n, deviation, ((n * x - sums) / n) @ v / np.sqrt(e[: v.shape[1]]), e[: v.shape[1]] / e.sum()


def test_whitening_equals_an_eigen_decomposition(spark, rows):
    out, models = whiten(frame(spark, rows).repartition(5))
    found = sorted(out.collect(), key=lambda r: (str(r.vec_id), r.whitened))
    own, n, deviation, w, explained = brute_whitening(rows)
    assert sorted(r.deviation for r in found) == sorted(deviation.tolist()) and {r.n for r in found} == {n}
    model = models[12]
    assert np.allclose(model.values[:12] / model.values.sum(), explained, rtol=1e-10)
    assert model.identity_error < 1e-12
    of = {(i, d): values for (i, _), d, values in zip(own, deviation.tolist(), w)}
    got = np.array([r.whitened for r in found])
    want = np.array([of[r.vec_id, r.deviation] for r in found])
    sign = np.sign((got * want).sum(axis=0))
    assert np.allclose(got * sign, want, atol=1e-9)
    assert len(found) == len(own)


def test_whitening_of_an_ill_conditioned_table(spark):
    """Axes whose deviations differ by seven powers of ten, far from zero: a plain Gram matrix has lost the last one."""
    rng = np.random.default_rng(2)
    x = np.floor(rng.normal(size=(400, 5)) * [1e9, 1e7, 1e5, 1e3, 60]) @ np.array([[1, 1, 0, 0, 1], [0, 1, 1, 0, 0], [0, 0, 1, 1, 0], [0, 0, 0, 1, 0], [0, 0, 0, 1, 1.0]])
    _, models = whiten(frame(spark, [(i, v.tolist()) for i, v in enumerate(x / 64)]))
    centred = np.floor(64 * (x / 64)) - np.floor(64 * (x / 64)).mean(axis=0)
    want = np.linalg.svd(centred, compute_uv=False) ** 2 / 400
    assert np.allclose(models[5].values, want, rtol=1e-5) and models[5].identity_error < 1e-6


def test_whitening_without_variance(spark):
    flat = [(i, [1.0, float(i), 2.0 * i]) for i in range(20)] + [(i, [7.0]) for i in range(20, 23)]
    out, models = whiten(frame(spark, flat))
    found = {r.vec_id: r for r in out.collect()}
    assert len(found) == 23 and all(r.whitened[1:] == [0.0] * (r.size - 1) for r in found.values())
    assert models[3].identity_error < 1e-9 and found[21].whitened == [0.0] and found[21].deviation == 0 and found[21].n == 1
    assert np.isclose(np.var([found[i].whitened[0] for i in range(20)]), 1)


def test_whitening_of_far_numbers(spark):
    out, _ = whiten(frame(spark, [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 2.0])]))
    assert {r.vec_id: r.deviation for r in out.collect()} == {1: None, 2: None, 3: (3 * 128 - 192) ** 2}


def test_whitening_query(spark):
    found = op12_whitening(spark, "/root/testdata/sf0.001").collect()
    table = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    own, n, deviation, w, explained = brute_whitening(table)
    want = {(i, c + 1): (d, v) for (i, _), d, row in zip(own, deviation.tolist(), w.tolist()) for c, v in enumerate(row)}
    got = {(r.vec_id, r.component): (r.deviation, r.whitened) for r in found}
    assert got.keys() == want.keys() and all(got[k][0] == want[k][0] for k in want)
    for c in range(1, 17):
        keys = [k for k in want if k[1] == c]
        a, b = (np.array([x[k][1] for k in keys]) for x in (got, want))
        assert np.abs(a * np.sign(a @ b) - b).max() < 1e-7
    assert all(r.n == n and abs(r.explained - explained[r.component - 1]) < 1e-10 and r.identity_error < 1e-10 for r in found)


def brute_search(rows, k=5, scale=256, every=50):
    own = [(i, [max(-FARTHEST, min(FARTHEST, int(np.floor(scale * x)))) for x in v]) for i, v in usable(rows)]
    out = []
    for q, a in own:
        if q is None or q % every:
            continue
        near = [(-sum(x * y for x, y in zip(a, b)), i is None, i) for i, b in own if len(a) == len(b) and i != q]
        out += [(q, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(near, key=lambda t: (t[0], t[1], t[2] or 0))[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("k, stripe", [(5, 1024), (3, 16), (400, 64)])
def test_search_equals_brute_force(spark, rows, monkeypatch, k, stripe):
    import tablebridge.llm.top_inner as module

    monkeypatch.setattr(module, "LEAST_ROWS", stripe)
    more = rows + [(3000, [1.0]), (3050, [2.0]), (3100, [3.0]), (3150, [4.0, 5.0])]
    found = [tuple(r) for r in top_inner_products(frame(spark, more).repartition(3), k=k).collect()]
    assert sorted(found, key=str) == brute_search(more, k)


def test_search_of_far_numbers(spark):
    far = [(50, [1e30, 1.0]), (100, [1e30, -1e30]), (2, [1.0, 1.0]), (3, [-1e30, 1e9])]
    found = top_inner_products(frame(spark, far)).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute_search(far)


def test_bounds_prune_and_lose_nothing():
    rng = np.random.default_rng(7)
    x = np.floor(rng.normal(size=(600, 64)) * np.geomspace(100, 1, 64)).astype(np.int64)
    rotation = np.linalg.eigh((x.T @ x).astype(float))[1][:, ::-1]
    vectors, queries = Side(np.arange(600), x, rotation), Side(np.arange(40), x[:40], rotation)
    scores = x[:40] @ x.T
    floors = np.sort(scores, axis=1)[:, -5].astype(float)
    q, v = survivors(queries, floors, vectors)
    kept = np.zeros(scores.shape, bool)
    kept[q, v] = True
    assert kept[scores >= floors[:, None]].all() and kept.mean() < 0.05
    assert np.array_equal(products(x[:40], x, q, v), scores[q, v])


def test_ties_go_to_the_smaller_id():
    query, score, vec = np.array([1, 0, 0, 0, 1]), np.array([5, 7, 9, 7, 5]), np.array([8, 4, 9, 3, 2])
    unknown = np.array([False, False, False, False, True])
    assert best_of(query, score, vec, unknown, 2).tolist() == [2, 3, 0, 4]


def test_empty_tables(spark):
    empty = frame(spark, [])
    assert whiten(empty)[0].count() == 0 and top_inner_products(empty).count() == 0
    assert op13_search(spark, "/root/testdata/sf0.001").columns == ["query_id", "rank", "vec_id", "score"]

import random
import re

import numpy as np
import pytest

from tablebridge.llm.embedding_dups import _classes, embedding_duplicates, fit_index, traversal
from tablebridge.llm.url_filters import filter_urls, host_edges, host_of, path_of, personalised_rank
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(6)
    rows, at = [], 0
    for family in range(40):
        centre = rng.normal(size=16)
        for _ in range(1 if family % 3 else 12):
            rows.append((at, [float(x) for x in centre + rng.normal(size=16) * 0.06]))
            at += 1
    rows += [(500 + i, list(rows[0][1])) for i in range(30)] + [(600, [2 * x for x in rows[0][1]])]
    rows += [(700, None), (701, []), (702, [0.0] * 16), (703, [float("nan")] + [1.0] * 15), (704, [None] + [1.0] * 15), (705, [float("inf")] * 16)]
    rows += [(None, list(rows[0][1])), (710, [1.0, 2.0, 3.0]), (711, [1.0, 2.0, 3.0]), (712, [3.0]), (500, list(rows[0][1]))]
    return rows


def brute(rows, threshold):
    def usable(i, v):
        return i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    unit = [np.array(v) / np.linalg.norm(v) if usable(i, v) else None for i, v in rows]
    n, label, links = len(rows), list(range(len(rows))), [0] * len(rows)

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(n):
        for j in range(i):
            a, b = unit[i], unit[j]
            if a is not None and b is not None and len(a) == len(b) and a @ b >= threshold:
                links[i] += 1
                links[j] += 1
                label[find(i)] = find(j)
    least = {}
    for i, (own, _) in enumerate(rows):
        if own is not None:
            least[find(i)] = min(own, least.get(find(i), own))
    return sorted(((own, links[i], least[find(i)] if own is not None else None) for i, (own, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("block_rows", [8, 1024])
def test_links_match_brute_force(spark, vectors, block_rows):
    frame = spark.createDataFrame([(*r, "x") for r in vectors], "vec_id long, embedding array<double>, node string")
    found = embedding_duplicates(frame, recall=1.0, block_rows=block_rows).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in found), key=str) == brute(vectors, 0.95)
    assert all(r.measured_recall >= 0.9 for r in found)


def test_no_vectors(spark):
    assert embedding_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    only_bad = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<float>")
    assert {(r.vec_id, r.n_links, r.component_id) for r in embedding_duplicates(only_bad).collect()} == {(1, 0, 1), (2, 0, 2)}


def with_pairs(rng, tight, alone, pairs, d=16):
    """A tight group, vectors with no link, and pairs at a cosine of 0.95 to 0.96."""
    def unit(x):
        return x / np.linalg.norm(x, axis=-1, keepdims=True)

    group = unit(unit(rng.normal(size=d)) + rng.normal(size=(tight, d)) * 0.001)
    first, other = unit(rng.normal(size=(pairs, d))), rng.normal(size=(pairs, d))
    other = unit(other - (other * first).sum(1)[:, None] * first)
    cos = rng.uniform(0.9505, 0.96, size=(pairs, 1))
    x = np.concatenate([group, unit(rng.normal(size=(alone, d))), first, cos * first + np.sqrt(1 - cos * cos) * other])
    return [(i, v) for i, v in enumerate(x.tolist())]


def lost_links(spark, rows, **options):
    """Links of brute force, those of them that were not found, and the result's first row."""
    x = np.array([v for _, v in rows])
    want = (x @ x.T >= 0.95).sum(axis=1) - 1
    found = embedding_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), **options).collect()
    got = {r.vec_id: r.n_links for r in found}
    assert all(got[i] <= n for i, n in enumerate(want))
    return want, np.array([n - got[i] for i, n in enumerate(want)]), found[0]


def test_a_tight_group_does_not_hide_lost_pairs(spark):
    want, lost, row = lost_links(spark, with_pairs(np.random.default_rng(12), 1000, 0, 1000))
    pairs = want[1000:].sum()
    assert lost[1000:].sum() <= 0.003 * pairs and not lost[:1000].any() and row.measured_recall >= 0.9995


def test_rare_pairs_are_found(spark):
    want, lost, row = lost_links(spark, with_pairs(np.random.default_rng(5), 1, 6000, 40))
    assert 60 <= want.sum() <= 120 and not lost.any() and row.measured_recall >= 0.9995


def test_codebooks_are_halved_until_the_recall_is_reached(spark):
    rows = with_pairs(np.random.default_rng(7), 1, 0, 400)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    classes = _classes(frame, "<f8").withColumn("copies", F.lit(1).cast("long"))
    books, steps, measured = fit_index(classes, "<f8", 0.95, 0.9995, most_steps=2)
    assert measured >= 0.9995 and steps <= 2 and len(books[16][0]) == 1


def test_traversal_is_the_order_of_all_cells():
    rng = np.random.default_rng(3)
    x, books = rng.normal(size=(20, 6)), (rng.normal(size=(7, 3)), rng.normal(size=(5, 3)))
    for steps in (1, 4, 35, 50):
        cells, sums = traversal(x, books, steps)
        for row in range(20):
            a = ((x[row, :3] - books[0]) ** 2).sum(1)
            b = ((x[row, 3:] - books[1]) ** 2).sum(1)
            want = np.sort((a[:, None] + b[None, :]).ravel())[:steps]
            assert np.allclose(sums[row], want)


RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "bad.org/"))


def plain_rule(host, path):
    fit = [(len(r), r, v) for v, r in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])]
    return max(fit)[1:] if fit else (None, None)


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(4)
    hosts = ["a.com", "www.example.com", "Example.COM", "b.net", "bad.org", "x.bad.org", "c.org", "d.org", "e.org", "xcom", "far.io"]
    rows = []
    for i in range(120):
        host = rng.choice(hosts)
        links = [f'<a class="x" href="{rng.choice(["http://", "https://", "//"])}{rng.choice(hosts)}/p?q">t</a>' for _ in range(rng.randint(0, 3))]
        links += ['<a href="/own">o</a>', f"<A HREF='http://{host}/self'>s</A>", "<link href='http://no.org/'>"]
        rows.append((i, f"{rng.choice(['http', 'https'])}://{host}{rng.choice(['/en/1', '/es/2', '', '/', '?x=/en/', '#y', '/fr/?a', '/en'])}", "".join(links)))
    rows += [(200, None, None), (201, "no scheme/en/", ""), (202, "http://", "<a href="), (203, "x://y://z.com/en", None), (None, "http://c.org/1", None)]
    rows += [rows[0], rows[0]]
    return rows


def plain_rank(edges, seeds, turns=30, damping=0.85):
    hosts = {h for e in edges for h in e} | set(seeds)
    out = {}
    for (a, _), n in edges.items():
        out[a] = out.get(a, 0) + n
    total = sum(seeds.values())
    rank = {h: seeds.get(h, 0) / total if total else 0.0 for h in hosts}
    start = dict(rank)
    for _ in range(turns if total else 0):
        got = dict.fromkeys(hosts, 0.0)
        for (a, b), n in edges.items():
            got[b] += rank[a] * n / out[a]
        rest = 1 - damping * sum(got.values())
        rank = {h: start[h] * rest + damping * got[h] for h in hosts}
    return rank


def test_urls_match_a_plain_version(spark, pages):
    frame = spark.createDataFrame([(*r, "h", 1) for r in pages], "page_id long, url string, html string, host string, n int")
    found = filter_urls(frame, RULES, turns=30).collect()
    split = []
    for i, url, html in pages:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.split(r"[/?#]", rest)[0].lower()
        split.append((host, re.split(r"[?#]", rest[len(host) :])[0], html or ""))
    edges, seen = {}, {}
    for host, path, html in split:
        for link in re.findall(r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*(?:https?:)?//([^"'\s>/?#]*)""", html):
            if host and link and link.lower() != host:
                edges[host, link.lower()] = edges.get((host, link.lower()), 0) + 1
        if host:
            seen.setdefault(host, []).append(plain_rule(host, path)[1])
    seeds = lambda kind: {h: v.count(kind) for h, v in seen.items() if v.count(kind) * 2 > len(v)}
    trust = plain_rank(edges, seeds("allow"))
    distrust = plain_rank({(b, a): n for (a, b), n in edges.items()}, seeds("block"))
    assert len(found) == len(pages)
    key = lambda x: (str(x[0]), str(x[1]), str(x[2]))
    got = sorted(((r.page_id, r.url_filter.host, r.url_filter.path, r.url_filter.rule, r.url_filter.verdict) for r in found), key=key)
    want = []
    for (i, _, _), (host, path, _) in zip(pages, split):
        rule, verdict = plain_rule(host, path)
        t, d = trust.get(host, 0.0), distrust.get(host, 0.0)
        want.append((i, host, path, rule, verdict or ("block" if d > t and d > 0.1 / len(seen) else "allow")))
    assert got == sorted(want, key=key)
    assert any(r.url_filter.rule is None and r.url_filter.verdict == "block" for r in found)
    for r in found:
        assert r.url_filter.trust == pytest.approx(trust.get(r.url_filter.host, 0.0), abs=1e-5)
        assert r.url_filter.distrust == pytest.approx(distrust.get(r.url_filter.host, 0.0), abs=1e-5)


def test_no_pages(spark):
    assert filter_urls(spark.createDataFrame([], "page_id long, url string, html string"), RULES).count() == 0


def test_rank_is_shared_out(spark):
    edges = spark.createDataFrame([("a", "b", 1), ("b", "c", 3), ("b", "a", 1)], "src string, dst string, n long")
    seeds = spark.createDataFrame([("a", 2.0)], "host string, weight double")
    ranks = {r.host: r.rank for r in personalised_rank(edges, seeds).collect()}
    assert sum(ranks.values()) == pytest.approx(1) and ranks["a"] > ranks["b"] > ranks["c"] > 0
    urls = spark.createDataFrame([("HTTP://A.b/c?d",)], "url string")
    assert urls.select(host_of(F.col("url")).alias("h"), path_of(F.col("url")).alias("p")).first() == ("a.b", "/c")
    assert host_edges(urls, F.lit("a"), F.lit(None).cast("string")).count() == 0

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from vitrine.llm import mixing, mtree, url_reputation

VECTORS = "vec_id long, embedding array<float>, id string, vec string, dim string, part string"


def _vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", "x", "x", "x") for i, v in rows], VECTORS).repartition(3)


def _by_hand(rows, k):
    ok = [(i, np.floor(64 * np.array(v, np.float32).astype(float)).astype(int)) for i, v in rows
          if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, x in ok:
        if q % 20 == 0:
            best = sorted((-int(x @ y), i) for i, y in ok if i != q and len(y) == len(x))[:k]
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(best)}
    return out


def _got(df, k):
    rows = [tuple(r) for r in mtree.top_k(df, df.where("vec_id % 20 = 0"), k=k).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_top_k_with_ties_and_useless_vectors(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(k, (rng.integers(-3, 4, 6) / 16).tolist()) for k in range(300)]
    rows += [(k, [0.25] * 6) for k in range(300, 420)]  # one very common vector
    rows += [(420, None), (440, []), (460, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (480, [float("nan")] * 6), (500, [float("inf")] + [0.0] * 5), (None, [0.1] * 6),
             (520, [0.5, 0.5]), (521, [0.25, 0.1]), (540, [0.0] * 6), (560, [9.0] * 6)]
    df = _vectors(spark, rows)
    assert _got(df, 20) == _by_hand(rows, 20)
    monkeypatch.setattr(mtree, "TREE_ROWS", 30)
    monkeypatch.setattr(mtree, "PAGE", 4)
    monkeypatch.setattr(mtree, "QUERY_BLOCK", 5)
    monkeypatch.setattr(mtree, "SLAB", 3)
    assert _got(df, 7) == _by_hand(rows, 7)


def test_top_k_of_few_and_no_rows(spark):
    assert _got(_vectors(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.5])]), 20) == {(0, 1, 1, 2048)}
    assert mtree.top_k(_vectors(spark, []), _vectors(spark, [])).count() == 0


def test_tree_spares_distances():
    """Clustered points: pages that cannot hold a better score are not opened."""
    rng = np.random.default_rng(4)
    centres = rng.integers(-60, 60, (40, 8))
    vec = np.concatenate([c + rng.integers(-2, 3, (100, 8)) for c in centres])
    norm = (vec ** 2).sum(axis=1)
    tree = mtree.MTree(mtree.lifted(vec, norm, float(norm.max())))
    opened = []
    page = tree.root
    stack = [page]
    leaves = 0
    while stack:
        page = stack.pop()
        leaves += "rows" in page
        stack += page.get("children", [])

    class Watched(np.ndarray):
        def __getitem__(self, key):
            out = super().__getitem__(key)
            if isinstance(key, np.ndarray) and key.dtype != bool:
                opened.append(len(key))
            return out

    ids = np.arange(len(vec))
    got = tree.search(vec.view(Watched), ids, vec[7], 7, 10, float(norm[7] + norm.max()), None)
    score = vec @ vec[7]
    want = sorted((-s, i) for i, s in enumerate(score.tolist()) if i != 7)[:10]
    assert sorted((-s, i) for s, i in got) == want
    assert sum(opened) < len(vec) / 2


def _stored(vec, ids, top):
    """A tree as it is stored: centre and part, the tree, vectors and ids in its order, largest squared norm."""
    norm = (vec ** 2).sum(axis=1)
    tree = mtree.MTree(mtree.lifted(vec, norm, top))
    order = tree.in_order()
    return tree, mtree._narrow(vec[order]), ids[order], float(norm.max())


@pytest.mark.parametrize("spread, scale", [(2, 1), (60, 1), (60, 3_000), (60, 10_000_000)])  # clusters, none, and products beyond float32 and float64
def test_block_of_queries_searches_trees_together(monkeypatch, spread, scale):
    """A block of queries is scored against whole pages, gives what each query's own search gives, and spares far pages."""
    rng = np.random.default_rng(6)
    centres = rng.integers(-60, 60, (30, 8))
    vec = np.concatenate([c + rng.integers(-spread, spread + 1, (100, 8)) for c in centres]) * scale
    vec[5] = vec[9] = vec[700]
    ids = np.arange(len(vec)) // 2 * 2  # every id twice
    norm = (vec ** 2).sum(axis=1)
    top = float(norm.max())
    trees = [((0, p), *_stored(vec[p::3], ids[p::3], top)) for p in range(3)]
    block = (ids[::20], mtree._narrow(vec[::20]), norm[::20], np.full(len(ids[::20]), mtree.NONE), np.full(len(ids[::20]), mtree.NO_ID), [])
    monkeypatch.setattr(mtree, "HITS", 500)
    monkeypatch.setattr(mtree, "SLICE", 30)
    scored = []

    class Watched(np.ndarray):
        def __rmatmul__(self, queries):
            scored.append(len(queries) * self.shape[1])
            return queries @ np.asarray(self)

    trees = [(at, tree, rows.view(Watched), *rest) for at, tree, rows, *rest in trees]
    hits = mtree._visit(block, trees, top, 10)
    got, want = {}, {}
    for q, i, s in zip(hits.query.tolist(), hits.id.tolist(), hits.score.tolist()):
        got.setdefault(q, []).append((-s, i))
    for q, (own, x) in enumerate(zip(block[0].tolist(), vec[::20])):
        want[q] = sorted((-s, i) for s, i in zip((vec @ x).tolist(), ids.tolist()) if i != own)[:10]
    assert {q: sorted(x) for q, x in got.items()} == want
    assert len(scored) > 3
    if spread == 2:
        assert sum(scored) < len(block[0]) * len(vec) / 2
    again = mtree._visit((*block[:3], hits.floor, hits.edge, [t[0] for t in trees]), trees, top, 10)  # trees that were visited
    assert not len(again.query)


def test_top_k_of_many_trees_and_blocks(spark, monkeypatch):
    """Blocks of queries and groups of trees meet in tasks; ids that repeat with other vectors share one ranking."""
    rng = np.random.default_rng(8)
    centres = rng.integers(-30, 31, (9, 5))
    rows = [(k, ((centres[k % 9] + rng.integers(-2, 3, 5)) / 32).tolist()) for k in range(700)]
    rows += [(k, (rng.integers(-9, 10, 5) / 16).tolist()) for k in range(0, 700, 35)] + rows[:40] + [(900 + k, [k / 8]) for k in range(5)]
    for name, value in {"TREE_ROWS": 20, "QUERY_BLOCK": 4, "PAGE": 4, "SLAB": 5, "CHUNK": 2, "GROUP_ROWS": 50, "CENTRES": 6, "TREE_CELLS": 60}.items():
        monkeypatch.setattr(mtree, name, value)
    df = _vectors(spark, rows)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in mtree.top_k(df, df.where("vec_id % 20 = 0"), k=6).collect())
    ok = [(i, np.floor(64 * np.array(v, np.float32).astype(float)).astype(int)) for i, v in rows]
    want = []
    for q in sorted({i for i, _ in rows if i % 20 == 0}):
        asked = {tuple(x) for i, x in ok if i == q}
        best = sorted((-int(np.dot(x, y)), i) for x in asked for i, y in ok if i != q and len(x) == len(y))[:6]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    assert got == want


URLS = [("http://A.Example.COM/en/x?q#f", "a.example.com", "/en/x", "example.com/en/", "block"), ("https://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("https://x.www.example.com/en/a", "x.www.example.com", "/en/a", "www.example.com/en/", "allow"), ("http://b.com/", "b.com", "/", "com/", "allow"), ("http://b.com", "b.com", "", None, None),
        ("ftp://x.net/es/1", "x.net", "/es/1", "net/es/", "block"), ("http://notexample.com/en/1", "notexample.com", "/en/1", "com/", "allow"), ("http://x.net/fr", "x.net", "/fr", None, None),
        ("http://y.org?u=http://z.com/", "y.org", "", None, None), (None, "", "", None, None), ("no scheme", "", "", None, None), ("http://", "", "", None, None),
        ("//x.com/en/", "", "", None, None), ("http://İ.Com/\nen", "İ.com", "/\nen", "com/", "allow")]


def test_rules(spark):
    pages = spark.createDataFrame([(k, u, "x", "y") for k, (u, *_) in enumerate(URLS)] + [(0, URLS[0][0], "x", "y")], "page_id long, url string, host string, rule string")
    got = url_reputation.judge_urls(pages).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        _, host, path, rule, verdict = URLS[r.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
    assert url_reputation.judge_urls(pages.limit(0)).count() == 0


def test_reputation_shrinks_by_evidence(spark):
    rows = [("bad.a.org", 1)] * 60 + [("good.b.org", 0)] * 60 + [("mixed.c.org", k % 2) for k in range(60)] + [("few.b.org", 1)] + [("new.a.org", None), ("new.zz", None)]
    rows += [(f"h{k}.d{k}.net", 0) for k in range(40)]
    got = {r.host: r for r in url_reputation.host_reputation(spark.createDataFrame(rows, "host string, blocked int")).collect()}
    assert got["bad.a.org"].lower > 0.5 > got["mixed.c.org"].lower
    assert got["good.b.org"].mean < 0.1
    assert got["few.b.org"].lower < 0.5  # one outcome on a good domain
    assert got["new.a.org"].mean > got["new.zz"].mean  # leans on its domain
    assert all(0 <= r.mean <= 1 for r in got.values())


def test_reputation_by_hand(spark):
    """One unit under the overall rate: the posterior of a beta-binomial with the fitted weight."""
    rows = [("a.x", 1)] * 3 + [("b.y", 0)] * 5
    units = spark.createDataFrame([("x", 3, 3, 0.4, 0.0), ("y", 5, 0, 0.4, 0.0)], "suffix string, n long, k long, p double, v double")
    p, q = 0.4, 8 * 0.24
    s, d = 3 * 0.36 + 5 * 0.16, 2 * 0.24
    rho = (s - d) / (q - d)
    m = min(max((1 - rho) / rho, 0.5), 1e6)
    got = {r.suffix: r for r in url_reputation._shrunk(units, "suffix", "p", "v").collect()}
    assert got["x"].suffix_mean == pytest.approx((m * p + 3) / (m + 3)) and got["y"].suffix_mean == pytest.approx(m * p / (m + 5))
    assert len(rows) == 8


def _targets(sizes, weights=(5, 2, 1), budget=1.5, cap=2.0):
    """Water filling in rounds."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, fixed = budget * sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > cap * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: cap * sizes[s] for s in over}


def test_mix_meets_its_targets(spark, docs, rows, no_docs):
    got = mixing.mix(docs).collect()
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += len(brute.words(t))
    want = _targets(sizes)
    taken, largest = Counter(), Counter()
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s, t in want.items():
        assert abs(taken[s] - t) <= largest[s]
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(7)).collect()))
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == Counter({i: n for i in {r.doc_id for r in got} if (n := sum(r.copies for r in got if r.doc_id == i))})
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed_documents(no_docs).count() == 0


def test_mix_is_near_its_targets_on_the_table(spark):
    got = mixing.mix(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).groupBy("source").agg(F.first("target").alias("target"), F.sum("taken").alias("taken")).collect()
    assert all(abs(r.taken - r.target) <= 0.03 * r.target for r in got)
    assert sum(r.taken for r in got) == pytest.approx(sum(r.target for r in got), rel=0.005)


def test_newton_solves_the_dual(spark):
    cells = spark.createDataFrame([("a", 30), ("a", 70), ("b", 50), (None, 10)], "source string, size long")
    targets = spark.createDataFrame([("a", 100, 3.0), ("b", 50, 100.0), (None, 10, 0.0)], "source string, source_size long, target double")
    got = {r.source: r.lam for r in mixing.balance(cells, targets).collect()}
    assert got["a"] == pytest.approx(np.log(0.03), abs=1e-9) and got["b"] == pytest.approx(np.log(2), abs=1e-9) and got[None] is None

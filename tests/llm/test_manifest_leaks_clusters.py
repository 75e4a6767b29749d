"""The Merkle manifest, winnowing and sharded clustering against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import EXTRA, SCHEMA, frame, prose
from vitrine.llm import decontaminate, lloyd, merkle

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _leaf(row):
    return _sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def _tree(leaves, fanout):
    """(root, siblings of every leaf as (left, right) pairs) of digests in order."""
    path = [[] for _ in leaves]
    level, place = list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for k, p in enumerate(place):
            a = p // fanout * fanout
            path[k].append(("".join(level[a:p]), "".join(level[p + 1: a + fanout])))
        level = [_sha("".join(level[a: a + fanout])) for a in range(0, len(level), fanout)]
        place = [p // fanout for p in place]
    return level[0], path


def _manifest(rows, fanout):
    """rows of FIELDS -> Counter of (id, leaf, subroot, root, proof, folded root)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    sub = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r)))
        sub[g] = _tree([_leaf(r) for r in groups[g]], fanout)
    root, above = _tree([sub[g][0] for g in names], fanout)
    out = Counter()
    for g, up in zip(names, above):
        for r, path in zip(groups[g], sub[g][1]):
            steps = path + up
            changed = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None:
                changed = (*r[:3], r[3] + 1, r[4])
            acc = _leaf(changed)
            for a, b in steps:
                acc = _sha(a + acc + b)
            out[r[0], _leaf(r), sub[g][0], root, _sha("".join(a + b for a, b in steps)), acc, acc == root] += 1
    return out


def _made(df, fanout=2):
    out = merkle.manifest(df, FIELDS, fanout=fanout, tampered={"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1},
                          tamper=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0)
    return Counter(tuple(r) for r in out.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof_text(F.col("path")), 256), "folded_root", "verified").collect())


@pytest.mark.parametrize("fanout", [2, 3])
def test_manifest(spark, docs, rows, fanout):
    full = [(i, source, lang, len(t or ""), t) for i, t, lang, source in rows]
    assert len({r[2] for r in full}) == 3
    got = _made(docs, fanout)
    assert got == _manifest(full, fanout)
    assert {v for *_, v in got} == {True, False}


def test_manifest_of_one_and_no_rows(spark, no_docs):
    one = frame(spark, [(7, "a", "en", "s")])
    assert _made(one) == _manifest([(7, "s", "en", 1, "a")], 2)
    assert _made(no_docs) == Counter()


def test_manifest_with_null_fields_largest_numbers_and_full_levels(spark):
    """Null n_chars stays null, the largest long is tampered without overflow, groups of exactly 16, 17 and 1 rows."""
    rows = [(i, None, lang, None if i % 3 == 0 else (1 << 63) - 1, None) for lang, n in (("aa", 16), ("é", 17), (None, 1), ("z", 33)) for i in range(n)]
    df = spark.createDataFrame([(i, t, lang, s, n, *["x"] * len(EXTRA)) for i, s, lang, n, t in rows], SCHEMA)
    assert _made(df) == _manifest(rows, 2)


# ---------------------------------------------------------------- winnowing

TOKEN = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _tokens(text):
    return TOKEN.findall((text or "").translate(ASCII_LOWER))


def _leaks(rows, items, length=10):
    windows = {}
    for i, t in items:
        w = _tokens(t)
        n = min(length, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[k: k + n]), set()).add(i)
    out = Counter()
    for i, t, *_ in rows:
        w, hit, names = _tokens(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                found = windows.get(tuple(w[k: k + n]))
                if found is not None:
                    hit |= set(range(k, k + n))
                    names |= found
        ids = sorted(str(x) for x in names if x is not None)
        out[i, len(w), len(hit), len(ids), _sha(",".join(ids)), bool(hit), tuple(sorted(hit))] += 1
    return out


def _found(df, items, **more):
    got = Counter()
    for r in decontaminate.contamination(df, items, **more).collect():
        hit = tuple(k for s in r.spans for k in range(s.start, s.end))
        got[r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated, hit] += 1
    return got


def _benchmark(rows):
    rng = random.Random(5)
    base = next(t for i, t, *_ in rows if i == 80)
    words = base.split(" ")
    items = [(1, " ".join(words[20:60])), (2, " ".join(words[40:52])), (10, " ".join(words[100:110])), (3, "one two"), (4, "The"), (5, "größe NAÏVE 日本語"), (6, " ".join(words[90:98])),
             (7, None), (8, ""), (9, "?!"), (11, " ".join(words[20:60])), (None, " ".join(words[150:165])), (12, prose(rng, 30, ["zyx", "wvu"])), (1, " ".join(words[180:195])), (13, "the " * 12)]
    return items


def test_contamination(spark, docs, rows):
    items = _benchmark(rows)
    df = spark.createDataFrame(items, "item_id long, text string")
    want = _leaks(rows, items)
    assert sum(w[2] > 0 for w in want) > 20
    assert _found(docs, df) == want
    assert _found(docs, df, broadcast_rows=3) == want  # the way beyond the broadcast
    assert _found(docs, df, length=7, k=3) == _leaks(rows, items, 7)


def test_contamination_of_nothing(spark, docs, rows, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert _found(docs, none) == _leaks(rows, [])
    assert _found(no_docs, spark.createDataFrame(_benchmark(rows), "item_id long, text string")) == Counter()


def test_every_shared_window_is_found(spark):
    """Spans of exactly ten words at every offset, over a small alphabet with many repeated grams."""
    rng = random.Random(8)
    alphabet = ["a", "b", "c"]
    items = [(k, prose(rng, rng.randint(8, 40), alphabet)) for k in range(30)]
    rows = []
    for k in range(60):
        w = items[k % 30][1].split(" ")
        at = rng.randrange(max(1, len(w) - 9))
        rows.append((k, " ".join([prose(rng, rng.randint(0, 30), alphabet + ["x"]), *w[at: at + 10], prose(rng, rng.randint(1, 30), alphabet + ["y"])]), "en", "s"))
    assert _found(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")) == _leaks(rows, items)


# ---------------------------------------------------------------- clustering

def _clusters(rows, k, rounds, dims):
    kept = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(np.float32(x)) for x in v)]
    start = sorted(kept, key=lambda r: (r[0] is None, _sha(f"1:{r[0]}"), r[1]))[:k]
    centroids = [v for _, v in start]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        best = assign()
        for n in range(len(centroids)):
            own = [v for (_, v), (_, m) in zip(kept, best) if m == n]
            if own:
                centroids[n] = [sum(col) // len(own) for col in zip(*own)]
    best = assign()
    top = (1 << 63) - 1
    near = [(min(d, top), n) for d, n in best]
    inertia = [min(sum(d for d, m in near if m == n), top) for n in range(len(centroids))]
    total = min(sum(sum(d for d, m in near if m == n) for n in range(len(centroids))), top)
    return Counter((i, n, d, inertia[n], total, _sha(",".join(map(str, centroids[n])))) for (i, _), (d, n) in zip(kept, near))


def _lloyd(spark, rows, dims, k=4, rounds=3):
    df = spark.createDataFrame([(i, v, "x", "x", "x") for i, v in rows], "vec_id long, embedding array<float>, cluster string, distance string, block string").repartition(3)
    return Counter(tuple(r) for r in lloyd.clusters(df, dims=dims, k=k, rounds=rounds).collect())


def test_clusters(spark, monkeypatch):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(lloyd, "BLOCK_DIMS", 4)
    monkeypatch.setattr(lloyd, "CHUNK_ROWS", 16)
    rows = [(k, rng.normal(size=10).astype(np.float32).tolist()) for k in range(120)]
    rows += [(k, [0.25] * 10) for k in range(120, 200)]  # one very common vector
    rows += [(200, None), (201, []), (202, [0.5] * 9), (203, [None] + [0.5] * 9), (204, [float("nan")] * 10), (205, [float("inf")] + [0.0] * 9), (None, [0.1] * 10), rows[0], (3, [2.0] * 10)]
    assert _lloyd(spark, rows, 10) == _clusters(rows, 4, 3, 10)


def test_clusters_of_few_equal_huge_and_no_vectors(spark):
    few = [(1, [0.5, 1.0]), (2, [0.5, 1.0]), (None, [-3.0, 2.0])]
    assert _lloyd(spark, few, 2, k=16) == _clusters(few, 16, 3, 2)
    huge = [(k, [s * 3e38, k / 7, -1e19]) for k, s in enumerate([1, -1, 1, 0.5, 1e-9, 0.0])]
    assert _lloyd(spark, huge, 3, k=2) == _clusters(huge, 2, 3, 3)
    assert _lloyd(spark, [], 2) == Counter()


def test_an_empty_cluster_keeps_its_centroid(spark):
    """Two equal first centroids: the second never wins a tie."""
    rows = [(k, [1.0, 1.0]) for k in range(6)]
    got = _lloyd(spark, rows, 2, k=3)
    assert got == _clusters(rows, 3, 3, 2) and {r[1] for r in got} == {0}

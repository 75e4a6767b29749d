import hashlib
from collections import Counter

from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.conftest import EXTRA, frame
from vitrine.llm import exact_dedup, ngram_join, substring_dedup


def _groups(rows):
    out = {}
    for i, t, *_ in rows:
        out.setdefault(t or "", []).append(i)
    return out


def test_exact_duplicates(docs, rows):
    groups = _groups(rows)
    want = Counter()
    for i, t, *_ in rows:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        want[i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in exact_dedup.exact_duplicates(docs).collect()) == want


def test_colliding_hashes_are_told_apart_by_bytes(docs):
    weak = lambda c: F.substring(F.md5(c), 1, 1)  # noqa: E731  16 hashes for all texts
    a = Counter(tuple(r) for r in exact_dedup.exact_duplicates(docs, hash_of=weak).collect())
    assert a == Counter(tuple(r) for r in exact_dedup.exact_duplicates(docs).collect())


def test_smallest_id_can_stay(docs, rows):
    got = exact_dedup.exact_duplicates(docs, keep="min").where("group_size > 1").select("doc_id", "keep_id").collect()
    ids = {i: min(x for x in g if x is not None) for g in _groups(rows).values() for i in g if any(x is not None for x in g)}
    assert all(r.keep_id == ids[r.doc_id] for r in got if r.doc_id is not None)


def test_dropping_keeps_one_row_and_all_columns(docs, rows, no_docs):
    out = exact_dedup.drop_exact_duplicates(docs)
    assert out.columns == docs.columns
    kept = out.select("doc_id", "text", EXTRA[0]).collect()
    assert Counter(r.text or "" for r in kept) == Counter(list(_groups(rows)))
    assert exact_dedup.drop_exact_duplicates(no_docs).count() == 0
    assert exact_dedup.exact_duplicates(no_docs).count() == 0


def _near(spark, df):
    return {(r.doc_id, r.n_shingles): r.component_id for r in ngram_join.near_components(df).collect()}


def test_near_components(spark, docs, rows):
    named = sorted((r[:2] for r in rows if r[0] is not None), key=lambda r: r[0])
    sets = [brute.shingles(t) for _, t in named]
    comp = brute.components(sets)
    got = _near(spark, docs)
    for k, (i, _) in enumerate(named):
        assert got[i, len(sets[k])] == (i if not sets[k] else named[comp[k]][0])


def test_near_components_with_small_tiles_and_no_order(spark, docs, rows, monkeypatch):
    """Tiles cut into blocks, and hash order instead of frequency order, lose no link."""
    want = _near(spark, docs)
    monkeypatch.setattr(ngram_join, "TILE_ROWS", 3)
    assert _near(spark, docs) == want
    monkeypatch.setattr(ngram_join, "FREQUENT", 0)
    assert _near(spark, docs) == want


def test_near_copies_with_senders_dealt_out(spark, monkeypatch):
    """A hub whose senders meet it in many parts; routes are joined by a shuffle."""
    monkeypatch.setattr(ngram_join, "TILE_ROWS", 3)
    monkeypatch.setattr(ngram_join, "SENDERS", 2)
    monkeypatch.setattr(ngram_join, "ROUTES", 0)
    w = [f"w{k}" for k in range(80)]
    rows = [(k, " ".join([*w[: 79 - k], f"edit{k}"]), "en", "s") for k in range(9)] + [(50 + k, " ".join(f"v{k}-{j}" for j in range(40)), "en", "s") for k in range(3)]
    rows += [(None, " ".join(w), "en", "s"), (60, None, "en", "s")]
    got = _near(spark, frame(spark, rows))
    assert {i: c for (i, _), c in got.items() if i is not None} == {k: 0 for k in range(9)} | {50: 50, 51: 51, 52: 52, 60: 60}


def test_near_copies_of_a_text_with_thousands_of_copies(spark):
    """Every shared tile is dealt out to three parts by its copies, and most nodes are alone in theirs."""
    w = [f"w{k}" for k in range(80)]
    rows = [(k, " ".join(w), "en", "s") for k in range(100, 100 + 2 * ngram_join.TILE_ROWS + 4)]
    rows += [(k, " ".join(w[: 79 - k] + [f"edit{k}"]), "en", "s") for k in range(6)]
    assert {ngram_join._node(s) % 3 for s in ngram_join.shingle_sets([r[1] for r in rows[-7:]])} == {0, 1, 2}
    assert set(_near(spark, frame(spark, rows)).values()) == {0}


def test_links_of_a_chain_join_one_component(spark):
    """Neighbours link, the ends don't: still one component; sizes at the exact threshold link."""
    w = [f"w{k}" for k in range(130)]
    rows = [(k, " ".join(w[6 * k: 6 * k + 64]), "en", "s") for k in range(11)]
    sets = [brute.shingles(t) for _, t, *_ in rows]
    assert brute.components(sets) == [0] * 11
    assert set(_near(spark, frame(spark, rows)).values()) == {0}
    edge = [(1, " ".join(w[:12]), "en", "s"), (2, " ".join(w[:14]), "en", "s"), (3, " ".join(w[:18]), "en", "s")]  # 8 of 10 links, 8 of 14 and 10 of 14 don't
    assert _near(spark, frame(spark, edge)) == {(1, 8): 1, (2, 10): 1, (3, 14): 3}


def test_near_stage_keeps_one_of_each_component(spark, docs, no_docs):
    out = ngram_join.drop_near_duplicates(docs)
    comp = ngram_join.near_components(docs).where("doc_id is not null").select("component_id").distinct().count()
    assert out.columns == docs.columns
    assert out.where("doc_id is not null").select("doc_id").distinct().count() == comp
    assert ngram_join.near_components(no_docs).count() == 0


def _spans_match(df, rows):
    flags = brute.removed([r[:2] for r in rows])
    want = Counter()
    for (i, t, *_), f in zip(rows, flags):
        w = brute.words(t)
        kept = b" ".join(x for x, gone in zip(w, f) if not gone)
        want[i, len(w), sum(f), hashlib.sha256(kept).hexdigest()] += 1
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.repeated_spans(df).collect())
    assert got == want


def test_repeated_spans(docs, rows, no_docs):
    _spans_match(docs, rows)
    assert substring_dedup.repeated_spans(no_docs).count() == 0


def test_repeated_spans_with_shards_of_many_parts(docs, rows, monkeypatch):
    monkeypatch.setattr(substring_dedup, "PART_WORDS", 300)
    monkeypatch.setattr(substring_dedup, "AUTOMATON_WORDS", 150)
    _spans_match(docs, rows)


def test_spans_name_the_removed_words_and_texts_lose_them(docs, rows):
    flags = {i: f for (i, *_), f in zip(rows, brute.removed([r[:2] for r in rows]))}
    for r in substring_dedup.repeated_spans(docs).where("n_removed > 0").collect():
        assert [k for s in r.spans for k in range(s.start, s.end)] == [k for k, f in enumerate(flags[r.doc_id]) if f]
    texts = {i: t for i, t, *_ in rows}
    out = substring_dedup.without_repeats(docs)
    assert out.columns == docs.columns
    for r in out.where("doc_id is not null").collect():
        f = flags[r.doc_id]
        assert r.text == (" ".join(w.decode() for w, gone in zip(brute.words(texts[r.doc_id]), f) if not gone) if any(f) else texts[r.doc_id])


def test_pivots_flag_tiles_of_two_nodes():
    """Tile 1: two nodes; 2: three; 3: one; 4: two, dealt out; 5: two, but its rows lie across batches."""
    import numpy as np
    import pyarrow as pa

    rows = [(1, -1, 10), (1, -1, 11), (1, -1, 11), (2, -1, 10), (2, -1, 11), (2, -1, 12), (3, -1, 10), (4, 0, 10), (4, 0, 12), (5, -1, 10), (5, -1, 13), (6, -1, 10)]
    t, p, v = (np.array(c) for c in zip(*rows))
    batch = pa.record_batch({"tile": t, "part": p.astype(np.int32), "node": v, "size": np.full(len(t), 9, np.int32), "place": np.zeros(len(t), np.int32)})
    got = [r for b in ngram_join._pivots(iter([batch.slice(0, 10), batch.slice(10)])) for r in b.to_pylist()]
    assert [(r["tile"], r["node"], r["pivot"], r["many"]) for r in got] == [
        (1, 11, 10, False), (2, 11, 10, True), (2, 12, 10, True), (4, 10, 10, True), (4, 12, 10, True), (5, 13, 10, True)]


def test_pairs_of_two_node_tiles_link_when_another_pivot_was_likelier(spark, monkeypatch):
    """Texts 1 and 2 link only with 3, at different ends: each pair of nodes has tiles of its own."""
    met = []
    keep = ngram_join._across
    monkeypatch.setattr(ngram_join, "_across", lambda percent, best: met.append(best) or keep(percent, best))
    w = [f"w{k}" for k in range(104)]
    rows = [(k, " ".join(w[a:b]), "en", "s") for k, (a, b) in enumerate(((0, 88), (8, 96), (16, 104)), 1)]
    sets = [brute.shingles(t) for _, t, *_ in rows]
    assert set(_near(spark, frame(spark, rows)).values()) == {[r[0] for r in rows][c] for c in brute.components(sets)} and met[-1] is False


def test_comparing_a_large_cell_takes_bounded_memory():
    """Two million pairs of one cell, all allowed by place and size: their bitmaps are looked at in pieces."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    n = 2000
    rows = pa.record_batch({"tile": np.zeros(n, np.int64), "band": np.zeros(n, np.int32), "cell": np.zeros(n, np.int64), "side": np.zeros(n, np.int32), "own": np.ones(n, bool),
                            "node": np.arange(n), "size": np.full(n, 100, np.int32), "place": np.zeros(n, np.int32), "component": np.arange(n),
                            "bits": pa.array([np.random.default_rng(k).bytes(ngram_join.COARSE // 8) for k in range(n)], pa.binary())})
    tracemalloc.start()
    pairs = sum(b.num_rows for b in ngram_join._across(80, False)(iter([rows])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20 and pairs == 0


def _cell_rows(rng, n):
    """Rows of random cells, sorted as they arrive."""
    import numpy as np

    rows = {"tile": rng.integers(0, 4, n), "band": rng.integers(0, 2, n).astype(np.int32), "cell": rng.integers(-2, 2, n), "side": rng.integers(-1, 2, n).astype(np.int32),
            "own": rng.random(n) < 0.7, "node": np.arange(n), "size": rng.integers(20, 60, n).astype(np.int32), "place": rng.integers(0, 6, n).astype(np.int32),
            "component": rng.integers(0, 5, n)}
    order = np.lexsort((rows["cell"], rows["band"], rows["tile"]))
    return {c: x[order] for c, x in rows.items()}


def test_rows_without_a_partner_get_no_bitmap():
    """Only rows that place and size allow a partner are left, and they make the same pairs."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(5)
    rows = pa.record_batch(_cell_rows(rng, 300))
    bits = np.array([rng.integers(0, 256, ngram_join.COARSE // 8, dtype=np.uint8).tobytes() for _ in range(300)], object)

    def pairs(batch, best):
        whole = batch.append_column("bits", pa.array([bits[k] for k in batch.column("node").to_pylist()], pa.binary()))
        return sorted((r["node"], r["other"]) for b in ngram_join._across(40, best)(iter([whole.slice(0, 70), whole.slice(70, 5), whole.slice(75)])) for r in b.to_pylist())

    left = [b for b in ngram_join._partnered(40)(iter([rows.slice(0, 90), rows.slice(90, 3), rows.slice(93)]))]
    left = pa.Table.from_batches(left).combine_chunks().to_batches()[0]
    assert 0 < left.num_rows < 300 and left.schema.equals(rows.schema)
    for best in (False, True):
        assert pairs(left, best) == pairs(rows, best)
    cells = {}
    for r in rows.to_pylist():
        cells.setdefault((r["tile"], r["band"], r["cell"]), []).append(r)
    expected = set()
    for cell in cells.values():
        for i, a in enumerate(cell):
            for b in cell[i + 1:]:
                common = min(a["size"] - a["place"], b["size"] - b["place"])
                if (a["component"] != b["component"] and (a["own"] or b["own"]) and sorted((a["side"], b["side"])) in ([0, 0], [0, 1], [-1, 1])
                        and 100 * min(a["size"], b["size"]) >= 40 * max(a["size"], b["size"]) and 100 * common >= 40 * (a["size"] + b["size"] - common)):
                    expected |= {a["node"], b["node"]}
    assert set(left.column("node").to_pylist()) == expected


def test_rows_that_no_other_row_of_their_tile_allows_stay_out_of_the_rounds():
    """Tile 1: sizes 10, 11, 100 and 101 pair up, 50 stands alone; tile 2: the places of two sets leave no room for a link; tile 3 is not whole."""
    import numpy as np
    import pyarrow as pa

    rows = [(1, 10, 10, 0), (1, 11, 11, 0), (1, 12, 50, 0), (1, 13, 100, 0), (1, 14, 101, 0), (2, 10, 20, 0), (2, 11, 20, 4), (2, 12, 21, 4), (2, 13, 25, 4), (3, 10, 10, 0), (3, 11, 90, 0)]
    t, v, s, at = (np.array(c) for c in zip(*rows))
    batch = pa.record_batch({"tile": t, "part": np.full(len(t), -1, np.int32), "node": v, "size": s.astype(np.int32), "place": at.astype(np.int32)})
    got = {(r["tile"], r["node"]): r["many"] for b in ngram_join._pivots(iter([batch]), 80) for r in b.to_pylist()}

    def allowed(a, b):
        common = min(a[2] - a[3], b[2] - b[3])
        return 100 * common >= 80 * (a[2] + b[2] - common)

    for r in rows:
        if r[1] != 10 and r[0] != 3:
            assert got[r[0], r[1]] == any(allowed(r, x) for x in rows if x[0] == r[0] and x != r), r
    assert got[1, 11] and not got[1, 12] and got[1, 14] and got[3, 11]


def test_both_sides_of_a_pair_share_one_exchange_of_bitmaps(spark, docs, monkeypatch):
    """The bitmaps of the pairs' first and second sides are dealt out once."""
    plans = []
    keep = type(docs).checkpoint

    def seen(self, *a, **k):
        plan = self._jdf.queryExecution().executedPlan().toString()
        if "their_node" in plan:
            plans.append(plan)
        return keep(self, *a, **k)

    monkeypatch.setattr(type(docs), "checkpoint", seen)
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the plan shows reuse before it runs
    try:
        _near(spark, docs)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert plans and all(any("ReusedExchange" in line and "their_node" in line for line in p.splitlines()) for p in plans)

"""N-gram Jaccard self-join: size-banded tiles, hashed bitmap signatures, exact sorted-array intersection.

Two documents link when 100 * |A and B| >= percent * |A or B| over their sets of
distinct n-word shingles (64-bit hashes; ASCII letters lower-cased).

1. Every document becomes a set.  Equal sets are one node, named by a 64-bit
   hash of the set and its size, so a group of copies is one row from here on.
2. Shingles are put in one total order: rare ones by hash, then the frequent
   ones (counted in every partition) by count.  Linked sets share one of the
   first |A| - ceil(percent |A|) + 1 shingles in that order; a shingle of these
   prefixes is a tile.  A tile of a frequent shingle is dealt out by its count.
   The order only decides how even the tiles are, never which links are found.
3. Each set has a bitmap of hashed shingles: a bit that only one side has set
   proves a shingle that the other lacks, so bit counts bound the overlap from
   above.  Every node of a tile meets the tile's pivot; of the pivots that its
   bitmap allows it is compared with the likeliest, by intersecting the sorted
   arrays.  The links give first components: a large group of near copies is a
   star here, not pairs.
4. What is left are pairs across components inside a tile.  Of a tile with two
   nodes that is the pair of step 3, and it is left only if its bitmaps allow it:
   such a tile sends no rows below.  The others are cut into size bands (partners differ by at most `percent` in size) and, where they are
   large, into cells: rows outside a tile's largest component (minors) and the
   others are dealt into blocks, and a cell holds two blocks.  A tile's row
   carries the shingle's place in the set's order, which bounds the overlap when
   this tile is the pair's first.  Rows travel without bitmaps at first; those that meet
   one whose size and place they allow come again, with a bitmap of fixed width, and the whole bitmap is
   met once for each pair that these allow.  In some rounds every node is compared
   with its likeliest partner of another component, which joins the large groups;
   the last round compares all pairs across components that are still allowed.
5. Sets of pairs that are left travel once: the side with fewer pairs is sent to
   the other one, whose senders are dealt out where they are many.

Defined results: null and empty texts have an empty set and link with nothing;
fewer than n words give one shingle of all words; repeated rows are copies; null
ids take part but never name a component that has another id.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.graph import connected_components
from vitrine.llm.shipping import release_shuffles, ship_package
from vitrine.llm.textwords import blocks, gram_hashes, mix
from vitrine.session import ensure_checkpoint_dir

#: the order's list of frequent shingles: at most so many, seen so often within so many shingles
FREQUENT, FREQUENT_IN_CHUNK, CHUNK = 1 << 16, 8, 1 << 22
#: rows of a tile that meet in one comparison; rounds of likeliest pairs across components before the one over all pairs
TILE_ROWS, ROUNDS = 2048, 1
#: rows of a tile whose pairs are looked at when the tile is made
PAIRED = 64
#: bits of a tile row's bitmap; candidate pairs looked at together; senders that meet one receiver's set; routes that are broadcast
COARSE, PAIRS, SENDERS, ROUTES = 1 << 10, 1 << 16, 4096, 200_000


def _sets(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    for _, _, block in blocks(texts, lower=True, most=1 << 19):  # some 100 bytes of arrays for each byte of text
        words = block.word_hashes()
        first = block.first.tolist()
        for a, b in zip(first, first[1:]):
            yield np.unique(gram_hashes(words[a:b], min(n, b - a))) if b > a else np.empty(0, np.uint64)


def _node(s: np.ndarray) -> int:
    """64-bit name of a set; 0 for the empty one."""
    if not len(s):
        return 0
    both = np.array([np.bitwise_xor.reduce(s), s.sum(dtype=np.uint64)], np.uint64)
    return int((mix(both[:1]) + both[1:]).view(np.int64)[0])


def shingle_sets(texts: list[str | None], n: int = 5) -> list[np.ndarray]:
    """Sorted shingle hashes of each text."""
    return list(_sets(pa.array(texts, pa.string()), n))


def frequent_shingles(docs: DataFrame, n: int) -> np.ndarray:
    """(2, k) shingles and counts, by shingle: the most frequent ones over all documents, at most FREQUENT."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held):
            if held:
                h, c = np.unique(np.concatenate(held), return_counts=True)
                often = c >= FREQUENT_IN_CHUNK
                yield pa.record_batch({"h": h[often].view(np.int64), "c": c[often].astype(np.int64)})

        held, size = [], 0
        for batch in batches:
            for s in _sets(batch.column("text"), n):
                held.append(s)
                size += len(s)
                if size >= CHUNK:
                    yield from flush(held)
                    held, size = [], 0
        yield from flush(held)

    rows = (docs.select("text").mapInArrow(count, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
            .orderBy(F.desc("c"), "h").limit(FREQUENT).collect())
    out = np.array([(r.h, r.c) for r in rows], np.int64).reshape(-1, 2)
    order = np.argsort(out[:, 0].view(np.uint64) if len(out) else out[:, 0])
    return out[order].T.copy()


def _prefix(s: np.ndarray, frequent: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Tile shingles of a set and how often the frequent ones among them occur (else 0)."""
    most = len(s) - -(-len(s) * percent // 100) + 1
    count = np.zeros(len(s), np.int64)
    if frequent.shape[1] and len(s):
        known = frequent[0].view(np.uint64)
        at = np.minimum(np.searchsorted(known, s), len(known) - 1)
        count = np.where(known[at] == s, frequent[1][at], 0)
    rare = np.flatnonzero(count == 0)
    if len(rare) >= most:
        pick = rare[:most]
    else:
        often = np.flatnonzero(count)
        pick = np.concatenate([rare, often[np.argsort(count[often], kind="stable")]])[:most]
    return s[pick], count[pick]


def _parts(node: int, count: np.ndarray) -> np.ndarray:
    """Part of each of a node's tiles by how often its shingle occurs; -1 for a tile that is not dealt out."""
    parts = 1 + count // TILE_ROWS
    return np.where(parts > 1, abs(node) % parts, -1).astype(np.int32)


def _members(frequent: np.ndarray, n: int, percent: int):
    """Documents -> (id, node, size); bitmap, tiles and their parts (arrays as bytes) at a node's first document in a partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[tuple[int, int]] = set()
        for batch in batches:
            out = {"node": [], "size": [], "bits": [], "tiles": [], "parts": []}
            for s in _sets(batch.column("text"), n):
                node, row = _node(s), (None, None, None)
                if len(s) and (node, len(s)) not in met:
                    met.add((node, len(s)))
                    h, c = _prefix(s, frequent, percent)
                    row = (_bits(s), h.tobytes(), _parts(node, c).tobytes())
                for name, x in zip(out, (node, len(s), *row)):
                    out[name].append(x)
            kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            yield pa.record_batch([batch.column("id"), *(pa.array(x, k) for x, k in zip(out.values(), kinds))], ["id", *out])

    return run


def _ranges(count: np.ndarray) -> np.ndarray:
    """0 to count - 1 for each count, one after the other."""
    return np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)


def _tile_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, size, tiles, parts) -> one row for each tile."""
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            piece = batch.slice(at, 1000)
            tiles = [np.frombuffer(x, np.int64) for x in piece.column("tiles").to_pylist()]
            parts = [np.frombuffer(x, np.int32) for x in piece.column("parts").to_pylist()]
            count = np.array([len(t) for t in tiles])
            yield pa.record_batch({"tile": np.concatenate(tiles), "part": np.concatenate(parts), "node": np.repeat(piece.column("node").to_numpy(), count),
                                   "size": np.repeat(piece.column("size").to_numpy(), count), "place": _ranges(count).astype(np.int32)})


def _allowed(x: np.ndarray, p: np.ndarray, y: np.ndarray, q: np.ndarray, percent: int) -> np.ndarray:
    """Whether sizes x and y allow a link of two sets whose first common shingle is at places p and q."""
    common = np.minimum(x - p, y - q)
    return (100 * np.minimum(x, y) >= percent * np.maximum(x, y)) & (100 * common >= percent * (x + y - common))


def _lone(begin: np.ndarray, end: np.ndarray, size: np.ndarray, place: np.ndarray, percent: int) -> np.ndarray:
    """Rows of groups (begin, end: bounds of each row's group) that no other row of their group allows; none in groups over PAIRED rows."""
    left = np.flatnonzero((end - begin > 1) & (end - begin <= PAIRED))
    lone = np.zeros(len(begin), bool)
    for at in range(0, len(left), PAIRS // PAIRED):
        rows = left[at: at + PAIRS // PAIRED]
        width = (end - begin)[rows]
        a, b = np.repeat(rows, width), np.repeat(begin[rows], width) + _ranges(width)
        ok = (a != b) & _allowed(size[a], place[a], size[b], place[b], percent)
        lone[rows] = np.bincount(np.repeat(np.arange(len(rows)), width), ok, len(rows)) == 0
    return lone


def _pivots(batches: Iterator[pa.RecordBatch], percent: int = 0) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (tile, part, node) -> those of tiles with two or more nodes, with the first node as pivot.

    Of a tile that was dealt out the pivots have rows too, as their own pivot: a
    node alone in its part still meets the other parts.  many: false for a tile
    that has just two nodes, its row and its pivot (one that lies across batches
    counts as many), and for a row that `percent` allows no link with any other row
    of a small tile.  Streams: the state is the last row.
    """
    last = None  # the tile that is open: key and pivot
    for batch in batches:
        t, p, v, s, at = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("tile", "part", "node", "size", "place"))
        if not len(t):
            continue
        new = np.empty(len(t), bool)
        new[1:] = (t[1:] != t[:-1]) | (p[1:] != p[:-1])
        new[0] = last is None or (t[0], p[0]) != last[:2]
        begins = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        own = group >= 0
        pivot, psize, pplace = (np.empty(len(t), x.dtype) for x in (v, s, at))
        for k, (x, source) in enumerate(((pivot, v), (psize, s), (pplace, at))):
            x[own] = source[begins][group[own]]
            if not new[0]:
                x[~own] = last[2 + k]
        other = (v != pivot) | (s != psize)
        # copies of a node from several partitions are neighbours: one row is enough
        again = np.zeros(len(t), bool)
        again[1:] = (v[1:] == v[:-1]) & (s[1:] == s[:-1]) & ~new[1:]
        keep = np.flatnonzero((other & ~again) | (new & (p >= 0)))
        others = np.bincount(group[keep][group[keep] >= 0], minlength=len(begins))
        many = (p >= 0) | ~own | (group == len(begins) - 1)
        many[own] |= others[group[own]] > 1
        # tiles that lie in this batch as a whole
        whole = np.flatnonzero(own & (p < 0) & (group < len(begins) - 1) & many & ~again)
        if percent and len(whole):
            _, start, count = np.unique(group[whole], return_index=True, return_counts=True)
            bounds = np.repeat(start, count), np.repeat(start + count, count)
            many[whole] &= ~_lone(*bounds, s[whole].astype(np.int64), at[whole].astype(np.int64), percent)
        yield pa.record_batch([pa.array(x[keep]) for x in (t, p, v, s, at, pivot, psize, pplace, many)],
                              ["tile", "part", "node", "size", "place", "pivot", "pivot_size", "pivot_place", "many"])
        last = (t[-1], p[-1], pivot[-1], psize[-1], pplace[-1])


def _bits(s: np.ndarray) -> bytes:
    """Bitmap of the set's shingles by their low bits; four to eight bits for each, a power of two."""
    out = np.zeros(max(COARSE, 1 << int(4 * len(s)).bit_length()), np.uint8)
    out[(s & np.uint64(len(out) - 1)).astype(np.int64)] = 1
    return np.packbits(out, bitorder="little").tobytes()


def _folded(bits: bytes, width: int) -> np.ndarray:
    """The bitmap of the same set with `width` bytes (a power of two, not more than it has)."""
    x = np.frombuffer(bits, np.uint64)
    while len(x) * 8 > width:
        x = x[: len(x) // 2] | x[len(x) // 2:]
    return x


def _may_link(size: np.ndarray, bits: np.ndarray, sizes: np.ndarray, others: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Upper bound of the overlap of sets with others (rows of bitmaps), and whether it allows a link."""
    mine = np.bitwise_count(bits & ~others).sum(axis=1).astype(np.int64)
    theirs = np.bitwise_count(others & ~bits).sum(axis=1).astype(np.int64)
    common = np.minimum(size - mine, sizes - theirs)  # each bit that one side alone has is a shingle that the other lacks
    return common, 100 * common >= percent * (size + sizes - common)


def _coarse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, size, bits) with bitmaps of COARSE bits."""
    for batch in batches:
        bits = [_folded(x, COARSE // 8).tobytes() for x in batch.column("bits").to_pylist()]
        yield pa.record_batch([batch.column("node"), batch.column("size"), pa.array(bits, pa.binary())], ["node", "size", "bits"])


def _named_texts(n: int):
    """(text) -> (text, node, size)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [(_node(s), len(s)) for s in _sets(batch.column("text"), n)]
            yield pa.record_batch([batch.column("text"), pa.array([a for a, _ in sets], pa.int64()), pa.array([b for _, b in sets], pa.int32())],
                                  ["text", "node", "size"])

    return run


def _sent_sets(n: int, most: int = 4 << 20):
    """(text, node, size, to) -> the sorted array as bytes, a row for each receiver; rows of at most `most` bytes at a time."""
    names = ["dst", "dst_size", "part", "node", "size", "shingles"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for batch in batches:
            for k, (s, node, size) in enumerate(zip(_sets(batch.column("text"), n), batch.column("node").to_pylist(), batch.column("size").to_pylist())):
                if len(s) != size or _node(s) != node:  # another text with the same id
                    continue
                raw = s.tobytes()
                for x in batch.column("to")[k].as_py():
                    out.append((x["dst"], x["dst_size"], x["part"], node, size, raw))
                    held += len(raw) + 32
                    if held >= most:
                        yield pa.record_batch([pa.array(c, kind) for c, kind in zip(zip(*out), kinds)], names)
                        out, held = [], 0
        if out:
            yield pa.record_batch([pa.array(c, kind) for c, kind in zip(zip(*out), kinds)], names)

    return run


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exact: intersection of two sorted arrays."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    common = int((large[at] == small).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def _verify(percent: int):
    """Rows by receiver, its own set first -> senders (node) and receivers (other) that link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, mine = None, None
        for batch in batches:
            out, last = [], None
            for *key, node, size, raw in (row for at in range(0, batch.num_rows, 200)
                                          for row in zip(*(batch.column(c).slice(at, 200).to_pylist() for c in ("dst", "dst_size", "part", "node", "size", "shingles")))):
                if (node, size) == tuple(key[:2]):
                    held, mine = key, np.frombuffer(raw, np.uint64)
                elif key == held and (key, node, size) != last and _linked(np.frombuffer(raw, np.uint64), mine, percent):
                    out.append((node, key[0]))
                last = (key, node, size)
            yield pa.record_batch([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["node", "other"])

    return run


def _links(pairs: DataFrame, base: DataFrame, nodes: DataFrame, n: int, percent: int) -> DataFrame:
    """pairs (node, size, other, other_size; stored) -> the linked ones (node, other): the sets of these nodes only are made again.

    The side with fewer pairs sends its set, so a node sends at most as many sets
    as the square root of twice the pairs.
    """
    sides = pairs.select("node", "size").unionByName(pairs.select(F.col("other").alias("node"), F.col("other_size").alias("size")))
    degree = sides.groupBy("node", "size").agg(F.count(F.lit(1)).alias("k"))
    both = (pairs.join(degree, ["node", "size"])
            .join(degree.select(F.col("node").alias("other"), F.col("size").alias("other_size"), F.col("k").alias("other_k")), ["other", "other_size"]))
    a, b = F.struct("k", "node", "size"), F.struct(F.col("other_k").alias("k"), F.col("other").alias("node"), F.col("other_size").alias("size"))
    sent = (both.select(F.least(a, b).alias("s"), F.greatest(a, b).alias("d"))
            .select("s.node", "s.size", F.col("d.node").alias("dst"), F.col("d.size").alias("dst_size"), F.expr(f"1 + int(d.k div {SENDERS})").alias("parts"))
            .withColumn("part", F.pmod(F.xxhash64("node", "size"), "parts").cast("int")))
    own = (sent.select("dst", "dst_size", "parts").distinct()
           .select(F.col("dst").alias("node"), F.col("dst_size").alias("size"), "dst", "dst_size", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")))
    to = (sent.drop("parts").unionByName(own).groupBy("node", "size").agg(F.collect_set(F.struct("dst", "dst_size", "part")).alias("to")))
    ids = nodes.where("id is not null").groupBy("node", "size").agg(F.min("id").alias("id"))
    route = to.join(ids, ["node", "size"], "left").checkpoint()
    named, routes = route.where("id is not null"), route.agg(F.sum(F.size("to"))).first()[0] or 0
    texts = (base.join(F.broadcast(named) if routes <= ROUTES else named, "id").select("text", "node", "size", "to")
             .unionByName(base.where("id is null").select("text").mapInArrow(_named_texts(n), "text string, node long, size int")
                          .join(route.where("id is null").drop("id"), ["node", "size"]).select("text", "node", "size", "to")))
    return (texts.mapInArrow(_sent_sets(n), "dst long, dst_size int, part int, node long, size int, shingles binary")
            .repartition("dst", "dst_size", "part")
            .sortWithinPartitions("dst", "dst_size", "part", F.expr("node <> dst or size <> dst_size"), "node", "size")
            .mapInArrow(_verify(percent), "node long, other long"))


def _bounded(percent: int):
    """(node, size, bits, other, other_size, other_bits) -> pairs whose bitmaps allow a link, with the bound of their similarity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, bound = [], []
            for k, (a, x, b, y) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("size", "bits", "other_size", "other_bits")))):
                width = min(len(x), len(y))
                common, ok = _may_link(np.array([a]), _folded(x, width)[None, :], np.array([b]), _folded(y, width)[None, :], percent)
                if ok[0]:
                    keep.append(k)
                    bound.append(float(common[0] / (a + b - common[0])))
            out = batch.select(["node", "size", "other", "other_size"]).take(pa.array(keep, pa.int64()))
            yield pa.record_batch([*out.columns, pa.array(bound, pa.float64())], [*out.schema.names, "bound"])

    return run


CELL_ROW = ["tile", "band", "cell", "side", "own", "node", "size", "place", "component"]


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]]:
    """Rows by (tile, band, cell) -> rows of whole cells, and the bounds of each row's cell.  Streams: the state is the rows of the cell that is open."""
    held: list[dict[str, np.ndarray]] = []

    def close(rows: dict[str, np.ndarray], begins: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
        count = np.diff(np.r_[begins, len(rows["tile"])])
        return rows, np.repeat(begins, count), np.repeat(begins + count, count)

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in CELL_ROW}
        rows["size"], rows["place"] = rows["size"].astype(np.int64), rows["place"].astype(np.int64)
        if "bits" in batch.schema.names:
            rows["bits"] = np.frombuffer(b"".join(batch.column("bits").to_pylist()), np.uint64).reshape(batch.num_rows, -1)
        new = np.r_[True, np.any([rows[c][1:] != rows[c][:-1] for c in ("tile", "band", "cell")], axis=0)]
        if held:
            new[0] = any(rows[c][0] != held[-1][c][-1] for c in ("tile", "band", "cell"))
        begins = np.flatnonzero(new)
        if not len(begins):
            held.append(rows)
            continue
        # the open cell ends here: it and the whole cells of this batch
        cut = begins[-1]
        if held or cut:
            whole = {c: np.concatenate([*(h[c] for h in held), rows[c][:cut]]) for c in rows}
            before = sum(len(h["tile"]) for h in held)
            starts = begins[:-1] + before
            yield close(whole, np.r_[0, starts] if before and (not len(starts) or starts[0]) else starts)
        held = [{c: x[cut:] for c, x in rows.items()}]
    if held:
        yield close({c: np.concatenate([h[c] for h in held]) for c in held[0]}, np.array([0]))


def _meeting(rows: dict[str, np.ndarray], begin: np.ndarray, end: np.ndarray, percent: int, best: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of a cell, across components, that place and size allow, some at a time.

    Rows of side 0 meet each other and side 1, rows of side -1 meet side 1 only.
    best: two rows of side 0 are a pair of either.
    """
    size, place, comp, side, own = (rows[c] for c in ("size", "place", "component", "side", "own"))
    left = np.flatnonzero((side <= 0) & (end - begin > 1))
    width = (end - begin)[left]
    upto = np.cumsum(width)
    at = 0
    while at < len(left):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS, "right")))
        a = np.repeat(left[at:to], width[at:to])
        b = np.repeat(begin[left[at:to]], width[at:to]) + _ranges(width[at:to])
        at = to
        x, y = size[a], size[b]
        ok = ((comp[a] != comp[b]) & (own[a] | own[b]) & ((side[b] == 1) | ((side[a] == 0) & (side[b] == 0) & ((a < b) | best)))
              & _allowed(x, place[a], y, place[b], percent))
        yield a[ok], b[ok]


def _partnered(percent: int):
    """Rows by (tile, band, cell) -> those that are in a pair which place and size allow."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, begin, end in _cells(batches):
            met = np.zeros(len(begin), bool)
            for a, b in _meeting(rows, begin, end, percent, False):
                met[a] = met[b] = True
            yield pa.record_batch([pa.array(rows[c][met].astype(np.int32) if c in ("size", "place") else rows[c][met]) for c in CELL_ROW], CELL_ROW)

    return run


def _across(percent: int, best: bool):
    """Rows by (tile, band, cell) -> pairs across components that place, size and bitmap allow, with the bitmap's bound.

    best: of every row of side 0 or -1 its likeliest pair in the cell.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, begin, end in _cells(batches):
            node, size, bits = rows["node"], rows["size"], rows["bits"]
            for a, b in _meeting(rows, begin, end, percent, best):
                common, ok = _may_link(size[a], bits[a], size[b], bits[b], percent)
                a, b, common = a[ok], b[ok], common[ok]
                bound = common / (size[a] + size[b] - common)
                if best and len(a):
                    order = np.lexsort((-bound, a))
                    order = order[np.r_[True, a[order][1:] != a[order][:-1]]]
                    a, b, bound = a[order], b[order], bound[order]
                if len(a):
                    yield pa.record_batch({"node": node[a], "size": size[a].astype(np.int32), "other": node[b], "other_size": size[b].astype(np.int32), "bound": bound})

    return run


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of docs: id, n_shingles, component_id (smallest id reachable by links, its own included)."""
    spark = docs.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/ngram-join-{uuid.uuid4().hex}"
    ship_package(spark)
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    base.mapInArrow(_members(frequent_shingles(base, n), n, percent), f"id {dict(base.dtypes)['id']}, node long, size int, bits binary, tiles binary, parts binary").write.parquet(f"{folder}/nodes")
    stored = spark.read.parquet(f"{folder}/nodes")
    nodes = stored.select("id", "node", "size")
    tiles = stored.where("tiles is not null").select("node", "size", "tiles", "parts").mapInArrow(_tile_rows, "tile long, part int, node long, size int, place int")
    # tiles with two nodes or more
    (tiles.repartition("tile", "part").sortWithinPartitions("tile", "part", "node", "size")
     .mapInArrow(lambda batches: _pivots(batches, percent), "tile long, part int, node long, size int, place int, pivot long, pivot_size int, pivot_place int, many boolean").write.parquet(f"{folder}/tiles"))
    release_shuffles(spark)
    open_tiles = spark.read.parquet(f"{folder}/tiles")
    pivot = F.col("pivot").alias("node"), F.col("pivot_size").alias("size")
    met = open_tiles.select("node", "size").unionByName(open_tiles.select(*pivot)).distinct()
    (stored.where("bits is not null").join(met, ["node", "size"], "left_semi").select("node", "size", "bits")
     .dropDuplicates(["node", "size"]).write.parquet(f"{folder}/signatures"))
    release_shuffles(spark)
    # tiles with more than one pair
    many = open_tiles.where("many")
    (many.select("tile", "node", "size", "place").unionByName(many.select("tile", *pivot, F.col("pivot_place").alias("place"))).distinct()
     .write.parquet(f"{folder}/many"))
    many = spark.read.parquet(f"{folder}/many")
    bits = spark.read.parquet(f"{folder}/signatures")
    coarse = bits.mapInArrow(_coarse, "node long, size int, bits binary")

    fits = f"100L * least(size, other_size) >= {percent} * greatest(size, other_size)"
    # a pair is allowed in the tile of its first common shingle at least
    first_fits = f"{100 + percent}L * least(size - place, pivot_size - pivot_place) >= {percent} * (size + pivot_size)"
    star = open_tiles.where(f"part >= 0 OR {first_fits}").select("node", "size", F.col("pivot").alias("other"), F.col("pivot_size").alias("other_size"))
    # the pivots of a tile that was dealt out meet the smallest of them
    heads = open_tiles.where("part >= 0").groupBy("tile", "part").agg(F.min(F.struct("pivot", "pivot_size")).alias("h")).select("tile", "h.pivot", "h.pivot_size")
    top = heads.groupBy("tile").agg(F.min(F.struct("pivot", "pivot_size")).alias("m"), F.count(F.lit(1)).alias("k")).where("k > 1")
    star = star.unionByName(heads.join(top, "tile").select(F.col("pivot").alias("node"), F.col("pivot_size").alias("size"),
                                                           F.col("m.pivot").alias("other"), F.col("m.pivot_size").alias("other_size"))).where("node <> other")
    # both sides name every column anew, so that their exchange is the same one
    mine, theirs = bits.toDF("my_node", "my_size", "my_bits"), bits.toDF("their_node", "their_size", "other_bits")

    def bounded(pairs: DataFrame) -> DataFrame:
        return (pairs.join(mine, F.expr("node = my_node AND size = my_size")).join(theirs, F.expr("other = their_node AND other_size = their_size"))
                .select("node", "size", F.col("my_bits").alias("bits"), "other", "other_size", "other_bits")
                .mapInArrow(_bounded(percent), "node long, size int, other long, other_size int, bound double"))

    allowed = bounded(star.where(fits).distinct()).checkpoint()
    release_shuffles(spark)
    # the likeliest pivot of every node; the other pairs come below where they still matter
    likely = (allowed.groupBy("node", "size").agg(F.max(F.struct("bound", "other", "other_size")).alias("b"))
              .select("node", "size", "b.other", "b.other_size").checkpoint())
    first = _links(likely, base, nodes, n, percent).checkpoint()
    release_shuffles(spark)
    found = connected_components(first.toDF("a", "b"))

    # rounds over the likeliest pairs across components, then one over all that are left
    links, ratio = first, float(np.log(100 / percent))
    for best in [True] * ROUNDS + [False]:
        release_shuffles(spark)
        every = (many.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
                 .withColumn("band", F.floor(F.log(F.col("size").cast("double")) / ratio + 1e-9).cast("int")).checkpoint())
        release_shuffles(spark)
        mixed = (every.groupBy("tile", "component").agg(F.count(F.lit(1)).alias("k"), F.max("band").alias("top")).groupBy("tile")
                 .agg(F.count(F.lit(1)).alias("components"), F.sum("k").alias("rows"), F.max("top").alias("top"), F.max(F.struct("k", "component")).alias("major"))
                 .where("components > 1")
                 .select("tile", "top", F.col("major.component").alias("major"), F.expr(f"int(ceil((rows - major.k) / {TILE_ROWS}))").alias("m"),
                         F.expr(f"int(ceil(major.k / {TILE_ROWS}))").alias("r")))
        # cells: a block of minors with a block of the others (with the first one the minors meet each other, too), and two blocks of minors
        cells = """CASE WHEN minor THEN
            concat(transform(sequence(0, r - 1), j -> named_struct('cell', bigint(i) * r + j, 'side', CASE WHEN j = 0 THEN 0 ELSE -1 END)),
                   transform(filter(sequence(0, m - 1), j -> j <> i),
                             j -> named_struct('cell', -1 - (bigint(least(i, j)) * m + greatest(i, j)), 'side', CASE WHEN i < j THEN -1 ELSE 1 END)))
            ELSE transform(sequence(0, m - 1), j -> named_struct('cell', bigint(j) * r + i, 'side', 1)) END"""
        rows = (every.join(mixed, "tile").withColumn("minor", F.col("component") != F.col("major"))
                .withColumn("i", F.expr("int(pmod(xxhash64(node, size), CASE WHEN minor THEN m ELSE r END))"))
                .withColumn("c", F.explode(F.expr(cells)))
                # a band's sets meet each other (own) and the smaller ones of the band below, if their place still allows the least size of the band
                .withColumn("b", F.explode(F.expr(f"""CASE WHEN band < top AND (size - place) * {100 + percent} >= {percent} * (size + exp({ratio!r} * (band + 1)) * 0.999999D)
                                                     THEN array(named_struct('band', band, 'own', true), named_struct('band', band + 1, 'own', false))
                                                     ELSE array(named_struct('band', band, 'own', true)) END""")))
                .select("tile", "b.band", "c.cell", "c.side", "b.own", "node", "size", "place", "component"))
        rows = (rows.repartition("tile", "band", "cell").sortWithinPartitions("tile", "band", "cell")
                .mapInArrow(_partnered(percent), "tile long, band int, cell long, side int, own boolean, node long, size int, place int, component long"))
        pairs = (rows.join(coarse, ["node", "size"]).repartition("tile", "band", "cell").sortWithinPartitions("tile", "band", "cell")
                 .mapInArrow(_across(percent, best), "node long, size int, other long, other_size int, bound double"))
        # the pivots that are left, the only pairs of tiles with two nodes
        side = found.select(F.col("node").alias("other"), F.col("component").alias("other_component"))
        pairs = pairs.unionByName(allowed.join(found, "node", "left").join(side, "other", "left")
                                  .where(F.coalesce("component", "node") != F.coalesce("other_component", "other")).select(allowed.columns))
        if best:
            pairs = pairs.groupBy("node", "size").agg(F.max(F.struct("bound", "other", "other_size")).alias("b")).select("node", "size", "b.other", "b.other_size")
        pairs = (pairs.select(F.least(F.struct("node", "size"), F.struct(F.col("other").alias("node"), F.col("other_size").alias("size"))).alias("a"),
                              F.greatest(F.struct("node", "size"), F.struct(F.col("other").alias("node"), F.col("other_size").alias("size"))).alias("b"))
                 .select("a.node", "a.size", F.col("b.node").alias("other"), F.col("b.size").alias("other_size")).distinct())
        pairs = bounded(pairs).drop("bound").checkpoint()
        release_shuffles(spark)
        new = _links(pairs, base, nodes, n, percent).checkpoint()
        release_shuffles(spark)
        if best and new.limit(1).count() == 0:
            continue
        links = links.unionByName(new)
        found = connected_components(links.toDF("a", "b"))

    named = nodes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = named.where("size > 0").groupBy("component").agg(F.min("id").alias("smallest"), F.count(F.lit(1)).alias("k")).where("k > 1").drop("k")
    return (named.join(smallest, "component", "left")
            .select(F.col("id").alias(id_col), F.col("size").cast("long").alias("n_shingles"),
                    F.when((F.col("size") == 0) | F.col("smallest").isNull(), F.col("id")).otherwise(F.col("smallest")).alias("component_id")))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs that stay: of each component the row with the smallest id (every row with that id)."""
    keep = near_components(docs, id_col, text_col, n, percent).where(F.col(id_col).eqNullSafe(F.col("component_id"))).select(F.col(id_col).alias("__keep"))
    return docs.join(keep.distinct(), F.col(id_col).eqNullSafe(F.col("__keep")), "left_semi")

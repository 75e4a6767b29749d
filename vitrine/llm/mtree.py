"""Exact top-k inner products by best-first search in M-trees.

Vectors become integers floor(scale * x).  With a further coordinate
sqrt(M - |x|^2), M the largest squared norm, all candidates lie on one sphere,
and the largest inner products with a query are the nearest neighbours of
(q, 0): a metric space, so the triangle inequality holds.

* Routing: centres are chosen from a bounded sample (farthest first), more of them
  for more rows; every candidate goes to its nearest centre.  A centre's rows are cut
  into trees of about TREE_ROWS by a hash, so a vector that a third of all rows share
  makes many trees and no large one.
* Index: every tree is built once: pages of at most PAGE entries; an entry holds its
  distance to the page's parent object, an inner entry also its covering radius.  A
  tree is stored as one row of bounded size, its vectors in the order of its pages.
* Search: queries go in blocks, near ones together.  A block first visits the few trees
  that are nearest for most of its queries; a query's k-th score there bounds the
  second round, in which a block visits only trees whose ball can hold a better or
  equal score for one of its queries.  In a tree a block goes down the pages nearest
  first, with the queries that still need each page; stored parent distances spare
  distance computations by the triangle inequality.  Where most queries need most
  children of a page, its rows are scored as one matrix product; where few queries
  need a tree, each makes its own best-first search.
* The second round deals several blocks and several trees to a task, so a block is sent
  once per GROUP_ROWS rows and a tree once per CHUNK blocks, and a task returns at most
  k hits of a query for all its trees.  The pairs of queries and rows that no bound
  excludes are all scored: without clusters in the data that is all of them.
* Scores are exact integers; bounds only skip what cannot enter the result
  (with a slack for rounding, so that ties are kept).

Defined results: vectors that are null, empty, or hold null or non-finite
components take no part, nor do rows without an id; only vectors of one length
meet; equal scores go to the smaller id; rows that repeat an id are never each
other's partners.  Components times scale must stay below 2^26.
"""

from __future__ import annotations

import heapq
import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.shipping import ship_package
from vitrine.session import ensure_checkpoint_dir

#: entries of a page, rows and numbers in a tree, queries searched together, sample and least number of the routing centres
PAGE, TREE_ROWS, TREE_CELLS, QUERY_BLOCK, SAMPLE, CENTRES = 64, 4096, 1 << 20, 4096, 4096, 64
#: balls that meet the blocks of queries as one row; trees of a block's first round; rows and numbers in the trees, and blocks of queries, of a task of the second
SLAB, HOME, GROUP_ROWS, GROUP_CELLS, CHUNK = 1024, 8, 1 << 16, 1 << 24, 4
#: rows scored at once; hits taken before the best are kept; queries that search alone; share of the children needed from which a page is read whole
SLICE, HITS, ALONE, WHOLE = 128, 1 << 17, 3, 0.5
#: score and id to beat of a query that has no k-th hit yet
NONE, NO_ID = np.iinfo(np.int64).min, np.iinfo(np.int64).max
_SLACK = 1e-6


def integer_vectors(rows: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """id, vec (array<long>), norm (squared), dim of the rows that take part."""
    raw = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("x")).where("id is not null and x is not null and size(x) > 0")
    finite = raw.where(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    return (finite.withColumn("vec", F.transform("x", lambda v: F.floor(v * scale).cast("long"))).withColumn("dim", F.size("x"))
            .select("id", "vec", "dim", F.aggregate("vec", F.lit(0).cast("long"), lambda a, v: a + v * v).alias("norm")))


def _matrix(column) -> np.ndarray:
    """Arrow list column of equal lengths -> int64 matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def lifted(vec: np.ndarray, norm: np.ndarray, top: float) -> np.ndarray:
    """Candidates on the sphere of squared radius `top`."""
    return np.concatenate([vec.astype(float), np.sqrt(np.maximum(top - norm, 0.0))[:, None]], axis=1)


def _distances(points: np.ndarray, one: np.ndarray) -> np.ndarray:
    away = points - one
    return np.sqrt(np.einsum("ij,ij->i", away, away))


def _spread(points: np.ndarray, k: int) -> tuple[list[int], np.ndarray]:
    """Up to k distinct points, each the farthest from those before, and for every point which of them is nearest."""
    chosen, gap, nearest = [0], _distances(points, points[0]), np.zeros(len(points), np.int64)
    while len(chosen) < k and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        away = _distances(points, points[chosen[-1]])
        nearest[away < gap] = len(chosen) - 1
        gap = np.minimum(gap, away)
    return chosen, nearest


def farthest_first(points: np.ndarray, k: int) -> np.ndarray:
    return points[_spread(points, k)[0]]


def chained(points: np.ndarray) -> np.ndarray:
    """The points in another order: each is followed by the nearest of those left."""
    order, left = [0], np.arange(1, len(points))
    while len(left):
        at = int(_distances(points[left], points[order[-1]]).argmin())
        order.append(int(left[at]))
        left = np.delete(left, at)
    return points[order]


def _gaps(vec: np.ndarray, norm: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Distances of the queries (vec, 0) to lifted centres."""
    return np.sqrt(np.maximum(norm[:, None] + (centres ** 2).sum(axis=1) - 2 * (vec @ centres[:, :-1].T), 0.0))


class Hits:
    """The k best hits of each query of a block, and what a further hit must beat: a score (floor) and, at that score, an id (edge).

    own: the queries' ids; reach: |q|^2 + M, squared distance = reach - 2 * score; limit: the distance at the floor.
    """

    def __init__(self, own: np.ndarray, reach: np.ndarray, k: int, floor: np.ndarray, edge: np.ndarray):
        self.own, self.reach, self.k, self.floor, self.edge = own, reach, k, floor.copy(), edge.copy()
        self.query = self.id = self.score = np.zeros(0, np.int64)
        self.fresh: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0
        self._limits()

    def _limits(self) -> None:
        near = np.sqrt(np.maximum(self.reach - 2.0 * self.floor, 0.0)) + _SLACK * (1 + np.sqrt(self.reach))
        self.limit = np.where(self.floor == NONE, np.inf, near)

    def add(self, query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        score = score.astype(np.int64)
        better = np.flatnonzero(((score > self.floor[query]) | (ids < self.edge[query])) & (ids != self.own[query]))
        self.fresh.append((query[better], ids[better], score[better]))
        self.held += len(better)
        if self.held > HITS:
            self.settle()

    def settle(self) -> None:
        if not self.held:
            return
        query, ids, score = (np.concatenate(x) for x in zip((self.query, self.id, self.score), *self.fresh))
        order = np.lexsort((ids, -score, query))
        query, ids, score = query[order], ids[order], score[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        kept, last = place < self.k, place == self.k - 1
        self.query, self.id, self.score = query[kept], ids[kept], score[kept]
        self.floor[query[last]], self.edge[query[last]] = score[last], ids[last]
        self.fresh, self.held = [], 0
        self._limits()


class MTree:
    """Paged metric tree over lifted points.

    A page is a dict: centre, entries (row numbers for a leaf, pages for an inner
    page), to_parent (distance of each entry's object to the page's centre), span (where
    its rows lie in the order of the pages), and for inner pages the entries' centres and
    covering radii.
    """

    def __init__(self, points: np.ndarray):
        self.points = points
        self.leaves: list[np.ndarray] = []
        self.placed = 0
        self.root = self._page(np.arange(len(points)), int(_distances(points, points.mean(axis=0)).argmin()))

    def _page(self, rows: np.ndarray, centre: int) -> dict:
        points = self.points
        away = _distances(points[rows], points[centre])
        page = {"centre": points[centre], "radius": float(away.max())}
        if len(rows) <= PAGE or page["radius"] == 0.0:
            return self._leaf(page, rows, away)
        heads, to = _spread(points[rows], min(PAGE, max(2, len(rows) // (PAGE // 2))))
        children = []
        for c in range(len(heads)):
            if len(own := rows[to == c]):
                children.append(self._page(own, int(rows[heads[c]])))
        if len(children) == 1:  # no split: its child holds all rows
            return children[0]
        centres = np.stack([c["centre"] for c in children])
        return page | {"span": (children[0]["span"][0], self.placed), "children": children, "centres": centres, "radii": np.array([c["radius"] for c in children]),
                       "to_parent": _distances(centres, page["centre"])}

    def _leaf(self, page: dict, rows: np.ndarray, away: np.ndarray) -> dict:
        order = np.argsort(away)
        self.leaves.append(rows[order])
        self.placed += len(rows)
        return page | {"rows": rows[order], "to_parent": away[order], "span": (self.placed - len(rows), self.placed)}

    def search(self, vec: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int, reach: float, floor: int | None) -> list[tuple[int, int]]:
        """The k best (score, id) by best-first search; `floor`: a score that the result must reach.

        reach is |q|^2 + M: squared distance = reach - 2 * score.
        """
        point = np.append(query.astype(float), 0.0)
        best: list[tuple[int, int]] = []  # heap of (score, -id), the worst on top
        limit = float("inf") if floor is None else np.sqrt(max(reach - 2.0 * floor, 0.0)) * (1 + _SLACK) + _SLACK
        start = float(np.sqrt(((point - self.root["centre"]) ** 2).sum()))
        queue, serial = [(max(0.0, start - self.root["radius"]), 0, start, self.root)], 1
        while queue:
            least, _, to_centre, page = heapq.heappop(queue)
            if least > limit:
                break
            if "rows" in page:
                near = np.abs(to_centre - page["to_parent"]) <= limit  # others are too far by the triangle inequality
                rows = page["rows"][near]
                rows = rows[ids[rows] != own]
                if not len(rows):
                    continue
                scores = vec[rows] @ query
                if len(rows) > k:
                    top = np.lexsort((ids[rows], -scores))[:k]
                    rows, scores = rows[top], scores[top]
                for s, i in zip(scores.tolist(), ids[rows].tolist()):
                    if floor is not None and s < floor:
                        continue
                    if len(best) < k:
                        heapq.heappush(best, (s, -i))
                    elif (s, -i) > best[0]:
                        heapq.heapreplace(best, (s, -i))
                if len(best) == k:
                    limit = min(limit, np.sqrt(max(reach - 2.0 * best[0][0], 0.0)) * (1 + _SLACK) + _SLACK)
            else:
                near = np.flatnonzero(np.abs(to_centre - page["to_parent"]) - page["radii"] <= limit)
                away = _distances(page["centres"][near], point)
                for c, d in zip(near.tolist(), away.tolist()):
                    low = max(0.0, d - float(page["radii"][c]))
                    if low <= limit:
                        heapq.heappush(queue, (low, serial, d, page["children"][c]))
                        serial += 1
        return [(s, -i) for s, i in best]

    def in_order(self) -> np.ndarray:
        """Numbers the rows by the order of the pages and lets the points go; their old numbers in the new order."""
        order, stack = np.concatenate(self.leaves), [self.root]
        while stack:
            page = stack.pop()
            if "rows" in page:
                page["rows"] = np.arange(*page["span"])
            stack += page.get("children", [])
        self.points, self.leaves = None, []
        return order

    def search_block(self, vec: np.ndarray, ids: np.ndarray, queries: np.ndarray, exact: np.ndarray, norm: np.ndarray, hits: Hits, who: np.ndarray, away: np.ndarray) -> None:
        """Adds the hits of the queries `who`, `away` from the root's centre, for the rows of the tree in its order.

        queries: floats for distances; exact: in the type of vec, whose products are exact.
        """
        stack = [(self.root, who, away)]
        while stack:
            page, who, away = stack.pop()
            near = away - page["radius"] <= hits.limit[who]
            who, away = who[near], away[near]
            if not len(who):
                continue
            limit, (low, high) = hits.limit[who], page["span"]
            if "children" in page:
                need = np.abs(away[:, None] - page["to_parent"]) - page["radii"] <= limit[:, None]
                some = np.flatnonzero(need.any(axis=1))  # the others are too far by the triangle inequality
                gap = np.full(need.shape, np.inf)
                gap[some] = _gaps(queries[who[some]], norm[who[some]], page["centres"])
                need &= gap - page["radii"] <= limit[:, None]
                if need.mean() < WHOLE:
                    least = np.where(need, gap - page["radii"], np.inf).min(axis=0)
                    for c in np.argsort(-least, kind="stable").tolist():  # the nearest on top
                        if need[:, c].any():
                            stack.append((page["children"][c], who[need[:, c]], gap[need[:, c], c]))
                    continue
            else:  # the rows lie by their distance to the page's centre
                low, high = low + int(np.searchsorted(page["to_parent"], (away - limit).min())), low + int(np.searchsorted(page["to_parent"], (away + limit).max(), "right"))
            asked = exact if len(who) == len(exact) else exact[who]
            for at in range(low, high, SLICE):
                upto = min(at + SLICE, high)
                scores = asked @ vec[at:upto].T
                found = np.flatnonzero(scores >= hits.floor[who].astype(exact.dtype)[:, None])  # faster than pairs of places
                q, r = np.divmod(found, upto - at)
                hits.add(who[q], ids[at:upto][r], scores.ravel()[found])


def _nearest_centre(centres: dict[int, np.ndarray], tops: dict[int, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, norms = batch.column("dim").to_numpy(), batch.column("norm").to_numpy()
            centre = np.zeros(batch.num_rows, np.int32)
            for d in np.unique(dims).tolist():
                at = np.flatnonzero(dims == d)
                points = lifted(_matrix(batch.column("vec").take(pa.array(at))), norms[at], tops[d])
                c = centres[d]
                centre[at] = np.argmin((points ** 2).sum(axis=1)[:, None] - 2 * points @ c.T + (c ** 2).sum(axis=1), axis=1)
            yield pa.record_batch([*(batch.column(x) for x in ("id", "vec", "dim", "norm")), pa.array(centre)], ["id", "vec", "dim", "norm", "centre"])

    return run


def _narrow(matrix: np.ndarray) -> np.ndarray:
    """The same integers in the narrowest type."""
    for kind in (np.int8, np.int16, np.int32):
        if np.iinfo(kind).min <= matrix.min() and matrix.max() <= np.iinfo(kind).max:
            return matrix.astype(kind)
    return matrix


def _exact_type(a: float, b: float) -> type:
    """A type that holds every partial sum of the products of two vectors with these squared norms."""
    most = float(np.sqrt(a) * np.sqrt(b))
    return np.float32 if most < 2 ** 24 else np.float64 if most < 2 ** 53 else np.int64


def _trees(tops: dict[int, float]):
    """A tree's rows -> the tree, its vectors and ids in its order, its root's routing object and covering radius."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        vec, norm, ids = _matrix(table.column("vec")), table.column("norm").to_numpy(), table.column("id").to_numpy()
        tree = MTree(lifted(vec, norm, tops[key[0].as_py()]))
        order = tree.in_order()
        return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "centre": pa.array([key[1].as_py()], pa.int32()), "part": pa.array([key[2].as_py()], pa.int32()),
                         "rows": pa.array([len(ids)], pa.int64()), "ball": pa.array([tree.root["centre"].tolist()], pa.list_(pa.float64())), "radius": pa.array([tree.root["radius"]]),
                         "tree": pa.array([pickle.dumps((tree, _narrow(vec[order]), ids[order], float(norm.max())), protocol=5)], pa.binary())})

    return run


def _blocks(key: tuple, table: pa.Table) -> pa.Table:
    """A block's queries -> one row: ids, vectors, squared norms, scores and ids to beat, trees visited."""
    ids = table.column("id").to_numpy()
    block = (ids, _narrow(_matrix(table.column("vec"))), table.column("norm").to_numpy(), np.full(len(ids), NONE), np.full(len(ids), NO_ID), [])
    return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "block": pa.array([key[1].as_py()], pa.int64()), "queries": pa.array([pickle.dumps(block, protocol=5)], pa.binary())})


def _slabs(key: tuple, table: pa.Table) -> pa.Table:
    """Up to SLAB balls -> one row."""
    packed = (*(table.column(c).to_numpy() for c in ("centre", "part", "group")), _matrix(table.column("ball")), table.column("radius").to_numpy())
    return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "slab": pa.array([key[1].as_py()], pa.int32()), "balls": pa.array([pickle.dumps(packed, protocol=5)], pa.binary())})


def _lows(table: pa.Table) -> tuple[tuple, list[tuple]]:
    """A block with its slabs -> the block; of each slab centre, part, group of its trees, and the least distance of every query to each tree's rows."""
    block = pickle.loads(table.column("queries")[0].as_py())
    vec, norm = block[1].astype(float), block[2].astype(float)
    slabs = (pickle.loads(x.as_py()) for x in table.column("balls"))
    return block, [(centre, part, group, np.maximum(_gaps(vec, norm, ball) - radius, 0.0)) for centre, part, group, ball, radius in slabs]


def _homes(key: tuple, table: pa.Table) -> pa.Table:
    """The HOME trees that are nearest for most queries of a block."""
    _, slabs = _lows(table)
    votes: dict[tuple[int, int], int] = {}
    least = np.min([low.min(axis=1) for *_, low in slabs], axis=0)
    for centre, part, _, low in slabs:
        nearest, n = np.unique(low.argmin(axis=1)[low.min(axis=1) <= least], return_counts=True)
        votes |= {(int(centre[t]), int(part[t])): int(x) for t, x in zip(nearest, n)}
    best = sorted(votes, key=lambda t: (-votes[t], t))[:HOME]
    return pa.table({"dim": pa.array([key[0].as_py()] * len(best), pa.int32()), "block": pa.array([key[1].as_py()] * len(best), pa.int64()),
                     "centre": pa.array([c for c, _ in best], pa.int32()), "part": pa.array([p for _, p in best], pa.int32())})


def _further(tops: dict[int, float], k: int):
    """The groups that hold a tree, not visited yet, with a row that a query of the block may still need."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        (ids, _, norm, floor, edge, seen), slabs = _lows(table)
        limit, groups = Hits(ids, norm + tops[dim], k, floor, edge).limit, set()
        for centre, part, group, low in slabs:
            need = (low <= limit[:, None]).any(axis=0) & np.array([t not in seen for t in zip(centre.tolist(), part.tolist())])
            groups |= set(group[need].tolist())
        return pa.table({"dim": pa.array([dim] * len(groups), pa.int32()), "block": pa.array([key[1].as_py()] * len(groups), pa.int64()), "group": pa.array(sorted(groups), pa.int32())})

    return run


def _visit(block: tuple, trees: list[tuple], top: float, k: int) -> Hits:
    """A block's best hits in the trees (its centre and part, the tree, vectors, ids, largest squared norm) that it hasn't visited."""
    own, vec, norm, floor, edge, seen = block
    hits = Hits(own, norm + top, k, floor, edge)
    left = [t for t in trees if t[0] not in seen]
    if not left:
        return hits
    queries, kinds = vec.astype(float), {}
    gap = _gaps(queries, norm.astype(float), np.stack([t[1].root["centre"] for t in left]))
    low = gap - np.array([t[1].root["radius"] for t in left])
    for t in np.argsort(np.maximum(low, 0.0).mean(axis=0), kind="stable").tolist():
        _, tree, rows, ids, most = left[t]
        who = np.flatnonzero(low[:, t] <= hits.limit)
        kind = _exact_type(most, float(norm.max()))
        if kind not in kinds:
            kinds[kind] = vec.astype(kind)
        rows = rows.astype(kind)
        if len(who) > ALONE:
            tree.search_block(rows, ids, queries, kinds[kind], norm.astype(float), hits, who, gap[who, t])
        else:
            for q in who.tolist():
                found = tree.search(rows, ids, kinds[kind][q], int(own[q]), k, float(hits.reach[q]), None if hits.floor[q] == NONE else int(hits.floor[q]))
                hits.add(np.full(len(found), q), np.array([i for _, i in found], np.int64), np.array([s for s, _ in found], kind))
        if hits.held > len(own):
            hits.settle()
    hits.settle()
    return hits


def _opened(table: pa.Table) -> list[tuple]:
    return [((c, p), *pickle.loads(t)) for c, p, t in zip(*(table.column(x).to_pylist() for x in ("centre", "part", "tree")))]


def _first(tops: dict[int, float], k: int):
    """A block and its nearest trees -> the block with the scores that its queries must reach now, and its hits."""
    def run(key: tuple, blocks: pa.Table, trees: pa.Table) -> pa.Table:
        out = {"dim": [], "block": [], "queries": [], "query": [], "id": [], "score": []}
        for packed in blocks.column("queries").to_pylist():  # one
            block, opened = pickle.loads(packed), _opened(trees)
            hits = _visit(block, opened, tops[key[0].as_py()], k)
            block = (*block[:3], hits.floor, hits.edge, [t[0] for t in opened])
            for c, v in zip(out, (key[0].as_py(), key[1].as_py(), pickle.dumps(block, protocol=5), hits.own[hits.query], hits.id, hits.score)):
                out[c].append(v)
        kinds = (pa.int32(), pa.int64(), pa.binary(), *[pa.list_(pa.int64())] * 3)
        return pa.table({c: pa.array(v, t) for (c, v), t in zip(out.items(), kinds)})

    return run


def _second(tops: dict[int, float], k: int):
    """Blocks and trees of a task -> the blocks' hits in the trees that they haven't visited."""
    def run(key: tuple, blocks: pa.Table, trees: pa.Table) -> pa.Table:
        opened, found = _opened(trees), [np.zeros((3, 0), np.int64)]
        for packed in blocks.column("queries").to_pylist():
            hits = _visit(pickle.loads(packed), opened, tops[key[0].as_py()], k)
            found.append(np.stack([hits.own[hits.query], hits.id, hits.score]))
        return pa.table(dict(zip(("query", "id", "score"), map(pa.array, np.concatenate(found, axis=1)))))

    return run


def top_k(rows: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", scale: float = 64.0) -> DataFrame:
    """query_id, rank (from 1), id, score: for every row of queries the k rows of highest integer inner product, its own id excepted."""
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    base = integer_vectors(rows, id_col, vec_col, scale)
    found = base.groupBy("dim").agg(F.max("norm").alias("top"), F.count(F.lit(1)).alias("rows")).collect()  # one row per vector length
    if not found:
        return spark.createDataFrame([], f"query_id long, rank int, {id_col} long, score long")
    tops = {r.dim: float(r.top) for r in found}
    sample = base.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()  # only places the centres
    centres = {}
    for d, top, n in found:
        own = [r for r in sample if r.dim == d] or base.where(F.col("dim") == d).limit(1).collect()
        many = max(CENTRES, min(SAMPLE // 4, n // TREE_ROWS))
        centres[d] = chained(farthest_first(lifted(np.array([r.vec for r in own], np.int64), np.array([r.norm for r in own]), float(top)), many))
    fields = "id long, vec array<long>, dim int, norm long, centre int"
    placed = base.mapInArrow(_nearest_centre(centres, tops), fields).checkpoint()
    tree_rows = F.least(F.lit(TREE_ROWS), F.greatest(F.lit(PAGE), F.floor(TREE_CELLS / F.col("dim"))))
    parts = placed.groupBy("dim", "centre").agg(F.ceil(F.count(F.lit(1)) / F.any_value(tree_rows)).cast("int").alias("parts"))
    key = ["dim", "centre", "part"]
    trees = (placed.join(F.broadcast(parts), ["dim", "centre"]).withColumn("part", F.pmod(F.xxhash64("id"), "parts").cast("int")).groupBy(*key)
             .applyInArrow(_trees(tops), "dim int, centre int, part int, rows long, ball array<double>, radius double, tree binary").checkpoint())

    # trees of near centres make a group, their balls a slab; one row per tree comes here
    numbers, trees_of, rows_of = [], Counter(), Counter()
    for d, centre, part, n in trees.select(*key, "rows").orderBy(*key).collect():
        numbers.append((d, centre, part, rows_of[d] // min(GROUP_ROWS, max(PAGE, GROUP_CELLS // d)), trees_of[d] // SLAB))
        trees_of[d] += 1
        rows_of[d] += n
    trees = trees.join(F.broadcast(spark.createDataFrame(numbers, "dim int, centre int, part int, group int, slab int")), key)
    slabs = trees.select("dim", "slab", "centre", "part", "group", "ball", "radius").groupBy("dim", "slab").applyInArrow(_slabs, "dim int, slab int, balls binary").checkpoint()

    # queries of near centres make a block; one row per centre comes here
    asked = integer_vectors(queries, id_col, vec_col, scale).where(F.col("dim").isin(*tops)).distinct()
    asked = asked.mapInArrow(_nearest_centre(centres, dict.fromkeys(tops, 0.0)), fields).checkpoint()
    places, asked_of = [], Counter()
    for d, centre, n in asked.groupBy("dim", "centre").count().orderBy("dim", "centre").collect():
        places.append((d, centre, asked_of[d], n, min(QUERY_BLOCK, max(PAGE, TREE_CELLS // d))))
        asked_of[d] += n
    block = F.floor((F.col("before") + F.pmod(F.xxhash64("id", "vec"), "n")) / F.col("most"))
    blocks = (asked.join(F.broadcast(spark.createDataFrame(places, "dim int, centre int, before long, n long, most long")), ["dim", "centre"]).withColumn("block", block)
              .select("dim", "block", "id", "vec", "norm").groupBy("dim", "block").applyInArrow(_blocks, "dim int, block long, queries binary").checkpoint())

    def planned(blocks: DataFrame, how, found: str) -> DataFrame:
        """Every block with the balls of all trees of its vector length."""
        met = blocks.join(F.broadcast(slabs.select("dim", "slab")), "dim").join(slabs, ["dim", "slab"])
        return met.select("dim", "block", "queries", "balls").groupBy("dim", "block").applyInArrow(how, f"dim int, block long, {found}")

    def together(blocks: DataFrame, trees: DataFrame, keys: list[str], tasks: int):
        """Blocks and trees of one key, dealt over so many tasks that few of them get two keys."""
        tasks, own = 2 * max(tasks, 1), [F.col(x).alias(x) for x in keys]  # both sides may come from one plan
        return (blocks.select(*keys, "queries").repartition(tasks, *keys).groupBy(*keys)
                .cogroup(trees.select(*own, "centre", "part", "tree").repartition(tasks, *keys).groupBy(*keys)))

    many = {d: 1 + (asked_of[d] - 1) // most for d, *_, most in places}
    homes = planned(blocks, _homes, "centre int, part int")  # at most HOME rows for a block
    first = (together(blocks, trees.join(F.broadcast(homes), key), ["dim", "block"], sum(many.values()))
             .applyInArrow(_first(tops, k), "dim int, block long, queries binary, query array<long>, id array<long>, score array<long>").checkpoint())
    state, task = first.select("dim", "block", "queries"), ["dim", "group", "chunk"]
    plan = planned(state, _further(tops, k), "group int").withColumn("chunk", F.floor(F.col("block") / CHUNK)).checkpoint()
    tasks = plan.select(*task).distinct()  # as many rows as the second round has tasks
    second = (together(state.join(plan, ["dim", "block"]), trees.join(F.broadcast(tasks), ["dim", "group"]), task, tasks.count())
              .applyInArrow(_second(tops, k), "query long, id long, score long"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    hits = first.select(F.inline(F.arrays_zip("query", "id", "score"))).unionByName(second)
    return (hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select(F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score"))

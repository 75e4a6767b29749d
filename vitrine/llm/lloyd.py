"""Centroid clustering of integer vectors: Lloyd's rounds, sharded by dimension.

Vectors are cut into chunks of rows and blocks of columns; a shard is one chunk's
block, a matrix of the smallest integer type that holds it.  Per round

* a task takes shards of a block and the matching slice of the centroids and
  gives each chunk's exact partial squared distances;
* `reduceByKey` by chunk adds the blocks, and the argmin assigns its vectors;
* shards meet their chunk's assignment, sum their own columns by cluster, and
  `reduceByKey` by block makes the new slice: floor(sum / count).

A shard's work needs only its block's slice, and no centroid is ever moved whole
but to the driver, which holds the k x dims numbers between rounds: both are
parameters, nothing else that the driver sees grows with the rows.  Shards are a
checkpointed table, so a lost executor recomputes one round from stored shards.

Numbers are exact at any size: matrices that could pass 64 bits are Python
integers.  Distances and inertias beyond a long are returned as the largest long.

Defined results: vectors that are null, of another length, or hold a null or
non-finite component take no part; rows that repeat an id are vectors of their
own; a null id takes part but starts a centroid only if too few others are left;
with fewer than k vectors there are as many centroids as vectors; ties go to the
smaller number; an empty cluster keeps its centroid; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.shipping import ship_package
from vitrine.session import ensure_checkpoint_dir

#: vectors in a chunk, columns in a block
CHUNK_ROWS, BLOCK_DIMS = 2048, 32
LARGEST = (1 << 63) - 1
_SAFE = 1 << 62


def _top(a: np.ndarray) -> int:
    """Largest absolute value."""
    return max(abs(int(a.max())), abs(int(a.min()))) if a.size else 0


def packed(a: np.ndarray) -> np.ndarray:
    """The same integers in the smallest type that holds them."""
    top = _top(a)
    for kind in (np.int8, np.int16, np.int32, np.int64):
        if top <= np.iinfo(kind).max:
            return a.astype(kind)
    return a.astype(object)


def _wide(a: np.ndarray, fits: bool) -> np.ndarray:
    return a.astype(np.int64 if fits else object)


def added(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    fits = _top(a) + _top(b) < _SAFE
    return packed(_wide(a, fits) + _wide(b, fits))


def scaled(vec: list[float], scale: float) -> list[int]:
    """floor(scale * x) of every component, x as double."""
    return [math.floor(scale * x) for x in vec]


def partial_distances(shard: np.ndarray, slice_: np.ndarray) -> np.ndarray:
    """Squared distances over the block's columns: rows x centroids."""
    fits = (_top(shard) + _top(slice_)) ** 2 * max(1, shard.shape[1]) < _SAFE
    x, c = _wide(shard, fits), _wide(slice_, fits)
    return packed(np.stack([((x - one) ** 2).sum(axis=1) for one in c], axis=1))


def nearest(distances: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (the smaller of equals) and its distance."""
    best = np.argmin(distances, axis=1)
    return packed(best), distances[np.arange(len(best)), best]


def column_sums(shard: np.ndarray, cluster: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the shard's columns and numbers of its rows, by cluster."""
    fits = _top(shard) * max(1, len(shard)) < _SAFE
    x = _wide(shard, fits)
    sums = np.zeros((k, shard.shape[1]), x.dtype)
    for c in np.unique(cluster):
        sums[c] = x[cluster == c].sum(axis=0)
    return packed(sums), np.bincount(cluster, minlength=k)


def _moved(sums: np.ndarray, counts: np.ndarray, old: np.ndarray) -> np.ndarray:
    """floor(sum / count); the centroid of an empty cluster stays."""
    fits = sums.dtype != object and old.dtype != object
    floors = _wide(sums, fits) // np.maximum(counts, 1)[:, None]
    return packed(np.where((counts > 0)[:, None], floors, _wide(old, fits)))


def _shards(scale: float, dims: int):
    """id, vec -> one row per chunk and block of columns; block -1 holds the ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 33
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(at, CHUNK_ROWS)
                flat = np.floor(scale * part.column(1).flatten().to_numpy(zero_copy_only=False).astype(float))
                flat = flat.astype(np.int64) if not flat.size or np.abs(flat).max() < _SAFE else np.array([int(x) for x in flat], object)
                matrix = flat.reshape(-1, dims)
                blocks = [packed(matrix[:, b: b + BLOCK_DIMS]) for b in range(0, dims, BLOCK_DIMS)]
                yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk] * (len(blocks) + 1), pa.int64()), "block": pa.array(range(-1, len(blocks)), pa.int32()),
                                                  "data": pa.array([pickle.dumps(x) for x in [part.column(0).to_pylist(), *blocks]], pa.binary())})
                chunk += 1

    return run


def cluster(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 16, rounds: int = 3, dims: int = 64, scale: float = 64.0,
            seed: str = "1") -> tuple[DataFrame, np.ndarray]:
    """(id, cluster, distance) of every vector that takes part, and the k x dims centroids.

    The first centroids are the vectors with the smallest SHA-256 of `seed:id`.
    """
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    vec = F.col(vec_col).cast("array<double>")
    finite = F.forall(vec, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    kept = rows.select(F.col(id_col).alias("id"), vec.alias("vec")).where((F.size("vec") == dims) & finite)
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256).asc_nulls_last()
    start = kept.orderBy(order, "vec").limit(k).collect()  # k rows
    id_type = kept.schema["id"].dataType
    shape = T.StructType([T.StructField(id_col, id_type), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    if not start:
        return spark.createDataFrame([], shape), np.empty((0, dims), np.int64)
    k = len(start)
    centroids = packed(np.array([scaled(r.vec, scale) for r in start], object))
    stored = kept.mapInArrow(_shards(scale, dims), "chunk long, block int, data binary").repartition("block", "chunk").checkpoint()
    shards = stored.where("block >= 0").rdd.map(lambda r: (r.chunk, (r.block, pickle.loads(r.data))))

    def assigned(centroids: np.ndarray):
        slices = spark.sparkContext.broadcast([centroids[:, b: b + BLOCK_DIMS] for b in range(0, dims, BLOCK_DIMS)])  # k x dims numbers
        return slices, shards.mapValues(lambda s: partial_distances(s[1], slices.value[s[0]])).reduceByKey(added).mapValues(nearest)

    for _ in range(rounds):
        slices, chunks = assigned(centroids)
        sums = shards.join(chunks).map(lambda row: (row[1][0][0], column_sums(row[1][0][1], row[1][1][0], k)))
        moved = (sums.reduceByKey(lambda a, b: (added(a[0], b[0]), a[1] + b[1]))
                 .map(lambda row: (row[0], _moved(*row[1], slices.value[row[0]]))).collect())  # one slice per block
        centroids = np.concatenate([s for _, s in sorted(moved, key=lambda row: row[0])], axis=1)
    _, chunks = assigned(centroids)
    ids = stored.where("block < 0").rdd.map(lambda r: (r.chunk, pickle.loads(r.data)))
    out = ids.join(chunks).flatMap(lambda row: [(i, c, min(d, LARGEST)) for i, c, d in zip(row[1][0], *(x.tolist() for x in row[1][1]))])
    return spark.createDataFrame(out, shape, verifySchema=False), centroids


def clusters(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", **parameters) -> DataFrame:
    """`cluster` with the inertia of every vector's cluster and of all, and the digest of its centroid (components joined by commas)."""
    found, centroids = cluster(rows, id_col, vec_col, **parameters)
    found = found.checkpoint()
    inertia = {r[0]: int(r[1]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect()}  # a row per centroid
    total = min(sum(inertia.values()), LARGEST)
    per = [(c, min(n, LARGEST), total, hashlib.sha256(",".join(str(int(x)) for x in centroids[c]).encode()).hexdigest()) for c, n in inertia.items()]
    table = rows.sparkSession.createDataFrame(per, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(table), "cluster").select(id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")

"""Centroid clustering over zone maps: vectors in the order of a Hilbert curve fill blocks with minimum and maximum boxes, the
boxes' distance bounds leave each block a few candidate centroids, and only those are compared exactly."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleethazard.llm.support import field
from fleethazard.session import written

LIMIT = 1 << 27  # grid components are held within this, so that 64 squared differences add up within 64 bits
EXACT_IN_DOUBLES = 1 << 21  # components up to this have inner products that doubles hold exactly
CURVE_BITS = 4  # steps of the curve along each dimension: 2^4
BLOCKS = "n int, ids array<long>, cells binary, low binary, high binary"


def grid_vectors(vectors: DataFrame, dims: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """``id, cells``: the vectors of ``dims`` finite components, each component x as floor(scale * x)."""
    whole = vectors.select(field(id_col).cast("long").alias("id"), field(vector_col).alias("v"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    cell = lambda x: F.greatest(F.least(F.floor(F.least(F.greatest(x.cast("double"), F.lit(-1e12)), F.lit(1e12)) * scale),
                                        F.lit(LIMIT)), F.lit(-LIMIT)).cast("int")
    return whole.where((F.size("v") == dims) & F.forall("v", finite)).select("id", F.transform("v", cell).alias("cells"))


def hilbert_keys(steps: np.ndarray, bits: int) -> list[bytes]:
    """Places along the Hilbert curve, as byte strings in curve order, of rows of coordinates below 2^bits (Skilling's transform)."""
    x = np.ascontiguousarray(steps.T).astype(np.uint32)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        low = np.uint32(q - 1)
        for i in range(len(x)):
            swap = np.where(x[i] & np.uint32(q), np.uint32(0), (x[0] ^ x[i]) & low)
            turn = np.where(x[i] & np.uint32(q), low, np.uint32(0))
            x[i] ^= swap
            x[0] ^= swap ^ turn
    x = np.bitwise_xor.accumulate(x, axis=0)
    flip = np.zeros(x.shape[1], dtype=np.uint32)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        flip ^= np.where(x[-1] & np.uint32(q), np.uint32(q - 1), np.uint32(0))
    x ^= flip
    planes = np.stack([(x >> np.uint32(b)) & np.uint32(1) for b in range(bits - 1, -1, -1)]).astype(np.uint8)
    packed = np.packbits(planes.reshape(-1, planes.shape[-1]).T, axis=1)
    return [row.tobytes() for row in packed]


def _matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def zone_map(grid: DataFrame, dims: int, block_rows: int) -> DataFrame:
    """``grid`` as blocks of up to ``block_rows`` vectors that follow each other on the curve, with their boxes; written once.

    The curve's steps span the middle 98 % of the extremes of the vectors; what lies beyond takes the outermost step. Equal
    vectors are dealt by a hash of their id as well, so that copies don't fill one partition."""
    ends = grid.agg(F.percentile_approx(F.array_min("cells"), 0.01, 1000), F.percentile_approx(F.array_max("cells"), 0.99, 1000)).first()
    low, high = (0, 1) if ends[0] is None else (ends[0], max(ends[1], ends[0] + 1))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = _matrix(batch.column("cells"), dims).astype(np.float64)
            steps = np.clip((cells - low) * (1 << CURVE_BITS) // (high - low + 1), 0, (1 << CURVE_BITS) - 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hilbert_keys(steps, CURVE_BITS), pa.binary())], ["id", "cells", "place"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, block_rows):
                part = batch.slice(start, block_rows)
                cells = _matrix(part.column("cells"), dims).astype("<i4")
                row = {"n": [len(cells)], "ids": [part.column("id").to_pylist()], "cells": [cells.tobytes()],
                       "low": [cells.min(axis=0).tobytes()], "high": [cells.max(axis=0).tobytes()]}
                yield pa.RecordBatch.from_pydict(row, pa.schema([("n", pa.int32()), ("ids", pa.list_(pa.int64())), ("cells", pa.binary()),
                                                                 ("low", pa.binary()), ("high", pa.binary())]))

    along = grid.mapInArrow(keyed, "id long, cells array<int>, place binary").withColumn("spread", F.xxhash64("id"))
    along = along.repartitionByRange("place", "spread").sortWithinPartitions("place", "spread")
    return written(along.select("id", "cells").mapInArrow(blocks, BLOCKS), "zone-map")


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that can be nearest to a vector in the box: no nearer bound above the least farthest one."""
    gap = np.maximum(np.maximum(low - centroids, centroids - high), 0)
    reach = np.maximum(np.abs(centroids - low), np.abs(centroids - high))
    return np.flatnonzero((gap * gap).sum(axis=1) <= (reach * reach).sum(axis=1).min())


def nearest(cells: np.ndarray, centroids: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest of the candidate centroids (the smallest number of equal ones) and the squared distance, in integers."""
    picked = centroids[among]
    if max(np.abs(cells).max(), np.abs(picked).max()) <= EXACT_IN_DOUBLES:
        x, c = cells.astype(np.float64), picked.astype(np.float64)
        far = (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)
    else:
        far = np.stack([((cells - c) ** 2).sum(axis=1) for c in picked], axis=1)
    best = far.argmin(axis=1)
    return among[best], far[np.arange(len(far)), best].astype(np.int64)


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray]]:
    """For each block: ids, cells, clusters and squared distances."""
    dims = centroids.shape[1]
    for batch in batches:
        for row in batch.to_pylist():
            cells = np.frombuffer(row["cells"], dtype="<i4").reshape(-1, dims).astype(np.int64)
            low, high = (np.frombuffer(row[k], dtype="<i4").astype(np.int64) for k in ("low", "high"))
            yield row["ids"], cells, *nearest(cells, centroids, candidates(low, high, centroids))


def moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid as the floor of its vectors' mean; one without vectors stays. One row per task, cluster and component is
    added up by Spark; sums of the size of ``centroids`` reach the driver."""
    k, dims = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((k, dims), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for _, cells, cluster, _ in _assigned(batches, centroids):
            n += np.bincount(cluster, minlength=k)
            for c in np.unique(cluster):
                total[c] += cells[cluster == c].sum(axis=0)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(used, dims).astype(np.int32)), pa.array(np.tile(np.arange(dims), len(used)).astype(np.int32)),
             pa.array(np.repeat(n[used], dims)), pa.array(total[used].ravel())], ["cluster", "dim", "n", "total"])

    parts = blocks.mapInArrow(sums, "cluster int, dim int, n long, total long").groupBy("cluster", "dim")
    out = centroids.copy()
    for r in parts.agg(F.sum(F.col("n").cast("decimal(20)")).alias("n"), F.sum(F.col("total").cast("decimal(20)")).alias("total")).collect():
        out[r["cluster"], r["dim"]] = int(r["total"]) // int(r["n"])
    return out


def cluster_vectors(vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1,
                    id_col: str = "vec_id", vector_col: str = "embedding", block_rows: int = 1024) -> DataFrame:
    """``id_col, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every usable vector.

    Usable are vectors with exactly ``dims`` components, none null, NaN or infinite; other rows are left out. All arithmetic is
    on the integers floor(scale * x), held within 2^27 either way, so the result does not depend on order or partitions. The
    first centroids are the ``k`` vectors with the smallest sha256 of "seed:id" (fewer vectors: fewer centroids; equal hashes: the
    smaller vector first; a null id counts as an empty one). Each round assigns and then moves the centroids; a last assignment follows. ``distance``
    is squared; ties go to the smaller number. ``inertia`` is null beyond 64 bits. Repeated rows are clustered each by itself; an empty
    table, or one without usable vectors, gives an empty table. No other column of the input is returned.

    The zone map is written once and read in each round; a block whose box lies clear of a centroid is never compared with
    it. The driver holds ``k`` centroids and their sums, nothing that grows with the table.
    """
    spark = vectors.sparkSession
    grid = grid_vectors(vectors, dims, scale, id_col, vector_col)
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = grid.select("cells", hashed.alias("h")).orderBy("h", "cells").limit(k).collect()
    columns = "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not first:
        return spark.createDataFrame([], f"id long, {columns}").withColumnRenamed("id", id_col)
    centroids = np.array([r["cells"] for r in first], dtype=np.int64)
    blocks = zone_map(grid, dims, block_rows)
    for _ in range(rounds):
        centroids = moved(blocks, centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, cluster, distance in _assigned(batches, centroids):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(cluster.astype(np.int32)), pa.array(distance)], ["id", "cluster", "distance"])

    done = written(blocks.mapInArrow(assign, "id long, cluster int, distance long"), "clusters")
    each = done.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20)")).alias("s")).collect()  # k rows
    whole = sum(int(r["s"]) for r in each)
    held = lambda total: total if total < 1 << 63 else None
    sha = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    lookup = spark.createDataFrame([(r["cluster"], held(int(r["s"])), held(whole), sha[r["cluster"]]) for r in each],
                                   "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return done.join(F.broadcast(lookup), "cluster").select(  # k rows
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")

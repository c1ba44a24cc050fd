"""Centroid clustering with heap-ordered bounds.

A vector keeps the gap between the distance to the nearest other centroid (lower bound) and to its
own (upper bound). When centroids move, the gap shrinks by no more than the drift of its own plus
the largest drift of another. A cluster adds these drifts up; a vector enters its heap with its gap
plus the sum so far, so entries are never rewritten. In a round, each cluster pops what has expired,
entries not above its present sum. Only those vectors are compared with all centroids again and
pushed into the heap of the cluster that they now belong to.

The table of vectors carries cluster and expiry. A round is one pass that writes the next table and,
beside it, the sums that moved between clusters; only these small rows are added up for the new
centroids. All distances are exact integers.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm.shared import ready, work_path

WIDTH = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
# Scaled components are held within this, so that any squared distance fits in 64 bits.
REACH = 2**26
_MOST = 2**63 - 1
# Relative reserve for rounding in square roots and sums of drifts.
_SLACK = 1e-9
STATE = "vec_id long, v array<long>, cluster int, expires double, distance long, kind string"


def usable(vectors: DataFrame, key: str, vector: str, width: int = WIDTH) -> DataFrame:
    """``vec_id`` and ``v`` of the vectors with ``width`` components, none null or non-finite."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    good = vectors.where((F.size(vector) == width) & finite)
    return good.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))


def _whole(lists: pa.ListArray, scale: int, width: int) -> np.ndarray:
    ends = lists.offsets.to_numpy()
    values = lists.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]]
    return np.clip(np.floor(scale * values), -REACH, REACH).astype(np.int64).reshape(-1, width)


def first_centroids(rows: DataFrame, clusters: int, scale: int, width: int) -> list[list[int]]:
    """The whole vectors with the smallest SHA-256 of ``1:<vec_id>``, in order of the hash."""
    name = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    chosen = rows.orderBy(F.asc_nulls_last(name), "v").limit(clusters).select("v").toArrow()
    lists = chosen.column("v").combine_chunks()
    return _whole(lists, scale, width).tolist() if chosen.num_rows else []


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, a column for each centroid."""
    out = np.empty((len(x), len(centroids)), np.int64)
    for j, c in enumerate(centroids):
        gap = x - c
        out[:, j] = np.einsum("nd,nd->n", gap, gap)
    return out


def scan(x: np.ndarray, centroids: np.ndarray, drift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid, ties to the smaller number, and the drift at which that expires."""
    squared = distances(x, centroids)
    near = squared.argmin(1)
    row = np.arange(len(x))
    upper = np.sqrt(squared[row, near].astype(float))
    squared[row, near] = _MOST
    lower = np.sqrt(squared.min(1).astype(float)) if len(centroids) > 1 else np.full(len(x), np.inf)
    reserve = _SLACK * (1 + upper + drift[near]) + _SLACK * np.where(np.isinf(lower), 0, lower)
    return near, lower - upper + drift[near] - reserve


class ClusterHeaps:
    """A heap of (expiry, row) for each cluster over the vectors that a task holds."""

    def __init__(self, cluster: np.ndarray, expires: np.ndarray, clusters: int):
        order = np.argsort(cluster, kind="stable")
        cuts = np.searchsorted(cluster[order], np.arange(clusters + 1))
        self.heaps = []
        for low, high in zip(cuts[:-1], cuts[1:]):
            rows = order[low:high]
            heap = list(zip(expires[rows].tolist(), rows.tolist()))
            heapq.heapify(heap)
            self.heaps.append(heap)

    def expired(self, drift: np.ndarray) -> np.ndarray:
        """Rows whose gap is used up, taken out of their heaps."""
        rows = []
        for heap, now in zip(self.heaps, drift.tolist()):
            while heap and heap[0][0] <= now:
                rows.append(heapq.heappop(heap)[1])
        return np.array(rows, np.int64)

    def push(self, rows: np.ndarray, cluster: np.ndarray, expires: np.ndarray) -> None:
        for row, c, at in zip(rows.tolist(), cluster.tolist(), expires.tolist()):
            heapq.heappush(self.heaps[c], (at, row))

    def state(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Cluster and expiry of every row, read from the heaps."""
        cluster, expires = np.zeros(size, np.int64), np.zeros(size)
        for c, heap in enumerate(self.heaps):
            if heap:
                at, rows = (np.array(a) for a in zip(*heap))
                cluster[rows], expires[rows] = c, at
        return cluster, expires


def _batch(ids, x, cluster, expires, distance, kind: str) -> pa.RecordBatch:
    n, width = x.shape
    lists = pa.ListArray.from_arrays(
        pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(x.ravel())
    )
    columns = [
        ids, lists, pa.array(cluster.astype(np.int32)), pa.array(expires),
        pa.array(distance.astype(np.int64)), pa.array([kind] * n, pa.string()),
    ]
    return pa.RecordBatch.from_arrays(
        columns, names=["vec_id", "v", "cluster", "expires", "distance", "kind"]
    )


def _sums(x: np.ndarray, cluster: np.ndarray, clusters: int) -> np.ndarray:
    return np.array([x[cluster == c].sum(0) for c in range(clusters)])


def _moved(sums: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """What a task adds to the sum of each cluster (``v``) and to its size (``distance``)."""
    rows = np.arange(len(sums))
    return _batch(pa.nulls(len(sums), pa.int64()), sums, rows, np.zeros(len(sums)), counts, "moved")


def _assign_all(rows: DataFrame, centroids: np.ndarray, scale: int, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
        for batch in batches:
            x = _whole(batch.column("v"), scale, width)
            if not len(x):
                continue
            cluster, expires = scan(x, centroids, np.zeros(len(centroids)))
            sums += _sums(x, cluster, len(centroids))
            counts += np.bincount(cluster, minlength=len(centroids))
            yield _batch(batch.column("vec_id"), x, cluster, expires, np.zeros(len(x)), "vector")
        yield _moved(sums, counts)

    return rows.mapInArrow(run, STATE)


def _reassign(state: DataFrame, centroids: np.ndarray, drift: np.ndarray, width: int, last: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
        for batch in batches:
            lists = batch.column("v")
            ends = lists.offsets.to_numpy()
            x = lists.values.to_numpy()[ends[0] : ends[-1]].reshape(-1, width)
            if not len(x):
                continue
            was = batch.column("cluster").to_numpy().astype(np.int64)
            heaps = ClusterHeaps(was, batch.column("expires").to_numpy(), len(centroids))
            rows = heaps.expired(drift)
            heaps.push(rows, *scan(x[rows], centroids, drift))
            cluster, expires = heaps.state(len(x))
            gone = np.flatnonzero(cluster != was)
            sums += _sums(x[gone], cluster[gone], len(centroids)) - _sums(x[gone], was[gone], len(centroids))
            counts += np.bincount(cluster, minlength=len(centroids))
            counts -= np.bincount(was, minlength=len(centroids))
            own = np.zeros(len(x))
            if last:
                gap = x - centroids[cluster]
                own = np.einsum("nd,nd->n", gap, gap)
                x = x[:, :0]
            yield _batch(batch.column("vec_id"), x, cluster, expires, own, "vector")
        if not last:
            yield _moved(sums, counts)

    return state.mapInArrow(run, STATE)


def _written(state: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """The vectors and the moved sums of a pass, written once into folders of their own."""
    path = work_path(state.sparkSession, name)
    state.write.partitionBy("kind").parquet(path)
    read = state.sparkSession.read.schema(state.schema).parquet(path)
    return read.where("kind = 'vector'").drop("kind"), read.where("kind = 'moved'").drop("kind")


def _add_moved(moved: DataFrame, sums: list[list[int]], counts: list[int]) -> None:
    exact = F.sum(F.col("x").cast("decimal(38,0)"))
    parts = moved.select("cluster", F.posexplode("v").alias("i", "x")).groupBy("cluster", "i")
    for c, i, x in parts.agg(exact).collect():
        sums[c][i] += int(x)
    for c, n in moved.groupBy("cluster").agg(F.sum("distance")).collect():
        counts[c] += n


def cluster(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    width: int = WIDTH,
) -> DataFrame:
    """Cluster of every vector with ``width`` finite components after ``rounds`` updates.

    Returns ``vec_id``, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia`` and
    ``centroid_sha256``. Vectors of another width or with a null or non-finite component have no
    row. A repeated or null ``vec_id`` is a vector of its own; a null one starts no centroid
    unless too few others exist. Fewer vectors than ``clusters`` give as many centroids; an
    empty table gives no row. Scaled components beyond 2 ** 26 are held there and sums of
    distances at 2 ** 63 - 1. Other columns are left out.
    """
    if rounds < 1:
        raise ValueError("at least one round")
    spark = ready(vectors.sparkSession)
    rows = usable(vectors, key, vector, width)
    start = first_centroids(rows, clusters, scale, width)
    if not start:
        return spark.createDataFrame(
            [],
            "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string",
        )
    centroids = np.array(start, np.int64)
    drift = np.zeros(len(start))
    sums, counts = [[0] * width for _ in start], [0] * len(start)
    state, moved = _written(_assign_all(rows, centroids, scale, width), "assigned")
    for number in range(1, rounds + 1):
        _add_moved(moved, sums, counts)
        after = np.array(
            [[s // n for s in row] if n else old for row, n, old in zip(sums, counts, centroids.tolist())],
            np.int64,
        )
        step = np.sqrt(np.einsum("cd,cd->c", after - centroids, after - centroids).astype(float))
        others = np.array([np.delete(step, c).max(initial=0) for c in range(len(step))])
        # Rounded up, as an expiry must never come late.
        drift, centroids = (drift + step + others) * (1 + _SLACK), after
        state, moved = _written(_reassign(state, centroids, drift, width, number == rounds), "assigned")
    return _described(state.select("vec_id", "cluster", "distance"), centroids.tolist())


def _described(found: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """The rows with the inertia of their cluster and of all, and the hash of its centroid."""
    spark = found.sparkSession
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    inertia = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(exact.alias("s")).collect()}
    total = min(sum(inertia.values()), _MOST)
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    about = spark.createDataFrame(
        [(c, min(s, _MOST), total, names[c]) for c, s in sorted(inertia.items())],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return found.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )

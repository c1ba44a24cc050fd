"""Exact search for the highest inner products by multi-resolution segment statistics.

A vector is cut into segments with a mean and a deviation each. For segments of length L the
squared distance is at least the sum of L ((mean - mean')^2 + (dev - dev')^2), so with the known
norms the inner product is at most the sum of L (mean mean' + dev dev'). Bounds are taken from
coarse to fine segments, and only the candidates that survive get exact products.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from winnow.llm.shared import kept

SCALE = 256
TOP = 5
SEGMENTS = (4, 8, 16)
# A task meets about so many candidates with so many queries.
GROUP_CANDIDATES = 8192
GROUP_QUERIES = 16384
# Queries whose score matrix is held at once.
QUERY_BLOCK = 256
_EXACT = 2.0**52


def quantised(vectors: DataFrame, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """``id`` and ``v``, the floors of the scaled components as doubles.

    Rows with a null key or vector or with a null or non-finite component are left out.
    """
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    usable = vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & finite)

    def floors(batches):
        for batch in batches:
            lists = batch.column("v")
            values = np.floor(scale * lists.values.to_numpy(zero_copy_only=False))
            whole = pa.ListArray.from_arrays(lists.offsets, pa.array(values, pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), whole], names=["id", "v"])

    plain = usable.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    return plain.mapInArrow(floors, "id long, v array<double>")


def _matrix(lists: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows, shorter ones filled with zeros."""
    whole = lists.combine_chunks()
    whole = whole.chunk(0) if isinstance(whole, pa.ChunkedArray) else whole
    ends = whole.offsets.to_numpy().astype(np.int64)
    values = whole.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(ends)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(ends[0], ends[-1]) - ends[:-1][row]] = values[ends[0] : ends[-1]]
    return out


def segment_features(x: np.ndarray, count: int) -> np.ndarray:
    """Means and deviations by segment, scaled so that a product of features is the bound."""
    cuts = np.unique(np.linspace(0, x.shape[1], count + 1).astype(int))
    size = np.diff(cuts)
    if not len(size):
        return np.zeros((len(x), 0))
    mean = np.add.reduceat(x, cuts[:-1], axis=1) / size
    square = np.add.reduceat(x * x, cuts[:-1], axis=1) / size
    deviation = np.sqrt(np.maximum(square - mean * mean, 0))
    return np.hstack([mean, deviation]) * np.sqrt(np.concatenate([size, size]))


def top_products(
    query_ids: np.ndarray,
    queries: np.ndarray,
    ids: np.ndarray,
    candidates: np.ndarray,
    top: int = TOP,
    levels: tuple[int, ...] = SEGMENTS,
):
    """Rows of query, candidate and score: the best ``top`` of each query, its own id apart.

    Ties go to the smaller candidate id. Products are exact integers; beyond the exact range
    of doubles they are taken with Python integers and held within 64 bits.
    """
    order = np.argsort(ids, kind="stable")
    ids, candidates = ids[order], candidates[order]
    width = queries.shape[1]
    reach = np.abs(queries).max(initial=0) * np.abs(candidates).max(initial=0) * max(width, 1)
    if reach >= _EXACT:
        return _plain_products(query_ids, queries, ids, candidates, top)
    coarse = [segment_features(candidates, n) for n in levels]
    fine = [segment_features(queries, n) for n in levels]
    slack = 1e-9 * (1 + reach)
    found = []
    for low in range(0, len(queries), QUERY_BLOCK):
        block = slice(low, low + QUERY_BLOCK)
        q, own = queries[block], query_ids[block][:, None] == ids[None, :]
        bound = fine[0][block] @ coarse[0].T
        bound[own] = -np.inf
        # The exact products of the most promising candidates give a first threshold.
        seeds = min(4 * top, len(ids))
        best = np.argpartition(-bound, seeds - 1, axis=1)[:, :seeds]
        exact = np.einsum("qd,qsd->qs", q, candidates[best])
        exact[np.take_along_axis(own, best, 1)] = -np.inf
        least = np.sort(exact, axis=1)[:, -min(top, seeds)][:, None]
        alive = (bound >= least - slack) & ~own
        for x, y in zip(fine[1:], coarse[1:]):
            if np.count_nonzero(alive) > 0.05 * alive.size:
                alive &= x[block] @ y.T >= least - slack
            else:
                row, column = np.nonzero(alive)
                kept_pairs = np.einsum("pd,pd->p", x[block][row], y[column]) >= least[row, 0] - slack
                alive[row[~kept_pairs], column[~kept_pairs]] = False
        row, column = np.nonzero(alive)
        if len(row) > 0.05 * alive.size:
            score = (q @ candidates.T)[row, column]
        else:
            score = np.einsum("pd,pd->p", q[row], candidates[column])
        good = score >= least[row, 0]
        row, column, score = row[good], column[good], score[good]
        order = np.lexsort((column, -score, row))
        row, column, score = row[order], column[order], score[order]
        place = np.arange(len(row)) - np.searchsorted(row, row, "left")
        first = place < top
        found.append((query_ids[block][row[first]], ids[column[first]], score[first]))
    empty = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    query, candidate, score = (np.concatenate(c) for c in zip(*(found or [empty])))
    return query, candidate, np.rint(score).astype(np.int64)


def _plain_products(query_ids, queries, ids, candidates, top):
    whole = np.frompyfunc(int, 1, 1)
    big = whole(candidates)
    rows = []
    for key, q in zip(query_ids.tolist(), whole(queries)):
        scored = sorted((-s, i) for s, i in zip((big * q).sum(1).tolist(), ids.tolist()) if i != key)
        rows += [(key, i, max(-(2**63), min(2**63 - 1, -s))) for s, i in scored[:top]]
    return tuple(np.array(c, np.int64) for c in zip(*rows)) or (np.zeros(0, np.int64),) * 3


def search(
    vectors: DataFrame,
    is_query: str,
    top: int = TOP,
    group_candidates: int = GROUP_CANDIDATES,
    group_queries: int = GROUP_QUERIES,
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` of the best candidates.

    ``vectors`` are kept rows of ``id`` and ``v``; ``is_query`` is an SQL condition on ``id``.
    Every row is a candidate for every query but itself; vectors of different lengths are
    compared as if filled with zeros. Candidates and queries are dealt to groups by a hash and
    each task meets one group of either, so memory is bounded at any size. A repeated id is
    searched, and listed, once for each different row.
    """
    size = F.max(F.size("v"))
    row = vectors.agg(F.count("*").alias("n"), F.count_if(F.expr(is_query)).alias("q"), size.alias("w")).head()
    rows, columns = -(-row["n"] // group_candidates) or 1, -(-row["q"] // group_queries) or 1
    width = row["w"] or 0
    candidates = vectors.withColumn("i", F.pmod(F.xxhash64("id"), F.lit(rows)).cast("int"))
    candidates = candidates.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(columns - 1))))
    queries = vectors.where(is_query).withColumn("j", F.pmod(F.xxhash64("id"), F.lit(columns)).cast("int"))
    queries = queries.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(rows - 1))))

    def meet(_, left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows and right.num_rows:
            q, c, s = top_products(
                left.column("id").to_numpy(),
                _matrix(left.column("v"), width),
                right.column("id").to_numpy(),
                _matrix(right.column("v"), width),
                top,
            )
        else:
            q = c = s = np.zeros(0, np.int64)
        return pa.table({"query_id": q, "vec_id": c, "score": s})

    met = (
        queries.groupBy("i", "j")
        .cogroup(candidates.groupBy("i", "j"))
        .applyInArrow(meet, "query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")


def top_of(vectors: DataFrame, key: str, vector: str, every: int = 50, **options) -> DataFrame:
    """Search with the rows whose key is divisible by ``every`` as queries."""
    return search(kept(quantised(vectors, key, vector), "vectors"), f"id % {every} = 0", **options)

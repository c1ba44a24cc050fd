"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is fitted on a bounded sample; every vector then descends it to a leaf. A query walks
the tree best bin first: a priority queue holds the open branches by the inner product of their
centroid with the query, the best one is opened, and its leaves come out in the order in which
they are worth a visit. How many leaves a query visits is calibrated: the true neighbours of a
bounded sample of queries, found by brute force over all vectors, tell the recall of any number of
visits, which is widened until the wanted recall is reached.

Equal vectors are searched as one, with their smallest keys, so a vector that is repeated any
number of times costs one place. Leaves are dealt to bins of bounded size, large ones to several,
and a query goes once to each bin that holds leaves it visits.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winnow.llm.shared import kept, kept_counted, ready

TOP = 20
RECALL = 0.97
# Bounds of the sample that fits the tree and of the queries that calibrate it.
SAMPLE_VECTORS = 16_384
SAMPLE_BYTES = 32 * 1024 * 1024
SAMPLE_QUERIES = 256
BRANCHES = 8
LEAF_SAMPLE = 48
# Vectors and queries that a task holds at most, and cells of a padded matrix.
BIN_VECTORS = 131_072
LEAST_BIN = 2_048
BIN_QUERIES = 65_536
CELLS = 4_000_000
QUERY_BLOCK = 1_024


@dataclass(frozen=True)
class Tree:
    """Centroids of all nodes; ``children`` of a node, none for a leaf; ``leaf`` numbers leaves."""

    centroids: np.ndarray
    children: list[list[int]]
    leaf: list[int]
    leaves: int

    def descend(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row: from the root to the nearest child, ties to the first."""
        at = np.zeros(len(x), np.int64)
        waiting = [0]
        while waiting:
            node = waiting.pop()
            rows = np.flatnonzero(at == node)
            kids = self.children[node]
            if not len(rows) or not kids:
                continue
            at[rows] = np.array(kids)[_nearest(x[rows], self.centroids[kids])]
            waiting += kids
        return np.array(self.leaf, np.int64)[at]

    def best_bins(self, likeness: np.ndarray, visits: int) -> list[int]:
        """The first ``visits`` leaves, best bin first, of a query with this likeness to nodes."""
        queue, order = [(0.0, 0)], []
        values = likeness.tolist()
        while queue and len(order) < visits:
            node = heapq.heappop(queue)[1]
            if self.children[node]:
                for kid in self.children[node]:
                    heapq.heappush(queue, (-values[kid], kid))
            else:
                order.append(self.leaf[node])
        return order


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (np.einsum("cd,cd->c", centroids, centroids) - 2 * (x @ centroids.T)).argmin(1)


def fit(sample: np.ndarray, branches: int = BRANCHES, leaf_size: int = LEAF_SAMPLE, rounds: int = 8) -> Tree:
    """k-means within k-means until at most ``leaf_size`` rows are left or all rows are equal."""
    rng = np.random.default_rng(7)
    centroids, children, leaf = [sample.mean(0)], [[]], [-1]
    waiting = [(0, np.arange(len(sample)))]
    while waiting:
        node, rows = waiting.pop()
        if len(rows) <= leaf_size:
            continue
        x = sample[rows]
        middle = np.unique(x[rng.choice(len(x), min(branches, len(x)), replace=False)], axis=0)
        for _ in range(rounds):
            near = _nearest(x, middle)
            used = np.unique(near)
            middle = np.array([x[near == c].mean(0) for c in used])
        near = _nearest(x, middle)
        parts = [rows[near == c] for c in range(len(middle))]
        if max(map(len, parts)) == len(rows):
            continue
        for centre, part in zip(middle, parts):
            children[node].append(len(centroids))
            waiting.append((len(centroids), part))
            centroids.append(centre)
            children.append([])
            leaf.append(-1)
    number = 0
    for node, kids in enumerate(children):
        if not kids:
            leaf[node], number = number, number + 1
    return Tree(np.array(centroids), children, leaf, number)


def padded(lists: pa.ListArray, width: int) -> np.ndarray:
    """Vectors as rows in doubles, shorter ones filled with zeros, longer ones cut."""
    ends = lists.offsets.to_numpy().astype(np.int64)
    values = lists.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]].astype(np.float64)
    sizes = np.diff(ends)
    if len(sizes) and (sizes == width).all():
        return values.reshape(-1, width)
    place = np.arange(len(values)) - np.repeat(ends[:-1] - ends[0], sizes)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out = np.zeros((len(sizes), width))
    inside = place < width
    out[row[inside], place[inside]] = values[inside]
    return out


def _lists(column: pa.ChunkedArray) -> pa.ListArray:
    whole = column.combine_chunks()
    return pa.concat_arrays(whole.chunks) if isinstance(whole, pa.ChunkedArray) else whole


def _parts(batch: pa.RecordBatch, width: int) -> Iterator[pa.RecordBatch]:
    step = max(1, CELLS // max(width, 1))
    for low in range(0, batch.num_rows, step):
        yield batch.slice(low, step)


def inner_products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Products of paired rows, added up from the first component to the last."""
    out = np.zeros(len(queries))
    for d in range(queries.shape[1]):
        out += queries[:, d] * rows[:, d]
    return out


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``id``, two hashes of the vector and ``v``, for rows with a key and a usable vector."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    good = vectors.where(F.col(key).isNotNull() & finite & F.exists(vector, lambda x: x != 0))
    v = F.col(vector)
    return good.select(
        F.col(key).cast("long").alias("id"), F.xxhash64(v).alias("h"), F.xxhash64(v, F.lit(1)).alias("g"), v.alias("v")
    )


def folded(rows: DataFrame, copies: int) -> DataFrame:
    """One row per distinct vector with its ``copies`` smallest keys in order.

    Ties go to smaller keys, so no list of that many neighbours needs more of them. Catalyst
    limits each group before the exchange: a vector of many copies sends few rows per task.
    """
    place = F.row_number().over(Window.partitionBy("h", "g").orderBy("id"))
    few = rows.withColumn("place", place).where(F.col("place") <= copies)
    return few.groupBy("h", "g").agg(
        F.first("v").alias("v"), F.array_sort(F.collect_list("id")).alias("ids")
    )


def _draw(rows: DataFrame, number: int, most: int) -> DataFrame:
    """About ``most`` rows by their hash, at most twice as many."""
    share = F.lit(2**31) if number <= most else F.lit(2**31 * most // number)
    return rows.where(F.pmod(F.xxhash64("g", "h"), F.lit(2**31)) < share).limit(2 * most)


def _matrix(rows: DataFrame, width: int) -> tuple[pa.Table, np.ndarray]:
    table = rows.orderBy("h", "g").toArrow()
    return table, padded(_lists(table.column("v")), width) if table.num_rows else np.zeros((0, width))


def with_leaf(rows: DataFrame, tree: Tree, width: int) -> DataFrame:
    """``h``, ``g``, ``leaf``, ``v`` and ``ids`` of every distinct vector."""
    kind = rows.schema["v"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch, width):
                leaf = tree.descend(padded(part.column("v"), width))
                columns = [part.column(c) for c in ("h", "g")]
                columns += [pa.array(leaf.astype(np.int32)), part.column("v"), part.column("ids")]
                yield pa.RecordBatch.from_arrays(columns, names=["h", "g", "leaf", "v", "ids"])

    return rows.mapInArrow(place, f"h long, g long, leaf int, v {kind}, ids array<long>")


def true_leaves(index: DataFrame, queries: np.ndarray, top: int, width: int) -> DataFrame:
    """Brute force: ``query`` and ``leaf`` of the ``top`` best vectors of each query, and ``h``.

    A query meets itself too; its copies count as often as they are kept.
    """

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch, width):
                score = queries @ padded(part.column("v"), width).T
                n = min(top, score.shape[1])
                best = np.argpartition(-score, n - 1, axis=1)[:, :n]
                query = np.repeat(np.arange(len(queries)), n)
                at = pa.array(best.ravel())
                columns = [pa.array(query.astype(np.int32)), pa.array(score[query, best.ravel()])]
                columns += [part.column(c).take(at) for c in ("h", "leaf", "ids")]
                yield pa.RecordBatch.from_arrays(columns, names=["query", "score", "h", "leaf", "ids"])

    met = index.mapInArrow(meet, "query int, score double, h long, leaf int, ids array<long>")
    # Fewer than ``top`` vectors hold the best ``top`` keys, each with at most its kept copies.
    best = Window.partitionBy("query").orderBy(F.desc("score"), "h")
    met = met.withColumn("place", F.row_number().over(best)).where(F.col("place") <= top)
    each = met.select("query", "leaf", "h", "place", F.posexplode("ids").alias("copy", "id"))
    nth = F.row_number().over(Window.partitionBy("query").orderBy("place", "copy"))
    return each.withColumn("nth", nth).where(F.col("nth") <= top).select("query", "leaf", "h")


def calibrate(
    index: DataFrame, sample: DataFrame, tree: Tree, width: int, top: int, recall: float
) -> tuple[int, float]:
    """Leaves to visit for the wanted recall on the sampled queries, and the recall they reach."""
    _, q = _matrix(sample, width)
    if not len(q):
        return tree.leaves, 1.0
    truth = true_leaves(index, q, top + 1, width).toArrow()
    orders = [tree.best_bins(row, tree.leaves) for row in q @ tree.centroids.T]
    place = np.zeros((len(q), tree.leaves), np.int64)
    for i, order in enumerate(orders):
        place[i, order] = np.arange(len(order))
    needed = place[truth.column("query").to_numpy(), truth.column("leaf").to_numpy()]
    reached = np.cumsum(np.bincount(needed, minlength=tree.leaves)) / max(len(needed), 1)
    visits = 1
    while visits < tree.leaves and reached[visits - 1] < recall:
        visits += 1
    return visits, float(reached[visits - 1])


@dataclass(frozen=True)
class Bins:
    """The bins of each leaf: ``shards[leaf]`` from ``first[leaf]`` on."""

    first: np.ndarray
    shards: np.ndarray
    number: int


def deal_leaves(sizes: np.ndarray, most: int) -> Bins:
    """Leaves one after the other into bins of about ``most`` vectors; a larger leaf gets several."""
    first, shards = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64)
    number, held = 0, 0
    for leaf, size in enumerate(sizes.tolist()):
        if size > most:
            number += held > 0
            first[leaf], shards[leaf] = number, -(-size // most)
            number, held = number + int(shards[leaf]), 0
            continue
        if held + size > most:
            number, held = number + 1, 0
        first[leaf] = number
        held += size
    return Bins(first, shards, int(max(number + 1, (first + shards).max(initial=1))))


def _visits(queries: DataFrame, tree: Tree, bins: Bins, visits: int, width: int) -> DataFrame:
    """A row for each query and bin to be visited: ``bin``, ``h``, ``g``, ``v`` and its ``leaves``."""
    kind = queries.schema["v"].dataType.simpleString()

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch, max(width, len(tree.children))):
                likeness = padded(part.column("v"), width) @ tree.centroids.T
                row, where, leaf = [], [], []
                for i, values in enumerate(likeness):
                    order = np.array(tree.best_bins(values, visits))
                    for_each = bins.shards[order]
                    shard = np.arange(for_each.sum()) - np.repeat(np.cumsum(for_each) - for_each, for_each)
                    row.append(np.full(len(shard), i))
                    where.append(np.repeat(bins.first[order], for_each) + shard)
                    leaf.append(np.repeat(order, for_each))
                row, where, leaf = (np.concatenate(a) for a in (row, where, leaf))
                order = np.lexsort((where, row))
                row, where, leaf = row[order], where[order], leaf[order]
                new = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (where[1:] != where[:-1])])
                at = pa.array(row[new])
                ends = np.append(new, len(row)).astype(np.int32)
                columns = [pa.array(where[new].astype(np.int64))]
                columns += [part.column(c).take(at) for c in ("h", "g", "v")]
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(leaf.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names=["bin", "h", "g", "v", "leaves"])

    return queries.mapInArrow(walk, f"bin long, h long, g long, v {kind}, leaves array<int>")


def best_of_bin(q: np.ndarray, leaves: pa.ListArray, x: np.ndarray, leaf: np.ndarray, top: int):
    """Query, row and score of the best ``top`` vectors of each query within its leaves."""
    score = np.full((len(q), top), -np.inf)
    found = np.zeros((len(q), top), np.int64)
    ends = leaves.offsets.to_numpy()
    visitor = np.repeat(np.arange(len(q)), np.diff(ends))
    visited = leaves.values.to_numpy()[ends[0] : ends[-1]]
    by_leaf = np.argsort(leaf, kind="stable")
    cuts = np.searchsorted(leaf[by_leaf], np.arange(leaf.max(initial=-1) + 2))
    by_visit = np.argsort(visited, kind="stable")
    for number in np.unique(leaf):
        members = by_leaf[cuts[number] : cuts[number + 1]]
        low, high = np.searchsorted(visited[by_visit], [number, number + 1])
        guests = visitor[by_visit[low:high]]
        for at in range(0, len(guests), QUERY_BLOCK):
            some = guests[at : at + QUERY_BLOCK]
            for begin in range(0, len(members), CELLS // QUERY_BLOCK):
                rows = members[begin : begin + CELLS // QUERY_BLOCK]
                product = q[some] @ x[rows].T
                n = min(top, len(rows))
                best = np.argpartition(-product, n - 1, axis=1)[:, :n]
                all_scores = np.hstack([score[some], np.take_along_axis(product, best, 1)])
                all_found = np.hstack([found[some], rows[best]])
                pick = np.argpartition(-all_scores, top - 1, axis=1)[:, :top]
                score[some] = np.take_along_axis(all_scores, pick, 1)
                found[some] = np.take_along_axis(all_found, pick, 1)
    query, place = np.nonzero(np.isfinite(score))
    row = found[query, place]
    exact = np.empty(len(query))
    step = max(1, CELLS // max(q.shape[1], 1))
    for at in range(0, len(query), step):
        exact[at : at + step] = inner_products(q[query[at : at + step]], x[row[at : at + step]])
    return query, row, exact


def _met(visits: DataFrame, index: DataFrame, bins: Bins, width: int, top: int) -> DataFrame:
    """The best vectors of each query in each bin: ``h``, ``g`` of the query, ``score``, ``ids``."""
    load = visits.groupBy("bin").agg(F.ceil(F.count("*") / BIN_QUERIES).cast("int").alias("columns"))
    load = kept(load, "load")
    first = F.array(*[F.lit(int(b)) for b in bins.first]) if len(bins.first) else F.array(F.lit(0))
    shards = F.array(*[F.lit(int(s)) for s in bins.shards]) if len(bins.shards) else F.array(F.lit(1))

    def of(table: Column) -> Column:
        return F.element_at(table, F.col("leaf") + 1)

    placed = index.withColumn("bin", (of(first) + F.pmod(F.col("g"), of(shards))).cast("long"))
    # A bin that more queries visit than a task holds is met by several tasks.
    candidates = placed.join(load, "bin").select(
        F.col("bin").alias("c_bin"), F.explode(F.sequence(F.lit(0), F.col("columns") - 1)).alias("c_part"),
        F.col("leaf").alias("c_leaf"), F.col("v").alias("c_v"), F.col("ids").alias("c_ids"),
    )
    asked = visits.join(load, "bin").withColumn("part", F.pmod(F.col("h"), F.col("columns")).cast("int"))

    def meet(_, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            empty = pa.array([], pa.int64())
            lists = pa.array([], pa.list_(pa.int64()))
            return pa.table({"h": empty, "g": empty, "score": pa.array([], pa.float64()), "ids": lists})
        query, row, score = best_of_bin(
            padded(_lists(left.column("v")), width), _lists(left.column("leaves")),
            padded(_lists(right.column("c_v")), width), right.column("c_leaf").to_numpy().astype(np.int64), top,
        )
        at = pa.array(query)
        return pa.table(
            {
                "h": left.column("h").take(at), "g": left.column("g").take(at),
                "score": pa.array(score), "ids": right.column("c_ids").take(pa.array(row)),
            }
        )

    met = asked.groupBy("bin", "part").cogroup(candidates.groupBy("c_bin", "c_part"))
    return met.applyInArrow(meet, "h long, g long, score double, ids array<long>")


def search(
    vectors: DataFrame,
    is_query: str,
    key: str = "vec_id",
    vector: str = "embedding",
    top: int = TOP,
    recall: float = RECALL,
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` of the neighbours that were found.

    ``is_query`` is an SQL condition on ``id``, the key. Vectors that are null, all zero (empty
    ones too) or hold a null or non-finite component take no part, nor do rows with a null key.
    Vectors of different lengths are compared as if filled with zeros. Equal scores go by the
    smaller key. Rows that repeat a key are searched and listed once for each; none lists its own
    key. An empty table gives no row. Other columns are left out.
    """
    ready(vectors.sparkSession)
    rows = usable(vectors, key, vector)
    distinct, number = kept_counted(folded(rows, top + 1), "distinct")
    width = distinct.agg(F.coalesce(F.max(F.size("v")), F.lit(0)).alias("w")).head()["w"]
    asking = kept(rows.where(F.expr(is_query)).select("id", "h", "g"), "queries")
    queries, asked = kept_counted(distinct.join(asking.select("h", "g"), ["h", "g"], "left_semi"), "asked")
    if not number or not asked:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    most = max(1, min(SAMPLE_VECTORS, SAMPLE_BYTES // (8 * width)))
    tree = fit(_matrix(_draw(distinct, number, most), width)[1])
    index = kept(with_leaf(distinct, tree, width), "index")
    sample = _draw(queries, asked, min(SAMPLE_QUERIES, most))
    visits, _ = calibrate(index, sample, tree, width, top, recall)
    sizes = np.zeros(tree.leaves, np.int64)
    for leaf, size in index.groupBy("leaf").count().collect():
        sizes[leaf] = size
    usual = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bound = max(1, min(BIN_VECTORS, 8 * BIN_VECTORS * 64 // max(width, 1)))
    bins = deal_leaves(sizes, min(bound, max(LEAST_BIN, number // usual)))
    walked = kept(_visits(queries, tree, bins, visits, width), "visits")
    met = _met(walked, index, bins, width, top + 1)
    nearest = Window.partitionBy("h", "g").orderBy(F.desc("score"), F.col("ids")[0])
    few = met.withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= top + 1)
    each = few.select("h", "g", "score", F.explode("ids").alias("id"))
    order = Window.partitionBy("h", "g").orderBy(F.desc("score"), "id")
    best = each.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top + 1)
    lists = best.groupBy("h", "g").agg(
        F.array_sort(F.collect_list(F.struct("place", "id", "score"))).alias("near")
    )
    others = F.filter("near", lambda n: n["id"] != F.col("id"))
    listed = asking.join(lists, ["h", "g"]).select(
        F.col("id").alias("query_id"), F.posexplode(F.slice(others, 1, top)).alias("place", "n")
    )
    return listed.select(
        "query_id", (F.col("place") + 1).alias("rank"), F.col("n.id").alias("vec_id"), F.col("n.score").alias("score")
    )

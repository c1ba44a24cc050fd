"""Ranked lexical search, reversed: documents stream through an inverted index of the items.

The items are few against the documents, so their terms form the index: each term with the items
that hold it. The index is sent to every task; a document's term counts pass through it once, add
up its score for every item they meet, and enter the bounded heaps of those items. The heaps of
all tasks are merged at the end. No document meets an item without a common term, and no list of
documents per term is ever built.

Items are taken in blocks whose texts have at most ``BLOCK_BYTES`` together (or one item each), so
the index that is sent has a proven bound; more items cost more passes over the documents.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from winnow.llm.shared import kept, whole_text
from winnow.llm.words import slices, words_of

TOP = 20
BLOCK_BYTES = 8 * 1024 * 1024
# Scores held at once by a task, documents times items, and meetings of a term with an item.
CELLS = 2_000_000
MEETINGS = 1_000_000


@dataclass(frozen=True)
class Index:
    """Items of each term: those of term ``t`` are ``item[start[t]:start[t + 1]]``.

    ``terms`` are the sorted hashes of the terms and ``times`` the occurrences in the item.
    """

    keys: pa.Array
    terms: np.ndarray
    start: np.ndarray
    item: np.ndarray
    times: np.ndarray


@dataclass(frozen=True)
class Weights:
    """Weight of each term of an index, number of documents with terms, and all their terms."""

    term: np.ndarray
    documents: int
    terms: int


def term_hashes(texts: pa.Array):
    """Terms of texts without nulls: runs of ASCII letters and digits and of all other characters
    beyond ASCII, with only A-Z in lower case."""
    return words_of(pc.ascii_lower(texts), lower=False, symbols_apart=True)


def build_index(keys: pa.Array, texts: pa.Array) -> Index:
    """The inverted index of a block of items; rows of an equal key are one item."""
    distinct = pc.unique(keys)
    place = {k: i for i, k in enumerate(distinct.to_pylist())}
    of_row = np.array([place[k] for k in keys.to_pylist()], np.int64)
    words = term_hashes(texts)
    terms, term = np.unique(words.hash, return_inverse=True)
    pairs, times = np.unique(
        term.astype(np.int64) * max(len(place), 1) + of_row[words.doc], return_counts=True
    )
    start = np.searchsorted(pairs // max(len(place), 1), np.arange(len(terms) + 1))
    return Index(distinct, terms, start, pairs % max(len(place), 1), times.astype(np.int64))


def _joined(ends: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values.astype(np.int32)))


def term_counts(docs: DataFrame, index: Index) -> DataFrame:
    """``doc_id``, ``n`` terms with repeats, and the occurrences ``tfs`` of the index ``terms``.

    A document without any term has no row; one without a term of the index has empty lists.
    """
    known = index.terms

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text"):
                words = term_hashes(rows.column("text"))
                at = np.searchsorted(known, words.hash)
                at[at == len(known)] = 0
                hit = known[at] == words.hash if len(known) else np.zeros(len(at), bool)
                width = max(len(known), 1)
                pairs, tf = np.unique(words.doc[hit] * width + at[hit], return_counts=True)
                ends = np.searchsorted(pairs // width, np.arange(rows.num_rows + 1))
                out = pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"),
                        pa.array(words.counts.astype(np.int64)),
                        _joined(ends, pairs % width),
                        _joined(ends, tf),
                    ],
                    names=["doc_id", "n", "terms", "tfs"],
                )
                yield out.filter(pa.array(words.counts > 0))

    return whole_text(docs).mapInArrow(count, "doc_id long, n long, terms array<int>, tfs array<int>")


def weigh(counts: DataFrame, index: Index) -> Weights:
    """Statistics of all documents; the terms of one index at most reach the driver."""
    whole = counts.agg(F.count("*").alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).head()
    held = np.zeros(len(index.terms), np.int64)
    for term, df in counts.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        held[term] = df
    n = whole["n"]
    weight = [math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) for df in held.tolist()]
    return Weights(np.array(weight, np.int64), n, whole["l"])


class Heaps:
    """The best ``top`` documents of each item; equal scores by smaller key, a null key last."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.heaps: list[list[tuple[int, int, int]]] = [[] for _ in range(items)]
        # What a document has to exceed, or to equal with a smaller key.
        self.least = np.zeros(items, np.int64)
        self.key = np.full(items, -(2**63), np.int64)

    def offer(self, scores: np.ndarray, keys: np.ndarray, null: np.ndarray) -> None:
        """Enter documents by rows of ``scores``, a column for each item."""
        order = np.where(null, 2**63 - 1, keys)
        good = (scores > self.least) | ((scores == self.least) & (order[:, None] < self.key))
        for row, item in zip(*(a.tolist() for a in np.nonzero(good & (scores > 0)))):
            heap = self.heaps[item]
            entry = (int(scores[row, item]), 0 if null[row] else 1, -int(keys[row]))
            if len(heap) < self.top:
                heapq.heappush(heap, entry)
            else:
                heapq.heappushpop(heap, entry)
            if len(heap) == self.top:
                self.least[item] = heap[0][0]
                self.key[item] = -heap[0][2] if heap[0][1] else 2**63 - 1

    def rows(self) -> tuple[list[int], list[int | None], list[int]]:
        found = [(i, -k if known else None, s) for i, h in enumerate(self.heaps) for s, known, k in h]
        return tuple(list(c) for c in zip(*found)) if found else ([], [], [])


def _scores(n, owner, term, tf, index: Index, weights: Weights) -> np.ndarray:
    """Score of every document for every item of the index, in 64-bit integers."""
    items = len(index.keys)
    length = [75 + 25 * x * weights.documents // weights.terms for x in n.tolist()]
    length = np.array(length, np.int64)
    part = weights.term[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * length[owner]))
    fan = index.start[term + 1] - index.start[term]
    begin = np.cumsum(fan) - fan
    at = np.arange(fan.sum()) + np.repeat(index.start[term] - begin, fan)
    out = np.zeros(len(n) * items, np.int64)
    np.add.at(out, np.repeat(owner, fan) * items + index.item[at], np.repeat(part, fan) * index.times[at])
    return out.reshape(len(n), items)


def rank_block(counts: DataFrame, index: Index, weights: Weights, key: StructField, top: int) -> DataFrame:
    """The heaps of every task over its documents: item key, ``doc_id`` and ``score``."""
    fan = np.diff(index.start)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = len(index.keys)
        heaps = Heaps(items, top)
        for batch in batches:
            lists = batch.column("terms")
            ends = lists.offsets.to_numpy().astype(np.int64)
            term = lists.values.to_numpy()[ends[0] : ends[-1]].astype(np.int64)
            other = batch.column("tfs")
            cut = other.offsets.to_numpy()
            tf = other.values.to_numpy()[cut[0] : cut[-1]].astype(np.int64)
            ends = ends - ends[0]
            met = np.concatenate([[0], np.cumsum(fan[term])])[ends]
            n = batch.column("n").to_numpy()
            null = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            keys = batch.column("doc_id").fill_null(0).to_numpy()
            low = 0
            while low < batch.num_rows:
                high = int(np.searchsorted(met, met[low] + MEETINGS, "right")) - 1
                high = min(max(high, low + 1), low + max(CELLS // items, 1), batch.num_rows)
                size = np.diff(ends[low : high + 1])
                part = slice(ends[low], ends[high])
                owner = np.repeat(np.arange(high - low), size)
                scores = _scores(n[low:high], owner, term[part], tf[part], index, weights)
                heaps.offer(scores, keys[low:high], null[low:high])
                low = high
        item, doc, score = heaps.rows()
        yield pa.RecordBatch.from_arrays(
            [
                index.keys.take(pa.array(item, pa.int64())),
                pa.array(doc, pa.int64()),
                pa.array(score, pa.int64()),
            ],
            names=[key.name, "doc_id", "score"],
        )

    schema = StructType([key, StructField("doc_id", LongType()), StructField("score", LongType())])
    return counts.where(F.size("terms") > 0).mapInArrow(stream, schema)


def _blocks(items: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    """The items with the number ``block`` of their block; blocks are within the bound."""
    number = 1
    spread = F.xxhash64("key")
    whole = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).head()["b"]
    while True:
        placed = items.withColumn("block", F.pmod(spread, F.lit(number)).cast("int"))
        if whole <= block_bytes:
            return placed, 1
        number = max(2 * number, -(-2 * whole // block_bytes))
        placed = items.withColumn("block", F.pmod(spread, F.lit(number)).cast("int"))
        size = placed.groupBy("block", "key").agg(F.sum(F.octet_length("text")).alias("b"))
        size = size.groupBy("block").agg(F.sum("b").alias("b"), F.count("*").alias("items"))
        if size.where((F.col("b") > block_bytes) & (F.col("items") > 1)).isEmpty():
            return placed, number


def search(
    docs: DataFrame,
    items: DataFrame,
    key: str = "item_id",
    text: str = "text",
    top: int = TOP,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``key``, ``rank`` from 1, ``doc_id`` and ``score`` of each item's best documents.

    Every whole text of ``docs`` is ranked for every item. A null text has no terms; a document
    without terms is not counted. Rows that repeat a ``doc_id`` are documents of their own, one
    with a null ``doc_id`` comes after its equals. Rows of ``items`` with an equal key, null
    included, are one item with the terms of all; an item without terms has no result. Other
    columns are left out.
    """
    plain = items.select(F.col(key).alias("key"), F.coalesce(text, F.lit("")).alias("text"))
    field = StructField(key, plain.schema["key"].dataType)
    placed, number = _blocks(plain, block_bytes)
    ranked = None
    for block in range(number):
        rows = placed.where(F.col("block") == block).select("key", "text").toArrow()
        index = build_index(rows.column("key").combine_chunks(), _one(rows.column("text")))
        counts = kept(term_counts(docs, index), "term-counts")
        part = rank_block(counts, index, weigh(counts, index), field, top)
        ranked = part if ranked is None else ranked.unionByName(part)
    best = Window.partitionBy(key).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    place = F.row_number().over(best).cast(IntegerType())
    return ranked.withColumn("rank", place).where(F.col("rank") <= top).select(key, "rank", "doc_id", "score")


def _one(column: pa.ChunkedArray) -> pa.Array:
    whole = column.combine_chunks()
    return pa.concat_arrays(whole.chunks) if isinstance(whole, pa.ChunkedArray) else whole

"""Quality classifier on random-indexing word vectors.

Every word has a spelling and a shape. A word that makes up at least a given share of all tokens
has a spelling vector of its own; there are at most as many of these words as the share goes into
one, at any size of the corpus. The spellings of rarer words are tied by hash in buckets, and so
are shapes. A vector is the sum of sparse random index vectors of the words near all occurrences
in the corpus. A document pools the vectors of its words; a two-layer network in numpy judges the
pooled vector, and its probabilities are calibrated by a temperature.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm.shared import kept, whole_text
from winnow.llm.words import Words, mix, slices, words_of

DIMENSIONS = 48
# Words of at least this share of all tokens have their own vector: 500,000 words at most.
OWN_SHARE = 1 / 500_000
SPELLINGS = 16_384
SHAPES = 2048
NEAR = 2  # words on either side
HIDDEN = 32
# Bound of the labelled sample, by hash of the key; a fifth of it sets the temperature.
SAMPLE_EACH = 3000
PASSES = 250
THRESHOLD = 0.7
SCALARS = 5
# Words whose contexts are summed at once, and rows of the table that travel together.
WORDS_AT_ONCE = 200_000
BLOCK_ROWS = 256
_GOLDEN = 0x9E3779B97F4A7C15

# Class of a byte for the shape: lower case, capital, digit, beyond ASCII, or the symbol itself.
_CLASS = np.arange(256, dtype=np.uint64)
_CLASS[ord("a") : ord("z") + 1] = ord("a")
_CLASS[ord("A") : ord("Z") + 1] = ord("A")
_CLASS[ord("0") : ord("9") + 1] = ord("0")
_CLASS[128:] = 128


def _shapes_of(words: Words) -> np.ndarray:
    """Bucket of the shape of each word: size, first byte and last four bytes by class."""
    end = words.start + words.size
    shape = np.minimum(words.size, 12).astype(np.uint64)
    for back in range(1, 5):
        byte = _CLASS[words.data[np.maximum(end - back, 0)]]
        shape = shape * np.uint64(131) + np.where(words.size >= back, byte, np.uint64(0))
    first = _CLASS[words.data[words.start]] if len(words.start) else shape
    shape = mix(shape * np.uint64(131) + first)
    return (shape % np.uint64(SHAPES)).astype(np.int64)


@dataclass
class Kinds:
    """Rows of the vector table: buckets of spellings, of shapes, then ``own`` words by hash."""

    own: np.ndarray

    @property
    def rows(self) -> int:
        return SPELLINGS + SHAPES + len(self.own)

    def of(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Row of the spelling and of the shape of each word."""
        spelling = (words.hash % np.uint64(SPELLINGS)).astype(np.int64)
        if len(self.own):
            at = np.minimum(np.searchsorted(self.own, words.hash), len(self.own) - 1)
            found = self.own[at] == words.hash
            spelling = np.where(found, SPELLINGS + SHAPES + at, spelling)
        return spelling, SPELLINGS + _shapes_of(words)

    def index_vectors(self) -> tuple[np.ndarray, np.ndarray]:
        """Two places and signs of the index vector of each row, by its bucket or word."""
        seed = np.concatenate([np.arange(SPELLINGS + SHAPES, dtype=np.uint64), mix(self.own)])
        draw = mix((seed[:, None] * np.uint64(2) + np.arange(2, dtype=np.uint64)) * np.uint64(_GOLDEN))
        return (draw % np.uint64(DIMENSIONS)).astype(np.int64), 1 - 2 * (draw >> np.uint64(63)).astype(np.int64)


@dataclass
class Vectors:
    """Context vectors of length 1 or 0 by row, in half precision."""

    kinds: Kinds
    table: np.ndarray

    def wide(self) -> "Vectors":
        return Vectors(self.kinds, self.table.astype(np.float32))


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` (hash) and ``count`` over all texts, summed in the tasks before the exchange."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def summed(parts):
            word, n = (np.concatenate(c) for c in zip(*parts))
            unique, back = np.unique(word, return_inverse=True)
            return unique, np.bincount(back, n, len(unique)).astype(np.int64)

        def emit(parts):
            word, n = summed(parts)
            arrays = [pa.array(word.view(np.int64)), pa.array(n)]
            return pa.RecordBatch.from_arrays(arrays, names=["word", "count"])

        parts, size = [], 0
        for batch in batches:
            for rows in slices(batch, "text"):
                words = words_of(rows.column("text"), lower=False)
                parts.append(np.unique(words.hash, return_counts=True))
                size += len(parts[-1][0])
                if size > 2_000_000:
                    parts = [summed(parts)]
                    size = len(parts[0][0])
                    if size > 1_000_000:
                        yield emit(parts)
                        parts, size = [], 0
        if parts:
            yield emit(parts)

    parted = whole_text(docs).select("text").mapInArrow(count, "word long, count long")
    return parted.groupBy("word").agg(F.sum("count").alias("count"))


def own_words(docs: DataFrame, share: float = OWN_SHARE) -> Kinds:
    """The words of at least this share of all tokens; at most ``1 / share`` reach the driver."""
    counts = kept(word_counts(docs), "word-counts")
    tokens = counts.agg(F.sum("count")).head()[0] or 0
    own = counts.where(F.col("count") >= F.lit(share * tokens)).select("word").toArrow()
    return Kinds(np.sort(own.column("word").to_numpy().view(np.uint64)))


def add_contexts(
    sums: np.ndarray,
    doc: np.ndarray,
    both: tuple[np.ndarray, np.ndarray],
    index: tuple[np.ndarray, np.ndarray],
) -> None:
    """Adds to both rows of every word the index vectors of the words near it in its text.

    ``sums`` are the cells of the table, row after row.
    """
    for low in range(0, len(doc), WORDS_AT_ONCE):
        # Each pair of near words is added with its first word's part.
        part = slice(low, low + WORDS_AT_ONCE + NEAR)
        of = doc[part]
        rows = [kind[part] * DIMENSIONS for kind in both]
        drawn = [(index[0][kind[part], k], index[1][kind[part], k]) for kind in both for k in (0, 1)]
        for step in range(1, NEAR + 1):
            first = np.flatnonzero(of[step:][:WORDS_AT_ONCE] == of[:-step][:WORDS_AT_ONCE])
            for own, near in ((first, first + step), (first + step, first)):
                targets = [row[own] for row in rows]
                for place, sign in drawn:
                    place, sign = place[near], sign[near]
                    for target in targets:
                        np.add.at(sums, target + place, sign)


def random_indexing(docs: DataFrame, share: float = OWN_SHARE) -> Vectors:
    """Context vectors of all own words and buckets, gathered from all documents.

    The tasks send their sums as compressed blocks of rows; each block is added up in one place,
    a sent block at a time. A null or empty text adds nothing, repeated rows add again.
    """
    kinds = own_words(docs, share)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = kinds.index_vectors()
        sums = np.zeros(-(-kinds.rows // BLOCK_ROWS) * BLOCK_ROWS * DIMENSIONS, "<i8")
        for batch in batches:
            for rows in slices(batch, "text"):
                words = words_of(rows.column("text"), lower=False)
                add_contexts(sums, words.doc, kinds.of(words), index)
        pack = zstandard.ZstdCompressor(level=1)
        for number, block in enumerate(sums.reshape(-1, BLOCK_ROWS * DIMENSIONS)):
            if block.any():
                # Bytes of equal worth together, most of which are equal.
                planes = np.ascontiguousarray(block.view(np.uint8).reshape(-1, 8).T)
                arrays = [pa.array([number], pa.int32()), pa.array([pack.compress(planes.tobytes())])]
                yield pa.RecordBatch.from_arrays(arrays, names=["block", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, held = zstandard.ZstdDecompressor(), {}
        for batch in batches:
            for number, packed in zip(batch.column("block").to_pylist(), batch.column("sums")):
                planes = np.frombuffer(unpack.decompress(packed.as_py()), np.uint8).reshape(8, -1)
                block = np.ascontiguousarray(planes.T).view("<i8").ravel()
                held[number] = held.get(number, 0) + block
        for number, block in held.items():
            rows = block.reshape(-1, DIMENSIONS).astype(float)
            norm = np.sqrt((rows * rows).sum(1, keepdims=True))
            rows = np.divide(rows, norm, out=np.zeros_like(rows), where=norm > 0)
            arrays = [pa.array([number], pa.int32()), pa.array([rows.astype("<f2").tobytes()])]
            yield pa.RecordBatch.from_arrays(arrays, names=["block", "rows"])

    parted = whole_text(docs).select("text").mapInArrow(gather, "block int, sums binary")
    added = parted.repartition("block").mapInArrow(add, "block int, rows binary").toArrow()
    table = np.zeros((-(-kinds.rows // BLOCK_ROWS) * BLOCK_ROWS, DIMENSIONS), np.float16)
    for number, rows in zip(added.column("block").to_pylist(), added.column("rows")):
        block = np.frombuffer(rows.as_py(), "<f2").reshape(-1, DIMENSIONS)
        table[number * BLOCK_ROWS : (number + 1) * BLOCK_ROWS] = block
    return Vectors(kinds, table[: kinds.rows])


def pooled(words: Words, vectors: Vectors) -> np.ndarray:
    """Per text: mean vectors of spellings and shapes, spread of the shapes, and scalars.

    The scalars are logarithms of the words and of their mean length, the share of distinct
    words, and the shares of words next to an equal one and next to one of equal shape.
    """
    n, counts = len(words.counts), words.counts
    spelling, shape = vectors.kinds.of(words)
    every = np.maximum(counts, 1)[:, None]
    out = np.zeros((n, 3 * DIMENSIONS + SCALARS))
    if not len(words.doc):
        return out
    ends = np.cumsum(counts)
    for i in np.flatnonzero(counts):
        for low in range(ends[i] - counts[i], ends[i], WORDS_AT_ONCE):
            part = slice(low, min(low + WORDS_AT_ONCE, ends[i]))
            own = vectors.table[shape[part]]
            out[i, :DIMENSIONS] += vectors.table[spelling[part]].sum(0)
            out[i, DIMENSIONS : 2 * DIMENSIONS] += own.sum(0)
            out[i, 2 * DIMENSIONS : 3 * DIMENSIONS] += np.einsum("ij,ij->j", own, own)
    out /= every
    mean = out[:, DIMENSIONS : 2 * DIMENSIONS]
    spread = out[:, 2 * DIMENSIONS : 3 * DIMENSIONS]
    spread[:] = np.sqrt(np.maximum(spread - mean * mean, 0))
    order = np.lexsort((words.hash, words.doc))
    new = np.ones(len(order))
    new[1:] = (np.diff(words.hash[order]) != 0) | (np.diff(words.doc[order]) != 0)
    out[:, -5] = np.log1p(counts)
    out[:, -4] = np.log1p(np.bincount(words.doc, words.size, n) / every[:, 0])
    out[:, -3] = np.bincount(words.doc[order], new, n) / every[:, 0]
    same = words.doc[1:] == words.doc[:-1]
    for column, value in ((-2, spelling), (-1, shape)):
        equal = same & (value[1:] == value[:-1])
        out[:, column] = np.bincount(words.doc[1:], equal, n) / every[:, 0]
    return out


@dataclass
class Network:
    """Two layers over standardised inputs, and the temperature of the output."""

    mean: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    second: np.ndarray
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        hidden = np.tanh(x @ self.first[:-1] + self.first[-1])
        return hidden @ self.second[:-1] + self.second[-1]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def fit(x: np.ndarray, good: np.ndarray, weight: np.ndarray, passes: int = PASSES) -> Network:
    """The network on four fifths of the sample, its temperature on the rest.

    ``weight`` restores the shares of the labels that the sample does not keep. Without rows of
    both labels the network gives the share of good ones, one half without any.
    """
    width = x.shape[1]
    constant = Network(
        np.zeros(width), np.ones(width), np.zeros((width + 1, HIDDEN)), np.zeros(HIDDEN + 1), 1.0
    )
    if good.all() or not good.any():
        share = np.clip(good.mean() if len(good) else 0.5, 0.01, 0.99)
        constant.second[-1] = np.log(share / (1 - share))
        return constant
    rng = np.random.default_rng(7)
    last = rng.permutation(len(x))
    train, rest = last[len(x) // 5 :], last[: len(x) // 5]
    mean, scale = x[train].mean(0), x[train].std(0) + 1e-4
    net = Network(
        mean,
        scale,
        rng.normal(0, 1 / np.sqrt(width), (width + 1, HIDDEN)),
        rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN + 1),
        1.0,
    )
    z = np.clip((x[train] - mean) / scale, -8, 8)
    y, w = good[train].astype(float), weight[train] / weight[train].sum()
    moments = [np.zeros_like(p) for p in (net.first, net.first, net.second, net.second)]
    for step in range(1, passes + 1):
        hidden = np.tanh(z @ net.first[:-1] + net.first[-1])
        out = hidden @ net.second[:-1] + net.second[-1]
        slope = w * (1 / (1 + np.exp(-np.clip(out, -30, 30))) - y)
        back = slope[:, None] * net.second[:-1] * (1 - hidden * hidden)
        up = [
            np.vstack([z.T @ back, back.sum(0)]) + 1e-4 * net.first,
            np.append(hidden.T @ slope, slope.sum()) + 1e-4 * net.second,
        ]
        for i, (g, p) in enumerate(zip(up, (net.first, net.second))):
            m, v = moments[2 * i], moments[2 * i + 1]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    if len(rest) and good[rest].any() and not good[rest].all():
        raw, sign = net.logits(x[rest]), np.where(good[rest], 1.0, -1.0)
        tried = np.geomspace(0.05, 20, 121)
        loss = [(weight[rest] * np.logaddexp(0, -sign * raw / t)).sum() for t in tried]
        net.temperature = float(tried[int(np.argmin(loss))])
    return net


def learn(docs: DataFrame, labels: DataFrame, label: str, vectors: Vectors) -> Network:
    """The network of at most ``SAMPLE_EACH`` labelled documents of either label.

    The documents with the smallest hashes of their keys are taken. Keys labelled both ways
    count as bad; null keys and labels are left out.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    known = known.groupBy("doc_id").agg(F.min(label).alias("label"))
    drawn = known.withColumn("draw", F.xxhash64("doc_id"))
    totals = dict(known.groupBy("label").count().where("label IN (0, 1)").collect())
    chosen = [
        drawn.where(F.col("label") == value).orderBy("draw", "doc_id").limit(SAMPLE_EACH)
        for value in (0, 1)
    ]
    keys = F.broadcast(chosen[0].unionByName(chosen[1]))  # 2 * SAMPLE_EACH rows at most
    width = 3 * DIMENSIONS + SCALARS

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = vectors.wide()
        for batch in batches:
            for rows in slices(batch, "text"):
                x = pooled(words_of(rows.column("text"), lower=False), wide)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("draw"),
                        rows.column("label").cast(pa.int32()),
                        pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), width).cast(
                            pa.list_(pa.float64())
                        ),
                    ],
                    names=["draw", "label", "x"],
                )

    rows = whole_text(docs).join(keys, "doc_id").select("text", "draw", "label")
    sample = rows.mapInArrow(pool, "draw long, label int, x array<double>").toArrow()
    order = np.argsort(sample.column("draw").to_numpy(), kind="stable")
    x = np.zeros((0, width))
    if sample.num_rows:
        x = np.vstack([v.values.to_numpy() for v in sample.column("x")])[order]
    good = sample.column("label").to_numpy()[order] == 1
    share = {g: totals.get(int(g), 0) / max(1, int((good == g).sum())) for g in (False, True)}
    return fit(x, good, np.where(good, share[True], share[False]))


def score(docs: DataFrame, vectors: Vectors, net: Network, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``score`` from 0 to 1 and ``predicted`` of every document.

    Null and empty texts pool to zeros and are scored like others, and so are rows with null or
    repeated keys; a very long text is pooled alone. Other columns are left out.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = vectors.wide()
        for batch in batches:
            for rows in slices(batch, "text"):
                value = net.scores(pooled(words_of(rows.column("text"), lower=False), wide))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(value), pa.array((value >= threshold).astype(np.int32))],
                    names=["doc_id", "score", "predicted"],
                )

    return whole_text(docs).mapInArrow(judge, "doc_id long, score double, predicted int")

"""Toxic spans by a linear-chain conditional random field, and document scores from them.

Words are tagged clean or toxic. The tags of the training documents come from their labels: in a
document labelled toxic, the words whose form or beginning is far more frequent in toxic than in
clean documents, by a false discovery rate that holds for any number of texts. The field is
fitted to these tags; forward-backward marginals of every whole text give the offending offsets
and, summed up, a calibrated document score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm.chain import posterior
from winnow.llm.shared import whole_text
from winnow.llm.words import Words, mix, prefix, slices, tail, words_of

BUCKETS = 1 << 18
# Bound of the labelled sample, by hash of the key.
SAMPLE_TOXIC = 1000
SAMPLE_CLEAN = 1000
PASSES = 40
# A word is tagged if it, or its beginning, is so many times as frequent in toxic texts as in
# clean ones, and so large a share of the words that are as unlikely by chance are no chance.
TAG_RATIO = 20.0
TAG_TRUE = 0.8
# Smallest hashes by which edited copies are recognised.
COPY_HASHES = 8
THRESHOLD = 0.7
SPAN_PROBABILITY = 0.5
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_OWN = 4  # the first four features are the word and its beginnings


def features(words: Words) -> np.ndarray:
    """Hashed features of each word, one row each: the word, its beginnings, its end, and the
    words beside it in the same text."""
    kinds = [words.hash, *(prefix(words, n) for n in (4, 5, 6))]
    kinds.append(tail(words, 1) | tail(words, 2) << np.uint64(8) | tail(words, 3) << np.uint64(16))
    last = len(words.hash) - 1
    at = np.arange(len(words.hash))
    for near in (np.maximum(at - 1, 0), np.minimum(at + 1, last)):
        same = (words.doc[near] == words.doc) & (near != at)
        kinds.append(np.where(same, words.hash[near], np.uint64(0)))
    salted = [mix(k + np.uint64(int(_GOLDEN) * (i + 1) % 2**64)) for i, k in enumerate(kinds)]
    return np.stack([(k >> np.uint64(46)).astype(np.int32) for k in salted])


@dataclass
class Field:
    """Weights of features for the toxic tag, moves between tags, and the document scores'."""

    weights: np.ndarray
    moves: np.ndarray
    document: np.ndarray

    def marginals(self, words: Words) -> np.ndarray:
        """Probability of the toxic tag for each word."""
        if not len(words.hash):
            return np.zeros(0)
        score = self.weights[features(words)].sum(0)
        lengths = words.counts[words.counts > 0]
        return _marginals(score, lengths, self.moves)[0]


def _marginals(score: np.ndarray, lengths: np.ndarray, moves: np.ndarray):
    # Both weights of a word are divided by the larger one, which changes no marginal.
    emit = np.exp(np.stack([np.minimum(-score, 0), np.minimum(score, 0)], 1))
    _, gamma, pairs = posterior(np.maximum(emit, 1e-30), lengths, np.array([0.5, 0.5]), np.exp(moves))
    return gamma[:, 1], pairs


def document_inputs(gamma: np.ndarray, doc: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per text: a constant, logarithm of the expected toxic words, and the largest marginal."""
    n = len(counts)
    expected = np.bincount(doc, gamma, n)
    most = np.zeros(n)
    np.maximum.at(most, doc, gamma)
    share = expected / np.maximum(counts, 1)
    return np.stack([np.ones(n), np.log1p(expected), most, np.log1p(100 * share)], 1)


def _adam(gradient, x: np.ndarray, passes: int, rate: float) -> np.ndarray:
    first, second = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, passes + 1):
        g = gradient(x)
        first += 0.1 * (g - first)
        second += 0.001 * (g * g - second)
        x = x + rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return x


def _tags(words: Words, found: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Words of toxic texts whose form or beginning marks toxic texts."""
    key = _copies(words)
    bad = toxic[words.doc]
    tag = np.zeros(len(words.doc), bool)
    texts = [max(1, len(np.unique(key[toxic == t]))) for t in (False, True)]
    for feature in found[:_OWN]:
        counted = []
        for kind in (False, True):
            use = bad == kind
            pairs = np.unique(feature[use].astype(np.int64) * len(toxic) + key[words.doc[use]])
            counted.append(np.bincount(pairs // len(toxic), minlength=BUCKETS))
        far = counted[1] * texts[0] >= TAG_RATIO * counted[0] * texts[1]
        true = _discoveries(counted[1], counted[0], texts[1] / (texts[0] + texts[1]))
        tag |= (far & (true >= TAG_TRUE))[feature] & bad
    return tag


def _copies(words: Words) -> np.ndarray:
    """The same number for texts that share a smallest hash of three words, so copies, also
    edited ones, count about once."""
    n = len(words.counts)
    key = np.arange(n)
    some = np.flatnonzero(words.counts)
    begins = (np.cumsum(words.counts) - words.counts)[some]
    grams = words.hash.copy()
    for step in (1, 2):
        same = words.doc[step:] == words.doc[:-step]
        grams[:-step] += np.where(same, mix(words.hash[step:] + np.uint64(step)), np.uint64(0))
    least = []
    for i in range(COPY_HASHES):
        salted = mix(grams + np.uint64(int(_GOLDEN) * i % 2**64))
        least.append(np.unique(np.minimum.reduceat(salted, begins), return_inverse=True)[1])
    while True:
        before = key.copy()
        for groups in least:
            lowest = np.full(groups.max(initial=0) + 1, n)
            np.minimum.at(lowest, groups, key[some])
            key[some] = lowest[groups]
        if (key == before).all():
            return key


def _discoveries(toxic: np.ndarray, clean: np.ndarray, share: float) -> np.ndarray:
    """Share of true marks among the features at least as unlikely by chance as each.

    By chance a feature's texts are toxic independently, each with probability ``share``. The
    numbers of texts allow few tail probabilities, so the marks to expect by chance are summed
    over the features with each number of texts.
    """
    draws = toxic + clean
    numbers = np.unique(draws[draws > 0])
    features_of = np.bincount(draws)
    ways = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, draws.max(initial=0) + 1)))])
    tails = {}
    for n in numbers.tolist():
        k = np.arange(n + 1)
        hits = ways[n] - ways[k] - ways[n - k] + k * np.log(share) + (n - k) * np.log1p(-share)
        tails[n] = np.minimum(np.cumsum(np.exp(hits)[::-1])[::-1], 1.0)
    chance = np.ones(len(draws))
    for n in numbers.tolist():
        own = np.flatnonzero(draws == n)
        chance[own] = tails[n][toxic[own]]
    levels, back, found = np.unique(chance, return_inverse=True, return_counts=True)
    expected = np.zeros(len(levels))
    for n in numbers.tolist():
        # The largest tail probability of n texts that is not over the level.
        reached = np.append(0.0, tails[n][::-1])
        at = np.searchsorted(tails[n][::-1], levels, "right")
        expected += features_of[n] * reached[at]
    # Empty buckets are no features; they have the last level.
    found[-1] -= np.count_nonzero(draws == 0)
    false = np.minimum(expected / np.maximum(np.cumsum(found), 1), 1.0)
    # A less likely feature is never the falser one.
    false = np.minimum.accumulate(false[::-1])[::-1]
    return (1 - false)[back]


def fit(texts: list[str], toxic: list[bool], passes: int = PASSES) -> Field:
    """The field and document scores of labelled texts; the texts are a bounded sample.

    Without texts of both labels every score is the share of toxic ones, one half without any.
    """
    label = np.array(toxic, bool)
    empty = Field(np.zeros(BUCKETS), np.zeros((2, 2)), np.zeros(4))
    words = words_of(pa.array(texts, pa.string()), symbols_apart=True)
    if label.all() or not label.any() or not len(words.hash):
        share = np.clip(label.mean() if len(label) else 0.5, 0.01, 0.99)
        empty.document[0] = np.log(share / (1 - share))
        return empty
    found = features(words)
    tags = _tags(words, found, label).astype(float)
    lengths = words.counts[words.counts > 0]
    begins = np.cumsum(lengths) - lengths
    inner = np.ones(len(tags), bool)
    inner[begins] = False
    at = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (tags[at - 1].astype(int), tags[at].astype(int)), 1)

    def gradient(x: np.ndarray) -> np.ndarray:
        weights, moves = x[:BUCKETS], x[BUCKETS:].reshape(2, 2)
        gamma, pairs = _marginals(weights[found].sum(0), lengths, moves)
        left = tags - gamma
        up = np.zeros(BUCKETS)
        for feature in found:
            up += np.bincount(feature, left, BUCKETS)
        return np.concatenate([up - 0.05 * weights, (seen - pairs - 0.05 * moves).ravel()])

    # The bias is in the moves: tags begin rare.
    x = np.concatenate([np.zeros(BUCKETS), [2.0, -2.0, 0.0, -1.0]])
    x = _adam(gradient, x, passes, 0.15)
    field = Field(x[:BUCKETS].astype(np.float32), x[BUCKETS:].reshape(2, 2), np.zeros(4))
    gamma = field.marginals(words)
    inputs = document_inputs(gamma, words.doc, words.counts)

    def document_gradient(b: np.ndarray) -> np.ndarray:
        return inputs.T @ (label - 1 / (1 + np.exp(-np.clip(inputs @ b, -30, 30)))) - 0.05 * b

    field.document = _adam(document_gradient, np.zeros(4), 800, 0.05)
    return field


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, ones: int, zeros: int
) -> tuple[list[str], list[bool]]:
    """Texts and labels of at most ``ones`` and ``zeros`` documents, equal texts once.

    The documents with the smallest hashes of their keys are taken. A key labelled both 0 and 1
    counts as 1; null keys and labels are left out.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    known = known.groupBy("doc_id").agg(F.max(label).alias("label"))
    drawn = known.withColumn("draw", F.xxhash64("doc_id"))
    chosen = [
        drawn.where(F.col("label") == value).orderBy("draw", "doc_id").limit(most)
        for value, most in ((1, ones), (0, zeros))
    ]
    # At most ``ones + zeros`` keys and their texts.
    keys = F.broadcast(chosen[0].unionByName(chosen[1]))
    rows = whole_text(docs).join(keys, "doc_id").orderBy("draw", "doc_id")
    picked = {r["text"]: r["label"] == 1 for r in rows.select("text", "label").collect()}
    return list(picked), list(picked.values())


SCORE_SCHEMA = "doc_id long, score double, predicted int, spans array<struct<start:int,end:int>>"


def _judged(texts: pa.Array, field: Field) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words of the texts, their marginals, and the score of each text."""
    words = words_of(texts, symbols_apart=True)
    gamma = field.marginals(words)
    inputs = document_inputs(gamma, words.doc, words.counts)
    return words, gamma, 1 / (1 + np.exp(-np.clip(inputs @ field.document, -30, 30)))


def _spans(words: Words, gamma: np.ndarray) -> pa.ListArray:
    """Places of toxic words in code points; words next to each other share a span."""
    hit = np.flatnonzero(gamma >= SPAN_PROBABILITY)
    doc = words.doc[hit]
    joined = np.zeros(len(hit), bool)
    joined[1:] = (np.diff(hit) == 1) & (np.diff(doc) == 0)
    first = np.flatnonzero(~joined)
    final = np.append(first[1:], len(hit))[: len(first)] - 1
    points = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
    base = points[words.first[doc[first]]]
    start = points[words.start[hit[first]]] - base
    end = points[(words.start + words.size)[hit[final]]] - base
    offsets = np.searchsorted(doc[first], np.arange(len(words.counts) + 1))
    places = [pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))]
    spans = pa.StructArray.from_arrays(places, ["start", "end"])
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), spans)


def score(docs: DataFrame, field: Field, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``score`` from 0 to 1, ``predicted`` and the toxic ``spans`` of every text.

    A span has the first and the last place, exclusive, in code points of the text. Null and
    empty texts have the score of a text without toxic words and no spans. Repeated rows and
    null keys are scored like others; other columns are left out.
    """

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text"):
                words, gamma, value = _judged(rows.column("text"), field)
                predicted = pa.array((value >= threshold).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(value), predicted, _spans(words, gamma)],
                    names=["doc_id", "score", "predicted", "spans"],
                )

    return whole_text(docs).mapInArrow(tag, SCORE_SCHEMA)


def without_toxic(docs: DataFrame, field: Field, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text is not predicted toxic."""

    @F.arrow_udf("boolean")
    def clean(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in parts:
            batch = pa.RecordBatch.from_arrays([texts], names=["text"])
            flags = [_judged(rows.column("text"), field)[2] < threshold for rows in slices(batch, "text")]
            yield pa.array(np.concatenate([np.zeros(0, bool), *flags]))

    # Only the text goes to Python and a flag comes back; the rows stay where they are.
    return docs.where(clean(F.coalesce("text", F.lit(""))))

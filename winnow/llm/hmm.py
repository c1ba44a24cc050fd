"""Hidden Markov language model over whole texts.

Words are counted over all training documents. The model's latent states emit classes: each word
that makes up at least a given share of all tokens is a class of its own, rarer words fall into
classes by their last bytes, and a class gives its words in proportion to their counts.

Documents are kept in blocks of a few MB with the distinct words of each. Baum-Welch is
incremental: training documents are dealt to parts, each step sums the expected counts of one
part on the cluster, and the next model comes from the last counts of all parts. Every training
document takes part equally often, at any size of the corpus. The scaled forward recursion then
gives the exact likelihood of every text.

Counts of rare words are never broadcast: only the distinct words of a block are joined with them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm.chain import forward, posterior
from winnow.llm.shared import kept, whole_text, work_path
from winnow.llm.words import Words, mix, slices, tail, words_of

STATES = 8
# Words of at least this share of all tokens are classes of their own, 500,000 at most; one that
# occurs less often than ``OWN_LEAST`` tells too little of its states at any size.
OWN_SHARE = 1 / 500_000
OWN_LEAST = 3
TAIL_CLASSES = 2048
# Training documents are dealt to so many parts, and each part is passed so often.
PARTS = 8
PASSES = 2
# Tokens with the usual mix of states that are added to each class.
PRIOR = 2.0
BLOCK_BYTES = 8_000_000
# Tokens that a task takes through a recursion at once; a longer document goes alone.
TOKENS_AT_ONCE = 300_000
END = np.uint64(1)  # hash of the end token
END_CLASS = 0


def _tail_class(words: Words) -> np.ndarray:
    """Class of a word by its last three bytes, without the class of the end token."""
    key = tail(words, 1) | tail(words, 2) << np.uint64(8) | tail(words, 3) << np.uint64(16)
    return (mix(key) % np.uint64(TAIL_CLASSES)).astype(np.int32)


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers below 2 ** 24 in three planes of bytes, which compress well."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    low, middle, high = np.frombuffer(data, np.uint8).reshape(3, -1).astype(np.int64)
    return low | middle << 8 | high << 16


def _with_ends(values: np.ndarray, counts: np.ndarray, end) -> np.ndarray:
    """Values of words with one for the end after each document's."""
    return np.insert(values, np.cumsum(counts), end)


def token_counts(docs: DataFrame) -> DataFrame:
    """``word`` (hash), ``tail`` class and ``count`` over all tokens, ends included."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def summed(parts):
            word, tails, n = (np.concatenate(c) for c in zip(*parts))
            unique, at, back = np.unique(word, return_index=True, return_inverse=True)
            return unique, tails[at], np.bincount(back, n, len(unique)).astype(np.int64)

        def emit(parts):
            word, tails, n = summed(parts)
            return pa.RecordBatch.from_arrays(
                [pa.array(word.view(np.int64)), pa.array(tails), pa.array(n)],
                names=["word", "tail", "count"],
            )

        parts, size = [], 0
        for batch in batches:
            for rows in slices(batch, "text"):
                words = words_of(rows.column("text"))
                unique, at, n = np.unique(words.hash, return_index=True, return_counts=True)
                parts.append((unique, _tail_class(words)[at], n))
                parts.append(
                    (np.array([END]), np.array([-1], np.int32), np.array([rows.num_rows]))
                )
                size += len(unique)
                if size > 1_500_000:
                    parts = [summed(parts)]
                    size = len(parts[0][0])
                    if size > 1_000_000:
                        yield emit(parts)
                        parts, size = [], 0
        if parts:
            yield emit(parts)

    rows = whole_text(docs).select("text")
    parted = rows.mapInArrow(count, "word long, tail int, count long")
    return parted.groupBy("word").agg(F.min("tail").alias("tail"), F.sum("count").alias("count"))


@dataclass
class Vocabulary:
    """Bounded statistics of the counts; ``tokens`` is N and ``types`` is V."""

    tokens: int
    types: int
    discount: float
    frequent: np.ndarray  # sorted hashes
    frequent_count: np.ndarray
    class_tokens: np.ndarray  # by class: end, frequent words, tails
    class_types: np.ndarray

    @property
    def classes(self) -> int:
        return len(self.class_tokens)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place among the frequent words, and whether it is one."""
        if not len(self.frequent):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.frequent, hashes), len(self.frequent) - 1)
        return at, self.frequent[at] == hashes

    def classes_of(self, words: Words) -> np.ndarray:
        at, found = self.find(words.hash)
        return np.where(found, 1 + at, 1 + len(self.frequent) + _tail_class(words))


def vocabulary(counts: DataFrame, share: float = OWN_SHARE, least: int = OWN_LEAST) -> Vocabulary:
    """Statistics of a kept table of counts; the driver gets the own words and the classes.

    At most ``1 / share`` words can make up this share of all tokens.
    """
    end = int(END)
    totals = counts.agg(
        F.sum("count").alias("n"),
        F.count("*").alias("v"),
        F.count_if(F.col("count") == 1).alias("once"),
        F.count_if(F.col("count") == 2).alias("twice"),
        F.sum(F.when(F.col("word") == end, F.col("count"))).alias("ends"),
    ).head()
    words = counts.where(F.col("word") != end)
    enough = max(share * (totals["n"] or 0), least)
    top = words.where(F.col("count") >= F.lit(float(enough))).toPandas()
    top = top.assign(word=top["word"].to_numpy(np.int64).view(np.uint64)).sort_values("word")
    by_tail = words.groupBy("tail").agg(F.sum("count").alias("n"), F.count("*").alias("v")).toPandas()
    tail_tokens, tail_types = np.zeros(TAIL_CLASSES), np.zeros(TAIL_CLASSES)
    tail_tokens[by_tail["tail"]] = by_tail["n"]
    tail_types[by_tail["tail"]] = by_tail["v"]
    np.subtract.at(tail_tokens, top["tail"].to_numpy(), top["count"].to_numpy())
    np.subtract.at(tail_types, top["tail"].to_numpy(), 1)
    once, twice = totals["once"] or 0, totals["twice"] or 0
    found = np.ones(len(top))
    return Vocabulary(
        tokens=totals["n"] or 0,
        types=totals["v"],
        discount=once / (once + 2 * twice) if once and twice else 0.5,
        frequent=top["word"].to_numpy(np.uint64),
        frequent_count=top["count"].to_numpy(np.int64),
        class_tokens=np.concatenate([[totals["ends"] or 0], top["count"], tail_tokens]),
        class_types=np.concatenate([[1 if totals["ends"] else 0], found, tail_types]),
    )


@dataclass
class Model:
    """Start, move and class probabilities of the states."""

    start: np.ndarray
    move: np.ndarray
    classes: np.ndarray  # states x classes


def first_model(vocab: Vocabulary, states: int = STATES) -> Model:
    """The class frequencies, disturbed differently for each state, and slow moves."""
    rng = np.random.default_rng(20240229)
    share = vocab.class_tokens * rng.gamma(2.0, 0.5, (states, vocab.classes))
    share /= np.maximum(share.sum(1, keepdims=True), 1e-300)
    move = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
    return Model(np.full(states, 1 / states), move, share)


def _training_parts(blocks: DataFrame, parts: int) -> DataFrame:
    """The training documents of kept blocks as classes of tokens, written by ``part``.

    Documents are dealt in turn, so parts are alike and copies of a text lie in all of them.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealt = TaskContext.get().partitionId()
        for batch in batches:
            for i in range(batch.num_rows):
                held_out, sizes, places, classes = (column[i] for column in batch.columns)
                sizes = sizes.values.to_numpy().astype(np.int64)
                symbols = _from_planes(classes.as_py())[_from_planes(places.as_py())]
                symbols = _with_ends(symbols, sizes, END_CLASS)
                part = (dealt + np.arange(len(sizes))) % parts
                part[held_out.values.to_numpy(zero_copy_only=False)] = -1
                dealt += len(sizes)
                of_token = np.repeat(part, sizes + 1)
                rows = [k for k in range(parts) if (part == k).any()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([sizes[part == k] + 1 for k in rows], pa.list_(pa.int64())),
                        pa.array([_planes(symbols[of_token == k]) for k in rows], pa.binary()),
                        pa.array(rows, pa.int32()),
                    ],
                    names=["lengths", "symbols", "part"],
                )

    schema = "lengths array<long>, symbols binary, part int"
    rows = blocks.select("held_out", "sizes", "places", "classes").mapInArrow(deal, schema)
    path = work_path(blocks.sparkSession, "training")
    rows.write.partitionBy("part").option("compression", "zstd").parquet(path)
    return blocks.sparkSession.read.schema(schema).parquet(path)


def _pieces(lengths: np.ndarray, most: int = TOKENS_AT_ONCE) -> Iterator[tuple[int, int]]:
    """Runs of sequences of about ``most`` tokens together, a longer one alone."""
    ends = np.cumsum(lengths)
    low = 0
    while low < len(lengths):
        begin = ends[low] - lengths[low]
        high = max(low + 1, int(np.searchsorted(ends, begin + most, "right")))
        yield low, high
        low = high


def expected_counts(training: DataFrame, model: Model) -> np.ndarray:
    """Expected counts of the tokens of each class by state, then of moves, then of starts.

    Tasks sum over their documents, Spark over tasks; the driver gets a row for each class.
    """
    states, classes = model.classes.shape
    start, move = model.start, model.move
    by_class = np.ascontiguousarray(model.classes.T) + 1e-12
    by_class = (by_class / by_class.max(1, keepdims=True)).astype(np.float32)
    names = [f"state_{k}" for k in range(states)]

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((classes + states + 1, states))

        def add(lengths: np.ndarray, symbols: np.ndarray) -> None:
            emit = by_class[symbols].astype(np.float64)
            _, gamma, moves = posterior(emit, lengths, start, move)
            for k in range(states):
                total[:classes, k] += np.bincount(symbols, gamma[:, k], classes)
            total[classes:-1] += moves
            total[-1] += gamma[np.cumsum(lengths) - lengths].sum(0)

        waiting, size = [], 0
        for batch in batches:
            for lengths, symbols in zip(batch.column("lengths"), batch.column("symbols")):
                lengths, symbols = lengths.values.to_numpy(), _from_planes(symbols.as_py())
                begins = np.cumsum(lengths) - lengths
                for low, high in _pieces(lengths):
                    own = symbols[begins[low] : begins[low] + lengths[low:high].sum()]
                    if size and size + len(own) > TOKENS_AT_ONCE:
                        add(*(np.concatenate(c) for c in zip(*waiting)))
                        waiting, size = [], 0
                    waiting.append((lengths[low:high], own))
                    size += len(own)
        if waiting:
            add(*(np.concatenate(c) for c in zip(*waiting)))
        cell = np.flatnonzero(total.any(1))
        columns = [pa.array(total[cell, k].astype(np.float32)) for k in range(states)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(cell.astype(np.int32)), *columns], names=["cell", *names]
        )

    schema = "cell int, " + ", ".join(f"{name} float" for name in names)
    parted = training.select("lengths", "symbols").mapInArrow(expect, schema)
    sums = parted.groupBy("cell").agg(*(F.sum(name).alias(name) for name in names)).toPandas()
    total = np.zeros((classes + states + 1, states))
    total[sums["cell"]] = sums[names]
    return total


def model_of(vocab: Vocabulary, total: np.ndarray) -> Model:
    """The model of expected counts.

    Each class keeps its tokens of the whole corpus. They go to the states as its expected counts
    do, with ``PRIOR`` tokens added that are mixed as all tokens are, so a rare class leans to the
    usual mix and one that no part has shown yet has just that.
    """
    classes, states = vocab.classes, total.shape[1]
    emitted, moved, begun = total[:classes], total[classes:-1] + 1e-3, total[-1] + 1e-3
    usual = emitted.sum(0) + 1e-3
    usual = usual / usual.sum()
    mixed = (emitted + PRIOR * usual) / (emitted.sum(1, keepdims=True) + PRIOR)
    shares = (vocab.class_tokens[:, None] * mixed).T
    return Model(
        begun / begun.sum(),
        moved / moved.sum(1, keepdims=True),
        shares / np.maximum(shares.sum(1, keepdims=True), 1e-300),
    )


def train(
    blocks: DataFrame,
    vocab: Vocabulary,
    states: int = STATES,
    parts: int = PARTS,
    passes: int = PASSES,
) -> Model:
    """Incremental Baum-Welch over all documents of kept ``blocks`` that are not held out.

    A step replaces the counts of one part, so one pass makes as many steps as there are parts.
    Blocks without training documents give the first model.
    """
    model = first_model(vocab, states)
    if not vocab.tokens:
        return model
    training = _training_parts(blocks, parts)
    latest: dict[int, np.ndarray] = {}
    for step in range(passes * parts):
        part = step % parts
        latest[part] = expected_counts(training.where(F.col("part") == part), model)
        model = model_of(vocab, sum(latest.values()))
    return model


BLOCK_SCHEMA = (
    "block long, doc_ids array<long>, held_out array<boolean>, sizes array<int>,"
    " places binary, classes binary, first_rare int, words array<long>"
)


def token_blocks(docs: DataFrame, vocab: Vocabulary, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Documents in kept blocks of about ``block_bytes`` of text, a longer one alone.

    ``docs`` have ``doc_id``, ``text`` without nulls and ``held_out``.

    The distinct words of a block are numbered, the frequent words of the vocabulary first and
    then by falling use, so that most numbers are small. ``places`` has the number of each token
    and ``classes`` the class of each number, both in planes of bytes, ``words`` the hashes from number ``first_rare`` on, and ``sizes`` the words of each document. A ``block``
    is a multiple of 2 ** 24, which leaves room for a number.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 20
        for batch in batches:
            for rows in slices(batch, "text", block_bytes):
                words = words_of(rows.column("text"))
                unique, at, places, uses = np.unique(
                    words.hash, return_index=True, return_inverse=True, return_counts=True
                )
                near, frequent = vocab.find(unique)
                tails = 1 + len(vocab.frequent) + _tail_class(words)[at]
                if len(unique) >> 24:
                    raise ValueError("a text has more than 2 ** 24 different words")
                order = np.lexsort((-uses, ~frequent))
                rank = np.empty(len(order), np.uint32)
                rank[order] = np.arange(len(order))
                classes = np.where(frequent, 1 + near, tails)[order]
                first = int(np.count_nonzero(frequent))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number << 24]),
                        pa.array([rows.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                        pa.array([rows.column("held_out").to_pylist()], pa.list_(pa.bool_())),
                        pa.array([words.counts.astype(np.int32)], pa.list_(pa.int32())),
                        pa.array([_planes(rank[places])], pa.binary()),
                        pa.array([_planes(classes)], pa.binary()),
                        pa.array([first], pa.int32()),
                        pa.array([unique[order][first:].view(np.int64)], pa.list_(pa.int64())),
                    ],
                    names=[f.split()[0] for f in BLOCK_SCHEMA.split(", ")],
                )
                number += 1

    options = {"parquet.block.size": "16777216", "compression": "zstd"}
    return kept(docs.mapInArrow(blocks, BLOCK_SCHEMA), "blocks", **options)


SCORE_SCHEMA = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long,"
    " base_score double, score double"
)


def score(blocks: DataFrame, counts: DataFrame, vocab: Vocabulary, model: Model) -> DataFrame:
    """Base and model log10 probability of every text of kept ``blocks``.

    Tokens are the words and one end. An unknown word counts as the one word outside the
    vocabulary; each class leaves it the absolute discount of its words, so the model's
    probabilities over V + 1 words sum to 1 in every state. Without training data both scores
    are 0. A null text is empty and has its end only. A null ``doc_id`` and repeated rows are
    scored like others.
    """
    seen = np.maximum(vocab.class_tokens, 1e-300)
    by_class = np.ascontiguousarray(model.classes.T)
    free = vocab.discount * vocab.class_types / seen * (vocab.class_tokens > 0)
    unknown = model.classes @ free
    if not vocab.tokens:
        unknown = np.ones(len(model.start))
    whole = vocab.tokens + vocab.types + 1

    def score_block(_, block: pa.Table, rare: pa.Table) -> pa.Table:
        row = {name: block.column(name)[0] for name in block.column_names}
        # One emission row per distinct word and one for the end.
        of_class = _from_planes(row["classes"].as_py())
        words = len(of_class)
        of_class = np.append(of_class, END_CLASS)
        count = np.zeros(words + 1, np.int64)
        count[rare.column("at").to_numpy() & 0xFFFFFF] = rare.column("count").to_numpy()
        frequent = (of_class > 0) & (of_class <= len(vocab.frequent))
        count[frequent] = vocab.frequent_count[of_class[frequent] - 1]
        count[-1] = int(vocab.class_tokens[END_CLASS])
        share = np.maximum(count - vocab.discount, 0) / seen[of_class]
        emission = np.where(
            (count > 0)[:, None], by_class[of_class] * share[:, None], unknown[None, :]
        )
        emission = np.maximum(emission, 1e-300)
        top = emission.max(1)
        emission /= top[:, None]
        logs = np.log10(top)
        base = np.log10((count + 1) / whole)
        sizes = row["sizes"].values.to_numpy().astype(np.int64)
        tokens = _with_ends(_from_planes(row["places"].as_py()), sizes, words)
        lengths = sizes + 1
        ends = np.cumsum(lengths)
        score = np.zeros(len(lengths))
        for low, high in _pieces(lengths):
            own = tokens[ends[low] - lengths[low] : ends[high - 1]]
            _, norms = forward(emission[own], lengths[low:high], model.start, model.move)
            of_doc = np.repeat(np.arange(high - low), lengths[low:high])
            score[low:high] = np.bincount(of_doc, norms / np.log(10) + logs[own], high - low)
        if not vocab.tokens:
            score[:] = 0
        of_doc = np.repeat(np.arange(len(lengths)), lengths)
        known = np.bincount(of_doc, count[tokens] > 0, len(lengths))
        return pa.table(
            {
                "doc_id": row["doc_ids"].values,
                "held_out": row["held_out"].values,
                "n_tokens": pa.array(lengths),
                "n_known": pa.array(known.astype(np.int64)),
                "train_tokens": pa.array(np.full(len(lengths), vocab.tokens, np.int64)),
                "base_score": pa.array(np.bincount(of_doc, base[tokens], len(lengths))),
                "score": pa.array(score),
            }
        )

    words = blocks.select("block", "first_rare", F.posexplode("words").alias("place", "word"))
    words = words.select((F.col("block") + F.col("first_rare") + F.col("place")).alias("at"), "word")
    # The own words' counts are in the vocabulary, so no word joined here is a hot key.
    wanted = words.join(counts.select("word", "count"), "word").select("at", "count")
    # Parts for a few blocks each, whatever their number.
    usual = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(usual, 2 * blocks.count())
    wanted = wanted.withColumn("of", F.shiftright("at", 24)).repartition(parts, "of")
    whole_blocks = blocks.drop("words", "first_rare").withColumn("number", F.shiftright("block", 24))
    grouped = whole_blocks.repartition(parts, "number").groupBy("number")
    return grouped.cogroup(wanted.groupBy("of")).applyInArrow(score_block, SCORE_SCHEMA)

"""Language identification by compression.

A text is compressed with one zstandard raw-content dictionary per language, in blocks so that
the dictionary stays in reach in long texts; the language of the smallest total is predicted.
A narrow margin to the second rejects the prediction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from winnow.llm.shared import whole_text
from winnow.llm.words import text_offsets

UNDETERMINED = "und"
# Bound of the training sample: so many documents of each language, so many bytes of each.
SAMPLE_DOCUMENTS = 96
SAMPLE_BYTES = 2048
BLOCK_BYTES = 1024
LEVEL = 3
# A prediction with a smaller share of the evidence is made anew with a slower, closer coder.
CLOSE_SCORE = 0.99
CLOSE_LEVEL = 19
# Rejected are margins of less than this share of the compressed bytes.
MIN_MARGIN = 0.002


def _letters():
    """Lower-case letters with single blanks for all else, so case and symbols say nothing.

    Empty without a letter, whatever marks there are.
    """
    kept = F.trim(F.regexp_replace(F.lower("text"), r"[^\p{L}\p{M}]+", " "))
    return F.when(F.regexp("text", F.lit(r"\p{L}")), kept).otherwise("")


def learn_dictionaries(
    docs: DataFrame,
    sample_documents: int = SAMPLE_DOCUMENTS,
    sample_bytes: int = SAMPLE_BYTES,
) -> dict[str, bytes]:
    """Raw dictionary content of each language in ``lang``, null and ``und`` apart.

    The documents of a language with the smallest hashes of their keys are taken, equal texts
    once. The result has ``sample_documents * sample_bytes`` bytes per language at most; no
    documents give no languages.
    """
    labelled = docs.where(F.col("lang").isNotNull() & (F.col("lang") != UNDETERMINED))
    hashed = labelled.select("lang", "doc_id", F.xxhash64("doc_id").alias("order"))
    drawn = Window.partitionBy("lang").orderBy("order", "doc_id")
    chosen = (
        hashed.withColumn("place", F.row_number().over(drawn))
        .where(F.col("place") <= sample_documents)
        .select("lang", "doc_id", "order")
    )
    # sample_documents rows per language at most.
    texts = labelled.select("doc_id", "lang", _letters().alias("letters")).join(
        F.broadcast(chosen), ["lang", "doc_id"]
    )
    sample: dict[str, dict[str, None]] = {}
    bounded = F.substring("letters", 1, sample_bytes).alias("letters")
    for row in texts.select("lang", "order", "doc_id", bounded).orderBy("order", "doc_id").toLocalIterator():
        if row["letters"] and len(sample.setdefault(row["lang"], {})) < sample_documents:
            sample[row["lang"]][row["letters"]] = None
    return {
        lang: " ".join(texts).encode()[: sample_documents * sample_bytes]
        for lang, texts in sorted(_agreeing({k: list(v) for k, v in sample.items()}).items())
        if texts
    }


def _agreeing(sample: dict[str, list[str]]) -> dict[str, list[str]]:
    """The sample without texts that the other half of it puts down to another language."""
    halves = [{k: " ".join(v[i::2]).encode() for k, v in sample.items()} for i in (0, 1)]
    coders = [Coders(half, CLOSE_LEVEL) for half in halves]
    out = {}
    for lang, texts in sample.items():
        own = sorted(sample).index(lang)
        keep = []
        for i, text in enumerate(texts):
            sizes = coders[1 - i % 2].sizes(text.encode(), BLOCK_BYTES)
            if sizes[own] <= sizes.min() + 1:
                keep.append(text)
        out[lang] = keep or texts
    return out


class Coders:
    """One compressor per language, in order of the names."""

    def __init__(self, dictionaries: dict[str, bytes], level: int):
        import zstandard

        options = {"format": zstandard.FORMAT_ZSTD1_MAGICLESS, "write_content_size": 0}
        if level >= CLOSE_LEVEL:
            options["min_match"] = 3
        how = zstandard.ZstdCompressionParameters.from_level(level, **options)
        self.coders = []
        for _, content in sorted(dictionaries.items()):
            known = zstandard.ZstdCompressionDict(
                content, dict_type=zstandard.DICT_TYPE_RAWCONTENT
            )
            known.precompute_compress(compression_params=how)
            self.coders.append(zstandard.ZstdCompressor(dict_data=known, compression_params=how))

    def sizes(self, data, block_bytes: int) -> np.ndarray:
        blocks = [data[a : a + block_bytes] for a in range(0, len(data), block_bytes)]
        return np.array([sum(len(c.compress(b)) for b in blocks) for c in self.coders], np.int64)


def _judge(sizes: np.ndarray, min_margin: float) -> tuple[int, float, float, bool]:
    """Place of the smallest size, its share of the evidence, its margin, and rejection."""
    best = int(sizes.argmin())
    others = np.delete(sizes, best)
    saved = int(others.min() - sizes[best]) if len(others) else int(sizes[best])
    # A saved byte is eight bits of evidence, but the words of a text depend on each other, so
    # it counts as one.
    weight = np.exp2(-np.minimum(sizes - sizes[best], 60).astype(float))
    margin = saved / int(sizes[best])
    return best, float(1 / weight.sum()), margin, margin < min_margin


class Identifier:
    """Judges texts of letters by the dictionaries of all languages."""

    def __init__(self, dictionaries: dict[str, bytes], block_bytes: int, level: int, min_margin: float):
        self.languages = sorted(dictionaries)
        self.block_bytes, self.min_margin = block_bytes, min_margin
        self.fast, self.close = Coders(dictionaries, level), Coders(dictionaries, CLOSE_LEVEL)

    def judged(self, letters: pa.Array) -> list[tuple[str, float, float, bool]]:
        ends = text_offsets(letters).tolist()
        data = memoryview(letters.buffers()[2] or b"")
        out: list[tuple[str, float, float, bool]] = []
        for low, high in zip(ends[:-1], ends[1:]):
            if low == high or not self.languages:
                out.append((UNDETERMINED, 0.0, 0.0, True))
                continue
            text = data[low:high]
            found = _judge(self.fast.sizes(text, self.block_bytes), self.min_margin)
            if found[1] < CLOSE_SCORE:
                found = _judge(self.close.sizes(text, self.block_bytes), self.min_margin)
            out.append((self.languages[found[0]], *found[1:]))
        return out


def identify(
    docs: DataFrame,
    dictionaries: dict[str, bytes],
    block_bytes: int = BLOCK_BYTES,
    level: int = LEVEL,
    min_margin: float = MIN_MARGIN,
) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score``, ``margin`` and ``rejected`` of every document.

    ``score`` is the share of the predicted language when each saved byte counts as evidence;
    ``margin`` the bytes saved against the second language as a share of the smallest size.
    A text that is null or has no letter is ``und`` with score 0, and rejected. Equal sizes go
    to the language that comes first by name, and are rejected. Without dictionaries every
    text is ``und``. Repeated rows and null keys are judged like others.
    """

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Identifier(dictionaries, block_bytes, level, min_margin)
        for batch in batches:
            found = list(zip(*own.judged(batch.column("letters")))) or [()] * 4
            kinds = (pa.string(), pa.float64(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, found, kinds)],
                names=["doc_id", "lang_pred", "score", "margin", "rejected"],
            )

    letters = whole_text(docs).select("doc_id", _letters().alias("letters"))
    return letters.mapInArrow(
        classify, "doc_id long, lang_pred string, score double, margin double, rejected boolean"
    )


def with_language(
    docs: DataFrame,
    dictionaries: dict[str, bytes],
    block_bytes: int = BLOCK_BYTES,
    level: int = LEVEL,
    min_margin: float = MIN_MARGIN,
) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose language is not rejected."""

    @F.arrow_udf("boolean")
    def known(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Identifier(dictionaries, block_bytes, level, min_margin)
        for letters in parts:
            yield pa.array([not rejected for *_, rejected in own.judged(letters)], pa.bool_())

    # Only the letters go to Python and a flag comes back; the rows stay where they are.
    return docs.where(known(F.coalesce(_letters(), F.lit(""))))

"""Words of many texts at once, as arrays over their UTF-8 bytes.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage
return, with A-Z in lower case if asked. Everything works on whole arrays, so a batch costs a
few passes over its bytes and no Python step per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2_000_000
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# Also every ASCII character that is no letter or digit.
_SYMBOL = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Odd multiplier of the word hash; any large odd number serves.
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser with the constants of splitmix64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def slices(
    batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES, rows: int | None = None
) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in parts of about so many bytes of text, and of so many ``rows`` at
    most; a longer text stands alone."""
    ends = text_offsets(batch.column(column))
    low = 0
    while low < batch.num_rows:
        high = int(np.searchsorted(ends, ends[low] + most, "right")) - 1
        high = min(max(high, low + 1), low + (rows or batch.num_rows), batch.num_rows)
        yield batch.slice(low, high - low)
        low = high


def text_offsets(texts: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    every = np.frombuffer(texts.buffers()[1], kind)
    return every[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)


@dataclass
class Words:
    """``doc`` is the row of each word, ``start`` and ``size`` its bytes, ``hash`` 64 bits.

    ``counts`` has the words of each row; ``data`` the bytes of the batch and ``first`` the
    byte at which each row begins.
    """

    data: np.ndarray
    first: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    size: np.ndarray
    hash: np.ndarray
    counts: np.ndarray


def words_of(texts: pa.Array, lower: bool = True, symbols_apart: bool = False) -> Words:
    """Words of texts without nulls; with ``symbols_apart`` ASCII symbols end a word too."""
    ends = text_offsets(texts)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[ends[0] : ends[-1]] if raw else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    if lower:
        data = _LOWER[data]
        if symbols_apart:
            # Capitals from U+00C0 to U+00DE, whose bytes are C3 80 to C3 9E, as well.
            wide = np.flatnonzero(data[:-1] == 0xC3) + 1
            wide = wide[(data[wide] >= 0x80) & (data[wide] <= 0x9E) & (data[wide] != 0x97)]
            data[wide] += 0x20
    space = (_SYMBOL if symbols_apart else _SPACE)[data]
    n = len(data)
    # breaks[i]: byte i is a space or the first of its row, so no word goes on from i - 1 to i.
    after_space = np.ones(n + 1, bool)
    after_space[1:] = space
    after_space[ends] = True
    before_space = np.ones(n + 1, bool)
    before_space[:n] = space
    before_space[ends] = True
    inside = ~space
    start = np.flatnonzero(inside & after_space[:n])
    size = np.flatnonzero(inside & before_space[1:]) + 1 - start
    doc = np.searchsorted(ends, start, "right") - 1
    longest = int(size.max(initial=0))
    powers = np.cumprod(np.full(longest, _BASE, np.uint64), dtype=np.uint64)
    value = (data[inside].astype(np.uint64) + np.uint64(1))
    place = np.arange(len(value), dtype=np.int64) - np.repeat(np.cumsum(size) - size, size)
    value *= powers[place]
    if len(start):
        summed = np.add.reduceat(value, np.cumsum(size) - size)
    else:
        summed = np.zeros(0, np.uint64)
    hashed = mix(summed ^ size.astype(np.uint64))
    counts = np.bincount(doc, minlength=len(texts))
    return Words(data, ends[:-1], doc, start, size, hashed, counts)


def tail(words: Words, back: int) -> np.ndarray:
    """The byte so far from each word's end (1: the last), 0 before its beginning."""
    at = words.start + words.size - back
    return np.where(words.size >= back, words.data[np.maximum(at, 0)], 0).astype(np.uint64)


def prefix(words: Words, size: int) -> np.ndarray:
    """Hash of the first ``size`` bytes of each word, of all bytes of a shorter one."""
    out = np.zeros(len(words.start), np.uint64)
    last = max(len(words.data) - 1, 0)
    for i in range(size):
        byte = words.data[np.minimum(words.start + i, last)].astype(np.uint64) + np.uint64(1)
        out = np.where(words.size > i, (out + byte) * _BASE, out)
    return mix(out)

"""Token ids of whole texts, with every word encoded once by a Python worker."""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from winnow.llm.words import mix, words_of

# Words remembered by one Python worker, about 24 bytes each.
WORDS_KEPT = 2_000_000
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
# What stands before a word: nothing, a space, or a line feed.
_LEADS = ("", " ", "\n")
# UTF-8 of white space beyond ASCII, by length; control characters 1C-1F count as well.
_WIDE_2 = (b"\xc2\x85", b"\xc2\xa0")
_WIDE_3 = (
    *(bytes((0xE2, 0x80, last)) for last in (*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF)),
    b"\xe1\x9a\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80",
)

_LOADED: dict[str, Encoder] = {}


class Encoder:
    """A tokenizer file, with the ids of words remembered by 64-bit hashes.

    Pre-tokenizers of the byte-level kind begin a new word at a single space and at a single
    line feed between characters that are no white space, so there the ids of a text are those
    of its words in a row. A text with other white space is encoded as it stands.
    """

    def __init__(self, path: str, words_kept: int = WORDS_KEPT):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # A text that spells a special token is encoded as it stands.
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words_kept = words_kept
        self._forget()

    def _forget(self) -> None:
        self.ids = np.zeros(1 << 16, np.int32)
        self.used = 0
        nothing = np.zeros(0, np.int64)
        # Sorted hashes with place and length of their ids: the bulk, and what came lately.
        self.bulk = (np.zeros(0, np.uint64), nothing, nothing)
        self.late = self.bulk

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Places and lengths of the ids of each text, which are added to the pool."""
        coded: list[list[int]] = []
        for low in range(0, len(texts), 5000):
            part = self.tokenizer.encode_batch_fast(texts[low : low + 5000], add_special_tokens=False)
            coded += [c.ids for c in part]
        size = np.fromiter(map(len, coded), np.int64, len(coded))
        begin, count = self.used, int(size.sum())
        if begin + count > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), count), np.int32)])
        self.ids[begin : begin + count] = np.fromiter(chain.from_iterable(coded), np.int32, count)
        self.used += count
        return begin + np.cumsum(size) - size, size

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at, size = np.full(len(hashes), -1), np.zeros(len(hashes), np.int64)
        for known, place, length in (self.bulk, self.late):
            if len(known):
                i = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                hit = known[i] == hashes
                at[hit], size[hit] = place[i[hit]], length[i[hit]]
        return at, size

    def _remember(self, hashes: np.ndarray, at: np.ndarray, size: np.ndarray) -> None:
        def merged(a, b):
            order = np.argsort(np.concatenate([a[0], b[0]]), kind="stable")
            return tuple(np.concatenate(c)[order] for c in zip(a, b))

        self.late = merged(self.late, (hashes, at, size))
        if len(self.late[0]) > 100_000:
            self.bulk = merged(self.bulk, self.late)
            self.late = tuple(c[:0] for c in self.late)

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each with ``end_id`` after it, and their numbers."""
        if len(self.bulk[0]) > self.words_kept:
            self._forget()
        words = words_of(texts, lower=False)
        plain = _plain(words, len(texts))
        for token in self.special:
            plain &= ~pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        use = plain[words.doc]
        doc, start, length = words.doc[use], words.start[use], words.size[use]
        lead = np.where(words.data[start - 1] == 0x0A, 2, 1)
        lead[start == words.first[doc]] = 0
        key = mix(words.hash[use] + _GOLDEN * (lead + 1).astype(np.uint64))
        unique, sample, back = np.unique(key, return_index=True, return_inverse=True)
        at, size = self._find(unique)
        new = np.flatnonzero(at < 0)
        data = words.data.tobytes()
        of = sample[new]
        spelled = [
            _LEADS[k] + data[s : s + n].decode()
            for k, s, n in zip(lead[of].tolist(), start[of].tolist(), length[of].tolist())
        ]
        at[new], size[new] = self._encode(spelled)
        self._remember(unique[new], at[new], size[new])
        held = self.used
        # Texts that stand apart are units of their own, and so is the end of every text.
        apart = np.flatnonzero(~plain)
        apart_at, apart_size = self._encode([texts[i].as_py() for i in apart.tolist()])
        end_at, end_size = self._store(end_id)
        every = np.arange(len(texts))
        unit_doc = np.concatenate([doc, apart, every])
        unit_at = np.concatenate([at[back], apart_at, np.full(len(every), end_at)])
        unit_size = np.concatenate([size[back], apart_size, np.full(len(every), end_size)])
        order = np.argsort(unit_doc, kind="stable")
        unit_at, unit_size = unit_at[order], unit_size[order]
        first = np.cumsum(unit_size) - unit_size
        place = np.arange(int(unit_size.sum())) - np.repeat(first - unit_at, unit_size)
        ids = self.ids[place]
        self.used = held
        return ids, np.bincount(unit_doc[order], unit_size, len(texts)).astype(np.int64)

    def _store(self, token: int) -> tuple[int, int]:
        if self.used == len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(1024, np.int32)])
        self.ids[self.used] = token
        self.used += 1
        return self.used - 1, 1


def _plain(words, texts: int) -> np.ndarray:
    """Which texts have words apart by single spaces and line feeds only."""
    data = words.data
    ends = np.append(words.first, len(data))
    length = np.diff(ends)
    covered = np.bincount(words.doc, words.size, texts)
    single = np.concatenate([[0], np.cumsum((data == 0x20) | (data == 0x0A))])
    separators = np.diff(single[ends])
    plain = (covered + separators == length) & (separators == words.counts - 1)
    odd = [np.flatnonzero((data >= 0x1C) & (data <= 0x1F))]
    if int(data.max(initial=0)) > 0x7F:
        raw = data.tobytes()
        for spelled in (*_WIDE_2, *_WIDE_3):
            at = raw.find(spelled)
            while at >= 0:
                # One hit settles a text; the search goes on behind it.
                of = int(np.searchsorted(ends, at, "right")) - 1
                odd.append(np.array([at]))
                at = raw.find(spelled, int(ends[of + 1]))
    plain[np.searchsorted(ends, np.concatenate(odd), "right") - 1] = False
    return plain


def encoder(path: str) -> Encoder:
    """The encoder of a file, loaded once by each Python worker."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]

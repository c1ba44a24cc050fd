"""N-best segmentation of whole texts into the pieces of a SentencePiece model, and decoding.

A forward Viterbi pass over the lattice of pieces scores every place. These scores are the exact
heuristic of an A-star search from the end, which completes the N best segmentations in order.

No piece of such a model goes on over a space or holds a line feed, so the lattice of a text is
a chain of lattices of words: each distinct word is searched once, and the best combinations of
the words' lists are found by a best-first search over the chain.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from winnow.llm.shared import whole_text
from winnow.llm.words import slices

BEST = 4
# Below the lowest score of a piece; for a character that only byte pieces can spell.
UNKNOWN_PENALTY = 10.0
# Words whose best way, and whose lists, one Python worker keeps, about 130 MB.
WORDS_KEPT = 400_000
LISTS_KEPT = 20_000
# Ways of longer units are not kept, so that the bounds above are bounds of memory.
LONGEST_KEPT = 64
# Instead of a piece, for a character that only byte pieces can spell.
SPELLED_BY_BYTES = -1
SLICE_BYTES = 2_000_000
# Longer words, and words with characters that are no pieces, are searched one by one.
LONGEST = 24
_BASE = np.uint64(0x9E3779B97F4A7C15)
FIRST_BITS = 22
_REST = np.uint64(64 - FIRST_BITS)
SPACE = "▁"
_UNIT = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")

_LOADED: dict[tuple[str, int], Segmenter] = {}


class Segmenter:
    """Pieces and scores of a model file, with the N-best lists of words remembered."""

    def __init__(self, path: str, best: int = BEST):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())
        self.best = best
        self.scores: dict[str, tuple[int, float]] = {}
        self.bytes_of: dict[int, int] = {}
        self.spelled: list[bytes] = []
        for i in every:
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes_of[int(piece[3:5], 16)] = i
                self.spelled.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.spelled.append(b"")
            else:
                self.scores[piece] = (i, model.get_score(i))
                self.spelled.append(piece.replace(SPACE, " ").encode())
        # The bytes of all pieces in a row, so that a text is spelled by one gather.
        self.spelled_bytes = np.frombuffer(b"".join(self.spelled), np.uint8)
        self.spelled_size = np.array([len(b) for b in self.spelled], np.int64)
        self.spelled_begin = np.cumsum(self.spelled_size) - self.spelled_size
        # Runs of spaces carry a score that stands for "never unless alone".
        usual = [s for _, s in self.scores.values() if s > -1e8]
        self.unknown = min(usual, default=0.0) - UNKNOWN_PENALTY
        # Pieces, and None for what some piece goes on from.
        self.begun: dict[str, tuple[int, float] | None] = {
            piece[:end]: None for piece in self.scores for end in range(1, len(piece))
        }
        self.begun.update(self.scores)
        # The same as sorted hashes for whole arrays of words, with the piece or -1.
        self.longest = max(map(len, self.begun), default=1)
        self.letters = {piece for piece in self.scores if len(piece) == 1}
        mask, base = 2**64 - 1, int(_BASE)
        hashed: dict[int, int] = {}
        for part, piece in self.begun.items():
            h = 0
            for c in part:
                h = (h + ord(c)) * base & mask
            hashed[h] = -1 if piece is None else piece[0]
        self.hashes = np.array(sorted(hashed), np.uint64)
        self.first_bits = np.zeros(1 << FIRST_BITS, bool)
        self.first_bits[self.hashes >> _REST] = True
        self.hashed_piece = np.array([hashed[h] for h in sorted(hashed)], np.int64)
        self.piece_score = np.zeros(len(self.spelled))
        for i, score in self.scores.values():
            self.piece_score[i] = score
        self._forget()
        self.lists: dict[str, list[tuple[float, bytes]]] = {}

    def forward(self, text: str) -> array:
        """Viterbi scores: the best score of any way from the beginning to each place."""
        n, begun = len(text), self.begun
        top = array("d", [-np.inf]) * (n + 1)
        top[0] = 0.0
        for place in range(n):
            here = top[place]
            alone = begun.get(text[place])
            score = self.unknown if alone is None else alone[1]
            if here + score > top[place + 1]:
                top[place + 1] = here + score
            for end in range(place + 2, n + 1):
                part = text[place:end]
                if part not in begun:
                    break
                piece = begun[part]
                if piece is not None and here + piece[1] > top[end]:
                    top[end] = here + piece[1]
        return top

    def nbest(self, text: str, most: int) -> list[tuple[float, bytes]]:
        """The best ``most`` segmentations: score and ids as little-endian 32-bit integers.

        A-star search from the end to the beginning. The forward scores are the exact rest of
        every open way, so ways are completed best first and only places of results are opened.
        A way is an entry with its piece and the entry behind it; no place is opened more than
        ``most`` times, as no other way can be a result. Among equal totals the way nearest to
        the beginning goes first, so ties are completed one after the other instead of side by
        side. Memory grows with the length of the text only.
        """
        n, scores, longest = len(text), self.scores, self.longest
        top = self.forward(text)
        places, behind, pieces, after = array("q", [n]), array("q", [-1]), array("i", [0]), array("d", [0.0])
        opened: dict[int, int] = {}
        queue, found = [(-top[n], n, 0)], []
        while queue and len(found) < most:
            total, place, entry = heappop(queue)
            if not place:
                found.append((-total, self._ids(text, entry, places, behind, pieces)))
                continue
            times = opened.get(place, 0)
            if times == most:
                continue
            opened[place] = times + 1
            rest = after[entry]
            for start in range(place - 1, max(place - longest, 0) - 1, -1):
                piece = scores.get(text[start:place])
                if piece is None:
                    if start + 1 < place:
                        continue
                    piece = (SPELLED_BY_BYTES, self.unknown)
                score = rest + piece[1]
                heappush(queue, (-(top[start] + score), start, len(places)))
                places.append(start)
                behind.append(entry)
                pieces.append(piece[0])
                after.append(score)
        return found

    def _ids(self, text: str, entry: int, places: array, behind: array, pieces: array) -> bytes:
        """The ids of a way from its entry at the beginning to the end of a text."""
        ids = array("i")
        while behind[entry] >= 0:
            if pieces[entry] == SPELLED_BY_BYTES:
                ids.extend([self.bytes_of.get(b, 0) for b in text[places[entry]].encode()])
            else:
                ids.append(pieces[entry])
            entry = behind[entry]
        return ids.tobytes()

    def first(self, text: str) -> tuple[float, bytes, float]:
        """The best segmentation of a word, its score and what the second best loses."""
        ways = self.nbest(text, 2)
        return *ways[0], ways[0][0] - ways[1][0] if len(ways) > 1 else np.inf

    def first_of_many(self, words: list[str]) -> list[tuple[float, bytes, float]]:
        """What ``first`` gives for each word; short words of known characters all at once.

        Words are rows of characters. Pieces are looked up by rolling hashes of growing length
        from every place, then the Viterbi scores advance place by place over all words.
        """
        fits = [0 < len(w) <= LONGEST and self.letters.issuperset(w) for w in words]
        rows = [w for w, fit in zip(words, fits) if fit]
        found = iter(self._first_of_rows(rows) if rows else ())
        return [next(found) if fit else self.first(w) for w, fit in zip(words, fits)]

    def _pieces_in(self, text: np.ndarray, length: np.ndarray):
        """Row, start, end and piece of everything in the rows that is a piece."""
        row, start = np.nonzero(text)
        hashed = np.zeros(len(row), np.uint64)
        found = []
        for size in range(1, self.longest + 1):
            inside = start + size <= length[row]
            row, start, hashed = row[inside], start[inside], hashed[inside]
            hashed = (hashed + text[row, start + size - 1]) * _BASE
            # Most of what begins no piece is seen by the first bits of its hash.
            maybe = self.first_bits[hashed >> _REST]
            row, start, hashed = row[maybe], start[maybe], hashed[maybe]
            at = np.minimum(np.searchsorted(self.hashes, hashed), len(self.hashes) - 1)
            begun = self.hashes[at] == hashed
            row, start, hashed, at = row[begun], start[begun], hashed[begun], at[begun]
            piece = self.hashed_piece[at]
            whole = piece >= 0
            found.append((row[whole], start[whole], start[whole] + size, piece[whole]))
            if not len(row):
                break
        return tuple(np.concatenate(c) for c in zip(*found))

    def _first_of_rows(self, words: list[str]) -> list[tuple[float, bytes, float]]:
        text = np.array(words, f"U{LONGEST}").view(np.uint32).reshape(len(words), LONGEST)
        text = text.astype(np.uint64)
        length = np.array([len(w) for w in words])
        row, start, end, piece = self._pieces_in(text, length)
        score = self.piece_score[piece]
        every = np.arange(len(words))
        # Cells of a row of places for each word, all rows in a row.
        origin = every * (LONGEST + 1)
        low, high, goal = origin[row] + start, origin[row] + end, origin + length
        top = np.full(len(words) * (LONGEST + 1), -np.inf)
        after = top.copy()
        top[origin], after[goal] = 0.0, 0.0
        # Places fit in a byte, for which the sort is linear.
        by_end, by_start = (np.argsort(a.astype(np.uint8), kind="stable") for a in (end, start))
        for edges in np.split(by_end, np.cumsum(np.bincount(end))[:-1])[1:]:
            np.maximum.at(top, high[edges], top[low[edges]] + score[edges])
        for edges in reversed(np.split(by_start, np.cumsum(np.bincount(start))[:-1])):
            np.maximum.at(after, low[edges], after[high[edges]] + score[edges])
        best = top[goal]
        came = np.full(top.shape, -1)
        reached = top[low] + score
        reaches = np.flatnonzero(reached == top[high])
        came[high[reaches]] = reaches
        used = np.zeros(len(row), bool)
        place, live, steps = goal, every, []
        while len(live):
            edge = came[place]
            used[edge] = True
            steps.append((live, piece[edge]))
            onward = start[edge] > 0
            place, live = low[edge][onward], live[onward]
        loss = np.full(len(words), np.inf)
        through = best[row] - reached - after[high]
        np.minimum.at(loss, row[~used], through[~used])
        count = np.bincount(row[used], minlength=len(words))
        last = np.cumsum(count)
        flat = np.zeros(int(last[-1]), "<i4")
        for back, (of, ids) in enumerate(steps, 1):
            flat[last[of] - back] = ids
        raw, ends = flat.tobytes(), (4 * last).tolist()
        spelled = [raw[a:b] for a, b in zip([0, *ends[:-1]], ends)]
        return list(zip(best.tolist(), spelled, np.maximum(loss, 0).tolist()))

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.gained, self.lost = np.zeros(0), np.zeros(0)
        self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, "<i4")

    def _learn(self, units: list[str]) -> dict[str, int]:
        """Numbers of new units, whose best ways are added to the arrays."""
        ways = self.first_of_many(units)
        first = len(self.gained)
        ids = np.frombuffer(b"".join([way[1] for way in ways]), "<i4")
        size = np.array([len(way[1]) // 4 for way in ways], np.int64)
        self.begin = np.concatenate([self.begin, len(self.pool) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.gained = np.concatenate([self.gained, [way[0] for way in ways]])
        self.lost = np.concatenate([self.lost, [way[2] for way in ways]])
        self.pool = np.concatenate([self.pool, ids])
        return dict(zip(units, range(first, first + len(units))))

    def texts(self, texts: list[str]) -> Iterator[list[tuple[float, bytes]]]:
        """The best segmentations of each text as pairs of score and ids in bytes.

        A text gets a space in front. An empty text has one empty segmentation.
        """
        if len(self.known) > WORDS_KEPT:
            self._forget()
        cut = [_UNIT.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        new = set(chain.from_iterable(cut)).difference(self.known)
        self.known |= self._learn([u for u in new if len(u) <= LONGEST_KEPT])
        # Longer units come last and are dropped with the texts that hold them.
        held, pooled = len(self.gained), len(self.pool)
        long = self._learn([u for u in new if len(u) > LONGEST_KEPT])
        for units in cut:
            yield self._text(units, long) if units else [(0.0, b"")]
        self.gained, self.lost = self.gained[:held], self.lost[:held]
        self.begin, self.size, self.pool = self.begin[:held], self.size[:held], self.pool[:pooled]

    def _text(self, units: list[str], long: dict[str, int]) -> list[tuple[float, bytes]]:
        known = self.known
        if long:
            known = {u: long[u] if u in long else known[u] for u in units}
        of = np.fromiter(map(known.__getitem__, units), np.int64, len(units))
        size = self.size[of]
        ends = np.cumsum(size)
        ids = self.pool[np.arange(ends[-1]) + np.repeat(self.begin[of] - ends + size, size)]
        total = float(self.gained[of].sum())
        if self.best == 1:
            return [(total, ids.tobytes())]
        # Only the units with the smallest losses can differ in the first ``best`` results.
        lost = self.lost[of]
        most = min(self.best - 1, len(units))
        least = np.partition(lost, most - 1)[most - 1]
        at = np.flatnonzero(lost <= least)
        at = at[np.argsort(lost[at], kind="stable")][:most]
        changed = [i for i in at.tolist() if lost[i] < np.inf]
        ranges = {i: (int(ends[i] - size[i]), int(ends[i])) for i in changed}
        choices = [self._list(units[i], ids[slice(*ranges[i])].tobytes()) for i in changed]
        in_order = sorted(range(len(changed)), key=changed.__getitem__)
        start = (0,) * len(choices)
        queue, seen, out = [(0.0, start)], {start}, []
        while queue and len(out) < self.best:
            loss, picks = heappop(queue)
            parts, low = [], 0
            for k in in_order:
                first, last = ranges[changed[k]]
                parts += [ids[low:first].tobytes(), choices[k][picks[k]][1]]
                low = last
            out.append((total - loss, b"".join([*parts, ids[low:].tobytes()])))
            for k, pick in enumerate(picks):
                if pick + 1 < len(choices[k]):
                    further = (*picks[:k], pick + 1, *picks[k + 1 :])
                    if further not in seen:
                        seen.add(further)
                        more = choices[k][pick][0] - choices[k][pick + 1][0]
                        heappush(queue, (loss + more, further))
        return out

    def _list(self, unit: str, first: bytes) -> list[tuple[float, bytes]]:
        """N-best list of a word, the way that stands in the best segmentation first."""
        found = self.lists.get(unit)
        if found is None:
            found = sorted(self.nbest(unit, self.best), key=lambda way: (-way[0], way[1] != first))
            if len(self.lists) < LISTS_KEPT and len(unit) <= LONGEST_KEPT:
                self.lists[unit] = found
        return found

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        return self._spelled(np.frombuffer(ids, "<i4")).decode(errors="replace").removeprefix(" ")

    def _spelled(self, ids: np.ndarray) -> bytes:
        size = self.spelled_size[ids]
        ends = np.cumsum(size)
        if not len(ids):
            return b""
        return self.spelled_bytes[np.arange(ends[-1]) + np.repeat(self.spelled_begin[ids] - ends + size, size)].tobytes()

    def round_trip(self, text: str, ways: list[tuple[float, bytes]]) -> bool:
        """Whether all ways decode to the text. Of the ways after the first, what they share
        with it from the beginning and from the end is decoded once."""
        if self.decode(ways[0][1]) != text:
            return False
        first = np.frombuffer(ways[0][1], "<i4")
        for _, coded in ways[1:]:
            other = np.frombuffer(coded, "<i4")
            size = min(len(first), len(other))
            apart = np.flatnonzero(first[:size] != other[:size])
            low = int(apart[0]) if len(apart) else size
            size -= low
            apart = np.flatnonzero(first[len(first) - size :] != other[len(other) - size :])
            back = size - 1 - int(apart[-1]) if len(apart) else size
            if self._spelled(first[low : len(first) - back]) != self._spelled(other[low : len(other) - back]):
                return False
        return True


def segmenter(path: str, best: int) -> Segmenter:
    """The segmenter of a file, loaded once by each Python worker."""
    if (path, best) not in _LOADED:
        _LOADED[path, best] = Segmenter(path, best)
    return _LOADED[path, best]


SEGMENTED = "doc_id long, rank int, score double, ids array<int>"


def segmentations(docs: DataFrame, model_path: str, best: int = BEST) -> DataFrame:
    """``doc_id``, ``rank`` from 1, ``score`` and ``ids`` of the best segmentations of each text.

    A text with fewer segmentations has fewer rows. Null and empty texts have one without ids.
    Segmentations of equal scores come in an order that depends on the text alone.
    """

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = segmenter(model_path, best)
        for batch in batches:
            for rows in slices(batch, "text", SLICE_BYTES // best):
                keys, ranks, scores, ids = [], [], [], []
                found = own.texts(rows.column("text").to_pylist())
                for key, ways in zip(rows.column("doc_id").to_pylist(), found):
                    for rank, (score, coded) in enumerate(ways, 1):
                        keys.append(key)
                        ranks.append(rank)
                        scores.append(score)
                        ids.append(np.frombuffer(coded, "<i4"))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.int64()),
                        pa.array(ranks, pa.int32()),
                        pa.array(scores, pa.float64()),
                        pa.array(ids, pa.list_(pa.int32())),
                    ],
                    names=["doc_id", "rank", "score", "ids"],
                )

    return whole_text(docs).mapInArrow(segment, SEGMENTED)


def decoded(segmented: DataFrame, model_path: str) -> DataFrame:
    """``doc_id``, ``rank`` and the ``text`` that the ids spell."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = segmenter(model_path, BEST)
        for batch in batches:
            lists = batch.column("ids")
            texts = [own.decode(v.values.to_numpy().astype("<i4").tobytes()) for v in lists]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("rank"), pa.array(texts, pa.string())],
                names=["doc_id", "rank", "text"],
            )

    return segmented.select("doc_id", "rank", "ids").mapInArrow(
        decode, "doc_id long, rank int, text string"
    )


DIGEST = (
    "doc_id long, n_pieces array<int>, scores array<double>, ids_crc32 array<long>,"
    " round_trip boolean"
)


def digests(docs: DataFrame, model_path: str, best: int = BEST) -> DataFrame:
    """One row per document: number of pieces, score and crc32 of each of the best
    segmentations, and whether all of them decode to the text.

    The same search as ``segmentations`` without moving the ids. A text that holds the space
    mark of the model decodes to a space instead and has no round trip.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = segmenter(model_path, best)
        for batch in batches:
            for rows in slices(batch, "text", SLICE_BYTES):
                sizes, scores, sums, same = [], [], [], []
                texts = rows.column("text").to_pylist()
                for text, ways in zip(texts, own.texts(texts)):
                    sizes.append([len(ids) // 4 for _, ids in ways])
                    scores.append([score for score, _ in ways])
                    sums.append([zlib.crc32(ids) for _, ids in ways])
                    same.append(own.round_trip(text, ways))
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"),
                        pa.array(sizes, pa.list_(pa.int32())),
                        pa.array(scores, pa.list_(pa.float64())),
                        pa.array(sums, pa.list_(pa.int64())),
                        pa.array(same, pa.bool_()),
                    ],
                    names=["doc_id", "n_pieces", "scores", "ids_crc32", "round_trip"],
                )

    return whole_text(docs).mapInArrow(digest, DIGEST)

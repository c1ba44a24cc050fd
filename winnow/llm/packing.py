"""Best-fit packing of token pieces with certified bin counts.

Pieces are dealt to groups by their number and each group is packed by best-fit decreasing. Lower
bounds from dual feasible functions certify a group whose bin count they reach. Full bins are
closed; the pieces of all other bins are exchanged: dealt anew into fewer groups and packed again.
That ends when the lower bound of all exchanged pieces certifies their bins, when one group is
left, or when a round of the largest groups saves no bin.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm.encoder import encoder
from winnow.llm.shared import kept, whole_text
from winnow.llm.words import slices

CAPACITY = 2048
# Text that a task encodes at once.
SLICE_BYTES = 2_000_000
# Pieces of a group on average, twice as many after each exchange up to the largest group, which
# takes about 20 MB of one task.
GROUP_PIECES = 8192
LARGEST_GROUP = 16 * GROUP_PIECES

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED_SCHEMA = PIECE_SCHEMA + ", sequence_id long, offset long, filled long, bins long, bound long"


def pieces_of(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0
) -> DataFrame:
    """Pieces of at most ``capacity`` ids of every document with its end id.

    A null or empty text gives one piece with the end id alone. Only longer documents are cut;
    their last piece may be shorter. Other columns are left out.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer_path)
        for batch in batches:
            for rows in slices(batch, "text", SLICE_BYTES):
                ids, lengths = coder.encode(rows.column("text"), end_id)
                raw = memoryview(ids.astype("<i4").tobytes())
                parts = -(-lengths // capacity)
                doc = np.repeat(np.arange(rows.num_rows), parts)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
                length = np.minimum(capacity, lengths[doc] - piece * capacity)
                first = 4 * ((np.cumsum(lengths) - lengths)[doc] + piece * capacity)
                crc = [zlib.crc32(raw[a : a + 4 * n]) for a, n in zip(first.tolist(), length.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id").take(pa.array(doc)),
                        pa.array(piece.astype(np.int32)),
                        pa.array(piece * capacity),
                        pa.array(length),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return whole_text(docs).mapInArrow(cut, PIECE_SCHEMA)


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """Bins that no packing can go below, by dual feasible functions.

    For each threshold e up to half a bin, pieces over ``capacity - e`` count as whole bins and
    pieces under e as nothing; the others go through u_k, which rounds (k + 1) x / capacity
    down to k-ths unless it is whole. k = 0 stands for the identity.
    """
    return bound_of_counts(np.bincount(lengths, minlength=capacity + 1), capacity)


def bound_of_counts(counts: np.ndarray, capacity: int = CAPACITY) -> int:
    """The same from the number of pieces of each length from 0 to ``capacity``."""
    if not counts.any():
        return 0
    sizes = np.arange(capacity + 1)
    most = 0
    for k in range(0, 13):
        # In units of 1 / (capacity * max(k, 1)), so that all sums are exact.
        scale = max(k, 1)
        whole = (k + 1) * sizes % capacity == 0
        kept_size = sizes * scale
        value = kept_size if k == 0 else np.where(
            whole, kept_size, (k + 1) * sizes // capacity * capacity
        )
        below = np.concatenate([[0], np.cumsum(counts * value)])
        at_least = np.concatenate([[0], np.cumsum(counts)])
        e = np.arange(1, capacity // 2 + 1)
        middle = below[capacity - e + 1] - below[e]
        large = at_least[-1] - at_least[capacity - e + 1]
        total = middle + large * capacity * scale
        most = max(most, int(-(-total.max() // (capacity * scale))))
    return most


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Bin number of each piece by best-fit decreasing."""
    bins = np.empty(len(lengths), np.int64)
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0  # bit r is set when a bin with r places left exists
    used = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = open_rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            chosen = rooms[room].pop()
            if not rooms[room]:
                open_rooms ^= 1 << room
        else:
            room, chosen = capacity, used
            used += 1
        bins[i] = chosen
        left = room - size
        if left:
            if not rooms[left]:
                open_rooms |= 1 << left
            rooms[left].append(chosen)
    return bins


def _pack_round(pieces: DataFrame, groups: int, number: int, capacity: int) -> DataFrame:
    """Every group packed on its own; ``bins`` and ``bound`` are those of the group."""

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
        frame = frame.sort_values([*columns], kind="stable", na_position="first")
        lengths = frame["length"].to_numpy()
        bins = best_fit(lengths, capacity)
        order = np.argsort(bins, kind="stable")
        out = frame.iloc[order]
        bins, lengths = bins[order], lengths[order]
        filled = np.bincount(bins, weights=lengths).astype(np.int64)
        before = np.cumsum(lengths) - lengths
        first = np.concatenate([[0], np.cumsum(np.bincount(bins))[:-1]])
        return out[columns].assign(
            sequence_id=(number << 56) + (int(frame["dealt"].iloc[0]) << 24) + bins,
            offset=before - before[first][bins],
            filled=filled[bins],
            bins=len(filled),
            bound=lower_bound(lengths, capacity),
        )

    # Dealt by the number of the row in its files, so that equal rows go to all groups alike.
    hashed = F.xxhash64(F.monotonically_increasing_id(), F.lit(number))
    dealt = pieces.withColumn("dealt", F.pmod(hashed, F.lit(groups)))
    return dealt.groupBy("dealt").applyInPandas(pack, PACKED_SCHEMA)


def pack(
    pieces: DataFrame,
    capacity: int = CAPACITY,
    group_pieces: int = GROUP_PIECES,
    max_exchanges: int | None = None,
) -> DataFrame:
    """Sequence and offset of every piece, and the certificate of its group.

    ``pieces`` are kept rows with the columns of ``PIECE_SCHEMA`` and lengths from 1 to
    ``capacity``. Equal rows are separate pieces. An exchange is kept only if it saves bins, so
    exchanges never make a packing worse; ``max_exchanges`` ends them early. An empty table
    gives no rows.
    """
    columns = [field.split()[0] for field in PIECE_SCHEMA.split(", ")]
    started = F.count_if(F.col("offset") == 0)  # every bin has one such row
    done: list[DataFrame] = []
    pool, gap, gap_bins, number = pieces, None, 0, 0
    largest = max(LARGEST_GROUP, group_pieces)
    size, total = group_pieces, pieces.count()
    while True:
        groups = max(1, -(-total // size))
        packed = kept(_pack_round(pool, groups, number, capacity), f"packed-{number}")
        saved = gap is None or packed.agg(started).head()[0] < gap_bins
        if saved:
            if gap is not None:
                done.pop()  # the open bins of the round before
            full = F.col("filled") == capacity
            done.append(packed.where(full))
            gap = packed.where(~full)
            done.append(gap)
            pool = gap.select(*columns)
            lengths = gap.groupBy("length").count().collect()  # at most ``capacity`` rows
            counts = np.zeros(capacity + 1, np.int64)
            for length, n in lengths:
                counts[length] = n
            total, gap_bins = int(counts.sum()), gap.agg(started).head()[0]
        certified = gap_bins == bound_of_counts(counts, capacity)
        if certified or groups == 1 or number == max_exchanges or not saved and size >= largest:
            return reduce(DataFrame.unionByName, done)
        size, number = min(2 * size, largest), number + 1

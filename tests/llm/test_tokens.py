from __future__ import annotations

import glob
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from samples import awkward, frame, texts
from winnow.llm import packing, tokens
from winnow.llm.encoder import Encoder
from winnow.llm.shared import kept, work_path

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ROWS = texts() + awkward()


def plain(path: str, texts: list[str | None]) -> list[list[int]]:
    tokenizer = Tokenizer.from_file(path)
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for t in texts]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_words_apart_give_the_ids_of_whole_texts(path):
    pieces = ["a", "B.", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "é,", "\n", " ", "  ", "\t", "İ", "Σ.", "'s", " ", "\x1c", "12", "“x”", "x" * 50]
    rng = random.Random(3)
    cases = ["".join(rng.choices(pieces, k=rng.randint(0, 9))) for _ in range(400)]
    cases += [t or "" for _, t, _ in ROWS]
    coder = Encoder(path, words_kept=50)
    for _ in range(2):  # with words new, and known
        ids, sizes = coder.encode(pa.array(cases), 0)
        ends = np.cumsum(sizes)
        found = [part.tolist() for part in np.split(ids, ends[:-1])]
        assert found == plain(path, cases)


def test_token_files_are_ordered_and_selective(spark):
    folder = work_path(spark, "files")
    docs = frame(spark, ROWS)
    tokens.write_tokens(docs, BYTES, folder, parts=3)
    rows = tokens.digest(tokens.read_tokens(spark, folder)).collect()
    assert len(rows) == len(ROWS)
    start = 0
    for row in sorted(rows, key=lambda r: r.start):
        assert row.start == start
        start += row.n_tokens
    keys = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert keys == sorted(keys, key=lambda k: (k is not None, k))
    expected = {
        (i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        for (i, _, _), ids in zip(ROWS, plain(BYTES, [t for _, t, _ in ROWS]))
    }
    assert {(r.doc_id, r.n_tokens, r.ids_crc32) for r in rows} == expected
    for path in glob.glob(f"{folder}/tokens/*.parquet"):
        group = pq.ParquetFile(path).metadata.row_group(0)
        column = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
        assert all(c.has_offset_index for c in column.values())
        assert "DELTA_BINARY_PACKED" in column["doc_id"].encodings
        assert "RLE_DICTIONARY" in column["ids.list.element"].encodings


def test_metadata_and_single_documents_are_read_without_the_ids(spark, plan):
    folder = work_path(spark, "files")
    tokens.write_tokens(frame(spark, ROWS), BYTES, folder)
    metadata = tokens.read_tokens(spark, folder, ids=False)
    assert "ids" not in plan(metadata)
    one = tokens.read_tokens(spark, folder).where("doc_id = 9")
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,9)" in plan(one)
    assert one.count() == 1


def test_token_files_of_an_empty_table(spark):
    folder = work_path(spark, "files")
    tokens.write_tokens(frame(spark, []), BYTES, folder)
    assert tokens.digest(tokens.read_tokens(spark, folder)).count() == 0


def packed(spark, rows, **options):
    return packing.pack(kept(packing.pieces_of(frame(spark, rows), WORDS), "pieces"), **options).collect()


def check_packing(found, rows):
    expected = []
    for (key, _, _), ids in zip(rows, plain(WORDS, [t for _, t, _ in rows])):
        for piece, low in enumerate(range(0, len(ids), 2048)):
            own = ids[low : low + 2048]
            expected.append((key, piece, low, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found]
    assert sorted(got, key=str) == sorted(expected, key=str)
    bins: dict[int, list] = {}
    for row in found:
        bins.setdefault(row.sequence_id, []).append(row)
    for own in bins.values():
        at = 0
        for row in sorted(own, key=lambda r: r.offset):
            assert row.offset == at
            at += row.length
        assert at <= 2048 and {r.filled for r in own} == {at}
    return len(bins)


def test_every_piece_is_packed_once(spark):
    bins = check_packing(packed(spark, ROWS), ROWS)
    lengths = [len(i) for i in plain(WORDS, [t for _, t, _ in ROWS])]
    pieces = np.array([min(2048, n - low) for n in lengths for low in range(0, n, 2048)])
    assert bins == packing.lower_bound(pieces)


def test_exchange_closes_the_gaps_of_small_groups(spark):
    rng = np.random.default_rng(1)
    lengths = rng.integers(300, 1400, 600)
    pieces = spark.createDataFrame([(i, 0, 0, int(n), i) for i, n in enumerate(lengths)], packing.PIECE_SCHEMA)
    alone = packing.pack(kept(pieces, "pieces"), group_pieces=20, max_exchanges=0)
    exchanged = packing.pack(kept(pieces, "pieces"), group_pieces=20)
    count = [df.select("sequence_id").distinct().count() for df in (alone, exchanged)]
    assert count[1] < count[0]
    assert exchanged.count() == 600
    assert exchanged.groupBy("sequence_id").agg({"length": "sum"}).where("`sum(length)` > 2048").isEmpty()


def test_equal_pieces_are_spread_and_certified(spark):
    same = [(7, 0, 0, 700, 5)] * 3000 + [(None, 0, 0, 1300, 6)] * 500
    pieces = kept(spark.createDataFrame(same, packing.PIECE_SCHEMA), "pieces")
    dealt = packing._pack_round(pieces, 8, 0, packing.CAPACITY).groupBy((packing.F.col("sequence_id") / 2**24).cast("long"))
    sizes = [r["count"] for r in dealt.count().collect()]
    assert len(sizes) == 8 and max(sizes) < 600
    found = packing.pack(pieces, group_pieces=50).collect()
    assert len(found) == 3500 and sum(r.length for r in found) == 3000 * 700 + 500 * 1300
    bins = len({r.sequence_id for r in found})
    assert bins == packing.lower_bound(np.array([700] * 3000 + [1300] * 500))


def test_lower_bound_never_exceeds_a_packing():
    rng = np.random.default_rng(2)
    for _ in range(200):
        lengths = rng.integers(1, 65, rng.integers(1, 40))
        bins = packing.best_fit(lengths, 64)
        assert packing.lower_bound(lengths, 64) <= bins.max() + 1
        assert np.bincount(bins, weights=lengths).max() <= 64
    # Three items over a third: pairs do not fit, which the plain sum does not show.
    assert packing.lower_bound(np.array([33, 33, 33]), 64) == 3
    assert packing.lower_bound(np.zeros(0, np.int64), 64) == 0


def test_packing_of_an_empty_table(spark):
    assert packed(spark, []) == []

"""Token-id files: Parquet list columns that allow selective reads of tokens and metadata.

Documents are dealt by ranges of ``doc_id``, encoded, and written in that order. The ids are a
dictionary-encoded list column, the counters are delta-encoded, row groups and pages are small
enough that a reader of a few documents or of the metadata alone skips the rest by the page
indexes. An index table beside the files has one row per file with the tokens before it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from winnow.llm.encoder import encoder
from winnow.llm.shared import ready, splits, whole_text
from winnow.llm.words import slices

ROW_GROUP_BYTES = 16 * 1024 * 1024
PAGE_ROWS = 500
END_ID = 0
# Text that a task encodes at once.
SLICE_BYTES = 2_000_000

TOKEN_SCHEMA = "doc_id long, part int, before long, n_tokens long, ids array<int>"

# Version-2 pages store integers without a dictionary as deltas.
FILE_OPTIONS = {
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "false",
    "parquet.enable.dictionary#ids.list.element": "true",
    "parquet.block.size": str(ROW_GROUP_BYTES),
    "parquet.page.row.count.limit": str(PAGE_ROWS),
    "compression": "zstd",
}


def encode_in_order(
    docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, parts: int | None = None
) -> DataFrame:
    """One row per document in ascending ``doc_id``: its ids, the end id, and its place.

    ``part`` counts the ranges of ``doc_id`` and ``before`` the ids in the same part before the
    document. A null text is empty and has the end id only. Rows with the same ``doc_id`` follow
    each other in the order of a hash of their texts; a null ``doc_id`` comes first. Other
    columns of ``docs`` are left out, so their names cannot clash. An empty table gives no rows.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        coder = encoder(tokenizer_path)
        for batch in batches:
            for rows in slices(batch, "text", SLICE_BYTES):
                ids, lengths = coder.encode(rows.column("text"), end_id)
                offsets = np.concatenate([[0], np.cumsum(lengths)])
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"),
                        pa.array(np.full(rows.num_rows, part, np.int32)),
                        pa.array(before + offsets[:-1]),
                        pa.array(lengths),
                        pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids)),
                    ],
                    names=["doc_id", "part", "before", "n_tokens", "ids"],
                )
                before += len(ids)

    rows = whole_text(docs)
    order = ["doc_id", F.xxhash64("text")]
    dealt = rows.repartitionByRange(parts or splits(docs), *order).sortWithinPartitions(*order)
    return dealt.mapInArrow(encode, TOKEN_SCHEMA)


def write_tokens(docs: DataFrame, tokenizer_path: str, folder: str, **options) -> None:
    """Writes ``folder/tokens``, one file per range of documents, and ``folder/index``."""
    spark = ready(docs.sparkSession)
    encoded = encode_in_order(docs, tokenizer_path, **options)
    encoded.write.options(**FILE_OPTIONS).parquet(f"{folder}/tokens")
    written = spark.read.schema(TOKEN_SCHEMA).parquet(f"{folder}/tokens")
    files = written.groupBy("part").agg(
        F.count("*").alias("documents"), F.sum("n_tokens").alias("tokens")
    )
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file, so the single task of this window stays small.
    base = F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("base")
    files.select("part", "documents", "tokens", base).write.parquet(f"{folder}/index")


def read_tokens(spark: SparkSession, folder: str, ids: bool = True) -> DataFrame:
    """Documents of token files with ``start``, the ids of all documents before each.

    Without ``ids`` only the metadata pages are read. A filter on ``doc_id`` skips row groups
    and pages by their statistics.
    """
    columns = ["doc_id", "part", "before", "n_tokens", *(["ids"] if ids else [])]
    written = spark.read.schema(TOKEN_SCHEMA).parquet(f"{folder}/tokens").select(*columns)
    index = spark.read.schema("part int, base long").parquet(f"{folder}/index")
    placed = written.join(index, "part")
    start = (F.col("base") + F.col("before")).alias("start")
    return placed.select("doc_id", start, "n_tokens", *(["ids"] if ids else []))


def digest(tokens: DataFrame) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and the crc32 of each document's stored ids."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            ids = memoryview(np.ascontiguousarray(lists.values.to_numpy(), "<i4").view(np.uint8))
            ends = 4 * lists.offsets.to_numpy().astype(np.int64)
            crc = [zlib.crc32(ids[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            plain = [batch.column(c) for c in ("doc_id", "start", "n_tokens")]
            yield pa.RecordBatch.from_arrays(
                [*plain, pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return tokens.mapInArrow(sums, "doc_id long, start long, n_tokens long, ids_crc32 long")

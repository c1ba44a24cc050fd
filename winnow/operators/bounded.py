"""Size checks before a table is made local, and durable cuts of the lineage."""

from __future__ import annotations

import tempfile
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType

# Largest statistic that may become a local table.
LOCAL_ROWS = 100_000
LOCAL_BYTES = 16 * 1024 * 1024
# Longest and shortest bound on a text of such a table.
CELL_CHARS, LEAST_CHARS = 1000, 64


def rows_if_small(
    df: DataFrame, max_rows: int = LOCAL_ROWS, max_bytes: int = LOCAL_BYTES
) -> pa.Table | None:
    """The rows of a table with plain columns, or None when it exceeds the bounds.

    ``take`` reads a few partitions at a time and stops at the bound, so a table of
    any size is refused after ``max_rows + 1`` rows, without an exchange to one task.
    Texts are cut before they leave the cluster, and a table with a longer one is refused:
    all rows and texts together then hold at most ``max_bytes`` characters, or
    ``LEAST_CHARS`` for each text, however many the table has.
    """
    texts = {f.name for f in df.schema if isinstance(f.dataType, StringType)}
    longest = max_bytes // max(max_rows * len(texts), 1)
    longest = max(LEAST_CHARS, min(CELL_CHARS, longest))
    cut = [
        F.substring(F.col(_quoted(c)), 1, longest + 1).alias(c) if c in texts else _quoted(c)
        for c in df.columns
    ]
    rows = df.select(*cut).take(max_rows + 1)
    if len(rows) > max_rows:
        return None
    schema = to_arrow_schema(df.schema)
    columns = list(zip(*rows)) or [()] * len(schema)
    if any(
        f.name in texts and any(v is not None and len(v) > longest for v in c)
        for c, f in zip(columns, schema)
    ):
        return None
    table = pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
    return None if table.nbytes > max_bytes else table


def _quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def local_if_small(
    df: DataFrame, max_rows: int = LOCAL_ROWS, max_bytes: int = LOCAL_BYTES
) -> DataFrame | None:
    """The result as a local relation, or None when it is larger than the bounds.

    Catalyst's own estimate for the result of a join or aggregate is often far too
    high, and a table of 25 labels would then shuffle the whole fact; the actual
    size settles it.
    """
    rows = rows_if_small(df, max_rows, max_bytes)
    return None if rows is None else df.sparkSession.createDataFrame(rows, schema=df.schema)


def small_or_same(df: DataFrame, max_rows: int = LOCAL_ROWS) -> DataFrame:
    """A table to be broadcast if it is proven small, else unchanged for a shuffled join."""
    local = local_if_small(df, max_rows)
    return df if local is None else F.broadcast(local)


def shared_folder(spark: SparkSession) -> str:
    """Folder for cut lineage: ``spark.checkpoint.dir``, which all executors can reach."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        # A local session without the setting, as in a trial, keeps one folder of its own.
        folder = tempfile.mkdtemp(prefix="winnow-")
        context.setCheckpointDir(folder)
    return folder


def durable(df: DataFrame) -> DataFrame:
    """The rows written as Parquet in the shared folder, so that every later read sees the same.

    Unlike a checkpoint of rows the files are compressed and read column by column.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/durable-{uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

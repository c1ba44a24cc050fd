"""What the operators of this package share: durable tables, deals of documents, worker setup."""

from __future__ import annotations

import os
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from winnow.operators.bounded import shared_folder

# Documents of a part when a table is dealt by ranges; about 100 MB of text.
ROWS_EACH = 40_000
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ready(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package from where the driver has it.

    On a cluster without a shared file system pass the package with ``--py-files``.
    """
    known = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, *known]))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that all executors reach."""
    return f"{shared_folder(spark).rstrip('/')}/winnow-{uuid4().hex}/{name}"


def kept(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The rows written as Parquet to the shared folder and read again.

    Later reads see the same rows, columns are pruned, and lost executors cost nothing.
    """
    path = work_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """The kept rows and their number, which the writing job counts on its way."""
    seen = Observation()
    rows = kept(df.observe(seen, F.count(F.lit(1)).alias("n")), name)
    return rows, seen.get["n"]


def crc_mod(column: str, divisor: int) -> Column:
    """crc32 of a key as text, modulo a divisor; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


def whole_text(docs: DataFrame, *extra: str) -> DataFrame:
    """``doc_id``, ``text`` with null as empty text, and the named columns only."""
    ready(docs.sparkSession)
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *extra)


def splits(df: DataFrame, rows_each: int = ROWS_EACH) -> int:
    """Number of parts for a table of this size, at least the session's shuffle partitions."""
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(usual, -(-df.count() // rows_each))

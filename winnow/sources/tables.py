"""Readers and writers for CSV sources, Parquet stages and JSON reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from winnow.functions.nulls import nan_to_null
from winnow.sources.schemas import INPUT_SCHEMAS

# Cell texts that a CSV source uses for "missing".
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

ORDER = "input_order"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    missing: Sequence[str] = MISSING_TEXTS,
    keep_order: bool = False,
    multiline: bool = False,
) -> DataFrame:
    """Read a CSV file with a header under a declared schema.

    Quotes inside a quoted cell are doubled. A row with more or fewer cells than the
    schema fails the job. ``multiline`` allows line breaks inside quotes; it is off by
    default, as it forbids to split a file.

    Cells are read as text with their blanks, the ``missing`` texts become NULL and
    the rest is cast; under ANSI mode a cell of the wrong type fails the job. An
    absent path fails at once. ``keep_order`` adds the position of each row.
    """
    text = StructType([StructField(f.name, StringType()) for f in schema])
    form = {"header": True, "encoding": "UTF-8", "enforceSchema": False, "mode": "FAILFAST"}
    raw = spark.read.schema(text).options(**form, escape='"', multiLine=multiline).csv(path)
    typed = [
        F.when(~F.col(f.name).isin(*missing), F.col(f.name)).cast(f.dataType).alias(f.name)
        for f in schema
    ]
    if not keep_order:
        return raw.select(*typed)
    return raw.select(*typed, row_position().alias(ORDER))


def row_position() -> Column:
    """Position of a row in its files: row ids only grow within one file block, which the path
    and block start identify."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def read_sources(
    spark: SparkSession,
    paths: Mapping[str, str],
    schemas: Mapping[str, StructType] = INPUT_SCHEMAS,
    keep_order: Sequence[str] = ("pesees", "cooperatives"),
) -> dict[str, DataFrame]:
    """Read the named CSV sources; the fact and the official labels keep their input order."""
    return {
        name: read_csv(spark, path, schemas[name], keep_order=name in keep_order)
        for name, path in paths.items()
    }


def write_csv(df: DataFrame, path: str) -> str:
    """Write CSV with a header, keeping the blanks around labels and doubling quotes."""
    df.write.mode("overwrite").options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    return path


def write_stage(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Write a stage as snappy Parquet, replacing the previous run."""
    writer = df.write.mode("overwrite").option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_bucketed(
    df: DataFrame, table: str, path: str, key: str, order: Sequence[str], buckets: int
) -> DataFrame:
    """A stage in buckets of its key, each sorted, as the table of that name; read it by the name.

    One exchange deals the rows, one task writes each bucket. Grouping, keep-first and joins by
    the key then need none, as often as the table is read in the session.
    """
    dealt = df.repartition(buckets, key).sortWithinPartitions(key, *order)
    writer = dealt.write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)


def read_stage(
    spark: SparkSession, path: str, schema: StructType | None = None, keep_order: bool = False
) -> DataFrame:
    """Read a Parquet stage with NaN as NULL; an absent path fails at once."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    raw = reader.parquet(path)
    if not keep_order or ORDER in raw.columns:
        return nan_to_null(raw)
    position = F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    )
    return nan_to_null(raw.select("*", position.alias(ORDER)))


def write_report(report: DataFrame, path: str) -> str:
    """Write a report (one nested row) as JSON, accents kept and absent values shown."""
    report.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path

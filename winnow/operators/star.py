"""Dimensions with integer keys and a fact table that carries them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from winnow.operators.bounded import LOCAL_ROWS, durable, rows_if_small
from winnow.operators.joins import attach_reference

# Members that one task numbers.
PART_ROWS = 1_000_000


def dimension(
    reference: DataFrame,
    natural_key: str,
    surrogate: str,
    attributes: Sequence[str] = (),
    local_rows: int = LOCAL_ROWS,
) -> DataFrame:
    """One row per natural key with a dense surrogate 1..n in key order.

    A dimension that is proven small is numbered in one sort. Otherwise rows are numbered
    inside many range partitions and shifted by the sizes of the partitions before; only
    those sizes, one row per partition, meet in one task. The numbers are the same.
    """
    rows = reference.select(natural_key, *attributes).filter(F.col(natural_key).isNotNull())
    if not attributes:
        rows = rows.distinct()
    small = rows_if_small(rows, local_rows)
    if small is not None:
        ordered = small.sort_by(natural_key)
        numbers = pa.array(range(1, ordered.num_rows + 1), pa.int64())
        table = ordered.add_column(0, surrogate, numbers)
        schema = StructType([StructField(surrogate, LongType()), *rows.schema])
        return reference.sparkSession.createDataFrame(table, schema=schema)
    # Range boundaries come from a sample: read them twice from a durable copy.
    usual = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(usual, -(-rows.count() // PART_ROWS))
    parts = durable(
        rows.repartitionByRange(ranges, natural_key).withColumn("part", F.spark_partition_id())
    )
    sizes = parts.groupBy("part").agg(F.count("*").alias("size"))
    before = F.sum("size").over(Window.orderBy("part")) - F.col("size")
    offsets = sizes.select("part", before.alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(natural_key))
    return (
        parts.withColumn("place", place)
        .join(offsets, "part")
        .select((F.col("before") + F.col("place")).alias(surrogate), natural_key, *attributes)
    )


def star_fact(
    df: DataFrame, dimensions: Mapping[str, tuple[DataFrame, str, str]], measures: Sequence[str]
) -> DataFrame:
    """Fact rows with one surrogate per dimension, NULL where the dimension lacks the value.

    ``dimensions`` maps a fact column to (dimension, natural key, surrogate).
    """
    for column, (table, natural_key, surrogate) in dimensions.items():
        df = attach_reference(df, table, column, [surrogate], natural_key)
    return df.select(*[s for _, _, s in dimensions.values()], *measures)

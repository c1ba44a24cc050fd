"""Surrogate keys that stay: a stored registry of natural keys that only ever grows.

A load compares its members with the registry by an anti-join and numbers the new ones after the
stored maximum, in key order. A key that was given out never changes and is never used again,
also when its member is missing from later loads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.operators.bounded import LOCAL_ROWS
from winnow.operators.star import dimension
from winnow.sources.stages import file_system


class KeyRegistry:
    """The registry of one dimension in a folder of Parquet files.

    A load appends one set of files, which Spark's commit makes visible as a whole: a load that
    fails leaves the registry as it was, and one that is repeated finds nothing new. Loads of
    one registry must not run at the same time.
    """

    def __init__(self, spark: SparkSession, path: str, natural_key: str, surrogate: str):
        self.spark = spark
        self.path = path
        self.natural_key = natural_key
        self.surrogate = surrogate

    def exists(self) -> bool:
        system, where = file_system(self.spark, f"{self.path}/_SUCCESS")
        return system.exists(where)

    def keys(self) -> DataFrame:
        """All keys that were given out: the surrogate and the natural key."""
        return self.spark.read.parquet(self.path)

    def load(self, members: DataFrame, local_rows: int = LOCAL_ROWS) -> DataFrame:
        """Register the members that are new; a missing natural key gets no number."""
        known = members.select(self.natural_key).dropna().distinct()
        last = 0
        if self.exists():
            given = self.keys()
            last = given.agg(F.max(self.surrogate).alias("last")).head()["last"] or 0
            known = known.join(given.select(self.natural_key), self.natural_key, "left_anti")
        new = dimension(known, self.natural_key, self.surrogate, local_rows=local_rows)
        number = (F.col(self.surrogate) + F.lit(last)).cast("long")
        new.withColumn(self.surrogate, number).write.mode("append").parquet(self.path)
        return self.keys()

    def dimension(self, reference: DataFrame, attributes: Sequence[str]) -> DataFrame:
        """Every registered key with its attributes of today, NULL where the member is gone."""
        now = reference.select(self.natural_key, *attributes)
        joined = self.keys().join(now, self.natural_key, "left")
        return joined.select(self.surrogate, self.natural_key, *attributes)

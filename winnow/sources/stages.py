"""Intermediate tables: written once, counted while they are written, removed with their run."""

from __future__ import annotations

from types import TracebackType
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from winnow.operators.bounded import shared_folder
from winnow.sources.tables import write_stage


class Stage:
    """Writes a table as Parquet under a fresh name and reads it back.

    ``rows`` is the number of rows of the last table. The writing tasks count them, and a task
    that is run again after a lost executor counts once, so no further job or scan is needed.
    """

    def __init__(self, folder: str | None = None):
        self.folder = folder
        self.rows: int | None = None

    def __call__(self, df: DataFrame) -> DataFrame:
        spark, seen = df.sparkSession, Observation()
        path = f"{self.folder or shared_folder(spark)}/stage-{uuid4().hex}"
        write_stage(df.observe(seen, F.count(F.lit(1)).alias("rows")), path)
        self.rows = seen.get["rows"]
        return spark.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it takes it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


class Run:
    """Owns the intermediate tables of one run and publishes its results at the end.

    Results are written next to their final name and renamed when the run leaves its block
    without an error, in the order in which they were written. Everything else is removed,
    also after an error: then nothing has changed under a final name.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.name = uuid4().hex
        self.folder = f"{folder or shared_folder(spark)}/run-{self.name}"
        self.pending: dict[str, str] = {}

    def stage(self) -> Stage:
        """A stage whose tables live as long as the run."""
        return Stage(self.folder)

    def result(self, path: str) -> str:
        """Where to write what will be found under ``path`` after the run."""
        self.pending[path] = f"{path.rstrip('/')}-unfinished-{self.name}"
        return self.pending[path]

    def __enter__(self) -> Run:
        return self

    def __exit__(
        self, kind: type[BaseException] | None, error: BaseException | None, trace: TracebackType | None
    ) -> None:
        try:
            if kind is None:
                for path, written in self.pending.items():
                    self._publish(written, path)
        finally:
            for path in (self.folder, *self.pending.values()):
                system, where = file_system(self.spark, path)
                system.delete(where, True)

    def _publish(self, written: str, path: str) -> None:
        system, final = file_system(self.spark, path)
        _, source = file_system(self.spark, written)
        system.delete(final, True)
        if not system.rename(source, final):
            raise OSError(f"cannot rename {written} to {path}")

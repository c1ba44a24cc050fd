"""Duplicate counts and keep-first deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in the given order; missing keys equal each other.

    Catalyst turns the filtered ``row_number`` into a group limit before the
    exchange, so a key that holds a third of the rows sends one row per task.
    """
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__position", position).filter("__position = 1").drop("__position")


def duplicate_counts(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """One row: ``lignes``, ``cles``, ``doublons_cle`` and ``doublons_complets``.

    Exact copies are folded first, which needs no key to be whole in one place;
    the second grouping then moves two counters per key.
    """
    columns = list(columns or df.columns)
    copies = df.groupBy(*columns).agg(F.count("*").alias("n"))
    per_key = copies.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum(F.col("n") - 1).alias("same"))
    total = F.coalesce(F.sum("n"), F.lit(0))
    return per_key.agg(
        total.alias("lignes"),
        F.count("*").alias("cles"),
        (total - F.count("*")).alias("doublons_cle"),
        F.coalesce(F.sum("same"), F.lit(0)).alias("doublons_complets"),
    )


def dedup_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows before, rows removed and rows after :func:`keep_first`."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n"), F.lit(0))
    return per_key.agg(
        before.alias("lignes_avant"),
        (before - F.count("*")).alias("doublons_supprimes"),
        F.count("*").alias("lignes_apres"),
    )

"""Imputation by group median, with a flag on every value that was filled."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.functions.nulls import flag
from winnow.functions.rounding import round_half_even, rounded_long
from winnow.operators.quantiles import (
    COUNT,
    VALUE,
    Measure,
    attach_statistic,
    group_quantiles,
    quantiles_of_counts,
)


@dataclass(frozen=True)
class MedianFill:
    """Fill ``column`` with its median over ``keys`` wherever ``valid`` is not true."""

    column: str
    keys: tuple[str, ...]
    flag: str
    valid: str
    digits: int | None = None  # None rounds to a whole number of type long

    @property
    def measure(self) -> Measure:
        return Measure(self.column, f"CASE WHEN {self.valid} THEN {self.column} END", self.keys)

    def rounded(self, value):
        return rounded_long(value) if self.digits is None else round_half_even(value, self.digits)


def null_sentinels(df: DataFrame, fill: MedianFill) -> DataFrame:
    """Set values that are not valid to NULL and mark them, as well as missing ones."""
    valid = F.expr(fill.valid)
    return df.withColumns(
        {fill.flag: ~flag(valid), fill.column: F.when(valid, F.col(fill.column))}
    )


def medians_of_counts(counts: DataFrame, fill: MedianFill) -> DataFrame:
    """Group medians for a fill from a small table of counted measures."""
    own = counts.filter(F.col("mesure") == fill.column).dropna(subset=[*fill.keys, VALUE])
    return quantiles_of_counts(own, fill.keys)


def filled_counts(counts: DataFrame, fill: MedianFill) -> DataFrame:
    """The counted values of a measure as they stand after its imputation."""
    own = counts.filter(F.col("mesure") == fill.column)
    medians = medians_of_counts(counts, fill)
    value = F.coalesce(F.col(VALUE), F.col("median"))
    return attach_statistic(own, medians, fill.keys).select(
        *fill.keys, fill.rounded(value).cast("double").alias(VALUE), COUNT
    )


def fill_with_median(df: DataFrame, fill: MedianFill, medians: DataFrame | None = None) -> DataFrame:
    """Apply a fill: flag, fill, round; a group without any median stays missing."""
    columns = df.columns
    if medians is None:
        medians = group_quantiles(df, fill.keys, F.expr(fill.measure.value))
    marked = null_sentinels(df, fill)
    filled = attach_statistic(marked, medians, fill.keys).withColumn(
        fill.column, fill.rounded(F.coalesce(F.col(fill.column), F.col("median")))
    )
    return filled.select(*columns, *([] if fill.flag in columns else [fill.flag]))


def imputation_summary(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """One row with the number of filled values per flag."""
    return df.agg(*[F.count_if(f).alias(f) for f in flags])


def measured_only(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Rows in which none of the flagged values was imputed."""
    for name in flags:
        df = df.filter(~F.col(name))
    return df

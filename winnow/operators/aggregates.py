"""Grouped summaries, shares and hierarchy checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winnow.functions.rounding import round_half_even


def exact_sum(df: DataFrame, column: str) -> Column:
    """Sum of a column that no order of its rows changes.

    Doubles are added as decimals of 12 places. A group with a value that these do not hold to
    nine digits (below 1e-3 with many digits, from 1e16 on, infinite or NaN) is added as
    doubles: NaN gives NaN, and no value is lost.
    """
    if dict(df.dtypes)[column] not in ("double", "float"):
        return F.sum(column)
    value = F.col(column)
    part = value.try_cast("decimal(28,12)")
    held = F.abs(part.cast("double") - value) <= F.abs(value) * 1e-9
    lost = F.count_if(value.isNotNull() & ~F.coalesce(held, F.lit(False)))
    exact = F.try_sum(part).cast("double")
    return F.when(lost == 0, F.coalesce(exact, F.sum(value))).otherwise(F.sum(value))


def grouped_summary(
    df: DataFrame,
    keys: Sequence[str],
    counted: Mapping[str, str] | None = None,
    means: Mapping[str, str] | None = None,
    sums: Mapping[str, str] | None = None,
    digits: int | None = 1,
) -> DataFrame:
    """Counts, means and sums per group as ``{output name: column}``; no group for a missing key."""

    def rounded(value: Column) -> Column:
        return value if digits is None else round_half_even(value, digits)

    return (
        df.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(
            *[F.count(c).alias(name) for name, c in (counted or {}).items()],
            *[rounded(F.avg(c)).alias(name) for name, c in (means or {}).items()],
            *[exact_sum(df, c).alias(name) for name, c in (sums or {}).items()],
        )
    )


def with_share(df: DataFrame, value: str, name: str, digits: int | None = 1, percent: bool = True) -> DataFrame:
    """Add each row's share of the column total; for a table of groups, which one task can hold.

    The total is a window over the rows themselves, so their plan runs once.
    """
    total = F.sum(value).over(Window.partitionBy(F.lit(0))).cast("double")
    share = F.try_divide(F.col(value).cast("double"), total)
    share = share * 100 if percent else share
    return df.withColumn(name, share if digits is None else round_half_even(share, digits))


def weighted_mean(
    df: DataFrame, keys: Sequence[str], amount: str, weight: str, name: str, digits: int | None = 1
) -> DataFrame:
    """``sum(amount) / sum(weight)`` per group, next to the two sums and the row count."""
    totals = df.groupBy(*keys).agg(
        F.count("*").alias("nb"),
        exact_sum(df, amount).alias(amount),
        exact_sum(df, weight).alias(weight),
    )
    mean = F.try_divide(F.col(amount).cast("double"), F.col(weight).cast("double"))
    return totals.withColumn(name, mean if digits is None else round_half_even(mean, digits))


def distinct_pairs(df: DataFrame, left: str, right: str) -> DataFrame:
    """One row ``couples``: distinct pairs in which neither side is missing."""
    return df.select(left, right).dropna().distinct().agg(F.count("*").alias("couples"))


def keys_with_several(df: DataFrame, key: str, attribute: str) -> DataFrame:
    """Keys with more than one attribute value; extremes suffice, no distinct set is built."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min(attribute).alias("low"), F.max(attribute).alias("high"))
        .filter(F.col("low") < F.col("high"))
        .select(key)
    )


def union_rows(df: DataFrame, repeated: Column) -> DataFrame:
    """The table followed by a second copy of the rows that meet ``repeated`` (bag union)."""
    return df.unionByName(df.filter(repeated))

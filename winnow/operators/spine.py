"""A calendar between two dates with month and weekday weights."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.functions.conditional import constant_lookup
from winnow.operators.aggregates import with_share
from winnow.operators.profile import period_span

SUNDAY = 6


def date_spine(df: DataFrame, date: Column) -> DataFrame:
    """Every day from the first to the last date of the table, both included."""
    bounds = period_span(df, date).filter(F.col("debut").isNotNull())
    return bounds.select(F.explode(F.sequence("debut", "fin")).alias("jour"))


def weighted_spine(
    spine: DataFrame,
    month_weights: Mapping[int, float],
    sunday_factor: float,
    name: str = "poids",
) -> DataFrame:
    """Weight per day, month weight times the Sunday factor, normalised to sum 1."""
    month = constant_lookup(F.month("jour"), month_weights)
    sunday = F.when(F.weekday("jour") == SUNDAY, sunday_factor).otherwise(1.0)
    return with_share(
        spine.withColumn("brut", month * sunday), "brut", name, digits=None, percent=False
    ).drop("brut")

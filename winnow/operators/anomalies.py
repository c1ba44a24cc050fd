"""Anomaly flags and their summary; no row is ever removed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.functions.nulls import flag, nan_to_null, share_pct
from winnow.functions.rounding import round_half_even
from winnow.operators.bounded import LOCAL_ROWS, local_if_small
from winnow.operators.quantiles import (
    VALUE,
    Measure,
    attach_statistic,
    group_quantiles,
    measure_counts,
    quantiles_of_counts,
)

# The names of the three families in reports.
FAMILIES = ("tonnage extreme", "humidite hors norme export", "prix atypique pour le grade")
FLAGS = ("anomalie_tonnage", "anomalie_humidite", "anomalie_prix")
QUARTILES = {"q1": 0.25, "q3": 0.75}


@dataclass(frozen=True)
class AnomalyColumns:
    """Columns and thresholds of the three anomaly families."""

    weight: str = "tonnage_kg"
    moisture: str = "humidite_pct"
    price: str = "prix_fcfa_kg"
    group: str = "qualite"
    spread: float = 3.0
    moisture_limit: float = 8.0
    deviation: float = 0.30


@dataclass(frozen=True)
class AnomalyStatistics:
    """Quartiles of the weight (one row) and median price per group."""

    quartiles: DataFrame
    medians: DataFrame


def anomaly_statistics(
    df: DataFrame, columns: AnomalyColumns = AnomalyColumns(), local_rows: int = LOCAL_ROWS
) -> AnomalyStatistics:
    """Both statistics, from one scan when the counted values are few enough."""
    c = columns
    measures = [Measure("weight", c.weight), Measure("price", c.price, (c.group,))]
    counts = local_if_small(measure_counts(df, measures), local_rows)
    if counts is None:
        return AnomalyStatistics(
            group_quantiles(df, [], c.weight, QUARTILES, local_rows),
            group_quantiles(df, [c.group], c.price, local_rows=local_rows),
        )
    weight = counts.filter("mesure = 'weight'").dropna(subset=[VALUE])
    price = counts.filter("mesure = 'price'").dropna(subset=[c.group, VALUE])
    return AnomalyStatistics(
        quantiles_of_counts(weight, [], QUARTILES), quantiles_of_counts(price, [c.group])
    )


def _fence(stats: AnomalyStatistics, spread: float) -> Column:
    """Upper fence as a scalar subquery, evaluated once."""
    fence = F.col("q3") + spread * (F.col("q3") - F.col("q1"))
    return stats.quartiles.select(fence).scalar()


def flag_anomalies(
    df: DataFrame,
    columns: AnomalyColumns = AnomalyColumns(),
    stats: AnomalyStatistics | None = None,
) -> DataFrame:
    """Add one boolean per family to every row; a missing measure, NaN too, is no anomaly."""
    c, df = columns, nan_to_null(df)
    stats = stats or anomaly_statistics(df, c)
    relative = F.try_divide(F.abs(F.col(c.price) - F.col("median")), F.col("median"))
    flagged = attach_statistic(df, stats.medians, [c.group]).withColumns(
        {
            FLAGS[0]: flag(F.col(c.weight) > _fence(stats, c.spread)),
            FLAGS[1]: flag(F.col(c.moisture) > c.moisture_limit),
            FLAGS[2]: flag(relative > c.deviation),
        }
    )
    return flagged.select(*df.columns, *FLAGS)


def anomaly_summary(
    df: DataFrame,
    columns: AnomalyColumns = AnomalyColumns(),
    stats: AnomalyStatistics | None = None,
) -> DataFrame:
    """One row per family: criterion, rows, share in percent, weight concerned, action."""
    c, df = columns, nan_to_null(df)
    stats = stats or anomaly_statistics(df, c)
    flagged = flag_anomalies(df, c, stats)
    totals = flagged.agg(
        F.count("*").alias("rows"),
        *[F.count_if(f).alias(f) for f in FLAGS],
        *[F.sum(F.when(F.col(f), F.col(c.weight))).alias(f"amount_{f}") for f in FLAGS],
    )
    return totals.select(F.inline(summary_rows(c, stats)))


def summary_rows(columns: AnomalyColumns, stats: AnomalyStatistics) -> Column:
    """The summary as an array of structs, from a row of totals.

    The totals are ``rows``, the count of each flag under its name, and the weight of the
    flagged rows as ``amount_<flag>``.
    """
    c = columns
    fence = F.format_number(F.rint(_fence(stats, c.spread)), 0)
    # The report texts of the three families.
    criteria = (
        F.concat(F.lit("> "), fence, F.lit(f" kg (Q3 + {c.spread:g} x IQR)")),
        F.lit(f"> {c.moisture_limit} %"),
        F.lit(f"ecart > {c.deviation:.0%} a la mediane du grade".replace("%", " %")),
    )
    rows = [
        F.struct(
            F.lit(name).alias("anomalie"),
            criterion.alias("critere"),
            F.col(f).alias("nb_lignes"),
            share_pct(F.col(f), F.col("rows")).alias("part_pct"),
            round_half_even(F.coalesce(f"amount_{f}", F.lit(0.0)), 1).alias("tonnage_concerne_kg"),
            F.lit("signale, conserve").alias("action"),
        )
        for f, name, criterion in zip(FLAGS, FAMILIES, criteria)
    ]
    return F.array(*rows)
